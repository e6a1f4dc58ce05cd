"""Fixed values that must equal the reference jobs' values for equal results.

Kept together, as plain text, in the order the jobs use them.
"""

# --- fixed values -----------------------------------------------------------
# Word tokenizer: split on runs of anything that is not a Unicode letter.
TOKENIZER_PATTERN = r"[^\p{L}]+"
# Variant tokenizer seen in the committed word-count output (keeps apostrophes).
APOSTROPHE_WORD_PATTERN = r"[\p{L}']+"
# Default word filter of the debugging word count (full match).
DEFAULT_FILTER_PATTERN = "Flourish|stomach"
# Separator of formatted word counts: "<word>: <count>".
COUNT_SEPARATOR = ": "
# Windowed word count: window size in minutes.
WORD_WINDOW_MINUTES = 10
# Ride turnover: tumbling window of 1 minute, allowed lateness 5 minutes.
TURNOVER_WINDOW = "1 minute"
TURNOVER_LATENESS_MINUTES = 5
# Ride positions: session gap of 60 minutes, zero allowed lateness.
SESSION_GAP_MINUTES = 60
# Early-firing delays (processing time) of the two ride branches.
TURNOVER_EARLY_FIRING = "1 second"
SESSION_EARLY_FIRING = "2 seconds"
# Pane timing labels.
EARLY, ON_TIME, LATE = "EARLY", "ON_TIME", "LATE"
# Output file label per window "HH:mm-HH:mm" and day partition "yyyyMMdd" (UTC).
WINDOW_LABEL_FORMAT = "HH:mm"
DAY_PARTITION_FORMAT = "yyyyMMdd"
# Device-log document sections (all required) and the side that is one object.
DEVICE_LOG_ARRAY_SECTIONS = ("events", "monitors", "testsuites", "useractions", "campaign")
DEVICE_LOG_OBJECT_SECTION = "info"
# Device-log group names picked by the job.
TRANSFER_ACTION = "TestFileTransfer"
BATTERY_EVENT = "batteryLevelRemaining"
RAT_CHANGE_EVENT = "psRatChd"
# Device-log field names.
ACTION_ID_FIELD = "uniqTcId"
ACTION_NAME_FIELD = "name"
EVENT_NAME_FIELD = "name"
EVENT_TIME_FIELD = "tStampMs"
EVENT_END_FIELD = "tStampMsEnd"
# Early firings, in seconds of processing time after the first element.
TURNOVER_EARLY_SECONDS = 1
POSITIONS_EARLY_SECONDS = 2
# Ride sink table schema (all nullable).
RIDE_TABLE_DDL = (
    "ride_id string, latitude double, longitude double, timestamp timestamp, "
    "meter_reading double, meter_increment double, passenger_count bigint, ride_status string"
)
# Ride message fields (payload), read as text; event time comes from the attribute `ts`.
RIDE_MESSAGE_FIELDS = ("ride_id", "latitude", "longitude", "timestamp",
                       "meter_reading", "meter_increment", "ride_status", "passenger_count")
# --- end of fixed values ----------------------------------------------------
