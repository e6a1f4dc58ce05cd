"""tidewater: Spark-native text, event-stream and device-log analytics operators."""

__version__ = "0.1.0"
