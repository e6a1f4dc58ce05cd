"""Word-count lines, the filter line, and their expected results."""

WORD_LINES = ["hi there", "hi", "hi sue bob", "hi sue", "", "bob hi"]
WORD_COUNTS = ["bob: 2", "hi: 5", "sue: 2", "there: 1"]
FILTER_LINE = "stomach secret Flourish message Flourish here Flourish"
FILTER_COUNTS = [("Flourish", 3), ("stomach", 1)]
