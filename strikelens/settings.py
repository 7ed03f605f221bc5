"""Default settings. Every one of them is a plain argument where it is used."""

# Results depend on them.
STRICT_THRESHOLD = 0.48  # a rule failing on a smaller share of rows is kept
LENIENT_THRESHOLD = 0.03
TOP_N = 5  # categories kept per year
OPEN_RANGE_MAX = 10_000  # upper bound of "Over n"
WINDOW = "12 seconds"  # tumbling window of the windowed totals
BATCH_ROWS = 1_000  # rows offered per producer tick
BATCH_TICK = "700 milliseconds"
STREAM_SALTS = 16  # tasks over which a stream with state spreads the rows of one code
REWRITE_TICK = "5 seconds"

# Where invalid rows go.
INVALID_SPECIES = "quarantine-species"
INVALID_QUANTITY = "quarantine-quantity"
INVALID_OTHER = "quarantine-other"
