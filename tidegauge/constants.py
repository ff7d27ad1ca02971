"""Fixed values that results depend on."""

# Walk-forward evaluation.
WINDOW_SIZE = 100
BATCH_SIZE = 20
NUM_TREES = 10
MAX_DEPTH = 5
MAX_BINS = 32
FEATURES = ("requests", "size", "hour", "y_lag1")
LABEL = "y"
FOREST_SEED = 42

# Trend over the newest totals.
TREND_ROWS = 100
TREND_MIN_ROWS = 2

# Request-rate and target formulas.
DRIFT_PERIOD = 10000
RATE_BASE = 50
RATE_SWING = 20
RATE_FLOOR = 5
HOURS_PER_DAY = 24
TARGET_LAG = 0.5
TARGET_LOAD = 0.015
TARGET_DRIFT = 0.01
TARGET_POWER = 1.2
TARGET_SIZE = 0.15

# First lag of a series, and the key its last value is kept under.
LAG_SEED = 0.0
LAST_VALUE_KEY = "last_y"

# Retention in whole minutes (seven days).
RETENTION_MINUTES = 10080
