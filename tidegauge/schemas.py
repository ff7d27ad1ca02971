"""One named schema per record type, as DDL text.

Input records (``SALES``, ``REQUEST_LOG``) have one directory each; a directory
never mixes record types, because a reader would turn foreign fields into nulls.
"""

SALES = "item STRING, amount DOUBLE, ts BIGINT"

REQUEST_LOG = (
    "timestamp STRING, t BIGINT, hour INT, requests BIGINT, "
    "size DOUBLE, y DOUBLE, y_lag1 DOUBLE, drift_factor DOUBLE"
)

SALES_STATS = "item STRING, total_amount DOUBLE, processed_at TIMESTAMP"

# Stored form of REQUEST_LOG: the lag is dropped, the hour narrowed.
REQUEST_LOGS = (
    "timestamp TIMESTAMP_NTZ, t BIGINT, hour TINYINT, requests BIGINT, "
    "size DOUBLE, y DOUBLE, drift_factor DOUBLE, processed_at TIMESTAMP"
)

# How many rows the window had when it was scored, whether its test part was full, checksums of the rows, and the
# time from which the ends of its evaluation are counted.
ML_PERFORMANCE = (
    "t_end BIGINT, n_train BIGINT, n_test BIGINT, complete BOOLEAN, train_sum BIGINT, test_sum BIGINT, "
    "mae DOUBLE, mean_pred DOUBLE, origin BIGINT, processed_at TIMESTAMP"
)

# Where the model of a window lies, and the rows it was fitted on.
MODEL_INDEX = "t_end BIGINT, n_train BIGINT, train_sum BIGINT, forest STRING, model STRING"

MODEL_RESULTS = "coeff DOUBLE, intercept DOUBLE, updated_at TIMESTAMP"

WORD_COUNT = "word STRING, count BIGINT"

def field_names(schema: str) -> list[str]:
    return [field.split()[0] for field in schema.split(",")]


METADATA = "key STRING, value DOUBLE, updated_at TIMESTAMP_NTZ"
