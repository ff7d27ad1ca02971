"""Walk-forward windows over the hourly request log."""

from __future__ import annotations

from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.catalog.inputs import LOG_SQL, hourly_series, stored_features
from tidegauge.constants import FEATURES, FOREST_SEED, LABEL, MAX_BINS, MAX_DEPTH, NUM_TREES
from tidegauge.operators import windows
from tidegauge.plans.requests import request_features
from tidegauge.plans.walk_forward_forest import evaluate_forest, kept_models, store_series
from tidegauge.plans.walk_forward_forest_grouped import TARGET_STEPS, poisson_steps, walk_forward_forest_grouped
from tidegauge.plans.walk_forward_linear import walk_forward_linear, walk_forward_linear_at
from tidegauge.scratch import fresh_folder
from tidegauge.sinks import write_snapshot
from tidegauge.sources import scan_table


def window_membership(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.window_membership(hourly_series(spark, sf_dir))


def window_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which row trains or tests which window, as pairs."""
    series = hourly_series(spark, sf_dir)
    grid = windows.WindowGrid(series)
    placed = grid.place(series.select(grid.block().alias("block"), "t"))
    return placed.select("t_end", "t", "is_train")


def _uneven_ends(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The request log, and windows that end where its numbers of requests say, of lengths that they say."""
    log = scan_table(spark, stored_features(spark, sf_dir))
    first = log.agg(F.min("t")).first()[0]
    train_from = F.when(F.col("t") % 9 == 0, F.lit(first)).otherwise(F.col("t") - 24 - F.col("requests"))
    ends = log.filter("requests % 5 = 0").select(
        F.col("t").alias("t_end"), train_from.cast("bigint").alias("train_from"), (F.col("t") + 1 + F.col("requests") % 30).alias("test_until")
    )
    return log, scan_table(spark, write_snapshot(ends, fresh_folder(spark, "ends")))


def window_rows_any_ends(spark: SparkSession, sf_dir: str) -> DataFrame:
    log, ends = _uneven_ends(spark, sf_dir)
    return windows.window_rows_at(log.select("t"), ends)


def walk_forward_any_ends(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(walk_forward_linear_at(*_uneven_ends(spark, sf_dir), ["y_lag1"]))


def _rounded(metrics: DataFrame) -> DataFrame:
    return metrics.select(
        "t_end", F.round("mae", 4).alias("mae"), F.round("mean_pred", 4).alias("mean_pred")
    )


def walk_forward_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(walk_forward_linear(request_features(hourly_series(spark, sf_dir)), ["y_lag1"]))


def walk_forward_linear_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(walk_forward_linear(request_features(hourly_series(spark, sf_dir))))


def walk_forward_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is certain of ten trees whose draws only the library knows: the windows, and means within reach."""
    path = stored_features(spark, sf_dir)
    metrics = evaluate_forest(spark, path, fresh_folder(spark, "ml-performance"))
    reach = scan_table(spark, path).agg(F.min("y").alias("low"), F.max("y").alias("high"))
    low, high = reach.first()
    within = F.col("mean_pred").between(low, high) & (F.col("mae") >= 0) & (F.col("mae") <= high - low)
    return metrics.select("t_end", "n_train", "n_test", "complete", within.alias("within_range"))


def _stump() -> RandomForestRegressor:
    """One tree of one cut and no draws, which SQL can state exactly."""
    return RandomForestRegressor(numTrees=1, bootstrap=False, featureSubsetStrategy="all", maxBins=128, maxDepth=1, seed=FOREST_SEED)


def walk_forward_stump(spark: SparkSession, sf_dir: str) -> DataFrame:
    metrics = evaluate_forest(spark, stored_features(spark, sf_dir), fresh_folder(spark, "ml-performance"), forest=_stump())
    return _rounded(metrics)


def _kept_stumps(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """The stored request log, and models of its first half, fitted and kept."""
    log, models = stored_features(spark, sf_dir), fresh_folder(spark, "models")
    series = scan_table(spark, log)
    middle = series.agg(F.expr("(min(t) + max(t)) div 2")).first()[0]
    half = store_series(series.filter(F.col("t") < middle), fresh_folder(spark, "half"))
    evaluate_forest(spark, half, fresh_folder(spark, "ml-performance"), forest=_stump(), models=models)
    return log, models


def stump_models_reused(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole log evaluated anew: windows of its first half are scored by kept models, the others fitted."""
    log, models = _kept_stumps(spark, sf_dir)
    return _rounded(evaluate_forest(spark, log, fresh_folder(spark, "ml-performance"), forest=_stump(), models=models))


def stump_models_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions for the whole log by models of its first half: each row by the last window that ends before it."""
    log, models = _kept_stumps(spark, sf_dir)
    scored = kept_models(spark, models, forest=_stump()).scored(scan_table(spark, log), FEATURES)
    return scored.select("t", "t_end", F.round("prediction", 4).alias("prediction"))


def stump_rescored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores after some targets were corrected: no window's number of rows has changed."""
    log, metrics = stored_features(spark, sf_dir), fresh_folder(spark, "ml-performance")
    evaluate_forest(spark, log, metrics, forest=_stump())
    corrected = scan_table(spark, log).withColumn("y", F.when(F.col("t") % 50 == 0, F.col("y") + 100).otherwise(F.col("y")))
    corrected = store_series(corrected, fresh_folder(spark, "corrected"))
    return _rounded(evaluate_forest(spark, corrected, metrics, forest=_stump()))


def walk_forward_forest_grouped_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(walk_forward_forest_grouped(scan_table(spark, stored_features(spark, sf_dir))))


QUERIES = {
    "window_membership": window_membership,
    "window_rows": window_rows,
    "window_rows_any_ends": window_rows_any_ends,
    "walk_forward_any_ends": walk_forward_any_ends,
    "walk_forward_trend": walk_forward_trend,
    "walk_forward_linear": walk_forward_linear_query,
    "walk_forward_forest": walk_forward_forest,
    "walk_forward_stump": walk_forward_stump,
    "stump_models_reused": stump_models_reused,
    "stump_models_scored": stump_models_scored,
    "stump_rescored": stump_rescored,
    "walk_forward_forest_grouped": walk_forward_forest_grouped_query,
}

_ENDS_SQL = f"""{LOG_SQL},
ends AS (
    SELECT unnest(range(s + 100, e, 20)) AS t_end FROM (SELECT min(t) AS s, max(t) AS e FROM log)
)"""


_UNEVEN_SQL = f"""{LOG_SQL},
ends AS (
    SELECT t AS t_end, CASE WHEN t % 9 = 0 THEN (SELECT min(t) FROM log) ELSE t - 24 - requests END AS train_from,
           t + 1 + requests % 30 AS test_until
    FROM log WHERE requests % 5 = 0
)"""


def _linear_sql(features: tuple[str, ...], label: str) -> str:
    """Least squares by successive orthogonalisation: every step removes one feature's share from
    the features after it and from the target, which leaves the prediction error in the end."""
    columns = [*features, label]
    centred = ", ".join(
        f"CAST({c} AS DOUBLE) - avg(CAST({c} AS DOUBLE)) FILTER (WHERE NOT is_test) OVER (PARTITION BY t_end) AS r_{c}"
        for c in columns
    )
    steps = [
        f"""placed AS (
    SELECT t_end, t >= t_end AS is_test, log.* EXCLUDE ("timestamp")
    FROM ends JOIN log ON t >= t_end - 100 AND t < t_end + 20
),
step_0 AS (SELECT t_end, is_test, y AS actual, {centred} FROM placed)"""
    ]
    for k, f in enumerate(features):
        rest = columns[k + 1 :]
        slopes = ", ".join(f"sum(r_{c} * r_{f}) / nullif(sum(r_{f} * r_{f}), 0) AS b_{c}" for c in rest)
        residuals = ", ".join(f"r_{c} - coalesce(b_{c}, 0) * r_{f} AS r_{c}" for c in rest)
        steps.append(
            f"""slopes_{k} AS (SELECT t_end, {slopes} FROM step_{k} WHERE NOT is_test GROUP BY t_end),
step_{k + 1} AS (SELECT t_end, is_test, actual, {residuals} FROM step_{k} JOIN slopes_{k} USING (t_end))"""
        )
    body = ",\n".join(steps)
    last = f"step_{len(features)}"
    return f"""WITH {_ENDS_SQL},
{body}
SELECT t_end, round(avg(abs(r_{label})), 4) AS mae, round(avg(actual - r_{label}), 4) AS mean_pred
FROM {last} WHERE is_test GROUP BY t_end"""


def _forest_sql(features: tuple[str, ...], label: str) -> str:
    """The grouped forest with rows, bins and nodes as plain tables, one set of them per level."""
    tried = -(-len(features) // 3)
    quantiles = [k / MAX_BINS for k in range(1, MAX_BINS)]
    cuts = ", ".join(f"quantile_disc({f}, {quantiles}) AS cuts_{f}" for f in features)
    long = "\n    UNION ALL ".join(
        f"SELECT t_end, t, is_train, {i} AS feature, len(list_filter(cuts_{f}, lambda c: c < {f})) AS bin "
        f"FROM placed JOIN cuts USING (t_end)"
        for i, f in enumerate(features)
    )
    steps = " + ".join(f"(u >= {step!r}::DOUBLE)::BIGINT" for step in poisson_steps())
    hashed = f"substr(md5(concat_ws(':', {FOREST_SEED}, t_end, tree, t, nth)), 1, 8)"
    parts = [
        f"""placed AS MATERIALIZED (
    SELECT t_end, t < t_end AS is_train, log.* EXCLUDE ("timestamp"),
           row_number() OVER (PARTITION BY t_end, t ORDER BY {", ".join((*features, label))}) - 1 AS nth
    FROM ends JOIN log ON t >= t_end - 100 AND t < t_end + 20
),
cuts AS MATERIALIZED (
    SELECT t_end, min({label}) AS low, (max({label}) - min({label})) / {TARGET_STEPS} AS step, {cuts}
    FROM placed WHERE is_train GROUP BY t_end
),
bins AS MATERIALIZED (
    {long}
),
drawn AS (
    SELECT t_end, t, tree, is_train, {label} AS actual,
           CASE WHEN is_train THEN {steps} ELSE 0 END AS w
    FROM (SELECT *, CAST('0x' || {hashed} AS BIGINT) / 4294967296 AS u
          FROM placed, (SELECT unnest(range({NUM_TREES})) AS tree))
),
nodes_0 AS MATERIALIZED (
    SELECT t_end, t, tree, is_train, actual, w, 1 AS node,
           w * CAST(CASE WHEN step > 0 AND is_train THEN round_even((actual - low) / step, 0) ELSE 0 END AS BIGINT) AS s
    FROM drawn JOIN cuts USING (t_end) WHERE w > 0 OR NOT is_train
)"""
    ]
    for level in range(MAX_DEPTH):
        parts.append(
            f"""sums_{level} AS (
    SELECT t_end, tree, node, feature, bin, sum(w) AS w, sum(s) AS s
    FROM nodes_{level} JOIN bins USING (t_end, t) WHERE nodes_{level}.is_train AND node >= {2**level}
    GROUP BY ALL
),
cumulated_{level} AS (
    SELECT t_end, tree, node, feature, bin,
           CAST(sum(w) OVER up_to_bin AS DOUBLE) AS lw, CAST(sum(s) OVER up_to_bin AS DOUBLE) AS ls,
           CAST(sum(w) OVER of_feature AS DOUBLE) AS tw, CAST(sum(s) OVER of_feature AS DOUBLE) AS ts
    FROM sums_{level}
    WINDOW of_feature AS (PARTITION BY t_end, tree, node, feature),
           up_to_bin AS (PARTITION BY t_end, tree, node, feature ORDER BY bin)
),
gains_{level} AS (
    SELECT *, CASE WHEN lw < tw
                   THEN ls * ls / lw + (ts - ls) * (ts - ls) / (tw - lw) - ts * ts / tw ELSE 0 END AS gain
    FROM cumulated_{level}
),
candidates_{level} AS (
    SELECT *, row_number() OVER (PARTITION BY t_end, tree, node
                                 ORDER BY md5(concat_ws(':', {FOREST_SEED}, t_end, tree, node, feature))) AS draw
    FROM (SELECT * FROM gains_{level}
          QUALIFY row_number() OVER (PARTITION BY t_end, tree, node, feature ORDER BY gain DESC, bin) = 1)
),
splits_{level} AS MATERIALIZED (
    SELECT t_end, tree, node, feature, bin
    FROM (SELECT * FROM candidates_{level} WHERE draw <= {tried})
    QUALIFY row_number() OVER (PARTITION BY t_end, tree, node ORDER BY gain DESC, feature) = 1 AND gain > 0
),
nodes_{level + 1} AS MATERIALIZED (
    SELECT n.t_end, n.t, n.tree, n.is_train, n.actual, n.w, n.s,
           CASE WHEN s.feature IS NULL THEN n.node ELSE 2 * n.node + (b.bin > s.bin)::INTEGER END AS node
    FROM nodes_{level} n
    LEFT JOIN splits_{level} s ON s.t_end = n.t_end AND s.tree = n.tree AND s.node = n.node
    LEFT JOIN bins b ON b.t_end = n.t_end AND b.t = n.t AND b.feature = s.feature
)"""
        )
    body = ",\n".join(parts)
    last = f"nodes_{MAX_DEPTH}"
    return f"""WITH {_ENDS_SQL},
{body},
leaves AS (
    SELECT t_end, tree, node, any_value(low) + CAST(sum(s) AS DOUBLE) / sum(w) * any_value(step) AS mean
    FROM {last} JOIN cuts USING (t_end) WHERE is_train GROUP BY ALL
),
predicted AS (
    SELECT t_end, t, any_value(actual) AS actual, avg(mean) AS prediction
    FROM {last} JOIN leaves USING (t_end, tree, node) WHERE NOT is_train GROUP BY t_end, t
)
SELECT t_end, round(avg(abs(actual - prediction)), 4) AS mae, round(avg(prediction), 4) AS mean_pred
FROM predicted GROUP BY t_end"""


def _stump_cuts(features: tuple[str, ...], label: str, ends: str, log: str = "log") -> str:
    """Of all midpoints of neighbouring values the cut that leaves the least variance; the mean on either side."""
    long = " UNION ALL ".join(f"SELECT t_end, {i} AS feature, CAST({f} AS DOUBLE) AS x, {label} AS target FROM train" for i, f in enumerate(features))
    return f"""WITH {ends},
train AS (SELECT t_end, log.* EXCLUDE ("timestamp") FROM ends JOIN {log} AS log ON t >= t_end - 100 AND t < t_end),
points AS ({long}),
valued AS (SELECT t_end, feature, x, count(*) AS n, sum(target) AS s FROM points GROUP BY ALL),
cumulated AS (
    SELECT t_end, feature, x, lead(x) OVER up AS next_x, sum(n) OVER up AS ln, sum(s) OVER up AS ls,
           sum(n) OVER (PARTITION BY t_end, feature) AS tn, sum(s) OVER (PARTITION BY t_end, feature) AS ts
    FROM valued WINDOW up AS (PARTITION BY t_end, feature ORDER BY x)
),
cuts AS (
    SELECT *, (x + next_x) / 2 AS cut, ls / ln AS low_mean, (ts - ls) / (tn - ln) AS high_mean
    FROM cumulated WHERE next_x IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY t_end ORDER BY ls * ls / ln + (ts - ls) * (ts - ls) / (tn - ln) DESC, feature, x) = 1
)"""


def _stump_prediction(features: tuple[str, ...]) -> str:
    value = "CASE feature " + " ".join(f"WHEN {i} THEN {f}" for i, f in enumerate(features)) + " END"
    return f"CASE WHEN {value} <= cut THEN low_mean ELSE high_mean END AS prediction"


def _stump_sql(features: tuple[str, ...], label: str, ends: str = _ENDS_SQL, log: str = "log") -> str:
    return f"""{_stump_cuts(features, label, ends, log)},
scored AS (
    SELECT t_end, {label} AS actual, {_stump_prediction(features)}
    FROM cuts JOIN {log} ON t >= t_end AND t < t_end + 20
)
SELECT t_end, round(avg(abs(actual - prediction)), 4) AS mae, round(avg(prediction), 4) AS mean_pred
FROM scored GROUP BY t_end"""


_HALF_ENDS_SQL = f"""{LOG_SQL},
ends AS (
    SELECT unnest(range(s + 100, e, 20)) AS t_end
    FROM (SELECT min(t) AS s, max(t) FILTER (WHERE t < (SELECT (min(t) + max(t)) // 2 FROM log)) AS e FROM log)
)"""

_CORRECTED_SQL = f"""{_ENDS_SQL},
corrected AS (SELECT * REPLACE (CASE WHEN t % 50 = 0 THEN y + 100 ELSE y END AS y) FROM log)"""


_MEMBERSHIP = """SELECT t_end,
       count(*) FILTER (WHERE t < t_end) AS n_train,
       count(*) FILTER (WHERE t >= t_end) AS n_test,
       t_end + 20 <= (SELECT max(t) + 1 FROM log) AS complete{more}
FROM ends JOIN log ON t >= t_end - 100 AND t < t_end + 20
GROUP BY t_end
HAVING count(*) FILTER (WHERE t < t_end) > 0 AND count(*) FILTER (WHERE t >= t_end) > 0"""

ORACLES = {
    "walk_forward_stump": _stump_sql(FEATURES, LABEL),
    "stump_models_reused": _stump_sql(FEATURES, LABEL),
    "stump_models_scored": f"""{_stump_cuts(FEATURES, LABEL, _HALF_ENDS_SQL)}
SELECT t, t_end, round(prediction, 4) AS prediction
FROM (SELECT t, t_end, {_stump_prediction(FEATURES)} FROM log ASOF JOIN cuts ON t >= t_end)""",
    "stump_rescored": _stump_sql(FEATURES, LABEL, _CORRECTED_SQL, "corrected"),
    "walk_forward_forest": f"WITH {_ENDS_SQL}\n" + _MEMBERSHIP.format(more=",\n       true AS within_range"),
    "window_membership": f"""WITH {_ENDS_SQL}
SELECT t_end,
       count(*) FILTER (WHERE t < t_end) AS n_train,
       count(*) FILTER (WHERE t >= t_end) AS n_test,
       t_end + 20 <= (SELECT max(t) + 1 FROM log) AS complete
FROM ends JOIN log ON t >= t_end - 100 AND t < t_end + 20
GROUP BY t_end
HAVING count(*) FILTER (WHERE t < t_end) > 0 AND count(*) FILTER (WHERE t >= t_end) > 0""",
    "window_rows": f"""WITH {_ENDS_SQL}
SELECT t_end, t, t < t_end AS is_train FROM ends JOIN log ON t >= t_end - 100 AND t < t_end + 20""",
    "window_rows_any_ends": f"""WITH {_UNEVEN_SQL}
SELECT t_end, t, t < t_end AS is_train FROM ends JOIN log ON t >= train_from AND t < test_until""",
    "walk_forward_any_ends": f"""WITH {_UNEVEN_SQL},
models AS (
    SELECT t_end, test_until, CASE WHEN max(y_lag1) > min(y_lag1) THEN regr_slope(y, y_lag1) ELSE 0 END AS slope,
           CASE WHEN max(y_lag1) > min(y_lag1) THEN regr_intercept(y, y_lag1) ELSE avg(y) END AS intercept
    FROM ends JOIN log ON t >= train_from AND t < t_end GROUP BY t_end, test_until
)
SELECT t_end, round(avg(abs(y - (slope * y_lag1 + intercept))), 4) AS mae,
       round(avg(slope * y_lag1 + intercept), 4) AS mean_pred
FROM models JOIN log ON t >= t_end AND t < test_until GROUP BY t_end""",
    "walk_forward_trend": f"""WITH {_ENDS_SQL},
models AS (
    SELECT t_end, regr_slope(y, y_lag1) AS slope, regr_intercept(y, y_lag1) AS intercept
    FROM ends JOIN log ON t >= t_end - 100 AND t < t_end GROUP BY t_end
)
SELECT t_end, round(avg(abs(y - (slope * y_lag1 + intercept))), 4) AS mae,
       round(avg(slope * y_lag1 + intercept), 4) AS mean_pred
FROM models JOIN log ON t >= t_end AND t < t_end + 20 GROUP BY t_end""",
    "walk_forward_linear": _linear_sql(FEATURES, LABEL),
    "walk_forward_forest_grouped": _forest_sql(FEATURES, LABEL),
}
