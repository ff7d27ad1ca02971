"""Walk-forward evaluation of a least-squares model: all windows in one job.

Least squares needs only counts, means and co-moments of the columns. These are built per block
with Spark's own aggregates, merged over the blocks of a window, and solved as column
expressions; the test rows then meet the coefficients of their one window in an equi-join. No
group of rows is gathered anywhere, so a time unit that holds a third of all rows is harmless.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.constants import BATCH_SIZE, FEATURES, LABEL, WINDOW_SIZE
from tidegauge.operators.intervals import interval_join
from tidegauge.operators.windows import WindowGrid, error_by_window

# A feature whose variance, once the features before it are accounted for, falls to this share
# of what it was is a combination of them; it gets no weight.
DEPENDENT = 1e-10


def complete_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.dropna("any", subset=list(columns))


# Below, the features are v0 … v(p-1) and the label is vp. ``mean_i`` is the mean of vi and
# ``m_i_j`` the co-moment of vi and vj; of the label with itself none is needed.


def _pairs(first: int, p: int) -> list[tuple[int, int]]:
    return list(combinations_with_replacement(range(first, p + 1), 2))[:-1]


def _exprs(texts: Sequence[str]):
    return [F.expr(text) for text in texts]


def numbered(series: DataFrame, columns: Sequence[str]) -> DataFrame:
    values = [F.col(c).cast("double").alias(f"v{i}") for i, c in enumerate(columns)]
    rows = series.select("t", *values)
    return complete_rows(rows, rows.columns[1:])


def moments_by(rows: DataFrame, group: Column, p: int) -> DataFrame:
    """Row count, means and population covariances per group of time units."""
    statistics = [
        "count(*) AS n",
        *[f"avg(v{i}) AS mean_{i}" for i in range(p + 1)],
        *[f"covar_pop(v{i}, v{j}) AS m_{i}_{j}" for i, j in _pairs(0, p)],
    ]
    return rows.groupBy(group).agg(*_exprs(statistics))


def block_moments(rows: DataFrame, grid: WindowGrid, p: int) -> DataFrame:
    return moments_by(rows, grid.block().alias("block"), p)


def train_moments(blocks: DataFrame, grid: WindowGrid, p: int) -> DataFrame:
    return merged_moments(grid.place(blocks).filter("is_train"), p)


def merged_moments(placed: DataFrame, p: int) -> DataFrame:
    """The same statistics per window, over what is placed in it; ``own_i`` keeps a feature's variance.

    Co-moments are merged around the window's own means, which keeps their precision where a
    difference of raw sums would lose it. Both steps share one partitioning by ``t_end``.
    """
    in_window = Window.partitionBy("t_end")
    size = F.sum("n").over(in_window)
    centred = placed.withColumns({f"window_{i}": F.sum(F.expr(f"n * mean_{i}")).over(in_window) / size for i in range(p + 1)})

    def merged(i: int, j: int) -> str:
        return f"sum(n * (m_{i}_{j} + (mean_{i} - window_{i}) * (mean_{j} - window_{j})))"

    statistics = [
        *[f"first(window_{i}) AS mean_{i}" for i in range(p + 1)],
        *[f"{merged(i, j)} AS m_{i}_{j}" for i, j in _pairs(0, p)],
        *[f"{merged(i, i)} AS own_{i}" for i in range(p)],
    ]
    return centred.groupBy("t_end").agg(*_exprs(statistics))


def solve(moments: DataFrame, p: int) -> DataFrame:
    """Coefficients ``b_i`` and ``intercept`` per window by elimination, one feature a step."""

    def share(k: int, j: int) -> str:
        return f"if(m_{k}_{k} > {DEPENDENT} * own_{k}, m_{k}_{j} / m_{k}_{k}, 0D)"

    for k in range(p):
        reduced = {f"m_{i}_{j}": F.expr(f"m_{i}_{j} - {share(k, i)} * m_{k}_{j}") for i, j in _pairs(k + 1, p)}
        if reduced:
            moments = moments.withColumns(reduced)
    # The last feature's coefficient is known at once; each of the others follows from those after it.
    weights: dict[int, str] = {}
    for k in reversed(range(p)):
        explained = "".join(f" - {share(k, j)} * {weights[j]}" for j in range(k + 1, p))
        weights[k] = f"({share(k, p)}{explained})"
    weighted = moments.select(
        "t_end", *[f"mean_{i}" for i in range(p + 1)], *_exprs([f"{weights[k]} AS b_{k}" for k in range(p)])
    )
    fitted = "".join(f" - b_{k} * mean_{k}" for k in range(p))
    return weighted.selectExpr("t_end", *[f"b_{k}" for k in range(p)], f"mean_{p}{fitted} AS intercept")


def walk_forward_linear(
    series: DataFrame,
    features: Sequence[str] = FEATURES,
    label: str = LABEL,
    window_size: int = WINDOW_SIZE,
    batch_size: int = BATCH_SIZE,
) -> DataFrame:
    """``t_end``, ``mae`` and ``mean_pred`` of every valid window. Incomplete rows take no part."""
    p = len(features)
    grid = WindowGrid(series, window_size, batch_size)
    rows = numbered(series, [*features, label])
    models = solve(train_moments(block_moments(rows, grid, p), grid, p), p)
    tested = rows.filter(grid.is_tested()).withColumn("t_end", grid.tested_at())
    return _scored(tested, models, p)


def _scored(tested: DataFrame, models: DataFrame, p: int) -> DataFrame:
    prediction = "intercept" + "".join(f" + b_{k} * v{k}" for k in range(p))
    scored = tested.join(models, "t_end").selectExpr("t_end", f"v{p} AS label", f"{prediction} AS prediction")
    return error_by_window(scored, "label")


def walk_forward_linear_at(
    series: DataFrame, ends: DataFrame, features: Sequence[str] = FEATURES, label: str = LABEL
) -> DataFrame:
    """The same for any windows: ``ends(t_end, train_from, test_until)``, one row per ``t_end``, in no spacing or length.

    A window trains on ``[train_from, t_end)`` and tests on ``[t_end, test_until)``. Rows are reduced to one aggregate per time
    unit, which is what the windows they train get. ``ends`` is read several times: hand in a stored table.
    """
    p = len(features)
    rows = numbered(series, [*features, label])
    per_time = moments_by(rows, F.col("t"), p)
    trained = interval_join(per_time, ends.select("train_from", "t_end"), "t", "train_from", "t_end")
    models = solve(merged_moments(trained, p), p)
    tested = interval_join(rows, ends.select("t_end", "test_until"), "t", "t_end", "test_until")
    return _scored(tested, models, p)
