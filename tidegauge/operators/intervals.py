"""Which points lie in which intervals: a range join that is an equi-join on bins.

Time is cut into bins of several widths, each ``FANOUT`` times the one before. An interval goes to the narrowest
width at which it meets at most ``FANOUT + 1`` bins, so a long one is split into a few wide bins and never into
very many narrow ones. A point goes to its one bin of each width that intervals use. Pairs of a bin
are found by hash or sort, and an exact test of the bounds leaves those that meet. Every pair comes up once, as an
interval has one width and a point one bin of it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.functions import floor_div

#: A width's bins in one bin of the next width.
FANOUT = 16
_WIDTH, _BIN = "_width", "_bin"


def widths(narrowest: int) -> list[int]:
    """All widths in the range of BIGINT, which has at most ``2 * FANOUT`` bins of the widest."""
    out = [narrowest]
    while out[-1] * FANOUT < 1 << 63:
        out.append(out[-1] * FANOUT)
    return out


def _bin_of(point: Column, places: list[int]) -> Column:
    """The point's bin at the width of that place."""
    return reduce(lambda rest, w: F.when(F.col(_WIDTH) == w, floor_div(point, w)).otherwise(rest), places, F.lit(None).cast("bigint"))


def in_bins(intervals: DataFrame, low: str, high: str, narrowest: int) -> DataFrame:
    """Intervals with a row for each of their bins. Those that are empty or lack a bound have none."""
    places = widths(narrowest)
    # Of whole numbers, whose difference may pass the range of BIGINT.
    length = F.col(high).cast("decimal(20,0)") - F.col(low).cast("decimal(20,0)")
    width = reduce(lambda rest, w: F.when(length <= w * FANOUT, w).otherwise(rest), reversed(places[:-1]), F.lit(places[-1]).cast("bigint"))
    sized = intervals.filter(F.col(low) < F.col(high)).withColumn(_WIDTH, width.cast("bigint"))
    bins = F.sequence(_bin_of(F.col(low), places), _bin_of(F.col(high) - 1, places))
    return sized.withColumn(_BIN, F.explode(bins))


def interval_join(
    points: DataFrame, intervals: DataFrame, point: str, low: str, high: str, *, narrowest: int | None = None
) -> DataFrame:
    """All pairs of a point and an interval with ``low <= point < high``, with the columns of both.

    Points and bounds are whole numbers, such as epoch units. The names of the columns must differ. Intervals may be of any
    length, overlap, repeat and end anywhere; empty ones, null bounds and null points pair with nothing. ``narrowest`` is the
    width of the narrowest bins, by default a typical length of the intervals. ``intervals`` is read up to three times: hand in
    a stored table, or one that is cheap to make.
    """
    if narrowest is None:
        length = F.when(F.col(low) < F.col(high), (F.col(high).cast("double") - F.col(low).cast("double")) / 4)
        typical = intervals.agg(F.percentile_approx(length, 0.5, 1000)).first()[0]
        narrowest = min(max(int(typical or 1), 1), 1 << 40)
    binned = in_bins(intervals, low, high, narrowest)
    # At most sixteen numbers, of sixteen widths.
    used = sorted(row[0] for row in binned.select(_WIDTH).distinct().collect())
    placed = points.filter(F.col(point).isNotNull()).withColumn(_WIDTH, F.explode(F.array(*(F.lit(w).cast("bigint") for w in used or [narrowest]))))
    placed = placed.withColumn(_BIN, _bin_of(F.col(point), used or [narrowest]))
    pairs = placed.join(binned, [_WIDTH, _BIN])
    return pairs.filter((F.col(point) >= F.col(low)) & (F.col(point) < F.col(high))).select(*points.columns, *intervals.columns)
