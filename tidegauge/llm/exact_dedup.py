"""Exact duplicates by content sort, in DataFrame operations only.

Texts are normalised and dealt out by range: Spark samples splitters over the first bytes and a hash of the whole
text. The splitters hold bounded keys, never whole texts. Each range is sorted externally by the same
keys and then by the full normalised text, so equal texts are neighbours, and the window compares neighbours
in full. All copies of a text lie in one stretch, and the stretch decides.

Only a text that more rows have than a range should hold, of which there are fewer than ranges, is cut: its rows are
dealt out in lots drawn from the id, one stretch in each range. The heads of these stretches, one row each, are then
compared with each other by their full texts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidegauge.llm.store import stored

#: Characters at the start of a text that splitters look at.
HEAD = 16


def normalised(text) -> F.Column:
    """Each run of space, tab and line separators becomes one space; null becomes empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[ \t\n\x0B\f\r]+", " ")


def lots_of(docs: DataFrame) -> int:
    """Into how many lots a hot text's rows are dealt: the number of ranges."""
    return int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def hashed(docs: DataFrame, carried: list[str]) -> DataFrame:
    """Rows with their normalised text, its head and hash; columns to be carried along get other names."""
    own = [F.col(f"`{c}`").alias(f"own_{c}") for c in carried]
    rows = docs.select(*own, "doc_id", normalised(F.col("text")).alias("norm"))
    return rows.select("*", F.substring("norm", 1, HEAD).alias("head"), F.xxhash64("norm").alias("hash"))


def hot_hashes(docs: DataFrame) -> list[int]:
    """Hashes that more rows have than one of equal ranges holds: they are fewer than the ranges."""
    most = docs.count() / lots_of(docs)
    counts = hashed(docs, []).groupBy("hash").agg(F.count(F.lit(1)).alias("n"))
    return sorted(row["hash"] for row in counts.where(F.col("n") > max(most, 1)).select("hash").collect())


def normalised_rows(docs: DataFrame, carried: list[str], hot: Sequence[int] = ()) -> DataFrame:
    """Rows with what they are dealt out by: their head, hash and, where there are hot hashes, a lot, which is 0 for other rows."""
    rows = hashed(docs, carried)
    if not hot:
        return rows.withColumn("hot", F.lit(False))
    rows = rows.withColumn("hot", F.col("hash").isin(list(hot)))
    lot = F.when(F.col("hot"), F.pmod(F.xxhash64("doc_id"), F.lit(lots_of(docs)))).otherwise(0)
    return rows.withColumn("lot", lot.cast("int"))


def stretches(rows: DataFrame, carried: list[str]) -> DataFrame:
    """Each row's place, and the smallest id and size, in its stretch of equal texts.

    The window asks for rows together that agree on all its keys. Ranges of those but the text give that,
    so the texts are not shuffled again. A stretch is named by its first row; the first row of one under a hot hash
    keeps the text.
    """
    keys = ["head", "hash", *(c for c in ("lot",) if c in rows.columns)]
    stretch = Window.partitionBy(*keys, "norm")
    dealt = rows.repartitionByRange(*keys).withColumn("row", F.monotonically_increasing_id())
    seen = dealt.select(
        *(f"own_{c}" for c in carried),
        "doc_id",
        "hot",
        "norm",
        F.row_number().over(stretch.orderBy(F.col("doc_id").asc_nulls_last())).alias("place"),
        F.min("row").over(stretch).alias("stretch"),
        F.min("doc_id").over(stretch).alias("least"),
        F.count(F.lit(1)).over(stretch).alias("size"),
    )
    kept = F.when(F.col("hot") & (F.col("place") == 1), F.col("norm"))
    return seen.withColumn("digest", F.unhex(F.sha2("norm", 256))).withColumn("norm", kept)


def _sorted_out(docs: DataFrame, carried: list[str]) -> tuple[DataFrame, DataFrame]:
    """Every row with its place in its stretch of equal texts, stored; and the group of each stretch under a hot hash."""
    seen = stretches(normalised_rows(docs, carried, hot_hashes(docs)), carried)
    # With whole rows only the first of a stretch can stay.
    seen = stored(seen.where("place = 1") if carried else seen, "texts")
    heads = seen.where("hot AND place = 1").select("stretch", "norm", "least", "size")
    groups = heads.groupBy("norm").agg(
        F.min(F.struct(F.col("least").isNull().alias("none"), "least", "stretch")).alias("first"), F.sum("size").alias("group_size")
    )
    return seen, heads.select("stretch", "norm").join(groups, "norm").drop("norm")


def exact_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``keep_id``, ``group_size``, ``kept``, ``text_sha256`` for every row of ``docs(doc_id, text)``.

    ``kept`` holds for exactly one row of each group, one with the smallest id. Null, empty and
    all-white texts are texts like others. A null id counts as larger than any other; a group of
    such rows alone has no ``keep_id`` and keeps one row. Of rows with equal id and text one is
    kept. Other columns are not read. An empty table gives an empty result.
    """
    seen, groups = _sorted_out(docs, [])
    digest = F.lower(F.hex("digest")).alias("text_sha256")
    first = F.col("place") == 1
    settled = seen.where("NOT hot").select("doc_id", F.col("least").alias("keep_id"), F.col("size").alias("group_size"), first.alias("kept"), digest)
    merged = seen.where("hot").join(groups, "stretch").select(
        "doc_id", F.col("first.least").alias("keep_id"), "group_size", ((F.col("first.stretch") == F.col("stretch")) & first).alias("kept"), digest
    )
    return settled.unionByName(merged)


def first_of_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that `exact_duplicates` keeps, with all their columns.

    The rows are sorted whole, so one row of each group is left even where ids repeat or are null.
    """
    seen, groups = _sorted_out(docs, docs.columns)
    stay = groups.where("first.stretch = stretch").select("stretch")
    left = seen.where("NOT hot").unionByName(seen.where("hot").join(stay, "stretch", "left_semi"))
    return left.select(*(F.col(f"own_{c}").alias(c) for c in docs.columns))


SQL = r"""
WITH texts AS (
    SELECT doc_id, regexp_replace(coalesce(text, ''), '[ \t\n\x0B\f\r]+', ' ', 'g') AS norm FROM documents
)
SELECT doc_id,
       min(doc_id) OVER (PARTITION BY norm) AS keep_id,
       count(*) OVER (PARTITION BY norm) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY norm) AS kept,
       sha256(norm) AS text_sha256
FROM texts
"""
