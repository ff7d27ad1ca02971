"""How document filters interact: what each removes in every order of application, by higher-order SQL folds.

A document is reduced to its digest, its part and a mask of the filters it fails; documents of one mask
and part form a cell, of which a part has at most ``2**5``. In every cell a fold runs over each
of the 120 orders: ``transform`` goes through the literal array of orders, ``aggregate`` through the steps
of one, and gives one struct of counts a step, weighted by the documents of the cell. The 600 structs of the cells
of a part are merged by elementwise sums.

Filter E looks at the whole table: a text fails if a smaller id has the same one. Rows of equal texts are
counted by digest, part and labels before and after they are shuffled; only the row with the
smallest id of each digest is set apart. A group of any number of copies is therefore a few rows a task.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

FILTERS = "ABCDE"
ORDERS = ["".join(p) for p in permutations(FILTERS)]
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")
LEAST_WORDS = 50
#: Least percentage of distinct words, largest percentage of capital letters.
DISTINCT, CAPITALS = 65, 5
_WHITE = r"[ \t\n\x0B\f\r]+"
_CAPITAL = "[A-Z]"
_MARKS = r"[#$%&*|]"

_STRUCT = "struct<" + ",".join(f"{c}:bigint" for c in COUNTS) + ">"


def _bit(place: int, fails: Column) -> Column:
    return F.when(fails, F.lit(1 << place)).otherwise(F.lit(0))


def judged(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``part``, ``digest`` of the text, and ``mask``: the bits of filters A to D that it fails."""
    text = F.coalesce(docs["text"], F.lit(""))
    rows = docs.select(docs["doc_id"], F.coalesce(docs["source"], F.lit("")).alias("part"), text.alias("text"), F.array_remove(F.split(text, _WHITE), "").alias("words"))
    words = F.size("words").cast("long")
    capitals = F.length("text") - F.length(F.regexp_replace("text", _CAPITAL, ""))
    fails = [
        words < LEAST_WORDS,
        100 * F.size(F.array_distinct("words")).cast("long") < DISTINCT * words,
        100 * capitals.cast("long") > CAPITALS * F.length("text").cast("long"),
        F.col("text").rlike(_MARKS),
    ]
    return rows.select("doc_id", "part", F.unhex(F.sha2("text", 256)).alias("digest"), sum((_bit(i, f) for i, f in enumerate(fails)), F.lit(0)).alias("mask"))


def cells(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``part``, ``mask`` of all five filters, and how many documents have them: ``n``, of which ``good`` and ``toxic``."""
    known = labels.where("doc_id is not null").groupBy("doc_id").agg(F.max((F.col("quality") == 1).cast("long")).alias("good"), F.max((F.col("toxic") == 1).cast("long")).alias("toxic"))
    # Rows without an id match no label; a lot from their digest keeps them from meeting in one task.
    lot = F.when(F.col("doc_id").isNull(), F.hash("digest")).otherwise(F.lit(0))
    rows = judged(docs).withColumn("lot", lot).join(known.withColumn("lot", F.lit(0)), ["doc_id", "lot"], "left")
    rows = rows.select("doc_id", "lot", "digest", "mask", "part", *(F.coalesce(c, F.lit(0)).alias(c) for c in ("good", "toxic")))
    kind = ["digest", "mask", "part", "good", "toxic"]
    rows = rows.groupBy("doc_id", "lot", *kind).agg(F.count(F.lit(1)).alias("n"))
    # One row for each digest, part and labels: all its rows, those without an id, those with the smallest id.
    known_id = F.col("doc_id").isNotNull()
    groups = rows.groupBy(*kind).agg(F.sum("n").alias("n"), F.sum(F.when(~known_id, F.col("n")).otherwise(0)).alias("nameless"), F.min(F.when(known_id, F.struct("doc_id", "n"))).alias("first"))
    groups = groups.groupBy("digest", "mask").agg(F.min("first.doc_id").alias("least"), F.collect_list(F.struct("part", "good", "toxic", "n", "nameless", "first")).alias("of"))
    groups = groups.select("mask", "least", F.explode("of").alias("g")).select("mask", "least", "g.*")
    firsts = F.col("nameless") + F.when(F.col("first.doc_id") == F.col("least"), F.col("first.n")).otherwise(0)
    sides = F.array(F.struct(F.col("mask"), firsts.alias("n")), F.struct(F.col("mask").bitwiseOR(F.lit(1 << 4)).alias("mask"), (F.col("n") - firsts).alias("n")))
    sides = groups.select("part", "good", "toxic", F.explode(sides).alias("side")).select("part", "good", "toxic", "side.*")
    return sides.groupBy("part", "mask").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("good")).alias("good"), F.sum(F.col("n") * F.col("toxic")).alias("toxic"))


def _letter_bit(letter: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1), F.instr(F.lit(FILTERS), letter) - 1)


def folded(cell: Column, orders: Column) -> Column:
    """For one cell: a struct of counts for each order and step."""

    def through(order: Column) -> Column:
        def step(so_far: Column, place: Column) -> Column:
            bit = _letter_bit(F.substring(order, place, F.lit(1)))
            fails, here = cell["mask"].bitwiseAND(bit) != 0, cell["mask"].bitwiseAND(so_far["before"]) == 0
            counts = {
                "kept": (here & ~fails, "n"),
                "removed": (here & fails, "n"),
                "redundant": (~here & fails, "n"),
                "unique_fails": (cell["mask"] == bit, "n"),
                "good_lost": (here & fails, "good"),
                "toxic_lost": (here & fails, "toxic"),
            }
            counted = F.struct(*(F.when(holds, cell[weight]).otherwise(F.lit(0)).cast("long").alias(c) for c, (holds, weight) in counts.items()))
            return F.struct(so_far["before"].bitwiseOR(bit).alias("before"), F.concat(so_far["steps"], F.array(counted)).alias("steps"))

        start = F.struct(F.lit(0).alias("before"), F.array().cast(f"array<{_STRUCT}>").alias("steps"))
        return F.aggregate(F.sequence(F.lit(1), F.lit(len(FILTERS))), start, step, lambda done: done["steps"])

    return F.flatten(F.transform(orders, through))


def _added(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: F.struct(*((x[c] + y[c]).alias(c) for c in COUNTS)))


def interactions(counted: DataFrame) -> DataFrame:
    """The audit of `filter_audit` from ``cells`` (``part``, ``mask``, ``n``, ``good``, ``toxic``), of which a part has few."""
    orders = F.split(F.lit(" ".join(ORDERS)), " ")
    zeros = F.array_repeat(F.struct(*(F.lit(0).cast("long").alias(c) for c in COUNTS)), len(ORDERS) * len(FILTERS))
    parts = counted.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))
    merged = F.aggregate("cells", zeros, lambda sums, cell: _added(sums, folded(cell, orders)))
    rows = parts.select("part", F.posexplode(merged).alias("at", "counts"))
    order, step = F.element_at(orders, (F.col("at") / len(FILTERS)).cast("int") + 1), F.col("at") % len(FILTERS) + 1
    rows = rows.select("part", order.alias("filter_order"), step.cast("int").alias("step"), "counts.*")
    letter = F.substring("filter_order", F.col("step"), F.lit(1))
    return rows.withColumn("shapley", F.sum("removed").over(Window.partitionBy("part", letter)))


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``part``, ``filter_order``, ``step``, the counts of ``COUNTS`` and ``shapley`` for ``docs(doc_id, text, source)``.

    Filters: A under 50 words, B under 65 % distinct words, C over 5 % capital letters, D any of ``#$%&*|``, E the text
    of a smaller id. ``shapley`` is the total that the step's filter removes in all orders; the mean over the 120 orders is
    the filter's Shapley value. Null texts are empty, a null source is the part ``""``. A row without an id has no label, never
    fails E and makes no other row fail it. Rows that repeat with the smallest id pass E together. An id with several
    rows in ``labels(doc_id, quality, toxic)`` is good or toxic if any of them says so; null labels say nothing. Other
    columns are not read. An empty table gives an empty result. The rows of a part are 600, its cells at most 32.
    """
    return interactions(cells(docs, labels))


SQL = r"""
WITH marks AS (
    SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
    FROM labels GROUP BY doc_id
), texts AS (
    SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
           coalesce(doc_id > min(doc_id) OVER (PARTITION BY coalesce(text, '')), false) AS e
    FROM documents
), worded AS (
    SELECT *, regexp_extract_all(text, '[^ \t\n\x0B\f\r]+') AS words FROM texts
), failing AS (
    SELECT doc_id, part,
           CASE WHEN len(words) < 50 THEN 1 ELSE 0 END
           + CASE WHEN 100 * len(list_distinct(words)) < 65 * len(words) THEN 2 ELSE 0 END
           + CASE WHEN 100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > 5 * length(text) THEN 4 ELSE 0 END
           + CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 8 ELSE 0 END
           + CASE WHEN e THEN 16 ELSE 0 END AS mask
    FROM worded
), counted AS (
    SELECT part, mask, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic
    FROM failing LEFT JOIN marks USING (doc_id) GROUP BY part, mask
), letters(letter, bit) AS (
    VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)
), orders AS (
    SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order
    FROM letters a, letters b, letters c, letters d, letters e
    WHERE a.bit | b.bit | c.bit | d.bit | e.bit = 31
), steps AS (
    SELECT filter_order, step, bit,
           coalesce(sum(bit) OVER (PARTITION BY filter_order ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::INTEGER AS before
    FROM orders, (SELECT unnest(range(1, 6))::INTEGER AS step) JOIN letters ON letter = substr(filter_order, step, 1)
), audit AS (
    SELECT part, filter_order, step, bit,
           sum(CASE WHEN mask & (before | bit) = 0 THEN n ELSE 0 END)::BIGINT AS kept,
           sum(CASE WHEN mask & before = 0 AND mask & bit > 0 THEN n ELSE 0 END)::BIGINT AS removed,
           sum(CASE WHEN mask & before > 0 AND mask & bit > 0 THEN n ELSE 0 END)::BIGINT AS redundant,
           sum(CASE WHEN mask = bit THEN n ELSE 0 END)::BIGINT AS unique_fails,
           sum(CASE WHEN mask & before = 0 AND mask & bit > 0 THEN good ELSE 0 END)::BIGINT AS good_lost,
           sum(CASE WHEN mask & before = 0 AND mask & bit > 0 THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
    FROM counted, steps GROUP BY part, filter_order, step, bit
)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley
FROM audit
"""
