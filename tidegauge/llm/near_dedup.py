"""Near duplicates by min-max hashing over word shingles, with exact confirmation.

1. One pass over the texts: shingle set, digest of the set, and a min-max signature. Each hash
   function gives two values, its minimum and its maximum over the set, so half the products are
   computed. Four values form a band.
2. Documents with equal sets form a class; its smallest id stands for it. What follows sees classes.
3. Every class of a band's bucket is paired with the bucket's smallest: no more pairs than rows.
   Pairs are confirmed on the full sets, and confirmed ones give components.
4. A bucket that still spans several components is searched further. Small ones give their pairs of
   different components. Large ones, groups of edited copies that mostly are no near duplicates of
   each other, are compared block by block on longer signatures within tasks, which give only
   pairs that these allow to be linked. No group is gathered and no group's pairs are emitted.
5. Components of all confirmed pairs, and of the classes that one id's texts belong to.

With 32 bands of 4 values a link at exactly 0.8 escapes all buckets with probability 5e-8, at 0.85 6e-11.
Signatures rule a pair out only at 6.5 standard deviations below the threshold. There is no cap on
pairs or buckets.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.components import components
from tidegauge.llm.kernel import mix, pieces
from tidegauge.llm.shingles import WIDTH, min_max, shingle_sets
from tidegauge.llm.store import bounded, id_filter, maybe_in, stored

#: Similarity in percent unless another is asked for: linked if 100 * intersection >= percent * union.
PERCENT = 80
BANDS = 32
BAND_VALUES = 4
#: Buckets up to this many classes give their pairs directly; larger ones are compared in blocks.
SMALL_BUCKET = 32
BLOCK = 512
#: Values of the longer signature, of which one byte each is kept.
LONG = 1024

_FACTORS = (np.random.Generator(np.random.PCG64(85)).integers(0, 1 << 63, BANDS * BAND_VALUES // 2, dtype=np.uint64) << np.uint64(1)) | np.uint64(1)


def _least(values: int, percent: int) -> int:
    """So many of a signature's values agree in a link: the threshold's share less 6.5 standard deviations."""
    share = percent / 100
    return math.floor(values * share - 6.5 * math.sqrt(values * share * (1 - share)))


_SIGNED = "doc_id long, n long, digest binary, bands array<long>, sketch binary"


def _signatures(width: int):
    def run(batches):
        for batch in pieces(batches, 1):
            ids, sets = batch.column(0), list(shingle_sets(batch.column(1), width))
            full = [i for i, s in enumerate(sets) if len(s)]
            bands: list = [None] * len(sets)
            sketch: list = [None] * len(sets)
            digest: list = [None] * len(sets)
            for low in range(0, len(full), 256):
                rows = full[low : low + 256]
                values = min_max([sets[i] for i in rows], _FACTORS)
                hashed = mix(values[:, 0::BAND_VALUES])
                for q in range(1, BAND_VALUES):
                    hashed = mix(hashed * np.uint64(31) + values[:, q::BAND_VALUES])
                low_bytes = (values & np.uint64(255)).astype(np.uint8)
                for k, i in enumerate(rows):
                    bands[i], sketch[i] = hashed[k].view(np.int64), low_bytes[k].tobytes()
                    digest[i] = hashlib.blake2b(sets[i].tobytes(), digest_size=16).digest()
            yield pa.RecordBatch.from_arrays(
                [ids.cast(pa.int64()), pa.array([len(s) for s in sets], pa.int64()), pa.array(digest, pa.binary()), pa.array(bands, pa.list_(pa.int64())), pa.array(sketch, pa.binary())],
                ["doc_id", "n", "digest", "bands", "sketch"],
            )

    return run


def _sets_of(docs: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """``id`` and its shingle set as bytes, for the documents named, stored; the texts are read again for it."""
    shared = id_filter(wanted)

    def run(batches):
        wanted = (batch.filter(pa.array(maybe_in(shared, batch.column(0)))) for batch in batches)
        for batch in pieces(wanted, 1):
            sets = [s.tobytes() for s in shingle_sets(batch.column(1), width)]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(sets, pa.binary())], ["id", "shingles"])

    sets = stored(bounded(docs.select("doc_id", "text")).mapInArrow(run, "id long, shingles binary"), "sets")
    shared.destroy()
    return sets


def _overlaps(percent: int):
    def run(batches):
        for batch in batches:
            a, b, x, y = (batch.column(i).to_pylist() for i in range(4))
            keep = []
            for i in range(len(a)):
                one, two = np.frombuffer(x[i], np.uint64), np.frombuffer(y[i], np.uint64)
                shared = len(np.intersect1d(one, two, assume_unique=True))
                if 100 * shared >= percent * (len(one) + len(two) - shared):
                    keep.append(i)
            yield pa.RecordBatch.from_arrays([pa.array([a[i] for i in keep], pa.int64()), pa.array([b[i] for i in keep], pa.int64())], ["a", "b"])

    return run


def _alike(percent: int):
    """Pairs whose signatures agree in enough places to be linked at all."""
    least = _least(BANDS * BAND_VALUES, percent)

    def run(batches):
        for batch in batches:
            x, y = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint8).reshape(-1, BANDS * BAND_VALUES) for i in (2, 3))
            yield batch.select(["a", "b"]).filter(pa.array((x == y).sum(axis=1) >= least))

    return run


def _confirmed(docs: DataFrame, classes: DataFrame, pairs: DataFrame, percent: int, width: int) -> DataFrame:
    """Those of the pairs ``a``, ``b`` that are linked, by their full sets."""
    sketches = classes.select("id", "sketch", "n")
    one, two = (sketches.select(F.col("id").alias(c), F.col("sketch").alias(f"s{c}"), F.col("n").alias(f"n{c}")) for c in "ab")
    pairs = pairs.join(one, "a").join(two, "b").where(f"100 * least(na, nb) >= {percent} * greatest(na, nb)")
    pairs = stored(pairs.select("a", "b", "sa", "sb").mapInArrow(_alike(percent), "a long, b long").distinct(), "candidates")
    sets = _sets_of(docs, pairs.select("a").union(pairs.select("b")), width)
    both = pairs.join(sets.select(F.col("id").alias("b"), F.col("shingles").alias("y")), "b")
    both = both.join(sets.select(F.col("id").alias("a"), F.col("shingles").alias("x")), "a").select("a", "b", "x", "y")
    return stored(both.mapInArrow(_overlaps(percent), "a long, b long").distinct(), "links")


def _long_sketches(docs: DataFrame, members: DataFrame, width: int) -> DataFrame:
    """``id`` and a signature of ``LONG`` bytes, for the classes named."""
    factors = (np.random.Generator(np.random.PCG64(86)).integers(0, 1 << 63, LONG // 2, dtype=np.uint64) << np.uint64(1)) | np.uint64(1)

    def run(batches):
        for batch in batches:
            sets = [np.frombuffer(s, np.uint64) for s in batch.column(1).to_pylist()]
            rows = [i for i, s in enumerate(sets) if len(s)]
            sketches = [(min_max([sets[i]], factors) & np.uint64(255)).astype(np.uint8).tobytes() for i in rows]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows, pa.int64())), pa.array(sketches, pa.binary())], ["id", "long"])

    return _sets_of(docs, members, width).mapInArrow(run, "id long, long binary")


def _near_in_blocks(table: pa.Table, percent: int) -> pa.Table:
    """Pairs of two blocks of a bucket, or of one, that belong to different components and may be linked."""
    left, right = table["left"][0].as_py(), table["right"][0].as_py()
    own, ids = table["own"].to_numpy(), table["id"].to_numpy()
    n, label = table["n"].to_numpy(), table["label"].to_numpy()
    bands = np.array(table["bands"].to_pylist(), np.int64)
    short = np.frombuffer(b"".join(table["sketch"].to_pylist()), np.uint8).reshape(len(ids), -1)
    long = np.frombuffer(b"".join(table["long"].to_pylist()), np.uint8).reshape(len(ids), -1)
    band = table["band"][0].as_py()
    one, two = np.flatnonzero(own == left), np.flatnonzero(own == right)
    least, least_long = _least(BANDS * BAND_VALUES, percent), _least(LONG, percent)
    a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for i in one.tolist():
        j = two[ids[two] > ids[i]] if left == right else two
        j = j[(label[j] != label[i]) & (100 * np.minimum(n[j], n[i]) >= percent * np.maximum(n[j], n[i]))]
        j = j[(short[j] == short[i]).sum(axis=1) >= least]
        j = j[(long[j] == long[i]).sum(axis=1) >= least_long]
        # A pair that meets in several bands is judged in the first.
        j = j[(bands[j] == bands[i]).argmax(axis=1) == band]
        a.append(np.minimum(ids[i], ids[j]))
        b.append(np.maximum(ids[i], ids[j]))
    return pa.table({"a": np.concatenate(a), "b": np.concatenate(b)})


def _pairs_in_blocks(docs: DataFrame, classes: DataFrame, large: DataFrame, percent: int, width: int) -> DataFrame:
    """Pairs of different components within large buckets, as far as signatures of ``LONG`` values allow a link.

    A bucket is cut into blocks of about ``BLOCK`` classes, and every two blocks are compared in a task
    of their own, so a task holds two blocks whatever the size of the bucket. Only near pairs leave it.
    """
    members = stored(large.select("id").distinct(), "large")
    long = stored(_long_sketches(docs, members, width), "sketches")
    rows = large.join(classes.select("id", "bands", "sketch"), "id").join(long, "id")
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    rows = rows.withColumn("own", F.pmod(F.xxhash64("id"), blocks).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    rows = rows.select("band", "value", F.least("own", "other").alias("left"), F.greatest("own", "other").alias("right"), "own", "id", "n", "label", "bands", "sketch", "long")
    return rows.groupBy("band", "value", "left", "right").applyInArrow(lambda table: _near_in_blocks(table, percent), "a long, b long").distinct()


def near_duplicates(docs: DataFrame, percent: int = PERCENT, width: int = WIDTH) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id``, ``kept`` for every row of ``docs(doc_id, text)``.

    Texts without words, empty and null ones have no shingles, are linked with nothing and are kept.
    A row without ``doc_id`` is linked with nothing, has no component and is kept. Rows that share a
    ``doc_id`` are one document with the links of all its texts. Other columns are not read.
    An empty table gives an empty result.
    """
    signed = stored(bounded(docs.select("doc_id", "text")).mapInArrow(_signatures(width), _SIGNED), "signatures")
    named = signed.where("doc_id is not null and digest is not null")
    of_digest = named.groupBy("digest").agg(F.min("doc_id").alias("id"))
    classes = stored(named.select("digest", F.col("doc_id").alias("id"), "n", "bands", "sketch").join(of_digest, ["digest", "id"], "left_semi").dropDuplicates(["digest", "id"]), "classes")

    members = classes.select("id", "n", F.posexplode("bands").alias("band", "value"))
    buckets = stored(members.groupBy("band", "value").agg(F.min("id").alias("hub"), F.count(F.lit(1)).alias("size")).where("size > 1"), "buckets")
    members = stored(members.join(buckets, ["band", "value"]), "members")
    first = _confirmed(docs, classes, members.where("id != hub").select(F.col("hub").alias("a"), F.col("id").alias("b")).distinct(), percent, width)
    labels = stored(components(first), "labels")

    labelled = members.where("size > 2").join(labels.withColumnRenamed("node", "id"), "id", "left").withColumn("label", F.coalesce("label", "id"))
    labelled = stored(labelled, "labelled")
    split = labelled.groupBy("band", "value").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low != high").select("band", "value")
    open_rows = stored(labelled.join(split, ["band", "value"]), "open")
    small = open_rows.where(F.col("size") <= SMALL_BUCKET).select("band", "value", "id", "n", "label", "hub")
    other = small.select("band", "value", F.col("id").alias("b"), F.col("n").alias("nb"), F.col("label").alias("lb"))
    pairs = (
        small.join(other, ["band", "value"])
        .where(f"id < b and id != hub and label != lb and 100 * least(n, nb) >= {percent} * greatest(n, nb)")
        .select(F.col("id").alias("a"), "b")
    )
    large = open_rows.where(F.col("size") > SMALL_BUCKET).select("band", "value", "size", "id", "n", "label")
    if not large.isEmpty():
        pairs = pairs.union(_pairs_in_blocks(docs, classes, large, percent, width))
    second = _confirmed(docs, classes, stored(pairs.distinct(), "pairs"), percent, width)

    linked = first.union(second)
    # Copies meet lot by lot, as they may be very many.
    lots = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    several = named.groupBy("doc_id").agg(F.min(F.xxhash64("digest")).alias("low"), F.max(F.xxhash64("digest")).alias("high"))
    several = stored(several.where("low != high").select("doc_id"), "several")
    if not several.isEmpty():
        # An id with several sets links their classes, also where it is not the smallest of any.
        own = named.select("doc_id", "digest").join(several, "doc_id", "left_semi").distinct()
        own = stored(own.withColumn("lot", F.pmod(F.xxhash64("doc_id"), F.lit(lots))), "own")
        heads = own.select("digest", "lot").distinct().join(of_digest, "digest")
        linked = linked.union(own.join(heads, ["digest", "lot"]).where("id != doc_id").select(F.col("id").alias("a"), F.col("doc_id").alias("b")))
    labels = stored(components(linked), "labels")
    class_label = of_digest.join(labels.withColumnRenamed("node", "id"), "id", "left").select("digest", F.coalesce("label", "id").alias("component_id"))
    found = signed.select("doc_id", "digest", "n", F.pmod(F.xxhash64("doc_id"), F.lit(lots)).alias("lot"))
    labelled = found.where("digest is not null").select("digest", "lot").distinct().join(class_label, "digest")
    found = found.join(labelled, ["digest", "lot"], "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return found.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )
