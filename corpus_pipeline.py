"""Cleaning and packing of a corpus: five stages, each on all that the one before kept.

Quality first, as it is a single scan and what it rejects costs nothing later; then exact copies, near
copies, benchmark leaks, and packing of what is left. Every stage but the last returns the columns
of the documents. Each result is written as Parquet and read again.

SQL cannot express the trained classifier, min-max signatures, seeds or packing, so there is no SQL for
the rows of ``run``; the tests hold every stage against a brute-force version.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.llm.decontamination import decontaminated
from tidegauge.llm.exact_dedup import first_of_copies
from tidegauge.llm.near_dedup import near_duplicates
from tidegauge.llm.packing import packed
from tidegauge.llm.quality import good_documents
from tidegauge.llm.store import stored, table

TOKENIZER = "word_bpe_49k.json"


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject; rows without an id are judged like others."""
    return good_documents(docs, table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts, one with the smallest id; null texts are empty ones."""
    return first_of_copies(docs)


def minhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each component; rows without an id are linked with nothing and stay."""
    gone = near_duplicates(docs).where("not kept").select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(gone, docs["doc_id"] == gone["_gone"], "left_anti")


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap no test item."""
    return decontaminated(docs, table(spark, sf_dir, "benchmark"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 4096 tokens with their place in a sequence."""
    return packed(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("quality_classifier", quality_classifier),
    ("exact_dedup", exact_dedup),
    ("minhash_near_dedup", minhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("best_fit_packing", best_fit_packing),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to the documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
