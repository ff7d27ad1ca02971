"""The registered queries of the operators: each over its whole table, returning its whole result."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidegauge.llm import exact_dedup, filter_audit
from tidegauge.llm.decontamination import contamination
from tidegauge.llm.language_model import language_model_scores
from tidegauge.llm.licenses import license_scan
from tidegauge.llm.near_dedup import near_duplicates
from tidegauge.llm.packing import packed
from tidegauge.llm.pii import personal_data
from tidegauge.llm.quality import quality_scores
from tidegauge.llm.secrets import secret_scan
from tidegauge.llm.spelling import spelling_variants
from tidegauge.llm.store import table
from tidegauge.llm.substring_dedup import repeated_substrings
from tidegauge.llm.token_files import token_files

TOKENIZER = "word_bpe_49k.json"


def op4_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), percent=85)


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


def op8_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_substrings(table(spark, sf_dir, "documents"))


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


def op9_token_id_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model_scores(table(spark, sf_dir, "documents"))


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(table(spark, sf_dir, "documents"))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(table(spark, sf_dir, "documents"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents"))


def op12_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan(table(spark, sf_dir, "documents"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {
    "op2_pii": op2_pii,
    "op3_benchmark_decontamination": op3_benchmark_decontamination,
    "op10_license_scan": op10_license_scan,
    "op1_quality_classifier": op1_quality_classifier,
    "op6_lm_scoring": op6_lm_scoring,
    "op5_best_fit_packing": op5_best_fit_packing,
    "op9_token_id_output": op9_token_id_output,
    "op4_minhash_near_dedup": op4_minhash_near_dedup,
    "op7_exact_dedup": op7_exact_dedup,
    "op8_suffix_array_dedup": op8_suffix_array_dedup,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_secret_scan": op12_secret_scan,
    "op13_filter_audit": op13_filter_audit,
}
ORACLES: dict[str, str] = {"op7_exact_dedup": exact_dedup.SQL, "op13_filter_audit": filter_audit.SQL}
