"""The registered queries of the corpus operators, and their SQL.

Each applies its operator, with production parameters, to its whole table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, decontam, jaccard, langid, line_dedup, mixing, oracles, suffix_dedup, token_counts, url_filter, window_index
from .sparkio import read

Query = Callable[[SparkSession, str], DataFrame]

RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block")]


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.dedup_substrings(read(spark, sf_dir, "documents"), texts=False)


def op2_learned_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    return url_filter.judge_urls(read(spark, sf_dir, "pages").select("page_id", "url"), rules).select("page_id", "host", "path", "rule", "verdict")


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(read(spark, sf_dir, "documents"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(read(spark, sf_dir, "documents"))


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(read(spark, sf_dir, "documents"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_lines(read(spark, sf_dir, "documents").select("doc_id", "text"), runs=True)
    return out.select("doc_id", "n_lines", "n_removed", "n_chunks", F.sha2("kept", 256).alias("kept_sha256"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.decontaminate(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op9_window_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return window_index.dedup_windows(read(spark, sf_dir, "documents"), texts=False)


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.suffix_sums(token_counts.length_histogram(read(spark, sf_dir, "documents")))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (op1_suffix_dedup, op2_learned_partitions, op3_url_filter, op4_language_id, op5_mixing, op6_jaccard_join, op7_line_dedup, op8_decontamination, op9_window_dedup, op10_token_counts)
}
#: The others are tested against brute force: they choose by hash, learn, or encode, which SQL can't express.
SQL: dict[str, str] = {
    "op1_suffix_dedup": oracles.SUFFIX_DEDUP,
    "op3_url_filter": url_filter.SQL,
    "op6_jaccard_join": oracles.JACCARD_JOIN,
    "op8_decontamination": oracles.DECONTAMINATION,
    "op9_window_dedup": oracles.WINDOW_DEDUP,
}
