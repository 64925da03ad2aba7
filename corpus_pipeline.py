"""A training-corpus pipeline: language ID, line dedup, near-duplicate removal,
benchmark decontamination, mixing to target weights.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor
kept; all but the last return the columns of documents. Null texts go in the
first stage (they have no language); rows equal in doc_id and text share
their fate, except that near-duplicate removal keeps one of them. Rows that
differ in one of the two are different documents, also where doc_id is null or
repeated. Empty tables pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from samplewright.llm import decontam, jaccard, langid, line_dedup, mixing
from samplewright.llm.sparkio import Scratch, keyed

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts in which no language is found (null, or without a letter)."""
    model = langid.train(docs)
    return langid.predict(docs.select(*COLUMNS), model).where(F.col("lang_pred") != langid.UNKNOWN).select(*COLUMNS)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes runs of two lines or more that stand earlier too; texts left without ink go."""
    out = line_dedup.dedup_lines(docs.select(*COLUMNS), runs=True)
    kept = out.withColumn("text", F.col("kept")).withColumn("n_chars", F.length("kept").cast(docs.schema["n_chars"].dataType))
    return kept.where(F.col("n_removed").eqNullSafe(0) | F.col("text").rlike(r"[^\x20\x09-\x0D]")).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component stays: the one with the smallest doc_id,
    then text. Documents are told apart by doc_id and text."""
    scratch = Scratch(spark, "near")
    own, rows = keyed(docs.select("doc_id", "text"), scratch)
    keep = jaccard.keyed_components(own, scratch).where("key = component").select("key")
    if rows is None:
        return docs.join(keep.withColumnRenamed("key", "_id"), F.col("doc_id").cast("long") == F.col("_id"), "left_semi").select(*COLUMNS)
    pairs = own.withColumnRenamed("text", "_t").join(rows.distinct().withColumnRenamed("doc_id", "_i"), "key").join(keep, "key")
    stays = docs.join(pairs, F.col("doc_id").eqNullSafe(F.col("_i")) & F.col("text").eqNullSafe(F.col("_t")), "left_semi")
    # rows equal in both: one of them stays
    return stays.groupBy("doc_id", "text").agg(F.min(F.struct("lang", "source", "n_chars")).alias("r")).select("doc_id", "text", "r.*").select(*COLUMNS)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents, told apart by doc_id and text, that hold a window of the benchmark."""
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    bad = decontam.keyed_hits(docs, bench).where("contaminated").select("k1", "k2").distinct()
    return decontam.with_key(docs).join(bad, ["k1", "k2"], "left_anti").select(*COLUMNS)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: each document that is taken, with the number of copies."""
    return mixing.mix_sources(docs).where(F.col("copies") > 0).select("doc_id", "source", "size", "source_size", "target", "copies", "taken")


STAGES = [("language_id", language), ("line_dedup", lines), ("near_duplicates", near_duplicates), ("decontamination", decontaminated), ("mixing", mixed)]
#: Not in SQL: language models and content-defined chunks; tests compare stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = scratch.save(stage(spark, docs, sf_dir), name)
        if i:
            scratch.drop(STAGES[i - 1][0])
    return docs
