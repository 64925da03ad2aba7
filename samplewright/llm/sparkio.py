"""What the corpus operators share of Spark: sizing of
shuffles, and one key for each document."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..scratch import Scratch, delete, free_shuffles, numbered, read_small, write_small
from .seqhash import trim

__all__ = ["Scratch", "ascii_lower", "buckets_for", "by_doc_id", "delete", "free_shuffles", "keyed", "read", "read_small", "reduced", "tasks_for", "write_small"]

#: A bucket of packed entries is planned for about so many bytes of scanned input; its reducer holds one.
BUCKET_BYTES = 4 << 20
#: Tasks of one shuffle, at most: beyond it a task takes several buckets, one after another.
MOST_TASKS = 50_000


def input_bytes(df: DataFrame) -> int:
    """Catalyst's estimate, from file sizes for scans."""
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return int(str(size))


def buckets_for(df: DataFrame) -> int:
    """Buckets: the session's shuffle partitions, or more for a large input, without a bound."""
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    size = input_bytes(df)
    if size > 1 << 60:  # no statistics
        return least
    return max(least, size // BUCKET_BYTES)


def tasks_for(df: DataFrame, buckets: int) -> int:
    """Tasks for the buckets of a table: one for each BUCKET_BYTES and at least one for each core, so that
    a small table's buckets are not as many files; see scratch.LOCAL for what these cost."""
    size = input_bytes(df)
    if size > 1 << 60:  # no statistics
        return buckets
    return min(buckets, max(df.sparkSession.sparkContext.defaultParallelism, size // BUCKET_BYTES))


def reduced(rows: DataFrame, buckets: int, reduce, schema, tasks: int = MOST_TASKS) -> DataFrame:
    """rows (bucket, …) dealt by bucket to so many tasks at most; reduce (batches to batches) sees one bucket at a time, in order."""
    return rows.repartition(min(buckets, tasks, MOST_TASKS), "bucket").sortWithinPartitions("bucket").mapInArrow(one_by_one(reduce), schema)


def one_by_one(reduce):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, now = [], None
        for b in batches:
            bucket = b.column("bucket").to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]) if len(bucket) else []
            for lo, hi in zip(cuts, [*cuts[1:], len(bucket)], strict=True):
                if held and bucket[lo] != now:
                    yield from reduce(iter(held))
                    held = []
                now = bucket[lo]
                held.append(b.slice(lo, hi - lo))
        if held:
            yield from reduce(iter(held))
        held.clear()
        trim()

    return run


def keyed(docs: DataFrame, scratch: Scratch, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame | None]:
    """((key long, text) with one row for each document, (doc_id, key) of all rows or None where the key is doc_id).

    Normally the key is doc_id. Where ids are null or repeated, the distinct
    pairs (doc_id, text) are numbered in that order, nulls last, so that rows
    equal in both are one document and every row still gets its result.
    """
    odd = docs.groupBy(id_col).agg(F.count("*").alias("n")).where((F.col("n") > 1) | F.col(id_col).isNull()).limit(1).count()
    if not odd:
        return docs.select(F.col(id_col).cast("long").alias("key"), F.col(text_col).alias("text")), None
    pairs = docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("text")).distinct()
    made = scratch.save(numbered(pairs, [F.col("i").asc_nulls_last(), F.col("text").asc_nulls_last()], "key"), "keys")
    back = made.select("key", F.col("i").alias("_i"), F.col("text").alias("_t"))
    same = F.col(id_col).eqNullSafe(F.col("_i")) & F.col(text_col).eqNullSafe(F.col("_t"))
    rows = docs.select(id_col, text_col).join(back, same).select(F.col(id_col).alias("doc_id"), "key")
    return made.select("key", "text"), scratch.save(rows, "rows")


def by_doc_id(result: DataFrame, rows: DataFrame | None) -> DataFrame:
    """A result by key, as one by doc_id; see keyed."""
    if rows is None:
        return result.withColumnRenamed("key", "doc_id")
    return rows.join(result, "key").drop("key")


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def ascii_lower(text: Column) -> Column:
    """A-Z only; other letters stay."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
