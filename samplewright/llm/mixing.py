"""Mixing sources to target weights by hash-threshold histograms (operator 5).

A document's size is its number of words. Each source gets a target, a share
of all words by weight, but at most `most` times what it has; the excess is
shared again by weight. A source takes all its documents q times and those
whose hash lies under a threshold once more. The threshold is found without
sorting: words are summed by source and hash bucket, whole buckets are taken
while they fit, and only the bucket at the boundary is looked at more finely,
level by level, until the rest is below `slack` of the target or one hash value is left. Thresholds are
nested: a larger budget keeps what a smaller one took.

Nulls: a null text has size 0; a null source is a source of its own, after all
others; a null doc_id hashes like any value. Rows equal in doc_id and text
share their fate (their hash is one). Documents of size 0 take 0. An empty
table gives an empty result. The driver holds one row for each source, not for
documents or buckets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import seqhash as H
from .sparkio import Scratch

#: Hash buckets of one level, as bits; the hash has 60 bits.
BITS, LEVELS = 10, 6
MOST = 3.0
SLACK = 1e-4
SIZED = "doc_id long, source string, size long, hash long"


def _sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        sizes = []
        for part in _parts(b):
            data, offs = H.batch_bytes(part.column("text"))
            sizes.append(word_counts(data, offs))
        size = np.concatenate(sizes) if sizes else np.zeros(0, np.int64)
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("source"), pa.array(size, pa.int64()), b.column("hash")], names=["doc_id", "source", "size", "hash"])


def _parts(batch: pa.RecordBatch, rows: int = 512) -> Iterator[pa.RecordBatch]:
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def word_counts(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Words of each text: a word begins where a text or a separator ended."""
    inside = ~H.SPACE[data]
    begin = inside.copy()
    begin[1:] &= ~inside[:-1]
    cuts = offs[:-1][np.diff(offs) > 0]
    begin[cuts] = inside[cuts]
    total = np.concatenate([[0], np.cumsum(begin)])
    return total[offs[1:]] - total[offs[:-1]]


def targets(sizes: dict, most: float = MOST, weights: tuple = (1, 2, 3)) -> dict:
    """Target words of each source, from its size; sources in code point order, null last."""
    order = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, open_, full = sum(sizes.values()), set(order), {}
    while open_:
        share = (total - sum(full.values())) / sum(weight[s] for s in open_)
        over = {s for s in open_ if share * weight[s] > most * sizes[s]}
        if not over:
            return full | {s: share * weight[s] for s in open_}
        full |= {s: most * sizes[s] for s in over}
        open_ -= over
    return full


def mix_sources(docs: DataFrame, most: float = MOST, slack: float = SLACK, seed: int = 7) -> DataFrame:
    """docs (doc_id, text, source, …) → doc_id, source, size, source_size,
    target, copies, taken: copies is how often the mix repeats the document."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "mix")
    hashed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "source", F.shiftrightunsigned(F.xxhash64("doc_id", "text", F.lit(seed)), 4).alias("hash"))
    sized = scratch.save(hashed.mapInArrow(_sizes, SIZED), "sizes")

    sizes = {r.source: r.size for r in sized.groupBy("source").agg(F.sum("size").alias("size")).collect()}
    goal = targets(sizes, most)
    # whole passes, and the words that are left for the pass under a threshold
    whole = {s: min(int(goal[s] // sizes[s]), int(most)) if sizes[s] else 0 for s in sizes}
    left = {s: goal[s] - whole[s] * sizes[s] for s in sizes}
    under = {s: 0 for s in sizes}  # hashes below it are taken once more
    active = {s for s in sizes if sizes[s] and left[s] > 0 and whole[s] < most}
    shown = "source string, low long, high long"
    for level in range(LEVELS):
        if not active:
            break
        shift = BITS * (LEVELS - 1 - level)
        span = 1 << (shift + BITS)
        edge = spark.createDataFrame([(s, under[s], under[s] + span) for s in active], shown)
        inside = sized.join(edge, sized.source.eqNullSafe(edge.source) & (F.col("hash") >= F.col("low")) & (F.col("hash") < F.col("high")))
        bucket = F.shiftright(F.col("hash") - F.col("low"), shift)
        counts = inside.groupBy(sized.source, bucket.alias("bucket")).agg(F.sum("size").alias("size"))
        # whole buckets are taken while they fit: the first that doesn't is the boundary
        upto = Window.partitionBy("source").orderBy("bucket")  # at most 2**BITS rows
        room = spark.createDataFrame([(s, float(left[s])) for s in active], "_s string, room double")
        summed = counts.withColumn("upto", F.sum("size").over(upto)).join(room, F.col("source").eqNullSafe(F.col("_s")))
        edges = summed.where(F.col("upto") > F.col("room")).groupBy("source").agg(F.min(F.struct("bucket", "upto", "size")).alias("e"))
        found = {r.source: r.e for r in edges.collect()}
        last = level == LEVELS - 1
        for s in list(active):
            e = found[s]
            left[s] -= e.upto - e.size
            under[s] += e.bucket << shift
            if last and e.size - left[s] < left[s]:  # one hash value: the nearer of with and without
                left[s] -= e.size
                under[s] += 1
            if left[s] <= slack * goal[s] or last:
                active.discard(s)
    plan = spark.createDataFrame([(s, sizes[s], float(goal[s]), whole[s], under[s]) for s in sizes], "source string, source_size long, target double, whole int, under long")
    copies = F.col("whole") + F.when((F.col("hash") < F.col("under")) & (F.col("size") > 0), 1).otherwise(0)
    out = sized.join(plan, sized.source.eqNullSafe(plan.source)).select("doc_id", sized.source, "size", "source_size", "target", copies.alias("copies"))
    return out.withColumn("taken", F.col("size") * F.col("copies"))
