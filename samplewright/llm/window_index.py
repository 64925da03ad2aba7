"""Incremental substring dedup with a log-structured fingerprint index (operator 9).

The index is one folder: a bucketed table of immutable runs, one for each
delivery of documents, and a manifest that names the runs that count. A run
holds the delivery's windows of 35 words as blocks: consecutive windows that
share an anchor, the place of the least hash of the 16-word grams in them.
A row has the block's fingerprint (the anchor's hash and two hashes over the
prime field, each over word codes of its own), its first place and its other
places in the same megabyte of text. Rows are hashed to buckets by anchor and
sorted by it, so all that can be equal lies in one bucket.

`add` writes a run and merges its buckets with those of the earlier runs;
nothing of the history is shuffled. Blocks with equal fingerprints are repeats
in full. Blocks with one anchor and different content are verified window by
window from their words. New repeats come back, of the delivery and of the
history. `compact` merges runs into one and deletes the old ones. `open`
finds an index again from its manifest alone.

Nulls: a null text has no words. Documents shorter than a window keep
everything. Rows equal in doc_id and text are one document, counted once.
An empty table gives an empty result; columns beyond doc_id and text are
passed by. Two windows count as equal if 64 + 61 + 31 bits of hashes agree
(blocks) or 61 + 61 (windows); words aren't compared beyond that.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import repeats as R
from . import seqhash as H
from .sparkio import Scratch, buckets_for, by_doc_id, delete, keyed, read_small, write_small

WINDOW, GRAM = 35, 16
#: Low bits of a gram's hash that give way to its place, so the leftmost of equal ones is the least.
PLACE_BITS = H.U64(22)
HIT, SPELL = 0, 1
#: Windows in one batch of rows.
TOGETHER = 1 << 17

PLACES = pa.list_(pa.struct([("key", pa.int64()), ("lo", pa.int32())]))
ENTRIES = "anchor long, c1 long, c2 long, key long, lo int, n int, more array<struct<key: long, lo: int>>"
ENTRIES_ARROW = pa.schema([("anchor", pa.int64()), ("c1", pa.int64()), ("c2", pa.int64()), ("key", pa.int64()), ("lo", pa.int32()), ("n", pa.int32()), ("more", PLACES)])


def word_codes(data: np.ndarray, offs: np.ndarray):
    """Two codes of each word, computed apart, and the first word of each text."""
    starts, ends, first = H.words(data, offs)
    return H.Field(data, 0).spans(starts, ends), H.Field(data, 1).spans(starts, ends), first


def blocks(a: np.ndarray, b: np.ndarray, first: np.ndarray, keys: np.ndarray, n: int, w: int):
    """(anchor, c1, c2, key, lo, n) of the blocks of some texts."""
    if len(a) < n:
        return [np.zeros(0, np.int64)] * 6
    grams = H.Rolling(a).grams(w)
    low = (H.U64(1) << PLACE_BITS) - H.U64(1)
    least = H.sliding_min(grams & ~low | np.arange(len(grams), dtype=H.U64), n - w + 1)
    place = (least & low).astype(np.int64)
    ok = R.valid_starts(first, n, len(least))
    own = np.zeros(len(a) + 1, bool)
    own[first[:-1]] = True
    begin = ok.copy()
    begin[1:] &= ~ok[:-1] | (place[1:] != place[:-1]) | own[1 : len(ok)]
    lo = np.flatnonzero(begin)
    text = np.searchsorted(first, lo, "right") - 1
    hi = np.minimum(np.r_[lo[1:], len(a)], first[text + 1] - n + 1)
    c1, c2 = H.Field(a, 0).spans(lo, hi - 1 + n), H.Field(b, 1).spans(lo, hi - 1 + n) >> H.U64(30)
    return [grams[place[lo]].view(np.int64), c1.astype(np.int64), c2.astype(np.int64), keys[text], lo - first[text], hi - lo]


def packed(columns: list[np.ndarray]) -> pa.RecordBatch:
    """One row for each different (first three columns): its first place by
    key and lo, and the other places as a list."""
    anchor, c1, c2, key, lo, n = columns
    order = np.lexsort((lo, key, c2, c1, anchor))
    anchor, c1, c2, key, lo, n = (c[order] for c in (anchor, c1, c2, key, lo, n))
    new = np.r_[True, (anchor[1:] != anchor[:-1]) | (c1[1:] != c1[:-1]) | (c2[1:] != c2[:-1])] if len(anchor) else np.zeros(0, bool)
    copies = np.r_[0, np.cumsum(np.bincount(np.cumsum(new) - 1, weights=~new).astype(np.int32))] if len(anchor) else np.zeros(1, np.int32)
    places = pa.StructArray.from_arrays([pa.array(key[~new], pa.int64()), pa.array(lo[~new], pa.int32())], fields=list(PLACES.value_type))
    more = pa.ListArray.from_arrays(pa.array(copies, pa.int32()), places)
    return pa.RecordBatch.from_arrays([pa.array(c[new], t) for c, t in zip((anchor, c1, c2, key, lo, n), ENTRIES_ARROW.types, strict=False)] + [more.cast(PLACES)], schema=ENTRIES_ARROW)


def _cut(a: np.ndarray, b: np.ndarray, first: np.ndarray, keys: np.ndarray, n: int):
    """Texts in pieces of at most PIECE tokens that overlap by n - 1, where there are more."""
    if len(a) <= R.PIECE:
        yield a, b, first, keys, 0
        return
    for t in range(len(first) - 1):
        for s in range(first[t], max(first[t + 1] - n + 1, first[t] + 1), R.PIECE):
            e = min(s + R.PIECE + n - 1, first[t + 1])
            yield a[s:e], b[s:e], np.array([0, e - s]), keys[t : t + 1], s - first[t]


def _block_rows(n: int, w: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for batch in R.pieces(big):
                keys = batch.column("key").to_numpy(zero_copy_only=False)
                a, b, first = word_codes(*H.batch_bytes(batch.column("text")))
                for x, y, f, k, shift in _cut(a, b, first, keys, n):
                    columns = blocks(x, y, f, k, n, w)
                    columns[4] = columns[4] + shift
                    yield packed(columns)

    return run


def _window_rows(n: int):
    """(key, text, spans of blocks) to their windows, each with hashes of its words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for batch in R.pieces(big):
                keys = batch.column("key").to_numpy(zero_copy_only=False)
                a, b, first = word_codes(*H.batch_bytes(batch.column("text")))
                text, lo, m = R.span_arrays(batch.column("spans"))
                begin = np.repeat(first[text] + lo, m) + R._ramp(m)
                text = np.repeat(text, m)
                c1, c2 = H.Field(a, 0).spans(begin, begin + n), H.Field(b, 1).spans(begin, begin + n)
                for at in range(0, len(begin), TOGETHER):
                    own = slice(at, at + TOGETHER)
                    yield packed([np.zeros(len(begin[own]), np.int64), c1[own].view(np.int64), c2[own].view(np.int64), keys[text[own]], begin[own] - first[text[own]], np.ones(len(begin[own]), np.int64)])

    return run


def _places(rows: DataFrame) -> DataFrame:
    """All places of rows, as (key, lo, n)."""
    own = F.array(F.struct("key", "lo"))
    return rows.select(F.explode(F.when(F.size("more") > 0, F.concat(own, "more")).otherwise(own)).alias("p"), "n").select("p.key", "p.lo", "n")


class FingerprintIndex:
    """An index in a folder. The number of buckets is fixed when it is made;
    choose it for the size it shall reach. One writer at a time."""

    def __init__(self, spark: SparkSession, path: str, buckets: int, window: int = WINDOW, gram: int = GRAM, fanout: int = 8):
        self.spark, self.path, self.buckets = spark, path, buckets
        self.window, self.gram, self.fanout = window, gram, fanout
        self.runs: list[int] = []
        self.made = 0
        self.table = f"fingerprints_{uuid.uuid4().hex}"
        spark.sql(f"CREATE TABLE {self.table} ({ENTRIES}, twice boolean, run int) USING parquet PARTITIONED BY (run) CLUSTERED BY (anchor) SORTED BY (anchor) INTO {buckets} BUCKETS LOCATION '{path}/runs'")

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> FingerprintIndex:
        """The index that a folder holds, as of its manifest."""
        made = json.loads(read_small(spark, f"{path}/manifest.json"))
        index = cls(spark, path, made["buckets"], made["window"], made["gram"], made["fanout"])
        index.runs, index.made = made["runs"], made["made"]
        spark.sql(f"ALTER TABLE {index.table} RECOVER PARTITIONS")
        return index

    def close(self) -> None:
        """Forgets the table's name; the folder stays."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")

    def _commit(self, runs: list[int]) -> None:
        """From here on these runs count; a run that a failed task left is not named and never read."""
        gone = [r for r in self.runs if r not in runs]
        self.runs = runs
        write_small(self.spark, f"{self.path}/manifest.json", json.dumps({"buckets": self.buckets, "window": self.window, "gram": self.gram, "fanout": self.fanout, "runs": runs, "made": self.made}))
        for r in gone:
            self.spark.sql(f"ALTER TABLE {self.table} DROP IF EXISTS PARTITION (run = {r})")
            delete(self.spark, f"{self.path}/runs/run={r}")

    def _write(self, rows: DataFrame) -> int:
        """A new run from rows that are dealt by anchor already."""
        self.made += 1
        delete(self.spark, f"{self.path}/runs/run={self.made}")  # of a writer that failed
        rows.withColumn("run", F.lit(self.made)).sortWithinPartitions("run", "anchor").write.insertInto(self.table)
        return self.made

    def live(self) -> DataFrame:
        return self.spark.table(self.table).where(F.col("run").isin(self.runs))

    def add(self, docs: DataFrame, texts: DataFrame, scratch: Scratch) -> DataFrame:
        """(key, lo, n): windows that this delivery shows to start more than once,
        its own and earlier ones not returned before. docs (key, text): the
        delivery; texts (key, text): all that was delivered, docs included, of
        which only texts with blocks to verify are read."""
        entries = docs.mapInArrow(_block_rows(self.window, self.gram), ENTRIES)
        run = self._write(entries.withColumn("twice", F.lit(False)).repartition(self.buckets, "anchor"))
        self._commit([*self.runs, run])
        found = scratch.save(self.met(run), f"met-{run}")
        spans = R.spans_by_key(found.where(F.col("kind") == SPELL))
        rows = texts.join(spans.hint("merge"), "key").select("key", "text", "spans").mapInArrow(_window_rows(self.window), ENTRIES)
        same = Window.partitionBy("c1", "c2")
        rows = rows.repartition(self.buckets, "c1", "c2").withColumn("copies", F.sum(F.lit(1) + F.size("more")).over(same)).where("copies > 1")
        windows = scratch.save(_places(rows), f"windows-{run}")
        if len(self.runs) >= self.fanout:
            self.compact()
        return found.where(F.col("kind") == HIT).select("key", "lo", "n").unionAll(windows)

    def met(self, run: int) -> DataFrame:
        """(kind, key, lo, n): blocks of a new run and of earlier ones that
        repeat (HIT), and those to verify (SPELL). Reads buckets side by side, without a shuffle."""
        same, near = Window.partitionBy("anchor", "c1", "c2"), Window.partitionBy("anchor")
        own = F.col("run") == run
        rows = self.live().withColumns({
            "copies": F.sum(F.lit(1) + F.size("more") + F.col("twice").cast("int")).over(same),
            "before": F.sum(F.when(~own, F.lit(1) + F.size("more") + F.col("twice").cast("int")).otherwise(0)).over(same),
            "place": F.row_number().over(same.orderBy("run", "key", "lo")),
        })
        rows = rows.withColumns({"other": (F.min("c1").over(near) < F.max("c1").over(near)) | (F.min("c2").over(near) < F.max("c2").over(near)), "fresh": F.max(own).over(near)})
        hit = (F.col("copies") > 1) & (own | (F.col("before") == 1) & (F.col("copies") > F.col("before")))
        spell = F.col("other") & F.col("fresh") & (F.col("place") == 1)
        rows = rows.where(hit | spell).withColumn("kinds", F.array_compact(F.array(F.when(hit, HIT), F.when(spell, SPELL))))
        rows = rows.select(F.explode("kinds").alias("kind"), "key", "lo", "n", "more")
        places = F.when((F.col("kind") == HIT) & (F.size("more") > 0), F.concat(F.array(F.struct("key", "lo")), "more")).otherwise(F.array(F.struct("key", "lo")))
        return rows.select("kind", F.explode(places).alias("p"), "n").select("kind", "p.key", "p.lo", "n")

    def compact(self) -> None:
        """All runs to one: blocks that stood several times stay once, marked. No shuffle."""
        first = F.min(F.struct("key", "lo", "n")).alias("f")
        twice = (F.sum(F.lit(1) + F.size("more") + F.col("twice").cast("int")) > 1).alias("twice")
        merged = self.live().groupBy("anchor", "c1", "c2").agg(first, twice)
        none = F.array().cast("array<struct<key: long, lo: int>>").alias("more")
        self._commit([self._write(merged.select("anchor", "c1", "c2", "f.*", none, "twice"))])


def _kept(window: int, texts: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offs = H.batch_bytes(b.column("text"))
            starts, ends, first = H.words(data, offs)
            rows, all_gone = [], R.covered(b.column("spans"), first, window)
            for i in range(b.num_rows):
                size, gone = int(first[i + 1] - first[i]), all_gone[first[i] : first[i + 1]]
                # separators are ASCII, so bytes split as the words do
                left = data[offs[i] : offs[i + 1]].tobytes().split()
                if gone.any():
                    left = [left[k] for k in np.flatnonzero(~gone)]
                left = b" ".join(left)
                rows.append((size, int(gone.sum()), hashlib.sha256(left).hexdigest(), left.decode() if texts else None))
            cols = list(zip(*rows, strict=True)) if rows else [[]] * 4
            arrays = [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.string(), pa.string()), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column("key"), *arrays], names=["key", "n_words", "n_removed", "kept_sha256", "kept"])

    return run


def dedup_windows(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, batches: int = 3, fanout: int = 2, texts: bool = True) -> DataFrame:
    """docs (doc_id, text, …) → doc_id, n_words, n_removed, kept_sha256 and,
    with texts, the kept words joined by one space. The table is added to a
    new index in `batches` deliveries, as a feed would bring them; runs are
    compacted when there are `fanout`."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "windows")
    own, rows = keyed(docs.select("doc_id", "text"), scratch)
    # a table's buckets are Spark's to bound; rows are sorted and spilled, so a large bucket needs no more memory
    buckets = min(buckets_for(own), int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets")))
    index = FingerprintIndex(spark, f"{scratch.root}/index", buckets, window, gram, fanout)
    delivery = F.pmod(F.xxhash64("key"), F.lit(batches))
    found = [index.add(own.where(delivery == i), own.where(delivery <= i), scratch) for i in range(batches)]
    index.close()
    hits = found[0]
    for f in found[1:]:
        hits = hits.unionAll(f)
    schema = "key long, n_words long, n_removed long, kept_sha256 string, kept string"
    out = R.with_hits(own, hits).select("key", "text", "spans").mapInArrow(_kept(window, texts), schema)
    out = by_doc_id(out if texts else out.drop("kept"), rows)
    return scratch.finish(out)
