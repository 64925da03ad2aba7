r"""Line dedup by content-defined chunks of lines (operator 7).

A text's lines (split at \n) are hashed; where the rolling hash over the last
two line hashes hits a trigger, a chunk ends after that line, so inserted or
removed lines shift boundaries only nearby. Chunks of two lines or more that
stand in several places are candidates; every copy is compared byte by byte
with the first one (smallest doc_id, then place), and equal ones are removed
with their line ends. Chunks of one line, and of white space alone, always stay.

Boundaries miss both ends of a passage whose surroundings differ, and passages
between two boundaries. With runs, all pairs of adjoining lines outside the
removed chunks are then compared in the same way, each with its first place in
the whole table, so every line goes that lies in a run of two lines or more that
stands earlier. Places that overlap in one text are no copies of each other: of a
run of one repeated line the first two stay. Runs of white space alone stay.

Nulls: a null text stays null, with no lines. Rows equal in doc_id and text
are one document and keep the same lines. Null doc_ids come last. Other columns
stay as they are, but for those named like a result. An empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import repeats as R
from . import seqhash as H
from .sparkio import Scratch, buckets_for, keyed, reduced, tasks_for

#: A chunk ends after a line with a chance of 1 in so many.
MEAN_LINES = 4
HIT, SPELL = R.HIT, R.SPELL
LEAST_LINES = 2


def _lines(data: np.ndarray, offs: np.ndarray):
    """(text, first byte, end, first of its text) of each line, the line end included."""
    at = np.flatnonzero(data == 10)
    ends = np.concatenate([at + 1, offs[1:][np.diff(offs) > 0]])
    ends = np.unique(ends)  # a text that ends with \n has no empty last line
    text = np.searchsorted(offs, ends, "left") - 1
    if not len(ends):
        none = np.zeros(0, np.int64)
        return none, none, none, np.zeros(0, bool)
    first = np.r_[True, text[1:] != text[:-1]]
    return text, np.where(first, offs[text], np.r_[0, ends[:-1]]), ends, first


def chunks(data: np.ndarray, offs: np.ndarray):
    """(text, first byte, end, lines) of each chunk, the line end included."""
    text, starts, ends, first = _lines(data, offs)
    if not len(ends):
        return text, starts, ends, text
    bare = ends - (data[ends - 1] == 10)
    h = H.Rolling(H.BYTE_CODES[data]).spans(starts, np.maximum(bare, starts))
    before = np.where(first, H.U64(0), np.r_[H.U64(0), h[:-1]])
    cut = H.mix(before * H.BASES[1] + h) % H.U64(MEAN_LINES) == 0
    last = np.r_[text[1:] != text[:-1], True]
    stop = np.flatnonzero(cut | last)
    begin = np.r_[0, stop[:-1] + 1]
    return text[begin], starts[begin], ends[stop], stop - begin + 1


def _whole_chunks(batch: pa.RecordBatch, data: np.ndarray, offs: np.ndarray):
    text, lo, hi, lines = chunks(data, offs)
    ink = np.concatenate([[0], np.cumsum(~H.SPACE[data])])
    fit = (lines >= LEAST_LINES) & (ink[hi] > ink[lo])
    return text[fit], lo[fit], hi[fit]


def _line_pairs(batch: pa.RecordBatch, data: np.ndarray, offs: np.ndarray):
    """Pairs of adjoining lines, but for those inside one of the spans: these
    stand earlier, so they are not the first of their kind."""
    text, starts, ends, first = _lines(data, offs)
    inside = np.zeros(len(data), np.int32)
    for n, (i, at, size) in enumerate(zip(*R.span_arrays(batch.column("spans")), strict=True)):
        inside[offs[i] + at : offs[i] + at + size] = n + 1
    at = np.flatnonzero(~first[1:])
    text, lo, hi = text[at], starts[at], ends[at + 1]
    fit = (inside[lo] == 0) | (inside[lo] != inside[hi - 1])
    return text[fit], lo[fit], hi[fit]


def _entries(batch: pa.RecordBatch, cut) -> np.ndarray:
    keys = batch.column("key").to_numpy(zero_copy_only=False)
    data, offs = H.batch_bytes(batch.column("text"))
    text, lo, hi = cut(batch, data, offs)
    if not len(text):
        return np.empty(0, R.ENTRY)
    codes = H.BYTE_CODES[data]
    bare = hi - (data[hi - 1] == 10)  # the last line of a text may have no end
    e = np.empty(len(text), R.ENTRY)
    e["anchor"], e["check"] = H.Rolling(codes, H.BASES[0]).spans(lo, bare), H.Rolling(codes, H.BASES[1]).spans(lo, bare)
    e["key"], e["lo"], e["n"], e["flags"] = keys[text], lo - offs[text], hi - lo, 0
    return e


GROUPS = "kind int, bucket int, key long, lo int, n int, packed binary, gid long"
GROUPS_ARROW = pa.schema([*R.ARROW, ("gid", pa.int64())])


def _with_group(b: pa.RecordBatch, gid=None) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*b.columns, pa.nulls(b.num_rows, pa.int64()) if gid is None else pa.array(gid.astype(np.int64))], schema=GROUPS_ARROW)


def _listed(kind: int, e: np.ndarray) -> pa.RecordBatch:
    return _with_group(R.table(kind, e["key"], e["lo"], e["n"]), e["anchor"] ^ (e["check"] << H.U64(1)))


def _chunk_rows(buckets: int, cut):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for batch in R.pieces(big):
                lead, hit = R.merged(_entries(batch, cut), both=False)
                if len(hit):
                    yield _listed(HIT, hit)
                if len(lead):
                    yield _with_group(R.dealt(lead, "anchor", buckets))

    return run


def _chunk_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Copies (HIT) and, of each group, the first (SPELL)."""
    entries: list[np.ndarray] = []
    yield from R.gathered(batches, entries)
    if entries:
        lead, hit = R.merged(np.concatenate(entries), both=False)
        if len(hit):
            yield _listed(HIT, hit)
        twice = lead[lead["flags"] & R.TWICE > 0]
        if len(twice):
            yield _listed(SPELL, twice)


def _bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The chunks' own bytes, without a last line end; copies that overlap the first one in its text are left out."""
    for big in batches:
        for b in R.pieces(big):
            data, offs = H.batch_bytes(b.column("text"))
            raw, spans = data.tobytes(), b.column("spans")
            text = np.repeat(np.arange(b.num_rows), pc.list_value_length(spans).to_numpy(zero_copy_only=False))
            kind, gid, lo, n = (spans.flatten().field(f).to_numpy(zero_copy_only=False) for f in ("kind", "gid", "lo", "n"))
            start = offs[text] + lo
            chunk = [raw[a:e].removesuffix(b"\n") for a, e in zip(start, start + n, strict=True)]
            ends = {(text[i], gid[i], chunk[i]): lo[i] + n[i] for i in np.flatnonzero(kind == SPELL)}
            take = np.array([k == SPELL or at >= ends.get((t, g, c), 0) for k, t, g, c, at in zip(kind, text, gid, chunk, lo, strict=True)], bool)
            keys = b.column("key").to_numpy(zero_copy_only=False)[text]
            columns = [pa.array(kind, pa.int32()), pa.array(gid, pa.int64()), pa.array(keys, pa.int64()), pa.array(lo, pa.int32()), pa.array(n, pa.int32()), pa.array(chunk, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["kind", "gid", "key", "lo", "n", "chunk"]).filter(pa.array(take))


def _repeated(docs: DataFrame, cut, scratch: Scratch, name: str) -> DataFrame:
    """docs (key, text, …) → (key, lo, n): byte spans of what `cut` gives that stand earlier too."""
    parts = buckets_for(docs)
    rows = reduced(docs.mapInArrow(_chunk_rows(parts, cut), GROUPS), parts, _chunk_groups, GROUPS, tasks_for(docs, parts))
    found = scratch.save(rows.select("kind", "gid", "key", "lo", "n"), f"{name}-groups")
    spans = found.groupBy("key").agg(F.collect_list(F.struct("kind", "gid", "lo", "n")).alias("spans"))
    each = docs.select("key", "text").join(spans.hint("merge"), "key").select("key", "text", "spans").mapInArrow(_bytes, "kind int, gid long, key long, lo int, n int, chunk binary")
    each = scratch.save(each, f"{name}-bytes")
    same = each.where(F.col("kind") == HIT)
    # all copies of a group are equal, unless hashes collide: then each content has a first place of its own
    mixed = each.groupBy("gid").agg(F.min("chunk").alias("a"), F.max("chunk").alias("b")).where("a <> b").select("gid")
    mixed = scratch.save(mixed, f"{name}-mixed")
    if mixed.limit(1).count():
        place = F.row_number().over(Window.partitionBy("gid", "chunk").orderBy("key", "lo"))
        again = each.join(mixed, "gid", "left_semi").withColumn("place", place).where("place > 1")
        same = same.join(mixed, "gid", "left_anti").select("key", "lo", "n").unionAll(again.select("key", "lo", "n"))
    out = scratch.save(same.select("key", "lo", "n").distinct(), f"{name}-removed")
    for part in ("groups", "bytes", "mixed"):
        scratch.drop(f"{name}-{part}")
    return out


def repeated_chunks(docs: DataFrame, scratch: Scratch, runs: bool = False) -> DataFrame:
    """docs (key, text) → (key, lo, n): byte spans of chunks that stand earlier
    too and, with runs, of all pairs of lines that do."""
    whole = _repeated(docs, _whole_chunks, scratch, "chunks")
    if not runs:
        return whole
    spans = R.spans_by_key(whole)
    rest = docs.join(spans.hint("merge"), "key", "left").select("key", "text", "spans")
    return whole.unionAll(_repeated(rest, _line_pairs, scratch, "pairs"))


def _left(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for big in batches:
        for b in R.pieces(big):
            data, offs = H.batch_bytes(b.column("text"))
            null = np.asarray(b.column("text").is_null())
            row, lo, n = R.span_arrays(b.column("spans"))
            edge = np.zeros(len(data) + 1, np.int32)
            np.add.at(edge, offs[row] + lo, 1)
            np.add.at(edge, offs[row] + lo + n, -1)
            whole = np.cumsum(edge[:-1]) <= 0
            text, n_lines, removed, n_chunks = [], [], [], []
            for i in range(b.num_rows):
                own, keep = data[offs[i] : offs[i + 1]], whole[offs[i] : offs[i + 1]]
                gone = 0
                for at, end in np.flatnonzero(np.diff(np.r_[True, keep, True].astype(np.int8))).reshape(-1, 2) if not keep.all() else ():
                    if H.SPACE[own[at:end]].all():
                        keep[at:end] = True
                    else:
                        gone += 1
                ends = own == 10
                open_ = len(own) and not ends[-1]
                n_lines.append(int(ends.sum()) + int(open_))
                removed.append(int((ends & ~keep).sum()) + int(open_ and not keep[-1]))
                n_chunks.append(gone)
                text.append(None if null[i] else own[keep].tobytes().decode() if gone else own.tobytes().decode())
            made = {"n_lines": pa.array(n_lines, pa.int64()), "n_removed": pa.array(removed, pa.int64()), "n_chunks": pa.array(n_chunks, pa.int64()), "kept": pa.array(text, pa.string())}
            own = [b.column("rest")] if "rest" in b.schema.names else []
            yield pa.RecordBatch.from_arrays([b.column("key"), *made.values(), *own], names=["key", *made, *(["rest"] if own else [])])


LEFT = "key long, n_lines long, n_removed long, n_chunks long, kept string"


def dedup_lines(docs: DataFrame, runs: bool = False) -> DataFrame:
    """docs (doc_id, text, …) with n_lines, n_removed (lines), n_chunks
    (removed; adjoining ones are one) and the text that is left in `kept`; own columns of these names give way.
    runs: all runs of lines that stand earlier go, not only whole chunks."""
    scratch = Scratch(docs.sparkSession, "lines")
    own, rows = keyed(docs.select("doc_id", "text"), scratch)
    removed = repeated_chunks(own, scratch, runs)
    made = ["n_lines", "n_removed", "n_chunks", "kept"]
    rest = [c for c in docs.columns if c not in (*made, "doc_id", "text")]
    # the caller's other columns travel in one struct, out of the way of the names used here
    carried = F.struct(*[F.col(f"`{c}`") for c in rest]) if rest else F.lit(None).cast("struct<none: int>")
    back = [F.col(f"rest.`{c}`").alias(c) for c in rest]
    spans = R.spans_by_key(removed)
    if rows is None:
        whole = docs.select(F.col("doc_id").cast("long").alias("key"), "text", carried.alias("rest"))
        schema = T.StructType([*T._parse_datatype_string(LEFT).fields, whole.schema["rest"]])
        out = whole.join(spans.hint("merge"), "key", "left").select("key", "text", "spans", "rest").mapInArrow(_left, schema)
        return out.select(F.col("key").cast(docs.schema["doc_id"].dataType).alias("doc_id"), *back, *made)
    out = own.join(spans.hint("merge"), "key", "left").select("key", "text", "spans").mapInArrow(_left, LEFT)
    match = own.withColumnRenamed("text", "_t").join(rows.distinct().withColumnRenamed("doc_id", "_i"), "key").join(out, "key").drop("key")
    same = F.col("doc_id").eqNullSafe(F.col("_i")) & F.col("text").eqNullSafe(F.col("_t"))
    return docs.select("doc_id", "text", carried.alias("rest")).join(match, same).select("doc_id", *back, *made)
