"""Exact search for repeated windows of n bytes.

A window is identified by an anchor: the smallest rolling hash of the short
grams in it. Consecutive windows of a document with one anchor form a block
(a phrase, with the n-1 bytes after it), so equal windows always lie in
blocks with equal anchors. Three steps follow.

1. Blocks, some 2/(n-w+2) a byte, are dealt out by anchor, packed as arrays;
   copies within a batch are merged before that. Equal blocks are repeats in
   full. Of different blocks with one anchor, those that agree before or after
   it, over half of what a window has besides, are ambiguous: no others can
   share a window.
2. One copy of each ambiguous block goes, with its bytes, to where its anchor
   is dealt to. There blocks are spelled out window by window, some anchors at
   a time, and equal windows found.
3. Runs of repeated windows come back to their documents.

No key gathers more than one entry for each batch and different content.
Blocks count as equal if their anchors' hashes (64 bits) and their own hashes
over a prime field (61 bits, see seqhash.Field) agree; windows of ambiguous
blocks are compared as bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import seqhash as H
from .sparkio import Scratch, buckets_for, free_shuffles, reduced

#: Bytes handled by one round of array passes; a longer text is cut into
#: overlapping pieces, which changes blocks but never which windows repeat.
PIECE = 1 << 18
#: Bytes of blocks whose windows are spelled out at a time; sorting their suffixes takes some 50 times as much.
SPELLED = 1 << 20

ROWS = "kind int, bucket int, key long, lo int, n int, packed binary"
ARROW = pa.schema([("kind", pa.int32()), ("bucket", pa.int32()), ("key", pa.int64()), ("lo", pa.int32()), ("n", pa.int32()), ("packed", pa.binary())])
HIT, SPELL, PACKED = 0, 1, 2

#: flags of an entry: seen at two places; its anchor gram occurs in it more
#: than once, so windows of one block may be equal
TWICE, INNER = 1, 2

ENTRY = np.dtype([("anchor", "<u8"), ("check", "<u8"), ("key", "<i8"), ("lo", "<i4"), ("n", "<i4"), ("flags", "u1")])

#: a block: also what stands before and after its anchor (0: too little in the block)
SIDED = np.dtype([*ENTRY.descr, ("left", "<u4"), ("right", "<u4")])


def pack(entries: np.ndarray) -> bytes:
    return b"".join(entries[f].tobytes() for f in entries.dtype.names)


def unpack(blob: bytes, dtype: np.dtype = ENTRY) -> np.ndarray:
    n = len(blob) // dtype.itemsize
    out, at = np.empty(n, dtype), 0
    for f in dtype.names:
        kind = dtype[f]
        out[f] = np.frombuffer(blob, kind, n, at)
        at += n * kind.itemsize
    return out


def table(kind: int, key=(), lo=(), n=(), bucket=None, packed=None) -> pa.RecordBatch:
    rows = len(bucket) if bucket is not None else len(key)
    blank = lambda t: pa.nulls(rows, t)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.full(rows, kind, np.int32)),
            pa.array(bucket, pa.int32()) if bucket is not None else pa.array(np.asarray(key) % 4096, pa.int32()),
            pa.array(key, pa.int64()) if packed is None else blank(pa.int64()),
            pa.array(lo, pa.int32()) if packed is None else blank(pa.int32()),
            pa.array(n, pa.int32()) if packed is None else blank(pa.int32()),
            pa.array(packed, pa.binary()) if packed is not None else blank(pa.binary()),
        ],
        schema=ARROW,
    )


def buckets_of(values: np.ndarray, buckets: int) -> np.ndarray:
    """Even buckets of hashes: the high 32 bits, scaled."""
    return ((values >> H.U64(32)) * H.U64(buckets) >> H.U64(32)).astype(np.int32)


def dealt(entries: np.ndarray, by: str, buckets: int) -> pa.RecordBatch:
    """One packed row for each bucket that has entries."""
    at = buckets_of(H.mix(entries[by].astype(H.U64) * H.BASES[1]), buckets)  # minima are not even
    order = np.lexsort((entries["check"], entries["anchor"], at))
    entries, at = entries[order], at[order]
    cut = np.flatnonzero(np.r_[True, at[1:] != at[:-1]]) if len(at) else np.zeros(0, int)
    ends = np.r_[cut[1:], len(at)]
    return table(PACKED, bucket=at[cut], packed=[pack(entries[a:b]) for a, b in zip(cut, ends, strict=True)])


def merged(entries: np.ndarray, both: bool) -> tuple[np.ndarray, np.ndarray]:
    """(one entry for each different (anchor, check): the first by key and
    place; entries known to repeat). both: every copy repeats, the first too;
    else only later ones. Entries of the same place are one."""
    order = np.lexsort((entries["lo"], entries["key"], entries["check"], entries["anchor"]))
    e = entries[order]
    if not len(e):
        return e, e
    new = np.r_[True, (e["anchor"][1:] != e["anchor"][:-1]) | (e["check"][1:] != e["check"][:-1])]
    moved = np.r_[True, (e["key"][1:] != e["key"][:-1]) | (e["lo"][1:] != e["lo"][:-1])]
    group = np.cumsum(new) - 1
    first = np.flatnonzero(new)
    twice = (np.bincount(group, weights=moved & ~new) > 0) | (np.bincount(group, weights=e["flags"] & TWICE) > 0)
    lead = e[first].copy()
    lead["flags"] = lead["flags"] & INNER | twice * TWICE
    if both:
        hit = e[twice[group]]
    else:
        f = e[first][group]
        hit = e[(e["key"] != f["key"]) | (e["lo"] != f["lo"])]
    return lead, hit


def pieces(batch: pa.RecordBatch, piece: int = PIECE) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row ranges of about `piece` bytes."""
    sizes = np.diff(H.batch_bytes(batch.column("text"))[1])
    at = np.cumsum(sizes) // piece
    cut = np.flatnonzero(np.r_[True, at[1:] != at[:-1]]) if len(at) else np.zeros(0, int)
    for a, b in zip(cut, np.r_[cut[1:], len(at)], strict=True):
        yield batch.slice(a, b - a)
    H.trim()


def valid_starts(first: np.ndarray, n: int, total: int) -> np.ndarray:
    """Which of `total` positions start a window of n tokens inside one text."""
    edge = np.zeros(total + 1, np.int32)
    room = np.maximum(np.diff(first) - n + 1, 0)
    np.add.at(edge, first[:-1][room > 0], 1)
    np.add.at(edge, (first[:-1] + room)[room > 0], -1)
    return np.cumsum(edge)[:total] > 0


def blocks(data: np.ndarray, first: np.ndarray, keys: np.ndarray, n: int, w: int) -> np.ndarray:
    """Entries of one batch; keys: of each text."""
    if len(data) < n:
        return np.empty(0, SIDED)
    codes = H.BYTE_CODES[data]
    grams = H.Rolling(codes, H.BASES[0]).grams(w)
    least = H.sliding_min(grams, n - w + 1)
    ok = valid_starts(first, n, len(least))
    own = np.zeros(len(codes) + 1, bool)
    own[first[:-1]] = True
    begin = ok.copy()
    begin[1:] &= ~ok[:-1] | (least[1:] != least[:-1]) | own[1 : len(ok)]
    lo = np.flatnonzero(begin)
    if not len(lo):
        return np.empty(0, SIDED)
    # a block lasts to the next one or to the last window of its text
    text = np.searchsorted(first, lo, "right") - 1
    hi = np.minimum(np.r_[lo[1:], len(codes)], first[text + 1] - n + 1)
    out = np.empty(len(lo), SIDED)
    rolling = H.Rolling(codes, H.BASES[1])
    out["anchor"], out["check"] = least[lo], H.Field(data).spans(lo, hi - 1 + n)
    out["key"], out["lo"], out["n"] = keys[text], lo - first[text], hi - lo
    # grams that are the least of some window, and how many of a block's are its anchor
    edge = np.zeros(n - w, H.U64)
    most = ~H.sliding_min(~np.concatenate([edge, least, edge]), n - w + 1)
    least_at = np.flatnonzero(grams == most)
    a, b = np.searchsorted(least_at, lo), np.searchsorted(least_at, hi + n - w)
    block = np.repeat(np.arange(len(lo)), b - a)
    place = least_at[np.repeat(a, b - a) + _ramp(b - a)]
    same = grams[place] == out["anchor"][block]
    out["flags"] = np.where(np.bincount(block[same], minlength=len(lo)) > 1, INNER, 0)
    at = np.zeros(len(lo), np.int64)
    at[block[same]] = place[same]
    half = -(-(n - w) // 2)
    for side, start, room in (("left", at - half, at - half >= lo), ("right", at + w, at + w + half < hi + n)):
        out[side] = 0
        out[side][room] = (rolling.spans(start[room], start[room] + half) >> H.U64(32)) | H.U64(1)
    return out


def alike(entries: np.ndarray, side: str) -> np.ndarray:
    """Which entries share their anchor and that side with another one."""
    order = np.lexsort((entries[side], entries["anchor"]))
    e = entries[order]
    equal = (e["anchor"][1:] == e["anchor"][:-1]) & (e[side][1:] == e[side][:-1]) & (e[side][1:] > 0)
    out = np.empty(len(e), bool)
    out[order] = np.r_[False, equal] | np.r_[equal, False]
    return out


def _cut(data: np.ndarray, first: np.ndarray, keys: np.ndarray, n: int, piece: int):
    """Texts of more than `piece` bytes, in pieces that overlap by n-1."""
    if len(data) <= 2 * piece:
        yield data, first, keys, 0
        return
    for t in range(len(first) - 1):
        a, b = first[t], first[t + 1]
        for s in range(a, max(b - n + 1, a + 1), piece):
            e = min(s + piece + n - 1, b)
            yield data[s:e], np.array([0, e - s]), keys[t : t + 1], s - a


def block_rows(n: int, w: int, buckets: int, both: bool):
    """The first step's map: batches of (key, text) to packed blocks and sure hits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for batch in pieces(big):
                keys = batch.column("key").to_numpy(zero_copy_only=False)
                data, first = H.batch_bytes(batch.column("text"))
                found = []
                for c, f, k, shift in _cut(data, first, keys, n, PIECE):
                    e = blocks(c, f, k, n, w)
                    e["lo"] += shift
                    found.append(e)
                lead, hit = merged(np.concatenate(found), both)
                if len(hit):
                    yield table(HIT, hit["key"], hit["lo"], hit["n"])
                if len(lead):
                    yield dealt(lead, "anchor", buckets)

    return run


def gathered(batches: Iterator[pa.RecordBatch], entries: list, dtype: np.dtype = ENTRY) -> Iterator[pa.RecordBatch]:
    """Passes on rows that aren't packed; entries: gets the others' content."""
    for b in batches:
        kind = b.column("kind").to_numpy(zero_copy_only=False)
        if (kind != PACKED).any():
            yield b.filter(pa.array(kind != PACKED))
        entries += [unpack(x, dtype) for x in b.column("packed").filter(pa.array(kind == PACKED)).to_pylist()]


def merge_blocks(both: bool):
    """The first step's reduce."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries: list[np.ndarray] = []
        yield from gathered(batches, entries, SIDED)
        if not entries:
            return
        lead, hit = merged(np.concatenate(entries), both)
        entries.clear()
        if len(hit):
            yield table(HIT, hit["key"], hit["lo"], hit["n"])
        group = np.cumsum(np.r_[True, lead["anchor"][1:] != lead["anchor"][:-1]]) - 1
        inner = np.bincount(group, weights=lead["flags"] & INNER) > 0  # its anchor may stand anywhere
        many = inner[group] | alike(lead, "left") | alike(lead, "right")
        if many.any():
            yield table(SPELL, lead["key"][many], lead["lo"][many], lead["n"][many])

    return run


def suffix_order(data: np.ndarray, n: int) -> np.ndarray:
    """Rank of each byte's n-byte string in the order of a suffix array cut at
    depth n (prefix doubling, from words of 8 bytes); equal strings have equal
    ranks. Strings that run over the end rank as if padded with zeros."""
    depth = min(8, n)
    padded = np.concatenate([data, np.zeros(depth - 1, np.uint8)]).astype(H.U64)
    rank = np.zeros(len(data), H.U64)
    for k in range(depth):
        rank = rank << H.U64(8) | padded[k : k + len(data)]
    rank = np.unique(rank, return_inverse=True)[1].astype(np.int64) + 1
    while depth < n:
        step = min(depth, n - depth)
        after = np.zeros(len(rank), np.int64)
        after[: max(len(rank) - step, 0)] = rank[step:]
        rank = np.unique(rank * (rank.max() + 1) + after, return_inverse=True)[1].astype(np.int64) + 1
        depth += step
    return rank


def content_rows(n: int, w: int, buckets: int):
    """The second step's map: (key, text, spans) to blocks with their bytes,
    packed by the anchor's bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for batch in pieces(big):
                keys = batch.column("key").to_numpy(zero_copy_only=False)
                data, first = H.batch_bytes(batch.column("text"))
                text, lo, n_windows = span_arrays(batch.column("spans"))
                e = np.zeros(len(text), ENTRY)
                e["key"], e["lo"], e["n"] = keys[text], lo, n_windows
                start = first[text] + e["lo"]
                e["anchor"] = H.sliding_min(H.Rolling(H.BYTE_CODES[data], H.BASES[0]).grams(w), n - w + 1)[start]
                at = buckets_of(H.mix(e["anchor"] * H.BASES[1]), buckets)
                order = np.argsort(at, kind="stable")
                cut = np.flatnonzero(np.r_[True, np.diff(at[order]) > 0])
                packed = []
                for own in np.split(order, cut[1:]):
                    stop = start[own] + e["n"][own] + n - 1
                    content = np.concatenate([data[a:b] for a, b in zip(start[own], stop, strict=True)])
                    packed.append(np.int32(len(own)).tobytes() + pack(e[own]) + content.tobytes())
                yield table(PACKED, bucket=at[order][cut], packed=packed)

    return run


def _ramp(sizes: np.ndarray) -> np.ndarray:
    """0..s-1 for each size s."""
    return np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def joined(hit: np.ndarray) -> np.ndarray:
    """Single windows to runs of neighbours."""
    hit = hit[np.lexsort((hit["lo"], hit["key"]))]
    step = np.flatnonzero(np.r_[True, (hit["key"][1:] != hit["key"][:-1]) | (hit["lo"][1:] != hit["lo"][:-1] + 1)])
    out = hit[step]
    out["n"] = np.diff(np.r_[step, len(hit)])
    return out


def merge_content(n: int, both: bool):
    """The second step's reduce: runs of windows that repeat."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, contents = [], []
        for blob in (x for b in batches for x in b.column("packed").to_pylist()):
            end = 4 + int(np.frombuffer(blob, np.int32, 1)[0]) * ENTRY.itemsize
            found.append(unpack(blob[4:end]))
            contents.append(np.frombuffer(blob[end:], np.uint8))
        if not found:
            return
        e, raw = np.concatenate(found), np.concatenate(contents)
        contents.clear()
        size = e["n"].astype(np.int64) + n - 1
        start = np.cumsum(size) - size
        order = np.argsort(e["anchor"], kind="stable")
        e, size, start = e[order], size[order], start[order]
        # slices of whole anchors
        group = np.cumsum(np.r_[True, e["anchor"][1:] != e["anchor"][:-1]]) - 1
        before = np.cumsum(size) - size
        slice_ = (before[np.searchsorted(group, group)]) // SPELLED
        for own in np.split(np.arange(len(e)), np.flatnonzero(np.diff(slice_)) + 1):
            m, long = e["n"][own].astype(np.int64), size[own]
            dictionary = raw[np.repeat(start[own], long) + _ramp(long)]
            begin = np.repeat(np.cumsum(long) - long, m) + _ramp(m)
            each = np.zeros(len(begin), ENTRY)
            # neighbours in this order with a common prefix of n are equal windows
            each["anchor"] = suffix_order(dictionary, n)[begin]
            each["key"], each["lo"], each["n"] = np.repeat(e["key"][own], m), np.repeat(e["lo"][own], m) + _ramp(m), 1
            _, hit = merged(each, both)
            if len(hit):
                hit = joined(hit)
                yield table(HIT, hit["key"], hit["lo"], hit["n"])

    return run


def repeats(docs: DataFrame, n: int, w: int, both: bool, scratch: Scratch) -> DataFrame:
    """(key, lo, n): runs of n windows from byte lo on that repeat. docs: (key, text)."""
    parts = buckets_for(docs)
    rows = docs.mapInArrow(block_rows(n, w, parts, both), ROWS)
    found = scratch.save(reduced(rows, parts, merge_blocks(both), ROWS).select("kind", "key", "lo", "n"), "blocks")
    spans = spans_by_key(found.where(F.col("kind") == SPELL))
    rows = docs.join(spans.hint("merge"), "key").select("key", "text", "spans").mapInArrow(content_rows(n, w, parts), ROWS)
    windows = scratch.save(reduced(rows, parts, merge_content(n, both), ROWS).select("key", "lo", "n"), "windows")
    return found.where(F.col("kind") == HIT).select("key", "lo", "n").unionAll(windows)


def spans_by_key(rows: DataFrame) -> DataFrame:
    """(key, spans): each key's places (lo, n), one whole number each."""
    return rows.groupBy("key").agg(F.collect_list(F.shiftleft(F.col("lo").cast("long"), 31) + F.col("n")).alias("spans"))


def span_arrays(spans: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, lo, n) of all spans of a batch, null lists without any."""
    sizes = pc.fill_null(pc.list_value_length(spans), 0).to_numpy(zero_copy_only=False)
    flat = spans.flatten().to_numpy(zero_copy_only=False)
    return np.repeat(np.arange(len(spans)), sizes), flat >> 31, flat & ((1 << 31) - 1)


def with_hits(docs: DataFrame, hits: DataFrame) -> DataFrame:
    """docs (key, text) with their runs; a document's list is no longer than the document."""
    spans = spans_by_key(hits)
    free_shuffles(docs.sparkSession)
    return docs.join(spans.hint("merge"), "key", "left")


def covered(spans: pa.ListArray, first: np.ndarray, n: int) -> np.ndarray:
    """Which tokens of a batch's texts, laid end to end, lie in a window of a run; first: each text's first token [len+1]."""
    text, lo, m = span_arrays(spans)
    edge = np.zeros(first[-1] + 1, np.int32)
    np.add.at(edge, first[text] + lo, 1)
    np.add.at(edge, first[text] + lo + m - 1 + n, -1)
    return np.cumsum(edge)[:-1] > 0
