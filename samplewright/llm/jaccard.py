"""Exact Jaccard self-join of word shingles by signature trees (operator 6).

Two texts link when 100 * |x ∩ y| >= 75 * |x ∪ y| over their sets of distinct
5-word shingles. A component is what links connect.

1. Equal sets are one node from the start, so a group of copies costs one set.
2. Prefix filter. Linked sets share at least l of each one's first
   |x|/4 + l shingles in any common order; sets with fewer such shingles that
   also occur elsewhere are done. Then all shingles of the sets that are left are
   counted exactly, and the filter repeats in rarest-first order. A shingle
   sends one entry for each batch in the first round, then one for each bucket
   of sets, however many sets hold it.
3. What still shares a prefix shingle forms candidate clusters. In each, a
   signature tree is built: leaves are sets, ordered by size, with bitmaps of
   their shingles; inner nodes hold the OR and the AND of their
   children's bitmaps and the range of sizes. A dual traversal of the
   tree with itself drops node pairs whose greatest possible overlap
   cannot reach the threshold, and those already connected; the pairs of sets
   that remain are intersected exactly.
4. Clusters of over BLOCK sets settle in rounds. Two rounds cut them into
   blocks by different hashes; a block's tree starts from what is connected
   already. Near copies are one component then. Only sets outside their
   cluster's largest component still meet all blocks of sizes that could
   link, so a group of copies costs blocks, not pairs of blocks. Nothing is
   skipped: two sets in one component need no test.

Nulls: a null text, or one without words, has an empty set, links with nothing
and is its own component. Fewer than 5 words: the whole sequence is
one shingle. Rows equal in doc_id and text are one document. component_id is a
doc_id; null ids come after all others. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import repeats as R
from . import seqhash as H
from .components import components
from .sparkio import Scratch, buckets_for, by_doc_id, keyed, reduced, tasks_for

K, SIMILAR = 5, 75
BLOCK = 256
#: Words of 64 bits in a signature; sets of one leaf; children of a node.
WIDTH, LEAF, FANOUT = 32, 16, 8
SEPARATOR = H.SPACE


def shingle_sets(data: np.ndarray, offs: np.ndarray, k: int = K, lower: bool = True, separator: np.ndarray = SEPARATOR):
    """(shingle hashes, sorted and distinct in each text; first one of each text [len+1]).
    Both the words' codes and the shingles' hashes are over the prime field, so
    no structure of the text makes different shingles equal."""
    if lower:
        data = H.LOWER[data]
    starts, ends, first = H.words(data, offs, separator)
    code = H.Field(data).spans(starts, ends)
    n = np.diff(first)
    m = np.where(n >= k, n - k + 1, np.minimum(n, 1))
    text = np.repeat(np.arange(len(n)), m)
    lo = np.repeat(first[:-1], m) + R._ramp(m)
    hi = lo + np.minimum(k, n[text])
    h = H.Field(code, 1).spans(lo, hi) if len(code) else np.zeros(0, H.U64)
    order = np.lexsort((h, text))
    h, text = h[order], text[order]
    new = np.r_[True, (h[1:] != h[:-1]) | (text[1:] != text[:-1])] if len(h) else np.zeros(0, bool)
    h, text = h[new], text[new]
    return h, np.searchsorted(text, np.arange(len(n) + 1))


def least_overlap(m):
    """Shingles of a set of m that a linked set must share."""
    return -(-SIMILAR * m // 100)


def support(m):
    return -(-m // 12)


def digests(h: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 63-bit digests of each set: sums of mixed shingles."""
    out = []
    for base in H.BASES:
        total = np.concatenate([[H.U64(0)], np.cumsum(H.mix(h * base))])
        d = total[first[1:]] - total[first[:-1]]
        out.append((H.mix(d + H.U64(1)) >> H.U64(1)).astype(np.int64))
    return out[0], out[1]


SIZES = "kind int, bucket int, key long, lo int, n int, packed binary, d1 long, d2 long"
SIZES_ARROW = pa.schema([*R.ARROW, ("d1", pa.int64()), ("d2", pa.int64())])


def _wide(b: pa.RecordBatch, d1=None, d2=None) -> pa.RecordBatch:
    none = pa.nulls(b.num_rows, pa.int64())
    return pa.RecordBatch.from_arrays([*b.columns, none if d1 is None else pa.array(d1), none if d2 is None else pa.array(d2)], schema=SIZES_ARROW)


def _counted(hit: np.ndarray) -> pa.RecordBatch:
    """Hits as counts by set."""
    sets, n = np.unique(hit["key"], return_counts=True)
    return R.table(R.HIT, sets, np.zeros(len(sets), np.int32), n.astype(np.int32))


def _prefix_rows(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for batch in R.pieces(big):
                keys = batch.column("key").to_numpy(zero_copy_only=False)
                h, first = shingle_sets(*H.batch_bytes(batch.column("text")))
                m = np.diff(first)
                d1, d2 = digests(h, first)
                yield _wide(R.table(R.SPELL, keys, np.zeros(len(keys), np.int32), m.astype(np.int32)), d1, d2)
                once = np.zeros(len(keys), bool)
                once[np.unique(d1, return_index=True)[1]] = True
                take = np.where(once, np.minimum(m - least_overlap(m) + support(m), m), 0)
                at = np.repeat(first[:-1], take) + R._ramp(take)
                e = np.zeros(len(at), R.ENTRY)
                e["anchor"], e["key"], e["n"] = h[at], np.repeat(d1, take), 1
                lead, hit = R.merged(e, both=True)
                # of tokens that already repeat, one marker goes on; its set is counted here
                if len(hit):
                    yield _wide(_counted(hit))
                if len(lead):
                    yield _wide(R.dealt(lead, "anchor", buckets))

    return run


def _prefix_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    entries: list[np.ndarray] = []
    yield from R.gathered(batches, entries)
    if entries:
        _, hit = R.merged(np.concatenate(entries), both=True)
        hit = hit[hit["flags"] & R.TWICE == 0]
        if len(hit):
            yield _wide(_counted(hit))


def _set_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, text) to (sid, tokens)."""
    for big in batches:
        for batch in R.pieces(big):
            h, first = shingle_sets(*H.batch_bytes(batch.column("text")))
            sets = [h[a:b].tobytes() for a, b in zip(first[:-1], first[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(sets, pa.binary())], names=["sid", "tokens"])


COUNTS = np.dtype([("token", "<u8"), ("home", "<i4"), ("n", "<i4")])
HOLDERS = np.dtype([("token", "<u8"), ("sid", "<i8")])
SHARED = "bucket int, sid long, tokens binary, packed binary"
STARS = "a long, b long, bucket int, packed binary"


def _rows(schema: str, **columns) -> pa.RecordBatch:
    """A batch of that shape; columns not given are null."""
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    size = max(len(c) for c in columns.values())
    fields = [f.split() for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(columns[n], kinds[t]) if n in columns else pa.nulls(size, kinds[t]) for n, t in fields], names=[n for n, _ in fields])


def _spread(schema: str, entries: np.ndarray, at: np.ndarray) -> pa.RecordBatch:
    """Entries packed into one row for each bucket."""
    order = np.argsort(at, kind="stable")
    entries, at = entries[order], at[order]
    cut = np.flatnonzero(np.r_[True, at[1:] != at[:-1]]) if len(at) else np.zeros(0, int)
    return _rows(schema, bucket=at[cut], packed=[R.pack(x) for x in np.split(entries, cut[1:])] if len(cut) else [])


def _home(batches: Iterator[pa.RecordBatch]) -> tuple[int, list, list, list]:
    """(bucket, [sid], [tokens], [packed]) of one home bucket."""
    home, sids, sets, entries = 0, [], [], []
    for b in batches:
        for home, sid, tokens, packed in zip(*(b.column(c).to_pylist() for c in ("bucket", "sid", "tokens", "packed")), strict=True):
            if packed is None:
                sids.append(sid)
                sets.append(np.frombuffer(tokens, H.U64))
            else:
                entries.append(packed)
    return home, sids, sets, entries


def _token_buckets(tokens: np.ndarray, buckets: int) -> np.ndarray:
    return R.buckets_of(H.mix(tokens * H.BASES[1]), buckets)


def _home_counts(buckets: int):
    """Sets of a home bucket to how many of them hold each token, one entry for
    all: a token of a third of all sets has as many entries as there are buckets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        home, _, sets, _ = _home(batches)
        tokens, n = np.unique(np.concatenate(sets), return_counts=True)
        e = np.empty(len(tokens), COUNTS)
        e["token"], e["home"], e["n"] = tokens, home, n
        yield _spread(SHARED, e, _token_buckets(tokens, buckets))

    return run


def _totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of tokens that two sets or more hold, the number of all sets that do, back to the home buckets."""
    found = [R.unpack(x, COUNTS) for b in batches for x in b.column("packed").to_pylist()]
    if not found:
        return
    e = np.concatenate(found)
    found.clear()
    e = e[np.argsort(e["token"], kind="stable")]
    group = np.cumsum(np.r_[True, e["token"][1:] != e["token"][:-1]]) - 1
    e["n"] = np.minimum(np.bincount(group, weights=e["n"]), 2**31 - 1)[group]
    e = e[e["n"] > 1]
    if len(e):
        yield _spread(SHARED, e, e["home"])


def _rare_holders(buckets: int):
    """Each set's rarest-first prefix, without the tokens that only it holds
    (those come first). Sets of one home that share a prefix token are edges;
    of those one goes on to the token's bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, sids, sets, packed = _home(batches)
        if not sets or not packed:
            return
        count = np.concatenate([R.unpack(x, COUNTS) for x in packed])
        count = count[np.argsort(count["token"])]
        n = np.array([len(x) for x in sets], np.int64)
        token, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), n)
        at = np.minimum(np.searchsorted(count["token"], token), len(count) - 1)
        known = count["token"][at] == token
        token, owner, total = token[known], owner[known], count["n"][at][known]
        order = np.lexsort((token, total, owner))
        token, owner = token[order], owner[order]
        shared = np.bincount(owner, minlength=len(sets))
        first = np.cumsum(shared) - shared
        take = n - least_overlap(n) + 1 - (n - shared)
        take = np.where(shared >= least_overlap(n), np.maximum(take, 0), 0)
        at = np.repeat(first, take) + R._ramp(take)
        if not len(at):
            return
        e = np.empty(len(at), HOLDERS)
        e["token"], e["sid"] = token[at], np.array(sids, np.int64)[owner[at]]
        lead, pairs = _starred(e)
        if len(pairs):
            yield _rows(STARS, a=pairs[:, 0], b=pairs[:, 1])
        yield _spread(STARS, lead, _token_buckets(lead["token"], buckets))

    return run


def _starred(e: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(the least holder of each token, edges of the others to it)."""
    e = e[np.lexsort((e["sid"], e["token"]))]
    new = np.r_[True, e["token"][1:] != e["token"][:-1]]
    root = e["sid"][np.flatnonzero(new)][np.cumsum(new) - 1]
    far = e["sid"] != root
    return e[new], np.unique(np.stack([e["sid"][far], root[far]], 1), axis=0)


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges, and of each token's holders an edge to the least one."""
    found = []
    for b in batches:
        edge = pc.is_valid(b.column("a"))
        yield b.filter(edge).select(["a", "b"])
        found += [R.unpack(x, HOLDERS) for x in b.filter(pc.invert(edge)).column("packed").to_pylist()]
    if found:
        pairs = _starred(np.concatenate(found))[1]
        yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0], pa.int64()), pa.array(pairs[:, 1], pa.int64())], names=["a", "b"])


class Tree:
    """Signature tree over sets that are ordered by size."""

    def __init__(self, sets: list[np.ndarray]):
        self.sets = sets
        self.size = np.array([len(s) for s in sets])
        self.bits = np.zeros((len(sets), WIDTH), H.U64)
        for i, s in enumerate(sets):
            bit = (H.mix(s) >> H.U64(64 - 11)).astype(np.int64) % (64 * WIDTH)
            np.bitwise_or.at(self.bits[i], bit >> 6, H.U64(1) << (bit & 63).astype(H.U64))
        n = len(sets)
        self.levels = []  # of (first, last, OR, AND, least size, most size), leaves first
        spans = [(i, min(i + LEAF, n)) for i in range(0, n, LEAF)]
        while True:
            self.levels.append([(a, b, np.bitwise_or.reduce(self.bits[a:b]), np.bitwise_and.reduce(self.bits[a:b]), self.size[a:b].min(), self.size[a:b].max()) for a, b in spans])
            if len(spans) == 1:
                break
            spans = [(spans[i][0], spans[min(i + FANOUT, len(spans)) - 1][1]) for i in range(0, len(spans), FANOUT)]


def enough(overlap, a, b):
    """Whether an overlap of sets of a and b shingles makes a link."""
    return 100 * overlap >= SIMILAR * (a + b - overlap)


def _ones(bits) -> np.ndarray:
    return np.bitwise_count(bits).sum(-1, dtype=np.int64)


def links(left: Tree, right: Tree | None = None, known: list | None = None) -> list[int]:
    """Roots that the links of left with right, or with itself, give the nodes;
    nodes of right are numbered after those of left. known: a mark for each
    node; nodes of one mark are connected from the start."""
    own = right is None
    right = left if own else right
    shift = 0 if own else len(left.sets)
    root = list(range(len(left.sets) + (0 if own else len(right.sets))))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    first: dict = {}
    for i, mark in enumerate(known or ()):
        root[i] = first.setdefault(mark, i)
    todo = [(len(left.levels) - 1, 0, len(right.levels) - 1, 0)]
    while todo:
        i, p, j, q = todo.pop()
        x, y = left.levels[i][p], right.levels[j][q]
        if own and (i, p) > (j, q) and i == j:
            continue
        if 100 * min(x[5], y[5]) < SIMILAR * max(x[4], y[4]):  # sizes too far apart
            continue
        most = min(x[5] - _ones(x[3] & ~y[2]), y[5] - _ones(y[3] & ~x[2]))
        if not enough(min(most, x[5], y[5]), x[4], y[4]):
            continue
        (a, b), (c, d) = x[:2], y[:2]
        one = find(a)
        if all(find(k) == one for k in range(a, b)) and all(find(k + shift) == one for k in range(c, d)):
            continue
        if i or j:
            if i >= j and i:
                todo += [(i - 1, c, j, q) for c in range(p * FANOUT, min(p * FANOUT + FANOUT, len(left.levels[i - 1])))]
            else:
                todo += [(i, p, j - 1, c) for c in range(q * FANOUT, min(q * FANOUT + FANOUT, len(right.levels[j - 1])))]
            continue
        bx, by = left.bits[a:b, None], right.bits[None, c:d]
        sx, sy = left.size[a:b, None], right.size[None, c:d]
        bound = np.minimum(sx - _ones(bx & ~by), sy - _ones(by & ~bx))
        for u, v in np.argwhere(enough(bound, sx, sy)):
            u, v = int(a + u), int(c + v)
            if (own and u >= v) or find(u) == find(v + shift):
                continue
            s, t = left.sets[u], right.sets[v]
            if enough(len(np.intersect1d(s, t, assume_unique=True)), len(s), len(t)):
                root[find(u)] = find(v + shift)
    return [find(i) for i in range(len(root))]


def _joined(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
    """One block, or one pair of blocks (side 0 and 1), to edges (a, b): marks of
    sets that are connected now, each to the least of its component."""
    pdf = pdf.sort_values(["side", "n", "sid"])
    sets, marks = [np.frombuffer(x, H.U64) for x in pdf["tokens"]], pdf["mark"].tolist()
    cut = int((pdf["side"] == 0).sum())
    roots = []
    if cut == len(sets) and cut:
        roots = links(Tree(sets), None, marks)
    elif cut:
        roots = links(Tree(sets[:cut]), Tree(sets[cut:]), marks)
    least: dict = {}
    for r, mark in zip(roots, marks, strict=False):
        least[r] = min(least.get(r, mark), mark)
    edges = {(mark, least[r]) for r, mark in zip(roots, marks, strict=False) if mark != least[r]}
    return pd.DataFrame(sorted(edges), columns=["a", "b"], dtype="int64")


def _met(tasks: DataFrame) -> DataFrame:
    """tasks (task, side, sid, n, mark, tokens) to edges of marks."""
    return tasks.groupBy("task").applyInPandas(_joined, "a long, b long")


def _by_hash(sets: DataFrame, seed: int) -> DataFrame:
    """Blocks of clusters by a hash of the set."""
    block = F.pmod(F.xxhash64("sid", F.lit(seed)), F.ceil(F.col("c") / BLOCK))
    return sets.select(F.concat_ws(":", "label", block).alias("task"), F.lit(0).alias("side"), "sid", "n", "mark", *[c for c in sets.columns if c == "tokens"])


def _rest_with_all(large: DataFrame) -> DataFrame:
    """Pairs of blocks: sets outside their cluster's largest component with all
    sets of the cluster whose sizes can link, by levels of size."""
    size = large.groupBy("label", "mark").agg(F.count("*").alias("k"))
    top = size.groupBy("label").agg(F.max(F.struct("k", "mark")).alias("top")).select("label", F.col("top.mark").alias("most"))
    level = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(100.0 / SIMILAR)) + 1e-9).cast("int")
    every = large.withColumn("level", level).join(top, "label")
    rest = every.where("mark <> most")

    def cut(sets: DataFrame, seed: int) -> tuple[DataFrame, DataFrame]:
        parts = sets.groupBy("label", "level").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("parts"))
        placed = sets.join(parts, ["label", "level"]).withColumn("part", F.pmod(F.xxhash64("sid", F.lit(seed)), F.col("parts").cast("long")).cast("int"))
        return placed, parts.select("label", "level", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))

    (left, some), (right, others) = cut(rest, 3), cut(every, 4)
    pairs = some.toDF("label", "la", "pa").join(others.toDF("label", "lb", "pb"), "label").where("abs(lb - la) <= 1")
    pairs = pairs.select("label", "la", "pa", "lb", "pb", F.concat_ws(":", "label", "la", "pa", "lb", "pb").alias("task"))
    side = lambda sets, lv, pt, n: sets.join(pairs.select("label", F.col(lv).alias("level"), F.col(pt).alias("part"), "task"), ["label", "level", "part"]).select("task", F.lit(n).alias("side"), "sid", "n", "mark")
    return side(left, "la", "pa", 0).unionAll(side(right, "lb", "pb", 1))


def _marked(sets: DataFrame, labels: DataFrame) -> DataFrame:
    """sets with their marks replaced by the components that labels (node, label) give them."""
    names = labels.select(F.col("node").alias("mark"), F.col("label").alias("_new"))
    return sets.join(names, "mark", "left").withColumn("mark", F.coalesce("_new", "mark")).drop("_new")


def linked(members: DataFrame, alive: DataFrame, scratch: Scratch) -> DataFrame:
    """members (sid, n, label): sets and their candidate cluster; alive (sid,
    tokens) → edges (a, b) whose components are those of all links."""
    count = members.groupBy("label").agg(F.count("*").alias("c"))
    sized = scratch.save(members.join(count, "label").join(alive.hint("merge"), "sid").withColumn("mark", F.col("sid")), "sized")
    edges = scratch.save(_met(_by_hash(sized, 1)), "edges-1")
    crowded = sized.where(F.col("c") > BLOCK)
    if not crowded.limit(1).count():
        return edges
    # texts' tokens join at the end, alike at every size; what is planned before is narrow
    tokens = crowded.select("sid", "tokens").hint("merge")
    large = crowded.drop("tokens")
    # in the first round each set is in one block, so its edge leads to its component's name
    first = edges.select(F.col("a").alias("node"), F.col("b").alias("label"))
    large = scratch.save(_marked(large, first), "large-1")
    again = scratch.save(_met(_by_hash(large, 2).join(tokens, "sid")), "edges-2")
    large = scratch.save(_marked(large, components(again, scratch, "blocks")), "large-2")
    return edges.unionAll(again).unionAll(scratch.save(_met(_rest_with_all(large).join(tokens, "sid")), "edges-3"))


def keyed_components(own: DataFrame, scratch: Scratch) -> DataFrame:
    """own (key, text), a row for each document → key, n_shingles, component (the smallest key in it)."""
    parts = buckets_for(own)
    found = reduced(own.mapInArrow(_prefix_rows(parts), SIZES), parts, _prefix_counts, SIZES, tasks_for(own, parts))
    found = scratch.save(found.select("kind", "key", "n", "d1", "d2"), "prefixes")
    each = found.where(F.col("kind") == R.SPELL).select("key", "n", "d1", "d2")
    sets = each.where("n > 0").groupBy("d1", "d2").agg(F.min("key").alias("sid"), F.first("n").alias("n"))
    shared = found.where(F.col("kind") == R.HIT).groupBy(F.col("key").alias("d1")).agg(F.sum("n").alias("c"))
    alive = sets.join(shared, "d1").where(F.col("c") >= F.ceil(F.col("n") / 16)).select("sid", "n")
    alive = scratch.save(own.join(alive.withColumnRenamed("sid", "key"), "key").select("key", "text").mapInArrow(_set_rows, "sid long, tokens binary"), "sets")

    home = F.pmod(F.xxhash64("sid"), F.lit(parts)).cast("int").alias("bucket")
    homes = alive.select(home, "sid", "tokens", F.lit(None).cast("binary").alias("packed"))
    totals = reduced(reduced(homes, parts, _home_counts(parts), SHARED), parts, _totals, SHARED)
    holders = reduced(homes.unionAll(totals), parts, _rare_holders(parts), STARS)
    spot = F.coalesce("bucket", F.pmod(F.xxhash64("a", "b"), F.lit(parts)).cast("int")).alias("bucket")
    edges = reduced(holders.select("a", "b", spot, "packed"), parts, _stars, "a long, b long")
    n = (F.octet_length("tokens") / 8).cast("int").alias("n")
    clusters = components(edges, scratch, "candidates")

    members = scratch.save(alive.select("sid", n).join(clusters.withColumnRenamed("node", "sid"), "sid"), "members")
    label = components(linked(members, alive, scratch), scratch, "links").select(F.col("node").alias("sid"), F.col("label").alias("component"))
    named = sets.select("d1", "d2", "sid").join(label, "sid", "left").select("d1", "d2", F.coalesce("component", "sid").alias("component"))
    return each.join(named, ["d1", "d2"], "left").select("key", F.col("n").cast("long").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("key")).alias("component"))


def jaccard_components(docs: DataFrame) -> DataFrame:
    """docs (doc_id, text, …) → doc_id, n_shingles, component_id."""
    scratch = Scratch(docs.sparkSession, "jaccard")
    own, rows = keyed(docs.select("doc_id", "text"), scratch)
    out = keyed_components(own, scratch)
    if rows is None:
        return scratch.finish(out.select(F.col("key").alias("doc_id"), "n_shingles", F.col("component").alias("component_id")))
    names = rows.distinct().select(F.col("key").alias("component"), F.col("doc_id").alias("component_id"))
    return scratch.finish(by_doc_id(out.join(names, "component").select("key", "n_shingles", "component_id"), rows))
