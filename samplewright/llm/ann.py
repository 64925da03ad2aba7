"""Approximate nearest neighbours by learned partitions (operator 2).

A bounded sample of vectors gives a neighbour graph; its nodes are parted into
balanced groups that keep neighbours together, and a small classifier (one
hidden layer) learns to tell a vector's part. Every vector is indexed under
the part that the classifier finds most probable; a query is routed to its
several most probable parts and compared exactly with all vectors there. How
many parts are asked is set on sampled vectors outside the training half,
so that TARGET of their true neighbours are reached.

There are about sqrt(n) / 7 parts for n vectors, from 2 to 256, at every size
alike. Parts are cut into blocks of about BLOCK vectors by a hash of the id, and
the queries of a part into blocks too, so a part that a third of all vectors
share is many tasks. A block's distances are one matrix product; those that
could be among a query's nearest are computed again from differences. Each
block returns its nearest for each query; the best of those is the result.

Nulls: vectors that are null, zero, of another length than most (of equally
common lengths the smallest), or hold null or non-finite components take no
part, nor do rows without vec_id. Repeated rows: a query leaves out all rows
with its own id; an id found twice counts once, at its smallest distance. Ties
go to the smaller vec_id. Fewer candidates than k give fewer rows; an empty
table gives none. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .sparkio import Scratch

#: Vectors that the partition is learned from, at most.
SAMPLE = 8192
LEAST_PARTS, MOST_PARTS, NEIGHBOURS, SLACK = 2, 256, 10, 1.1
HIDDEN, STEPS, BATCH = 128, 1500, 256
TARGET = 0.95
BLOCK, QUERY_BLOCK = 8192, 4096
#: Queries whose distances to a block are one matrix.
TOGETHER = 128


def nearest(queries: np.ndarray, base: np.ndarray, k: int, own: bool = False) -> np.ndarray:
    """Indices of the k nearest base rows of each query, block by block."""
    out = []
    norm = (base * base).sum(1)
    for at in range(0, len(queries), 512):
        d = norm[None] - 2 * queries[at : at + 512] @ base.T
        if own:
            d[np.arange(len(d)), np.arange(at, at + len(d))] = np.inf
        out.append(np.argpartition(d, min(k, d.shape[1] - 1), 1)[:, :k])
    return np.concatenate(out) if out else np.zeros((0, k), int)


def balanced_parts(graph: np.ndarray, start: np.ndarray, parts: int, rounds: int = 10) -> np.ndarray:
    """Labels of the graph's nodes: each round a node moves to the part of most
    of its neighbours (in both directions) while that part has room."""
    n = len(graph)
    room = int(np.ceil(SLACK * n / parts))
    label = start.copy()
    src, dst = np.repeat(np.arange(n), graph.shape[1]), graph.ravel()
    for _ in range(rounds):
        votes = np.zeros((n, parts), np.float32)
        np.add.at(votes, (src, label[dst]), 1)
        np.add.at(votes, (dst, label[src]), 1)
        gain = votes.max(1) - votes[np.arange(n), label]
        size = np.bincount(label, minlength=parts)
        moved = 0
        for i in np.argsort(-gain, kind="stable"):
            if gain[i] <= 0 and size[label[i]] <= room:
                continue
            for p in np.argsort(-votes[i], kind="stable"):
                if p == label[i] and size[p] <= room:
                    break
                if p != label[i] and size[p] < room:
                    size[label[i]] -= 1
                    size[p] += 1
                    label[i] = p
                    moved += 1
                    break
        if not moved:
            break
    return label


class Router:
    """The classifier of parts."""

    def __init__(self, x: np.ndarray, label: np.ndarray, parts: int, seed: int = 3):
        rng = np.random.default_rng(seed)
        self.mean, self.scale = x.mean(0), x.std(0) + 1e-9
        z = self._norm(x)
        w = [rng.normal(0, np.sqrt(2 / z.shape[1]), (z.shape[1], HIDDEN)), np.zeros(HIDDEN), rng.normal(0, np.sqrt(1 / HIDDEN), (HIDDEN, parts)), np.zeros(parts)]
        first, second = [np.zeros_like(p) for p in w], [np.zeros_like(p) for p in w]
        goal = np.eye(parts)[label]
        for t in range(1, STEPS + 1):  # Adam
            pick = rng.integers(0, len(z), BATCH)
            a = np.maximum(z[pick] @ w[0] + w[1], 0)
            s = a @ w[2] + w[3]
            p = np.exp(s - s.max(1, keepdims=True))
            d = (p / p.sum(1, keepdims=True) - goal[pick]) / BATCH
            back = (d @ w[2].T) * (a > 0)
            for i, g in enumerate((z[pick].T @ back, back.sum(0), a.T @ d, d.sum(0))):
                first[i] = 0.9 * first[i] + 0.1 * g
                second[i] = 0.999 * second[i] + 0.001 * g * g
                w[i] = w[i] - 3e-3 * (first[i] / (1 - 0.9**t)) / (np.sqrt(second[i] / (1 - 0.999**t)) + 1e-8)
        self.w = w

    def _norm(self, x: np.ndarray) -> np.ndarray:
        return (x - self.mean) / self.scale

    def ranked(self, x: np.ndarray) -> np.ndarray:
        """Parts of each vector, the most probable first."""
        a = np.maximum(self._norm(x) @ self.w[0] + self.w[1], 0)
        return np.argsort(-(a @ self.w[2] + self.w[3]), 1, kind="stable")


def parts_for(n: int) -> int:
    return max(LEAST_PARTS, min(MOST_PARTS, round(n**0.5 / 7)))


def learn(x: np.ndarray, parts: int, k: int = 10):
    """(router, parts to ask) from sampled vectors; no more parts than there are vectors to fit."""
    half = max(len(x) // 2, 1)
    fit, rest = x[:half], x[half:]
    parts = min(parts, half)
    graph = nearest(fit, fit, NEIGHBOURS, own=True)
    seeds = fit[np.linspace(0, half - 1, parts).astype(int)]
    for _ in range(8):
        start = nearest(fit, seeds, 1)[:, 0]
        seeds = np.array([fit[start == p].mean(0) if (start == p).any() else seeds[p] for p in range(parts)])
    router = Router(fit, balanced_parts(graph, start, parts), parts)
    home = router.ranked(x)[:, 0]
    ask = rest[:500]
    if not len(ask):
        return router, parts
    true = nearest(ask, x, k + 1)
    other = true != half + np.arange(len(ask))[:, None]  # any routing finds the query itself
    place = np.argsort(router.ranked(ask), 1)  # rank of each part for each query
    # too few to calibrate on: the last of them counts
    needed = np.sort(place[np.arange(len(ask))[:, None], home[true]][other])
    return router, int(needed[min(int(np.ceil(TARGET * len(needed))), len(needed) - 1)]) + 1


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id long, embedding array<double>) of the rows that take part."""
    fine = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    fine = fine.where("vec_id is not null and embedding is not null and size(embedding) > 0")
    fine = fine.where("forall(embedding, x -> x is not null and not isnan(x) and abs(x) < double('infinity')) and exists(embedding, x -> x <> 0)")
    size = fine.groupBy(F.size("embedding").alias("n")).agg(F.count("*").alias("c")).orderBy(F.desc("c"), "n").head()
    return fine.where(F.size("embedding") == (size["n"] if size else 0))


def _routed(router, ask: int):
    def run(frames):
        for f in frames:
            if len(f):
                ranked = router.ranked(np.stack(f["embedding"]))[:, :ask]
                yield pd.DataFrame({"vec_id": f["vec_id"], "embedding": f["embedding"], "parts": list(ranked.astype("int32"))})

    return run


def _compared(k: int):
    def run(key, base: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(base) and len(queries):
            c, ids = np.stack(base["embedding"]), base["vec_id"].to_numpy()
            order = np.argsort(ids, kind="stable")
            c, ids = c[order], ids[order]
            first = np.flatnonzero(np.r_[True, ids[1:] != ids[:-1]])  # an id counts once
            own, group = ids[first], np.cumsum(np.r_[True, ids[1:] != ids[:-1]]) - 1
            asked, q = queries["vec_id"].to_numpy(), np.stack(queries["embedding"])
            norm = (c * c).sum(1)
            for at in range(0, len(q), TOGETHER):
                found += _nearest_ids(c, norm, own, first, group, q[at : at + TOGETHER], asked[at : at + TOGETHER], k)
        ids, scores = [np.concatenate(x) if found else np.zeros(0) for x in (list(zip(*found, strict=True))[1:] if found else ([], []))]
        asked = np.repeat([f[0] for f in found], [len(f[1]) for f in found]) if found else np.zeros(0)
        return pd.DataFrame({"query_id": asked.astype(np.int64), "vec_id": ids.astype(np.int64), "score": scores.astype(float)})

    return run


def _nearest_ids(c, norm, own, first, group, q, asked, k: int) -> list[tuple]:
    """(query, ids, distances) of each query's k nearest ids in a block. The
    product finds all that may be among them, within its rounding error."""
    near = norm[None] - 2 * q @ c.T
    by_id = np.minimum.reduceat(near, first, axis=1) if len(own) < len(group) else near
    mine = np.searchsorted(own, asked)
    here = np.flatnonzero((mine < len(own)) & (own[np.minimum(mine, len(own) - 1)] == asked))
    by_id = by_id.copy()
    by_id[here, mine[here]] = np.inf
    edge = np.partition(by_id, min(k, len(own)) - 1, axis=1)[:, min(k, len(own)) - 1]
    slip = 1e-12 * c.shape[1] * (norm.max() + (q * q).sum(1)) + 1e-300
    out = []
    for i, v in enumerate(q):
        at = np.flatnonzero((near[i] <= edge[i] + slip[i]) & (own[group] != asked[i]))
        if not len(at):
            continue
        d = np.sqrt(((c[at] - v) ** 2).sum(1))
        start = np.flatnonzero(np.r_[True, group[at][1:] != group[at][:-1]])
        d, ids = np.minimum.reduceat(d, start), own[group[at][start]]
        best = np.lexsort((ids, d))[:k]
        out.append((asked[i], ids[best], d[best]))
    return out


def search(vectors: DataFrame, is_query, k: int = 10, parts: int | None = None) -> DataFrame:
    """vectors (vec_id, embedding, …); is_query: a condition on vec_id →
    query_id, rank, vec_id, score (Euclidean distance). parts: parts_for the
    number of vectors, where not given."""
    spark = vectors.sparkSession
    scratch = Scratch(spark, "ann")
    fine = scratch.save(usable(vectors), "vectors")
    sample = fine.orderBy(F.xxhash64("vec_id", "embedding")).limit(SAMPLE).select("embedding").collect()
    if not sample:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    router, ask = learn(np.array([r.embedding for r in sample]), parts or parts_for(fine.count()), k)

    shape = "vec_id long, embedding array<double>, parts array<int>"
    base = scratch.save(fine.mapInPandas(_routed(router, 1), shape).select("vec_id", "embedding", F.col("parts")[0].alias("part")), "base")
    asked = scratch.save(fine.where(is_query).mapInPandas(_routed(router, ask), shape).select("vec_id", "embedding", F.explode("parts").alias("part")), "queries")
    # a row for each part: how many blocks of vectors and of queries it has
    plan = base.groupBy("part").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("nb"))
    plan = F.broadcast(plan.join(asked.groupBy("part").agg(F.ceil(F.count("*") / QUERY_BLOCK).cast("int").alias("nq")), "part"))
    spot = lambda n, seed: F.pmod(F.xxhash64("vec_id", F.lit(seed)), F.col(n).cast("long")).cast("int")
    left = base.join(plan, "part").select("vec_id", "embedding", "part", spot("nb", 1).alias("b"), F.explode(F.sequence(F.lit(0), F.col("nq") - 1)).alias("q"))
    right = asked.join(plan, "part").select("vec_id", "embedding", "part", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)).alias("b"), spot("nq", 2).alias("q"))
    near = left.groupBy("part", "b", "q").cogroup(right.groupBy("part", "b", "q")).applyInPandas(_compared(k), "query_id long, vec_id long, score double")
    best = near.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
