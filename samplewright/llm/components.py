"""Connected components by alternating large-star and small-star rounds.

Each round is one aggregation by node; labels never gather on the driver, and
a node of very many edges only costs rows (its minimum is aggregated first).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .sparkio import Scratch

ROUNDS = 60


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """edges (a, b), a > b. Connects each node's larger (or smaller) neighbours, or itself, to its least one."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if large:
        both = both.unionAll(edges.select(F.col("b"), F.col("a")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    joined = both.join(least, "u")
    if large:
        out = joined.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        out = joined.select(F.col("v").alias("a"), F.col("m").alias("b"))
    own = least.select(F.col("u").alias("a"), F.col("m").alias("b"))
    return out.unionAll(own).where("a > b").distinct()


def components(edges: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(node, label): the least node of each node's component. edges (a, b) of two different nodes, in any direction."""
    now = scratch.save(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b").distinct(), f"{name}-0")
    before = None
    for i in range(1, ROUNDS):
        step = scratch.save(_star(_star(now, True), False), f"{name}-{i}")
        # done when every node hangs on one root that hangs on nothing
        state = (step.count(), step.agg(F.sum(F.xxhash64("a", "b") % (1 << 40))).head()[0])
        if i > 1:
            scratch.drop(f"{name}-{i - 1}")
        now = step
        if state == before:
            break
        before = state
    else:
        raise RuntimeError(f"components of {name} still change after {ROUNDS - 1} rounds")
    labels = now.select(F.col("a").alias("node"), F.col("b").alias("label"))
    return labels.unionAll(labels.select(F.col("label").alias("node"), "label").distinct())
