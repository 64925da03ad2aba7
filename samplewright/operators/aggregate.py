"""Distributions, frequencies, pivot and prefix sums."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import MISSING, col, multi_values
from ..scratch import Scratch

#: Sections that prefix sums of one group are cut into.
SECTIONS = 64


def melt(df: DataFrame, ids: list[str], columns: list[str], field: str = "feature", value: str = "value", kind: str = "double") -> DataFrame:
    typed = df.select(*[col(i) for i in ids], *[col(c).cast(kind).alias(c) for c in columns])
    return typed.unpivot(ids, columns, field, value)


def distribution(df: DataFrame, columns: list[str], kind: str = "float") -> DataFrame:
    """(feature, v, c) of non-zero, non-null values; one pass over all columns."""
    long = melt(df, [], columns, "feature", "v", kind)
    return long.where("v is not null and v <> 0").groupBy("feature", "v").agg(F.count("*").alias("c"))


def stored(dist: DataFrame) -> DataFrame:
    """A distribution that several sums are taken of: written once, so what it comes from is read once."""
    return Scratch(dist.sparkSession, "distribution").save(dist, "values")


def extremes(dist: DataFrame) -> DataFrame:
    return dist.groupBy("feature").agg(F.min("v").alias("lo"), F.max("v").alias("hi"), F.sum("c").alias("n"), F.count("*").alias("n_distinct"))


def running(df: DataFrame, group: str, order: str, value: str) -> DataFrame:
    """df with `i` (place in the group by `order`, from 1), `cum` (running sum of
    `value`) and `tot`. Groups are cut into sections at approximate quantiles;
    sums run within sections and over the few sections of a group, so a group
    of any size is spread over tasks. Sections only need to be in order, so
    the result is exact."""
    shares = [(k + 1) / SECTIONS for k in range(SECTIONS - 1)]
    edges = df.groupBy(group).agg(F.percentile_approx(order, shares, 1000).alias("_e"))
    cut = df.join(edges, group).withColumn("_s", F.size(F.filter("_e", lambda e: e < col(order)))).drop("_e")
    parts = cut.groupBy(group, "_s").agg(F.count("*").alias("_n"), F.sum(value).alias("_v"))
    before = Window.partitionBy(group).orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(group, "_s", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_n0"), F.coalesce(F.sum("_v").over(before), F.lit(0)).alias("_v0"), F.sum("_v").over(Window.partitionBy(group)).alias("tot"))
    inside = Window.partitionBy(group, "_s").orderBy(order)
    up_to = inside.rowsBetween(Window.unboundedPreceding, 0)
    out = cut.join(parts, [group, "_s"])
    return out.withColumns({"i": F.col("_n0") + F.row_number().over(inside), "cum": F.col("_v0") + F.sum(value).over(up_to)}).drop("_s", "_n0", "_v0")


def token_frequency(df: DataFrame, field: str, tokens: str) -> DataFrame:
    each = df.select(col(field).alias("field"), F.explode(multi_values(tokens)).alias("token"))
    return each.groupBy("field", "token").agg(F.count("*").alias("cnt"))


def label_histogram(df: DataFrame, label: str) -> DataFrame:
    return df.groupBy(col(label).alias("label")).agg(F.count("*").alias("cnt"))


def pivot_extend(df: DataFrame, key: str, field: str, values: list[str], order: str | None = None) -> DataFrame:
    """One row for each key; for each listed value, every other column as
    `{value}_{column}`, a string. A value without rows gives '-1'; a null cell
    of a row stays null. Of several rows the last by `order` counts (by
    default by all columns). One aggregation, with the values known."""
    others = [c for c in df.columns if c not in (key, field)]
    rank = F.struct(*[col(c) for c in ([order] if order else others)])
    picks = []
    for v in values:
        mine = col(field).cast("string") == str(v)
        last = F.max(F.when(mine, F.struct(rank.alias("r"), F.struct(*[col(c).cast("string").alias(c) for c in others]).alias("s"))))
        picks.append(last.alias(f"_{v}"))
    wide = df.groupBy(key).agg(*picks)
    cells = [F.when(F.col(f"`_{v}`").isNull(), MISSING).otherwise(F.col(f"`_{v}`.s.`{c}`")).alias(f"{v}_{c}") for v in values for c in others]
    return wide.select(*cells, col(key))
