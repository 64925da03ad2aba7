"""Stratified sampling and splitting."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import col, hash_share
from . import aggregate as A

SEED = 36


def by_group(df: DataFrame, key: str, fractions: dict, seed: int = SEED) -> DataFrame:
    """Of each value of the key a share of the rows, chosen by a hash of the whole row, so
    any run keeps the same; values without a fraction go."""
    rates = df.sparkSession.createDataFrame([(k, float(f)) for k, f in fractions.items()], T.StructType([df.schema[key], T.StructField("_rate", T.DoubleType())]))
    return _kept(df, rates.withColumnRenamed(key, "_k").withColumnRenamed("_rate", "fraction"), key, seed)


def _kept(df: DataFrame, rate: DataFrame, key: str, seed: int) -> DataFrame:
    own = df.withColumn("_share", hash_share(*df.columns, seed=seed))
    return own.join(rate, col(key).eqNullSafe(F.col("_k"))).where(F.col("_share") < F.col("fraction")).drop("_k", "fraction", "_share")


def fractions(df: DataFrame, key: str, n: int) -> DataFrame:
    """(label, cnt, fraction): 1 where the group has fewer than n rows, else n / cnt."""
    return A.label_histogram(df, key).withColumn("fraction", F.when(F.col("cnt") < n, 1.0).otherwise(F.lit(float(n)) / F.col("cnt")))


def by_num(df: DataFrame, key: str, n: int, seed: int = SEED) -> DataFrame:
    """About n rows of each value of the key, chosen by a hash of the whole row.
    Fractions join as a table: any number of values."""
    return _kept(df, fractions(df, key, n).select(F.col("label").alias("_k"), "fraction"), key, seed)


def by_field(df: DataFrame, key: str, value, times: float, seed: int = SEED) -> DataFrame:
    """Every group cut to `times` the rows that have the given value."""
    n = df.where(col(key) == F.lit(value)).count()
    if not n:
        raise ValueError(f"no row has {key} = {value!r}")
    return by_num(df, key, max(int(n * times), 1), seed)


def random_split(df: DataFrame, weights: list[float], seed: int = SEED) -> list[DataFrame]:
    return df.randomSplit(weights, seed)


def hash_split(df: DataFrame, keys: list[str], names: list[str], weights: list[float], seed: int = SEED, column: str = "split") -> DataFrame:
    """A column with each row's split; rows with the same keys stay together, on any run."""
    share = hash_share(*keys, seed=seed)
    total, at, out = sum(weights), 0.0, None
    for name, w in list(zip(names, weights, strict=True))[:-1]:
        at += w / total
        out = F.when(share < at, name) if out is None else out.when(share < at, name)
    return df.withColumn(column, F.lit(names[-1]) if out is None else out.otherwise(names[-1]))


def experiments(df: DataFrame, key: str, split_field: str, specs: list[dict]) -> DataFrame:
    """One row for each experiment that a row falls into: specs name, rate
    (0.25), positive and negative values of the split field; label 1 or 0."""
    parts = []
    for s in specs:
        inside = df.where(hash_share(key, seed=s.get("seed", SEED)) < s.get("rate", 0.25))
        label = F.when(col(split_field).isin(*s["positive"]), 1).when(col(split_field).isin(*s["negative"]), 0)
        parts.append(inside.withColumn("experiment", F.lit(s["name"])).withColumn("label", label).where("label is not null"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
