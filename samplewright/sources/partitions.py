"""Choosing table partitions: names are p_yyyyMMdd."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import col
from ..functions.times import period_days

#: How many of the newest partitions a windowed load looks at.
NEWEST = 230


# What a cluster is taken to have where its settings don't say.
EXECUTORS, CORES, TIMES = 600, 4, 2


def parallelism(spark: SparkSession, times: int = TIMES) -> int:
    """Partitions for a load: executors by cores by `times`."""
    conf = spark.sparkContext.getConf()
    return int(conf.get("spark.executor.instances", str(EXECUTORS))) * int(conf.get("spark.executor.cores", str(CORES))) * times


def resolve(spec: str, today: str) -> list[str] | str:
    """`last` stays; `-1` is today's; others get the prefix p_."""
    if spec.strip() == "last":
        return "last"
    if spec.strip() == "-1":
        return [f"p_{today}"]
    return [p if p.startswith("p_") else f"p_{p}" for p in (x.strip() for x in spec.split(",")) if p]


def counts(df: DataFrame, part: str) -> DataFrame:
    return df.groupBy(col(part).alias("part")).agg(F.count("*").alias("rows"))


def latest(df: DataFrame, part: str, n: int = 1, skip: int = 0) -> DataFrame:
    """The n newest partitions that have rows, without `default`."""
    own = counts(df, part).where((F.col("part") != "default") & (F.col("rows") > 0))
    return own.orderBy(F.desc("part")).limit(n + skip).orderBy("part").limit(n) if skip else own.orderBy(F.desc("part")).limit(n)


def latest_until(df: DataFrame, part: str, day: str) -> str | None:
    """The newest partition up to a day, in one aggregation."""
    return df.where(col(part) <= day).agg(F.max(part)).head()[0]


def outside(part: Column | str, ranges: list[tuple[str, str]]) -> Column:
    """Whether a partition lies outside every range; without ranges all do."""
    out = F.lit(True)
    for lo, hi in ranges:
        out = out & ~col(part).between(lo, hi)
    return out


def in_window(part: Column | str, day: str, unit: int, n: int, step: int = 3) -> Column:
    """(day - (n+1)·unit·step, day - n·unit·step]"""
    return (col(part) > period_days(day, -(n + 1) * unit * step)) & (col(part) <= period_days(day, -n * unit * step))


def window_days(days: DataFrame, part: str, day: str, unit: int, n: int, step: int = 3) -> DataFrame:
    """The newest `unit` partitions of a window, of the NEWEST last ones."""
    newest = days.select(col(part).alias("part")).distinct().orderBy(F.desc("part")).limit(NEWEST)
    return newest.where(in_window("part", day, unit, n, step)).orderBy(F.desc("part")).limit(unit)


def load(df: DataFrame, part: str, spec: str, today: str) -> DataFrame:
    """The partitions that a spec names; the filter is pruned by the scan."""
    wanted = resolve(spec, today)
    if wanted == "last":
        newest = latest(df.select(part), part).head()
        wanted = [newest["part"]] if newest else []
    return df.where(col(part).isin(*wanted)) if wanted else df.limit(0)


def newest(df: DataFrame, part: str, periods: int, unit: str = "day") -> DataFrame:
    """Rows of the newest `periods` days or months that have any."""
    period = F.substring(part, 3, 8 if unit == "day" else 6)
    own = df.where(col(part) != "default").withColumn("_period", period)
    last = own.select("_period").distinct().orderBy(F.desc("_period")).limit(periods)
    return own.join(F.broadcast(last), "_period", "left_semi").drop("_period")  # a row for each period


def exists(df: DataFrame, part: str, value: str) -> bool:
    return df.where(col(part) == value).limit(1).count() > 0


def keyed(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    unknown = [c for c in [key, *columns] if c not in df.columns]
    if unknown:
        raise ValueError(f"unknown columns {unknown}")
    return df.select(col(key).alias("key"), F.array(*[col(c).cast("string") for c in columns]).alias("values"))
