"""Wide-table joins, id mapping and dictionary lookups.

No side is broadcast by hint: Spark broadcasts what its statistics show to
be small, and adaptive execution splits skewed partitions of the rest.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.columns import col, hash_share, legal_id
from ..scratch import numbered

PARTNERS = 100


@dataclass
class FeatureTable:
    frame: DataFrame
    id_field: str
    join_field: str
    features: list[str]


def feature_collect(action: DataFrame, tables: list[FeatureTable], keep: list[str] | None = None, unique: bool = True) -> DataFrame:
    """The action table with each table's features, by left joins in order.
    unique: of several rows with one id only the first (by all its columns)
    counts, so rows of the action table never multiply."""
    for t in tables:
        if t.id_field not in t.frame.columns:
            raise ValueError(f"the feature table has no column {t.id_field}")
        right = t.frame.select(col(t.id_field).alias("_id"), *[col(f) for f in t.features]).where("_id is not null")
        if unique:
            right = right.groupBy("_id").agg(F.min(F.struct(*[col(f) for f in t.features])).alias("_f")).select("_id", "_f.*")
        action = action.join(right, col(t.join_field) == F.col("_id"), "left").drop("_id")
    return action.select(*[col(c) for c in keep]) if keep else action


def mapping_registry(spark: SparkSession, items: list[dict], read=None) -> dict[str, DataFrame]:
    """Id-mapping tables by their id, from entries {id, input}; entries without
    an id or input are left out, a repeated id is an error. read: how an input
    becomes a frame (parquet by default)."""
    read = read or spark.read.parquet
    out: dict[str, DataFrame] = {}
    for item in items:
        name, source = (str(item.get(k) or "").strip() for k in ("id", "input"))
        if not name or not source:
            continue
        if name in out:
            raise ValueError(f"two id mappings are named {name}")
        out[name] = read(source)
    return out


def pairs(mapping: DataFrame, from_id: str, to_id: str) -> DataFrame:
    """Legal pairs as strings."""
    return mapping.select(col(from_id).cast("string").alias("from_id"), col(to_id).cast("string").alias("to_id")).where(legal_id("from_id") & legal_id("to_id"))


def map_ids(df: DataFrame, id_col: str, mapping: DataFrame, from_id: str, to_id: str, name: str | None = None) -> DataFrame:
    """Rows with a partner, the id replaced by it (and renamed); several partners give several rows."""
    own = df.withColumn("_k", col(id_col).cast("string"))
    out = own.join(pairs(mapping, from_id, to_id), F.col("_k") == F.col("from_id")).drop("_k", "from_id", id_col)
    return out.withColumnRenamed("to_id", name or id_col)


def cut(mapping: DataFrame, from_id: str, to_id: str, limit: int = PARTNERS, on: str = "from_id") -> DataFrame:
    """Distinct pairs whose id on that side has under `limit` partners. Degrees
    are partial sums, so a hot id never gathers in one task."""
    distinct = pairs(mapping, from_id, to_id).distinct()
    few = distinct.groupBy(on).agg(F.count("*").alias("_n")).where(F.col("_n") < limit).drop("_n")
    return distinct.join(few, on, "left_semi")


def map_features(df: DataFrame, id_col: str, mapping: DataFrame, from_id: str, to_id: str, limit: int = PARTNERS, on: str = "from_id") -> DataFrame:
    """Features moved to the mapped id, by pairs that pass the cut on one side."""
    few = cut(mapping, from_id, to_id, limit, on)
    own = df.withColumn("_k", col(id_col).cast("string"))
    return own.join(few, F.col("_k") == F.col("from_id")).drop("_k", "from_id", id_col).withColumnRenamed("to_id", id_col)


def unseen(values: DataFrame, known: DataFrame, on: list[str]) -> DataFrame:
    return values.join(known.select(*on), on, "left_anti")


def lookup(df: DataFrame, value: str, dictionary: DataFrame, field: str) -> DataFrame:
    """The value replaced by its index in (field, value, idx), as a string; unknown ones stay."""
    own = dictionary.where(F.col("field") == field).select(F.col("value").alias("_v"), F.col("idx").alias("_i"))
    out = df.join(own, col(value) == F.col("_v"), "left")
    return out.withColumn(value, F.coalesce(F.col("_i").cast("string"), col(value))).drop("_v", "_i")


def with_field_rate(counts: DataFrame, field: str = "field", count: str = "cnt") -> DataFrame:
    """Each token's share of its field's count."""
    total = counts.groupBy(field).agg(F.sum(count).alias("_total"))
    return counts.join(total, field).withColumn("rate", col(count) / F.col("_total")).drop("_total")


def shuffle_column(df: DataFrame, column: str, name: str, order: list[str], seed: int = 36) -> DataFrame:
    """A column that holds another one's values in a random order, by a hash of
    the row's `order` columns, the same on any run. Rows are numbered by two
    distributed sorts; nothing gathers in one task."""
    left = numbered(df, order, "_index")
    mixed = df.select(col(column).alias(name), *[col(c).alias(f"_o{i}") for i, c in enumerate(order)])
    keys = [f"_o{i}" for i in range(len(order))]
    right = numbered(mixed, [hash_share(*keys, seed=seed), *keys], "_index").select("_index", col(name))
    return left.join(right, "_index").drop("_index")


def latest(df: DataFrame, key: list[str], order: str) -> DataFrame:
    """The newest row of each key."""
    rank = F.row_number().over(Window.partitionBy(*key).orderBy(col(order).desc()))
    return df.withColumn("_r", rank).where("_r = 1").drop("_r")
