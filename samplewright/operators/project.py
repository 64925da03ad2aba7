"""Selecting, renaming, parsing and filtering of feature columns."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import col, label_at_least, multi_values, zero_if_missing

TYPES = {"str": T.StringType(), "string": T.StringType(), "int": T.IntegerType(), "float": T.FloatType(), "double": T.DoubleType(), "long": T.LongType()}


def select_features(df: DataFrame, wanted: list[str], configured: list[str], ids: list[str]) -> DataFrame:
    """Ids and those wanted features that are configured, in the wanted order."""
    missing = [c for c in ids if c not in df.columns]
    if missing:
        raise ValueError(f"id columns are missing: {missing}")
    return df.select(*ids, *[c for c in wanted if c in configured and c in df.columns and c not in ids])


def rename(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(names)


def drop_columns(df: DataFrame, names: list[str]) -> DataFrame:
    return df.drop(*names)


def nulls_to_zero(df: DataFrame, names: list[str] | None = None) -> DataFrame:
    """0 for null in numeric columns, '0' in strings; types stay."""
    names = names or df.columns
    return df.withColumns({n: zero_if_missing(n, df.schema[n].dataType.simpleString()) for n in names})


def add_label(df: DataFrame, source: str, threshold, name: str = "label") -> DataFrame:
    return df.withColumn(name, label_at_least(source, threshold))


def parse_typed(df: DataFrame, text: str, delimiter: str, names: list[str], kinds: list[str], strict: bool = True) -> DataFrame:
    """Columns from a delimited string, trimmed and cast. strict: a value that
    doesn't parse is an error; else it is null."""
    unknown = set(kinds) - set(TYPES)
    if unknown or len(names) != len(kinds):
        raise ValueError(f"unknown types {unknown}" if unknown else "as many types as names are needed")
    parts = F.split(col(text), re.escape(delimiter))
    value = lambda i, k: F.trim(F.get(parts, F.lit(i))).cast(TYPES[k]) if strict else F.trim(F.get(parts, F.lit(i))).try_cast(TYPES[k])
    return df.select(*[value(i, k).alias(n) for i, (n, k) in enumerate(zip(names, kinds, strict=True))])


def min_fields(df: DataFrame, text: str, least: int, delimiter: str = ",") -> DataFrame:
    """Lines of at least so many fields, empty ones at the end not counted."""
    trimmed = F.regexp_replace(col(text), f"({re.escape(delimiter)})+$", "")
    return df.where(F.size(F.split(trimmed, re.escape(delimiter))) >= least)


def drop_first(df: DataFrame, n: int = 2) -> DataFrame:
    return df.select(*[col(c) for c in df.columns[n:]])


def token_count_between(df: DataFrame, tokens: str, least: int = 3, below: int = 30, id_col: str | None = None) -> DataFrame:
    """Rows with least <= tokens < below and, with id_col, an id that isn't '-1'."""
    out = df.where(F.size(multi_values(tokens)).between(least, below - 1))
    return out.where(F.coalesce(col(id_col).cast("string") != "-1", F.lit(False))) if id_col else out


def frequency_band(df: DataFrame, count: str, least: int = 10_000, most: int = 10_000_000) -> DataFrame:
    return df.where(col(count).between(least, most))


def run_sql(query: str, **frames: DataFrame) -> DataFrame:
    """Any SQL over named frames, without names shared by the session: {name} stands for a frame."""
    if not frames:
        raise ValueError("at least one frame is needed")
    return next(iter(frames.values())).sparkSession.sql(query, **frames)
