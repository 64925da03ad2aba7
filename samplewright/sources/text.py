"""Delimited text, date ranges of paths, whole files."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..functions.times import days_between
from ..scratch import filesystem, read_small


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = filesystem(spark, path)
    found = fs.globStatus(where)
    return found is not None and len(found) > 0


def expand_dates(part: str) -> list[str]:
    """`a-b` of two days: all days between; else the text itself."""
    a, dash, b = part.partition("-")
    if dash and a.isdigit() and b.isdigit() and len(a) == len(b) == 8:
        return days_between(a, b)
    return [part]


def date_paths(root: str, spec: str) -> list[str]:
    return [f"{root.rstrip('/')}/{d}" for part in spec.split(",") for d in expand_dates(part.strip())]


def present(spark: SparkSession, paths: list[str], required: bool = False) -> list[str]:
    found = [p for p in paths if exists(spark, p)]
    if required and len(found) < len(paths):
        raise FileNotFoundError(sorted(set(paths) - set(found)))
    return found


def string_schema(fields: list[str]) -> T.StructType:
    return T.StructType([T.StructField(f, T.StringType()) for f in fields])


def load_text(spark: SparkSession, paths: list[str], fields: list[str], delimiter: str = ",") -> DataFrame:
    """All columns as strings, in one scan of all paths that are there."""
    schema, found = string_schema(fields), present(spark, paths)
    if not found:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("sep", delimiter).csv(found)


def load(spark: SparkSession, kind: str, paths: list[str], allow_missing: bool = True, schema: str | T.StructType | None = None, strict: bool = True) -> DataFrame:
    """text: (value string); whole: (path, content) of non-empty files; records:
    (path, record) of length-prefixed files; tfrecord: examples by `schema`;
    sequence: (key, value) of sequence files; parquet (by `schema`, where nothing is there)."""
    found = present(spark, paths, required=not allow_missing)
    empty = {"text": "value string", "whole": "path string, content binary", "records": "path string, record binary", "sequence": "key string, value string"}
    if kind not in {*empty, "tfrecord", "parquet"}:
        raise ValueError(f"unknown kind {kind!r}")
    if kind == "tfrecord" and schema is None:
        raise ValueError("tfrecord needs a schema")
    if not found:
        shape = empty.get(kind, schema)
        if shape is None:
            raise FileNotFoundError(f"none of {paths} is there, and no schema says what an empty table would hold")
        return spark.createDataFrame([], shape)
    if kind == "text":
        return spark.read.text(found)
    if kind == "whole":
        return spark.read.format("binaryFile").load(found).where("length > 0").select("path", "content")
    if kind in ("records", "tfrecord"):
        from .records import read_lpb, read_tfrecord

        return read_lpb(spark, found, strict) if kind == "records" else read_tfrecord(spark, found, schema, strict)
    if kind == "sequence":
        return spark.createDataFrame(spark.sparkContext.union([spark.sparkContext.sequenceFile(p) for p in found]).map(lambda r: (str(r[0]), str(r[1]))), "key string, value string")
    return spark.read.parquet(*found)


def wait_ready(spark: SparkSession, glob: str, count: int, timeout_s: float, every_s: float = 10.0) -> bool:
    """Whether `count` finished paths match within the time; temporary ones don't count."""
    end = time.monotonic() + timeout_s
    while True:
        fs, where = filesystem(spark, glob)
        names = [str(s.getPath().toString()) for s in fs.globStatus(where) or []]
        if sum("_temporary" not in n and not n.endswith(".tmp") for n in names) >= count:
            return True
        if time.monotonic() >= end:
            return False
        time.sleep(min(every_s, max(end - time.monotonic(), 0)))


def read_config(spark: SparkSession, path: str) -> str:
    """A small file's text, from any filesystem that Spark reads."""
    return read_small(spark, path)
