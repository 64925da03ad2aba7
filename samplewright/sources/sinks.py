"""Writers."""

from __future__ import annotations

import io
import zipfile

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..scratch import Scratch, filesystem

SMALL, FEW_FILES, MANY_FILES = 10_000_000, 50, 300


def save(df: DataFrame, path: str, kind: str = "text", mode: str = "overwrite", delimiter: str = ",") -> None:
    if kind == "text":
        df.write.mode(mode).option("sep", delimiter).option("emptyValue", "").csv(path)
    elif kind == "lines":
        df.select(F.col(df.columns[0]).cast("string")).write.mode(mode).text(path)
    elif kind == "parquet":
        df.write.mode(mode).parquet(path)
    elif kind in ("tfrecord", "lpb"):
        from .records import write_records

        write_records(df, path, kind, mode)
    else:
        raise ValueError(f"unknown kind {kind!r}")


def save_splits(df: DataFrame, root: str, when: str, kinds: list[str], split: str = "split") -> list[str]:
    """{root}{when}{split}_{kind} for each of the splits train, val and test.
    The rows are written once by split, so what they come from is read once."""
    stored = Scratch(df.sparkSession, "splits").save(df, "rows")
    paths = []
    for kind in kinds:
        for name in ("train", "val", "test"):
            paths.append(f"{root}{when}{name}_{kind}")
            save(stored.where(F.col(split) == name).drop(split), paths[-1], kind)
    return paths


def save_partition(df: DataFrame, path: str, part: str, rows: int | None = None) -> None:
    """Replaces only the partitions that df has; about as many files as the rows need."""
    if rows is not None:
        df = df.coalesce(FEW_FILES if rows < SMALL else MANY_FILES)
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(part).parquet(path)


def remove(spark, path: str) -> None:
    fs, where = filesystem(spark, path)
    fs.delete(where, True)


def mark_done(spark, path: str, done: bool = True) -> None:
    """Sets or clears {path}/_SUCCESS."""
    fs, where = filesystem(spark, f"{path}/_SUCCESS")
    if done:
        fs.create(where, True).close()
    else:
        fs.delete(where, False)


def save_zip(df: DataFrame, folder: str, mode: str = "overwrite") -> None:
    """One zip with one entry for each partition: the records of the first column, one after another."""
    from .records import write_records

    write_records(df, folder, "zip", mode)


def load_zip(spark, folder: str) -> DataFrame:
    """(name string, content binary) of the entries of all zips in a folder, on any filesystem."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").load(folder).select("content")

    def run(batches):
        for b in batches:
            for c in b.column("content"):
                with zipfile.ZipFile(io.BytesIO(c.as_py())) as z:
                    entries = [(n, z.read(n)) for n in z.namelist()]
                yield pa.RecordBatch.from_arrays([pa.array([n for n, _ in entries], pa.string()), pa.array([x for _, x in entries], pa.binary())], names=["name", "content"])

    return files.mapInArrow(run, "name string, content binary")
