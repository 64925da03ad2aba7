"""Written tables that cut lineage, in the folder that the whole cluster shares,
and row numbers that are made without leaving the JVM."""

from __future__ import annotations

import atexit
import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of an Arrow batch while a table is written: whole texts are long rows.
ARROW, ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", 1000
#: Hadoop's local file system starts a process to set the mode of each folder, file and checksum, which
#: stands for a second JVM until it is under way. Without checksums a task's file costs two, not three.
LOCAL, RAW = "fs.file.impl", {"fs.file.impl": "org.apache.hadoop.fs.RawLocalFileSystem", "fs.file.impl.disable.cache": "true"}
#: Nobody looks for the marker of a finished table: the driver reads it when its write has returned.
UNMARKED = {"mapreduce.fileoutputcommitter.marksuccessfuljobs": "false"}
#: Row numbers within a partition, in monotonically_increasing_id.
PLACE_BITS = 33


def scratch_root(spark: SparkSession) -> str:
    """The cluster's spark.checkpoint.dir; a temporary folder only on a local
    master, whose tasks all run on this machine."""
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="samplewright-"))
        root = sc.getCheckpointDir()
    return root


def filesystem(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def delete(spark: SparkSession, path: str) -> None:
    fs, where = filesystem(spark, path)
    fs.delete(where, True)


def write_small(spark: SparkSession, path: str, text: str | bytes) -> None:
    """A small file, there as a whole or not at all."""
    fs, where = filesystem(spark, path)
    _, side = filesystem(spark, f"{path}.{uuid.uuid4().hex}")
    out = fs.create(side, True)
    out.write(bytearray(text.encode() if isinstance(text, str) else text))
    out.close()
    fs.delete(where, False)
    if not fs.rename(side, where):
        raise OSError(f"could not write {path}")


def read_small(spark: SparkSession, path: str) -> str:
    return spark.read.text(path, wholetext=True).head()[0]


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark's cleaner delete shuffle files of plans that are done."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


class Scratch:
    """Written tables of one operator run. They cut lineage: a lost executor
    costs a re-read, not the whole plan. `drop` frees one early; what is left
    goes when the driver ends."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.root = f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"
        atexit.register(self.clear)

    def save(self, df: DataFrame, name: str) -> DataFrame:
        path, before = f"{self.root}/{name}", self.spark.conf.get(ARROW)
        try:
            self.spark.conf.set(ARROW, str(min(int(before), ARROW_ROWS)))
            own = self.spark.sparkContext._jsc.hadoopConfiguration().get(LOCAL)
            df.write.mode("overwrite").options(**UNMARKED, **({} if own else RAW)).parquet(path)
        finally:
            self.spark.conf.set(ARROW, before)
        free_shuffles(self.spark)
        return self.spark.read.schema(df.schema).parquet(path)

    def finish(self, df: DataFrame, name: str = "result") -> DataFrame:
        """A run's result, written; everything else that the run has written goes."""
        out = self.save(df, name)
        fs, root = filesystem(self.spark, self.root)
        for other in fs.listStatus(root):
            if other.getPath().getName() != name:
                fs.delete(other.getPath(), True)
        return out

    def drop(self, name: str) -> None:
        delete(self.spark, f"{self.root}/{name}")

    def clear(self) -> None:
        try:
            delete(self.spark, self.root)
        except Exception:  # the JVM may be gone at exit; nothing is left to free then
            pass


def numbered(df: DataFrame, order: list, name: str = "idx", start: int = 0) -> DataFrame:
    """Rows numbered in the order of `order`, from `start`: sorted by ranges and
    written, counted by range, and numbered within ranges. No task holds all
    rows and none of them leaves the JVM; the driver sees one count for each range."""
    scratch = Scratch(df.sparkSession, "numbered")
    place = F.monotonically_increasing_id()
    rows = scratch.save(df.orderBy(*order).withColumn("_place", place), "rows")
    part = F.shiftright("_place", PLACE_BITS)
    counts = rows.groupBy(part.alias("p")).agg(F.count("*").alias("n")).collect()
    before, at = [], start
    for c in sorted(counts, key=lambda r: r.p):
        before.append((c.p, at))
        at += c.n
    first = df.sparkSession.createDataFrame(before, "_p long, _first long")
    within = F.col("_place").bitwiseAND(F.lit((1 << PLACE_BITS) - 1))
    return rows.join(F.broadcast(first), part == F.col("_p")).select(*[F.col(f"`{c}`") for c in df.columns], (F.col("_first") + within).alias(name))
