import os
import subprocess
import sys

from samplewright.llm import line_dedup
from samplewright.llm.sparkio import Scratch, reduced, tasks_for

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
WRITES = """
import sys
from pyspark.sql import SparkSession
from samplewright.scratch import Scratch
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.checkpoint.dir", sys.argv[1]).getOrCreate()
made = Scratch(spark, "few").save(spark.range(0, 30, 1, 3), "rows")
assert sorted(r.id for r in made.collect()) == list(range(30)) and len(made.inputFiles()) == 3
"""


def test_only_files_that_are_read_cost_a_process(tmp_path):
    """Hadoop runs chmod from the PATH; a script of that name there counts."""
    script, log = tmp_path / "bin" / "chmod", tmp_path / "log"
    script.parent.mkdir()
    script.write_text(f'#!/bin/sh\necho "$@" >> {log}\nexec /bin/chmod "$@"\n')
    script.chmod(0o755)
    env = os.environ | {"PATH": f"{script.parent}:{os.environ['PATH']}", "PYTHONPATH": f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"}
    subprocess.run([sys.executable, "-c", WRITES, f"file://{tmp_path}/shared"], env=env, check=True, timeout=120)
    ran = [x for x in (log.read_text().splitlines() if log.exists() else []) if x.endswith((".parquet", ".crc", "_SUCCESS"))]
    assert len(ran) <= 3, ran


def test_buckets_of_a_small_table_share_tasks(spark):
    docs = [(i, f"own {i}\nshared {i % 7}\nshared too {i % 7}\nown again {i}") for i in range(60)]
    df = Scratch(spark, "docs").save(spark.createDataFrame(docs, "doc_id long, text string"), "docs")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        assert tasks_for(df, 64) == spark.sparkContext.defaultParallelism < 64
        scratch, files = Scratch(spark, "shared"), []
        save = Scratch.save
        Scratch.save = lambda self, out, name: files.append((name, len((made := save(self, out, name)).inputFiles()))) or made
        try:
            kept = {r.doc_id: r.kept for r in line_dedup.dedup_lines(df, runs=True).collect()}
        finally:
            Scratch.save = save
        # each bucket is still reduced alone
        rows = spark.range(640).selectExpr("cast(id % 64 as int) bucket", "id")
        alone = scratch.save(reduced(rows, 64, _buckets, "n int, ids int", 4), "alone").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert {n for name, n in files if name.endswith("-groups")} <= set(range(spark.sparkContext.defaultParallelism + 1)), files
    assert kept == {i: t if i < 7 else f"own {i}\nown again {i}" for i, t in docs}
    assert sorted((r.n, r.ids) for r in alone) == [(1, 10)] * 64


def _buckets(batches):
    import pyarrow as pa

    whole = pa.Table.from_batches(list(batches))
    seen = len(set(whole.column("bucket").to_pylist()))
    yield pa.RecordBatch.from_pydict({"n": pa.array([seen], pa.int32()), "ids": pa.array([whole.num_rows], pa.int32())})
