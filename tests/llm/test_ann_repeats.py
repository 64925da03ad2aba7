import numpy as np
import pytest
from pyspark.sql import functions as F

from samplewright.llm import ann


@pytest.mark.parametrize("copies", [2, 12])
def test_repeated_ids_count_once(spark, copies):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(60, 6))
    rows = [(i, [float(v) for v in x[i] + (0.01 * c if i % 2 else 0)]) for i in range(60) for c in range(copies)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    out = ann.search(df, F.col("vec_id") % 10 == 0, parts=1).collect()
    for q in range(0, 60, 10):
        least = {}
        for i, v in rows:
            if i != q:
                least[i] = min(least.get(i, np.inf), float(np.sqrt(((np.array(v) - x[q]) ** 2).sum())))
        want = sorted((s, i) for i, s in least.items())[:10]
        got = sorted((r["rank"], r.vec_id, r.score) for r in out if r.query_id == q)
        assert [g[:2] for g in got] == [(n + 1, i) for n, (_, i) in enumerate(want)]
        assert [g[2] for g in got] == pytest.approx([s for s, _ in want])
