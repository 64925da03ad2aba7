import random
from collections import Counter

import corpus_pipeline as P


def test_rows_with_one_id_are_told_apart(spark, tmp_path):
    rng = random.Random(11)
    text = lambda n: " ".join(f"w{rng.randrange(300)}" for _ in range(n))
    a, b, c, d, e, bench = text(80), text(80), text(80), text(80), text(80), text(30)
    near, bad = a + " extra", text(20) + " " + bench + " " + text(20)
    spark.createDataFrame([(1, bench)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    rows = [(None, b), (None, c), (None, bad), (1, a), (7, near), (7, d), (7, d), (8, e), (8, bad + " more " + text(60))]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    left = lambda df: Counter((r.doc_id, r.text) for r in df.collect())
    once = P.near_duplicates(spark, docs, str(tmp_path))
    assert once.columns == P.COLUMNS and left(once) == Counter({*rows} - {(7, near)})
    clean = P.decontaminated(spark, docs, str(tmp_path))
    assert clean.columns == P.COLUMNS and left(clean) == Counter(r for r in rows if bench not in r[1])
