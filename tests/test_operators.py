import random
from bisect import bisect_left

import pytest
from pyspark.sql import functions as F

from samplewright.functions import columns as C
from samplewright.operators import aggregate as A
from samplewright.operators import discretize as D
from samplewright.operators import encode as E
from samplewright.operators import join as J
from samplewright.operators import pretrain as P
from samplewright.operators import project, sample


def greedy(values, num):
    counts = {}
    for v in values:
        counts[v] = counts.get(v, 0) + 1
    width, out, c = len(values) // num, [], 0
    for v in sorted(counts):
        c += counts[v]
        if len(out) < num - 1 and c >= (len(out) + 1) * width:
            out.append(v)
    return out


def test_equal_counts_match_the_greedy_walk(spark):
    rng = random.Random(1)
    cases = {f"f{i}": [float(rng.randint(1, rng.choice([2, 9, 300]))) for _ in range(rng.choice([1, 3, 8, 60, 700]))] for i in range(12)}
    cases["heavy"] = [5.0] * 90 + [float(i) for i in range(10, 30)]
    dist = spark.createDataFrame([(f, v) for f, vs in cases.items() for v in vs], "feature string, v float").groupBy("feature", "v").agg(F.count("*").alias("c"))
    for num in (2, 4, 10, 1000):
        got = {r.feature: list(r.boundaries) for r in D.equi_freq(dist, num).collect()}
        assert got == {f: greedy(vs, num) for f, vs in cases.items() if greedy(vs, num)}


def test_bins_are_right_closed_and_floats_stay_32_bit(spark):
    bounds = [0.1, 2.0, 7.0]
    xs = [0.0, 0.05, 2.0, 2.1, 7.0, 8.0]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    b = spark.createDataFrame([("x", bounds)], D.BOUNDS)
    assert [r.x for r in D.apply(df, b, ["x"], "plain").collect()] == [bisect_left(bounds, x) for x in xs]
    tenth = spark.createDataFrame([(0.1,)], "x double")
    assert D.apply(tenth, b, ["x"], "plain").head().x == 0  # 0.1 is below the 32-bit 0.1


def test_missing_values_by_rule(spark):
    rows = ["", " 1.5 ", "abc", "-3", "1.2.3", "7", "0", "NaN", None]
    df = spark.createDataFrame([(r,) for r in rows], "x string")
    b = spark.createDataFrame([("x", [1.0, 5.0])], D.BOUNDS)
    assert [r.x for r in D.apply(df, b, ["x"], "zero_based").collect()] == [-1, -1, -1, -1, -1, 2, 0, -1, -1]
    assert [r.x for r in D.apply(df, b, ["x"], "keyed").collect()] == [None, 1, None, None, None, 2, 0, 2, None]
    assert [r.x for r in D.apply(df, b, ["x"], "or_raw").collect()] == ["", "1", "abc", "0", "1.2.3", "2", "0", "2", None]
    none = spark.createDataFrame([], D.BOUNDS)
    assert [r.x for r in D.apply(df.where("x = '7'"), none, ["x"], "zero_based").collect()] == [-1]


def test_empty_distributions_and_saved_bounds(spark, tmp_path):
    df = spark.createDataFrame([(0.0, None), (0.0, None)], "a double, b double")
    assert D.learn(df, ["a", "b"]).count() == 0
    b = spark.createDataFrame([("x", [1.0, 2.5]), ("y", [4.0])], D.BOUNDS)
    D.save_bounds(b, str(tmp_path / "b"))
    assert {r.feature: r.boundaries for r in D.load_bounds(spark, str(tmp_path / "b")).collect()} == {"x": [1.0, 2.5], "y": [4.0]}


def test_dictionaries_grow(spark):
    df = spark.createDataFrame([("a", "1"), ("b,c", "2_3"), ("a", None)], "x string, y string")
    first = E.encode_learn(df.limit(0), ["x", "y"])
    assert first.count() == 0
    d = E.encode_learn(df, ["x", "y"], first)
    assert sorted((r.idx, r.field, r.value) for r in d.collect()) == [(0, "x", "a"), (1, "x", "b,c"), (2, "y", "1"), (3, "y", "2_3")]
    one = d.where("idx = 0")
    again = E.encode_learn(df, ["x", "y"], one)
    assert sorted(r.idx for r in again.collect()) == [0, 1, 2, 3]
    more = spark.createDataFrame([("zz", "1")], "x string, y string")
    assert sorted(tuple(r) for r in E.encode_apply(more, ["x", "y"], d).collect()) == [("zz", "2")]


def test_pivot_tells_missing_from_null(spark):
    df = spark.createDataFrame([("k", "a", 1, None), ("k", "a", 0, "q"), ("m", "b", None, "z"), ("m", "c", 5, "z")], "key string, f string, n int, s string")
    rows = {r.key: r.asDict() for r in A.pivot_extend(df, "key", "f", ["a", "b"]).collect()}
    assert rows["k"] == {"a_n": "1", "a_s": None, "b_n": "-1", "b_s": "-1", "key": "k"}
    assert rows["m"]["b_n"] is None and rows["m"]["b_s"] == "z" and rows["m"]["a_s"] == "-1"


def test_id_mapping(spark):
    pairs = [("a", "0"), ("a", None), ("b", "x"), ("b", "x"), (None, "y")] + [("hot", f"t{i}") for i in range(100)] + [("warm", f"t{i}") for i in range(99)]
    m = spark.createDataFrame(pairs, "f string, t string")
    kept = {(r.from_id, r.to_id) for r in J.cut(m, "f", "t").collect()}
    assert ("b", "x") in kept and len(kept) == 100 and not any(f == "hot" for f, _ in kept)
    df = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "f string, v int")
    assert {(r.f, r.v) for r in J.map_ids(df, "f", m, "f", "t").collect()} == {("x", 2)}


def test_wide_join_never_multiplies_rows(spark):
    action = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (4, "q")], "id int, k string")
    feature = spark.createDataFrame([("a", 5), ("a", 4), ("b", 7), (None, 9)], "k string, v int")
    out = J.feature_collect(action, [J.FeatureTable(feature, "k", "k", ["v"])], ["id", "v"])
    assert sorted((r.id, r.v) for r in out.collect()) == [(1, 4), (2, 7), (3, None), (4, None)]


def test_libsvm(spark):
    df = spark.createDataFrame([(1, "x", "a_b", "0"), (2, "y", "", "3"), (3, "z", None, "0.0")], "i int, l string, p string, q string")
    index = E.libsvm_index(df, ["p", "q"])
    assert sorted(r.value for r in E.libsvm_map(index).collect()) == ["c0_a_b:1", "c1_3:2"]
    assert {r.i: r.line for r in E.libsvm_rows(df, "l", ["p", "q"], index, ["i"]).collect()} == {1: "x 1:a_b", 2: "y 2:3", 3: "z"}


def test_top_values_and_crosses(spark):
    df = spark.createDataFrame([(1, "a:3,b:5,c:5"), (2, "z"), (3, None)], "i int, m string")
    assert {r.i: r.m for r in E.top_values(df, ["i"], "m", 2, True).collect()} == {1: "b:5.0,c:5.0", 2: "z:1.0"}
    assert E.normal_crosses([("z", ["a", "b"]), ("c", ["b", "a", "a"]), ("one", ["a"])]) == {"c": ["a", "b"]}
    assert spark.range(1).select(C.cross("id", "id")).head()[0] == "0"


def test_sampling_invariants(spark):
    df = spark.range(20_000).withColumn("label", (F.col("id") % 10 == 0).cast("int"))
    out = sample.by_field(df, "label", 1, 2.0)
    n = {r.label: r.cnt for r in A.label_histogram(out, "label").collect()}
    assert n[1] == 2000 and 3700 < n[0] < 4300
    assert sorted(out.collect()) == sorted(sample.by_field(df, "label", 1, 2.0).collect())
    split = sample.hash_split(df, ["id"], ["train", "val", "test"], [0.7, 0.15, 0.15])
    share = {r.split: r["count"] / 20_000 for r in split.groupBy("split").count().collect()}
    assert abs(share["train"] - 0.7) < 0.02 and abs(share["val"] - 0.15) < 0.02


def test_pretraining_samples(spark):
    rng = random.Random(3)
    tags = [f"t{i}" for i in range(40)]
    rows = [(f"u{i}", ",".join(rng.sample(tags, rng.choice([2, 3, 5, 29, 30])))) for i in range(60)] + [("-1", "t1,t2,t3")]
    df = spark.createDataFrame(rows, "wuid string, f string")
    melted = P.melt_tags(df, "wuid", ["f"])
    assert {len(r.feats.split(",")) for r in melted.collect()} == {3, 5, 29} and melted.where("wuid = '1-'").count() == 0
    samples, vocab = P.pretrain_samples(df, "wuid", ["f"], None, 1, 1000)
    for r in samples.collect():
        own = set(r.tags)
        assert 1 <= len(r.select_tag) <= 4 and set(r.sample_tags) <= own and len(set(r.select_tag)) == len(r.select_tag)
        if r.label:
            assert set(r.select_tag) <= own and not set(r.select_tag) & set(r.sample_tags)
        else:
            assert not set(r.select_tag) & own


def test_negatives_follow_the_rates(spark):
    vocab = spark.createDataFrame([("f", i, c) for i, c in ((0, 1), (1, 3), (2, 6))], "field string, idx long, cnt long")
    pos = spark.range(6000).select(F.col("id").cast("string").alias("wuid"), F.lit("f").alias("fieldname"), F.array(F.lit(99).cast("long")).alias("tags"), F.array(F.lit(99).cast("long")).alias("sample_tags"))
    first = P.negatives(pos, vocab).groupBy(F.col("select_tag")[0].alias("t")).count().collect()
    share = {r.t: r["count"] / 6000 for r in first}
    assert abs(share[0] - 0.1) < 0.02 and abs(share[1] - 0.3) < 0.03 and abs(share[2] - 0.6) < 0.03


def test_projection_helpers(spark):
    lines = spark.createDataFrame([("1, x ,2.5",), ("2,,",), ("bad,y,1",)], "value string")
    assert project.min_fields(lines, "value", 3).count() == 2
    lenient = project.parse_typed(lines, "value", ",", ["a", "b", "c"], ["int", "str", "double"], strict=False)
    assert [tuple(r) for r in lenient.collect()] == [(1, "x", 2.5), (2, "", None), (None, "y", 1.0)]
    assert project.run_sql("SELECT count(*) AS n FROM {t}", t=lines).head().n == 3
    zero = project.nulls_to_zero(spark.createDataFrame([(None, None)], "a float, s string"))
    assert tuple(zero.head()) == (0.0, "0") and zero.schema["a"].dataType.simpleString() == "float"


def test_shuffled_column_is_a_permutation(spark):
    out = J.shuffle_column(spark.range(200).withColumn("v", F.col("id") * 2), "v", "w", ["id"]).collect()
    assert sorted(r.w for r in out) == sorted(r.v for r in out) and [r.w for r in out] != [r.v for r in out]


def test_samples_are_the_same_however_rows_lie(spark):
    rows = spark.createDataFrame([(f"w{i}", "f", [j % 7 + i % 3 for j in range(6)]) for i in range(40)], "wuid string, fieldname string, tags array<long>")
    vocab = spark.createDataFrame([("f", i, 10 * i + 1) for i in range(12)], "field string, idx long, cnt long")
    shown = lambda df: sorted(map(str, df.collect()))
    for f in (lambda r: P.positives(r), lambda r: P.negatives(P.positives(r), vocab), lambda r: P.pair_samples(r, vocab)):
        assert shown(f(rows)) == shown(f(rows.repartition(5)))
    for r in P.negatives(P.positives(rows), vocab).collect():
        assert not set(r.select_tag) & set(r.tags) and len(set(r.select_tag)) == len(r.select_tag) <= 4
    # a small field is drawn from in full: 12 tags, at most 7 of them the row's own
    per = P.negatives(P.positives(rows), vocab).groupBy("wuid", F.array_join(F.col("sample_tags").cast("array<string>"), ",")).agg(F.sum(F.size("select_tag")).alias("n"), F.max(F.size("tags")).alias("t")).collect()
    assert all(r.n == min(8, 12 - r.t) for r in per)
    pairs = P.pair_samples(rows, vocab).collect()
    tags = {r.wuid: set(r.tags) for r in rows.collect()}
    assert all((r.context in tags[r.wuid]) == (r.label == 1) and r.tag in tags[r.wuid] for r in pairs) and {r.label for r in pairs} == {0, 1}


def test_mapping_registry(spark, tmp_path):
    spark.range(2).write.parquet(str(tmp_path / "m"))
    got = J.mapping_registry(spark, [{"id": "a", "input": str(tmp_path / "m")}, {"id": "", "input": "x"}, {"id": "b", "input": ""}])
    assert list(got) == ["a"] and got["a"].count() == 2
    with pytest.raises(ValueError):
        J.mapping_registry(spark, [{"id": "a", "input": str(tmp_path / "m")}] * 2)


def test_sampling_by_group(spark):
    df = spark.createDataFrame([(i, "ab"[i % 2]) for i in range(2000)] + [(-1, None)], "i long, k string")
    kept = sample.by_group(df, "k", {"a": 0.25, None: 1.0}).collect()
    assert 180 < sum(r.k == "a" for r in kept) < 320 and sum(r.k is None for r in kept) == 1 and not any(r.k == "b" for r in kept)
