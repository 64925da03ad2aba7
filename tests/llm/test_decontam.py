import hashlib
import random
import re

from pyspark.sql import functions as F

from samplewright.llm import decontam as D
from samplewright.llm.sparkio import Scratch

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def toks(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER))


def brute(docs, bench):
    wins = {}
    for i, t in bench:
        w = toks(t)
        for s in range(max(1, len(w) - 9) if w else 0):
            wins.setdefault(tuple(w[s : s + 10]), set()).add(i)
    out = {}
    for k, t in docs:
        w, hit, items = toks(t), set(), set()
        for n in {len(x) for x in wins}:
            for s in range(len(w) - n + 1):
                if tuple(w[s : s + n]) in wins:
                    hit |= set(range(s, s + n))
                    items |= wins[tuple(w[s : s + n])]
        out[k] = (len(w), len(hit), len(items), hashlib.sha256(",".join(sorted(map(str, items))).encode()).hexdigest(), bool(hit))
    return out


def corpus(seed):
    rng = random.Random(seed)
    vocab = ["ab", "Né", "the", "x1", "ÑANDÚ", "日本", "of"] + [f"w{i}" for i in range(40)]
    text = lambda n: rng.choice([" ", "-", "\n"]).join(rng.choice(vocab) for _ in range(n))
    bench = [(i, text(rng.choice([1, 3, 10, 11, 30]))) for i in range(12)] + [(20, None), (21, " . "), (22, "of of of of of of of of of of of of"), (12, "rare9 word9")]
    docs = [(i, text(rng.randint(0, 60)) + rng.choice([" ", ", "]) + (rng.choice(bench)[1] or "") + " " + text(rng.randint(0, 9))) for i in range(80)]
    return docs + [(90, None), (91, ""), (92, "..."), (93, "of " * 30), (94, "word9 a b rare9"), (95, "RARE9  word9")], bench


def test_equals_brute_force(spark):
    docs, bench = corpus(3)
    d = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as item_id", "2 as win")
    b = spark.createDataFrame(bench, "item_id long, text string").selectExpr("*", "1 as doc_id")
    rows = D.decontaminate(d, b).collect()
    assert {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in rows} == brute(docs, bench)


def test_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(D, "BROADCAST_TERMS", 0)
    d = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, "b a b"), (None, None)], "doc_id long, text string")
    b = spark.createDataFrame([(5, "a b"), (5, "a b"), (None, "b a")], "item_id long, text string")
    got = sorted((r.n_words, r.n_hit, r.n_items) for r in D.decontaminate(d, b).collect())
    assert got == [(0, 0, 0), (2, 2, 1), (2, 2, 1), (3, 3, 1)]
    assert [r.n_hit for r in D.decontaminate(d, b.limit(0)).collect()] == [0] * 4
    assert D.decontaminate(d.limit(0), b).count() == 0


def test_proximity(spark):
    docs, bench = corpus(4)
    d = spark.createDataFrame(docs, "doc_id long, text string")
    keyed, _, chosen, index = D.build(d, spark.createDataFrame(bench, "item_id long, text string"), Scratch(spark, "t"))
    near = D.proximity_matches(chosen, index, 3).join(keyed, ["k1", "k2"])
    got = {(r.doc_id, r.gap) for r in near.where(F.col("win") == F.array(F.lit("rare9"), F.lit("word9"))).collect()}
    assert {g for g in got if g[0] >= 90} == {(94, 3), (95, 1)}
