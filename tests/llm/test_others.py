import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from samplewright.llm import ann, langid, line_dedup, mixing, token_counts, url_filter

RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block")]


def judge(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = "".join(c.lower() if c.isascii() else c for c in host)
    fits = [(len(h + p), h + p, v) for h, p, v in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *(max(fits)[1:] if fits else (None, "allow")))


@pytest.mark.parametrize("most", [100_000, 0])
def test_urls(spark, monkeypatch, most):
    monkeypatch.setattr(url_filter, "BROADCAST_RULES", most)
    urls = ["http://a.Example.com/en/x", "https://www.example.com/en/", "http://b.www.example.com/en/q?x=/es/", "http://x.net/es/1#a", "http://x.net/es", "http://net/es/", "http://com", "http://com/", "nourl", "", None, "a://b://c/en/", "http://ÉX.com/é", "http://badexample.com/en/", "http://x.net?/es/"] * 2
    df = spark.createDataFrame([(i, u, "old") for i, u in enumerate(urls)], "page_id long, url string, rule string")
    out = url_filter.judge_urls(df, spark.createDataFrame(RULES, "host string, path string, verdict string"))
    assert {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in out.collect()} == {i: judge(u) for i, u in enumerate(urls)}
    none = url_filter.judge_urls(df, spark.createDataFrame([], "host string, path string, verdict string"))
    assert {r.verdict for r in none.collect()} == {"allow"}


def vectors(n, seed=0, dim=12):
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(20, dim))
    return centers[rng.integers(0, 20, n)] + rng.normal(scale=0.3, size=(n, dim))


def test_nearest_neighbours(spark):
    x = vectors(3000)
    x[100:700] = x[99]  # a hot vector
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)]
    odd = [(9001, None), (9002, [0.0] * 12), (9003, [float("nan")] * 12), (9004, [1.0]), (None, [1.0] * 12)]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>").withColumn("part", F.lit(1))
    out = ann.search(df, F.col("vec_id") % 100 == 0, parts=16).collect()
    found = {}
    for r in out:
        found.setdefault(r.query_id, []).append((r["rank"], r.score, r.vec_id))
    good = total = 0
    for q in range(0, 3000, 100):
        d = np.sqrt(((x - x[q]) ** 2).sum(1))
        d[q] = np.inf
        true = np.lexsort((np.arange(len(d)), d))[:10]
        got = sorted(found[q])
        assert [g[0] for g in got] == list(range(1, 11)) and [g[1:] for g in got] == sorted(g[1:] for g in got)
        assert all(abs(g[1] - d[g[2]]) < 1e-12 for g in got)
        good, total = good + sum(g[1] <= d[true[-1]] for g in got), total + 10
    assert good / total >= 0.9
    few = ann.search(df.where("vec_id in (0, 1, 9001)"), F.col("vec_id") % 100 == 0).collect()
    assert [(r.query_id, r["rank"], r.vec_id) for r in few] == [(0, 1, 1)]
    assert ann.search(df.limit(0), F.lit(True)).count() == 0


def test_languages(spark):
    rng = random.Random(1)
    words = {"aa": ["the", "tion", "with", "of"], "bb": ["eau", "leè", "que", "oux"], "cc": ["der", "ung", "ß", "ich"]}
    rows = [(i, " ".join(rng.choice(words[lang]) for _ in range(rng.choice([8, 60]))), lang) for i, lang in enumerate(rng.choices(list(words), k=400))]
    rows += [(1000, None, "aa"), (1001, "12 34 !", "aa"), (1002, "", None), (None, "the of with", "aa"), (1003, "que eau oux que", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("score", F.lit("x"))
    got = {r.doc_id: r for r in langid.identify(df).collect()}
    import zlib

    held = [r for r in rows[:400] if zlib.crc32(str(r[0]).encode()) % 3 == 1]
    assert all(got[r[0]].held_out for r in held)
    assert sum(got[r[0]].lang_pred == r[2] for r in held) / len(held) > 0.95
    assert all(got[i].lang_pred == "und" and got[i].score == 0 for i in (1000, 1001, 1002))
    assert got[1003].lang_pred == "bb" and got[None].held_out is False and all(0 <= r.score <= 1 for r in got.values())
    assert {r.lang_pred for r in langid.identify(df.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    assert langid.identify(df.limit(0)).count() == 0
    code = langid.codewords(20)
    assert min((code[i] != code[j]).sum() for i in range(20) for j in range(i)) >= 8


def test_mixing(spark):
    rng = random.Random(2)
    rows = [(i, "w " * rng.randint(0, 60), rng.choice(["a", "a", "a", "b", "é", None])) for i in range(3000)] + [(None, None, "a"), (5000, "x", "tiny")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("size", F.lit(1))
    out = mixing.mix_sources(df).collect()
    assert sorted((r.doc_id is None, r.doc_id, r.size) for r in out if r.doc_id is not None) == sorted((False, i, len((t or "").split())) for i, t, _ in rows if i is not None)
    taken, target = Counter(), {}
    for r in out:
        taken[r.source] += r.taken
        target[r.source] = r.target
        assert r.taken <= 3 * r.size
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += len((t or "").split())
    assert target == pytest.approx(mixing.targets(sizes)) and target["tiny"] == 3
    assert sum(target.values()) == pytest.approx(sum(sizes.values()))
    assert all(abs(taken[s] - target[s]) <= max(60, 0.01 * target[s]) for s in target)
    assert sorted(map(str, out)) == sorted(map(str, mixing.mix_sources(df).collect()))
    assert mixing.mix_sources(df.limit(0)).count() == 0


def brute_lines(docs):
    """Chunks by the operator's own boundaries, all compared as bytes."""
    seen, out = {}, {}
    for key, text in sorted(docs, key=lambda d: d[0]):
        if text is None:
            out[key] = None
            continue
        data = np.frombuffer(text.encode(), np.uint8)
        left = b""
        for _, lo, hi, n in zip(*line_dedup.chunks(data, np.array([0, len(data)])), strict=True):
            chunk = data[lo:hi].tobytes()
            bare = chunk.removesuffix(b"\n")
            if n >= 2 and bare.strip() and bare in seen:
                continue
            if n >= 2:
                seen[bare] = key
            left += chunk
        out[key] = left.decode()
    return out


def test_lines(spark):
    rng = random.Random(4)
    line = lambda: "".join(rng.choices("abcé ", k=rng.randint(0, 8)))
    shared = ["\n".join(line() for _ in range(12)) for _ in range(4)]
    docs = [(i, "\n".join(rng.choice(shared) if rng.random() < 0.5 else line() for _ in range(rng.randint(0, 8)))) for i in range(80)]
    docs += [(90, None), (91, ""), (92, "\n\n\n\n"), (93, "\n\n\n\n"), (94, "x\r\ny\n"), (95, "same\n" * 50), (96, "same\n" * 50)]
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as key", "'q' as lang").repartition(4)
    out = line_dedup.dedup_lines(df)
    got = {r.doc_id: r for r in out.collect()}
    want = brute_lines(docs)
    assert {k: r.kept for k, r in got.items()} == want and any(r.n_removed for r in got.values()) and got[1].lang == "q"
    assert got[96].n_removed == 50 and got[96].kept == ""
    twice = spark.createDataFrame([(1, "a\nb\nc\nd\ne"), (1, "a\nb\nc\nd\ne"), (None, "a\nb\nc\nd\ne"), (None, None)], "doc_id long, text string")
    assert sorted(str(r.n_removed) for r in line_dedup.dedup_lines(twice).collect())[:3] == ["0", "0", "0"]
    assert line_dedup.dedup_lines(df.limit(0)).count() == 0


def test_token_counts(spark):
    texts = ["the cat", "the", None, "", "a " * 3000, "the cat", "né ß 日本"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    encode = token_counts.encoder(*token_counts.read_ranks(token_counts.RANKS)).encode_ordinary
    n = [len(encode(t or "")) for t in texts]
    sums = token_counts.suffix_sums(token_counts.length_histogram(df))
    for r in sums.collect():
        assert r.n_docs == n.count(r.n_tokens) and r.docs_from == sum(x >= r.n_tokens for x in n)
        assert r.tokens_from == sum(x for x in n if x >= r.n_tokens) and r.truncated_total == sum(min(x, r.n_tokens) for x in n)
    assert [token_counts.truncated_total(sums, k) for k in (0, 1, 5, 10**6)] == [sum(min(x, k) for x in n) for k in (0, 1, 5, 10**6)]
    assert token_counts.quantile(sums, 0.5) == sorted(n)[3] and token_counts.quantile(sums, 1.0) == max(n)
    assert token_counts.suffix_sums(token_counts.length_histogram(df.limit(0))).count() == 0


def test_pipeline(spark, tmp_path):
    import corpus_pipeline as P

    rng = random.Random(8)
    vocab = [f"w{i}" for i in range(300)]
    text = lambda n: " ".join(rng.choices(vocab, k=n))
    bench = [(i, text(30)) for i in range(3)]
    docs = [(i, text(120), "en", f"s{i % 3}") for i in range(60)]
    docs += [(100, docs[0][1], "en", "s0"), (101, docs[1][1] + " extra", "en", "s1"), (102, text(40) + " " + bench[1][1] + " " + text(20), "en", "s2"), (103, "1 2 3", "en", None), (104, None, None, None)]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string").withColumn("n_chars", F.length("text").cast("long"))
    df.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    now, kept = spark.read.parquet(str(tmp_path / "documents.parquet")), []
    for i, (name, stage) in enumerate(P.STAGES):
        stage(spark, now, str(tmp_path)).write.parquet(str(tmp_path / name))
        now = spark.read.parquet(str(tmp_path / name))
        kept.append({r.doc_id for r in now.collect()})
        if i < 4:
            assert now.columns == P.COLUMNS
    all_ = {d[0] for d in docs}
    assert kept[0] == all_ - {103, 104} and kept[1] == kept[0] and kept[2] == kept[1] - {100, 101} and kept[3] == kept[2] - {102}
    assert kept[4] <= kept[3] and P.run(spark, str(tmp_path)).count() == len(kept[4])
    assert P.STAGES[2][1](spark, df.limit(0), str(tmp_path)).count() == 0
