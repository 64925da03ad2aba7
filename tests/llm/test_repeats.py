import hashlib
import random
import re
from collections import Counter

from samplewright.llm.suffix_dedup import dedup_substrings
from samplewright.llm.sparkio import Scratch
from samplewright.llm.window_index import FingerprintIndex, dedup_windows


def brute_bytes(docs, n):
    seen, out = set(), {}
    for key, text in sorted(docs, key=lambda d: d[0]):
        b = (text or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - n + 1):
            if b[i : i + n] in seen:
                gone[i : i + n] = b"\1" * n
            seen.add(b[i : i + n])
        left = bytes(x for x, g in zip(b, gone) if not g)
        runs = len(re.findall(rb"\x01+", bytes(gone)))
        out[key] = (len(b), sum(gone), runs, hashlib.sha256(left).hexdigest())
    return out


def brute_words(docs, n):
    words = {k: re.findall(r"[^\x20\x09-\x0D]+", t or "") for k, t in docs}
    count = Counter(tuple(w[i : i + n]) for w in words.values() for i in range(len(w) - n + 1))
    out = {}
    for k, w in words.items():
        gone = [False] * len(w)
        for i in range(len(w) - n + 1):
            if count[tuple(w[i : i + n])] > 1:
                gone[i : i + n] = [True] * n
        left = " ".join(x for x, g in zip(w, gone) if not g)
        out[k] = (len(w), sum(gone), hashlib.sha256(left.encode()).hexdigest())
    return out


def corpus(seed):
    rng = random.Random(seed)
    vocab = ["ab", "né", "the", "x", "ñandú", "tion", "日本", "of\t", " q"]
    phrase = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    shared = [phrase(rng.choice([20, 40, 90])) for _ in range(6)]
    docs = []
    for _ in range(60):
        docs.append(" ".join(rng.choice(shared) if rng.random() < 0.4 else phrase(rng.randint(0, 40)) for _ in range(rng.randint(0, 6))))
    docs += [docs[3], docs[4], None, "", "a" * 700, "a" * 350, "ab " * 200, phrase(3000) + shared[0] + phrase(3000)]
    rng.shuffle(docs)
    return list(enumerate(docs))


def test_substrings_equal_brute_force(spark):
    for seed, n, gram in ((1, 100, 24), (2, 30, 6)):
        docs = corpus(seed)
        df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
        got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in dedup_substrings(df, n, gram).collect()}
        assert got == brute_bytes(docs, n)


def test_substrings_with_odd_rows(spark):
    text = "".join(random.Random(5).choices("abcdefgh ", k=300))
    rows = [(1, text), (1, text), (None, text), (None, None), (7, None), (2, text[50:250] + "zz")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as key", "2 as spans", "3 as lo")
    got = sorted((r.doc_id is None, r.doc_id or 0, r.n_bytes, r.n_removed) for r in dedup_substrings(df).collect())
    assert got == [(False, 1, 300, 0), (False, 1, 300, 0), (False, 2, 202, 200), (False, 7, 0, 0), (True, 0, 0, 0), (True, 0, 300, 300)]
    assert dedup_substrings(df.limit(0)).count() == 0


def test_windows_equal_brute_force(spark):
    for seed, n, gram in ((3, 35, 8), (4, 12, 3)):
        docs = corpus(seed)
        df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
        got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in dedup_windows(df, n, gram).collect()}
        assert got == brute_words(docs, n)


def test_windows_with_odd_rows(spark):
    text = " ".join(random.Random(6).choices("abcdefgh", k=80))
    rows = [(1, text), (1, text), (7, None), (None, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as bucket")
    assert sorted((r.n_words, r.n_removed) for r in dedup_windows(df).collect()) == [(0, 0), (1, 0), (80, 0), (80, 0)]
    df = spark.createDataFrame([(1, text), (2, "q " + text), (None, text)], "doc_id long, text string")
    assert sorted((r.n_words, r.n_removed) for r in dedup_windows(df).collect()) == [(80, 80), (80, 80), (81, 80)]
    assert dedup_windows(df.limit(0)).count() == 0


def index_answer(docs, n):
    words = {k: re.findall(r"[^\x20\x09-\x0D]+", t or "") for k, t in docs}
    count = Counter(tuple(w[i : i + n]) for w in words.values() for i in range(len(w) - n + 1))
    return {(k, i) for k, w in words.items() for i in range(len(w) - n + 1) if count[tuple(w[i : i + n])] > 1}


def test_index_reopens_compacts_and_shuffles_no_history(spark, tmp_path):
    docs = corpus(9)
    df = spark.createDataFrame(docs, "key long, text string")
    scratch = Scratch(spark, "t")
    FingerprintIndex(spark, str(tmp_path), 4, 12, 3, fanout=3).add(df.where("key % 4 = 0"), df.where("key % 4 = 0"), scratch).collect()
    hits = set()
    for i in range(4):  # each delivery by an index that is opened anew
        if i:
            index = FingerprintIndex.open(spark, str(tmp_path))
            runs = index.add(df.where(f"key % 4 = {i}"), df.where(f"key % 4 <= {i}"), scratch).collect()
        else:
            index = FingerprintIndex(spark, str(tmp_path / "again"), 4, 12, 3, fanout=3)
            runs = index.add(df.where("key % 4 = 0"), df.where("key % 4 = 0"), scratch).collect()
        hits |= {(r.key, r.lo + j) for r in runs for j in range(r.n)}
        plan = index.met(index.made)._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan
        index.close()
    assert hits == index_answer(docs, 12)
    index = FingerprintIndex.open(spark, str(tmp_path))
    assert len(index.runs) == 2 and index.made == 5  # three deliveries became one run; their files are gone
    assert sorted(p.name for p in (tmp_path / "runs").iterdir() if p.name.startswith("run=")) == [f"run={r}" for r in sorted(index.runs)]
    index.close()


def thue_morse(bits, letters):
    return "".join(letters[bin(i).count("1") % 2] for i in range(1 << bits))


def test_words_that_break_hashes_modulo_two_to_the_64(spark):
    a, b = thue_morse(11, "ab"), thue_morse(11, "ba")
    rest = " ".join(f"w{i}" for i in range(34))
    df = spark.createDataFrame([(1, f"{a} {rest}"), (2, f"{b} {rest}")], "doc_id long, text string")
    assert [r.n_removed for r in dedup_windows(df).collect()] == [0, 0]
    df = spark.createDataFrame([(1, "x" + a), (2, "y" + b)], "doc_id long, text string")
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in dedup_substrings(df).collect()}
    assert got == brute_bytes([(1, "x" + a), (2, "y" + b)], 100)
