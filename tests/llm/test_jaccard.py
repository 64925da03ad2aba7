import random
import re

from samplewright.llm import jaccard as J
from samplewright.llm.components import components
from samplewright.llm.sparkio import Scratch


def brute(docs):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = {}
    for k, t in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(lower))
        sets[k] = {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    root = {k: k for k in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for i in ids:
        for j in ids:
            if i < j and sets[i] and sets[j]:
                o = len(sets[i] & sets[j])
                if 100 * o >= 75 * len(sets[i] | sets[j]):
                    a, b = sorted((find(i), find(j)))
                    root[b] = a
    return {k: (len(sets[k]), find(k)) for k in ids}


def corpus(seed, n=150):
    rng = random.Random(seed)
    vocab = ["ab", "né", "The", "the", "x", "ñandú", "tion", "日本", "of", "q"] + [f"w{i}" for i in range(90)]
    text = lambda n: [rng.choice(vocab) for _ in range(n)]
    base = [text(rng.choice([3, 5, 8, 60, 200])) for _ in range(12)]
    passage = text(50)
    docs = []
    for _ in range(n):
        w = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 2, 3, 5])):
            w[rng.randrange(len(w))] = rng.choice(vocab)
        if rng.random() < 0.2:
            w += passage
        docs.append(rng.choice([" ", "\n", "  "]).join(w))
    docs += ["", None, " \t", "one", "ONE", "a b c d", "a b c d e", "aa " * 40, "aa " * 50]
    rng.shuffle(docs)
    return list(enumerate(docs))


def result(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in J.jaccard_components(df).collect()}


def test_components_equal_brute_force(spark, monkeypatch):
    docs = corpus(1)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    assert result(df) == brute(docs)
    monkeypatch.setattr(J, "BLOCK", 4)  # large clusters in pairs of blocks
    docs = corpus(2, 80)
    assert result(spark.createDataFrame(docs, "doc_id long, text string")) == brute(docs)


def test_odd_rows(spark):
    rows = [(4, "a b c d e f"), (4, "a b c d e f"), (None, "A b c d e f"), (None, None), (2, ""), (9, "x y")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as key", "2 as sid", "3 as n")
    got = sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in J.jaccard_components(df).collect())
    assert got == [("2", 0, "2"), ("4", 2, "4"), ("4", 2, "4"), ("9", 1, "9"), ("None", 0, "None"), ("None", 2, "4")]
    assert J.jaccard_components(df.limit(0)).count() == 0


def test_long_chains_are_one_component(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101)], "a long, b long")
    got = {r.node: r.label for r in components(edges, Scratch(spark, "t"), "c").collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}


def test_thue_morse_words_are_different(spark):
    a, b = ("".join(letters[bin(i).count("1") % 2] for i in range(1024)) for letters in ("ab", "ba"))
    assert result(spark.createDataFrame([(1, a), (2, b)], "doc_id long, text string")) == {1: (1, 1), 2: (1, 2)}


def test_large_clusters_settle_in_few_tasks(spark, monkeypatch):
    """Near copies of one text, a chain at its edge, and a far text that shares words: every pair of blocks would be 190 tasks."""
    rng = random.Random(12)
    base = [f"w{i}" for i in range(120)]
    docs = []
    for i in range(600):
        w = list(base)
        for _ in range(rng.choice([0, 1, 1, 2])):
            w[rng.randrange(len(w))] = f"x{rng.randrange(10**6)}"
        docs.append((i, " ".join(w)))
    docs += [(1000 + k, " ".join(base[: 120 - 2 * k] + [f"y{k}-{j}" for j in range(2 * k)])) for k in range(1, 20)]
    docs.append((2000, " ".join(base[:60])))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    tasks, real = [], J._met
    monkeypatch.setattr(J, "_met", lambda t: (tasks.append(t.select("task").distinct().count()), real(t))[1])
    monkeypatch.setattr(J, "BLOCK", 32)
    assert result(df) == brute(docs)
    assert len(tasks) == 3 and tasks[0] <= 30 and tasks[1] <= 30 and tasks[2] <= 120, tasks
