import random

from samplewright.llm import line_dedup


def brute_runs(docs):
    """Kept text of each (key, text): all pairs of adjoining lines are compared as bytes with their first place."""
    first, out = {}, {}
    for key, text in sorted(docs):
        data = text.encode()
        lines = [x + b"\n" for x in data.split(b"\n")]
        lines = lines[:-1] if data.endswith(b"\n") or not data else lines
        gone = [False] * len(lines)
        for i in range(len(lines) - 1):
            k, j = first.setdefault(lines[i] + lines[i + 1], (key, i))
            if k != key or i >= j + 2:
                gone[i] = gone[i + 1] = True
        i = 0
        while i < len(lines):
            j = i
            while j < len(lines) and gone[j]:
                j += 1
            if j > i and not b"".join(lines[i:j]).strip():
                gone[i:j] = [False] * (j - i)
            i = max(j, i + 1)
        kept = b"".join(x for x, g in zip(lines, gone, strict=True) if not g)
        if lines and not gone[-1] and not data.endswith(b"\n"):
            kept = kept[:-1]
        out[key] = (kept.decode(), len(lines), sum(gone))
    return out


def test_all_repeated_runs_go(spark):
    rng = random.Random(9)
    line = lambda: "".join(rng.choices("abcdé ", k=rng.randint(0, 7)))
    shared = [[line() for _ in range(n)] for n in (2, 2, 3, 5, 12)]
    docs = []
    for i in range(150):
        out = []
        for _ in range(rng.randint(0, 6)):
            out += rng.choice([rng.choice(shared), [line()], [rng.choice("xyz")] * rng.randint(1, 6), [""] * rng.randint(1, 4)])
        docs.append((i, "\n".join(out) + rng.choice(["", "\n"])))
    docs += [(900, "one 1\nshared a\nshared b\ntwo 2"), (901, "three 3\nshared a\nshared b\nfour 4"), (902, "u\n" + "same\n" * 50 + "v"), (903, "w\n" + "same\n" * 41 + "t"), (904, "rrr\n" * 3), (905, "\n\n\n")]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    got = {r.doc_id: (r.kept, r.n_lines, r.n_removed) for r in line_dedup.dedup_lines(df, runs=True).collect()}
    assert got == brute_runs(docs)
    assert got[901][0] == "three 3\nfour 4" and got[902][0] == "u\nsame\nsame\nv" and got[903][0] == "w\nt" and got[904][2] == 0
    pairs = [(1, "a\nb\nc"), (1, "d\na\nb"), (None, "b\nc\ne"), (None, "b\nc\ne"), (None, None)]
    twice = spark.createDataFrame(pairs, "doc_id long, text string")
    assert sorted(str(r.kept) for r in line_dedup.dedup_lines(twice, runs=True).collect()) == ["None", "a\nb\nc", "d\n", "e", "e"]
    assert line_dedup.dedup_lines(df.limit(0), runs=True).count() == 0
