"""Language identification with error-correcting output codes (operator 4).

Every language has a codeword of +1/-1 bits. For each bit a binary classifier
over hashed byte n-grams predicts it; the language whose codeword loses least
(logistic loss, each bit weighted by its accuracy in training) wins, and a
prediction whose runner-up comes close is flagged as ambiguous.

Up to SAMPLE labelled rows are learned from, chosen by a hash of doc_id with
an equal share for each language; predictions use whole texts and nothing but
the text.

Nulls: a null text, or one without a letter, is `und` with score 0. Rows with
a null lang or doc_id aren't learned from. With no labelled rows everything is
`und`; with one language every text with letters gets it. Repeated rows each
get their result. Other columns are kept by `predict`.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import repeats as R
from . import seqhash as H

#: Labelled rows to learn from, at most (in expectation, by hash).
SAMPLE = 6000
#: Features; n-gram lengths in bytes.
DIM, GRAMS = 2048, (1, 2, 3)
ROUNDS, RATE, DECAY = 200, 30.0, 1e-6
#: Below this share of the best two languages' evidence a text is ambiguous.
CLEAR = 0.6
UNKNOWN = "und"
LETTER = re.compile(r"[^\W\d_]")


def features(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Square roots of n-gram shares, one row for each text, of length 1."""
    codes = H.BYTE_CODES[H.LOWER[data]]
    texts = len(offs) - 1
    out = np.zeros((texts, DIM), np.float32)
    rolling = H.Rolling(codes)
    owner = H.owners(offs)
    for n in GRAMS:
        g = rolling.grams(n)
        if len(g):
            ok = owner[: len(g)] == owner[n - 1 :]
            at = owner[: len(g)][ok] * DIM + (g[ok] >> H.U64(64 - 11)).astype(np.int64)
            out += np.bincount(at, minlength=texts * DIM).reshape(texts, DIM).astype(np.float32)
    out = np.sqrt(out)
    return out / np.maximum(np.sqrt((out * out).sum(1, keepdims=True)), 1e-9)


def codewords(n: int, seed: int = 11) -> np.ndarray:
    """n codewords: all splits of up to 7 languages, else random ones that are far apart."""
    if n <= 1:
        return np.ones((n, 1), np.float32)
    if n <= 7:
        columns = [(1, *c) for c in itertools.product((1, -1), repeat=n - 1) if -1 in c]
        return np.array(columns, np.float32).T
    rng = np.random.default_rng(seed)
    best, far = None, -1
    for _ in range(50):
        code = rng.choice([-1.0, 1.0], (n, int(np.ceil(10 * np.log2(n)))))
        apart = (code @ code.T - 2 * code.shape[1] * np.eye(n)).max()
        if best is None or -apart > far:
            best, far = code, -apart
    return best.astype(np.float32)


class Model:
    def __init__(self, languages: list[str], code: np.ndarray, weights: np.ndarray, trust: np.ndarray):
        self.languages, self.code, self.weights, self.trust = languages, code, weights, trust

    def decode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(best language, its share of the evidence, whether it is ambiguous)."""
        f = x @ self.weights[:-1] + self.weights[-1]
        loss = np.logaddexp(0, -f[:, None, :] * self.code[None]) * self.trust
        loss = loss.sum(2)
        order = np.sort(loss, 1)
        share = np.exp(order[:, :1] - loss)
        score = 1 / share.sum(1)
        second = order[:, 1] if loss.shape[1] > 1 else order[:, 0] + 50
        return loss.argmin(1), score, 1 / (1 + np.exp(order[:, 0] - second)) < CLEAR


def fit(x: np.ndarray, y: list[str]) -> Model:
    """Logistic regressions of all bits at once, by accelerated gradient steps."""
    languages = sorted(set(y))
    code = codewords(len(languages))
    if len(languages) <= 1:
        return Model(languages, code, np.zeros((DIM + 1, 1), np.float32), np.ones(1, np.float32))
    row = np.array([languages.index(v) for v in y])
    goal = code[row]
    x1 = np.concatenate([x, np.ones((len(x), 1), np.float32)], 1)
    share = 1 / (np.bincount(row)[row] * len(languages))  # languages count alike
    w = np.zeros((DIM + 1, code.shape[1]), np.float32)
    ahead = w
    for i in range(ROUNDS):
        f = x1 @ ahead
        pull = (goal / (1 + np.exp(np.clip(goal * f, -30, 30)))) * share[:, None].astype(np.float32)
        step = ahead + RATE * (x1.T @ pull - DECAY * ahead)
        ahead = step + (i / (i + 3)) * (step - w)
        w = step
    right = ((x1 @ w) * goal > 0).mean(0)
    trust = np.maximum(right - 0.5, 1e-3).astype(np.float32)
    return Model(languages, code, w.astype(np.float32), trust / trust.mean())


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for big in batches:
        for b in R.pieces(big):
            x = features(*H.batch_bytes(b.column("text"))).astype(np.float16)
            yield pa.RecordBatch.from_arrays([b.column("lang"), pa.array([r.tobytes() for r in x], pa.binary())], names=["lang", "x"])


def held_out(doc_id=None):
    """Rows that are never learned from."""
    return F.coalesce(F.crc32((F.col("doc_id") if doc_id is None else doc_id).cast("string")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, sample: int = SAMPLE) -> Model:
    """docs (doc_id, text, lang). The driver gets at most about `sample` feature rows of 4 kB."""
    usable = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & F.col("text").isNotNull() & ~held_out())
    counts = {r.lang: r.n for r in usable.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return fit(np.zeros((0, DIM), np.float32), [])
    each = max(1, sample // len(counts))
    share = F.create_map(*[F.lit(v) for lang, n in counts.items() for v in (lang, min(1.0, each / n))])
    chance = F.shiftrightunsigned(F.xxhash64("doc_id", F.lit(5)), 11) / F.lit(float(1 << 53))
    rows = usable.where(chance < share[F.col("lang")]).select("lang", "text").mapInArrow(_sampled, "lang string, x binary").collect()
    rows.sort(key=lambda r: (r.lang, bytes(r.x)))
    x = np.array([np.frombuffer(r.x, np.float16) for r in rows], np.float32).reshape(len(rows), DIM)
    return fit(x, [r.lang for r in rows])


def _predicted(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for b in R.pieces(big):
                best, score, close = model.decode(features(*H.batch_bytes(b.column("text")))) if model.languages else (np.zeros(b.num_rows, int), np.zeros(b.num_rows), np.ones(b.num_rows, bool))
                some = np.array([bool(t) and LETTER.search(t) is not None for t in b.column("text").to_pylist()], bool) & bool(model.languages)
                lang = [model.languages[k] if s else UNKNOWN for k, s in zip(best, some, strict=True)]
                out = {"lang_pred": pa.array(lang, pa.string()), "score": pa.array(np.where(some, score, 0.0).clip(0, 1).astype(float)), "ambiguous": pa.array(close | ~some)}
                keep = {n: b.column(n) for n in b.schema.names if n not in out}
                yield pa.RecordBatch.from_arrays([*keep.values(), *out.values()], names=[*keep, *out])

    return run


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """docs with lang_pred, score and ambiguous (own columns of these names give way); needs `text`."""
    docs = docs.drop("lang_pred", "score", "ambiguous")
    made = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("ambiguous", T.BooleanType())]
    return docs.mapInArrow(_predicted(model), T.StructType([*docs.schema.fields, *made]))


def identify(docs: DataFrame) -> DataFrame:
    """Learn from the labelled rows that aren't held out, and predict all:
    doc_id, held_out, lang_pred, score, ambiguous."""
    model = train(docs)
    out = predict(docs.select("doc_id", held_out().alias("held_out"), "text"), model)
    return out.drop("text")
