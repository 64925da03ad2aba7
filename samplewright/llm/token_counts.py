"""Token counts by an exact length histogram (operator 10).

Documents are encoded once and counted by encoded length, which is written;
suffix sums over the histogram then answer, for every context limit, how many documents reach it,
how many tokens they hold and how many are left when each document is cut
there, as well as totals and quantiles, without going back to the texts.

Nulls: a null or empty text has length 0. Repeated rows count each. An empty
table gives an empty histogram. Special tokens' strings are ordinary text.
Very long texts are encoded whole.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .sparkio import Scratch

#: A vocabulary by its name in the tokenizers' package, or by a path.
RANKS = "byte_bpe_50k.tiktoken"
#: Lengths are summed in groups of so many, then within them, so no task holds all.
GROUP = 1024


def read_ranks(path: str) -> tuple[bytes, str]:
    """(a vocabulary file, the pattern that cuts text before it applies), read on the driver."""
    import public_tokenizers

    with open(path if "/" in path else public_tokenizers.path(path), "rb") as file:
        return file.read(), public_tokenizers.PATTERN


@lru_cache(maxsize=2)
def encoder(ranks: bytes, pattern: str):
    import tiktoken

    merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=merges, special_tokens={})


def _lengths(ranks, text: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(*ranks.value).encode_ordinary
        for b in batches:
            count: dict[int, int] = {}
            for t in b.column(text):
                n = len(encode(t.as_py() or ""))
                count[n] = count.get(n, 0) + 1
            n = np.array(list(count), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(n), pa.array(list(count.values()), pa.int64())], names=["n_tokens", "n_docs"])

    return run


def length_histogram(docs: DataFrame, text: str = "text", ranks: str = RANKS) -> DataFrame:
    """(n_tokens, n_docs), one row for each length that occurs. ranks: a
    vocabulary file on the driver, some 1 MB, that is broadcast to the executors."""
    sent = docs.sparkSession.sparkContext.broadcast(read_ranks(ranks))
    each = docs.select(text).mapInArrow(_lengths(sent, text), "n_tokens long, n_docs long")
    counts = each.groupBy("n_tokens").agg(F.sum("n_docs").alias("n_docs"))
    return Scratch(docs.sparkSession, "lengths").save(counts, "histogram")


def suffix_sums(histogram: DataFrame) -> DataFrame:
    """The histogram with docs_from and tokens_from (documents of at least
    this length and their tokens) and truncated_total (tokens left when every
    document is cut to this length). Two levels of sums keep tasks small."""
    rows = histogram.withColumn("_g", F.floor(F.col("n_tokens") / GROUP)).withColumn("_t", F.col("n_tokens") * F.col("n_docs"))
    # one row for each 1024 tokens of the longest text: few, whatever the number of documents
    after = Window.orderBy(F.col("_g").desc()).rowsBetween(Window.unboundedPreceding, -1)
    groups = rows.groupBy("_g").agg(F.sum("n_docs").alias("d"), F.sum("_t").alias("t"))
    total = F.sum("t").over(Window.partitionBy())
    groups = groups.select("_g", F.coalesce(F.sum("d").over(after), F.lit(0)).alias("_d"), F.coalesce(F.sum("t").over(after), F.lit(0)).alias("_s"), total.alias("_all"))
    inside = Window.partitionBy("_g").orderBy(F.col("n_tokens").desc())
    rows = rows.join(groups, "_g").withColumns({"docs_from": F.col("_d") + F.sum("n_docs").over(inside), "tokens_from": F.col("_s") + F.sum("_t").over(inside)})
    cut = F.col("_all") - F.col("tokens_from") + F.col("docs_from") * F.col("n_tokens")
    return rows.select("n_tokens", "n_docs", "docs_from", "tokens_from", cut.alias("truncated_total"))


def truncated_total(sums: DataFrame, limit: int) -> int:
    """Tokens left when every document is cut to `limit`, from suffix_sums alone."""
    r = sums.where(F.col("n_tokens") > limit).orderBy("n_tokens").select("docs_from").head()
    below = sums.where(F.col("n_tokens") <= limit).agg(F.sum(F.col("n_tokens") * F.col("n_docs"))).head()[0] or 0
    return int(below + (r[0] * limit if r else 0))


def quantile(sums: DataFrame, q: float) -> int | None:
    """The least length that at least a share q of the documents don't exceed."""
    total = sums.agg(F.sum("n_docs")).head()[0]
    if not total:
        return None
    most_above = total - max(1, -(-int(round(q * total * 10**9)) // 10**9))
    r = sums.where(F.col("docs_from") - F.col("n_docs") <= most_above).orderBy("n_tokens").head()
    return int(r["n_tokens"])
