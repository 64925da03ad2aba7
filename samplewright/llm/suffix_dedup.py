"""Substring dedup over bytes by prefix-free parsing (operator 1).

Rolling-hash triggers (the least hash of the 24-byte grams in each window)
cut every document into phrases. The dictionary holds each different phrase
once, together with the bytes its windows reach into; the parse is the list
of (document, place) that refer to it. Phrases whose every window lies in an
equal phrase need no sorting. The rest of the dictionary is put into suffix
order, cut at the window length, for some trigger values at a time; neighbours
with a common prefix of that length are equal strings. Equal strings have
equal triggers, so the parts' orders need no merging: only equality and the
first place of a string are asked for.

Nulls: a null text is empty. Documents shorter than a window keep everything.
Rows equal in doc_id and text are one document and get one result each; null
ids come after all others. Other columns are passed by. An empty table gives
an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import repeats as R
from . import seqhash as H
from .sparkio import Scratch, by_doc_id, keyed

WINDOW, GRAM = 100, 24


def _kept(window: int, texts: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offs = H.batch_bytes(b.column("text"))
            rows, all_gone = [], R.covered(b.column("spans"), offs, window)
            for i in range(b.num_rows):
                own, gone = data[offs[i] : offs[i + 1]], all_gone[offs[i] : offs[i + 1]]
                left = own[~gone].tobytes()
                begins = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
                rows.append((len(own), int(gone.sum()), begins, hashlib.sha256(left).hexdigest(), left if texts else None))
            cols = list(zip(*rows, strict=True)) if rows else [[]] * 5
            arrays = [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column("key"), *arrays], names=["key", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    return run


def dedup_substrings(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, texts: bool = True) -> DataFrame:
    """docs (doc_id, text, …) → doc_id, n_bytes, n_removed, n_spans,
    kept_sha256 and, with texts, the remaining bytes `kept`. Every byte goes
    that a string of `window` bytes covers which also starts earlier."""
    scratch = Scratch(docs.sparkSession, "suffix")
    own, rows = keyed(docs.select("doc_id", "text"), scratch)
    hits = R.repeats(own, window, gram, both=False, scratch=scratch)
    schema = "key long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"
    out = R.with_hits(own, hits).select("key", "text", "spans").mapInArrow(_kept(window, texts), schema)
    out = by_doc_id(out if texts else out.drop("kept"), rows)
    return scratch.finish(out)
