"""Benchmark decontamination with a distributed positional inverted index
(operator 8), in DataFrame functions only.

The index stores postings (term, document, position) of the training texts
for the terms that the search needs: of every benchmark window (10 consecutive
words; a shorter item is one window) the two terms that are rarest in the
training texts, counted over all of them. A window's two lists are shifted by
the terms' places in the window and intersected on (document, start); the
places that are left are compared word by word with their documents.
`proximity_matches` asks the same lists for the two terms near each other in
any order.

Terms of the benchmark are broadcast up to BROADCAST_TERMS, beyond that joined
by a shuffle in which a document's hash splits every term over SALT tasks, so a
frequent term isn't one task. Counts are summed before they are shuffled.
Postings of one term never gather in one task: they are hashed by document.

Nulls: null texts have no words; null item_ids are left out of the item lists but
their windows count as hits. Rows equal in doc_id and text are one document.
Repeated item_ids count once. Empty tables give no hits, and every document
still gets its row. Other columns of both tables are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .sparkio import Scratch, ascii_lower

WINDOW = 10
#: Terms that may be sent to every executor: with their counts some 10 MB.
BROADCAST_TERMS = 100_000
SALT = 64
#: What stands between words; A-Z are lower-cased word by word.
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Stands for the end of a document in its index; no word has a blank.
END = " "


def lower(word: Column) -> Column:
    """A-Z only; `lower` does that, faster, where all letters are ASCII."""
    return F.when(F.octet_length(word) == F.char_length(word), F.lower(word)).otherwise(ascii_lower(word))


def parts(text: Column) -> Column:
    """Words in order, as written; the first and the last part may be empty."""
    return F.split(F.coalesce(text, F.lit("")), SEPARATORS)


def empties(cut: Column) -> Column:
    """How many of the parts are no words."""
    return F.when(F.element_at(cut, 1) == "", 1).otherwise(0) + F.when((F.size(cut) > 1) & (F.element_at(cut, -1) == ""), 1).otherwise(0)


def words(text: Column) -> Column:
    """Lower-cased words; null and wordless texts give an empty array. For short texts."""
    return F.transform(F.filter(parts(text), lambda w: w != ""), lower)


def with_key(docs: DataFrame) -> DataFrame:
    """docs with one key (k1, k2) for rows equal in doc_id and text."""
    return docs.select(F.xxhash64("doc_id", "text", F.lit(1)).alias("k1"), F.xxhash64(F.lit(2), "text", "doc_id").alias("k2"), *docs.columns)


def _small(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_TERMS else df


def _of_terms(each: DataFrame, terms: DataFrame, rows: int) -> DataFrame:
    """Words (k1, …, term) that are among the terms."""
    if rows <= BROADCAST_TERMS:
        return each.join(F.broadcast(terms), "term")
    salted = terms.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
    return each.withColumn("salt", F.pmod("k1", F.lit(SALT)).cast("int")).join(salted, ["term", "salt"]).drop("salt")


def windows(benchmark: DataFrame, width: int = WINDOW) -> DataFrame:
    """(w, win): the benchmark's different windows, and (w, item_id) of each item."""
    items = benchmark.select("item_id", words(F.col("text")).alias("t")).where(F.size("t") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("t") - width + 1, F.lit(1)))
    return items.select("item_id", F.explode(starts).alias("s"), "t").select("item_id", F.slice("t", F.col("s"), width).alias("win")).distinct()


def term_counts(docs: DataFrame, terms: DataFrame, rows: int) -> DataFrame:
    """(term, n): how often each of the terms stands in all documents."""
    each = docs.select(F.explode(parts(F.col("text"))).alias("word")).select(lower(F.col("word")).alias("term"))
    if rows <= BROADCAST_TERMS:
        each = each.join(F.broadcast(terms), "term")
    seen = each.groupBy("term").agg(F.count("*").alias("n"))
    return terms.join(seen, "term", "left").select("term", F.coalesce("n", F.lit(0)).alias("n"))


def postings(docs: DataFrame, terms: DataFrame, rows: int) -> DataFrame:
    """The index: (term, k1, k2, doc_id, pos, n_words), pos from 0. Each
    document also has a row of the term END."""
    cut = docs.select("k1", "k2", "doc_id", parts(F.col("text")).alias("p"))
    own = cut.select("k1", "k2", "doc_id", (F.size("p") - empties(F.col("p"))).alias("n_words"), F.array_append("p", F.lit(END)).alias("t"))
    each = own.select("k1", "k2", "doc_id", "n_words", F.posexplode("t").alias("pos", "word")).withColumn("term", lower(F.col("word")))
    wanted = terms.unionAll(docs.sparkSession.range(1).select(F.lit(END).alias("term")))
    return _of_terms(each, wanted, rows).select("term", "k1", "k2", "doc_id", "pos", "n_words")


def build(docs: DataFrame, benchmark: DataFrame, scratch: Scratch, width: int = WINDOW):
    """(keyed documents, windows by item, windows with their two rarest terms, the stored index)."""
    keyed = with_key(docs.select("doc_id", "text"))
    wins = scratch.save(windows(benchmark, width), "windows")
    terms = scratch.save(wins.select(F.explode("win").alias("term")).distinct(), "terms")
    n_terms = terms.count()
    counts = scratch.save(term_counts(docs, terms, n_terms), "counts")
    distinct = wins.select("win").distinct()
    places = distinct.select("win", F.posexplode("win").alias("at", "term")).groupBy("win", "term").agg(F.min("at").alias("at"))
    ranked = places.join(_small(counts, n_terms), "term").groupBy("win").agg(F.sort_array(F.collect_list(F.struct("n", "term", "at"))).alias("r"))  # at most `width` terms
    chosen = scratch.save(ranked.select("win", F.col("r")[0].alias("a"), F.get("r", F.lit(1)).alias("b")), "chosen")
    wanted = chosen.select(F.explode(F.array_compact(F.array("a.term", "b.term"))).alias("term")).distinct()
    index = scratch.save(postings(keyed, wanted, n_terms), "index")
    return keyed, wins, chosen, index


def phrase_matches(keyed: DataFrame, chosen: DataFrame, index: DataFrame) -> DataFrame:
    """(k1, k2, win, start): every place where a window stands, word by word."""
    first = index.join(F.broadcast(chosen) if chosen.count() <= BROADCAST_TERMS else chosen, F.col("term") == F.col("a.term"))
    first = first.select("k1", "k2", "win", "b", (F.col("pos") - F.col("a.at")).alias("start")).where(F.col("start") >= 0)
    # of the second lists only places that a first list leaves are asked for
    places = index.select("k1", "k2", F.col("term").alias("t2"), F.col("pos").alias("p2"))
    alone = first.where(F.col("b").isNull())
    two = first.where(F.col("b").isNotNull()).withColumns({"t2": F.col("b.term"), "p2": F.col("start") + F.col("b.at")})
    both = two.join(places, ["k1", "k2", "t2", "p2"], "left_semi")
    left = alone.select("k1", "k2", "win", "start").unionAll(both.select("k1", "k2", "win", "start"))
    by_doc = left.groupBy("k1", "k2").agg(F.collect_set(F.struct("win", "start")).alias("left"))
    # only the texts of these documents are cut again, alike at every size
    cut = keyed.select("k1", "k2", "text").join(by_doc.hint("merge"), ["k1", "k2"]).select("k1", "k2", "left", parts(F.col("text")).alias("p"))
    here = lambda x: F.transform(F.slice("p", x["start"] + 1, F.size(x["win"])), lower) == x["win"]
    return cut.select("k1", "k2", F.explode(F.filter("left", here)).alias("x")).select("k1", "k2", "x.win", "x.start")


def proximity_matches(chosen: DataFrame, index: DataFrame, slop: int) -> DataFrame:
    """(k1, k2, win, gap): the two rarest terms of a window at most `slop` words
    apart, in any order, and the smallest such gap in each document."""
    pairs = chosen.where(F.col("b").isNotNull())
    a = index.join(pairs, F.col("term") == F.col("a.term")).select("k1", "k2", "win", F.col("b.term").alias("t2"), F.col("pos").alias("p1"), F.explode(F.array(F.floor(F.col("pos") / (slop + 1)) - 1, F.floor(F.col("pos") / (slop + 1)), F.floor(F.col("pos") / (slop + 1)) + 1)).alias("cell"))
    b = index.select("k1", "k2", F.col("term").alias("t2"), F.col("pos").alias("p2"), F.floor(F.col("pos") / (slop + 1)).alias("cell"))
    near = a.join(b, ["k1", "k2", "t2", "cell"]).withColumn("gap", F.abs(F.col("p1") - F.col("p2"))).where(F.col("gap") <= slop)
    return near.groupBy("k1", "k2", "win").agg(F.min("gap").alias("gap"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, width: int = WINDOW) -> DataFrame:
    """docs (doc_id, text, …), benchmark (item_id, text, …) → doc_id, n_words,
    n_hit, n_items, items_sha256, contaminated."""
    return keyed_hits(docs, benchmark, width).drop("k1", "k2")


def keyed_hits(docs: DataFrame, benchmark: DataFrame, width: int = WINDOW) -> DataFrame:
    """As decontaminate, with the key (k1, k2) of each row."""
    scratch = Scratch(docs.sparkSession, "decontam")
    keyed, wins, chosen, index = build(docs, benchmark, scratch, width)
    found = scratch.save(phrase_matches(keyed, chosen, index), "matches")
    # words covered: runs of the windows' starts, merged in order within a document
    spans = found.select("k1", "k2", F.col("start").alias("lo"), (F.col("start") + F.size("win")).alias("hi")).distinct()
    covered = spans.groupBy("k1", "k2").agg(F.sort_array(F.collect_list(F.struct("lo", "hi"))).alias("s"))  # no longer than the document
    zero = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
    step = lambda acc, x: F.struct((acc["n"] + F.greatest(x["hi"] - F.greatest(x["lo"], acc["end"]), F.lit(0))).alias("n"), F.greatest(x["hi"], acc["end"]).alias("end"))
    hits = covered.select("k1", "k2", F.aggregate("s", zero, step)["n"].cast("long").alias("n_hit"))
    items = found.select("k1", "k2", "win").distinct().join(wins.where("item_id is not null"), "win").select("k1", "k2", F.col("item_id").cast("string").alias("i")).distinct()
    items = items.groupBy("k1", "k2").agg(F.sort_array(F.collect_list("i")).alias("items"))  # no more than the benchmark's items
    marks = hits.join(items, ["k1", "k2"], "left")
    counted = index.where(F.col("term") == END).select("k1", "k2", "doc_id", F.col("n_words").cast("long").alias("n_words"))
    out = counted.join(marks, ["k1", "k2"], "left")
    names = F.coalesce("items", F.array().cast("array<string>"))
    return out.select(
        "k1",
        "k2",
        "doc_id",
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.size(names).cast("long").alias("n_items"),
        F.sha2(F.array_join(names, ","), 256).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
    )
