"""Positive and negative samples from multi-valued tags."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import col, hash_share, multi_values
from ..scratch import Scratch
from . import aggregate as A
from . import encode as E

LEAST_TAGS, BELOW_TAGS, MOST_DRAWN, SELECTED = 3, 30, 50, 4
NEGATIVES = 2
#: Draws of a positive before its field is looked through.
DRAWS = 24


def melt_tags(df: DataFrame, id_col: str, fields: list[str], least: int = LEAST_TAGS, below: int = BELOW_TAGS) -> DataFrame:
    """(wuid, fieldname, feats): the reversed id, of rows with a legal id and few enough tags."""
    own = df.where(F.coalesce(col(id_col).cast("string") != "-1", F.lit(False)) & (F.length(col(id_col).cast("string")) > 0))
    long = A.melt(own, [id_col], fields, "fieldname", "feats", "string").where(F.size(multi_values("feats")).between(least, below - 1))
    return long.select(F.reverse(col(id_col).cast("string")).alias("wuid"), "fieldname", "feats")


def token_stats(melted: DataFrame) -> DataFrame:
    return A.token_frequency(melted, "fieldname", "feats")


def known_tags(melted: DataFrame, vocab: DataFrame) -> DataFrame:
    """(wuid, fieldname, tags): ids of the tags in the vocabulary, in order; rows without any are left out."""
    each = melted.select("wuid", "fieldname", "feats", F.posexplode(multi_values("feats")).alias("_p", "_t"))
    own = vocab.select(F.col("field").alias("_f"), F.col("token").alias("_v"), "idx")
    found = each.join(own, (F.col("fieldname") == F.col("_f")) & (F.col("_t") == F.col("_v")))
    listed = F.array_sort(F.collect_list(F.struct("_p", "idx")))
    return found.groupBy("wuid", "fieldname", "feats").agg(F.transform(listed, lambda x: x["idx"]).alias("tags")).drop("feats")


def _mixed(tags: Column, *keys) -> Column:
    """An array in an order that a hash of the row and the item gives."""
    mark = lambda t: F.struct(F.md5(F.concat_ws("#", *keys, t.cast("string"))).alias("h"), t.alias("t"))
    return F.transform(F.array_sort(F.transform(tags, mark)), lambda x: x["t"])


def positives(rows: DataFrame, rounds: int = 2, seed: int = 36) -> DataFrame:
    """Up to `rounds` samples of each row of over 2 different tags: sample_tags
    is a random part of 1 to min(n-1, 50) tags, select_tag up to 4 of the rest;
    label 1. Draws are hashes of the row, so a task that runs again draws the same."""
    base = rows.withColumn("tags", F.array_distinct("tags")).where(F.size("tags") > 2)
    base = base.withColumn("_k", F.explode(F.sequence(F.lit(seed), F.lit(seed + rounds - 1)).cast("array<string>")))
    keys = [F.col("wuid"), F.col("fieldname"), F.col("_k")]
    n = F.lit(1) + F.floor(hash_share("wuid", "fieldname", "_k", seed=seed) * F.least(F.size("tags") - 1, F.lit(MOST_DRAWN)))
    mixed = base.withColumns({"_m": _mixed(F.col("tags"), *keys), "_n": n.cast("int")})
    return mixed.select("wuid", "fieldname", "tags", F.slice("_m", F.lit(1), F.col("_n")).alias("sample_tags"), F.slice("_m", F.col("_n") + 1, F.lit(SELECTED)).alias("select_tag"), F.lit(1).alias("label"))


def unigram_weights(counts: DataFrame, power: float = 0.75) -> DataFrame:
    own = counts.withColumn("_w", F.pow(F.col("cnt").cast("double"), power))
    total = own.groupBy("field").agg(F.sum("_w").alias("_t"))
    return own.join(total, "field").withColumn("weight", F.col("_w") / F.col("_t")).drop("_w", "_t")


def cumulative(vocab: DataFrame) -> DataFrame:
    """(field, idx, cnt, lo, hi, total): each tag's share of its field as a range of whole numbers, in the order of idx."""
    own = A.stored(vocab.select("field", "idx", "cnt"))
    run = A.running(own, "field", "idx", "cnt")
    return run.select("field", "idx", "cnt", (F.col("cum") - F.col("cnt")).alias("lo"), F.col("cum").alias("hi"), F.col("tot").alias("total"))


def drawn(draws: DataFrame, ranges: DataFrame) -> DataFrame:
    """draws (field, r, …) with the idx whose range holds r. An equi-join on
    cells, as many for each field as it has tags, so a cell has few tags."""
    sized = ranges.groupBy("field").agg(F.count("*").alias("_v"), F.max("total").alias("_total")).select("field", F.ceil(F.col("_total") / F.col("_v")).cast("long").alias("_w"))
    sized = F.broadcast(sized)  # a row for each field
    cells = ranges.join(sized, "field").select("field", "idx", "lo", "hi", F.explode(F.sequence(F.expr("lo div _w"), F.expr("(hi - 1) div _w"))).alias("_cell"))
    asked = draws.join(sized, "field").withColumn("_cell", F.expr("r div _w")).drop("_w")
    return asked.join(cells, ["field", "_cell"]).where("r >= lo and r < hi").drop("_cell", "lo", "hi")


def negatives(pos: DataFrame, vocab: DataFrame, groups: int = NEGATIVES, seed: int = 37) -> DataFrame:
    """For each positive, up to `groups` rows of 4 tags of its field that it
    doesn't have, drawn by rate without replacement; label 0.

    A positive makes DRAWS draws by hash; tags that it has and tags drawn
    before are rejected. Where that isn't enough although the field has more,
    the other tags follow by the key -ln(u) / count, so small fields are drawn
    from in full. The vocabulary is joined by ranges of its running counts, and
    never gathers in one row or task."""
    need = groups * SELECTED
    scratch = Scratch(pos.sparkSession, "negatives")
    ranges = scratch.save(cumulative(vocab), "ranges")
    fields = F.broadcast(ranges.groupBy("field").agg(F.max("total").alias("total"), F.count("*").alias("size")))
    row = F.md5(F.concat_ws("#", "wuid", "fieldname", F.array_join(F.col("sample_tags").cast("array<string>"), ",")))
    own = scratch.save(pos.select(row.alias("row"), "wuid", "fieldname", "tags", "sample_tags").dropDuplicates(["row"]), "positives")
    share = lambda *parts: F.conv(F.substring(F.md5(F.concat_ws("#", *parts, F.lit(str(seed)))), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))
    asked = own.select("row", "tags", F.col("fieldname").alias("field"), F.explode(F.sequence(F.lit(0), F.lit(DRAWS - 1))).alias("j")).join(fields, "field")
    asked = asked.withColumn("r", F.floor(share(F.col("row"), F.col("j").cast("string")) * F.col("total")).cast("long")).select("row", "tags", "field", "j", "r")
    got = drawn(asked, ranges).where(~F.array_contains("tags", F.col("idx"))).groupBy("row", "idx").agg(F.min("j").alias("j"))
    got = scratch.save(got.select("row", "idx", F.col("j").cast("double").alias("key"), F.lit(0).alias("later")), "drawn")
    # positives that are short of tags which their field still has
    count = got.groupBy("row").agg(F.count("*").alias("n"))
    known = own.join(fields, F.col("fieldname") == F.col("field")).join(count, "row", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    short = known.where((F.col("n") < need) & (F.col("n") < F.col("size") - F.size("tags"))).select("row", "field", "tags")
    rest = short.join(ranges.select("field", "idx", "cnt"), "field").where(~F.array_contains("tags", F.col("idx"))).join(got.select("row", "idx"), ["row", "idx"], "left_anti")
    late = -F.log((share(F.col("row"), F.col("idx").cast("string")) + F.lit(2.0**-53))) / F.col("cnt")
    every = got.unionByName(rest.select("row", "idx", late.alias("key"), F.lit(1).alias("later")))
    place = F.row_number().over(Window.partitionBy("row").orderBy("later", "key", "idx"))
    best = every.withColumn("place", place).where(F.col("place") <= need)
    first = best.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("place", "idx"))).alias("b"))  # `need` at most
    split = own.join(first, "row").withColumn("_b", F.transform("b", lambda x: x["idx"]))
    group = F.explode(F.transform(F.sequence(F.lit(0), F.lit(groups - 1)), lambda g: F.slice("_b", g * SELECTED + 1, SELECTED)))
    out = split.select("wuid", "fieldname", "tags", "sample_tags", group.alias("select_tag"), F.lit(0).alias("label"))
    return out.where(F.size("select_tag") > 0)


def pair_samples(rows: DataFrame, vocab: DataFrame, most: int = 10, extra: int = 5, tries: int = 4, seed: int = 38) -> DataFrame:
    """(wuid, fieldname, tag, context, label): min(k + extra, most) pairs of two
    tags of a row, k drawn below its number of tags, label 1; and for each one
    or two tags that the row doesn't have in the place of the second, label 0.
    Of `tries` draws for a negative the first that isn't rejected counts; where
    all are, it is left out. Draws are hashes of the row."""
    base = rows.withColumn("tags", F.array_distinct("tags")).where(F.size("tags") > 1)
    n = F.least(F.floor(hash_share("wuid", "fieldname", seed=seed) * F.size("tags")).cast("int") + extra, F.lit(most))
    pairs = base.withColumn("_j", F.explode(F.sequence(F.lit(0), n - 1)))
    pairs = pairs.withColumn("_m", _mixed(F.col("tags"), F.col("wuid"), F.col("fieldname"), F.col("_j").cast("string"), F.lit(str(seed))))
    pairs = pairs.select("wuid", "fieldname", "tags", "_j", F.col("_m")[0].alias("tag"), F.col("_m")[1].alias("context"))
    ranges = Scratch(rows.sparkSession, "pairs").save(cumulative(vocab), "ranges")
    fields = F.broadcast(ranges.groupBy("field").agg(F.max("total").alias("total")))
    many = F.lit(1) + F.floor(hash_share("wuid", "fieldname", "_j", seed=seed + 1) * 2).cast("int")
    asked = pairs.withColumn("_g", F.explode(F.sequence(F.lit(1), many))).withColumn("_t", F.explode(F.sequence(F.lit(1), F.lit(tries))))
    asked = asked.withColumnRenamed("fieldname", "field").join(fields, "field")
    asked = asked.withColumn("r", F.floor(hash_share("wuid", "field", "_j", "_g", "_t", seed=seed + 2) * F.col("total")).cast("long"))
    fresh = drawn(asked, ranges).where(~F.array_contains("tags", F.col("idx")))
    chosen = fresh.groupBy("wuid", "field", "_j", "_g", "tag").agg(F.min_by("idx", "_t").alias("context"))
    return pairs.select("wuid", "fieldname", "tag", "context", F.lit(1).alias("label")).unionAll(chosen.select("wuid", F.col("field").alias("fieldname"), "tag", "context", F.lit(0).alias("label")))


def pretrain_samples(df: DataFrame, id_col: str, fields: list[str], known: DataFrame | None = None, least: int = 10_000, most: int = 10_000_000, seed: int = 36) -> tuple[DataFrame, DataFrame]:
    """(samples, vocabulary) of a tag table."""
    melted = melt_tags(df, id_col, fields)
    vocab = E.vocabulary(token_stats(melted), known, least, most)
    pos = positives(known_tags(melted, vocab), seed=seed)
    return pos.unionByName(negatives(pos, vocab, seed=seed + 1)), vocab
