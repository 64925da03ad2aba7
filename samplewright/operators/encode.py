"""Dictionaries, vocabularies, multi-valued features and libsvm."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import EMPTY_LIBSVM, MISSING, col, cross, multi_values
from ..scratch import numbered
from . import aggregate as A
from .join import lookup, unseen

FEW, LEAST = 5000, 1000
DICTIONARY = "field string, value string, idx long"


def ranked(df: DataFrame, group: str, order: list, name: str) -> DataFrame:
    """Rows numbered from 0 within their group, by one sort of all rows by
    ranges: a group that holds most rows is still many tasks."""
    rows = numbered(df, [group, *order], "_at")  # reads what it has written
    first = rows.groupBy(group).agg(F.min("_at").alias("_first"))
    return rows.join(first, group).withColumn(name, F.col("_at") - F.col("_first")).drop("_at", "_first")


def melt_values(df: DataFrame, fields: list[str]) -> DataFrame:
    return A.melt(df, [], fields, "field", "value", "string").where("value is not null")


def encode_learn(df: DataFrame, fields: list[str], known: DataFrame | None = None) -> DataFrame:
    """(field, value, idx): ids of all values in the order of field and value; known ones
    keep theirs, new ones go on after the greatest."""
    values = melt_values(df, fields).distinct()
    if known is None:
        return numbered(values, ["field", "value"])
    top = known.agg(F.max("idx")).head()[0]
    fresh = numbered(unseen(values, known, ["field", "value"]), ["field", "value"], start=0 if top is None else top + 1)
    return known.select("field", "value", "idx").unionByName(fresh)


def encode_apply(df: DataFrame, fields: list[str], dictionary: DataFrame) -> DataFrame:
    for f in fields:
        df = lookup(df, f, dictionary, f)
    return df


def feature_index(df: DataFrame, fields: list[str], few: int = FEW, least: int = LEAST) -> DataFrame:
    """(field, value, cnt, rank): values that occur more than `few` and `least`
    times, ranked from 0 by count within the field, ties by value."""
    known = [f for f in fields if f in df.columns]
    long = A.melt(df, [], known, "field", "_m", "string").where(F.coalesce(F.col("_m"), F.lit(MISSING)) != MISSING)
    each = long.select("field", F.explode(multi_values("_m")).alias("value")).groupBy("field", "value").agg(F.count("*").alias("cnt"))
    return ranked(each.where(F.col("cnt") > max(few, least)), "field", [F.desc("cnt"), "value"], "rank").select("field", "value", "cnt", "rank")


def vocabulary(counts: DataFrame, known: DataFrame | None = None, least: int = 10_000, most: int = 10_000_000) -> DataFrame:
    """(field, token, cnt, idx): known tokens keep their ids; new ones in the
    frequency band get the next ids of their field, most frequent first."""
    if known is None:
        return ranked(counts.where(F.col("cnt").between(least, most)), "field", [F.desc("cnt"), "token"], "idx").select("field", "token", "cnt", "idx")
    old = known.select("field", "token", F.col("idx").cast("long").alias("_old"))
    top = old.groupBy("field").agg(F.max("_old").alias("_top"))
    marked = counts.join(old, ["field", "token"], "left")
    fresh = marked.where(F.col("_old").isNull() & F.col("cnt").between(least, most))
    fresh = ranked(fresh.select("field", "token", "cnt"), "field", [F.desc("cnt"), "token"], "_rank")
    fresh = fresh.join(top, "field", "left").select("field", "token", "cnt", (F.coalesce("_top", F.lit(-1)) + 1 + F.col("_rank")).alias("idx"))
    return marked.where("_old is not null").select("field", "token", "cnt", F.col("_old").alias("idx")).unionByName(fresh)


def top_values(df: DataFrame, ids: list[str], feature: str, top: int, scores: bool, pairs: str = ",", key_value: str = ":") -> DataFrame:
    """The `top` values of a multi-valued `value:score` feature, by score, ties by value.
    scores: keep them (identity), else values alone (dummy)."""
    each = df.select(*[col(i) for i in ids], F.explode(F.split(col(feature), pairs)).alias("_p"))
    parts = F.split("_p", key_value)
    each = each.select(*[col(i) for i in ids], F.trim(parts[0]).alias("value"), F.coalesce(F.get(parts, F.lit(1)).try_cast("double"), F.lit(1.0)).alias("score")).where("value <> ''")
    rank = F.row_number().over(Window.partitionBy(*ids).orderBy(F.desc("score"), "value"))
    kept = each.withColumn("_r", rank).where(F.col("_r") <= top)
    shown = F.concat_ws(key_value, "value", F.col("score").cast("string")) if scores else F.col("value")
    listed = F.array_sort(F.collect_list(F.struct("_r", shown.alias("v"))))
    return kept.groupBy(*ids).agg(F.array_join(F.transform(listed, lambda x: x["v"]), pairs).alias(feature))


def feature_crosses(df: DataFrame, specs: dict[str, list[str]]) -> DataFrame:
    return df.withColumns({name: cross(*deps) for name, deps in specs.items()})


def normal_crosses(specs: list[tuple[str, list[str]]]) -> dict[str, list[str]]:
    """Two dependencies at least; of crosses of one set of columns the first name by order."""
    named: dict[tuple, str] = {}
    for name, deps in specs:
        key = tuple(sorted({d for d in deps if d}))
        if len(key) >= 2:
            named[key] = min(name, named.get(key, name))
    return {name: list(key) for key, name in named.items()}


def libsvm_index(df: DataFrame, columns: list[str]) -> DataFrame:
    """(col, value, idx) of all non-empty values, from 1, by column place and value."""
    place = {c: i for i, c in enumerate(columns)}
    each = F.explode(F.array(*[F.struct(F.lit(i).alias("col"), F.trim(col(c).cast("string")).alias("value")) for c, i in place.items()]))
    values = df.select(each.alias("e")).select("e.*").where(F.col("value").isNotNull() & ~F.col("value").isin(*EMPTY_LIBSVM, "")).distinct()
    return numbered(values, ["col", "value"], start=1)


def libsvm_rows(df: DataFrame, label: str, columns: list[str], index: DataFrame, row_id: list[str]) -> DataFrame:
    """(row_id…, line): `label idx:value …`, ascending by index; row_id tells rows apart."""
    each = F.explode_outer(F.array(*[F.struct(F.lit(i).alias("col"), F.trim(col(c).cast("string")).alias("value")) for i, c in enumerate(columns)]))
    long = df.select(*[col(r) for r in row_id], col(label).cast("string").alias("_label"), each.alias("e")).select(*[col(r) for r in row_id], "_label", "e.*")
    found = long.join(index, ["col", "value"], "left")
    item = F.when(F.col("idx").isNotNull(), F.struct("idx", F.concat_ws(":", F.col("idx").cast("string"), "value").alias("s")))
    lines = found.groupBy(*row_id, "_label").agg(F.array_sort(F.collect_list(item)).alias("_s"))
    return lines.select(*row_id, F.concat_ws(" ", "_label", F.transform("_s", lambda x: x["s"])).alias("line"))


def libsvm_map(index: DataFrame) -> DataFrame:
    """Text lines `c{col}_{value}:{idx}`."""
    return index.select(F.concat(F.lit("c"), F.col("col").cast("string"), F.lit("_"), "value", F.lit(":"), F.col("idx").cast("string")).alias("value"))
