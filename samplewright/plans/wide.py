"""Runs a declared wide-table job (plans.spec): load, discretise, encode, map
ids, join, cross, label, sample, split, save.

Every table is handled alike: its partitions are chosen, numeric features are
binned by saved or learned bounds, categories replaced by dictionary ids (both
may apply to one feature: first bins, then ids of bins), multi-valued features
cut to their top values, columns renamed to feature names. Feature tables whose
from_id and to_id differ move to the other id by a mapping, then join the
action table from the left; several rows of one id count once, so the action
table's rows never multiply.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import bin_index, col, zero_based
from ..operators import discretize as D
from ..operators import encode as E
from ..operators import join as J
from ..operators import sample
from ..scratch import Scratch
from ..sources import partitions, sinks
from ..sources import text as files
from .spec import FeatureSpec, WideSpec

#: The column that names a row's partition, in tables that have one.
PART = "part"
#: Bins that learn_artefacts makes, whatever a feature asks for.
LEARNED_BINS = 1000
INVALID = -1

Reader = Callable[[str], DataFrame]


@dataclass
class WideResult:
    frame: DataFrame
    bounds: dict[str, DataFrame] = field(default_factory=dict)
    dictionaries: dict[str, DataFrame] = field(default_factory=dict)
    written: list[str] = field(default_factory=list)


def reader(spark: SparkSession) -> Reader:
    return lambda source: spark.read.parquet(source) if "/" in source else spark.table(source)


def load(read: Reader, source: str, time: str, day: str) -> DataFrame:
    """A table's partitions by its spec; a table without the partition column is loaded whole."""
    df = read(source)
    return partitions.load(df, PART, time, day).drop(PART) if PART in df.columns else df


def binned(df: DataFrame, features: list[FeatureSpec], saved: DataFrame | None) -> tuple[DataFrame, DataFrame | None]:
    """Discretised features as 0-based bins, -1 where a value is missing or no
    number; bounds that aren't saved are learned, those of one method and number of bins together."""
    todo = [f for f in features if f.discretize]
    if not todo:
        return df, None
    known = set() if saved is None else {r.feature for r in saved.select("feature").collect()}  # one for each feature
    bounds = saved
    kinds = {(f.method, f.bins) for f in todo if f.value_field not in known}
    for method, bins in sorted(kinds):
        names = sorted({f.value_field for f in todo if (f.method, f.bins) == (method, bins) and f.value_field not in known})
        learned = D.learn(df, names, bins, method)
        bounds = learned if bounds is None else bounds.unionByName(learned)
    columns = sorted({f.value_field for f in todo})
    wide = df.crossJoin(F.broadcast(D.as_columns(bounds, columns)))  # one row
    new = {}
    for c in columns:
        b = F.coalesce(F.col(f"`_b_{c}`"), F.array().cast("array<float>"))
        text = df.schema[c].dataType.simpleString() == "string"
        bin_ = zero_based(col(c), b) if text else F.coalesce(F.when(F.size(b) > 0, bin_index(col(c).cast("double"), b)), F.lit(INVALID))
        new[c] = bin_.cast("string")
    return wide.withColumns(new).drop(*[f"_b_{c}" for c in columns]), bounds


def encoded(df: DataFrame, features: list[FeatureSpec], known: DataFrame | None) -> tuple[DataFrame, DataFrame | None]:
    """Encoded features as ids of a dictionary of their table; known ids stay, new values get the next ones."""
    fields = sorted({f.value_field for f in features if f.encode})
    if not fields:
        return df, known
    dictionary = Scratch(df.sparkSession, "dictionary").save(E.encode_learn(df, fields, known), "ids")
    return E.encode_apply(df, fields, dictionary), dictionary


def shaped(df: DataFrame, ids: list[str], features: list[FeatureSpec], saved: DataFrame | None, known: DataFrame | None):
    """(ids and features under their names, bounds, dictionary)."""
    missing = sorted({f.value_field for f in features} - set(df.columns)) + [i for i in ids if i not in df.columns]
    if missing:
        raise ValueError(f"the table has no column {missing}")
    df, bounds = binned(df, features, saved)
    df, dictionary = encoded(df, features, known)
    single = [f for f in features if not (f.kind == "multi" and f.top)]
    out = df.select(*[col(i) for i in ids], *[col(f.value_field).alias(f.name) for f in single if f.name not in ids])
    for f in features:
        if f.kind == "multi" and f.top:
            top = E.top_values(df, ids, f.value_field, f.top, scores=f.operator == "identity")
            out = out.join(top.withColumnRenamed(f.value_field, f.name), ids, "left")
    return out, bounds, dictionary


def saved_artefacts(spark: SparkSession, root: str, name: str) -> tuple[DataFrame | None, DataFrame | None]:
    """(bounds, dictionary) of a table under root, None where there are none."""
    bounds, ids = f"{root}/discretize/{name}", f"{root}/index/{name}"
    return (D.load_bounds(spark, bounds) if files.exists(spark, bounds) else None, spark.read.parquet(ids).select("field", "value", F.col("rank").alias("idx")) if files.exists(spark, ids) else None)


def learn_artefacts(spark: SparkSession, spec: WideSpec, day: str, root: str, read: Reader | None = None, bins: int = LEARNED_BINS, few: int = E.FEW, least: int = E.LEAST) -> list[str]:
    """Bounds of all numeric features and the index of frequent values of all
    categories, of the action table and of every feature table, under root. A
    value's dictionary id is its place among all of its table's, by feature, count and value."""
    read = read or reader(spark)
    tables = [("action", spec.action, "last", spec.context)] + [(t.name, t.source, t.time, t.features) for t in spec.tables]
    written = []
    for name, source, time, features in tables:
        df = load(read, source, time, day)
        numeric = sorted({f.value_field for f in features if f.kind == "numeric" and f.discretize})
        if numeric:
            written.append(f"{root}/discretize/{name}")
            D.save_bounds(D.learn(df, numeric, bins), written[-1])
        categories = sorted({f.value_field for f in features if f.kind != "numeric" and f.encode})
        if categories:
            written.append(f"{root}/index/{name}")
            index = E.numbered(E.feature_index(df, categories, few, least).drop("rank"), ["field", F.desc("cnt"), "value"], "rank")
            sinks.save(index, written[-1], "parquet")
    return written


def build(spark: SparkSession, spec: WideSpec, day: str, read: Reader | None = None, mappings: dict[str, DataFrame] | None = None, artefacts: str | None = None, limit: int = J.PARTNERS) -> WideResult:
    """The wide table: ids, label, features, crosses. mappings: by the name
    `from_id:to_id`, frames of those two columns."""
    read = read or reader(spark)
    saved = lambda name: saved_artefacts(spark, artefacts, name) if artefacts else (None, None)
    result = WideResult(None)
    action = load(read, spec.action, "last", day)
    ids = list(dict.fromkeys([*spec.ids, *([spec.label] if spec.label in action.columns else [])]))
    joins = [t.join_field or t.id_field for t in spec.tables if (t.join_field or t.id_field) in action.columns]
    frame, bounds, dictionary = shaped(action, list(dict.fromkeys([*ids, *joins])), spec.context, *saved("action"))
    result.bounds["action"], result.dictionaries["action"] = bounds, dictionary
    tables = []
    for t in spec.tables:
        df = load(read, t.source, t.time, day)
        if t.id_field not in df.columns:
            raise ValueError(f"the table {t.name} has no column {t.id_field}")
        own, bounds, dictionary = shaped(df, [t.id_field], t.features, *saved(t.name))
        result.bounds[t.name], result.dictionaries[t.name] = bounds, dictionary
        if t.from_id != t.to_id:
            name = f"{t.from_id}:{t.to_id}"
            if name not in (mappings or {}):
                raise ValueError(f"the table {t.name} needs the id mapping {name}")
            own = J.map_features(own, t.id_field, mappings[name], t.from_id, t.to_id, limit)
        tables.append(J.FeatureTable(own, t.id_field, t.join_field or t.id_field, [f.name for f in t.features]))
    # mapped ids are strings, so all ids join as strings
    for t in tables:
        t.frame = t.frame.withColumn(t.id_field, col(t.id_field).cast("string"))
    keys = {t.join_field: f"_join_{t.join_field}" for t in tables if t.join_field in frame.columns}
    frame = frame.withColumns({own: col(c).cast("string") for c, own in keys.items()})
    for t in tables:
        t.join_field = keys.get(t.join_field, t.join_field)
    frame = J.feature_collect(frame, tables).drop(*keys.values())
    frame = E.feature_crosses(frame, spec.crosses) if spec.crosses else frame
    features = [f.name for f in spec.context] + [f.name for t in spec.tables for f in t.features]
    wanted = [f for f in spec.id_features if f in features] or features
    result.frame = frame.select(*[col(c) for c in dict.fromkeys([*ids, *wanted, *spec.crosses])])
    return result


def run(spark: SparkSession, spec: WideSpec, day: str, **options) -> WideResult:
    """build, and for training jobs the sample of the label's groups, the split
    and the files of each kind under the spec's root."""
    result = build(spark, spec, day, **options)
    if spec.task == "predict" or not spec.root:
        return result
    rows = Scratch(spark, "wide").save(result.frame, "rows")
    kept = sample.by_field(rows, spec.label, 1, float(spec.label_rate)) if spec.task == "train" else rows
    names = [n for n in ("train", "val", "test") if spec.split.get(n)] or [spec.task]
    split = sample.hash_split(kept, spec.ids or kept.columns, names, [spec.split.get(n) or 1.0 for n in names])
    result.frame = split
    result.written = sinks.save_splits(split, f"{spec.root}/", day, [k for k in spec.formats if k != "libsvm"] or ["text"])
    if "libsvm" in spec.formats:
        columns = [c for c in rows.columns if c not in {*spec.ids, spec.label}]
        index = E.libsvm_index(rows, columns)
        lines = E.libsvm_rows(split.withColumn("_row", F.monotonically_increasing_id()), spec.label, columns, index, ["_row", "split"])
        result.written += sinks.save_splits(lines.select("line", "split"), f"{spec.root}/", f"{day}libsvm_", ["lines"])
        sinks.save(E.libsvm_map(index), f"{spec.root}/{day}libsvm_map", "lines")
    return result
