"""Learning and applying bins.

Bounds are 32-bit floats; bins are right-closed. A frame of bounds has a row
(feature, boundaries array<float>) for each feature.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import bin_index, bin_or_raw, col, keyed_bin, one_based, zero_based
from . import aggregate as A

BOUNDS = "feature string, boundaries array<float>"


def equi_freq(dist: DataFrame, num: int) -> DataFrame:
    """Bounds by equal counts. With width = total div num, the m-th bound is
    the first value after the one before whose running count reaches m * width:
    its place is m + max(t_j - j, j <= m), t_j being the first place whose count
    reaches j widths. Where width is 0 the first num-1 values are bounds."""
    run = A.running(dist, "feature", "v", "c")
    level = F.when(F.col("tot") < num, num - 1).otherwise(F.least(F.lit(num - 1).cast("long"), F.expr(f"cum div greatest(tot div {num}, 1)")))
    run = A.stored(run.select("feature", "v", "i", level.cast("int").alias("f")))
    first = run.where("f > 0").groupBy("feature", "f").agg(F.min("i").alias("t"))
    # a level that no value stops at is reached where the next one is
    last = Window.partitionBy("feature").orderBy("f")
    first = first.withColumn("p", F.lag("f", 1, 0).over(last)).select("feature", "t", F.explode(F.sequence(F.col("p") + 1, F.col("f"))).alias("m"))
    place = F.col("m") + F.max(F.col("t") - F.col("m")).over(Window.partitionBy("feature").orderBy("m").rowsBetween(Window.unboundedPreceding, 0))
    wanted = first.select("feature", place.alias("i"))
    found = run.join(wanted, ["feature", "i"]).select("feature", "v")
    return found.groupBy("feature").agg(F.sort_array(F.collect_list(F.col("v").cast("float"))).alias("boundaries"))  # at most num-1


def equi_val(dist: DataFrame, num: int) -> DataFrame:
    """lo + i * (hi - lo) / num for i = 1 .. num-1, in 32-bit arithmetic."""
    width = ((F.col("hi") - F.col("lo")).cast("float") / F.lit(num)).cast("float")
    step = lambda i: (F.col("lo").cast("float") + (i.cast("float") * F.col("w")).cast("float")).cast("float")
    return A.extremes(dist).withColumn("w", width).select("feature", F.transform(F.sequence(F.lit(1), F.lit(num - 1)), step).alias("boundaries"))


METHODS = {"equi_freq": equi_freq, "equi_val": equi_val}


def learn(df: DataFrame, columns: list[str], num: int = 10, method: str = "equi_freq", positive_only: bool = False, digits_only: bool = False) -> DataFrame:
    """Bounds of several columns in one pass; zeros and values that don't
    parse are left out, and a column without values has no row."""
    if method not in METHODS:
        raise ValueError(f"method must be one of {sorted(METHODS)}, not {method!r}")
    if digits_only:
        df = df.select(*[F.when(col(c).cast("string").rlike("^[0-9]+$"), col(c)).alias(c) for c in columns])
    strings = [c for c in columns if df.schema[c].dataType.simpleString() == "string"]
    df = df.select(*[col(c).try_cast("float").alias(c) if c in strings else col(c).cast("float").alias(c) for c in columns])
    dist = A.distribution(df, columns)
    return METHODS[method](A.stored(dist.where("v > 0") if positive_only else dist), num)


def adaptive_bins(df: DataFrame, columns: list[str], num: int, few: int = 4) -> DataFrame:
    """Equal counts in num bins, or in `few` for columns of fewer different values; blank counts as 0 and stays."""
    filled = df.select(*[F.coalesce(col(c).try_cast("float"), F.lit(0).cast("float")).alias(c) for c in columns])
    dist = A.stored(A.melt(filled, [], columns, "feature", "v", "float").groupBy("feature", "v").agg(F.count("*").alias("c")))
    small = A.extremes(dist).where(F.col("n_distinct") < num).select("feature")
    return equi_freq(dist.join(small, "feature", "left_anti"), num).unionByName(equi_freq(dist.join(small, "feature", "left_semi"), few))


def as_columns(bounds: DataFrame, columns: list[str]) -> DataFrame:
    """One row with a column of bounds for each feature, null where there are none."""
    picks = [F.max(F.when(F.col("feature") == c, F.col("boundaries"))).alias(f"_b_{c}") for c in columns]
    return bounds.agg(*picks)


APPLY = {"zero_based": zero_based, "one_based": one_based, "keyed": keyed_bin, "or_raw": bin_or_raw, "plain": bin_index}


def apply(df: DataFrame, bounds: DataFrame, columns: list[str], rule: str = "one_based") -> DataFrame:
    """Columns replaced by their bins. Bounds arrive as one row of at most
    features * (bins - 1) floats, cross-joined as a broadcast; columns
    without bounds stay as they are."""
    wide = df.crossJoin(F.broadcast(as_columns(bounds, columns)))
    text = rule in ("zero_based", "keyed", "or_raw")
    new = {}
    for c in columns:
        own = col(c).cast("string") if text else col(c)
        b = F.col(f"`_b_{c}`")
        if rule == "zero_based":
            b = F.coalesce(b, F.array().cast("array<float>"))
        new[c] = APPLY[rule](own, b) if rule == "zero_based" else F.coalesce(APPLY[rule](own, b).cast("string"), F.when(b.isNull(), col(c).cast("string"))).cast("string" if rule == "or_raw" else "long")
    return wide.withColumns(new).drop(*[f"_b_{c}" for c in columns])


def merge_bounds(saved: DataFrame, learned: DataFrame) -> DataFrame:
    """Both sets; of a feature in both, the saved one."""
    return saved.unionByName(learned.join(saved.select("feature"), "feature", "left_anti"))


def save_bounds(bounds: DataFrame, path: str) -> None:
    """Text lines `feature,b1;b2;…`."""
    bounds.select(F.concat_ws(",", "feature", F.array_join(F.transform("boundaries", lambda b: b.cast("string")), ";"))).write.mode("overwrite").text(path)


def load_bounds(spark, path: str) -> DataFrame:
    """Lines without bounds are skipped."""
    parts = F.split("value", ",")
    lines = spark.read.text(path).where(F.size(parts) > 1)
    return lines.select(parts[0].alias("feature"), F.transform(F.split(parts[1], ";"), lambda b: b.cast("float")).alias("boundaries"))


def discretize_node(df: DataFrame, drop: list[str], learn_columns: list[str], saved: DataFrame | None, label: str, threshold, num: int = 10, method: str = "equi_freq") -> DataFrame:
    """Drop columns, null to 0, learn the given columns, add saved bounds (which
    win), the label from the raw value, bins from 1, all as long."""
    from .project import add_label, nulls_to_zero

    df = nulls_to_zero(df.drop(*drop))
    bounds = learn(df, learn_columns, num, method)
    columns = learn_columns
    if saved is not None:
        bounds = merge_bounds(saved, bounds)
        columns = [c for c in df.columns if c in {*learn_columns, *[r.feature for r in saved.select("feature").collect()]}]  # one name for each feature
    out = apply(add_label(df, label, threshold), bounds, columns, "one_based")
    return out.select(*[col(c).cast("long").alias(c) for c in out.columns])


def column_index_driver(lines: DataFrame, least_fields: int, label: int, leave: list[int], numeric: list[int], num: int) -> DataFrame:
    """Distinct comma-separated lines to label, left columns and 0-based bins."""
    from .project import min_fields

    good = min_fields(lines, "value", least_fields).distinct()
    names = {i: f"c{i}" for i in [label, *leave, *numeric]}
    fields = good.select(*[F.trim(F.split("value", ",")[i]).alias(n) for i, n in names.items()])
    fields = fields.withColumns({names[i]: F.coalesce(col(names[i]).try_cast("double"), F.lit(0.0)) for i in numeric})
    bounds = adaptive_bins(fields, [names[i] for i in numeric], num)
    out = apply(fields, bounds, [names[i] for i in numeric], "plain")
    return out.select(names[label], *[names[i] for i in leave], *[names[i] for i in numeric]).distinct()
