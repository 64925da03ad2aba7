"""URL allow and block lists by hashed expressions (operator 3), all in SQL functions.

A url's host suffixes (whole labels) and path prefixes (of the lengths that
the rules use) combine into expressions `host/path`. Expressions meet rules in
an equi-join on the first 4 bytes of their SHA-256, as a client with a
downloaded prefix list would do it; then the full digests and the rule's own
path decide, and of all rules that fit the longest one gives the verdict.

A rule (host, path, verdict) fits its host and all subdomains where the url's
path starts with the rule's path. Ties cannot happen: rules that fit one url
and are equally long are the same rule; a rule listed with both verdicts
blocks. A url that no rule fits is allowed, as in every block list.

Nulls: a null url, or one without `://`, has empty host and path, and no rule.
Repeated rows each get their result; an empty table gives an empty result;
columns of the pages other than the four results are kept as they are, whatever
their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .sparkio import ascii_lower

#: Hex digits of the digest that the join uses.
PREFIX = 8
#: Rules that may be sent to every executor: at some 200 bytes each, 20 MB.
BROADCAST_RULES = 100_000
NO_RULE = "allow"


def host_path(url: Column) -> tuple[Column, Column]:
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url))).otherwise(F.lit(""))
    host = ascii_lower(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1))
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def expressions(host: Column, path: Column, labels: list[int], lengths: list[int]) -> Column:
    """host suffixes of so many labels, each with path prefixes of so many characters."""
    parts = F.split(host, r"\.")
    suffix = lambda n: F.array_join(F.slice(parts, F.size(parts) - n + 1, n), ".")
    hosts = [F.when(F.size(parts) >= n, suffix(n)) for n in labels]
    paths = [F.when(F.length(path) >= n, F.substring(path, 1, n)) for n in lengths]
    each = [F.when(h.isNotNull() & p.isNotNull(), F.struct(h.alias("h"), p.alias("p"))) for h in hosts for p in paths]
    return F.array_compact(F.array(*each))


def digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat(host, F.lit("\n"), path), 256)


def judge_urls(pages: DataFrame, rules: DataFrame, url: str = "url") -> DataFrame:
    """pages with host, path, rule and verdict added (their own columns of
    these names give way). rules: host, path, verdict ('allow' or 'block')."""
    spark = pages.sparkSession
    listed = (
        rules.select(ascii_lower(F.col("host")).alias("h"), F.col("path").alias("p"), "verdict")
        .where("h is not null and p is not null and verdict in ('allow', 'block')")
        .groupBy("h", "p")
        .agg(F.max("verdict").alias("_verdict"))
        .withColumn("_full", digest(F.col("h"), F.col("p")))
        .withColumn("_short", F.substring("_full", 1, PREFIX))
        .withColumn("_rule", F.concat("h", "p"))
        .select("_short", "_full", "_rule", "_verdict", F.size(F.split("h", r"\.")).alias("_labels"), F.length("p").alias("_len"))
    )
    # both sets are bounded by the longest host and the longest path of a rule
    shape = listed.agg(F.count("*").alias("n"), F.collect_set("_labels").alias("labels"), F.collect_set("_len").alias("lens")).head()
    keep = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict")]
    # the caller's columns travel in one struct, out of the way of the names used here
    own = pages.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), F.col(f"`{url}`").alias("_url"))
    urls = own.select("_url").where(F.col("_url").isNotNull()).distinct()
    host, path = host_path(F.col("_url"))
    if not shape["n"]:
        listed = spark.createDataFrame([], "_short string, _full string, _rule string, _verdict string")
    each = expressions(F.col("host"), F.col("path"), sorted(shape["labels"]) or [1], sorted(shape["lens"]) or [1])
    asked = (
        urls.select("_url", host.alias("host"), path.alias("path"))
        .select("_url", F.explode(each).alias("e"))
        .select("_url", digest(F.col("e.h"), F.col("e.p")).alias("_asked"))
        .withColumn("_short", F.substring("_asked", 1, PREFIX))
    )
    small = shape["n"] <= BROADCAST_RULES
    side = listed.select("_short", "_full", "_rule", "_verdict")
    found = asked.join(F.broadcast(side) if small else side, "_short").where("_asked = _full")
    best = found.groupBy("_url").agg(F.max(F.struct(F.length("_rule").alias("n"), F.col("_rule"), F.col("_verdict"))).alias("_best"))
    host, path = host_path(F.col("_url"))
    shown = [F.col(f"row.`{c}`").alias(c) for c in keep]
    return own.join(best, "_url", "left").select(*shown, host.alias("host"), path.alias("path"), F.col("_best._rule").alias("rule"), F.coalesce("_best._verdict", F.lit(NO_RULE)).alias("verdict"))


SQL = r"""
WITH u AS (
  SELECT page_id, CASE WHEN url IS NULL OR instr(url, '://') = 0 THEN '' ELSE substr(url, instr(url, '://') + 3) END AS rest FROM pages),
p AS (
  SELECT page_id, translate(regexp_extract(rest, '(?s)^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '(?s)^[^/?#]*([^?#]*)', 1) AS path FROM u),
r(h, q, v) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
f AS (
  SELECT p.page_id, p.host, p.path, max(struct_pack(n := length(h || q), rule := h || q, v := v)) FILTER (WHERE h IS NOT NULL) AS best
  FROM p LEFT JOIN r ON (p.host = r.h OR ends_with(p.host, '.' || r.h)) AND starts_with(p.path, r.q)
  GROUP BY ALL)
SELECT page_id, host, path, best.rule AS rule, coalesce(best.v, 'allow') AS verdict FROM f
"""
