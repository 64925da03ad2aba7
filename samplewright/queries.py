"""Registered queries of the sample-preparation operators, and their SQL.

Every entry reads whole tables. SQL is what another engine runs for the same
rows. Operators that draw do so by hashes of their rows, so SQL can draw the same.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import aggregate as A
from .operators import discretize as D
from .operators import encode as E
from .operators import join as J
from .operators import pretrain as P
from .operators import project, sample
from .plans import nodes, workflow
from .sources import partitions
from .streaming import events as S

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}
PRICE, SEED = 150_000.0, 36
NUMERIC = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def query(sql: str | None = None):
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def melt_sql(source: str, columns: list[str]) -> str:
    return " UNION ALL ".join(f"SELECT '{c}' AS feature, {c} AS x FROM {source}" for c in columns)


def bounds_sql(long: str, n: int, name: str = "b", positive: bool = False, zero: bool = False) -> str:
    """CTEs that end in {name}(feature, b); zero: zeros count too."""
    p = name
    fit = "IS NOT NULL" if zero else "> 0" if positive else "<> 0"
    return f"""
{p}_d AS (SELECT feature, CAST(x AS FLOAT) v, count(*) c FROM ({long}) WHERE CAST(x AS FLOAT) {fit} GROUP BY ALL),
{p}_w AS (SELECT *, row_number() OVER (PARTITION BY feature ORDER BY v) i, sum(c) OVER (PARTITION BY feature ORDER BY v ROWS UNBOUNDED PRECEDING) cum, sum(c) OVER (PARTITION BY feature) tot FROM {p}_d),
{p}_f AS (SELECT *, CASE WHEN tot < {n} THEN {n - 1} ELSE least({n - 1}, cum // (tot // {n})) END f FROM {p}_w),
{p}_k AS (SELECT *, i + least(0, min(f - i) OVER (PARTITION BY feature ORDER BY v ROWS UNBOUNDED PRECEDING)) k FROM {p}_f),
{p}_e AS (SELECT *, lag(k, 1, 0) OVER (PARTITION BY feature ORDER BY v) pk FROM {p}_k),
{p} AS (SELECT feature, list(v ORDER BY v) b FROM {p}_e WHERE k > pk GROUP BY feature)"""


def bin_sql(x: str, feature: str, name: str = "b") -> str:
    return f"len(list_filter((SELECT b FROM {name} WHERE feature = '{feature}'), lambda v: v < {x}))"


WIDE = "SELECT o.o_orderkey, o.o_totalprice, c.c_acctbal, c.c_mktsegment, n.n_name FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey"


def wide(spark, sf_dir) -> DataFrame:
    t = lambda n: table(spark, sf_dir, n)
    return J.feature_collect(
        t("orders"),
        [J.FeatureTable(t("customer"), "c_custkey", "o_custkey", ["c_acctbal", "c_mktsegment", "c_nationkey"]), J.FeatureTable(t("nation"), "n_nationkey", "c_nationkey", ["n_name"])],
        ["o_orderkey", "o_totalprice", "c_acctbal", "c_mktsegment", "n_name"],
    )


@query(f"""WITH t AS ({WIDE}), {bounds_sql(melt_sql('t', ['o_totalprice', 'c_acctbal']), 10)}
SELECT o_orderkey, c_mktsegment, n_name, CAST({bin_sql('coalesce(o_totalprice, 0)', 'o_totalprice')} + 1 AS BIGINT) AS o_totalprice,
CAST({bin_sql('coalesce(c_acctbal, 0)', 'c_acctbal')} + 1 AS BIGINT) AS c_acctbal, CAST(CASE WHEN o_totalprice >= {PRICE} THEN 1 ELSE 0 END AS BIGINT) AS label FROM t""")
def wide_table_orders(spark, sf_dir):
    t = project.add_label(wide(spark, sf_dir), "o_totalprice", PRICE).withColumn("label", F.col("label").cast("long"))
    columns = ["o_totalprice", "c_acctbal"]
    return D.apply(t, D.learn(t, columns), columns)


def _bounds(b: DataFrame) -> DataFrame:
    return b.select("feature", F.posexplode("boundaries").alias("place", "bound")).select("feature", F.col("place").cast("long").alias("place"), F.col("bound").cast("double").alias("bound"))


UNNEST = "SELECT feature, CAST(unnest(range(0, len(b))) AS BIGINT) AS place, CAST(unnest(b) AS DOUBLE) AS bound FROM b"


@query(f"WITH {bounds_sql(melt_sql('lineitem', NUMERIC), 10)} {UNNEST}")
def equifreq_bounds_lineitem(spark, sf_dir):
    return _bounds(D.learn(table(spark, sf_dir, "lineitem"), NUMERIC))


@query(f"WITH {bounds_sql(melt_sql('lineitem', NUMERIC), 1000)} {UNNEST}")
def equifreq_bounds_1000(spark, sf_dir):
    return _bounds(D.learn(table(spark, sf_dir, "lineitem"), NUMERIC, 1000))


@query(f"""WITH m AS (SELECT feature, min(CAST(x AS FLOAT)) lo, max(CAST(x AS FLOAT)) hi FROM ({melt_sql('lineitem', NUMERIC)}) WHERE CAST(x AS FLOAT) <> 0 GROUP BY feature),
w AS (SELECT feature, lo, CAST(CAST(hi - lo AS FLOAT) / 10 AS FLOAT) w FROM m)
SELECT feature, CAST(i - 1 AS BIGINT) AS place, CAST(CAST(lo + CAST(CAST(i AS FLOAT) * w AS FLOAT) AS FLOAT) AS DOUBLE) AS bound FROM w, range(1, 10) r(i)""")
def equival_bounds_lineitem(spark, sf_dir):
    return _bounds(D.learn(table(spark, sf_dir, "lineitem"), NUMERIC, 10, "equi_val"))


@query(f"SELECT feature, CAST(count(DISTINCT v) AS BIGINT) AS n_distinct, CAST(sum(c) AS BIGINT) AS n, min(v) AS lo, max(v) AS hi FROM (SELECT feature, CAST(x AS FLOAT) v, count(*) c FROM ({melt_sql('lineitem', NUMERIC)}) WHERE CAST(x AS FLOAT) <> 0 GROUP BY ALL) GROUP BY feature")
def value_distribution(spark, sf_dir):
    return A.extremes(A.distribution(table(spark, sf_dir, "lineitem"), NUMERIC))


TEXTS = "SELECT c_custkey, CASE c_custkey % 7 WHEN 0 THEN '' WHEN 1 THEN 'abc' WHEN 2 THEN '-3' WHEN 3 THEN '1.2.3' ELSE CAST(CAST(c_acctbal AS INTEGER) AS VARCHAR) END AS x FROM customer"
FIXED = "b AS (SELECT 'x' AS feature, [CAST(100 AS FLOAT), 1000, 5000.5] AS b)"


def _texts(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey") % 7
    x = F.when(k == 0, "").when(k == 1, "abc").when(k == 2, "-3").when(k == 3, "1.2.3").otherwise(F.rint("c_acctbal").cast("int").cast("string"))
    return c.select("c_custkey", x.alias("x")), spark.createDataFrame([("x", [100.0, 1000.0, 5000.5])], D.BOUNDS)


def _binned(rule):
    def run(spark, sf_dir):
        df, b = _texts(spark, sf_dir)
        out = D.apply(df, b, ["x"], rule)
        return out if rule == "or_raw" else out.select("c_custkey", F.col("x").cast("long").alias("x"))

    return run


def _named(name, f, sql=None):
    f.__name__ = name
    return query(sql)(f)


_named("discretize_zero_based", _binned("zero_based"), f"WITH {FIXED}, t AS ({TEXTS}) SELECT c_custkey, CAST(coalesce(CASE WHEN regexp_full_match(x, '[0-9]|[0-9.]{{2,}}') THEN {bin_sql('TRY_CAST(x AS DOUBLE)', 'x')} + 0 * TRY_CAST(x AS DOUBLE) END, -1) AS BIGINT) AS x FROM t")
_named("discretize_keyed_null", _binned("keyed"), f"WITH {FIXED}, t AS ({TEXTS}) SELECT c_custkey, CAST(CASE WHEN TRY_CAST(x AS DOUBLE) >= 0 THEN {bin_sql('TRY_CAST(x AS DOUBLE)', 'x')} END AS BIGINT) AS x FROM t")
_named("discretize_passthrough", _binned("or_raw"), f"WITH {FIXED}, t AS ({TEXTS}) SELECT c_custkey, CASE WHEN TRY_CAST(x AS DOUBLE) IS NULL THEN x ELSE CAST({bin_sql('TRY_CAST(x AS DOUBLE)', 'x')} AS VARCHAR) END AS x FROM t")


def _bin_select(columns, one=1):
    return ", ".join(f"CAST({bin_sql(f'coalesce({c}, 0)', c)} + {one} AS BIGINT) AS {c}" for c in columns)


@query(f"WITH {bounds_sql(melt_sql('lineitem', NUMERIC), 10)} SELECT l_orderkey, l_linenumber, {_bin_select(NUMERIC)} FROM lineitem")
def discretize_one_based(spark, sf_dir):
    t = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", *NUMERIC)
    return D.apply(t, D.learn(t, NUMERIC), NUMERIC)


@query(f"""WITH {bounds_sql(melt_sql('customer', ['c_acctbal']), 8, positive=True)} SELECT c_custkey, CAST({bin_sql('c_acctbal', 'c_acctbal')} AS BIGINT) AS c_acctbal FROM customer""")
def discretize_positive_learned(spark, sf_dir):
    t = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    return D.apply(t, D.learn(t, ["c_acctbal"], 8, positive_only=True), ["c_acctbal"], "plain")


@query(f"""WITH {bounds_sql(melt_sql('lineitem', ['l_quantity', 'l_tax']), 10, 'q')}, b AS (SELECT 'l_tax' AS feature, [CAST(0.02 AS FLOAT), 0.05] AS b UNION ALL SELECT feature, b FROM q WHERE feature <> 'l_tax')
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, CAST(CASE WHEN l_quantity >= 25 THEN 1 ELSE 0 END AS BIGINT) AS label, {_bin_select(['l_quantity', 'l_tax'])} FROM lineitem""")
def discretize_saved_boundaries(spark, sf_dir):
    t = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_tax", "l_discount")
    saved = spark.createDataFrame([("l_tax", [0.02, 0.05])], D.BOUNDS)
    return D.discretize_node(t, ["l_discount"], ["l_quantity", "l_tax"], saved, "l_quantity", 25)


@query(f"""WITH t AS (SELECT DISTINCT l_linestatus AS c0, l_returnflag AS c1, l_quantity AS c2, l_discount AS c3 FROM lineitem),
{bounds_sql(melt_sql('t', ['c2', 'c3']).replace('c2 AS x', 'c2 + 1 AS x').replace('c3 AS x', 'c3 + 1 AS x'), 20, 'x')},
d AS (SELECT feature, count(DISTINCT v) n FROM (SELECT 'c2' feature, CAST(c2 AS FLOAT) v FROM t UNION ALL SELECT 'c3', CAST(c3 AS FLOAT) FROM t) GROUP BY feature)
SELECT feature, CAST(n AS BIGINT) AS n_distinct, CAST(CASE WHEN n < 20 THEN 4 ELSE 20 END AS BIGINT) AS bins FROM d""")
def adaptive_bin_counts(spark, sf_dir):
    t = table(spark, sf_dir, "lineitem").select(F.col("l_linestatus").alias("c0"), F.col("l_returnflag").alias("c1"), F.col("l_quantity").alias("c2"), F.col("l_discount").alias("c3")).distinct()
    made = D.adaptive_bins(t, ["c2", "c3"], 20).select("feature", (F.size("boundaries") + 1).cast("long").alias("bins"))
    counts = A.extremes(A.melt(t, [], ["c2", "c3"], "feature", "v", "float").groupBy("feature", "v").agg(F.count("*").alias("c")))
    return counts.join(made, "feature").select("feature", "n_distinct", "bins")


VALUES = "SELECT 'p_brand' AS field, p_brand AS value FROM part UNION SELECT 'p_type', p_type FROM part"


@query(f"SELECT field, value, row_number() OVER (ORDER BY field, value) - 1 AS idx FROM ({VALUES})")
def category_encode(spark, sf_dir):
    return E.encode_learn(table(spark, sf_dir, "part"), ["p_brand", "p_type"])


HALF = VALUES.replace("FROM part", "FROM part WHERE p_partkey % 2 = 0 AND p_size < 3")


@query(f"""WITH old AS (SELECT field, value, row_number() OVER (ORDER BY field, value) - 1 AS idx FROM ({HALF})),
new AS (SELECT a.field, a.value FROM ({VALUES}) a ANTI JOIN old USING (field, value))
SELECT * FROM old UNION ALL SELECT field, value, row_number() OVER (ORDER BY field, value) + (SELECT max(idx) FROM old) AS idx FROM new""")
def category_encode_incremental(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    old = E.encode_learn(part.where("p_partkey % 2 = 0 and p_size < 3"), ["p_brand", "p_type"])
    return E.encode_learn(part, ["p_brand", "p_type"], old)


@query(f"""WITH d AS (SELECT field, value, row_number() OVER (ORDER BY field, value) - 1 AS idx FROM ({HALF}))
SELECT p_partkey, coalesce(CAST(a.idx AS VARCHAR), p_brand) AS p_brand, coalesce(CAST(b.idx AS VARCHAR), p_type) AS p_type FROM part
LEFT JOIN d a ON a.field = 'p_brand' AND a.value = p_brand LEFT JOIN d b ON b.field = 'p_type' AND b.value = p_type""")
def category_apply(spark, sf_dir):
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type", "p_size")
    d = E.encode_learn(part.where("p_partkey % 2 = 0 and p_size < 3"), ["p_brand", "p_type"])
    return E.encode_apply(part.drop("p_size"), ["p_brand", "p_type"], d)


@query("""WITH c AS (SELECT 'l_returnflag' AS field, l_returnflag AS value, count(*) AS cnt FROM lineitem GROUP BY ALL UNION ALL SELECT 'l_linestatus', l_linestatus, count(*) FROM lineitem GROUP BY ALL)
SELECT field, value, CAST(cnt AS BIGINT) AS cnt, row_number() OVER (PARTITION BY field ORDER BY cnt DESC, value) - 1 AS rank FROM c WHERE cnt > 5000""")
def category_index_topcount(spark, sf_dir):
    return E.feature_index(table(spark, sf_dir, "lineitem"), ["l_returnflag", "l_linestatus"])


PAIRS = "SELECT user_id, event_type, count(*) AS c FROM events GROUP BY ALL"


@query(f"""WITH r AS (SELECT user_id, event_type, c, row_number() OVER (PARTITION BY user_id ORDER BY c DESC, event_type) r FROM ({PAIRS}))
SELECT user_id, string_agg(event_type, ',' ORDER BY r) AS kinds FROM r WHERE r <= 2 GROUP BY user_id""")
def multi_value_topn(spark, sf_dir):
    c = table(spark, sf_dir, "events").groupBy("user_id", "event_type").agg(F.count("*").alias("c"))
    packed = c.groupBy("user_id").agg(F.array_join(F.array_sort(F.collect_list(F.concat_ws(":", "event_type", F.col("c").cast("string")))), ",").alias("kinds"))
    return E.top_values(packed, ["user_id"], "kinds", 2, scores=False)


@query("SELECT p_partkey, p_brand || '_' || CAST(p_size AS VARCHAR) AS brand_size, p_brand || '_' || p_type AS brand_type FROM part")
def feature_cross(spark, sf_dir):
    return E.feature_crosses(table(spark, sf_dir, "part"), {"brand_size": ["p_size", "p_brand"], "brand_type": ["p_brand", "p_type"]}).select("p_partkey", "brand_size", "brand_type")


@query("SELECT CAST(o_custkey AS VARCHAR) AS id, l_linenumber, l_quantity FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_custkey <> 0 AND o_orderkey <> 0")
def id_mapping_inner(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("id"), "l_linenumber", "l_quantity")
    return J.map_ids(rows, "id", table(spark, sf_dir, "orders"), "o_orderkey", "o_custkey").select("id", "l_linenumber", "l_quantity")


def _cut_sql(side: str, limit: int) -> str:
    return f"""WITH p AS (SELECT DISTINCT CAST(l_partkey AS VARCHAR) AS from_id, CAST(l_suppkey AS VARCHAR) AS to_id FROM lineitem WHERE l_partkey <> 0 AND l_suppkey <> 0),
d AS (SELECT {side}, count(*) n FROM p GROUP BY ALL) SELECT p.from_id, p.to_id FROM p JOIN d USING ({side}) WHERE n < {limit}"""


@query(_cut_sql("from_id", 25))
def id_mapping_cut(spark, sf_dir):
    return J.cut(table(spark, sf_dir, "lineitem"), "l_partkey", "l_suppkey", 25)


@query(_cut_sql("to_id", 500))
def id_mapping_cut_to(spark, sf_dir):
    return J.cut(table(spark, sf_dir, "lineitem"), "l_partkey", "l_suppkey", 500, "to_id")


@query(f"WITH c AS ({_cut_sql('from_id', 25)}) SELECT c.to_id AS id, p_size, p_brand FROM part JOIN c ON CAST(p_partkey AS VARCHAR) = c.from_id")
def id_mapping_features(spark, sf_dir):
    part = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), "p_size", "p_brand")
    return J.map_features(part, "id", table(spark, sf_dir, "lineitem"), "l_partkey", "l_suppkey", 25).select("id", "p_size", "p_brand")


STATUS = "SELECT o_custkey, o_orderstatus, count(*) AS n, max(o_orderkey) AS top FROM orders GROUP BY ALL"


def _cell(v, c):
    return f"coalesce(max(CASE WHEN o_orderstatus = '{v}' THEN CAST({c} AS VARCHAR) END), '-1') AS \"{v}_{c}\""


@query(f"SELECT {', '.join(_cell(v, c) for v in 'FOX' for c in ('n', 'top'))}, o_custkey FROM ({STATUS}) GROUP BY o_custkey")
def pivot_extend(spark, sf_dir):
    t = table(spark, sf_dir, "orders").groupBy("o_custkey", "o_orderstatus").agg(F.count("*").alias("n"), F.max("o_orderkey").alias("top"))
    return A.pivot_extend(t, "o_custkey", "o_orderstatus", list("FOX"))


SVM = "SELECT DISTINCT 0 AS col, l_linestatus AS value FROM lineitem UNION SELECT 1, CAST(l_linenumber AS VARCHAR) FROM lineitem"


@query(f"SELECT CAST(col AS BIGINT) AS col, value, row_number() OVER (ORDER BY col, value) AS idx FROM ({SVM})")
def libsvm_index(spark, sf_dir):
    return E.libsvm_index(table(spark, sf_dir, "lineitem"), ["l_linestatus", "l_linenumber"]).withColumn("col", F.col("col").cast("long"))


@query(f"""WITH x AS (SELECT col, value, row_number() OVER (ORDER BY col, value) AS idx FROM ({SVM}))
SELECT l_orderkey, l_linenumber, l_returnflag || ' ' || CAST(a.idx AS VARCHAR) || ':' || l_linestatus || ' ' || CAST(b.idx AS VARCHAR) || ':' || CAST(l_linenumber AS VARCHAR) AS line
FROM lineitem JOIN x a ON a.col = 0 AND a.value = l_linestatus JOIN x b ON b.col = 1 AND b.value = CAST(l_linenumber AS VARCHAR)""")
def libsvm_rows(spark, sf_dir):
    t = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus", F.monotonically_increasing_id().alias("row"))
    columns = ["l_linestatus", "l_linenumber"]
    return E.libsvm_rows(t, "l_returnflag", columns, E.libsvm_index(t, columns), ["row", "l_orderkey", "l_linenumber"]).select("l_orderkey", "l_linenumber", "line")


@query("SELECT l_returnflag AS label, count(*) AS cnt, CASE WHEN count(*) < 2000 THEN 1.0::DOUBLE ELSE 2000.0::DOUBLE / count(*) END AS fraction FROM lineitem GROUP BY 1")
def label_fractions(spark, sf_dir):
    return sample.fractions(table(spark, sf_dir, "lineitem"), "l_returnflag", 2000)


SHARE = "CAST(('0x' || substr(md5(CAST(o_orderkey AS VARCHAR) || '#' || '36'), 1, 8)) AS BIGINT) / 4294967296.0::DOUBLE"


@query(f"SELECT o_orderkey, CASE WHEN {SHARE} < 0.7 THEN 'train' WHEN {SHARE} < 0.85 THEN 'val' ELSE 'test' END AS split FROM orders")
def hash_split(spark, sf_dir):
    return sample.hash_split(table(spark, sf_dir, "orders").select("o_orderkey"), ["o_orderkey"], ["train", "val", "test"], [0.7, 0.15, 0.15], SEED)


@query(f"""SELECT o_orderkey, 'urgent' AS experiment, CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END AS label FROM orders WHERE {SHARE} < 0.25 AND o_orderpriority IN ('1-URGENT', '5-LOW')""")
def experiment_split(spark, sf_dir):
    t = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    return sample.experiments(t, "o_orderkey", "o_orderpriority", [{"name": "urgent", "positive": ["1-URGENT"], "negative": ["5-LOW"]}]).drop("o_orderpriority")


TAGS = "SELECT user_id * 10 + event_id % 10 AS user_id, string_agg(event_type, ',' ORDER BY ts, event_id) AS kinds, string_agg(CAST(event_id // 10 % 50 AS VARCHAR), ',' ORDER BY ts, event_id) AS items FROM events GROUP BY 1"


def _tags(spark, sf_dir) -> DataFrame:
    listed = lambda e: F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ts", "event_id", e.alias("v")))), lambda x: x["v"]), ",")
    t = table(spark, sf_dir, "events").groupBy((F.col("user_id") * 10 + F.col("event_id") % 10).cast("string").alias("wuid"))
    return t.agg(listed(F.col("event_type")).alias("kinds"), listed((F.expr("event_id div 10") % 50).cast("string")).alias("items"))


MELTED = f"""t AS ({TAGS}), l AS (SELECT user_id, 'kinds' AS fieldname, kinds AS feats FROM t UNION ALL SELECT user_id, 'items', items FROM t),
m AS (SELECT reverse(CAST(user_id AS VARCHAR)) AS wuid, fieldname, feats FROM l WHERE len(string_split(feats, ',')) BETWEEN 3 AND 29)"""
COUNTS = f"{MELTED}, c AS (SELECT fieldname AS field, token, count(*) AS cnt FROM (SELECT fieldname, unnest(string_split(feats, ',')) AS token FROM m) GROUP BY ALL)"


@query(f"WITH {MELTED} SELECT * FROM m")
def melt_tags(spark, sf_dir):
    return P.melt_tags(_tags(spark, sf_dir), "wuid", ["kinds", "items"])


@query(f"WITH {COUNTS} SELECT field, token, cnt FROM c")
def token_frequency(spark, sf_dir):
    return P.token_stats(melt_tags(spark, sf_dir))


VOCAB = f"{COUNTS}, v AS (SELECT field, token, cnt, row_number() OVER (PARTITION BY field ORDER BY cnt DESC, token) - 1 AS idx FROM c WHERE cnt BETWEEN 20 AND 1000000)"


def _vocab(spark, sf_dir):
    return E.vocabulary(token_frequency(spark, sf_dir), None, 20, 1_000_000)


@query(f"WITH {VOCAB} SELECT field, token, cnt, idx FROM v")
def vocab_build(spark, sf_dir):
    return _vocab(spark, sf_dir)


@query(f"""WITH {VOCAB}, k AS (SELECT field, token, idx FROM v WHERE idx % 2 = 0), top AS (SELECT field, max(idx) AS top FROM k GROUP BY field),
f AS (SELECT c.field, c.token, c.cnt FROM c ANTI JOIN k USING (field, token) WHERE c.cnt BETWEEN 10 AND 1000000)
SELECT c.field, c.token, c.cnt, k.idx FROM c JOIN k USING (field, token)
UNION ALL SELECT f.field, f.token, f.cnt, coalesce(top.top, -1) + row_number() OVER (PARTITION BY f.field ORDER BY f.cnt DESC, f.token) AS idx FROM f LEFT JOIN top USING (field)""")
def vocab_extend(spark, sf_dir):
    return E.vocabulary(token_frequency(spark, sf_dir), _vocab(spark, sf_dir).where("idx % 2 = 0"), 10, 1_000_000)


@query(f"""WITH {VOCAB}, e AS (SELECT wuid, fieldname, unnest(string_split(feats, ',')) AS token, unnest(range(0, len(string_split(feats, ',')))) AS p FROM m)
SELECT e.wuid, e.fieldname, string_agg(CAST(v.idx AS VARCHAR), ',' ORDER BY p) AS tags FROM e JOIN v ON e.fieldname = v.field AND e.token = v.token GROUP BY ALL""")
def vocab_filter(spark, sf_dir):
    known = P.known_tags(melt_tags(spark, sf_dir), _vocab(spark, sf_dir))
    return known.withColumn("tags", F.array_join(F.col("tags").cast("array<string>"), ","))


@query(f"WITH {COUNTS} SELECT field, token, cnt, round(cnt / sum(cnt) OVER (PARTITION BY field), 9) AS rate FROM c")
def neg_weights(spark, sf_dir):
    return J.with_field_rate(token_frequency(spark, sf_dir)).withColumn("rate", F.round("rate", 9))


@query(f"WITH {COUNTS} SELECT field, token, cnt, round(pow(cnt, 0.75) / sum(pow(cnt, 0.75)) OVER (PARTITION BY field), 9) AS weight FROM c")
def unigram_weights(spark, sf_dir):
    return P.unigram_weights(token_frequency(spark, sf_dir)).withColumn("weight", F.round("weight", 9))


DAYS = "SELECT *, 'p_' || strftime(o_orderdate, '%Y%m%d') AS part FROM orders"


def _days(spark, sf_dir):
    return table(spark, sf_dir, "orders").withColumn("part", F.concat(F.lit("p_"), F.date_format("o_orderdate", "yyyyMMdd")))


@query(f"SELECT part, count(*) AS rows FROM ({DAYS}) GROUP BY part ORDER BY part DESC LIMIT 5")
def partition_latest_n(spark, sf_dir):
    return partitions.latest(_days(spark, sf_dir), "part", 5)


@query(f"SELECT o_orderkey, part FROM ({DAYS}) WHERE NOT (part BETWEEN 'p_19950101' AND 'p_19961231') AND NOT (part BETWEEN 'p_19980101' AND 'p_19980301')")
def partition_exclude_ranges(spark, sf_dir):
    return _days(spark, sf_dir).where(partitions.outside("part", [("p_19950101", "p_19961231"), ("p_19980101", "p_19980301")])).select("o_orderkey", "part")


@query("SELECT strftime(d, '%Y%m%d') AS day, count(o_orderkey) AS n FROM (SELECT unnest(range(DATE '1996-02-25', DATE '1996-03-06', INTERVAL 1 DAY)) AS d) LEFT JOIN orders ON CAST(o_orderdate AS DATE) = d GROUP BY 1")
def date_range_scan(spark, sf_dir):
    from .functions.times import days_between

    days = spark.createDataFrame([(d,) for d in days_between("19960225", "19960305")], "day string")
    n = _days(spark, sf_dir).select(F.substring("part", 3, 8).alias("day"), "o_orderkey")
    return days.join(n, "day", "left").groupBy("day").agg(F.count("o_orderkey").alias("n"))


@query("SELECT l_returnflag, l_linestatus, CAST(l_linenumber AS BIGINT) AS l_linenumber FROM lineitem WHERE l_quantity < 10 UNION SELECT l_returnflag, l_linestatus, CAST(l_linenumber AS BIGINT) FROM lineitem WHERE l_tax > 0.05")
def union_distinct_csv(spark, sf_dir):
    t = table(spark, sf_dir, "lineitem")
    line = F.concat_ws(",", "l_returnflag", "l_linestatus", F.col("l_linenumber").cast("string")).alias("value")
    both = t.where("l_quantity < 10").select(line).union(t.where("l_tax > 0.05").select(line))
    good = project.min_fields(both, "value", 3).distinct()
    return project.parse_typed(good, "value", ",", ["l_returnflag", "l_linestatus", "l_linenumber"], ["str", "str", "long"])


@query("SELECT event_id, event_type, coalesce(CAST(props ->> 'k' AS BIGINT), 0) AS k, CAST(CASE WHEN value >= 50 THEN 1 ELSE 0 END AS BIGINT) AS label FROM events")
def nulls_and_labels(spark, sf_dir):
    t = table(spark, sf_dir, "events").withColumn("k", F.get_json_object("props", "$.k").try_cast("long"))
    t = project.add_label(project.nulls_to_zero(t, ["k"]), "value", 50)
    return t.select("event_id", "event_type", "k", F.col("label").cast("long").alias("label"))


WORKFLOW = """<job name="brand"><pipeline name="wide"><properties><property key="bins" value="10"/></properties>
<node id="orders" processor="load_table"><properties><property key="table" value="{dir}/orders.parquet"/></properties></node>
<node id="customer" processor="load_table"><properties><property key="table" value="{dir}/customer.parquet"/></properties></node>
<node id="join" processor="join_tables"><properties><property key="c.id" value="c_custkey"/><property key="c.join" value="o_custkey"/><property key="c.features" value="c_mktsegment,c_nationkey"/></properties>
<dependency><node id="orders" input="df"/><node id="customer" input="c"/></dependency></node>
<node id="agg" processor="sql"><properties><property key="sql" value="SELECT c_mktsegment, count(*) AS n, max(o_totalprice) AS top FROM tmp_table GROUP BY c_mktsegment"/></properties><dependency><node id="join" input="df"/></dependency></node>
</pipeline></job>"""


@query("SELECT c_mktsegment, count(*) AS n, max(o_totalprice) AS top FROM orders LEFT JOIN customer ON o_custkey = c_custkey GROUP BY 1")
def workflow_wide(spark, sf_dir):
    job = workflow.build_job(WORKFLOW.replace("{dir}", sf_dir))
    assert nodes.Sql is workflow.REGISTRY["sql"]
    return workflow.run_job(spark, lambda: job, {})["wide"]["agg"]


# The SQL node, a query for each family. {t} names a table in Spark's form; the same text without braces is the other engine's.
STATEMENTS = {
    "sql_window_rank": "SELECT o_orderkey, o_custkey, CAST(rank() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC) AS BIGINT) AS r, CAST(dense_rank() OVER (PARTITION BY o_orderpriority ORDER BY o_custkey) AS BIGINT) AS d, CAST(ntile(4) OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey) AS BIGINT) AS q FROM {orders}",
    "sql_window_frame": "SELECT o_orderkey, count(*) OVER w AS n, max(o_totalprice) OVER w AS top, lag(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS before FROM {orders} WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderkey ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)",
    "sql_rollup": "SELECT l_returnflag, l_linestatus, count(*) AS n, min(l_quantity) AS lo FROM {lineitem} GROUP BY ROLLUP (l_returnflag, l_linestatus)",
    "sql_cube": "SELECT l_returnflag, l_linestatus, count(*) AS n, max(l_tax) AS hi FROM {lineitem} GROUP BY CUBE (l_returnflag, l_linestatus)",
    "sql_grouping_sets": "SELECT o_orderstatus, o_orderpriority, CAST(grouping(o_orderstatus) AS BIGINT) AS g, count(*) AS n FROM {orders} GROUP BY GROUPING SETS ((o_orderstatus), (o_orderpriority), ())",
    "sql_setops": "(SELECT c_custkey AS k FROM {customer} INTERSECT SELECT o_custkey FROM {orders}) EXCEPT SELECT c_custkey FROM {customer} WHERE c_nationkey = 3",
    "sql_except_all": "SELECT c_nationkey AS k FROM {customer} EXCEPT ALL SELECT s_nationkey FROM {supplier}",
    "sql_semi_anti": "SELECT c_custkey, 'with' AS kind FROM {customer} WHERE EXISTS (SELECT 1 FROM {orders} WHERE o_custkey = c_custkey) UNION ALL SELECT c_custkey, 'without' FROM {customer} WHERE NOT EXISTS (SELECT 1 FROM {orders} WHERE o_custkey = c_custkey)",
    "sql_full_outer": "SELECT c.n AS customers, s.n AS suppliers, coalesce(c.k, s.k) AS k FROM (SELECT c_nationkey AS k, count(*) AS n FROM {customer} WHERE c_nationkey > 5 GROUP BY c_nationkey) c FULL OUTER JOIN (SELECT s_nationkey AS k, count(*) AS n FROM {supplier} WHERE s_nationkey < 20 GROUP BY s_nationkey) s ON c.k = s.k",
    "sql_cross_join": "SELECT r_name, n_name FROM {region} CROSS JOIN {nation}",
    "sql_range_join": "SELECT p_partkey, CAST(b.hi AS BIGINT) AS hi FROM {part} JOIN (SELECT 0 AS lo, 10 AS hi UNION ALL SELECT 10, 30 UNION ALL SELECT 30, 60) b ON p_size > b.lo AND p_size <= b.hi",
    "sql_asof_like": "SELECT event_id, prev FROM (SELECT event_id, max(CASE WHEN event_type = 'click' THEN event_id END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev FROM {events}) x",
    "sql_topk": "SELECT o_orderkey, o_totalprice FROM {orders} ORDER BY o_totalprice DESC, o_orderkey LIMIT 20",
    "sql_string_fns": "SELECT p_partkey, upper(p_name) AS u, substring(p_type, 1, 4) AS s, CAST(length(p_brand) AS BIGINT) AS n, replace(p_brand, '#', '-') AS r, concat(p_brand, ':', p_type) AS c, trim(concat('  ', p_name, ' ')) AS t, reverse(p_name) AS v FROM {part}",
    "sql_date_fns": "SELECT o_orderkey, CAST(year(o_orderdate) AS BIGINT) AS y, CAST(month(o_orderdate) AS BIGINT) AS m, CAST(dayofmonth(o_orderdate) AS BIGINT) AS d, CAST(quarter(o_orderdate) AS BIGINT) AS q FROM {orders}",
    "sql_conditional": "SELECT o_orderkey, CASE WHEN o_totalprice > 200000 THEN 'high' WHEN o_totalprice > 100000 THEN 'mid' ELSE 'low' END AS band, nullif(o_orderstatus, 'O') AS s, coalesce(nullif(o_orderstatus, 'O'), 'open') AS t, greatest(o_custkey, 50) AS g FROM {orders}",
    "sql_math_fns": "SELECT p_partkey, round(power(p_size, 2), 3) AS p, CAST(floor(p_retailprice) AS BIGINT) AS f, CAST(ceil(p_retailprice) AS BIGINT) AS c, abs(p_size - 25) AS a, p_size % 7 AS m FROM {part}",
    "sql_subquery": "SELECT c_custkey, (SELECT count(*) FROM {orders} WHERE o_custkey = c_custkey) AS n FROM {customer} WHERE c_acctbal > (SELECT avg(c_acctbal) FROM {customer})",
    "sql_cte_having": "WITH t AS (SELECT o_custkey, count(*) AS n, max(o_totalprice) AS top FROM {orders} GROUP BY o_custkey HAVING count(*) > 3) SELECT c_nationkey, sum(n) AS n, max(top) AS top FROM t JOIN {customer} ON c_custkey = o_custkey GROUP BY c_nationkey",
    "sql_distinct_aggs": "SELECT l_returnflag, count(DISTINCT l_partkey) AS parts, count(DISTINCT l_suppkey) AS supps, count(*) FILTER (WHERE l_discount > 0.05) AS cheap FROM {lineitem} GROUP BY l_returnflag",
    "sql_values_in": "SELECT n_name FROM {nation} WHERE n_regionkey IN (SELECT r_regionkey FROM {region} WHERE r_name LIKE 'A%') AND n_nationkey NOT IN (1, 2)",
}


def _statement(text: str) -> Query:
    import re

    def run(spark, sf_dir):
        return project.run_sql(text, **{n: table(spark, sf_dir, n) for n in set(re.findall(r"{(\w+)}", text))})

    return run


for _name, _text in STATEMENTS.items():
    _sql = _text.replace("{", "").replace("}", "")
    if _name in ("sql_distinct_aggs", "sql_cte_having"):
        _sql = f"SELECT * REPLACE (CAST({'n' if 'cte' in _name else 'parts'} AS BIGINT) AS {'n' if 'cte' in _name else 'parts'}) FROM ({_sql})"
    _named(_name, _statement(_text), _sql)


@query("SELECT event_id, CAST(props ->> 'k' AS BIGINT) AS k FROM events")
def sql_json_props(spark, sf_dir):
    return project.run_sql("SELECT event_id, CAST(get_json_object(props, '$.k') AS BIGINT) AS k FROM {t}", t=table(spark, sf_dir, "events"))


@query("SELECT o_custkey, CAST(len(list(DISTINCT o_orderstatus)) AS BIGINT) AS n, list_contains(list(o_orderstatus), 'F') AS has_f, array_to_string(list_sort(list(DISTINCT o_orderstatus)), '') AS s FROM orders GROUP BY o_custkey")
def sql_array_fns(spark, sf_dir):
    return project.run_sql("SELECT o_custkey, CAST(size(collect_set(o_orderstatus)) AS BIGINT) AS n, array_contains(collect_list(o_orderstatus), 'F') AS has_f, array_join(sort_array(collect_set(o_orderstatus)), '') AS s FROM {t} GROUP BY o_custkey", t=table(spark, sf_dir, "orders"))


@query("SELECT l_returnflag, CAST(sum(CAST(l_extendedprice AS DECIMAL(18, 2))) AS DECIMAL(28, 2)) AS total FROM lineitem GROUP BY 1")
def sql_decimal_sum(spark, sf_dir):
    return project.run_sql("SELECT l_returnflag, CAST(sum(CAST(l_extendedprice AS DECIMAL(18, 2))) AS DECIMAL(28, 2)) AS total FROM {t} GROUP BY 1", t=table(spark, sf_dir, "lineitem"))


@query("SELECT time_bucket(INTERVAL 1 HOUR, ts, TIMESTAMP '1970-01-01') AS start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL")
def events_tumbling(spark, sf_dir):
    return S.tumbling(table(spark, sf_dir, "events"), "ts", "1 hour", ["event_type"], "value").withColumns({"total": F.round("total", 4), "start": F.col("start").cast("timestamp_ntz")})


@query("""SELECT time_bucket(INTERVAL 30 MINUTE, ts, TIMESTAMP '1970-01-01') - o * INTERVAL 30 MINUTE AS start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events, range(0, 2) r(o) GROUP BY ALL""")
def events_sliding(spark, sf_dir):
    return S.sliding(table(spark, sf_dir, "events"), "ts", "1 hour", "30 minutes", ["event_type"], "value").withColumns({"total": F.round("total", 4), "start": F.col("start").cast("timestamp_ntz")})


@query("""WITH g AS (SELECT user_id, ts, value, CASE WHEN ts >= lag(ts) OVER (PARTITION BY user_id ORDER BY ts) + INTERVAL 30 MINUTE THEN 1 ELSE 0 END AS cut FROM events),
s AS (SELECT *, sum(cut) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS s FROM g)
SELECT min(ts) AS start, max(ts) + INTERVAL 30 MINUTE AS "end", user_id, count(*) AS n, round(sum(value), 4) AS total FROM s GROUP BY user_id, s""")
def events_sessions(spark, sf_dir):
    out = S.sessions(table(spark, sf_dir, "events"), "ts", "30 minutes", ["user_id"], "value")
    return out.withColumns({"total": F.round("total", 4), "start": F.col("start").cast("timestamp_ntz"), "end": F.col("end").cast("timestamp_ntz")})


# The rest registers itself; it needs what is defined above.
from . import io_queries  # noqa: E402, F401
