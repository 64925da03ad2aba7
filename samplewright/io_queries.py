"""Registered queries of sources, sinks, times, workflows and the wide-table
job. Sinks write to the shared scratch folder and what they wrote is read back,
so the rows that come out went through the files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .functions import times
from .functions.columns import col
from .operators import aggregate as A
from .operators import discretize as D
from .operators import encode as E
from .operators import join as J
from .operators import pretrain as P
from .operators import project, sample
from .plans import nodes, spec, wide, workflow
from .queries import COUNTS, DAYS, MELTED, NUMERIC, SHARE, SVM, UNNEST, VOCAB, _bounds, _cut_sql, _days, _tags, _vocab, bin_sql, bounds_sql, melt_sql, query, table
from .scratch import Scratch, write_small
from .sources import partitions, records, sinks, text


def _folder(spark, name: str) -> str:
    return Scratch(spark, name).root


# sources

FEW_DAYS = ["19960226", "19960227", "19960301"]


@query("SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderstatus, strftime(o_orderdate, '%Y%m%d') AS day FROM orders WHERE strftime(o_orderdate, '%Y%m%d') IN ('19960226', '19960227', '19960301')")
def text_date_range_load(spark, sf_dir):
    """Days without a folder are passed over."""
    root = _folder(spark, "days")
    df = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", F.date_format("o_orderdate", "yyyyMMdd").alias("day"))
    for day in FEW_DAYS:
        sinks.save(df.where(F.col("day") == day), f"{root}/{day}")
    return text.load_text(spark, text.date_paths(root, "19960225-19960302"), ["o_orderkey", "o_orderstatus", "day"])


def _events(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", "event_type", F.col("value").cast("float").alias("value"), F.array("user_id", "event_id").alias("ids"), F.when(F.col("user_id") % 3 > 0, F.col("user_id")).alias("maybe"))


EXAMPLES = "SELECT event_id, event_type, CAST(CAST(value AS FLOAT) AS DOUBLE) AS value, CAST(user_id AS VARCHAR) || ',' || CAST(event_id AS VARCHAR) AS ids, CASE WHEN user_id % 3 > 0 THEN user_id END AS maybe FROM events"


def _shown(df: DataFrame) -> DataFrame:
    return df.withColumns({"value": F.col("value").cast("double"), "ids": F.array_join(F.col("ids").cast("array<string>"), ",")})


@query(EXAMPLES)
def tfrecord_roundtrip(spark, sf_dir):
    df, path = _events(spark, sf_dir), _folder(spark, "examples")
    sinks.save(df, path, "tfrecord")
    return _shown(text.load(spark, "tfrecord", [path], schema=df.schema))


@query(EXAMPLES)
def tfrecord_ignore_mode(spark, sf_dir):
    """A second write with mode ignore leaves what is there."""
    df, path = _events(spark, sf_dir), _folder(spark, "examples")
    records.write_records(df, path, "tfrecord", "ignore", "gzip")
    records.write_records(df.limit(5), path, "tfrecord", "ignore")
    return _shown(records.read_tfrecord(spark, [path], df.schema))


@query("SELECT kind, 'order ' || CAST(o_orderkey AS VARCHAR) AS record FROM orders, (VALUES ('none'), ('gzip')) k(kind)")
def lpb_roundtrip(spark, sf_dir):
    root = _folder(spark, "records")
    df = table(spark, sf_dir, "orders").select(F.encode(F.concat(F.lit("order "), F.col("o_orderkey").cast("string")), "UTF-8").alias("record"))
    out = []
    for kind in ("none", "gzip"):
        records.write_records(df, f"{root}/{kind}", "lpb", "overwrite", kind)
        out.append(text.load(spark, "records", [f"{root}/{kind}"]).select(F.lit(kind).alias("kind"), F.decode("record", "UTF-8").alias("record")))
    return out[0].unionAll(out[1])


@query("SELECT * FROM (VALUES ('bad', 'one'), ('cut', 'two'), ('end', 'three'), ('good', 'four'), ('good', 'five')) t(file, record)")
def lpb_skip_policy(spark, sf_dir):
    """Length 0 ends a file; a negative length or a cut payload ends it too, where bad records are skipped."""
    root, framed = _folder(spark, "skip"), records.framed
    held = {"bad": framed(b"one") + b"\xfb\xff\xff\xff" + framed(b"lost"), "cut": framed(b"two") + framed(b"lost")[:-1], "end": framed(b"three") + framed(b"") + framed(b"lost"), "good": framed(b"four") + framed(b"five"), "empty": b""}
    for name, data in held.items():
        write_small(spark, f"{root}/{name}", data)
    records.register(spark)
    df = spark.read.format("lpb").option("skip_bad", "true").load(root)
    return df.select(F.element_at(F.split("path", "/"), -1).alias("file"), F.decode("record", "UTF-8").alias("record"))


@query("SELECT count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS total, CAST(1 AS BIGINT) AS tasks FROM orders")
def packed_small_files(spark, sf_dir):
    """Forty files, one task."""
    root = _folder(spark, "small")
    df = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderkey").cast("string").cast("binary").alias("record"))
    records.write_records(df.repartition(40, "o_orderkey").select("record"), root, "lpb")
    records.register(spark)
    got = spark.read.format("lpb").option("task_bytes", str(1 << 30)).load(root).select(F.decode("record", "UTF-8").cast("long").alias("k"), F.spark_partition_id().alias("p"))
    return got.agg(F.count("*").alias("n"), F.sum("k").alias("total"), F.count_distinct("p").alias("tasks"))


@query("SELECT n_name AS file, n_name || ' of ' || CAST(n_regionkey AS VARCHAR) AS content FROM nation")
def whole_files(spark, sf_dir):
    """One record for each file that isn't empty."""
    root = _folder(spark, "whole")
    write_small(spark, f"{root}/EMPTY", b"")
    for r in table(spark, sf_dir, "nation").collect():  # 25 files
        write_small(spark, f"{root}/{r.n_name}", f"{r.n_name} of {r.n_regionkey}")
    df = text.load(spark, "whole", [root])
    return df.select(F.url_decode(F.element_at(F.split("path", "/"), -1)).alias("file"), F.decode("content", "UTF-8").alias("content"))


@query("SELECT CAST(r_regionkey AS VARCHAR) AS key, r_name AS value FROM region")
def sequence_files(spark, sf_dir):
    path = _folder(spark, "sequence")
    table(spark, sf_dir, "region").rdd.map(lambda r: (str(r.r_regionkey), r.r_name)).saveAsSequenceFile(path)
    return text.load(spark, "sequence", [path])


@query("SELECT 'bins=10' AS config, 'job' AS name")
def config_loader(spark, sf_dir):
    path = f"{_folder(spark, 'config')}/job.xml"
    write_small(spark, path, '<job name="job"><config><c key="bins" value="10"/></config></job>')
    job = workflow.build_job(text.read_config(spark, path))
    return spark.createDataFrame([(f"bins={job.config['bins']}", job.name)], "config string, name string")


MONTHS = "SELECT o_orderkey, 'p_' || strftime(o_orderdate, '%Y%m') AS part FROM orders"


@query(f"SELECT o_orderkey, part, kind FROM ({MONTHS}), (VALUES ('named'), ('last'), ('today')) k(kind) WHERE CASE kind WHEN 'named' THEN part IN ('p_199602', 'p_199603') WHEN 'last' THEN part = (SELECT max(part) FROM ({MONTHS})) ELSE part = 'p_199701' END")
def partition_pruned_table(spark, sf_dir):
    """Explicit partitions, the newest, and the run's own; the filter prunes the scan."""
    path = _folder(spark, "warehouse")
    months = table(spark, sf_dir, "orders").select("o_orderkey", F.concat(F.lit("p_"), F.date_format("o_orderdate", "yyyyMM")).alias("part"))
    sinks.save_partition(months.repartition("part"), path, "part")
    df, out = spark.read.parquet(path), None
    for kind, which in (("named", "199602,p_199603"), ("last", "last"), ("today", "-1")):
        own = partitions.load(df, "part", which, "199701").select("o_orderkey", "part", F.lit(kind).alias("kind"))
        out = own if out is None else out.unionAll(own)
    return out


@query(f"""WITH d AS (SELECT DISTINCT strftime(o_orderdate, '%Y%m%d') AS part FROM orders ORDER BY 1 DESC LIMIT 230)
SELECT part FROM d WHERE part > strftime(DATE '2001-07-01' - INTERVAL 42 DAY, '%Y%m%d') AND part <= strftime(DATE '2001-07-01' - INTERVAL 21 DAY, '%Y%m%d') ORDER BY part DESC LIMIT 7""")
def partition_pre_sample(spark, sf_dir):
    days = table(spark, sf_dir, "orders").select(F.date_format("o_orderdate", "yyyyMMdd").alias("part"))
    return partitions.window_days(days, "part", "20010701", 7, 1)


@query(f"SELECT max(part) AS part, CAST(1 AS BIGINT) AS there, CAST(0 AS BIGINT) AS absent FROM ({DAYS}) WHERE part <= 'p_19960315'")
def partition_latest_until(spark, sf_dir):
    df = _days(spark, sf_dir).select("part")
    found = partitions.latest_until(df, "part", "p_19960315")
    return spark.createDataFrame([(found, int(partitions.exists(df, "part", found)), int(partitions.exists(df, "part", "p_30000101")))], "part string, there long, absent long")


@query(f"SELECT part, count(*) AS rows FROM ({DAYS}) GROUP BY part")
def partition_counts(spark, sf_dir):
    return partitions.counts(_days(spark, sf_dir), "part")


@query("SELECT CAST(1 AS BIGINT) AS some, CAST(3 AS BIGINT) AS thrice")
def partition_number(spark, sf_dir):
    """Executors by cores by a factor, so in proportion to the factor."""
    one = partitions.parallelism(spark, 1)
    return spark.createDataFrame([(int(one > 0), partitions.parallelism(spark, 3) // one)], "some long, thrice long")


@query(f"SELECT o_orderkey, part FROM ({DAYS}) WHERE substr(part, 3, 6) IN (SELECT DISTINCT substr(part, 3, 6) FROM ({DAYS}) ORDER BY 1 DESC LIMIT 2)")
def partition_newest_periods(spark, sf_dir):
    """The two newest months."""
    return partitions.newest(_days(spark, sf_dir), "part", 2, "month").select("o_orderkey", "part")


@query("SELECT CAST(c_custkey AS BIGINT) AS key, c_name || '|' || c_mktsegment AS vals FROM customer")
def keyed_projection(spark, sf_dir):
    df = partitions.keyed(table(spark, sf_dir, "customer"), "c_custkey", ["c_name", "c_mktsegment"])
    return df.select("key", F.array_join("values", "|").alias("vals"))


@query("SELECT CAST(1 AS BIGINT) AS ready, CAST(0 AS BIGINT) AS more, CAST(1 AS BIGINT) AS marked, CAST(0 AS BIGINT) AS cleared, CAST(0 AS BIGINT) AS removed")
def ready_and_done_markers(spark, sf_dir):
    root = _folder(spark, "ready")
    for day in FEW_DAYS:
        sinks.mark_done(spark, f"{root}/{day}")
    flags = [text.wait_ready(spark, f"{root}/*/_SUCCESS", 3, 5), text.wait_ready(spark, f"{root}/*/_SUCCESS", 4, 0.1, 0.05), text.exists(spark, f"{root}/19960226/_SUCCESS")]
    sinks.mark_done(spark, f"{root}/19960226", False)
    flags.append(text.exists(spark, f"{root}/19960226/_SUCCESS"))
    sinks.remove(spark, root)
    flags.append(text.exists(spark, root))
    return spark.createDataFrame([tuple(int(f) for f in flags)], "ready long, more long, marked long, cleared long, removed long")


# sinks


@query("SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_mktsegment FROM customer, (VALUES (1), (2)) t(i)")
def csv_append(spark, sf_dir):
    df, path = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment"), _folder(spark, "csv")
    for _ in range(2):
        sinks.save(df, path, "text", "append")
    return text.load_text(spark, [path], ["c_custkey", "c_mktsegment"])


@query("SELECT p_name || '|' || p_brand AS value FROM part")
def lines_saver(spark, sf_dir):
    """Text lines, written over what was there."""
    path = _folder(spark, "lines")
    df = table(spark, sf_dir, "part").select(F.concat_ws("|", "p_name", "p_brand").alias("line"))
    for rows in (df.limit(3), df):
        sinks.save(rows, path, "lines")
    return text.load(spark, "text", [path])


@query(f"""SELECT kind, split, o_orderkey, o_orderpriority FROM (SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderpriority, CASE WHEN {SHARE} < 0.7 THEN 'train' WHEN {SHARE} < 0.85 THEN 'val' ELSE 'test' END AS split FROM orders), (VALUES ('text'), ('tfrecord')) k(kind)""")
def split_write(spark, sf_dir):
    """Three splits in two kinds of files, read back from each."""
    root = f"{_folder(spark, 'splits')}/"
    df = sample.hash_split(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority"), ["o_orderkey"], ["train", "val", "test"], [0.7, 0.15, 0.15], 36)
    out = None
    for path in sinks.save_splits(df, root, "2024010100", ["text", "tfrecord"]):
        name, kind = path.removeprefix(f"{root}2024010100").split("_")
        fields = ["o_orderkey", "o_orderpriority"]
        own = text.load_text(spark, [path], fields) if kind == "text" else text.load(spark, "tfrecord", [path], schema="o_orderkey long, o_orderpriority string").withColumn("o_orderkey", F.col("o_orderkey").cast("string"))
        own = own.select(F.lit(kind).alias("kind"), F.lit(name).alias("split"), *fields)
        out = own if out is None else out.unionAll(own)
    return out


@query("SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN -o_totalprice ELSE o_totalprice END AS price, o_orderstatus FROM orders")
def partition_overwrite(spark, sf_dir):
    """A second write replaces the partitions that it has, and no others."""
    path = _folder(spark, "overwrite")
    df = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_totalprice").alias("price"), "o_orderstatus")
    sinks.save_partition(df, path, "o_orderstatus")
    sinks.save_partition(df.where("o_orderstatus = 'F'").withColumn("price", -F.col("price")), path, "o_orderstatus", 100)
    return spark.read.parquet(path).select("o_orderkey", "price", F.col("o_orderstatus").cast("string").alias("o_orderstatus"))


@query("SELECT count(*) AS n, CAST(1 AS BIGINT) AS few FROM lineitem")
def file_count_rule(spark, sf_dir):
    """Under ten million rows at most fifty files."""
    path = _folder(spark, "files")
    df = table(spark, sf_dir, "lineitem").select("l_orderkey", F.lit("p_1").alias("part")).repartition(80, "l_orderkey")
    sinks.save_partition(df, path, "part", 1_000_000)
    got = spark.read.parquet(path).select("l_orderkey", F.input_file_name().alias("f"))
    return got.agg(F.count("*").alias("n"), (F.count_distinct("f") <= sinks.FEW_FILES).cast("long").alias("few"))


@query("SELECT string_agg(n_name || ';', '' ORDER BY n_nationkey) AS content, CAST(1 AS BIGINT) AS entries FROM nation")
def zip_roundtrip(spark, sf_dir):
    path = _folder(spark, "zip")
    df = table(spark, sf_dir, "nation").coalesce(1).sortWithinPartitions("n_nationkey").select(F.concat("n_name", F.lit(";")).alias("r"))
    sinks.save_zip(df, path)
    got = sinks.load_zip(spark, path)
    return got.agg(F.max(F.decode("content", "UTF-8")).alias("content"), F.count("*").alias("entries"))


@query(f"SELECT 'c' || CAST(col AS VARCHAR) || '_' || value || ':' || CAST(row_number() OVER (ORDER BY col, value) AS VARCHAR) AS value FROM ({SVM})")
def libsvm_map_file(spark, sf_dir):
    path = _folder(spark, "map")
    sinks.save(E.libsvm_map(E.libsvm_index(table(spark, sf_dir, "lineitem"), ["l_linestatus", "l_linenumber"])), path, "lines")
    return text.load(spark, "text", [path])


# projections, joins, bins

@query("SELECT p_brand AS brand, p_type AS kind, CAST(p_size AS BIGINT) AS size FROM part")
def project_rename_drop_first(spark, sf_dir):
    df = project.select_features(table(spark, sf_dir, "part"), ["p_name", "p_brand", "p_type", "p_size"], ["p_name", "p_brand", "p_type", "p_size"], ["p_partkey"])
    return project.rename(project.drop_first(df, 2), {"p_brand": "brand", "p_type": "kind", "p_size": "size"}).withColumn("size", F.col("size").cast("long"))


@query("SELECT CAST(o_custkey AS VARCHAR) AS id, l_linenumber FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_custkey <> 0 AND o_orderkey <> 0")
def id_mapping_registry(spark, sf_dir):
    maps = J.mapping_registry(spark, [{"id": "order_customer", "input": f"{sf_dir}/orders.parquet"}, {"id": "none", "input": " "}, {"id": "", "input": "x"}])
    assert list(maps) == ["order_customer"]
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("id"), "l_linenumber")
    return J.map_ids(rows, "id", maps["order_customer"], "o_orderkey", "o_custkey").select("id", "l_linenumber")


@query(f"WITH c AS ({_cut_sql('to_id', 500)}) SELECT c.to_id AS id, p_size FROM part JOIN c ON CAST(p_partkey AS VARCHAR) = c.from_id")
def id_mapping_features_to(spark, sf_dir):
    part = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), "p_size")
    return J.map_features(part, "id", table(spark, sf_dir, "lineitem"), "l_partkey", "l_suppkey", 500, "to_id").select("id", "p_size")


@query(f"WITH {bounds_sql(melt_sql('lineitem', NUMERIC), 7)}, m AS (SELECT feature, min(CAST(x AS FLOAT)) lo, max(CAST(x AS FLOAT)) hi FROM ({melt_sql('lineitem', ['l_tax'])}) WHERE CAST(x AS FLOAT) <> 0 GROUP BY feature), w AS (SELECT feature, lo, CAST(CAST(hi - lo AS FLOAT) / 4 AS FLOAT) w FROM m) SELECT 'equi_freq' AS method, * FROM ({UNNEST}) UNION ALL SELECT 'equi_val', feature, CAST(i - 1 AS BIGINT), CAST(CAST(lo + CAST(CAST(i AS FLOAT) * w AS FLOAT) AS FLOAT) AS DOUBLE) FROM w, range(1, 4) r(i)")
def discretize_dispatch(spark, sf_dir):
    """A method by name; an unknown name is an error."""
    df = table(spark, sf_dir, "lineitem")
    try:
        D.learn(df, ["l_tax"], 4, "other")
        raise AssertionError("an unknown method was accepted")
    except ValueError:
        pass
    freq, val = _bounds(D.learn(df, NUMERIC, 7, "equi_freq")), _bounds(D.learn(df, ["l_tax"], 4, "equi_val"))
    return freq.withColumn("method", F.lit("equi_freq")).unionByName(val.withColumn("method", F.lit("equi_val")))


DIGITS = "SELECT 'k' AS feature, CAST(k AS FLOAT) AS x FROM (SELECT CASE WHEN event_id % 7 = 0 THEN 'x' || (props ->> 'k') WHEN event_id % 5 = 0 THEN (props ->> 'k') || '.5' ELSE props ->> 'k' END AS k FROM events) WHERE regexp_full_match(k, '[0-9]+')"


@query(f"WITH {bounds_sql(DIGITS, 10)} {UNNEST}")
def digits_only_bounds(spark, sf_dir):
    k = F.get_json_object("props", "$.k")
    mixed = F.when(F.col("event_id") % 7 == 0, F.concat(F.lit("x"), k)).when(F.col("event_id") % 5 == 0, F.concat(k, F.lit(".5"))).otherwise(k)
    return _bounds(D.learn(table(spark, sf_dir, "events").select(mixed.alias("k")), ["k"], digits_only=True))


@query(f"WITH {bounds_sql(melt_sql('lineitem', ['l_quantity', 'l_tax']), 10)} SELECT l_orderkey, l_linenumber, CAST({bin_sql('l_quantity', 'l_quantity')} AS BIGINT) AS l_quantity, CAST({bin_sql('l_tax', 'l_tax')} AS BIGINT) AS l_tax FROM lineitem")
def bounds_from_file(spark, sf_dir):
    """Bounds saved as text lines, read back and applied, bins from 0."""
    path, columns = _folder(spark, "bounds"), ["l_quantity", "l_tax"]
    df = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", *[F.col(c).cast("string").alias(c) for c in columns])
    D.save_bounds(D.learn(table(spark, sf_dir, "lineitem"), columns), path)
    return D.apply(df, D.load_bounds(spark, path), columns, "zero_based")


RAW = "SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN 'n/a' ELSE CAST(CAST(o_totalprice AS BIGINT) - 100000 AS VARCHAR) END AS price FROM orders"


@query(f"""WITH r AS ({RAW}), {bounds_sql("SELECT 'price' AS feature, try_cast(price AS FLOAT) AS x FROM r WHERE try_cast(price AS FLOAT) > 0", 10, positive=True)}
SELECT o_orderkey, coalesce(CASE WHEN try_cast(price AS DOUBLE) IS NOT NULL THEN CAST({bin_sql('try_cast(price AS DOUBLE)', 'price')} AS VARCHAR) END, price) AS price FROM r""")
def discretize_or_raw(spark, sf_dir):
    """Bounds of the positive values; what is no number stays as it is. Half prices go to the even neighbour, as in SQL's cast."""
    price = F.when(F.col("o_orderkey") % 5 == 0, "n/a").otherwise((F.rint("o_totalprice").cast("long") - 100000).cast("string"))
    df = table(spark, sf_dir, "orders").select("o_orderkey", price.alias("price"))
    return D.apply(df, D.learn(df, ["price"], positive_only=True), ["price"], "or_raw")


# samples

LINE_SHARE = "CAST(('0x' || substr(md5(CAST(l_orderkey AS VARCHAR) || '#' || CAST(l_linenumber AS VARCHAR) || '#' || l_returnflag || '#36'), 1, 8)) AS BIGINT) / 4294967296.0::DOUBLE"


@query(f"SELECT l_orderkey, l_linenumber, l_returnflag FROM lineitem WHERE {LINE_SHARE} < CASE l_returnflag WHEN 'R' THEN 0.5 WHEN 'A' THEN 0.1 ELSE 0 END")
def sample_by_group(spark, sf_dir):
    df = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")
    return sample.by_group(df, "l_returnflag", {"R": 0.5, "A": 0.1})


EVENT_KEY = "CAST(event_id AS VARCHAR) || '#' || CAST(conv_num AS VARCHAR) || '#' || CAST(label AS VARCHAR)"
SAMPLED = f"""t AS (SELECT event_id, event_id % 150 AS conv_num, CAST(CASE WHEN event_id % 150 >= 110 THEN 1 ELSE 0 END AS BIGINT) AS label FROM events),
f AS (SELECT label, least(1.0::DOUBLE, greatest(1, (SELECT count(*) FROM t WHERE label = 1)) / count(*)) AS rate FROM t GROUP BY label),
k AS (SELECT t.* FROM t JOIN f USING (label) WHERE CAST(('0x' || substr(md5({EVENT_KEY} || '#36'), 1, 8)) AS BIGINT) / 4294967296.0::DOUBLE < rate),
s AS (SELECT *, CAST(('0x' || substr(md5({EVENT_KEY} || '#36'), 1, 8)) AS BIGINT) / 4294967296.0::DOUBLE AS share FROM k)"""


@query(f"WITH {SAMPLED} SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(conv_num AS VARCHAR) AS conv_num, CAST(label AS VARCHAR) AS label, CASE WHEN share < 0.7 THEN 'train' WHEN share < 0.7 + 0.15 THEN 'val' ELSE 'test' END AS split FROM s")
def sampling_node(spark, sf_dir):
    """Label, cut to the positives' number, split, saved by split and read back."""
    folder = _folder(spark, "sampled")
    path, root = f"{folder}/in", f"{folder}/out"
    sinks.save(table(spark, sf_dir, "events").select("event_id", (F.col("event_id") % 150).alias("conv_num")), path, "parquet")
    job = workflow.build_job(f"""<job name="j"><pipeline name="p"><node id="a" processor="load_table"><properties><property key="table" value="{path}"/></properties></node>
<node id="b" processor="sampling"><properties><property key="label_source" value="conv_num"/><property key="output" value="{root}"/></properties><dependency><node id="a" input="df"/></dependency></node></pipeline></job>""")
    workflow.run_job(spark, lambda: job, {"dataTime": "20240101"})
    out = None
    for name in ("train", "val", "test"):
        own = text.load_text(spark, [f"{root}/20240101{name}_text"], ["event_id", "conv_num", "label"]).withColumn("split", F.lit(name))
        out = own if out is None else out.unionAll(own)
    return out


@query(f"WITH {VOCAB} SELECT field, token, cnt, idx, CAST(1 AS BIGINT) AS saved FROM v")
def pretrain_vocabulary(spark, sf_dir):
    """The vocabulary that the pre-training job makes, saved and read back."""
    path = _folder(spark, "vocabulary")
    _, vocab = P.pretrain_samples(_tags(spark, sf_dir), "wuid", ["kinds", "items"], None, 20, 1_000_000)
    sinks.save(vocab, path, "parquet")
    return text.load(spark, "parquet", [path]).withColumn("saved", F.lit(1).cast("long"))


KNOWN = f"""WITH {VOCAB}, e AS (SELECT wuid, fieldname, unnest(string_split(feats, ',')) AS token, unnest(range(0, len(string_split(feats, ',')))) AS p FROM m),
u AS (SELECT e.wuid, e.fieldname, v.idx, min(p) AS p FROM e JOIN v ON e.fieldname = v.field AND e.token = v.token GROUP BY ALL),
n AS (SELECT wuid, fieldname, count(*) AS n, string_agg(CAST(idx AS VARCHAR), ',' ORDER BY p) AS tags FROM u GROUP BY ALL),
"""


def share_sql(key: str) -> str:
    return f"CAST(('0x' || substr(md5({key}), 1, 8)) AS BIGINT) / 4294967296.0::DOUBLE"


POSITIVES = KNOWN + f"""b AS (SELECT n.*, CAST(k AS VARCHAR) AS k FROM n, range(36, 38) r(k) WHERE n > 2),
z AS (SELECT b.*, u.idx, row_number() OVER (PARTITION BY b.wuid, b.fieldname, k ORDER BY md5(b.wuid || '#' || b.fieldname || '#' || k || '#' || CAST(idx AS VARCHAR))) AS r,
  1 + CAST(floor({share_sql("b.wuid || '#' || b.fieldname || '#' || k || '#36'")} * least(n - 1, 50)) AS BIGINT) AS take FROM b JOIN u USING (wuid, fieldname)),
pos AS (SELECT wuid, fieldname, tags, k, string_agg(CAST(idx AS VARCHAR), ',' ORDER BY r) FILTER (r <= take) AS sample_tags, string_agg(CAST(idx AS VARCHAR), ',' ORDER BY r) FILTER (r > take AND r <= take + 4) AS select_tag FROM z GROUP BY ALL)
"""


def _as_text(df: DataFrame) -> DataFrame:
    arrays = {c: F.array_join(F.col(c).cast("array<string>"), ",") for c in ("tags", "sample_tags", "select_tag")}
    return df.withColumns(arrays).withColumn("label", F.col("label").cast("long"))


@query(f"{POSITIVES} SELECT wuid, fieldname, tags, sample_tags, select_tag, CAST(1 AS BIGINT) AS label FROM pos")
def pos_samples(spark, sf_dir):
    return _as_text(P.positives(P.known_tags(P.melt_tags(_tags(spark, sf_dir), "wuid", ["kinds", "items"]), _vocab(spark, sf_dir))))


def wide_share_sql(key: str) -> str:
    return f"CAST(('0x' || substr(md5({key} || '#37'), 1, 13)) AS BIGINT) / 4503599627370496.0::DOUBLE"


NEGATIVES = POSITIVES + f""", g AS (SELECT field, idx, cnt, CAST(sum(cnt) OVER (PARTITION BY field ORDER BY idx) - cnt AS BIGINT) AS lo, CAST(sum(cnt) OVER (PARTITION BY field ORDER BY idx) AS BIGINT) AS hi, CAST(sum(cnt) OVER (PARTITION BY field) AS BIGINT) AS total FROM v),
q AS (SELECT DISTINCT md5(wuid || '#' || fieldname || '#' || sample_tags) AS row, wuid, fieldname, tags, sample_tags FROM pos),
t2 AS (SELECT field, max(total) AS total FROM g GROUP BY field),
dr AS (SELECT row, field, j, CAST(floor({wide_share_sql("row || '#' || CAST(j AS VARCHAR)")} * total) AS BIGINT) AS r FROM q JOIN t2 ON fieldname = field, range(0, 24) x(j)),
dd AS (SELECT row, idx, min(j) AS j FROM dr JOIN g USING (field) WHERE r >= lo AND r < hi GROUP BY ALL),
cand AS (SELECT q.row, g.idx, CASE WHEN dd.j IS NULL THEN 1 ELSE 0 END AS later, coalesce(CAST(dd.j AS DOUBLE), -ln({wide_share_sql("q.row || '#' || CAST(g.idx AS VARCHAR)")} + pow(2.0::DOUBLE, -53)) / g.cnt) AS key
  FROM q JOIN g ON q.fieldname = g.field LEFT JOIN dd ON dd.row = q.row AND dd.idx = g.idx WHERE NOT list_contains(string_split(q.tags, ','), CAST(g.idx AS VARCHAR))),
o AS (SELECT *, row_number() OVER (PARTITION BY row ORDER BY later, key, idx) - 1 AS p FROM cand),
w AS (SELECT row, p // 4 AS grp, string_agg(CAST(idx AS VARCHAR), ',' ORDER BY p) AS select_tag FROM o WHERE p < 8 GROUP BY ALL)
"""


@query(f"{NEGATIVES} SELECT wuid, fieldname, tags, sample_tags, select_tag, CAST(0 AS BIGINT) AS label FROM q JOIN w USING (row)")
def neg_samples(spark, sf_dir):
    vocab = _vocab(spark, sf_dir)
    return _as_text(P.negatives(P.positives(P.known_tags(P.melt_tags(_tags(spark, sf_dir), "wuid", ["kinds", "items"]), vocab)), vocab))


@query(f"{NEGATIVES} SELECT wuid, fieldname, tags, sample_tags, select_tag, CAST(1 AS BIGINT) AS label FROM pos UNION ALL SELECT wuid, fieldname, tags, sample_tags, select_tag, CAST(0 AS BIGINT) FROM q JOIN w USING (row)")
def pretrain_node(spark, sf_dir):
    """The whole job as a workflow: melt, vocabulary, positives, negatives."""
    path = _folder(spark, "tags")
    sinks.save(_tags(spark, sf_dir), path, "parquet")
    job = workflow.build_job(f"""<job name="j"><pipeline name="p"><node id="a" processor="load_table"><properties><property key="table" value="{path}"/></properties></node>
<node id="b" processor="pretrain"><properties><property key="fields" value="kinds,items"/><property key="least" value="20"/><property key="most" value="1000000"/></properties><dependency><node id="a" input="df"/></dependency></node></pipeline></job>""")
    return _as_text(workflow.run_job(spark, lambda: job, {})["p"]["b"])


PAIRS = KNOWN + f"""b AS (SELECT *, least(CAST(floor({share_sql("wuid || '#' || fieldname || '#38'")} * n) AS BIGINT) + 5, 10) AS k FROM n WHERE n > 1),
j AS (SELECT b.*, j FROM b, range(0, 10) r(j) WHERE j < k),
z AS (SELECT j.wuid, j.fieldname, j.tags, j, u.idx, row_number() OVER (PARTITION BY j.wuid, j.fieldname, j ORDER BY md5(j.wuid || '#' || j.fieldname || '#' || CAST(j AS VARCHAR) || '#38#' || CAST(idx AS VARCHAR))) AS r FROM j JOIN u USING (wuid, fieldname)),
pp AS (SELECT wuid, fieldname, tags, j, max(idx) FILTER (r = 1) AS tag, max(idx) FILTER (r = 2) AS context FROM z GROUP BY ALL),
g AS (SELECT field, idx, CAST(sum(cnt) OVER (PARTITION BY field ORDER BY idx) - cnt AS BIGINT) AS lo, CAST(sum(cnt) OVER (PARTITION BY field ORDER BY idx) AS BIGINT) AS hi, CAST(sum(cnt) OVER (PARTITION BY field) AS BIGINT) AS total FROM v),
a AS (SELECT pp.*, g, t, CAST(floor({share_sql("wuid || '#' || fieldname || '#' || CAST(j AS VARCHAR) || '#' || CAST(g AS VARCHAR) || '#' || CAST(t AS VARCHAR) || '#40'")} * (SELECT max(total) FROM g WHERE field = fieldname)) AS BIGINT) AS r
  FROM pp, range(1, 3) x(g), range(1, 5) y(t) WHERE g <= 1 + CAST(floor({share_sql("wuid || '#' || fieldname || '#' || CAST(j AS VARCHAR) || '#39'")} * 2) AS BIGINT)),
neg AS (SELECT wuid, fieldname, j, a.g AS n, tag, arg_min(idx, t) AS context FROM a JOIN g ON g.field = a.fieldname AND r >= lo AND r < hi WHERE NOT list_contains(string_split(tags, ','), CAST(idx AS VARCHAR)) GROUP BY ALL)
"""


@query(f"{PAIRS} SELECT wuid, fieldname, tag, context, CAST(1 AS BIGINT) AS label FROM pp UNION ALL SELECT wuid, fieldname, tag, context, CAST(0 AS BIGINT) FROM neg")
def pair_samples(spark, sf_dir):
    vocab = _vocab(spark, sf_dir)
    known = P.known_tags(P.melt_tags(_tags(spark, sf_dir), "wuid", ["kinds", "items"]), vocab)
    return P.pair_samples(known, vocab).withColumn("label", F.col("label").cast("long"))


ROW_SHARE = "CAST(('0x' || substr(md5(CAST(l_orderkey AS VARCHAR) || '#' || CAST(l_linenumber AS VARCHAR) || '#' || CAST(label AS VARCHAR) || '#36'), 1, 8)) AS BIGINT) / 4294967296.0::DOUBLE"


@query(f"""WITH t AS (SELECT l_orderkey, l_linenumber, CAST(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS INTEGER) AS label FROM lineitem), f AS (SELECT label, least(1.0::DOUBLE, greatest(1, (SELECT count(*) FROM t WHERE label = 1)) / count(*)) AS rate FROM t GROUP BY label)
SELECT t.* FROM t JOIN f USING (label) WHERE {ROW_SHARE} < rate""")
def stratified_sample(spark, sf_dir):
    t = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("label"))
    return sample.by_field(t, "label", 1, 1.0)


@query("""WITH a AS (SELECT *, row_number() OVER (ORDER BY c_custkey) AS i FROM customer), b AS (SELECT c_mktsegment AS other, row_number() OVER (ORDER BY CAST(('0x' || substr(md5(CAST(c_custkey AS VARCHAR) || '#36'), 1, 8)) AS BIGINT), c_custkey) AS i FROM customer)
SELECT c_custkey, c_mktsegment, other FROM a JOIN b USING (i)""")
def shuffle_column(spark, sf_dir):
    return J.shuffle_column(table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment"), "c_mktsegment", "other", ["c_custkey"])


@query("SELECT split, CAST(o_orderkey AS BIGINT) AS o_orderkey FROM (SELECT o_orderkey, CASE WHEN " + SHARE + " < 0.9 THEN 'train' ELSE 'test' END AS split FROM orders)")
def split_to_examples(spark, sf_dir):
    """Nine tenths and the rest, each as examples."""
    root = _folder(spark, "tenths")
    df = sample.hash_split(table(spark, sf_dir, "orders").select("o_orderkey"), ["o_orderkey"], ["train", "test"], [0.9, 0.1], 36)
    out = None
    for name in ("train", "test"):
        sinks.save(df.where(F.col("split") == name).drop("split"), f"{root}/{name}", "tfrecord")
        own = text.load(spark, "tfrecord", [f"{root}/{name}"], schema="o_orderkey long").withColumn("split", F.lit(name))
        out = own if out is None else out.unionAll(own)
    return out


LINES = "SELECT DISTINCT l_linestatus AS c0, l_returnflag AS c1, l_quantity AS c2, l_tax AS c3 FROM lineitem"


@query(f"""WITH t AS ({LINES}), {bounds_sql("SELECT 'c2' AS feature, c2 AS x FROM t", 10, 'b2', zero=True)}, {bounds_sql("SELECT 'c3' AS feature, c3 AS x FROM t", 4, 'b3', zero=True)}
SELECT DISTINCT c0, c1, CAST({bin_sql('c2', 'c2', 'b2')} AS BIGINT) AS c2, CAST({bin_sql('c3', 'c3', 'b3')} AS BIGINT) AS c3 FROM t""")
def column_index_driver(spark, sf_dir):
    """l_tax has nine different values, fewer than ten: four bins."""
    t = table(spark, sf_dir, "lineitem").select(F.concat_ws(",", "l_linestatus", "l_returnflag", F.col("l_quantity").cast("string"), F.col("l_tax").cast("string")).alias("value"))
    return D.column_index_driver(t, 4, 0, [1], [2, 3], 10)


# learned artefacts, workflows, the wide-table job


@query(f"""WITH {bounds_sql(melt_sql('customer', ['c_acctbal']), 1000)} SELECT 'bounds' AS kind, feature AS a, CAST(place AS VARCHAR) AS b, bound AS c FROM ({UNNEST})
UNION ALL SELECT 'index', field, value, CAST(row_number() OVER (ORDER BY cnt DESC, value) - 1 AS DOUBLE) FROM (SELECT 'c_mktsegment' AS field, c_mktsegment AS value, count(*) AS cnt FROM customer GROUP BY ALL)""")
def learn_bounds_and_index_node(spark, sf_dir):
    root = _folder(spark, "learned")
    job = workflow.build_job(f"""<job name="j"><pipeline name="p"><node id="a" processor="load_table"><properties><property key="table" value="{sf_dir}/customer.parquet"/></properties></node>
<node id="b" processor="learn_bounds_and_index"><properties><property key="numeric" value="c_acctbal"/><property key="category" value="c_mktsegment"/><property key="few" value="0"/><property key="least" value="0"/><property key="table_name" value="customer"/><property key="root_path" value="{root}"/></properties><dependency><node id="a" input="df"/></dependency></node></pipeline></job>""")
    workflow.run_job(spark, lambda: job, {})
    bounds = _bounds(D.load_bounds(spark, f"{root}/discretize/customer"))
    index = text.load(spark, "parquet", [f"{root}/index/customer"])
    return bounds.select(F.lit("bounds").alias("kind"), F.col("feature").alias("a"), F.col("place").cast("string").alias("b"), F.col("bound").alias("c")).unionAll(index.select(F.lit("index"), "field", "value", F.col("rank").cast("double")))


@query(f"""WITH x AS (SELECT col, value, row_number() OVER (ORDER BY col, value) AS idx FROM ({SVM}))
SELECT l_returnflag || ' ' || CAST(a.idx AS VARCHAR) || ':' || l_linestatus || ' ' || CAST(b.idx AS VARCHAR) || ':' || CAST(l_linenumber AS VARCHAR) AS line
FROM lineitem JOIN x a ON a.col = 0 AND a.value = l_linestatus JOIN x b ON b.col = 1 AND b.value = CAST(l_linenumber AS VARCHAR)""")
def libsvm_node(spark, sf_dir):
    """Two columns dropped, the label's place counted before that, the map saved."""
    root = _folder(spark, "svm")
    job = workflow.build_job(f"""<job name="j"><pipeline name="p"><node id="a" processor="load_table"><properties><property key="table" value="{sf_dir}/lineitem.parquet"/></properties></node>
<node id="s" processor="sql"><properties><property key="sql" value="SELECT l_orderkey, l_partkey, l_returnflag, l_linestatus, l_linenumber FROM tmp_table"/></properties><dependency><node id="a" input="df"/></dependency></node>
<node id="b" processor="libsvm"><properties><property key="label_idx" value="2"/><property key="map_path" value="{root}"/></properties><dependency><node id="s" input="df"/></dependency></node></pipeline></job>""")
    return workflow.run_job(spark, lambda: job, {})["p"]["b"]


WIDE_XML = """<config><task_type name="{task}"/><data_type name="user"/><sample><labelrate name="1"/><split><train name="0.7"/><val name="0.2"/><test name="0.1"/></split><save_path><root_path name="{root}"/></save_path><save_type><is_Text>true</is_Text></save_type></sample>
<action_data><input>{dir}/labelled</input><label_name name="label"/><ids><id name="o_orderkey"/><id name="o_custkey"/></ids><contenxt_features><feature feature_name="priority" value_field="o_orderpriority" feature_type="category" isencode="1"/><feature feature_name="price" value_field="o_totalprice" isdiscretize="1" discretize="equi_val" discretize_argv="5"/></contenxt_features></action_data>
<feature_collect><feature_data norm_name="customer" time="last"><input>{dir}/customer.parquet</input><features><feature feature_name="balance" value_field="c_acctbal" isdiscretize="1" discretize_argv="10"/><feature feature_name="segment" value_field="c_mktsegment" feature_type="category" isencode="1"/></features><id_conf id_field="c_custkey" join_field="o_custkey"/></feature_data>
<feature_data norm_name="nation" time="last"><input>{dir}/nation.parquet</input><features><feature feature_name="nation" value_field="n_name" feature_type="category"/></features><id_conf id_field="n_nationkey" join_field="o_custkey" from_id="c_nationkey" to_id="c_custkey"/></feature_data></feature_collect>
<gen_feature><features name="comb_features"><feature name="segment_nation" dependencies="segment|nation"/></features></gen_feature></config>"""

WIDE_SQL = f"""act AS (SELECT o_orderkey, o_custkey, o_orderpriority, o_totalprice, CAST(CASE WHEN o_orderstatus = 'P' OR o_orderkey % 5 = 0 THEN 1 ELSE 0 END AS BIGINT) AS label FROM orders),
m AS (SELECT min(CAST(o_totalprice AS FLOAT)) lo, max(CAST(o_totalprice AS FLOAT)) hi FROM act WHERE CAST(o_totalprice AS FLOAT) <> 0), w AS (SELECT lo, CAST(CAST(hi - lo AS FLOAT) / 5 AS FLOAT) w FROM m),
pb AS (SELECT list(CAST(lo + CAST(CAST(i AS FLOAT) * w AS FLOAT) AS FLOAT) ORDER BY i) AS b FROM w, range(1, 5) r(i)),
{bounds_sql(melt_sql('customer', ['c_acctbal']), 10)},
pri AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS i FROM (SELECT DISTINCT o_orderpriority AS v FROM act)), seg AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS i FROM (SELECT DISTINCT c_mktsegment AS v FROM customer)),
map AS (SELECT DISTINCT c_nationkey AS f, c_custkey AS t FROM customer WHERE c_nationkey <> 0 AND c_custkey <> 0), few AS (SELECT map.* FROM map JOIN (SELECT f FROM map GROUP BY f HAVING count(*) < 100) USING (f)),
wide AS (SELECT o_orderkey, o_custkey, label, CAST(pri.i AS VARCHAR) AS priority, CAST(len(list_filter(pb.b, lambda x: x < o_totalprice)) AS VARCHAR) AS price, CASE WHEN c_custkey IS NULL THEN NULL ELSE CAST({bin_sql('c_acctbal', 'c_acctbal')} AS VARCHAR) END AS balance, CAST(seg.i AS VARCHAR) AS segment, n_name AS nation,
 n_name || '_' || CAST(seg.i AS VARCHAR) AS segment_nation
 FROM act CROSS JOIN pb LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN pri ON pri.v = o_orderpriority LEFT JOIN seg ON seg.v = c_mktsegment LEFT JOIN few ON few.t = o_custkey LEFT JOIN nation ON n_nationkey = few.f)"""


def _wide_spec(spark, sf_dir, task: str) -> spec.WideSpec:
    root = _folder(spark, "wide")
    label = ((F.col("o_orderstatus") == "P") | (F.col("o_orderkey") % 5 == 0)).cast("long")
    sinks.save(table(spark, sf_dir, "orders").withColumn("label", label), f"{root}/labelled", "parquet")
    xml = WIDE_XML.replace("{dir}/labelled", f"{root}/labelled").replace("{dir}", sf_dir).replace("{root}", f"{root}/samples").replace("{task}", task)
    return spec.read_wide_spec(xml)


def _mappings(spark, sf_dir) -> dict:
    return {"c_nationkey:c_custkey": table(spark, sf_dir, "customer").select("c_nationkey", "c_custkey")}


@query(f"WITH {WIDE_SQL} SELECT * FROM wide")
def wide_spec_job(spark, sf_dir):
    """The declared job: two feature tables, one by an id mapping, bins, dictionaries, a cross."""
    return wide.run(spark, _wide_spec(spark, sf_dir, "predict"), "19980801", mappings=_mappings(spark, sf_dir)).frame


SPEC_ROW = "CAST(o_orderkey AS VARCHAR) || '#' || CAST(o_custkey AS VARCHAR) || '#' || CAST(label AS VARCHAR) || '#' || coalesce(priority, '') || '#' || coalesce(price, '') || '#' || coalesce(balance, '') || '#' || coalesce(segment, '') || '#' || coalesce(nation, '') || '#' || coalesce(segment_nation, '') || '#36'"


@query(f"""WITH {WIDE_SQL}, f AS (SELECT label, least(1.0::DOUBLE, (1.0::DOUBLE * (SELECT count(*) FROM wide WHERE label = 1)) / count(*)) AS rate FROM wide GROUP BY label),
s AS (SELECT *, {share_sql("CAST(o_orderkey AS VARCHAR) || '#' || CAST(o_custkey AS VARCHAR) || '#36'")} AS spot FROM wide JOIN f USING (label) WHERE {share_sql(SPEC_ROW)} < rate)
SELECT CASE WHEN spot < 0.7 THEN 'train' WHEN spot < (0.7 + 0.2) THEN 'val' ELSE 'test' END AS split, CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(label AS VARCHAR) AS label, balance, segment_nation FROM s""")
def wide_spec_samples(spark, sf_dir):
    """The declared job for training: the other group cut to the positives' number, split, saved as text, read back."""
    out = wide.run(spark, _wide_spec(spark, sf_dir, "train"), "19980801", mappings=_mappings(spark, sf_dir))
    fields = [c for c in out.frame.columns if c != "split"]
    every = None
    for path in out.written:
        name = path.split("/19980801")[1].split("_")[0]
        own = text.load_text(spark, [path], fields).select(F.lit(name).alias("split"), "o_orderkey", "label", "balance", "segment_nation")
        every = own if every is None else every.unionAll(own)
    return every


@query(f"WITH {WIDE_SQL} SELECT o_orderkey, label, balance, nation FROM wide")
def wide_table_node(spark, sf_dir):
    """The declared job as a node of a workflow, from a configuration file."""
    folder = _folder(spark, "wide-node")
    label = ((F.col("o_orderstatus") == "P") | (F.col("o_orderkey") % 5 == 0)).cast("long")
    sinks.save(table(spark, sf_dir, "orders").withColumn("label", label), f"{folder}/labelled", "parquet")
    sinks.save(_mappings(spark, sf_dir)["c_nationkey:c_custkey"], f"{folder}/map", "parquet")
    write_small(spark, f"{folder}/spec.xml", WIDE_XML.replace("{dir}/labelled", f"{folder}/labelled").replace("{dir}", sf_dir).replace("{root}", "").replace("{task}", "predict"))
    job = workflow.build_job(f"""<job name="j"><pipeline name="p"><node id="a" processor="wide_table"><properties><property key="config" value="{folder}/spec.xml"/><property key="mappings" value="c_nationkey:c_custkey={folder}/map"/></properties></node></pipeline></job>""")
    return workflow.run_job(spark, lambda: job, {})["p"]["a"].select("o_orderkey", "label", "balance", "nation")


@query(f"""WITH {bounds_sql(melt_sql('customer', ['c_acctbal']), 1000, 'c')}, {bounds_sql(melt_sql('orders', ['o_totalprice']), 1000, 'o')}
SELECT 'bounds' AS kind, feature, CAST(len(b) AS BIGINT) AS n, CAST(list_aggregate(b, 'max') AS DOUBLE) AS top FROM c UNION ALL SELECT 'bounds', feature, len(b), CAST(list_aggregate(b, 'max') AS DOUBLE) FROM o
UNION ALL SELECT 'index', 'c_mktsegment', count(DISTINCT c_mktsegment), CAST(count(DISTINCT c_mktsegment) - 1 AS DOUBLE) FROM customer UNION ALL SELECT 'index', 'o_orderpriority', count(DISTINCT o_orderpriority), CAST(count(DISTINCT o_orderpriority) - 1 AS DOUBLE) FROM orders""")
def wide_learn_artefacts(spark, sf_dir):
    """Bounds and indices of the action table and of every feature table, read back."""
    root, out = _folder(spark, "artefacts"), None
    for path in wide.learn_artefacts(spark, _wide_spec(spark, sf_dir, "train"), "19980801", root, few=0, least=0):
        if "/discretize/" in path:
            own = D.load_bounds(spark, path).select(F.lit("bounds").alias("kind"), "feature", F.size("boundaries").cast("long").alias("n"), F.array_max("boundaries").cast("double").alias("top"))
        else:
            own = text.load(spark, "parquet", [path]).groupBy(F.col("field").alias("feature")).agg(F.count("*").alias("n"), F.max("rank").cast("double").alias("top")).select(F.lit("index").alias("kind"), "feature", "n", "top")
        out = own if out is None else out.unionAll(own)
    return out


@workflow.node("query_source")
class _Source(workflow.Node):
    takes = (0, 0)

    def run(self) -> DataFrame:
        return self.coalesced(self.spark.range(self.get("n", 3, int)).repartition(4))


@workflow.node("query_stop")
class _Stop(workflow.Node):
    def run(self, df: DataFrame) -> DataFrame:
        raise workflow.Terminated


@workflow.node("query_fail")
class _Fail(workflow.Node):
    def run(self, df: DataFrame) -> DataFrame:
        raise ValueError("on purpose")


@workflow.node("query_number")
class _Number(workflow.Node):
    takes = (0, 0)

    def run(self) -> int:
        return 1


def _outcome(f) -> str:
    try:
        return str(f())
    except workflow.DependencyError:
        return "dependency error"
    except workflow.FlowError:
        return "flow error"
    except ValueError:
        return "value error"


@query("""SELECT * FROM (VALUES ('node over workflow', '5'), ('command line over node', '6'), ('node on the command line', '7'), ('workflow', '4'), ('early end', 'completed terminated created'), ('failure', 'flow error'),
('cycle', 'dependency error'), ('unknown input', 'dependency error'), ('edge type', 'flow error'), ('arguments', 'flow error'), ('backfill', 'p@2024010100 p@2023123123 p@2023123122'), ('coalesced', '2'), ('fan-out', '4 0')) t(case_, result)""")
def workflow_control(spark, sf_dir):
    """Property precedence, states, type and dependency checks, early end, backfill, arguments, coalescing."""
    source = '<node id="a" processor="query_source"><properties><property key="n" value="5"/></properties></node>'

    def job(xml: str, props: str = '<property key="n" value="4"/>'):
        return workflow.build_job(f'<job name="j"><pipeline name="p"><properties>{props}</properties>{xml}</pipeline></job>')

    def after(id: str, kind: str, dep: str, props: str = "") -> str:
        return f'<node id="{id}" processor="{kind}"><properties>{props}</properties><dependency><node id="{dep}" input="df"/></dependency></node>'

    count = lambda xml, cli: workflow.run_job(spark, lambda: job(xml), cli)["p"]["a"].count()
    out = [("node over workflow", count(source, {})), ("command line over node", count(source, {"n": "6"})), ("node on the command line", count(source, {"n": "6", "a.n": "7"})), ("workflow", count('<node id="a" processor="query_source"/>', {}))]
    ended = job(source + after("b", "query_stop", "a") + after("c", "query_fail", "b"))
    workflow.run_job(spark, lambda: ended, {})
    out.append(("early end", " ".join({workflow.State.INIT: "created"}.get(n.state, n.state.value) for n in ended.pipelines[0].nodes.values())))
    out.append(("failure", _outcome(lambda: workflow.run_job(spark, lambda: job(source + after("b", "query_fail", "a")), {}))))
    out.append(("cycle", _outcome(lambda: job(after("a", "query_stop", "b") + after("b", "query_stop", "a")))))
    out.append(("unknown input", _outcome(lambda: job(after("a", "query_stop", "nowhere")))))
    out.append(("edge type", _outcome(lambda: job('<node id="a" processor="query_number"/>' + after("b", "query_stop", "a")))))
    out.append(("arguments", _outcome(lambda: workflow.parse_arguments(["flow=x", "oops"]))))
    out.append(("backfill", " ".join(workflow.run_job(spark, lambda: job(source), {"dataTime": "2024010100", "regression": "3"}))))
    out.append(("coalesced", workflow.run_job(spark, lambda: job(source), {"coalescePartition": "2"})["p"]["a"].rdd.getNumPartitions()))
    sql = lambda f: f'<property key="sql" value="SELECT {f}(id) AS m FROM tmp_table"/>'
    both = workflow.run_job(spark, lambda: job(source + after("b", "sql", "a", sql("max")) + after("c", "sql", "a", sql("min"))), {})["p"]
    out.append(("fan-out", f"{both['b'].head().m} {both['c'].head().m}"))
    return spark.createDataFrame([(a, str(b)) for a, b in out], "case_ string, result string")


# times: every instant is worked out twice, here from strings and in SQL from dates

INSTANTS = "SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders"


@query(f"""SELECT strftime(d, '%Y%m%d') AS day, strftime(d - INTERVAL 3 MONTH, '%Y%m%d') AS month, strftime(d - INTERVAL 2 YEAR, '%Y%m%d') AS year, strftime(d - INTERVAL 14 DAY, '%Y%m%d') AS weeks, strftime(d - INTERVAL 1 HOUR, '%Y%m%d%H') AS hour, strftime(d + INTERVAL 40 DAY, '%Y%m%d') AS later,
'p/' || strftime(d + INTERVAL 13 HOUR, '%Y%m%d%H') || '/' || strftime(d + INTERVAL 2 DAY, '%Y%m%d') || '/' || strftime(d + INTERVAL 14 HOUR + INTERVAL 5 MINUTE, '%Y%m%d%H%M') AS wild, strftime(d, '%y%m%d') || '-' || strftime(d, '%Y%m%d') || '14' AS current_,
CAST(epoch_ms(d) - 8 * 3600000 AS BIGINT) AS ms, CAST(1 AS BIGINT) AS aligned, CAST(0 AS BIGINT) AS unaligned, strftime(d, '%Y%m%d') || ' ' || strftime(d - INTERVAL 1 DAY, '%Y%m%d') AS backfill, CAST(epoch_ms(d) - 2 * 2 * 3600000 AS BIGINT) AS first_, CAST(epoch_ms(d) + 3 * 2 * 3600000 AS BIGINT) AS last_, CAST(epoch_ms(d) + 2 * 3600000 AS BIGINT) AS fixed_, CAST(14 AS BIGINT) AS of_day, CAST(850 AS BIGINT) AS minute_of_day, CAST(7 * 24 * 3600000 AS BIGINT) AS week_ms FROM ({INSTANTS})""")
def time_functions(spark, sf_dir):
    """Granularities, alignment, formats, periods, windows, wildcards and backfills, for every day of an order."""
    g = times.Granularity
    rows = []
    for (day,) in table(spark, sf_dir, "orders").select(F.date_format("o_orderdate", "yyyyMMdd")).distinct().collect():  # one row a day
        at = times.parse(f"{day}1410")
        ms, utc = times.to_epoch_ms(times.parse(day), 8), times.to_epoch_ms(times.parse(day))
        assert times.granularity_of(f"{day}14") == g.HOUR and times.show(at, g.DAY) == day
        assert times.require_aligned(ms, g.DAY) == ms and _outcome(lambda u=utc: times.require_aligned(u, g.DAY)) == "value error"
        first, last = times.window(utc, g.HOUR, 2, 3, 3, False)
        rows.append((
            day, times.back(day, g.MONTH, 3, 1), times.back(day, g.YEAR, 1, 2), times.back(day, g.WEEK, 2, 1), times.back(f"{day}00", g.HOUR, 1, 1), times.period_days(day, 40),
            times.fill_wildcards("p/YYYYMMDDHH-1/YYYYMMDD+2DAY/YYYYMMDDHHMM-5", at), times.fill_current("{currentDayShort}-{currentHour}", at),
            ms, int(times.is_aligned(ms, g.DAY)), int(times.is_aligned(utc, g.DAY)), " ".join(times.backfill(day, 2)), first, last, times.window(utc, g.HOUR, 2, 3, 3, True)[1],
            times.cycle_of_day(f"{day}14"), times.cycle_of_day(f"{day}1410"), g.WEEK.milliseconds(),
        ))
    names = "day string, month string, year string, weeks string, hour string, later string, wild string, current_ string, ms long, aligned long, unaligned long, backfill string, first_ long, last_ long, fixed_ long, of_day long, minute_of_day long, week_ms long"
    return spark.createDataFrame(rows, T._parse_datatype_string(names))


# functions by SQL, and functions of one's own


@query("SELECT p_partkey, regexp_extract(p_type, '^([A-Z]+) ', 1) AS first, regexp_replace(p_name, '[aeiou]', '*', 'g') AS masked, CAST(CASE WHEN regexp_matches(p_brand, '[13]$') THEN 1 ELSE 0 END AS BIGINT) AS odd FROM part")
def sql_regex_fns(spark, sf_dir):
    return project.run_sql("SELECT p_partkey, regexp_extract(p_type, '^([A-Z]+) ', 1) AS first, regexp_replace(p_name, '[aeiou]', '*') AS masked, CAST(CASE WHEN p_brand RLIKE '[13]$' THEN 1 ELSE 0 END AS BIGINT) AS odd FROM {t}", t=table(spark, sf_dir, "part"))


@query("SELECT o_custkey, CAST(max(CASE WHEN o_orderstatus = 'F' THEN n END) AS BIGINT) AS f, coalesce(CAST(max(CASE WHEN o_orderstatus = 'P' THEN n END) AS BIGINT), -1) AS p, CAST(count(*) AS BIGINT) AS size, string_agg(o_orderstatus, '' ORDER BY o_orderstatus) AS keys FROM (SELECT o_custkey, o_orderstatus, count(*) AS n FROM orders GROUP BY ALL) GROUP BY o_custkey")
def sql_map_fns(spark, sf_dir):
    return project.run_sql("""SELECT o_custkey, element_at(m, 'F') AS f, coalesce(element_at(m, 'P'), -1) AS p, CAST(size(m) AS BIGINT) AS size, array_join(sort_array(map_keys(m)), '') AS keys
FROM (SELECT o_custkey, map_from_entries(collect_list(struct(o_orderstatus, n))) AS m FROM (SELECT o_custkey, o_orderstatus, count(*) AS n FROM {t} GROUP BY o_custkey, o_orderstatus) GROUP BY o_custkey)""", t=table(spark, sf_dir, "orders"))


@query("SELECT CAST(c_custkey AS BIGINT) AS c_custkey, upper(substr(c_mktsegment, 1, 1)) || CAST(length(c_mktsegment) AS VARCHAR) AS code FROM customer")
def own_function_in_workflow(spark, sf_dir):
    """A function registered on the session, named by a workflow's statement."""

    def code(s):
        return s.str[:1].str.upper() + s.str.len().astype(str)

    spark.udf.register("segment_code", F.pandas_udf(code, "string"))
    job = workflow.build_job(f"""<job name="j"><pipeline name="p"><node id="a" processor="load_table"><properties><property key="table" value="{sf_dir}/customer.parquet"/></properties></node>
<node id="b" processor="sql"><properties><property key="sql" value="SELECT c_custkey, segment_code(c_mktsegment) AS code FROM tmp_table"/></properties><dependency><node id="a" input="df"/></dependency></node></pipeline></job>""")
    assert "sql" in workflow.REGISTRY and nodes.Sql is workflow.REGISTRY["sql"]
    return workflow.run_job(spark, lambda: job, {})["p"]["b"]


SCORES = "SELECT user_id, event_type, count(*) AS c FROM events GROUP BY ALL"


@query(f"""WITH r AS (SELECT user_id, event_type, c, row_number() OVER (PARTITION BY user_id ORDER BY c DESC, event_type) r FROM ({SCORES}))
SELECT user_id, string_agg(event_type || ':' || CAST(c AS VARCHAR) || '.0', ',' ORDER BY r) AS kinds FROM r WHERE r <= 2 GROUP BY user_id""")
def multi_value_identity(spark, sf_dir):
    """The top values with their scores."""
    c = table(spark, sf_dir, "events").groupBy("user_id", "event_type").agg(F.count("*").alias("c"))
    packed = c.groupBy("user_id").agg(F.array_join(F.array_sort(F.collect_list(F.concat_ws(":", "event_type", F.col("c").cast("string")))), ",").alias("kinds"))
    return E.top_values(packed, ["user_id"], "kinds", 2, scores=True)


@query(f"WITH {MELTED}, t2 AS (SELECT wuid, fieldname, string_split(feats, ',') AS l FROM m) SELECT wuid, fieldname, array_to_string(list_filter(l, lambda x: NOT list_contains(['click', '1', '2'], x)), ',') AS rest FROM t2")
def array_difference(spark, sf_dir):
    melted = P.melt_tags(_tags(spark, sf_dir), "wuid", ["kinds", "items"])
    parts = F.filter(F.split("feats", ","), lambda x: ~F.array_contains(F.array(F.lit("click"), F.lit("1"), F.lit("2")), x))
    return melted.select("wuid", "fieldname", F.array_join(parts, ",").alias("rest"))


@query(f"WITH {COUNTS} SELECT field, CAST(sum(cnt) AS BIGINT) AS total, count(*) AS tokens FROM c GROUP BY field")
def field_totals(spark, sf_dir):
    counts = P.token_stats(P.melt_tags(_tags(spark, sf_dir), "wuid", ["kinds", "items"]))
    return counts.groupBy(col("field").alias("field")).agg(F.sum("cnt").alias("total"), F.count("*").alias("tokens"))


@query("SELECT event_type AS label, count(*) AS cnt FROM events GROUP BY 1")
def label_histogram(spark, sf_dir):
    return A.label_histogram(table(spark, sf_dir, "events"), "event_type")
