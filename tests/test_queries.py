import os

import pytest

import __spark_entry__ as entry

DATA = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data here")
def test_queries_equal_their_sql(spark):
    import duckdb

    con = duckdb.connect()
    for f in os.listdir(DATA):
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{DATA}/{f}'")
    made, sql = entry.queries(), entry.oracle_sql()
    show = lambda v: round(v, 6) if isinstance(v, float) else v
    wrong = []
    for name in sql:
        df = made[name](spark, DATA)
        columns = sorted(df.columns)
        own = sorted((tuple(show(r[c]) for c in columns) for r in df.collect()), key=str)
        got = con.execute(sql[name])
        names = [d[0] for d in got.description]
        other = sorted((tuple(show(r[names.index(c)]) for c in columns) for r in got.fetchall()), key=str)
        if own != other or sorted(names) != columns:
            wrong.append(name)
    assert not wrong


def test_half_prices_are_rounded_as_in_sql(spark, tmp_path):
    import duckdb

    # whole and half prices on both sides of 100000, keys divisible by 5, a null
    prices = [99_990 + k / 2 for k in range(60)] + [100_000.5, 100_002.5, 99_999.49, 100_003.51, 100_000.0, None]
    spark.createDataFrame(list(enumerate(prices, 1)), "o_orderkey long, o_totalprice double").write.parquet(str(tmp_path / "orders.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW orders AS SELECT * FROM '{tmp_path}/orders.parquet/*.parquet'")
    other = con.execute(f"SELECT o_orderkey, price FROM ({entry.oracle_sql()['discretize_or_raw']}) ORDER BY o_orderkey").fetchall()
    own = entry.queries()["discretize_or_raw"](spark, str(tmp_path)).orderBy("o_orderkey").collect()
    assert [(r.o_orderkey, r.price) for r in own] == other
    assert len({price for _, price in other}) > 5 and other[-1] == (66, None)


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data here")
def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_streams_give_what_batches_give(spark, tmp_path):
    from samplewright.streaming import events as S

    rows = spark.sql("SELECT CAST(TIMESTAMP '2024-01-01 00:00:00' + make_interval(0,0,0,0,0,id * 7) AS TIMESTAMP) AS ts, id % 3 AS k, 1.0D AS v FROM range(100)")
    rows.write.parquet(str(tmp_path / "in"))
    stream = S.tumbling(spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in")), "ts", "1 hour", ["k"], "v")
    q = stream.writeStream.outputMode("complete").format("memory").queryName("hours").start()
    q.processAllAvailable()
    q.stop()
    assert sorted(spark.table("hours").collect()) == sorted(S.tumbling(rows, "ts", "1 hour", ["k"], "v").collect())
    assert S.sliding(rows, "ts", "1 hour", "30 minutes", ["k"], "v").count() > 0 and S.sessions(rows, "ts", "5 minutes", ["k"], "v").count() == 100
