import gzip
import struct
import zipfile

import pytest
from pyspark.sql import functions as F

from samplewright.functions import times as T
from samplewright.sources import partitions, records, sinks, text


def test_length_prefixed_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(bytes([i]) * i,) for i in range(1, 40)], "record binary").repartition(3)
    for compression in ("none", "gzip"):
        path = str(tmp_path / compression)
        records.register(spark)
        records.write_records(df, path, "lpb", "overwrite", compression)
        want = sorted(bytes(r.record) for r in df.collect())
        assert sorted(bytes(r.record) for r in spark.read.format("lpb").load(path).select("record").collect()) == want
        assert sorted(bytes(r.record) for r in records.read_lpb(spark, [path]).collect()) == want


def test_bad_records(spark, tmp_path):
    good = records.framed(b"abc")
    assert list(records.frames(b"")) == []
    assert list(records.frames(good + struct.pack("<i", 0) + b"junk")) == [b"abc"]
    for bad in (struct.pack("<i", -5), struct.pack("<i", 9) + b"ab", b"\1"):
        with pytest.raises(ValueError):
            list(records.frames(good + bad))
        assert list(records.frames(good + bad, strict=False)) == [b"abc"]
    (tmp_path / "x.gz").write_bytes(gzip.compress(good + good))
    assert records.read_lpb(spark, [str(tmp_path / "x.gz")]).count() == 2


def test_examples_round_trip(spark, tmp_path):
    schema = "i long, f float, s string, l array<long>, n long"
    rows = [(-3, 1.5, "né", [1, -2], None), (2**40, 0.0, "", [], 7)]
    df = spark.createDataFrame(rows, schema)
    path = str(tmp_path / "t")
    sinks.save(df, path, "tfrecord")
    back = sorted(tuple(r) for r in records.read_tfrecord(spark, [path], schema).collect())
    assert back == sorted(rows, key=lambda r: r[0])
    assert records.masked_crc(b"123456789") == (((0xE3069283 >> 15 | 0xE3069283 << 17) & 0xFFFFFFFF) + 0xA282EAD8) & 0xFFFFFFFF
    sinks.save(df, path, "tfrecord", mode="ignore")
    assert records.read_tfrecord(spark, [path], schema).count() == 2


def test_text_dates_and_missing_paths(spark, tmp_path):
    assert len(text.expand_dates("20221006-20230428")) == 205 and text.expand_dates("x-y") == ["x-y"]
    assert text.expand_dates("20240228-20240301") == ["20240228", "20240229", "20240301"]
    for day in ("20240228", "20240301"):
        spark.createDataFrame([(day, "a")], "d string, v string").write.csv(str(tmp_path / day))
    got = text.load_text(spark, text.date_paths(str(tmp_path), "20240228-20240301"), ["d", "v"])
    assert sorted(r.d for r in got.collect()) == ["20240228", "20240301"]
    assert text.load_text(spark, [str(tmp_path / "no")], ["a"]).count() == 0
    with pytest.raises(FileNotFoundError):
        text.load(spark, "text", [str(tmp_path / "no")], allow_missing=False)
    assert text.wait_ready(spark, str(tmp_path / "2024*"), 2, 1) and not text.wait_ready(spark, str(tmp_path / "2024*"), 3, 0.1, 0.05)


def test_whole_files_markers_zips_and_partitions(spark, tmp_path):
    (tmp_path / "w").mkdir()
    (tmp_path / "w" / "a").write_bytes(b"x")
    (tmp_path / "w" / "b").write_bytes(b"")
    assert text.load(spark, "whole", [str(tmp_path / "w")]).count() == 1
    sinks.mark_done(spark, str(tmp_path / "w"))
    assert text.exists(spark, str(tmp_path / "w" / "_SUCCESS"))
    sinks.mark_done(spark, str(tmp_path / "w"), False)
    assert not text.exists(spark, str(tmp_path / "w" / "_SUCCESS"))
    (tmp_path / "z").mkdir()
    sinks.save_zip(spark.createDataFrame([(b"ab",), (b"cd",)], "r binary").coalesce(1), str(tmp_path / "z"))
    with zipfile.ZipFile(next((tmp_path / "z").iterdir())) as z:
        assert z.read(z.namelist()[0]) == b"abcd"
    path = str(tmp_path / "p")
    sinks.save_partition(spark.createDataFrame([(1, "p_20240101"), (2, "p_20240102")], "v int, dt string"), path, "dt")
    sinks.save_partition(spark.createDataFrame([(3, "p_20240102")], "v int, dt string"), path, "dt", 1)
    df = spark.read.parquet(path)
    assert sorted(r.v for r in df.collect()) == [1, 3]
    assert [r.v for r in partitions.load(df, "dt", "last", "20240101").collect()] == [3]
    assert [r.v for r in partitions.load(df, "dt", "-1", "20240101").collect()] == [1]
    assert partitions.resolve("20240101,p_20240102", "") == ["p_20240101", "p_20240102"]
    assert partitions.latest_until(df, "dt", "p_20240101") == "p_20240101" and not partitions.exists(df, "dt", "p_1")
    sinks.save_splits(spark.createDataFrame([("a", "train"), ("b", "test")], "v string, split string"), str(tmp_path) + "/", "2024", ["text"])
    assert spark.read.text(str(tmp_path / "2024train_text")).count() == 1


def test_partition_choice(spark):
    df = spark.createDataFrame([("default",), ("p_20240101",), ("p_20240103",), ("p_20240102",)], "part string")
    assert [r.part for r in partitions.latest(df, "part", 2).collect()] == ["p_20240103", "p_20240102"]
    assert df.where(partitions.outside("part", [])).count() == 4
    days = spark.createDataFrame([(d,) for d in T.days_between("20240101", "20240131")], "part string")
    got = sorted(r.part for r in partitions.window_days(days, "part", "20240131", 2, 1).collect())
    assert got == ["20240124", "20240125"]


def test_times():
    assert T.granularity_of("2024010112") == T.Granularity.HOUR
    for bad in ("2024", "20230230", "2024010a"):
        with pytest.raises(ValueError):
            T.parse(bad)
    assert T.back("20240331", T.Granularity.MONTH, 1, 1) == "20240229"
    assert T.backfill("2024010100", 3) == ["2024010100", "2023123123", "2023123122"]
    t = T.parse("202401312330")
    assert T.fill_wildcards("x/YYYYMMDDHH-1/YYYYMMDD+2DAY/YYYYMMDDHHMM+40", t) == "x/2024013122/20240202/202402010010"
    assert T.fill_current("{currentDay}-{currentHour}", t) == "20240131-2024013123"
    assert T.cycle_of_day("202401010130") == 90 and T.cycle_of_day("20240101") == 0
    assert T.is_aligned(T.to_epoch_ms(T.parse("20240101"), 8), T.Granularity.DAY)
    assert T.window(10_000_000_000, T.Granularity.HOUR, 2, 3, 2, True) == (10_000_000_000 - 14_400_000, 10_000_000_000 + 7_200_000)
    with pytest.raises(ValueError):
        T.Granularity.MONTH.minutes()


def test_array_functions_used_by_sources(spark):
    assert partitions.keyed(spark.range(1).withColumn("v", F.lit(2)), "id", ["v"]).head().values == ["2"]
    with pytest.raises(ValueError):
        partitions.keyed(spark.range(1), "id", ["nope"])


def test_writes_replace_at_commit_and_leave_nothing_behind(spark, tmp_path):
    path = str(tmp_path / "o")
    df = spark.createDataFrame([(b"a",), (b"b",)], "record binary")
    records.write_records(df, path, "lpb")
    shown = lambda: sorted(p.name for p in (tmp_path / "o").iterdir() if p.name != "_temporary")
    kept = shown()
    broken = df.select(F.udf(lambda r: 1 / 0, "binary")("record").alias("record"))
    with pytest.raises(Exception, match="division by zero"):
        records.write_records(broken, path, "lpb")
    assert shown() == kept
    records.write_records(df.limit(1), path, "lpb")
    assert records.read_lpb(spark, [path]).count() == 1 and not (tmp_path / "o" / "_temporary").exists()


def test_skip_policies_and_packing(spark, tmp_path):
    (tmp_path / "a.pb").write_bytes(records.framed(b"x") + struct.pack("<i", -5))
    (tmp_path / "b.pb.gz").write_bytes(b"no gzip")
    (tmp_path / "c.pb").write_bytes(records.framed(b"y"))
    records.register(spark)
    read = lambda **o: sorted(bytes(r.record) for r in spark.read.format("lpb").options(**o).load(str(tmp_path)).collect())
    assert read(skip_bad="true", skip_errors="true") == read(mode="PERMISSIVE") == [b"x", b"y"]
    for only in ({"skip_bad": "true"}, {"skip_errors": "true"}):
        with pytest.raises(Exception, match="bad record|gzip|zlib"):
            read(**only)
    files = [("r", f"f{i}", n) for i, n in enumerate((5, 5, 50, 1, 1))]
    assert [[p for _, p in f] for f in records.packed(files, 10)] == [["f0", "f1"], ["f2"], ["f3", "f4"]]


def test_checksums_side_by_side(spark):
    import random

    rng = random.Random(3)
    held = [rng.randbytes(rng.choice([0, 1, 7, 300])) for _ in range(100)] + [b"123456789"]
    assert records.masked_crcs(held) == [records.masked_crc(h) for h in held] and records.masked_crcs([]) == []
    frame = records.tf_frame(b"abc")
    assert list(records.tf_frames(frame + frame)) == [b"abc", b"abc"]
    for bad in (frame[:-1], frame[:-1] + b"?", b"zz" + frame):
        assert list(records.tf_frames(frame + bad, strict=False)) == [b"abc"]
        with pytest.raises(ValueError):
            list(records.tf_frames(frame + bad))


def test_loads_by_kind(spark, tmp_path):
    sinks.save(spark.range(3), str(tmp_path / "t"), "tfrecord")
    assert text.load(spark, "tfrecord", [str(tmp_path / "t")], schema="id long").count() == 3
    with pytest.raises(ValueError):
        text.load(spark, "tfrecord", [str(tmp_path / "t")])
    for kind in ("sequence", "records", "whole", "text"):
        assert text.load(spark, kind, [str(tmp_path / "no")]).count() == 0
    assert text.load(spark, "parquet", [str(tmp_path / "no")], schema="a int").count() == 0
    with pytest.raises(FileNotFoundError):
        text.load(spark, "parquet", [str(tmp_path / "no")])


def test_newest_periods(spark):
    df = spark.createDataFrame([("p_20240131",), ("p_20240201",), ("p_20240215",), ("p_20231230",), ("default",)], "part string")
    assert sorted(r.part for r in partitions.newest(df, "part", 2, "month").collect()) == ["p_20240131", "p_20240201", "p_20240215"]
    assert sorted(r.part for r in partitions.newest(df, "part", 1).collect()) == ["p_20240215"]


def test_session_settings_stay(spark):
    from samplewright.scratch import ARROW, Scratch, numbered

    before = spark.conf.get(ARROW)
    scratch = Scratch(spark, "t")
    assert scratch.save(spark.range(5), "x").count() == 5 and spark.conf.get(ARROW) == before
    got = numbered(spark.range(1000).repartition(7), [F.desc("id")], "n", 5).collect()
    assert {r.n: r.id for r in got} == {i + 5: 999 - i for i in range(1000)}
    assert numbered(spark.range(0), ["id"]).count() == 0
