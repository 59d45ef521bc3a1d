from datetime import datetime

import pytest
from helpers import at, rows
from pyspark.sql import functions as F

from tremora.config import METRIC_RATINGS, SENSOR_LOCATIONS, STATUS_RATINGS, sensor_dimension
from tremora.functions import names
from tremora.functions.ratings import rating_band
from tremora.functions.time import epoch_micros, epoch_seconds, from_micros, parse_datetime, time_slice
from tremora.operators import rows as ops
from tremora.session import broadcast_if_small


def test_parse_datetime_is_strict(spark):
    df = spark.createDataFrame(
        [("2025-04-01", "00:00:05"), (" 2025-04-01 ", " 00:00:05"), ("2025-4-1", "00:00:05"), ("2025-04-01", "bad"), (None, "00:00:05"), ("2025-02-30", "00:00:00")],
        "Date string, Time string")
    got = [r.datetime for r in ops.with_datetime(df).collect()]
    assert got == [at(5), at(5), None, None, None, None]


def test_filter_range_keeps_both_ends(spark):
    df = spark.createDataFrame([(at(0), 1), (at(60), 2), (at(120), 3)], "datetime timestamp_ntz, value long")
    assert ops.filter_range(df, at(0), at(60)).count() == 2
    assert ops.filter_range(df, at(0), None).count() == 3


def test_range_filter_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(at(i), i) for i in range(5)], "datetime timestamp_ntz, value long").write.parquet(path)
    plan = ops.filter_range(spark.read.parquet(path), at(1), at(2))._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(datetime), GreaterThanOrEqual(datetime" in plan


def test_overlap_range(spark):
    a = spark.createDataFrame([("d", at(s)) for s in (0, 10, 20)] + [("only_a", at(0))], "device string, datetime timestamp_ntz")
    b = spark.createDataFrame([("d", at(s)) for s in (10, 15, 40)], "device string, datetime timestamp_ntz")
    left, right = ops.overlap_range(a, b)
    assert rows(left) == rows(a.where(F.col("datetime") != at(0)).unionByName(a.where("device = 'only_a'")))
    assert [r[1] for r in rows(right, "datetime")] == [at(10), at(15)]
    empty = b.where("false")
    left, right = ops.overlap_range(a, empty)
    assert left.count() == 4 and right.count() == 0


def test_epoch_before_1970_rounds_down(spark):
    df = spark.createDataFrame([(datetime(1969, 12, 31, 23, 59, 59, 500000),), (datetime(1970, 1, 1, 0, 0, 1, 900000),)], "ts timestamp_ntz")
    out = df.select(epoch_seconds("ts"), time_slice("ts", 60), from_micros(epoch_micros("ts"))).collect()
    assert [r[0] for r in out] == [-1, 1]
    assert [r[1] for r in out] == [-1, 0]
    assert [r[2] for r in out] == [r.ts for r in df.collect()]


def test_times_do_not_depend_on_the_session_zone(spark):
    # 02:30 does not exist on this day in New York
    moment = datetime(2024, 3, 10, 2, 30, 15, 250000)
    df = spark.createDataFrame([(moment, "2024-03-10", "02:30:15", "20240310 023015_a.json")], "ts timestamp_ntz, d string, c string, f string")
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        got = df.select(epoch_micros("ts"), from_micros(epoch_micros("ts")), time_slice("ts", 3600), parse_datetime("d", "c"), names.wave_time(F.col("f"))).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    micros = int((moment - datetime(1970, 1, 1)).total_seconds() * 1_000_000)
    whole = moment.replace(microsecond=0)
    assert tuple(got) == (micros, moment, micros // 3_600_000_000, whole, whole)


def test_one_hot_null_is_all_zero(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "z")], "id long, location string")
    assert rows(ops.one_hot(df, {"location": ["a", "b"]}, {"location": "loc"}), "id") == [(1, 1, 0), (2, 0, 0), (3, 0, 0)]


def test_numeric_only_booleans(spark):
    df = spark.createDataFrame([(1, True, "x")], "a long, b boolean, c string")
    assert ops.numeric_only(df).columns == ["a", "b"]
    assert ops.numeric_only(df, booleans=False).columns == ["a"]
    assert ops.numeric_only(df, keep=["c"]).columns == ["a", "b", "c"]


def test_subsample_does_not_depend_on_partitioning(spark):
    df = spark.range(1000)
    a = {r.id for r in ops.subsample(df.repartition(3), ["id"], 50).collect()}
    b = {r.id for r in ops.subsample(df.coalesce(1), ["id"], 50).collect()}
    assert a == b and 400 < len(a) < 600


def test_subsample_takes_the_same_share_at_every_size(spark):
    shares = [ops.subsample(spark.range(n), ["id"], 20).count() / n for n in (5_000, 200_000)]
    assert all(abs(s - 0.2) < 0.02 for s in shares)
    some = spark.createDataFrame([(1, None), (None, None), (1, "a")], "id long, k string")
    assert ops.subsample(some, ["id", "k"], 100).count() == 3 and ops.subsample(some, ["id", "k"], 0).count() == 0


def test_union_by_name_and_drop(spark):
    a, b = spark.createDataFrame([(1, "x")], "id long, a string"), spark.createDataFrame([(2, 2.0)], "id long, b double")
    assert rows(ops.union_by_name(a, b), "id") == [(1, "x", None), (2, None, 2.0)]
    assert ops.drop_columns(a, ["a", "nope"]).columns == ["id"]
    assert ops.suffix_ratings(a, ["a", "nope"]).columns == ["id", "a_rating"]


def test_distinct_values_and_device(spark):
    df = spark.createDataFrame([("d", "b"), ("d", "a"), ("d", None), ("e", "a")], "device string, location string")
    assert [r.location for r in ops.distinct_values(df, "location").collect()] == ["a", "b"]
    assert ops.select_device(df, "d", ["a", "q"]).count() == 1
    assert ops.select_device(df, "d").count() == 3


def test_rating_bands(spark):
    df = spark.createDataFrame([(v,) for v in (100.0, 80.0, 79.5, 60.0, 59.9, 30.0, 29.0, None)], "r double")
    got = [r[0] for r in df.select(rating_band(F.col("r"))).collect()]
    assert got == ["healthy", "healthy", "usable", "usable", "warning", "warning", "fault", None]


def test_file_names(spark):
    hexes = "0" * 23 + "a", "67c29baa30e6dd385f031b30"
    full = f"20230101 120000_{hexes[0]}_{hexes[1]}_VV.json"
    given = [full, f"20230101120000_device_{hexes[1]}_VV.json", "x_20230101_120000.json", "nothing.json", "20231301 120000_x.json"]
    df = spark.createDataFrame([(n,) for n in given], "n string")
    got = df.select(names.wave_time(F.col("n")), names.sensor_id(F.col("n")), names.wave_code(F.col("n"))).collect()
    noon = datetime(2023, 1, 1, 12)
    assert [r[0] for r in got] == [noon, noon, noon, None, None]
    assert [r[1] for r in got] == [hexes[1], None, None, None, None]
    assert [r[2] for r in got] == ["VV", None, None, None, None]


def test_location_and_device_of_file(spark):
    df = spark.createDataFrame([("20250401(8#Belt Conveyer) Motor Drive End.csv",), ("(Tube Mill) Rating 2025.csv",), ("(Tube Mill)Ratings.csv",)], "n string")
    n = F.col("n")
    got = df.select(names.location_of(n), names.belongs_to(n, "8#Belt Conveyer"), names.is_rating_file(n)).collect()
    assert [tuple(r) for r in got] == [("Motor Drive End", True, False), ("Rating 2025", False, True), ("Ratings", False, False)]


def test_labels(spark):
    df = spark.createDataFrame([("rms_1_10khz",), ("tube_mill",), ("8#belt",)], "n string")
    got = df.select(names.label(F.col("n")), names.heading(F.col("n"))).collect()
    assert [tuple(r) for r in got] == [(s.replace("_", " ").title(), s.upper().replace("_", " ")) for s in ("rms_1_10khz", "tube_mill", "8#belt")]


def test_canonical_device(spark):
    df = spark.createDataFrame([("1#High-temperature Fan",), ("Tube Mill",), (None,)], "d string")
    assert [r[0] for r in df.select(names.canonical_device(F.col("d"))).collect()] == ["1#High-Temp Fan", "Tube Mill", None]


def test_map_location_keeps_unknown(spark):
    df = spark.createDataFrame([("67c29bab30e6dd385f031caa",), ("x",), (None,)], "sensor_id string")
    assert rows(ops.map_location(df, sensor_dimension(spark))) == sorted([("67c29bab30e6dd385f031caa", "Gear Reducer"), ("x", None), (None, None)], key=repr)


def test_vocabularies():
    assert not set(STATUS_RATINGS) & set(METRIC_RATINGS)
    assert len(SENSOR_LOCATIONS) == 12


def test_broadcast_only_when_small(spark):
    df = spark.range(10)
    big = spark.range(1000)
    def plan(small):
        return big.join(small, "id")._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" in plan(broadcast_if_small(df, 10))
    assert "strategy=broadcast" not in plan(broadcast_if_small(df, 9))
