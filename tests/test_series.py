import random
from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from helpers import T0, at, rows
from pyspark.sql import functions as F

from tremora.operators import buckets, joins, reshape, timeseries
from tremora.plans import chain


def test_pivot_means_and_nulls(spark):
    df = spark.createDataFrame(
        [("d", at(0), "a", "t", 1.0), ("d", at(0), "a", "t", 3.0), ("d", at(0), "a", "v", None), ("d", at(5), "a", "t", None),
         ("d", None, "a", "t", 1.0), ("d", at(9), None, "t", 1.0)],
        "device string, datetime timestamp_ntz, location string, Measurement string, data double")
    assert rows(reshape.pivot_readings(df, ["t", "v"])) == [("d", at(0), "a", 2.0, None)]


def test_pivot_never_drops_a_name(spark):
    schema = "device string, datetime timestamp_ntz, location string, Measurement string, data double"
    df = spark.createDataFrame([("d", at(0), "a", "t", 1.0), ("d", at(9), "a", "other", 2.0)], schema)
    with pytest.raises(Exception, match="Measurement not listed: other"):
        reshape.pivot_readings(df, ["t"]).collect()
    with pytest.raises(Exception, match="Measurement not listed: other"):
        reshape.pivot_readings(df, ["t"]).select("device").count()
    found = reshape.pivot_readings(df)
    assert found.columns[3:] == ["other", "t"]
    assert rows(found) == [("d", at(0), "a", None, 1.0), ("d", at(9), "a", 2.0, None)]
    with pytest.raises(ValueError, match="over 1"):
        reshape.pivot_mean(df, ["device"], "Measurement", "data", most=1)


def test_pivot_is_one_shuffle(spark):
    df = spark.createDataFrame([("d", at(0), "a", "t", 1.0)], "device string, datetime timestamp_ntz, location string, Measurement string, data double")
    plan = reshape.pivot_readings(df, ["t", "v"])._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("HashAggregate") == 2


def test_forward_fill_across_slices(spark):
    day = 86400
    data = [("d", "a", at(0), None), ("d", "a", at(10), 1.0), ("d", "a", at(3 * day), None), ("d", "a", at(3 * day + 5), 2.0),
            ("d", "a", at(4 * day), None), ("d", "b", at(4 * day), None)]
    df = spark.createDataFrame(data, "device string, location string, datetime timestamp_ntz, v double")
    got = rows(timeseries.forward_fill(df, ["v"]), "location", "datetime")
    assert [r[3] for r in got] == [None, 1.0, 1.0, 2.0, 2.0, None]


def test_forward_fill_matches_pandas(spark):
    rng = random.Random(1)
    data = [("d", f"l{rng.randrange(3)}", at(i * 977), rng.random() if rng.random() < 0.2 else None) for i in range(600)]
    df = spark.createDataFrame(data, "device string, location string, datetime timestamp_ntz, v double")
    pdf = pd.DataFrame(data, columns=["device", "location", "datetime", "v"])
    pdf["v"] = pdf.groupby("location")["v"].ffill()
    got = timeseries.forward_fill(df, ["v"], slice_seconds=3600).toPandas().sort_values("datetime")
    np.testing.assert_array_equal(got["v"].to_numpy(float), pdf["v"].to_numpy(float))


@pytest.mark.parametrize("few", [300_000, 0])
def test_asof_edges(spark, few):
    left = spark.createDataFrame([("d", at(s)) for s in (0, 10, 11, 7000, 20000, 30000)] + [("x", at(0)), (None, at(0))], "device string, datetime timestamp_ntz")
    right = spark.createDataFrame([("d", at(10), "b", 1.0), ("d", at(10), "a", 2.0), ("d", at(20000), "a", 3.0)], "device string, datetime timestamp_ntz, who string, r double")
    got = {(r[0], r[1]): r[3] for r in rows(joins.asof_join(left, right, tie_break="who", broadcast_rows=few))}
    assert [got["d", at(s)] for s in (0, 10, 11, 7000, 20000, 30000)] == [2.0, 2.0, 3.0, 3.0, 3.0, None]
    assert got["x", at(0)] is None and got[None, at(0)] is None
    back = {(r[0], r[1]): r[3] for r in rows(joins.asof_join(left, right, tie_break="who", direction="backward", broadcast_rows=few))}
    assert [back["d", at(s)] for s in (0, 10, 11, 7000, 20000, 30000)] == [None, 2.0, 2.0, 2.0, 3.0, 3.0]
    assert joins.asof_join(left, right.where("false")).where("r is not null").count() == 0
    with pytest.raises(ValueError):
        joins.asof_join(left, right, direction="nearest")


@pytest.mark.parametrize("few", [300_000, 0])
@pytest.mark.parametrize("direction", ["forward", "backward"])
def test_asof_matches_pandas(spark, direction, few):
    rng = random.Random(2)
    l = sorted({rng.randrange(40 * 86400) for _ in range(400)})
    r = sorted({rng.randrange(5 * 86400, 30 * 86400) for _ in range(60)})
    left = spark.createDataFrame([("d", at(s)) for s in l], "device string, datetime timestamp_ntz")
    right = spark.createDataFrame([("d", at(s), float(s)) for s in r], "device string, datetime timestamp_ntz, v double")
    want = pd.merge_asof(pd.DataFrame({"t": l}), pd.DataFrame({"t": r, "v": [float(s) for s in r]}), on="t", direction=direction)["v"]
    got = joins.asof_join(left, right, direction=direction, broadcast_rows=few).orderBy("datetime").toPandas()["v"]
    np.testing.assert_array_equal(got.to_numpy(float), want.to_numpy(float))


def test_asof_over_silent_years(spark):
    """Ratings ten years apart, more hours than may be broadcast; rows without time or device meet none."""
    years = 10 * 365 * 86400
    left = spark.createDataFrame([("d", at(s)) for s in (5, years // 2, years + 5)] + [("d", None), (None, at(3)), ("e", at(0))], "device string, datetime timestamp_ntz")
    right = spark.createDataFrame([("d", at(0), 1.0), ("d", at(years), 2.0), (None, at(4), 9.0), ("d", None, 9.0)], "device string, datetime timestamp_ntz, v double")
    got = rows(joins.asof_join(left, right, direction="backward", broadcast_rows=1000))
    assert got == sorted([("d", at(5), 1.0), ("d", at(years // 2), 1.0), ("d", at(years + 5), 2.0), ("d", None, None), (None, at(3), None), ("e", at(0), None)], key=repr)
    assert [r[2] for r in rows(joins.asof_join(left, right, broadcast_rows=1000).where("device = 'd' and datetime is not null"), "datetime")] == [2.0, 2.0, None]


def test_asof_is_an_equi_join(spark):
    left = spark.createDataFrame([(d, at(s)) for d in "de" for s in (0, 20)], "device string, datetime timestamp_ntz")
    right = spark.createDataFrame([(d, at(10), 1.0) for d in "de"], "device string, datetime timestamp_ntz, r double")
    plan = joins.asof_join(left, right)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_interval_join_edges(spark):
    buckets_ = spark.createDataFrame([("d", "a", at(0), at(1500), 1), ("d", "a", at(1600), at(1600), 2), ("d", "b", at(0), at(90000), 3)],
                                     "device string, location string, bucket_start timestamp_ntz, bucket_end timestamp_ntz, b int")
    points = spark.createDataFrame([("d", "a", at(s)) for s in (-1, 0, 1500, 1550, 1600)] + [("d", "b", at(80000)), ("d", None, at(0)), ("d", "c", at(0))],
                                   "device string, location string, timestamp timestamp_ntz")
    want = [("a", at(0), 1), ("a", at(1500), 1), ("a", at(1600), 2), ("b", at(80000), 3)]
    for width in (7, 1200, 100000):
        got = joins.interval_join(points, buckets_, bin_seconds=width).select("location", "timestamp", "b")
        assert rows(got, "location", "timestamp") == want


def greedy(data, minutes, null_breaks=False):
    """Plain loop over one location: bucket number and start per row."""
    out, number, start, rating = [], 0, None, None
    for t, r in data:
        changed = r != rating or (null_breaks and None in r)
        if start is None or changed or t - start >= timedelta(minutes=minutes):
            number, start, rating = number + 1, t, r
        out.append((t, number, start))
    return out


def frame(spark, data):
    return spark.createDataFrame([("d", l, t, *r) for l, t, r in data], "device string, location string, datetime timestamp_ntz, p double, q double")


def check(spark, data, minutes, slice_seconds=86400, null_breaks=False):
    got = buckets.assign_buckets(frame(spark, data), ["p", "q"], minutes, null_breaks=null_breaks, slice_seconds=slice_seconds)
    for loc in {l for l, _, _ in data}:
        want = greedy(sorted((t, r) for l, t, r in data if l == loc), minutes, null_breaks)
        have = [tuple(r) for r in got.where(F.col("location") == loc).orderBy("datetime").select("datetime", "bucket_id", "bucket_start").collect()]
        assert have == want


def test_buckets_small_cases(spark):
    c = (1.0, 1.0)
    check(spark, [("a", at(0), c)], 20)
    # exactly N minutes opens; a long gap re-anchors at the next row; a change opens at once
    check(spark, [("a", at(0), c), ("a", at(1199), c), ("a", at(1200), c), ("a", at(90000), c), ("a", at(90001), (2.0, 1.0)), ("a", at(90002), c)], 20)


def key(r):
    return tuple((x is None, x or 0) for x in r)


@pytest.mark.parametrize("seed,minutes,slice_seconds,change", [
    (1, 20, 86400, 0.0), (2, 20, 3600, 0.02), (3, 7, 900, 0.2), (4, 120, 1800, 0.01), (5, 50, 600, 0.0),
])
def test_buckets_match_loop(spark, seed, minutes, slice_seconds, change):
    rng = random.Random(seed)
    data = []
    for loc in "ab":
        t, r = 0, (1.0, 1.0)
        for _ in range(700):
            t += rng.choice([5, 5, 5, 60, 400, rng.randrange(1, 9000)])
            if rng.random() < change:
                r = (float(rng.randrange(3)), 1.0)
            data.append((loc, at(t), r))
    check(spark, data, minutes, slice_seconds)


def test_bucket_nulls(spark):
    data = [("a", at(s), r) for s, r in ((0, (None, 1.0)), (5, (None, 1.0)), (10, (1.0, 1.0)), (90000, (None, 1.0)))]
    df = frame(spark, data).unionByName(frame(spark, [(None, at(0), (1.0, 1.0))]))
    def ids(**kw):
        return [r.bucket_id for r in buckets.assign_buckets(df, ["p", "q"], 20, **kw).orderBy("datetime").collect()]
    assert ids() == [1, 1, 2, 3]
    assert ids(null_breaks=True) == [1, 2, 3, 4]


def test_bucket_table(spark):
    df = frame(spark, [("a", at(s), (5.0, None)) for s in (0, 5, 10)]).withColumn("m", F.when(F.col("datetime") > at(0), F.second("datetime").cast("double")))
    got = chain.bucket_table(df, ["m"], ["p", "q"]).collect()
    assert len(got) == 1
    r = got[0]
    assert (r.m_count, r.m_mean, r.m_min, r.m_max) == (2, 7.5, 5.0, 10.0)
    assert r.m_std == pytest.approx(np.std([5, 10], ddof=1))
    assert (r.p_rating, r.q_rating, r.bucket_start, r.bucket_end) == (5.0, None, at(0), at(10))
    one = chain.bucket_table(df.where(F.col("datetime") == at(5)), ["m"], ["p", "q"]).first()
    assert one.m_std is None
    assert chain.bucket_table(df.where("false"), ["m"], ["p", "q"]).count() == 0


def test_resample_rules():
    for span, rule in ((timedelta(hours=1), None), (timedelta(hours=1, seconds=1), "5 minutes"), (timedelta(days=1), "5 minutes"), (timedelta(days=1, seconds=1), "15 minutes")):
        assert timeseries.resample_rule(T0, T0 + span) == rule


def test_resample_matches_pandas(spark):
    rng = random.Random(3)
    data = [(f"l{rng.randrange(2)}", "d", at(rng.randrange(20 * 3600)), rng.random()) for _ in range(80)]
    df = spark.createDataFrame(data, "location string, device string, datetime timestamp_ntz, v double")
    pdf = pd.DataFrame(data, columns=["location", "device", "datetime", "v"])
    want = pdf.set_index("datetime").groupby(["location", "device"]).resample("5min").mean(numeric_only=True).reset_index()
    got = timeseries.resample_adaptive(df, T0, T0 + timedelta(hours=21), ["v"], gaps=True).orderBy("location", "datetime").toPandas()
    assert list(got["datetime"]) == list(want["datetime"])
    np.testing.assert_allclose(got["v"].to_numpy(float), want["v"].to_numpy(float))
    raw = timeseries.resample_adaptive(df, T0, T0 + timedelta(hours=1), ["v"])
    assert raw.count() == sum(d[2] <= T0 + timedelta(hours=1) for d in data)


def test_sequences(spark):
    data = [("d", "a", at(0), at(2), 1.0, None), ("d", "a", at(0), at(3), 3.0, 5.0), ("d", "a", at(0), at(11), None, 7.0)]
    df = spark.createDataFrame(data, "device string, location string, bucket_start timestamp_ntz, datetime timestamp_ntz, x double, y double")
    r = timeseries.sequence_windows(df, ["x", "y"], steps=6, step_seconds=5).first()
    assert r.n_steps == 3
    assert [tuple(s) for s in r.sequence] == [(2.0, 5.0), (2.0, 5.0), (2.0, 7.0), (0.0, 0.0), (0.0, 0.0), (0.0, 0.0)]
    late = df.where(F.col("datetime") == at(11))
    assert [s.y for s in timeseries.sequence_windows(late, ["x", "y"], steps=4, step_seconds=5).first().sequence] == [0.0, 0.0, 7.0, 0.0]


def test_sequences_refuse_what_does_not_fit(spark):
    schema = "device string, location string, bucket_start timestamp_ntz, datetime timestamp_ntz, x double"
    for when in (at(30), at(-1)):
        df = spark.createDataFrame([("d", "a", at(0), at(2), 1.0), ("d", "a", at(0), when, 9.0)], schema)
        with pytest.raises(Exception, match="outside the 6 steps"):
            timeseries.sequence_windows(df, ["x"], steps=6, step_seconds=5).collect()
    assert timeseries.sequence_windows(df.where("x = 1"), ["x"], steps=6, step_seconds=5).count() == 1


def test_overlay_skips_unknown(spark):
    df = spark.createDataFrame([("a", at(5), 1.0), ("a", at(0), 2.0)], "location string, datetime timestamp_ntz, v double")
    got = [tuple(r) for r in timeseries.overlay_series(df, ["v", "nope"]).select("series", "location", "datetime", "value").collect()]
    assert got == [("v", "a", at(0), 2.0), ("v", "a", at(5), 1.0)]


def test_merged_table_matches_pandas(spark):
    rng = random.Random(5)
    readings = [("d", f"l{rng.randrange(2)}", at(60 * rng.randrange(600)), m, rng.random()) for m in ("t", "v") for _ in range(200)]
    marks = [("d", at(1200 * (i + 3)), "p", float(rng.randrange(5))) for i in range(20)]
    r = pd.DataFrame(readings, columns=["device", "location", "datetime", "Measurement", "data"])
    m = pd.DataFrame(marks, columns=["device", "datetime", "Metric", "Rating"])
    wide = r.pivot_table(index=["datetime", "location"], columns="Measurement", values="data").reset_index()
    rated = m.pivot_table(index=["datetime", "device"], columns="Metric", values="Rating").reset_index()
    wide["t"] = wide.groupby("location")["t"].ffill()
    lo, hi = max(wide.datetime.min(), rated.datetime.min()), min(wide.datetime.max(), rated.datetime.max())
    wide, rated = (x[(x.datetime >= lo) & (x.datetime <= hi)].sort_values("datetime") for x in (wide, rated))
    want = pd.merge_asof(wide, rated, on="datetime", direction="forward").sort_values(["datetime", "location"])
    got = chain.merged_table(
        spark.createDataFrame(readings, "device string, location string, datetime timestamp_ntz, Measurement string, data double"),
        spark.createDataFrame(marks, "device string, datetime timestamp_ntz, Metric string, Rating double"), ["t", "v"], ["p"], fill=["t"],
    ).orderBy("datetime", "location").toPandas()
    assert list(got["datetime"]) == list(want["datetime"]) and list(got["location"]) == list(want["location"])
    for c in ("t", "v", "p"):
        np.testing.assert_allclose(got[c].to_numpy(float), want[c].to_numpy(float))
