from datetime import timedelta

import numpy as np
import pytest
from helpers import T0, at, rows
from pyspark.sql import functions as F

from tremora.config import MEASUREMENTS, METRIC_RATINGS, STATUS_RATINGS, VIBRATION, sensor_dimension
from tremora.plans import chain

SENSOR = "67c29bab30e6dd385f031caa"  # Gear Reducer
RATINGS = STATUS_RATINGS + METRIC_RATINGS


@pytest.fixture(scope="module")
def merged(spark):
    """Two hours of five-second readings at two locations, rated every 20 minutes."""
    readings, marks = [], []
    for i in range(0, 7200, 5):
        for j, loc in enumerate(("Gear Reducer", "Motor Drive End")):
            for k, m in enumerate(MEASUREMENTS):
                if m != "Temperature" or i % 60 == 0:
                    readings.append(("d", at(i), loc, m, float(np.sin(i / 50 + k) + j)))
    for i in range(0, 7201, 1200):
        marks += [("d", at(i), r, float(i // 2400 + n)) for n, r in enumerate(RATINGS)]
    return chain.merged_table(
        spark.createDataFrame(readings, "device string, datetime timestamp_ntz, location string, Measurement string, data double"),
        spark.createDataFrame(marks, "device string, datetime timestamp_ntz, Metric string, Rating double"), MEASUREMENTS, RATINGS)


def test_whole_chain(spark, merged):
    assert merged.count() == 2880
    assert merged.where(F.col("Temperature").isNull()).count() == 0
    summary = chain.bucket_table(merged, MEASUREMENTS, RATINGS)
    assert summary.groupBy("location").count().select("count").distinct().collect()[0][0] == len({(r.bucket_start) for r in summary.collect()})
    assert summary.agg(F.sum(f"`{VIBRATION}_count`")).first()[0] == 2880
    name = f"{{}}_{'0' * 24}_{SENSOR}_VV.json"
    waves = spark.createDataFrame(
        [("d", [0.0, 0.001, 0.002], [1.0, -1.0, 0.5], name.format(t)) for t in ("20250401 000010", "20250401 010000", "20250402 000000")],
        "device string, axisX array<double>, axisY array<float>, file_name string")
    features = chain.feature_table(waves, sensor_dimension(spark), summary)
    got = features.orderBy("timestamp").collect()
    assert [r.timestamp for r in got] == [at(10), at(3600)]
    assert all(r.location == "Gear Reducer" and r.bucket_start <= r.timestamp <= r.bucket_end for r in got)
    # a metric and the rating of the same name stand side by side
    assert got[0].velocity_rms == pytest.approx(np.sqrt(0.75)) and got[0].velocity_rms_rating is not None


def test_dashboard(spark, merged):
    short = chain.dashboard_selection(merged, "d", T0, T0 + timedelta(minutes=30), RATINGS + [VIBRATION], ["Gear Reducer"])
    assert short.count() == 361
    binned = chain.dashboard_selection(merged, "d", T0, T0 + timedelta(hours=2), RATINGS + [VIBRATION])
    assert binned.count() == 2 * 24
    views = chain.dashboard_views(binned, interval=300.0)
    assert rows(views["header"]) == [(T0, at(6900))]
    means = {r.rating: r["mean"] for r in views["status"].collect()}
    assert list(sorted(means)) == sorted(STATUS_RATINGS)
    want = binned.agg(F.avg("alignment_status")).first()[0]
    assert means["alignment_status"] == pytest.approx(want)
    assert views["metrics"].count() == len(METRIC_RATINGS)
    assert views["ratings"].count() == 48 * len(RATINGS)
    assert views["signal"].count() == 2 * (24 + 12 + 24 + 12)
    empty = chain.dashboard_views(binned.where("false"))
    assert empty["status"].count() == 0 and empty["signal"].count() == 0 and rows(empty["header"]) == [(None, None)]
    assert chain.dashboard_selection(merged, "d", None, None, [VIBRATION]).count() == 2880
