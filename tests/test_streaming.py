import random
from datetime import timedelta

import numpy as np
import pytest
from helpers import at, rows
from pyspark.sql import functions as F

from tremora.operators import buckets, timeseries
from tremora.session import settings
from tremora.sources import waveforms
from tremora.streaming import identities, jobs, levels, live
from workload import queries

SCHEMA = "device string, location string, datetime timestamp_ntz, v double, p double"


def batches(spark, path, parts):
    for i, part in enumerate(parts):
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def readings(seed, n=400, locations="ab"):
    rng = random.Random(seed)
    out = []
    for loc in locations:
        t, p = 0, 1.0
        for _ in range(n):
            t += rng.choice([5, 5, 60, 700])
            p = float(rng.randrange(3)) if rng.random() < 0.05 else p
            out.append(("d", loc, at(t), None if rng.random() < 0.1 else rng.random(), p))
    return sorted(out, key=lambda r: r[2])


def stream(spark, path, **kw):
    return jobs.file_stream(spark, path, spark.read.parquet(path).schema, **kw)


@pytest.mark.parametrize("files,shuffle", [(1, False), (4, True)])
def test_buckets_equal_batch(spark, tmp_path, files, shuffle):
    data = readings(1)
    path = str(tmp_path / "in")
    size = len(data) // files
    parts = [data[i * size:(i + 1) * size if i < files - 1 else None] for i in range(files)]
    if shuffle:
        # rows arrive out of order by less than the watermark delay
        rng = random.Random(2)
        order = sorted(data, key=lambda r: r[2] + timedelta(seconds=rng.randrange(1800)))
        parts = [order[i * size:(i + 1) * size if i < files - 1 else None] for i in range(files)]
    batches(spark, path, parts)
    closed = jobs.buckets_available(stream(spark, path, files_per_trigger=1), ["v"], ["p"], 20)
    batch = spark.createDataFrame(data, SCHEMA)
    marked = buckets.assign_buckets(batch, ["p"], 20)
    want = buckets.summarise_buckets(marked.drop("bucket_start"), ["v"], ["p"]).drop("bucket_id").toPandas()
    want = want.sort_values(["location", "bucket_start"]).reset_index(drop=True)
    got = closed.toPandas()
    got = got.sort_values(["location", "bucket_start"]).reset_index(drop=True)
    assert len(got) == len(want) > 50
    for c in ("location", "bucket_start", "bucket_end", "v_count"):
        assert list(got[c]) == list(want[c])
    for c in ("v_mean", "v_std", "v_min", "v_max", "p"):
        np.testing.assert_allclose(got[c].to_numpy(float), want[c].to_numpy(float), rtol=1e-9)


def test_open_buckets_go_on_in_the_next_run(spark, tmp_path):
    """One location with nearly all rows, files out of order, and a run after each of them."""
    data = readings(7, 300, "a") + readings(8, 5, "b")
    rng = random.Random(2)
    order = sorted(data, key=lambda r: r[2] + timedelta(seconds=rng.randrange(1800)))
    path, sink, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    want = buckets.summarise_buckets(buckets.assign_buckets(spark.createDataFrame(data, SCHEMA), ["p"], 20).drop("bucket_start"), ["v"], ["p"])
    for part in (order[:150], order[150:151], order[151:]):
        batches(spark, path, [part])
        got = jobs.buckets_available(stream(spark, path), ["v"], ["p"], 20, sink=sink, checkpoint=state)
    names = ["location", "bucket_start", "bucket_end", "v_count", "p"]
    assert rows(got.select(*names)) == rows(want.select(*names))
    closed = jobs.buckets_available(stream(spark, path), ["v"], ["p"], 20, sink=sink, checkpoint=state, finish=False)
    assert 0 < closed.count() < got.count()
    again = jobs.buckets_available(stream(spark, path), ["v"], ["p"], 20, sink=sink, checkpoint=state)
    assert rows(again.select(*names)) == rows(want.select(*names))


def test_resample_equals_batch(spark, tmp_path):
    data = readings(3)
    path = str(tmp_path / "in")
    half = len(data) // 2
    batches(spark, path, [data[:half], data[half:]])
    got = levels.resample_available(stream(spark, path, files_per_trigger=1), "15 minutes", ["v"])
    want = timeseries.resample(spark.createDataFrame(data, SCHEMA), "15 minutes", ["v"]).toPandas()
    want = want.sort_values(["location", "datetime"])
    have = got.withColumn("datetime", F.col("datetime").cast("timestamp_ntz")).toPandas().sort_values(["location", "datetime"])
    assert list(have["datetime"]) == list(want["datetime"])
    np.testing.assert_allclose(have["v"].to_numpy(float), want["v"].to_numpy(float))


def test_dedup_drops_a_file_sent_again(spark, tmp_path):
    data = readings(4, 50)
    path = str(tmp_path / "in")
    batches(spark, path, [data, data])
    kept = jobs.run_available(jobs.dedup_stream(stream(spark, path), ["device", "location", "datetime"]), "dedup")
    assert kept.count() == len(data)


def test_ingest_reads_each_file_once(spark, tmp_path):
    data = readings(5, 50)
    path, sink, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    batches(spark, path, [data[:60]])
    jobs.run_available(jobs.ingest(stream(spark, path)), "ingest", sink, state)
    batches(spark, path, [data[60:]])
    table = jobs.run_available(jobs.ingest(stream(spark, path)), "ingest", sink, state)
    assert rows(jobs.refresh_times(table).select("device", "n_rows", "last_reading")) == [("d", 100, max(r[2] for r in data))]
    assert table.select("ingest_time").distinct().count() == 2


def test_files_in_reverse_time_order_lose_nothing(spark, tmp_path):
    """Many small batches from the latest to the earliest, and one more run with a file older than all."""
    data = readings(11)
    size = len(data) // 6
    parts = [data[i * size:(i + 1) * size if i < 5 else None] for i in range(6)][::-1]
    batch = spark.createDataFrame(data, SCHEMA)
    names = ["location", "bucket_start", "bucket_end", "v_count", "p"]
    want = {
        "buckets": rows(buckets.summarise_buckets(buckets.assign_buckets(batch, ["p"], 20).drop("bucket_start"), ["v"], ["p"]).select(*names)),
        "resample": rows(timeseries.resample(batch, "15 minutes", ["v"]).selectExpr("location", "datetime", "round(v, 9)")),
    }
    identity = ["device", "location", "datetime", "v", "p"]
    want["dedup"] = rows(batch.dropDuplicates(identity))
    runs = {
        "buckets": lambda s, **kw: jobs.buckets_available(s, ["v"], ["p"], 20, **kw).select(*names),
        "resample": lambda s, **kw: levels.resample_available(s, "15 minutes", ["v"], **kw).selectExpr(
            "location", "cast(datetime as timestamp_ntz) datetime", "round(v, 9)"),
        "dedup": lambda s, **kw: identities.dedup_available(s, identity, **kw),
    }
    path = str(tmp_path / "in")
    where = {k: {n: str(tmp_path / k / n) for n in ("sink", "checkpoint")} for k in runs}
    for now in (parts[:-1], parts[-1:]):
        for part in now:  # files are read by the time they were written
            batches(spark, path, [part])
        got = {k: rows(run(stream(spark, path, files_per_trigger=1), **where[k])) for k, run in runs.items()}
    assert got == want
    batches(spark, path, [parts[0]])
    assert rows(runs["dedup"](stream(spark, path, files_per_trigger=1), **where["dedup"])) == want["dedup"]


def summary_of(spark, data):
    marked = buckets.assign_buckets(spark.createDataFrame(data, SCHEMA), ["p"], 20).drop("bucket_start")
    return rows(buckets.summarise_buckets(marked, ["v"], ["p"]).select(*NAMES))


NAMES = ["location", "bucket_start", "bucket_end", "v_count", "p"]


def test_live_buckets_equal_batch_over_restarts(spark, tmp_path):
    """Files out of order within the delay, a run after each few of them, and nulls."""
    data = readings(21, 200, "a") + readings(22, 60, "b")
    data = [(d, loc, t, v, None if i % 40 == 3 else p) for i, (d, loc, t, v, p) in enumerate(data)]
    rng = random.Random(2)
    order = sorted(data, key=lambda r: r[2] + timedelta(seconds=rng.randrange(1800)))
    path, sink, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    held = []
    for part in (order[:90], order[90:170], order[170:]):
        batches(spark, path, [part[: len(part) // 2], part[len(part) // 2 :]])
        got = live.buckets_live(stream(spark, path, files_per_trigger=1), ["v"], ["p"], 20, sink=sink, checkpoint=state)
        schema = spark.createDataFrame([], "device string, location string, live_micros long, v double, p double").schema
        held.append(live.open_rows(spark, state, schema).count())
        assert rows(got.select(*NAMES)) == summary_of(spark, [r for r in order[: order.index(part[-1]) + 1]])
    closed = live.buckets_live(stream(spark, path, files_per_trigger=1), ["v"], ["p"], 20, sink=sink, checkpoint=state, finish=False)
    assert 0 < closed.count() < got.count()
    assert max(held) < len(data) // 2  # open slices only, whatever has passed


def test_live_buckets_do_not_lose_late_rows_in_silence(spark, tmp_path):
    data = readings(23, 100, "a")
    path, sink, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    run = lambda **kw: live.buckets_live(stream(spark, path), ["v"], ["p"], 20, sink=sink, checkpoint=state, **kw)
    batches(spark, path, [data[20:]])
    run()
    batches(spark, path, [data[:20]])
    with pytest.raises(ValueError, match="20 rows came later"):
        run()
    assert rows(run(late="drop").select(*NAMES)) == summary_of(spark, data[20:])


def test_bins_are_merged_in_levels(spark, tmp_path, monkeypatch):
    """What runs write follows their rows: each sum is written once a level. Readers always meet whole tables."""
    monkeypatch.setattr(levels, "FAN", 3)
    data = readings(24, 100, "a")
    path, sink, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    written, before = 0, None
    for i in range(10):
        batches(spark, path, [data[10 * i : 10 * i + 10]])
        got = levels.resample_available(stream(spark, path), "15 minutes", ["v"], sink=sink, checkpoint=state)
        names = {n for n, _, _ in levels.current_parts(spark, sink)}
        assert sum(n.startswith("0-") for n in names) < 3
        if before is not None:  # a reader that took the list before this run still finds its parts
            assert before.count() > 0
        before = levels.read_bins(spark, sink, ["v"])
        written += sum(many for n, level, many in levels.current_parts(spark, sink) if n.endswith(f"-{i}"))
    want = timeseries.resample(spark.createDataFrame(data, SCHEMA), "15 minutes", ["v"])
    assert rows(got.selectExpr("location", "cast(datetime as timestamp_ntz) datetime", "round(v, 9)")) == rows(want.selectExpr("location", "datetime", "round(v, 9)"))
    bins = want.count()
    assert written < 4 * (bins + 10)  # ten runs that sum all anew would write five times as many


def test_repeats_are_looked_for_in_few_buckets(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(identities, "FIRST", 16)  # filters fill up and are followed by larger ones
    looked = []
    plain = identities.bucket_rows
    monkeypatch.setattr(identities, "bucket_rows", lambda spark, sink, schema, upto, buckets=None: looked.append(buckets) or plain(spark, sink, schema, upto, buckets))
    data = readings(25, 150, "ab")
    identity = ["device", "location", "datetime"]
    path, sink, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    run = lambda: identities.dedup_available(stream(spark, path), identity, sink=sink, checkpoint=state)
    batches(spark, path, [data[:200]])
    assert run().count() == 200
    batches(spark, path, [data[200:230] + data[5:7]])
    looked.clear()
    assert run().count() == 230
    opened = [b for b in looked if b is not None]
    assert len(opened) == 1 and 1 <= len(opened[0]) <= 8  # of 64; two rows came again
    batches(spark, path, [data[230:], data[230:]])
    assert rows(run().select("location", "datetime")) == rows(spark.createDataFrame(data, SCHEMA).select("location", "datetime"))
    looked.clear()
    assert run().count() == len(data) and looked == [None]  # nothing new: only the result is read


def test_a_filter_that_knows_everything_loses_no_row(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(identities, "_knows", lambda bits, h1, h2: np.ones(len(h1), bool))
    data = [(None if i % 7 == 0 else "d", "a", r[2], r[3], r[4]) for i, r in enumerate(readings(26, 80, "a"))]
    path, sink, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    for part in (data[:50], data[30:]):
        batches(spark, path, [part])
        got = identities.dedup_available(stream(spark, path), ["device", "datetime"], sink=sink, checkpoint=state, buckets=4)
    assert rows(got.select("device", "datetime")) == rows(spark.createDataFrame(data, SCHEMA).select("device", "datetime"))


def test_a_run_of_several_batches_is_one_run(spark, tmp_path, monkeypatch):
    real = queries.recordings.waveform_binary_stream
    monkeypatch.setattr(queries.recordings, "waveform_binary_stream", lambda spark, path: real(spark, path, 4))
    spark.createDataFrame([(i, [1.0, 2.0]) for i in range(24)], "vec_id long, embedding array<float>").write.parquet(str(tmp_path / "embeddings.parquet"))
    got = queries.stream_waveforms(spark, str(tmp_path))
    assert rows(got.select("vec_id", "run"), "vec_id") == [(i, 1 + i % 2) for i in range(24) if i % 10]


def test_many_small_recordings_take_few_batches_and_tasks(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for i in range(600):
        (tmp_path / "in" / f"dev_{i}_20240101_000000.Single").write_bytes(np.array([50.0, *range(1 + i % 3)], "<f4").tobytes())
    held = ("spark.sql.sources.parallelPartitionDiscovery.parallelism", "spark.sql.files.openCostInBytes",
            "spark.sql.hive.filesourcePartitionFileCacheSize", "spark.sql.sources.ignoreDataLocality")
    before = {k: spark.conf.get(k) for k in held}
    arrived = jobs.ingest(waveforms.waveform_binary_stream(spark, str(tmp_path / "in")))
    table = jobs.run_available(arrived.select("filepath", F.size("axisY").alias("n"), "ingest_time"), "waves")
    assert sorted(r.n for r in table.collect()) == sorted(1 + i % 3 for i in range(600))
    assert table.select("ingest_time").distinct().count() == 1
    assert len(table.inputFiles()) <= spark.sparkContext.defaultParallelism + 1
    assert {k: spark.conf.get(k) for k in held} == before


def test_smaller_settings_of_the_session_stay(spark):
    with settings(spark, **{jobs.LISTING: "3", jobs.OPEN_COST: "1k"}):
        assert jobs._many_files(spark) == {jobs.LISTING: "3", jobs.OPEN_COST: "1024", jobs.LISTED: "0"}
    assert jobs._many_files(spark) == {jobs.LISTING: str(4 * spark.sparkContext.defaultParallelism), jobs.OPEN_COST: "65536", jobs.LISTED: "0"}
