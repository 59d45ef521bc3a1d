import os

import pytest
from helpers import at, rows
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tremora.operators import rows as ops
from tremora.session import scratch_root
from tremora.sources import files, readings, stages, waveforms


@pytest.fixture
def raw(tmp_path):
    head = "id,Date,Time,Measurement,data\n"
    files = {
        "2025 (8#Belt Conveyer) Motor + Drive End.csv": head + "1,2025-04-01,00:00:00,Temperature,1.5\n2,2025-04-01,bad,Temperature,\n",
        "2025 (8#Belt Conveyer) Gear Reducer.csv": head + "3,2025-04-01,00:00:05,Temperature,2.5\n",
        "2025 (8#Belt Conveyer) Rating.csv": "Date,Time,Device,Metric,Rating\n2025-04-01,00:20:00,8#Belt Conveyer,velocity_rms,80\n",
        "2025 (Tube Mill) Feed.csv": head + "4,2025-04-01,00:00:05,Temperature,9\n",
    }
    for name, text in files.items():
        (tmp_path / name).write_text(text)
    return str(tmp_path)


def test_route_files(spark, raw):
    r, marks = readings.route_files(spark, raw, "8#Belt Conveyer")
    assert rows(r.select("id", "location", "device"), "id") == [
        (1, "Motor + Drive End", "8#Belt Conveyer"), (2, "Motor + Drive End", "8#Belt Conveyer"), (3, "Gear Reducer", "8#Belt Conveyer")]
    assert rows(marks) == [("2025-04-01", "00:20:00", "8#Belt Conveyer", "velocity_rms", 80.0)]
    with pytest.raises(FileNotFoundError, match="rating files"):
        readings.route_files(spark, raw, "Tube Mill")
    with pytest.raises(FileNotFoundError, match="no files"):
        readings.route_files(spark, raw, "Belt Conveyer")


def test_columns_go_by_name(spark, tmp_path):
    (tmp_path / "a (d) One.csv").write_text("id,Date,Time,Measurement,data\n1,2025-04-01,00:00:00,Temperature,1.5\n")
    (tmp_path / "b (d) Two [x].csv").write_text("data,Measurement,extra,Time,id\n2.5,Temperature,z,00:00:05,2\n")
    (tmp_path / "c (d) Rating March.csv").write_text("Rating,Metric,Device,Time,Date\n80,velocity_rms,d,00:20:00,2025-04-01\n")
    got = readings.read_readings(spark, str(tmp_path), "d").select("id", "Date", "Time", "Measurement", "data", "location")
    assert rows(got, "id") == [(1, "2025-04-01", "00:00:00", "Temperature", 1.5, "One"), (2, None, "00:00:05", "Temperature", 2.5, "Two [x]")]
    _, marks = readings.route_files(spark, str(tmp_path), "d")
    assert rows(marks) == [("2025-04-01", "00:20:00", "d", "velocity_rms", 80.0)]


def test_files_without_rows_are_there(spark, tmp_path):
    (tmp_path / "a (d) One.csv").write_text("id,Date,Time,Measurement,data\n")
    with pytest.raises(FileNotFoundError, match="no rating files"):
        readings.route_files(spark, str(tmp_path), "d")
    (tmp_path / "b (d) Rating.csv").write_text("Date,Time,Device,Metric,Rating\n")
    r, marks = readings.route_files(spark, str(tmp_path), "d")
    assert r.count() == marks.count() == 0
    (tmp_path / "c (e) Rating.csv").write_text("Date,Time,Device,Metric,Rating\n2025-04-01,00:20:00,e,m,1\n")
    with pytest.raises(FileNotFoundError, match="no reading files"):
        readings.route_files(spark, str(tmp_path), "e")


def test_a_stream_refuses_columns_out_of_order(spark, tmp_path):
    from pyspark.sql.types import StructType

    from tremora.streaming import jobs

    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("b,a\n1,x\n")
    stream = jobs.file_stream(spark, str(tmp_path / "in"), StructType.fromDDL("a string, b int"), "csv")
    with pytest.raises(StreamingQueryException):
        jobs.run_available(stream, "refused", str(tmp_path / "out"), str(tmp_path / "state"))


def test_device_is_looked_for_below_the_base(spark, tmp_path):
    base = tmp_path / "Fan data"
    for folder in ("20230101#Belt Conveyer", "20230102#Fan/deep", "20230103#Fan"):
        (base / folder).mkdir(parents=True)
        (base / folder / "20230101 120000_x_VV.json").write_text('{"axisX": [0, 1], "axisY": [1, 2]}')
    got = waveforms.scan_waveform_json(spark, str(base), "Fan")
    assert sorted(r.filepath.split("/Fan data/")[1].split("/")[0] for r in got.collect()) == ["20230102#Fan", "20230103#Fan"]
    assert waveforms.scan_waveform_json(spark, str(tmp_path / "F*a"), "data").count() == 0
    assert waveforms.scan_waveform_json(spark, str(base), "Belt").count() == 1


def test_read_and_clean(spark, raw):
    got = readings.clean_readings(readings.read_readings(spark, raw, "8#Belt Conveyer"))
    assert rows(got.select("datetime", "data", "location"), "data") == [(None, None, "Motor + Drive End"), (at(0), 1.5, "Motor + Drive End"), (at(5), 2.5, "Gear Reducer")]
    everything = readings.read_readings(spark, raw)
    assert {r.device for r in everything.select("device").distinct().collect()} == {"8#Belt Conveyer", "Tube Mill"}


def test_write_stage_replaces_only_its_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    both = spark.createDataFrame([("a", 1), ("b", 2)], "device string, v int")
    stages.write_stage(both, path)
    stages.write_stage(both.where("device = 'a'").withColumn("v", F.lit(9)), path)
    assert rows(spark.read.parquet(path).select("device", "v"), "device") == [("a", 9), ("b", 2)]


def test_day_partitions_prune(spark, tmp_path):
    df = spark.createDataFrame([("a", at(0)), ("a", at(90000))], "device string, datetime timestamp_ntz")
    table = stages.write_day_partitions(df, str(tmp_path / "t"))
    chosen = ops.filter_range(table, at(0), at(5), date="date")
    assert chosen.count() == 1
    plan = chosen._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan and "PartitionFilters: []" not in plan
    assert sorted(os.listdir(tmp_path / "t" / "device=a"))[:2] == ["date=2025-04-01", "date=2025-04-02"]


def test_read_stage_csv(spark, tmp_path):
    (tmp_path / "m.csv").write_text("Unnamed: 0,datetime,location,v\n0,2025-04-01 00:00:00,a,1.5\n1,2025-04-01 00:00:05,b,\n")
    df = readings.read_stage(spark, str(tmp_path), "`Unnamed: 0` int, datetime timestamp_ntz, location string, v double", time_to="timestamp")
    assert df.columns == ["timestamp", "location", "v"]
    assert rows(df, "timestamp") == [(at(0), "a", 1.5), (at(5), "b", None)]


def test_scratch_has_an_owner_and_an_end(spark, tmp_path):
    from tremora import session

    kept = session.materialise(spark.range(3), "kept")
    assert kept.count() == 3 and spark.sparkContext.applicationId in kept.inputFiles()[0]
    folder = kept.inputFiles()[0].removeprefix("file:").split("/kept-")[0].replace("///", "/")
    assert os.path.isdir(folder)
    session.drop_scratch(spark)
    assert not os.path.isdir(folder)
    assert session.materialise(spark.range(2), "again").count() == 2


def test_scratch_root_follows_the_session(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert scratch_root(spark) == (named or spark.sparkContext.getCheckpointDir()).rstrip("/")


def test_rows_of_a_cut_file_are_read_once(spark, tmp_path):
    """Parts of any size, quoted and missing values, long and short rows, line ends of either kind, no last line end."""
    lines = [f'{i},"a ""b"" {i}",' + ("" if i % 3 else str(i / 2)) for i in range(300)]
    lines[7], lines[8] = "7", "8,x,4.0,too,many"
    (tmp_path / "x (d) One.csv").write_text("id,Measurement,data\n" + "\n".join(lines))
    (tmp_path / "y (d) Two.csv").write_bytes(b"\xef\xbb\xbfdata,id\r\n1.5,900\r\n2.5,901\r\n")
    (tmp_path / "z (d) Three.csv").write_text("id,data")
    (tmp_path / "empty (d) Four.csv").write_text("")
    want = None
    for size in (1 << 20, 4000, 97, 1):
        got = rows(readings.read_readings(spark, str(tmp_path), "d", part_bytes=size).select("id", "Measurement", "data", "location"))
        want = want or got
        assert got == want and len(got) == 302
    by_id = {r[0]: r for r in want}
    assert by_id[3] == (3, 'a "b" 3', 1.5, "One") and by_id[4][2] is None and by_id[7] == (7, None, None, "One") and by_id[8] == (8, "x", 4.0, "One")
    assert by_id[901] == (901, None, 2.5, "Two")


def test_many_small_files_are_one_job(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(files, "PART_FILES", 100)
    for i in range(450):
        (tmp_path / f"{i} (d) One.csv").write_text(f"id,data\n{i},{i}.5\n")
    df = readings.read_readings(spark, str(tmp_path), "d")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("many files", "")
    try:
        assert df.count() == 450 and df.rdd.getNumPartitions() == 5
        jobs_run = tracker.getJobIdsForGroup("many files")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs_run) <= 2


def test_patterns_lists_and_missing_folders(spark, tmp_path):
    for name in ("a (d) One.csv", "b (d) Two.csv", "_hidden (d) X.csv"):
        (tmp_path / name).write_text("id,data\n1,1\n")
    read = lambda path: readings.read_readings(spark, path, "d").count()
    assert read(str(tmp_path)) == 2 and read(f"file://{tmp_path}") == 2 and read(f"{tmp_path}/a*") == 1
    assert read([f"{tmp_path}/a (d) One.csv", f"{tmp_path}/b (d) Two.csv"]) == 2
    with pytest.raises(Exception, match="nowhere"):
        read(str(tmp_path / "nowhere"))


def test_a_recording_in_pieces(spark, tmp_path):
    import numpy as np

    deep = tmp_path / "deep"
    deep.mkdir()
    samples = np.arange(1000, dtype="<f4")
    (deep / "dev_20250401_120000.Single").write_bytes(np.float32(200).tobytes() + samples.tobytes())
    (tmp_path / "dev_20250401_120001.single").write_bytes(np.float32(50).tobytes() + samples[:1].tobytes())
    (tmp_path / "bad_20250401_120002.Single").write_bytes(b"12345")
    (tmp_path / "none_20250401_120003.Single").write_bytes(b"")
    (tmp_path / "dev_none.Single").write_bytes(samples.tobytes())
    for size in (1, 60, 4004, 1 << 20):
        got = waveforms.scan_waveform_parts(spark, str(tmp_path), size).orderBy("timestamp", "start").collect()
        own = [r for r in got if r.fs == 200]
        assert np.array_equal(np.concatenate([r.axisY for r in own]), samples) and [r.start for r in own] == np.cumsum([0, *map(lambda r: len(r.axisY), own)])[:-1].tolist()
        assert len(own) == -(-1000 // max(1, size // 4))
        assert [(r.start, r.axisY) for r in got if r.fs == 50] == [(0, [0.0])]
        assert sum(r.fs is None and r.axisY is None for r in got) == 2


def test_a_second_run_reads_new_recordings_only(spark, tmp_path):
    from tremora.streaming import jobs

    base = tmp_path / "waves"
    (base / "a").mkdir(parents=True)
    where = {"sink": str(tmp_path / "sink"), "checkpoint": str(tmp_path / "state")}
    for n, name in ((1, "one.json"), (2, "two.JSON")):
        (base / "a" / name).write_text('{"axisX": [0, 1], "axisY": [1, 2]}' if n == 1 else "not json")
        table = jobs.run_available(jobs.ingest(waveforms.waveform_json_stream(spark, str(base))), "waves", **where)
        assert table.count() == n
    assert table.select("ingest_time").distinct().count() == 2
    assert {r.file_name: r.axisY for r in table.collect()} == {"one.json": [1.0, 2.0], "two.JSON": None}
