import json
import struct

import numpy as np
import pandas as pd
import pytest
from helpers import at
from pyspark.sql import functions as F

from tremora.config import WAVE_METRICS, sensor_dimension
from tremora.operators import spectra, waveforms
from tremora.sources import waveforms as recordings

SENSOR = "67c29bab30e6dd385f031caa"


def wave(spark, y, fs=1000.0, name=f"20250401 000000_{'0' * 24}_{SENSOR}_VV.json"):
    x = [i / fs for i in range(len(y))]
    return spark.createDataFrame([(x, [float(v) for v in y], name)], "axisX array<double>, axisY array<double>, file_name string")


def measured(spark, y, fs=1000.0, **kw):
    return waveforms.waveform_metrics(wave(spark, y, fs), sensor_dimension(spark), **kw).first()


def test_two_point_signal(spark):
    r = measured(spark, [1, -1])
    assert r.velocity_rms == 1.0 and r.crest_factor == 1.0 and r.peak_value_opt == 1.0
    assert r.location == "Gear Reducer" and r.timestamp == at(0)


def test_sine_band_peak(spark):
    t = np.arange(1000) / 1000
    r = measured(spark, np.sin(2 * np.pi * 50 * t))
    assert r.peak_10_1000hz == pytest.approx(1.0, abs=0.05)
    assert r.rms_10_100hz == pytest.approx(np.sqrt((500**2) / 1000), rel=1e-6)
    assert r.rms_10_25khz is None
    p = measured(spark, np.sin(2 * np.pi * 50 * t), norm="parseval")
    assert p.rms_10_100hz == pytest.approx(np.sqrt(0.5), rel=1e-6)


@pytest.mark.parametrize("n,fs", [(1000, 1000.0), (999, 25000.0), (512, 50000.0), (25600, 25600.0)])
def test_metrics_match_numpy(spark, n, fs):
    rng = np.random.default_rng(42)
    y = np.sin(2 * np.pi * 50 * np.arange(n) / fs) + 0.3 * rng.standard_normal(n) + 2
    r = measured(spark, y, fs)
    c = y - y.mean()
    assert r.velocity_rms == pytest.approx(np.sqrt((y**2).mean()))
    assert r.kurtosis_opt == pytest.approx((c**4).mean() / (c**2).mean() ** 2)
    assert r.peak_value_opt == pytest.approx(np.abs(y).max())
    spec, freq = np.fft.rfft(c), np.fft.rfftfreq(n, 1 / fs)
    for name, lo, hi in (("rms_0_10hz", 0.1, 10), ("rms_10_100hz", 10, 100), ("rms_1_10khz", 1000, 10000)):
        inside = (freq >= lo) & (freq <= hi)
        want = np.sqrt((np.abs(spec[inside]) ** 2).sum() / n) if inside.any() else None
        assert r[name] == (pytest.approx(want) if want is not None else None)
    assert r.peak_10_1000hz == pytest.approx(np.abs(np.fft.irfft(np.where((freq >= 10) & (freq <= 1000), spec, 0), n)).max())


def test_zero_signal(spark):
    r = measured(spark, np.zeros(512), 200.0)
    assert r.velocity_rms == 0 and r.crest_factor is None and r.kurtosis_opt is None
    assert r.rms_0_10hz == 0 and r.peak_10_1000hz == 0


def test_invalid_axis_keeps_row_without_metrics(spark):
    name = f"20250401 000000_{'0' * 24}_{SENSOR}_VV.json"
    df = spark.createDataFrame(
        [([0.0], [1.0], name), ([0.0, 0.0], [1.0, 2.0], name), ([0.1, 0.0], [1.0, 2.0], name), (None, None, name), ([], [], name),
         ([0.0, 0.001, 0.002], [1.0, 2.0, 3.0], "no time.json")],
        "axisX array<double>, axisY array<double>, file_name string")
    got = waveforms.waveform_metrics(df, sensor_dimension(spark)).collect()
    assert len(got) == 5
    assert all(r[c] is None for r in got for c in WAVE_METRICS)
    assert waveforms.with_sampling_rate(df).orderBy(F.size("axisX").desc()).first().fs == pytest.approx(1000)


def test_unknown_norm(spark):
    with pytest.raises(ValueError):
        waveforms.with_band_rms(waveforms.with_sampling_rate(wave(spark, [1, 2])), norm="x")


def test_scan_json(spark, tmp_path):
    folder = tmp_path / "20230101#Belt Conveyer" / "a + b"
    folder.mkdir(parents=True)
    other = tmp_path / "20230101#Tube Mill"
    other.mkdir()
    name = f"20230101 120000_{'0' * 24}_{SENSOR}_VV.json"
    doc = json.dumps({"axisX": [0, 0.001, 0.002], "axisY": [1, 2, 3]}, indent=1)
    (folder / name).write_text(doc)
    (folder / "20230101 130000_bad.json").write_text("{not json")
    (folder / "notes.txt").write_text("x")
    (other / name).write_text(doc)
    got = recordings.scan_waveform_json(spark, str(tmp_path), "Belt Conveyer").orderBy("file_name").collect()
    assert [r.file_name for r in got] == [name, "20230101 130000_bad.json"]
    assert got[0].axisY == [1, 2, 3] and got[1].axisY is None
    assert got[0].filepath.endswith(f"20230101#Belt Conveyer/a + b/{name}")
    assert recordings.scan_waveform_json(spark, str(tmp_path)).count() == 3
    metrics = waveforms.waveform_metrics(recordings.scan_waveform_json(spark, str(tmp_path), "Belt Conveyer"), sensor_dimension(spark))
    assert {(r.location, r.velocity_rms is None) for r in metrics.collect()} == {("Gear Reducer", False), (None, True)}


def test_scan_binary(spark, tmp_path):
    for n, values in (("dev_20250101_010203.Single", [1000.0, 0, 1, -2, 0.5]), ("dev_20250101_010204.single", [500.0, 1, -1])):
        (tmp_path / n).write_bytes(struct.pack(f"<{len(values)}f", *values))
    (tmp_path / "dev_20250101_010205.Single").write_bytes(b"abc")
    (tmp_path / "nodate.Single").write_bytes(struct.pack("<2f", 1, 2))
    got = recordings.scan_waveform_binary(spark, str(tmp_path)).orderBy("timestamp").collect()
    assert [(r.timestamp.second, r.fs, r.axisY) for r in got] == [(3, 1000.0, [0, 1, -2, 0.5]), (4, 500.0, [1, -1]), (5, None, None)]


def series(spark, lengths, seed=0):
    rng = np.random.default_rng(seed)
    data = [("d", f"l{n}", at(5 * i * 977), float(v)) for n in lengths for i, v in enumerate(rng.standard_normal(n) * 3 + 1)]
    data.append(("d", f"l{lengths[0]}", at(1), None))
    return data, spark.createDataFrame(data, "device string, location string, timestamp timestamp_ntz, v double")


def numpy_panels(y):
    y = y - y.mean()
    n = len(y)
    spec = np.fft.fft(y)
    h = np.zeros(n)
    h[0] = 1
    if n % 2 == 0:
        h[n // 2] = 1
    h[1:(n + 1) // 2] = 2
    env = np.abs(np.fft.ifft(spec * h))
    env = env - env.mean()
    return {"raw": y, "spectrum": np.abs(spec)[:n // 2], "envelope": env, "envelope_spectrum": np.abs(np.fft.fft(env))[:n // 2]}


@pytest.mark.parametrize("one_task_points", [10**6, 5])
def test_panels_match_numpy(spark, one_task_points):
    lengths = [1, 2, 7, 12, 97, 200]
    data, df = series(spark, lengths)
    got = spectra.signal_panels(df, "v", one_task_points=one_task_points).toPandas()
    for n in lengths:
        values = [(r[2], r[3]) for r in data if r[1] == f"l{n}" and r[3] is not None]
        want = numpy_panels(np.array([v for _, v in values]))
        mine = got[got.location == f"l{n}"]
        for panel, y in want.items():
            part = mine[mine.panel == panel]
            part = part.sort_values("timestamp" if panel in ("raw", "envelope") else "bin")
            np.testing.assert_allclose(part["y"].to_numpy(float), y, atol=1e-9)
            if panel in ("raw", "envelope"):
                assert list(part["timestamp"]) == [t for t, _ in values]
                assert part["x"].isna().all()
            else:
                np.testing.assert_allclose(part["x"].to_numpy(float), np.arange(n // 2) / (n * 5.0))


@pytest.mark.parametrize("block_points", [1, 40, 300])
def test_long_series_lie_in_few_blocks(spark, block_points, monkeypatch):
    lengths = [1, 2, 3, 96, 97, 128]
    data, df = series(spark, lengths)
    stored = []
    real = spectra.materialise
    monkeypatch.setattr(spectra, "materialise", lambda df, name: stored.append(real(df, name)) or stored[-1])
    got = spectra.signal_panels(df, "v", one_task_points=0, block_points=block_points).toPandas()
    for n in lengths:
        want = numpy_panels(np.array([r[3] for r in data if r[1] == f"l{n}" and r[3] is not None]))
        for panel, y in want.items():
            part = got[(got.location == f"l{n}") & (got.panel == panel)]
            part = part.sort_values("timestamp" if panel in ("raw", "envelope") else "bin")
            np.testing.assert_allclose(part["y"].to_numpy(float), y, atol=1e-9)
    if block_points == 300:  # what is stored and shuffled are matrices, not points
        assert all(s.where("n = 128").count() == 1 for s in stored)


def test_panels_of_nothing(spark):
    _, df = series(spark, [3])
    assert spectra.signal_panels(df.where("false"), "v").count() == 0
    with pytest.raises(ValueError):
        spectra.signal_panels(df, "v", panels=["other"])
    assert set(spectra.spectrum(df, "v").columns) == {"device", "location", "bin", "frequency", "amplitude"}


def test_recordings_of_one_length_and_rate_share_a_transform(spark, monkeypatch):
    """Mixed lengths, rates, nulls and constants in one batch: each row as if alone, with a transform per kind and not per row."""
    from tremora.functions import waveform

    rng = np.random.default_rng(3)
    kinds = [(64, 300.0), (64, 50_000.0), (50, 300.0), (7, np.nan)]
    ys, rates = [], []
    for i in range(400):
        n, fs = kinds[i % 4]
        ys.append(rng.normal(size=n).astype(np.float32))
        rates.append(fs)
    ys[0], ys[1], ys[2] = None, np.array([], dtype=np.float32), np.full(50, 2.5, dtype=np.float32)
    ys[5][3] = np.nan
    measure, calls, rfft = waveform._metrics_udf(True, True, True).func, [], np.fft.rfft
    alone = pd.concat([next(measure(iter([(pd.Series([y], dtype=object), pd.Series([fs]))]))) for y, fs in zip(ys, rates)], ignore_index=True)
    monkeypatch.setattr(np.fft, "rfft", lambda *a, **b: calls.append(1) or rfft(*a, **b))
    together = next(measure(iter([(pd.Series(ys, dtype=object), pd.Series(rates))])))
    assert len(calls) == 3
    pd.testing.assert_frame_equal(together, alone, rtol=1e-12)
    assert together.iloc[[0, 1]].isna().all(axis=None) and together.iloc[3][waveform.BAND_NAMES].isna().all()
    assert together.iloc[5][waveform.TIME_NAMES].isna().all()
    assert np.isnan(together["kurtosis_opt"][2]) and together["crest_factor"][2] == 1.0
    x = ys[9].astype(float)  # 64 points at 50 kHz
    power = np.abs(rfft(x - x.mean())) ** 2 * np.r_[1, np.full(31, 2), 1] / 64**2
    at = np.arange(33) * 50_000 / 64
    assert together["rms_1_10khz"][9] == pytest.approx(np.sqrt(power[(at >= 1000) & (at <= 10_000)].sum()))
    assert together["velocity_rms"][9] == pytest.approx(np.sqrt(np.mean(x * x)))


def test_names_are_parsed_once_whatever_is_joined(spark):
    """Conditions on the recording time, which a join adds, must not repeat the parsing of the name."""
    from tremora.operators.joins import interval_join

    # 20250401 with the id as minutes, and every seventh name without a time
    name = F.concat(F.when(F.col("id") % 7 == 0, "none").otherwise(F.concat(F.lit("20250401 00"), F.lpad(F.col("id").cast("string"), 2, "0"), F.lit("00"))),
                    F.lit(f"_{'0' * 24}_{SENSOR}_VV.json"))
    waves = spark.range(60).select(F.lit("d").alias("device"), name.alias("file_name"), F.array(F.lit(0.0), F.lit(0.001)).alias("axisX"),
                                   F.array(F.lit(1.0), F.col("id").cast("double")).alias("axisY"))
    buckets = spark.createDataFrame([("d", "Gear Reducer", at(0), at(600)), ("d", "Gear Reducer", at(1800), at(1920))],
                                    "device string, location string, bucket_start timestamp_ntz, bucket_end timestamp_ntz")
    joined = interval_join(waveforms.waveform_metrics(waves, sensor_dimension(spark)), buckets).na.drop(subset=["timestamp", "velocity_rms"])
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert not [line for line in plan.splitlines() if "Filter" in line and "regexp_extract" in line]
    assert plan.count("regexp_extract(") < 12
    got = joined.orderBy("timestamp").collect()
    assert [r.timestamp for r in got] == [at(60 * i) for i in (1, 2, 3, 4, 5, 6, 8, 9, 10, 30, 31, 32)]
    assert all(r.sensor_id == SENSOR and r.wave_code == "VV" and r.bucket_start <= r.timestamp <= r.bucket_end for r in got)
