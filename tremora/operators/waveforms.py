"""Waveform tables: one row per recording in, one row of metrics out."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tremora.config import RMS_BANDS, WAVE_METRICS
from tremora.functions import names
from tremora.functions.waveform import TIME_NAMES, all_metrics, band_metrics, sampling_rate, time_metrics
from tremora.operators.rows import map_location


def with_sampling_rate(df: DataFrame, axis_x: str = "axisX") -> DataFrame:
    return df.withColumn("fs", sampling_rate(F.col(axis_x)))


def with_time_metrics(df: DataFrame, axis_y: str = "axisY") -> DataFrame:
    return df.withColumn("_t", time_metrics(F.col(axis_y))).withColumns({c: F.col(f"_t.{c}") for c in TIME_NAMES}).drop("_t")


def with_band_rms(df: DataFrame, axis_y: str = "axisY", fs: str = "fs", norm: str = "one_sided") -> DataFrame:
    bands = df.withColumn("_b", band_metrics(F.col(axis_y), F.col(fs), norm))
    return bands.withColumns({c: F.col(f"_b.{c}") for c in RMS_BANDS}).drop("_b")


def with_band_peak(df: DataFrame, axis_y: str = "axisY", fs: str = "fs") -> DataFrame:
    bands = df.withColumn("_b", band_metrics(F.col(axis_y), F.col(fs)))
    return bands.withColumn("peak_10_1000hz", F.col("_b.peak_10_1000hz")).drop("_b")


def with_file_fields(df: DataFrame, name: str = "file_name") -> DataFrame:
    """Time, sensor and wave code from the file name; names without a time are dropped."""
    n = F.col(name)
    # a generated column is read once: conditions on a plain one, as joins add them, would each parse the name anew
    timed = df.drop("timestamp").select("*", F.explode(F.array(names.wave_time(n))).alias("timestamp"))
    return timed.withColumns({"sensor_id": names.sensor_id(n), "wave_code": names.wave_code(n)}).where(F.col("timestamp").isNotNull())


def waveform_metrics(waves: DataFrame, dimension: DataFrame, norm: str = "one_sided") -> DataFrame:
    """Nine metrics per recording with its time, sensor, wave code and location.

    A recording without a valid sampling rate keeps its row with null metrics.
    """
    timed = with_sampling_rate(with_file_fields(waves))
    ok = F.when(F.col("fs").isNotNull(), F.col("axisY"))
    measured = timed.withColumn("_m", all_metrics(ok, F.col("fs"), norm))
    flat = measured.withColumns({c: F.col(f"_m.{c}") for c in (*TIME_NAMES, *RMS_BANDS, "peak_10_1000hz")})
    kept = [c for c in ("device", "filepath") if c in waves.columns]
    return map_location(
        flat.select(*kept, "timestamp", *WAVE_METRICS, "sensor_id", "wave_code"), dimension
    ).select(*kept, "timestamp", *WAVE_METRICS, "sensor_id", "wave_code", "location")
