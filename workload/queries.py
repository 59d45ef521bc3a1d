"""One query per operator: (spark, folder of the tables) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tremora.config import RMS_BANDS, VIBRATION, WAVE_METRICS, sensor_dimension
from tremora.functions import names
from tremora.functions.ratings import rating_band
from tremora.functions.time import epoch_seconds
from tremora.operators import (
    buckets, folds, joins, models, profiles, quantiles, reshape, rows, spectra, timeseries, waveforms,
)
from tremora.plans import chain
from tremora.session import scratch_path
from tremora.sources import readings as staged
from tremora.sources import stages
from tremora.sources import waveforms as recordings
from tremora.streaming import identities, jobs, levels, live
from workload import tables as t
from workload.staging import csv_files, file_per_row
from workload.tables import MEASURES, RATINGS

BUCKET_MINUTES = 120
FEATURES = ["l_quantity", "l_discount", "l_tax", "ship_ts"]
PRICE = "l_extendedprice"
SMALL = {
    "RandomForest": {"n_estimators": 10, "max_depth": 5},
    "GradientBoosting": {"n_estimators": 10, "max_depth": 3},
    "KernelRidge": {"components": 32},
}

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(f):
    REGISTRY[f.__name__.rstrip("_")] = f
    return f


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded for comparison.

    The nudge settles exact halves, which summation order would otherwise decide;
    adding zero turns a negative zero positive.
    """
    return df.select(*[
        (F.round(F.col(f"`{f.name}`") + F.lit(1e-9), digits) + F.lit(0.0)).alias(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ])


# -- shared steps -----------------------------------------------------------

def wide(spark, d):
    return reshape.pivot_readings(t.sensor_readings(spark, d), MEASURES)


def rated(spark, d):
    return reshape.pivot_ratings(t.ratings(spark, d), RATINGS)


def merged(spark, d):
    return chain.merged_table(t.sensor_readings(spark, d), t.ratings(spark, d), MEASURES, RATINGS, fill=["view"])


def summary(spark, d):
    return chain.bucket_table(merged(spark, d), MEASURES, RATINGS, BUCKET_MINUTES)


def metrics(spark, d):
    return waveforms.waveform_metrics(t.waves(spark, d), rows_dimension(spark))


def rows_dimension(spark):
    return sensor_dimension(spark, t.SENSORS)


def folded(spark, d):
    return folds.time_folds(t.regression(spark, d), t.ROW_ORDER)


# -- sources and sinks ------------------------------------------------------

def stage_readings(spark, d) -> str:
    """Readings and ratings staged as CSV files, several for a device and location; those of odd locations order their columns otherwise."""
    cols = ["id", "Date", "Time", "Measurement", "data"]
    r = t.readings(spark, d)
    odd = F.col("location").rlike("[13]$")
    after = F.concat(F.lit(" ("), "device", F.lit(") "), "location", F.lit(".csv"))
    path = csv_files(r.where(~odd), cols, "2024 + ", after)
    csv_files(r.where(odd), list(reversed(cols)), "2024 + ", after, path)
    marks = t.ratings(spark, d).select(
        F.date_format("datetime", "yyyy-MM-dd").alias("Date"), F.date_format("datetime", "HH:mm:ss").alias("Time"),
        F.col("device").alias("Device"), "Metric", "Rating")
    return csv_files(marks, marks.columns, "2024 + ", F.concat(F.lit(" ("), F.col("Device"), F.lit(") Rating March.csv")), path)


@query
def scan_readings(spark, d):
    path = stage_readings(spark, d)
    return staged.read_readings(spark, path, "dev_0").unionByName(staged.read_readings(spark, path, part_bytes=250_000).where("device = 'dev_1'"))


@query
def route_files(spark, d):
    readings, marks = staged.route_files(spark, stage_readings(spark, d), "dev_0")
    return readings.select(F.lit("reading").alias("kind"), "location", "Date", "Time",
                           F.col("Measurement").alias("name"), F.col("data").alias("value")).unionByName(
        marks.select(F.lit("rating").alias("kind"), F.lit(None).cast("string").alias("location"), "Date", "Time",
                     F.col("Metric").alias("name"), F.col("Rating").alias("value")))


@query
def union_by_name(spark, d):
    a = t.readings(spark, d).select("datetime", "device", "location", "Measurement", "data")
    return rows.union_by_name(a, t.ratings(spark, d))


def stage_json(spark, d) -> str:
    # the base folder's name holds the device too, which must not count
    files = t.waves(spark, d).select(
        F.concat(F.substring("file_name", 1, 8), F.lit("#"), "device", F.lit("/"), "file_name").alias("name"),
        F.to_json(F.struct("axisX", "axisY")).alias("content"))
    return file_per_row(files, scratch_path(spark, "waves of dev_1"))


@query
def scan_waveform_json(spark, d):
    read = recordings.scan_waveform_json(spark, stage_json(spark, d), "dev_1").withColumn(
        "filepath", F.regexp_extract("filepath", "([^/]+/[^/]+)$", 1))
    total = F.aggregate("axisY", F.lit(0.0), lambda s, v: s + v)
    return rounded(read.select("filepath", "file_name", F.size("axisX").alias("n_x"), F.size("axisY").alias("n_y"), total.alias("total")))


@F.pandas_udf(T.BinaryType())
def _single(ys: pd.Series) -> pd.Series:
    return ys.map(lambda y: np.float32(t.RATE).tobytes() + np.asarray(y, dtype="<f4").tobytes())


def binary_files(spark, d):
    """Recordings as binary files; those of every tenth number have a name that says no time."""
    files = t.table(spark, d, "embeddings").select("vec_id", _single("embedding").alias("content"))
    stamp = F.date_format(F.timestamp_add("SECOND", F.col("vec_id") * 60, F.lit("2024-01-01").cast("timestamp_ntz")), "yyyyMMdd_HHmmss")
    name = F.concat(F.lit("dev_"), F.col("vec_id"), F.when(F.col("vec_id") % 10 == 0, F.lit("_none")).otherwise(F.concat(F.lit("_"), stamp)), F.lit(".Single"))
    return files.select(name.alias("name"), "content", "vec_id")


def _vec_id():
    return F.regexp_extract("filepath", r"dev_(\d+)_", 1).cast("long").alias("vec_id")


@query
def scan_waveform_binary(spark, d):
    total = F.aggregate("axisY", F.lit(0.0), lambda s, v: s + v)
    read = recordings.scan_waveform_binary(spark, file_per_row(binary_files(spark, d)))
    return rounded(read.select(_vec_id(), "timestamp", "fs", F.size("axisY").alias("n_y"), total.alias("total")))


@query
def scan_waveform_parts(spark, d):
    """Pieces of a hundred bytes, so that every recording is read by several."""
    pieces = recordings.scan_waveform_parts(spark, file_per_row(binary_files(spark, d)), 100)
    own = F.aggregate("axisY", F.lit(0.0), lambda s, v: s + v)
    whole = pieces.groupBy("filepath", "timestamp", "fs").agg(F.sum(F.size("axisY")).alias("n_y"), F.sum(own).alias("total"), F.count("*").alias("pieces"))
    return rounded(whole.select(_vec_id(), "timestamp", "fs", "n_y", "total", "pieces"))


@query
def stream_waveforms(spark, d):
    """Two runs over a folder that grows in between; the second reads the new files only.

    A run of many files takes them in in several batches, each at a time of its own, so the last time of the
    first run tells the runs apart.
    """
    files, path = binary_files(spark, d), scratch_path(spark, "arriving")
    where = {n: scratch_path(spark, n) for n in ("sink", "checkpoint")}
    until = []
    for odd in (0, 1):
        file_per_row(files.where(F.col("vec_id") % 2 == odd), path)
        arrived = jobs.ingest(recordings.waveform_binary_stream(spark, path))
        table = jobs.run_available(arrived.select("filepath", "timestamp", F.size("axisY").alias("n_y"), "ingest_time"), "waves", **where)
        until.append(table.agg(F.max(F.unix_micros("ingest_time"))).first()[0])
    return table.select(_vec_id(), "timestamp", "n_y", F.when(F.unix_micros("ingest_time") <= until[0], 1).otherwise(2).alias("run"))


@query
def write_stage(spark, d):
    return rounded(stages.write_stage(wide(spark, d), scratch_path(spark, "wide")))


@query
def read_stage(spark, d):
    """The pivoted readings as a CSV stage with a stray index column, read back under another name for its time."""
    path = scratch_path(spark, "stage")
    wide(spark, d).withColumn("Unnamed: 0", F.lit(0)).write.option("header", True).csv(path)
    schema = "device string, datetime timestamp_ntz, location string, click double, signup double, view double, `Unnamed: 0` int"
    return rounded(staged.read_stage(spark, path, T.StructType.fromDDL(schema), time_to="timestamp"))


@query
def save_best(spark, d):
    table = t.regression(spark, d)
    done = chain.train(table, ["l_quantity"], [PRICE, "steady"], t.ROW_ORDER, ["Baseline", "Ridge"])
    path = scratch_path(spark, "results")
    stored = stages.save_best(done.models, done.best, done.predictions, path, "dev_0")
    read = stages.load_predictions(spark, path, "dev_0", PRICE).agg(F.count("y").alias("n_predictions"))
    return whole_scores(stored).crossJoin(read)  # one row


def whole_scores(df):
    """Scores with errors in whole units, as the solvers agree to about ten digits only."""
    errors = {c: F.round(c, 0).cast("long") for c in ("MSE", "RMSE", "MAE") if c in df.columns}
    return df.withColumns(errors).withColumns({c: F.round(F.col(f"`{c}`") + 1e-9, 6) + 0.0 for c in ("R2", "Explained Variance")})


# -- projections, filters, scalars ------------------------------------------

@query
def parse_datetime(spark, d):
    r = t.readings(spark, d).drop("datetime").withColumn("Time", F.when(F.col("id") % 50 == 0, "bad").otherwise(F.concat(F.lit(" "), "Time")))
    return rows.with_datetime(r).select("id", "datetime")


@query
def filter_range(spark, d):
    return rows.filter_range(t.readings(spark, d), datetime(2024, 1, 5), datetime(2024, 1, 12, 12)).select("id", "datetime", "device", "data")


@query
def overlap_range(spark, d):
    a, b = rows.overlap_range(wide(spark, d), rated(spark, d))
    return a.select(F.lit("reading").alias("side"), "device", "datetime").unionByName(
        b.select(F.lit("rating").alias("side"), "device", "datetime"))


@query
def drop_columns(spark, d):
    return rows.drop_columns(t.readings(spark, d), ["Date", "Time", "not there", "datetime"])


@query
def suffix_ratings(spark, d):
    return rounded(rows.suffix_ratings(rated(spark, d), [*RATINGS, "not there"]))


@query
def drop_nulls(spark, d):
    return rounded(rows.drop_nulls(rated(spark, d)))


@query
def epoch_seconds_(spark, d):
    return t.table(spark, d, "events").select("event_id", epoch_seconds("ts").alias("datetime_ts"))


@query
def one_hot(spark, d):
    codes = waveforms.with_file_fields(t.waves(spark, d)).select("vec_id", "sensor_id", "wave_code")
    located = rows.map_location(codes, rows_dimension(spark))
    return rows.one_hot(located.drop("sensor_id"), {"location": ["loc_0", "loc_1", "loc_2"], "wave_code": ["AH", "VV"]},
                        {"location": "loc", "wave_code": "wave"})


@query
def parse_wave_time(spark, d):
    w = t.waves(spark, d)
    older = F.concat(F.lit("dev_"), F.substring("file_name", 1, 8), F.lit("_"), F.substring("file_name", 10, 6), F.lit(".json"))
    name = F.when(F.col("vec_id") % 5 == 0, older).when(F.col("vec_id") % 5 == 1, F.lit("unnamed.json")).otherwise(F.col("file_name"))
    named = w.select("vec_id", name.alias("file_name"))
    return waveforms.with_file_fields(named).select("vec_id", "timestamp")


@query
def parse_wave_name(spark, d):
    n = F.when(F.col("vec_id") % 7 == 0, F.upper("file_name")).otherwise(F.col("file_name"))
    return t.waves(spark, d).select("vec_id", names.sensor_id(n).alias("sensor_id"), names.wave_code(n).alias("wave_code"))


@query
def map_location(spark, d):
    w = t.waves(spark, d).select("vec_id", names.sensor_id(F.col("file_name")).alias("sensor_id"))
    return rows.map_location(w, rows_dimension(spark))


@query
def canon_device(spark, d):
    raw = F.when(F.col("user_id") % 3 == 0, "1#High-temperature Fan").when(F.col("user_id") % 3 == 1, "8#Belt Conveyer").otherwise("Tube Mill")
    return t.table(spark, d, "events").select("event_id", names.canonical_device(raw).alias("device"))


@query
def display_names(spark, d):
    raw = F.concat("event_type", F.lit("_"), F.col("user_id") % 3, F.lit("_10khz"))
    e = t.table(spark, d, "events").select("event_id", raw.alias("name"))
    return e.select("event_id", names.heading(F.col("name")).alias("heading"), names.label(F.col("name")).alias("label"))


@query
def distinct_locations(spark, d):
    return rows.distinct_values(t.readings(spark, d), "location", ["device"])


@query
def location_filter(spark, d):
    return rows.select_device(t.readings(spark, d), "dev_0", ["loc_2", "loc_9"]).select("id", "device", "location", "data")


@query
def subsample(spark, d):
    return rows.subsample(t.readings(spark, d), ["id"], 30).select("id", "data")


@query
def first_n(spark, d):
    return rows.first_n(t.readings(spark, d).select("datetime", "id", "data"), ["datetime", "id"], 500)


@query
def numeric_only(spark, d):
    flagged = t.readings(spark, d).withColumn("hot", F.col("data") > 100)
    return rows.numeric_only(flagged, keep=["datetime"])


@query
def rating_band_(spark, d):
    r = t.ratings(spark, d)
    return r.withColumn("Rating", F.nullif("Rating", F.lit(40.0))).withColumn("band", rating_band(F.col("Rating")))


@query
def sort_time(spark, d):
    return rows.sort_time(t.readings(spark, d).select("datetime", "location", "id"), then=["location", "id"])


# -- reshape and aggregation ------------------------------------------------

@query
def pivot_readings(spark, d):
    return rounded(wide(spark, d))


@query
def pivot_ratings(spark, d):
    return rounded(rated(spark, d))


@query
def unpivot_targets(spark, d):
    return rounded(reshape.to_long(rated(spark, d), [*RATINGS, "not there"]))


@query
def bucket_summary(spark, d):
    return rounded(summary(spark, d))


@query
def profile(spark, d):
    return rounded(profiles.profile(wide(spark, d), MEASURES), 5)


@query
def radar_means(spark, d):
    selected = chain.dashboard_selection(rated_rows(spark, d), "dev_1", datetime(2024, 1, 3), datetime(2024, 1, 20), RATINGS)
    return rounded(profiles.radar_means(selected, [*RATINGS, "not there"]))


def rated_rows(spark, d):
    return rated(spark, d).withColumn("location", F.lit("loc_1"))


@query
def histogram_by_location(spark, d):
    return rounded(profiles.histogram(wide(spark, d), MEASURES, ["device", "location"]))


@query
def histogram_targets(spark, d):
    return rounded(profiles.histogram(rated(spark, d).withColumn("steady", F.lit(5.0)), [*RATINGS, "steady"]))


@query
def box_stats(spark, d):
    return rounded(profiles.box_stats(wide(spark, d), MEASURES, ["location"]))


@query
def box_stats_ranked(spark, d):
    """The way of groups too large for one task."""
    return rounded(profiles.box_stats(wide(spark, d), MEASURES, ["location"], in_memory_rows=0))


@query
def profile_ranked(spark, d):
    return rounded(profiles.profile(wide(spark, d), MEASURES, in_memory_rows=0), 5)


@query
def selected_quantiles(spark, d):
    """Quartiles and tails of whole columns by histograms; sixteen bins make several passes."""
    return rounded(quantiles.selected_quantiles(t.regression(spark, d), [*FEATURES, PRICE, "steady"], (0.0, 0.25, 0.5, 0.75, 0.999), bins=16)
                   .select("feature", "n", F.posexplode("q").alias("place", "value")), 5)


@query
def sketched_profile(spark, d):
    """Whether the exact rank of every answer is within the stated error, twice over, of the rank asked for."""
    table, error = t.sensor_readings(spark, d), 2 * quantiles.rank_error(400)
    q = profiles.sketched_profile(table, ["data"], ["Measurement"])
    asked = F.array(*[F.struct(F.lit(p).alias("asked"), F.col(f"q{round(100 * p)}").alias("answer")) for p in profiles.QUARTILES])
    answers = q.select("Measurement", "n", F.inline(asked))
    ranks = table.join(F.broadcast(answers), "Measurement").groupBy("Measurement", "n", "asked").agg(
        F.count_if(F.col("data") < F.col("answer")).alias("below"), F.count_if(F.col("data") <= F.col("answer")).alias("upto"))
    within = (F.col("below") / F.col("n") <= F.col("asked") + error) & (F.col("upto") / F.col("n") >= F.col("asked") - error)
    return ranks.select("Measurement", "n", "asked", within.alias("within"))


@query
def iqr_filter_selected(spark, d):
    """The way of columns too large for one task."""
    return profiles.iqr_filter(t.readings(spark, d), ["data"], in_memory_rows=0).select("id", "data")


@query
def corr_matrix(spark, d):
    return rounded(profiles.corr_matrix(t.regression(spark, d), [*FEATURES, PRICE, "steady"]), 5)


@query
def corr_cross(spark, d):
    return rounded(profiles.corr_cross(t.regression(spark, d), FEATURES, [PRICE, "steady"]), 5)


@query
def iqr_filter(spark, d):
    """Event values have a long tail, so rows do go."""
    return profiles.iqr_filter(t.readings(spark, d), ["data"]).select("id", "data")


@query
def pair_points(spark, d):
    return reshape.pair_points(t.regression(spark, d), ["l_quantity", "l_tax"], [PRICE], ["l_orderkey", "l_linenumber"], None)


@query
def pair_points_bounded(spark, d):
    return reshape.pair_points(t.regression(spark, d), ["l_quantity", "l_tax"], [PRICE],
                               ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"], 700)


@query
def time_extent(spark, d):
    return rows.time_extent(t.readings(spark, d), ["device"])


# -- time series ------------------------------------------------------------

@query
def forward_fill(spark, d):
    return rounded(timeseries.forward_fill(wide(spark, d), ["view"]))


@query
def bucket_assign(spark, d):
    marked = buckets.assign_buckets(merged(spark, d), RATINGS, BUCKET_MINUTES)
    return marked.select("device", "location", "datetime", "bucket_id", "bucket_start")


@query
def bucket_assign_shuffled(spark, d):
    """The way of slices too many to be broadcast."""
    marked = buckets.assign_buckets(merged(spark, d), RATINGS, BUCKET_MINUTES, broadcast_rows=0)
    return marked.select("device", "location", "datetime", "bucket_id", "bucket_start")


RANGE = (datetime(2024, 1, 3, 6), datetime(2024, 1, 24))


@query
def resample_adaptive(spark, d):
    return rounded(timeseries.resample_adaptive(wide(spark, d), *RANGE, MEASURES))


@query
def resample_gapfill(spark, d):
    return rounded(timeseries.resample_adaptive(wide(spark, d), *RANGE, MEASURES, gaps=True))


@query
def dashboard_selection(spark, d):
    return rounded(chain.dashboard_selection(wide(spark, d), "dev_1", *RANGE, MEASURES, ["loc_1"]))


@query
def dashboard_signal(spark, d):
    """Signal views of a resampled selection; the sampling interval is the bin width."""
    chosen = chain.dashboard_selection(wide(spark, d).withColumnRenamed("view", VIBRATION), "dev_1", *RANGE, [VIBRATION])
    out = chain.dashboard_views(chosen, interval=900.0)["signal"]
    return rounded(out.withColumn("x", F.col("x") * 1_000_000), 4)


@query
def overlay_series(spark, d):
    return rounded(timeseries.overlay_series(wide(spark, d), ["click", "view", "not there"], ["device", "location"], "datetime"))


@query
def sequence_windows(spark, d):
    w = wide(spark, d).withColumn("bucket_start", F.window("datetime", f"{BUCKET_MINUTES} minutes")["start"])
    seq = timeseries.sequence_windows(w, ["click", "view"], steps=240, step_seconds=30)
    def total(f):
        return F.aggregate("sequence", F.lit(0.0), lambda s, x: s + x[f])
    def weighted(f):
        return F.aggregate(F.transform("sequence", lambda x, i: x[f] * (i + 1)), F.lit(0.0), lambda s, x: s + x)
    return rounded(seq.select("device", "location", "bucket_start", "n_steps", F.size("sequence").alias("length"),
                              *[g(f).alias(f"{f}_{n}") for f in ("click", "view") for n, g in (("sum", total), ("weighted", weighted))]), 4)


# -- joins ------------------------------------------------------------------

@query
def asof_forward(spark, d):
    return rounded(joins.asof_join(wide(spark, d), rated(spark, d)))


@query
def asof_shuffled(spark, d):
    """The way of ratings too many to be broadcast."""
    return rounded(joins.asof_join(wide(spark, d), rated(spark, d), broadcast_rows=0))


@query
def asof_backward(spark, d):
    return rounded(joins.asof_join(wide(spark, d), rated(spark, d), direction="backward"))


@query
def merged_table(spark, d):
    return rounded(merged(spark, d))


def _contained(spark, d, bin_seconds):
    points = t.waves(spark, d).withColumn("timestamp", names.wave_time(F.col("file_name")))
    located = rows.map_location(points.withColumn("sensor_id", names.sensor_id(F.col("file_name"))), rows_dimension(spark))
    spans = summary(spark, d).select("device", "location", "bucket_id", "bucket_start", "bucket_end")
    out = joins.interval_join(located.select("vec_id", "device", "location", "timestamp"), spans, bin_seconds=bin_seconds)
    return out.select("vec_id", "device", "location", "timestamp", "bucket_id", "bucket_start", "bucket_end")


@query
def interval_join(spark, d):
    return _contained(spark, d, None)


@query
def interval_join_binned(spark, d):
    return _contained(spark, d, 600)


@query
def feature_table(spark, d):
    out = chain.feature_table(t.waves(spark, d), rows_dimension(spark), summary(spark, d), minutes=BUCKET_MINUTES)
    return rounded(out.select("timestamp", *WAVE_METRICS, "sensor_id", "wave_code", "device", "location", "bucket_id",
                              "view_mean", "view_count", "error_rating", "bucket_start", "bucket_end"), 4)


def model_rows(spark, d):
    features = chain.feature_table(t.waves(spark, d), rows_dimension(spark), summary(spark, d), minutes=BUCKET_MINUTES)
    have = features.drop("rms_0_10hz", "rms_10_100hz").select(
        "timestamp", "velocity_rms", "rms_1_10khz", "rms_10_25khz", "location", "wave_code", "sensor_id", "bucket_id", "view_count", "view_mean", "error_rating")
    return chain.regression_table(have, "timestamp", {"location": ["loc_0", "loc_1", "loc_2"], "wave_code": ["AH", "VV"]})


@query
def regression_table(spark, d):
    """Features to the rows that models train on; a recording's band without bins leaves it incomplete."""
    table = model_rows(spark, d)
    columns, targets = chain.split_columns(table, ["datetime_ts"])
    return rounded(table.select("timestamp", "datetime_ts", *columns, *targets), 4)


# -- waveforms and spectra --------------------------------------------------

@query
def sampling_rate(spark, d):
    cut = F.when(F.col("vec_id") % 10 == 0, F.slice("axisX", 1, 1)).when(F.col("vec_id") % 10 == 1, F.reverse("axisX")).otherwise(F.col("axisX"))
    return rounded(waveforms.with_sampling_rate(t.waves(spark, d).withColumn("axisX", cut)).select("vec_id", "fs"))


@query
def time_metrics(spark, d):
    return rounded(waveforms.with_time_metrics(t.waves(spark, d)).select("vec_id", "velocity_rms", "crest_factor", "kurtosis_opt", "peak_value_opt"))


@query
def band_rms(spark, d):
    return rounded(waveforms.with_band_rms(waveforms.with_sampling_rate(t.waves(spark, d))).select("vec_id", *RMS_BANDS), 4)


@query
def band_peak(spark, d):
    return rounded(waveforms.with_band_peak(waveforms.with_sampling_rate(t.waves(spark, d))).select("vec_id", "peak_10_1000hz"), 4)


@query
def waveform_metrics(spark, d):
    return rounded(metrics(spark, d), 4)


@query
def spectrum(spark, d):
    return rounded(spectra.spectrum(t.vibration(spark, d), "velocity").withColumn("frequency", F.col("frequency") * 1000), 4)


@query
def spectrum_spread(spark, d):
    """The way of series too long for one task."""
    out = spectra.spectrum(t.vibration(spark, d), "velocity", one_task_points=0)
    return rounded(out.withColumn("frequency", F.col("frequency") * 1000), 4)


@query
def envelope(spark, d):
    return rounded(spectra.envelope(t.vibration(spark, d), "velocity"), 4)


@query
def envelope_spectrum(spark, d):
    return rounded(spectra.envelope_spectrum(t.vibration(spark, d), "velocity").withColumn("frequency", F.col("frequency") * 1000), 4)


@query
def signal_panels(spark, d):
    out = spectra.signal_panels(t.vibration(spark, d), "velocity")
    return rounded(out.withColumn("x", F.col("x") * 1000), 4)


@query
def signal_panels_spread(spark, d):
    out = spectra.signal_panels(t.vibration(spark, d), "velocity", one_task_points=0)
    return rounded(out.withColumn("x", F.col("x") * 1000), 4)


# -- modelling --------------------------------------------------------------

@query
def standardise(spark, d):
    table = t.regression(spark, d)
    out = models.standardise(table, ["l_quantity", "l_discount", "steady"], table.where("l_shipdate < timestamp_ntz'1999-01-01 00:00:00'"))
    return rounded(out.select("l_orderkey", "l_linenumber", "l_quantity", "l_discount", "steady"))


@query
def poly_features(spark, d):
    out = models.poly_features(t.regression(spark, d), ["l_quantity", "l_discount"])
    labels = ["q", "q2", "d", "qd", "d2"]
    return rounded(out.select("l_orderkey", "l_linenumber", *[F.get("poly", F.lit(i)).alias(n) for i, n in enumerate(labels)]))


@query
def time_folds(spark, d):
    return folded(spark, d).select("l_orderkey", "l_linenumber", "row_index", "test_fold")


@query
def baseline_mean(spark, d):
    return rounded(folds.baseline_mean(folded(spark, d), PRICE), 4)


def fold_scores(spark, d):
    """Two fixed predictors of two targets, one of them constant, over the time folds."""
    rows_ = folded(spark, d).where("test_fold is not null")
    guess = F.col("l_quantity") * 1500.0
    cells = [("price", "linear", F.col(PRICE), guess), ("price", "flat", F.col(PRICE), F.lit(38000.0)),
             ("steady", "linear", F.col("steady"), guess), ("steady", "flat", F.col("steady"), F.lit(7.0))]
    cell = F.array(*[F.struct(F.lit(a).alias("target"), F.lit(m).alias("model"), y.alias("y"), p.alias("prediction")) for a, m, y, p in cells])
    long = rows_.select(F.col("test_fold").alias("fold"), F.inline(cell))
    return folds.fold_metrics(long)


@query
def fold_metrics(spark, d):
    return rounded(fold_scores(spark, d), 2)


@query
def cv_summary(spark, d):
    return rounded(folds.cv_summary(fold_scores(spark, d)), 2)


@query
def select_best(spark, d):
    return rounded(folds.select_best(folds.cv_summary(fold_scores(spark, d)), ["linear", "flat"]), 2)


@query
def ridge(spark, d):
    fitted = models.fit(t.regression(spark, d), ["l_quantity", "l_discount"], PRICE, "Ridge", {"alpha": 1000.0}).stages[-1]
    weights = [("l_quantity", float(fitted.coefficients[0])), ("l_discount", float(fitted.coefficients[1])), ("intercept", float(fitted.intercept))]
    return rounded(spark.createDataFrame(weights, "term string, weight double"), 2)


def _scored(spark, d, model):
    return rounded(models.cross_validate(folded(spark, d), FEATURES, PRICE, {model: (model, SMALL.get(model, {}))}), 4)


@query
def poly_ridge(spark, d):
    candidates = {"PolyRidgeDegree2": ("PolyRidgeDegree2", {})}
    return whole_scores(models.cross_validate(folded(spark, d), ["l_quantity"], PRICE, candidates))


FACTS = {"RandomForest": SMALL["RandomForest"], "GradientBoosting": SMALL["GradientBoosting"],
         "KernelRidge": {}, "RuleTree": {}}


@query
def model_facts(spark, d):
    """Of every model without a closed form: that it scores all folds, about as well as the mean or better."""
    price = F.col("l_quantity") * 900.0 + F.col("l_discount") * 5000.0 + F.pmod(F.col("l_orderkey"), F.lit(7)) * 10.0
    table = folded(spark, d).withColumn("made", price)  # a target that does depend on the features
    scores = models.cross_validate(table, FEATURES, "made", {n: (n, p) for n, p in FACTS.items()})
    return scores.select("target", "model", "fold", (F.col("R2") > 0.1).alias("explains"), (F.col("MSE") > 0).alias("errs"))


@query
def random_forest(spark, d):
    return _scored(spark, d, "RandomForest")


@query
def gbt(spark, d):
    return _scored(spark, d, "GradientBoosting")


@query
def kernel_ridge_rff(spark, d):
    return _scored(spark, d, "KernelRidge")


@query
def rule_tree(spark, d):
    fitted = models.fit(t.regression(spark, d), FEATURES, PRICE, "RuleTree")
    scored = models.predict(fitted, t.regression(spark, d))
    return rounded(scored.groupBy("prediction").agg(F.count("*").alias("n"), F.min("l_quantity").alias("lo"), F.max("l_quantity").alias("hi"))
                   .withColumn("rules", F.lit(models.rule_text(fitted).split("\n", 1)[1])), 2)


@query
def random_search(spark, d):
    best, draws = models.random_search(folded(spark, d), ["l_quantity"], PRICE, "Ridge")
    return whole_scores(draws).withColumn("best_alpha", F.round(F.lit(best["alpha"]), 6))


@query
def forest_search(spark, d):
    """A search over forests and boosted trees: every draw and fold is fitted on one table of binned features."""
    price = F.col("l_quantity") * 900.0 + F.col("l_discount") * 5000.0 + F.pmod(F.col("l_orderkey"), F.lit(7)) * 10.0
    table = folded(spark, d).withColumn("made", price)
    matrix = models.binned(table, FEATURES, ["made"])
    spaces = {"RandomForest": {"n_estimators": ("int", 3, 8), "max_depth": ("int", 3, 6)},
              "GradientBoosting": {"n_estimators": ("int", 4, 8), "max_depth": ("one", 2, 3), "learning_rate": ("log", 0.3, 0.6)}}
    found = [(m, models.random_search(table, FEATURES, "made", m, 2, space=space, matrix=matrix)) for m, space in spaces.items()]
    tables = [draws.select("target", F.lit(m).alias("searched"), F.col("model").alias("draw"), (F.col("R2") > 0.5).alias("explains"),
                           F.lit(set(best) == set(spaces[m])).alias("settled")) for m, (best, draws) in found]
    return tables[0].unionByName(tables[1])


@query
def train_features(spark, d):
    """The feature chain to its end: recordings and buckets to complete rows, columns split, models compared by target."""
    table = model_rows(spark, d)
    columns, targets = chain.split_columns(table, ["datetime_ts"])
    done = chain.train(table, columns, targets, ["timestamp", "velocity_rms"], ["Baseline", "Ridge", "RandomForest"],
                       {"RandomForest": {"n_estimators": 5, "max_depth": 3}})
    counts = done.predictions.agg(F.count("y").alias("n_predictions"), F.countDistinct("target").alias("n_targets"))
    return rounded(done.scores.where("model = 'Baseline'"), 4).crossJoin(counts)  # one row


# -- streaming --------------------------------------------------------------

def _event_stream(spark, d):
    # a pattern fits one file as well as a folder of files
    return jobs.file_stream(spark, f"{d}/[e]vents.parquet", t.EVENTS_SCHEMA)


@query
def stream_ingest(spark, d):
    arrived = jobs.ingest(t.as_readings(_event_stream(spark, d)))
    table = jobs.run_available(arrived, "ingest")
    return jobs.refresh_times(table).drop("refreshed_at")


@query
def stream_resample(spark, d):
    stream = t.as_readings(_event_stream(spark, d)).withColumnRenamed("data", "mean_data")
    binned = levels.resample_available(stream, "15 minutes", ["mean_data"])
    return rounded(binned.withColumn("datetime", F.col("datetime").cast("timestamp_ntz")))


@query
def stream_resample_live(spark, d):
    """Bins that the watermark has passed, each written once."""
    stream = t.as_readings(_event_stream(spark, d)).withColumnRenamed("data", "mean_data")
    closed = jobs.run_available(jobs.resample_stream(stream, "15 minutes", ["mean_data"]), "bins")
    return rounded(closed.withColumn("datetime", F.col("datetime").cast("timestamp_ntz")))


def _sent_twice(spark, d):
    stream = t.as_readings(_event_stream(spark, d)).select("id", "datetime", "device", "data")
    return stream.unionByName(t.as_readings(_event_stream(spark, d)).select("id", "datetime", "device", "data"))


@query
def stream_dedup(spark, d):
    kept = identities.dedup_available(_sent_twice(spark, d), ["id"])
    return kept.withColumn("datetime", F.col("datetime").cast("timestamp_ntz"))


@query
def stream_dedup_live(spark, d):
    """Repeats within the watermark's delay, which is all that the state knows."""
    kept = jobs.run_available(jobs.dedup_stream(_sent_twice(spark, d), ["id"]), "dedup")
    return kept.withColumn("datetime", F.col("datetime").cast("timestamp_ntz"))


def bucket_rows(events):
    """One reading per event with a coarse rating of its own, keyed by device and location."""
    return t.as_readings(events.withColumn("exact", F.col("ts")), "exact").select(
        "device", "location", F.col("exact").alias("datetime"), "data",
        (F.floor(F.col("data") / 60) * 20).cast("double").alias("level"))


@query
def stream_buckets(spark, d):
    """In any order, however late."""
    return rounded(jobs.buckets_available(bucket_rows(_event_stream(spark, d)), ["data"], ["level"], BUCKET_MINUTES))


@query
def stream_buckets_live(spark, d):
    """With the state of open slices only."""
    return rounded(live.buckets_live(bucket_rows(_event_stream(spark, d)), ["data"], ["level"], BUCKET_MINUTES))
