"""The stage chain: readings and ratings to merged table, features and models."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import partial, reduce

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, functions as F, types as T

from tremora.config import METRIC_RATINGS, STATUS_RATINGS, VIBRATION
from tremora.functions.time import epoch_seconds
from tremora.operators import buckets, folds, models, reshape, rows, spectra, timeseries, waveforms
from tremora.operators.joins import asof_join, interval_join
from tremora.operators.profiles import radar_means
from tremora.session import materialise


def merged_table(readings: DataFrame, ratings: DataFrame, measurements: Sequence[str], metrics: Sequence[str],
                 fill: Sequence[str] = ("Temperature",), direction: str = "forward") -> DataFrame:
    """Long readings and ratings of all devices to one row per device, time and location.

    Readings pivot, fill forward, are cut to the time both sides cover and take the
    next rating of their device. The pivoted sides are written once, as their extents
    are needed before their rows, and so is the result, which the bucket steps read
    several times with few columns.
    """
    wide = materialise(reshape.pivot_readings(readings, measurements), "wide-readings")
    rated = materialise(reshape.pivot_ratings(ratings, metrics), "wide-ratings")
    bounds = rows.overlap_bounds(wide, rated)
    # values from before the shared range still carry into it
    filled = rows.clip(timeseries.forward_fill(wide, fill), bounds)
    return materialise(asof_join(filled, rows.clip(rated, bounds), direction=direction), "merged")


def bucket_table(merged: DataFrame, measurements: Sequence[str], ratings: Sequence[str], minutes: int = 20,
                 null_breaks: bool = False) -> DataFrame:
    """Rating buckets of the merged table with measurement statistics, ratings suffixed."""
    renamed = rows.suffix_ratings(merged, ratings)
    suffixed = [f"{r}_rating" for r in ratings]
    marked = buckets.assign_buckets(renamed, suffixed, minutes, null_breaks=null_breaks)
    return buckets.summarise_buckets(marked.drop("bucket_start"), measurements, suffixed)


def feature_table(waves: DataFrame, dimension: DataFrame, summary: DataFrame,
                  keys: Sequence[str] = ("device", "location"), minutes: int = 20) -> DataFrame:
    """Waveform metrics beside the bucket they were recorded in."""
    metrics = waveforms.waveform_metrics(waves, dimension)
    return interval_join(metrics, summary, keys=keys, bin_seconds=minutes * 60)


@dataclass
class Training:
    """Chosen model per target, all scores, the winning rows and their predictions."""

    models: dict[str, PipelineModel]
    scores: DataFrame
    best: DataFrame
    predictions: DataFrame  # order columns, target, y, prediction


def regression_table(features: DataFrame, ts: str = "datetime", categories: Mapping[str, Sequence[str]] | None = None,
                     unused: Sequence[str] = ("filepath", "sensor_id", "bucket_id", "bucket_end", "s3_key")) -> DataFrame:
    """Complete rows with epoch seconds and, where categories are given, 0/1 columns for them."""
    complete = rows.drop_nulls(rows.drop_columns(features, unused))
    timed = complete.withColumn("datetime_ts", epoch_seconds(ts))
    return rows.one_hot(timed, dict(categories), {"location": "loc", "wave_code": "wave"}) if categories else timed


def split_columns(df: DataFrame, keep: Sequence[str] = ()) -> tuple[list[str], list[str]]:
    """Targets end in ``_rating``; features are the other numeric columns not kept aside."""
    targets = [c for c in df.columns if c.endswith("_rating")]
    numeric = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.NumericType, T.BooleanType))]
    return [c for c in numeric if c not in targets and c not in keep], targets


def train(df: DataFrame, features: Sequence[str], targets: Sequence[str], order: Sequence[str],
          names: Sequence[str] | Mapping[str, tuple[str, Mapping]] = models.MODELS,
          params: Mapping[str, Mapping] | None = None, k: int = 3,
          tune: bool = False, draws: int = 10, threads: int = 4, seed: int = 42) -> Training:
    """Per target, the model with the best mean R2 over time folds, refitted on all rows.

    ``names`` lists models, or names candidates of one's own as (model, parameters), so that
    one model can compete with itself. The rows are ordered and stored once; scores, final
    fits and predictions all read that table. Forests and boosted trees read one table of
    binned features, which all targets, draws and folds share.
    """
    own = names if isinstance(names, Mapping) else {n: (n, {}) for n in names}
    listed = {n: (m, {**p, **(params or {}).get(n, {})}) for n, (m, p) in own.items()}
    folded = folds.time_folds(df, order, k)
    forests = any(model in models.FORESTS for model, _ in listed.values())
    matrix = models.binned(folded, features, targets) if forests and targets else None

    def score(target: str) -> tuple[dict, DataFrame]:
        settings = {}
        for name, (model, own) in listed.items():
            if tune and model in models.SEARCH_SPACE:
                own = own | models.random_search(folded, features, target, model, draws, k, threads, seed, matrix=matrix)[0]
            settings[name] = (model, own)
        return settings, models.cross_validate(folded, features, target, settings, k, threads, seed, matrix)

    # the fits of a target overlap, the targets follow each other: one pool of threads at a time
    scored = {target: score(target) for target in targets}
    metrics = rows.union_by_name(*[m for _, m in scored.values()])
    scores = materialise(folds.cv_summary(metrics), "scores")
    best = folds.select_best(scores, list(listed))
    winners = {r["target"]: r["model"] for r in best.collect()}  # one row per target

    def refit(target: str) -> PipelineModel:
        model, own = scored[target][0][winners[target]]
        if model in models.FORESTS:
            return models.fit_binned(matrix, matrix.rows, target, model, own, seed)
        return models.fit(folded, features, target, model, own, seed)

    fitted = dict(zip(targets, models.in_threads([partial(refit, target) for target in targets], threads)))
    return Training(fitted, scores, best, _predictions(folded, fitted, order))


def _predictions(df: DataFrame, fitted: Mapping[str, PipelineModel], order: Sequence[str]) -> DataFrame:
    """Truth and prediction of every target in one long table beside the order columns."""
    if not fitted:
        return df.select(*order, F.lit("").alias("target"), F.lit(0.0).alias("y"), F.lit(0.0).alias("prediction")).where("false")
    each = [
        model.transform(df).select(*order, F.lit(t).alias("target"), F.col(f"`{t}`").cast("double").alias("y"), F.col("prediction").cast("double").alias("prediction"))
        for t, model in fitted.items()]
    return reduce(DataFrame.unionByName, each)  # a filter on the target leaves its part alone


def dashboard_selection(merged: DataFrame, device: str, start: datetime | None, end: datetime | None,
                        columns: Sequence[str], locations: Sequence[str] | None = None) -> DataFrame:
    """Rows behind a dashboard view: range, adaptive bins with gaps, device and locations."""
    df = rows.select_device(merged, device, locations)
    if start is None or end is None:
        return df
    return timeseries.resample_adaptive(df, start, end, columns, gaps=True)


def dashboard_views(selection: DataFrame, interval: float = 5.0, ts: str = "datetime") -> dict[str, DataFrame]:
    """The numbers behind each chart of the dashboard."""
    out = {
        "header": rows.time_extent(selection, ts=ts),
        "status": radar_means(selection, STATUS_RATINGS),
        "metrics": radar_means(selection, METRIC_RATINGS),
        "ratings": timeseries.overlay_series(selection, STATUS_RATINGS + METRIC_RATINGS, ts=ts),
    }
    if VIBRATION in selection.columns:
        out["signal"] = spectra.signal_panels(selection, VIBRATION, interval, ts=ts)
    return out
