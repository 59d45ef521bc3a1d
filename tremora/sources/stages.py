"""Stage tables and saved models."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F


def write_stage(df: DataFrame, path: str, partition_by: Sequence[str] = ("device",), fmt: str = "parquet") -> DataFrame:
    """Write a stage table and read it back.

    Only the partitions present in ``df`` are replaced, so one device can be rerun
    alone. Local disk or object store is a matter of the path's scheme.
    """
    writer = df.write.format(fmt).partitionBy(*partition_by).mode("overwrite")
    writer = writer.option("partitionOverwriteMode", "dynamic")
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.save(path)
    reader = df.sparkSession.read.schema(df.schema)
    if fmt == "csv":
        reader = reader.option("header", True)
    return reader.format(fmt).load(path).select(*df.columns)


def write_day_partitions(df: DataFrame, path: str, ts: str = "datetime") -> DataFrame:
    """Merged table partitioned by device and date, so a time range prunes folders."""
    return write_stage(df.withColumn("date", F.to_date(ts)), path, ("device", "date"))


def save_best(models: Mapping[str, PipelineModel], metrics: DataFrame, predictions: DataFrame,
              path: str, device: str) -> DataFrame:
    """Save the chosen models, their scores and one table of predictions (keys, target, y, prediction); returns the stored scores.

    The predictions of a target go straight to its folder; only rows of targets without a model are sorted for theirs.
    """
    spark, base = predictions.sparkSession, f"{path}/predictions/{device}"
    for target, model in models.items():
        model.write().overwrite().save(f"{path}/models/{device}/{target}")
    others = predictions.where(F.col("target").isNull() | ~F.col("target").isin(list(models)))
    others.write.mode("overwrite").partitionBy("target").parquet(base)
    for target in models:
        folder = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(target)
        predictions.where(F.col("target") == target).drop("target").write.mode("overwrite").parquet(f"{base}/target={folder}")
    return write_stage(metrics.withColumn("device", F.lit(device)), f"{path}/metrics")


def load_best(path: str, device: str, target: str) -> PipelineModel:
    return PipelineModel.load(f"{path}/models/{device}/{target}")


def load_predictions(spark: SparkSession, path: str, device: str, target: str) -> DataFrame:
    """Keys, truth and prediction of one target; the other targets' files are not opened."""
    return spark.read.parquet(f"{path}/predictions/{device}").where(F.col("target") == target)
