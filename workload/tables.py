"""Sensor-shaped views of the test tables.

``events`` stands in for readings (and, in 20-minute means, for ratings) and
``embeddings`` for waveforms; ``lineitem`` is the regression table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

MEASURES = ["click", "signup", "view"]
RATINGS = ["error", "purchase"]
RATE, SLOW_RATE = 50_000.0, 300.0  # every third recording is slow, so that the low bands hold values too
SENSORS = {f"{i:024x}": f"loc_{i}" for i in range(3)}  # the fourth sensor stays unmapped
ROW_ORDER = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]

EVENTS_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _device() -> F.Column:
    return F.concat(F.lit("dev_"), F.col("user_id") % 2)


def _location() -> F.Column:
    return F.concat(F.lit("loc_"), F.col("user_id") % 4)


def as_readings(events: DataFrame, *extra: str) -> DataFrame:
    """Long readings with text date and time, as staged files hold them."""
    return events.select(
        F.col("event_id").alias("id"),
        F.date_format("ts", "yyyy-MM-dd").alias("Date"),
        F.date_format("ts", "HH:mm:ss").alias("Time"),
        F.col("event_type").alias("Measurement"),
        F.col("value").alias("data"),
        _device().alias("device"),
        _location().alias("location"),
        F.date_trunc("second", "ts").cast("timestamp_ntz").alias("datetime"),
        *extra,
    )


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_readings(table(spark, sf_dir, "events"))


def sensor_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings of the sensors: the events of all types but those that stand for ratings."""
    return readings(spark, sf_dir).where(~F.col("Measurement").isin(RATINGS))


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A 0-100 rating per device, metric and 20 minutes, in steps of 20."""
    level = F.floor(F.round(F.avg("value"), 6) / 20) * 20
    return (
        table(spark, sf_dir, "events")
        .where(F.col("event_type").isin(RATINGS))
        .groupBy(_device().alias("device"), F.window("ts", "20 minutes").alias("w"), F.col("event_type").alias("Metric"))
        .agg(F.greatest(F.lit(0.0), F.lit(100.0) - level.cast("double")).alias("Rating"))
        .select("device", F.col("w.end").alias("datetime"), "Metric", "Rating")
    )


def vibration(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One numeric series per device and location."""
    events = table(spark, sf_dir, "events")
    return events.select(_device().alias("device"), _location().alias("location"),
                         F.col("ts").alias("timestamp"), F.col("value").alias("velocity"))


def rate() -> Column:
    return F.when(F.col("vec_id") % 3 == 0, SLOW_RATE).otherwise(RATE)


def waves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Waveform recordings named like the files they would come from."""
    seconds = (F.col("vec_id") % 500) * 85 * 60
    at = F.timestamp_add("SECOND", seconds, F.lit("2024-01-01").cast("timestamp_ntz"))
    sensor = F.col("vec_id") % 4
    name = F.concat(
        F.date_format(at, "yyyyMMdd HHmmss"), F.lit("_"), F.lpad(F.lower(F.hex("vec_id")), 24, "0"), F.lit("_"),
        F.lpad(sensor.cast("string"), 24, "0"), F.lit("_"),
        F.when(F.col("vec_id") % 3 == 0, "VV").otherwise("AH"), F.lit(".json"),
    )
    return table(spark, sf_dir, "embeddings").select(
        "vec_id",
        F.concat(F.lit("dev_"), sensor % 2).alias("device"),
        name.alias("file_name"),
        F.transform(F.sequence(F.lit(0), F.size("embedding") - 1), lambda i: i / rate()).alias("axisX"),
        F.col("embedding").alias("axisY"),
    )


def regression(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        *ROW_ORDER, "l_discount", "l_tax", F.lit(7.0).alias("steady"),
        F.floor(F.unix_micros(F.col("l_shipdate").cast("timestamp")) / 1_000_000).cast("double").alias("ship_ts"),
    )
