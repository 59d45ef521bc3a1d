"""Incremental versions of the table steps.

Each function turns a streaming table into a streaming table; ``run_available``
drives one over everything that has arrived.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tremora.functions.time import epoch_micros
from tremora.operators.buckets import assign_buckets, summarise_buckets
from tremora.session import broadcast_if_small, scratch_path, settings
from tremora.streaming.tables import delete, each_batch, folders, is_complete, numbers

LISTING, OPEN_COST = "spark.sql.sources.parallelPartitionDiscovery.parallelism", "spark.sql.files.openCostInBytes"
LISTED = "spark.sql.hive.filesourcePartitionFileCacheSize"
OPEN_BYTES = 1 << 16  # that opening a file counts as, so that a task takes at most about 2 000 files


def file_stream(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
                files_per_trigger: int | None = 256) -> DataFrame:
    """New files below ``path``, each read once; a limit bounds a batch of backlog.

    A CSV file whose header does not name the schema's columns in their order fails the stream.
    """
    reader = spark.readStream.schema(schema).format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True).option("enforceSchema", False)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)


def event_time(df: DataFrame, ts: str, delay: str) -> DataFrame:
    """Watermark ``ts``; zone-free times are read as UTC since watermarks need an instant."""
    return df.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)


def _many_files(spark: SparkSession) -> dict[str, str]:
    """Settings for batches of many small files; the file source reads them from the session of its stream during a run.

    The files of a batch are listed by a few tasks a core, not by a task each, and small ones share a reading
    task; smaller values of the session stay. As no batch comes twice, none stays in the driver's cache of lists.
    """
    cost = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(OPEN_COST))
    tasks = min(int(spark.conf.get(LISTING)), 4 * spark.sparkContext.defaultParallelism)
    return {LISTING: str(tasks), OPEN_COST: str(min(cost, OPEN_BYTES)), LISTED: "0"}


def run_available(stream: DataFrame, name: str, sink: str | None = None, checkpoint: str | None = None) -> DataFrame:
    """Process all files present now, append to a Parquet sink and return the sink's table."""
    spark = stream.sparkSession
    sink = sink or scratch_path(spark, f"{name}-sink")
    checkpoint = checkpoint or scratch_path(spark, f"{name}-state")
    with settings(spark, **_many_files(spark)):
        query = (
            stream.writeStream.format("parquet").outputMode("append")
            .option("path", sink).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start()
        )
        query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(sink)


def ingest(stream: DataFrame) -> DataFrame:
    """Arriving rows stamped with the time they were taken in."""
    return stream.withColumn("ingest_time", F.current_timestamp())


def refresh_times(table: DataFrame, keys: Sequence[str] = ("device",), ts: str = "datetime") -> DataFrame:
    """Rows, last reading and latest refresh per device of an ingested table."""
    return table.groupBy(*keys).agg(
        F.count("*").alias("n_rows"), F.max(ts).alias("last_reading"), F.max("ingest_time").alias("refreshed_at")
    )


def resample_stream(stream: DataFrame, rule: str, columns: Sequence[str], keys: Sequence[str] = ("location", "device"),
                    ts: str = "datetime", delay: str = "1 hour") -> DataFrame:
    """Bin means, emitted once the watermark has passed the bin; later rows are dropped."""
    return (
        event_time(stream, ts, delay)
        .groupBy(*keys, F.window(ts, rule).alias("_w"))
        .agg(*[F.avg(c).alias(c) for c in columns])
        .select(*keys, F.col("_w.start").alias(ts), *columns)
    )


def dedup_stream(stream: DataFrame, identity: Sequence[str], ts: str = "datetime", delay: str = "1 hour") -> DataFrame:
    """Drop readings delivered again within the watermark delay; later ones than that are dropped unseen."""
    return event_time(stream, ts, delay).dropDuplicatesWithinWatermark(list(identity))


def _stage(stream: DataFrame, change: Callable[[DataFrame], DataFrame], checkpoint: str) -> DataFrame:
    """Write every batch that is there, changed, as a table under its number; all of them, earlier runs' included.

    A batch that runs again replaces what it wrote.
    """
    spark = stream.sparkSession
    each_batch(stream, lambda batch, number: change(batch).write.mode("overwrite").parquet(f"{checkpoint}/parts/{number}"), checkpoint)
    schema = change(spark.createDataFrame([], stream.schema)).schema
    parts = [f"{checkpoint}/parts/{n}" for n in _complete(spark, f"{checkpoint}/parts")]
    return spark.read.schema(schema).parquet(*parts) if parts else spark.createDataFrame([], schema)


STATS = ("count", "mean", "std", "min", "max")


class _Versions:
    """Tables kept from run to run; one that settles again replaces what it wrote."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path

    def read(self, name: str, version: int) -> DataFrame | None:
        return self.spark.read.parquet(f"{self.path}/{name}/{version}") if version >= 0 else None

    def write(self, df: DataFrame, name: str, version: int) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{self.path}/{name}/{version}")
        return self.spark.read.schema(df.schema).parquet(f"{self.path}/{name}/{version}")

    def drop(self, name: str, version: int) -> None:
        if version >= 0:
            delete(self.spark, f"{self.path}/{name}/{version}")


def buckets_available(stream: DataFrame, measurements: Sequence[str], ratings: Sequence[str], minutes: int = 20,
                      keys: Sequence[str] = ("device", "location"), ts: str = "datetime", delay: str = "1 hour",
                      sink: str | None = None, checkpoint: str | None = None, finish: bool = True) -> DataFrame:
    """Greedy rating buckets of everything that has arrived, in whatever order, with their summary.

    The rows of a run are staged batch by batch. Once its backlog is read, they join the
    rows that still wait and go through the batch operator, whose work is split by key and
    time slice; no key's backlog is ever one row or one call. Rows up to the mark (the
    latest time seen less ``delay``) are settled: buckets that end before it are written,
    and the rows of each key's open bucket wait for the next run with those behind the
    mark. Its first row anchors it there as it does here. All rows stay staged: when
    a later run brings a key rows from before the mark, that key is settled anew from all
    its rows, and its buckets replace the earlier ones. With ``finish`` the buckets still
    open are returned too, as they stand; a later run replaces them.
    """
    spark = stream.sparkSession
    sink = sink or scratch_path(spark, "buckets-sink")
    checkpoint = checkpoint or scratch_path(spark, "buckets-state")
    kept = _Versions(spark, f"{checkpoint}/kept")
    width, late = minutes * 60 * 1_000_000, F.expr(f"interval {delay}")
    columns = [*keys, *[f"{c}_{s}" for c in measurements for s in STATS], *ratings, "bucket_start", "bucket_end"]
    have = " and ".join(f"`{c}` is not null" for c in (*keys, ts))

    def settle(rows: DataFrame, mark: object, name: str, batch: int) -> tuple[DataFrame, DataFrame]:
        """Summary of the closed buckets, and the rows that wait; all close if ``mark`` is None."""
        ready = rows if mark is None else rows.where(F.col(ts) <= F.lit(mark))
        marked = kept.write(assign_buckets(ready, ratings, minutes, keys, ts), name, batch)
        if mark is None:
            return summarise_buckets(marked.drop("bucket_start"), measurements, ratings, (*keys, "bucket_id"), ts).select(*columns), ready.limit(0)
        last = broadcast_if_small(marked.groupBy(*keys).agg(F.max("bucket_id").alias("_last")))
        over = (F.col("bucket_id") < F.col("_last")) | (epoch_micros("bucket_start") + width <= epoch_micros(F.lit(mark)))
        judged = marked.join(last, list(keys))
        closed = judged.where(over).drop("bucket_start", "_last")
        waiting = judged.where(~over).select(*rows.columns).unionByName(rows.where(F.col(ts) > F.lit(mark)))
        return summarise_buckets(closed, measurements, ratings, (*keys, "bucket_id"), ts).select(*columns), waiting

    staged = _stage(stream, lambda batch: batch.where(have).withColumn(ts, F.col(ts).cast("timestamp_ntz")), checkpoint)
    staged_numbers = _complete(spark, f"{checkpoint}/parts")
    settled = max(_complete(spark, f"{checkpoint}/kept/mark"), default=-1)
    number = max(staged_numbers, default=-1)
    if number > settled:
        for folder in (f"{sink}/closed", f"{sink}/anew"):  # what a run that broke off has left
            for n in numbers(spark, folder, "batch="):
                if n > settled:
                    delete(spark, f"{folder}/batch={n}")
        rows = spark.read.schema(staged.schema).parquet(*[f"{checkpoint}/parts/{n}" for n in staged_numbers if n > settled])
        mark = None
        if settled >= 0:
            mark = kept.read("mark", settled).first()[0]
            rows.where(F.col(ts) <= F.lit(mark)).select(*keys).distinct().write.mode("overwrite").parquet(f"{sink}/anew/batch={number}")
            anew = broadcast_if_small(spark.read.parquet(f"{sink}/anew/batch={number}"))
            rows = kept.read("waiting", settled).unionByName(rows).join(anew, list(keys), "left_anti").select(*staged.columns)
            rows = rows.unionByName(staged.join(anew, list(keys), "left_semi").select(*staged.columns))
        rows = kept.write(rows, "rows", number)
        latest = rows.agg((F.max(ts) - late).cast("timestamp_ntz")).first()[0]
        mark = max(m for m in (mark, latest, datetime.min) if m is not None)
        closed, waiting = settle(rows, mark, "marked", number)
        closed.write.mode("overwrite").parquet(f"{sink}/closed/batch={number}")
        kept.write(waiting, "waiting", number)
        kept.write(spark.createDataFrame([(mark,)], "mark timestamp_ntz"), "mark", number)
        for name in ("rows", "marked"):
            kept.drop(name, number)
        for name in ("waiting", "mark"):
            kept.drop(name, settled)
    out_schema = _bucket_schema(stream, keys, measurements, ratings)
    if number < 0:
        return spark.createDataFrame([], out_schema)
    done = spark.read.schema(T.StructType([*out_schema, T.StructField("batch", T.IntegerType())])).parquet(f"{sink}/closed")
    if folders(spark, f"{sink}/anew"):
        since = broadcast_if_small(spark.read.parquet(f"{sink}/anew").groupBy(*keys).agg(F.max("batch").alias("_since")))
        done = done.join(since, list(keys), "left").where("_since is null or batch >= _since")
    done = done.select(*columns)
    if not finish:
        return done
    rest, _ = settle(kept.read("waiting", number), None, "open", number)
    rest.write.mode("overwrite").parquet(f"{sink}/open")
    return done.unionByName(spark.read.schema(out_schema).parquet(f"{sink}/open"))


def _bucket_schema(stream: DataFrame, keys: Sequence[str], measurements: Sequence[str], ratings: Sequence[str]) -> T.StructType:
    stat = {"count": T.LongType(), "mean": T.DoubleType(), "std": T.DoubleType()}
    return T.StructType(
        [stream.schema[k] for k in keys]
        + [T.StructField(f"{c}_{s}", stat.get(s, stream.schema[c].dataType)) for c in measurements for s in STATS]
        + [stream.schema[c] for c in ratings]
        + [T.StructField(c, T.TimestampNTZType()) for c in ("bucket_start", "bucket_end")])


def _complete(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the tables below ``path`` that were written to their end."""
    return [n for n in numbers(spark, path) if is_complete(spark, f"{path}/{n}")]
