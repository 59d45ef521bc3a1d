"""Bin means of a stream, kept as partial sums in levels.

Every micro-batch leaves the sums and counts of its bins as one part. ``FAN`` parts of a level are
merged to one of the next, so a sum is rewritten once a level, and what a run does follows its
new rows. Which parts are current is told by the latest complete table of the folder
``current``: a reader takes that list, and the parts of the list before it stay until the run after
next, so a reader never meets a missing table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from tremora.session import scratch_path
from tremora.streaming.tables import delete, each_batch, is_complete, latest, numbers

FAN = 8
_LIST = "name string, level int, n_rows long"


def _sums(columns: Sequence[str]) -> list[str]:
    return [f"_{kind}{i}" for i in range(len(columns)) for kind in "sn"]


def current_parts(spark: SparkSession, sink: str) -> list[tuple[str, int, int]]:
    """(name, level, rows) of the parts that make up the table now."""
    now = latest(spark, f"{sink}/current")
    return sorted(tuple(r) for r in spark.read.schema(_LIST).parquet(f"{sink}/current/{now}").collect()) if now >= 0 else []


def _added(spark: SparkSession, sink: str, names: Sequence[str], keys: Sequence[str], ts: str, columns: Sequence[str]) -> DataFrame:
    parts = spark.read.parquet(*[f"{sink}/parts/{n}" for n in names])
    return parts.groupBy(*keys, ts).agg(*[F.sum(c).alias(c) for c in _sums(columns)])


def _publish(spark: SparkSession, sink: str, number: int, keys: Sequence[str], ts: str, columns: Sequence[str]) -> None:
    """Take in the parts of new batches, merge full levels, and point readers to the outcome."""
    before = latest(spark, f"{sink}/current", number)
    parts = {n: (level, rows) for n, level, rows in current_parts(spark, sink)} if before >= 0 else {}
    old = set(parts)
    for n in numbers(spark, f"{sink}/parts", "0-"):
        if before < n <= number and is_complete(spark, f"{sink}/parts/0-{n}"):
            parts[f"0-{n}"] = (0, spark.read.parquet(f"{sink}/parts/0-{n}").count())
    level = 0
    while any(at >= level for at, _ in parts.values()):
        own = sorted(n for n, (at, _) in parts.items() if at == level)
        if len(own) >= FAN:
            name = f"{level + 1}-{number}"
            _added(spark, sink, own, keys, ts, columns).write.mode("overwrite").parquet(f"{sink}/parts/{name}")
            for n in own:
                del parts[n]
            parts[name] = (level + 1, spark.read.parquet(f"{sink}/parts/{name}").count())
        level += 1
    rows = [(n, at, many) for n, (at, many) in sorted(parts.items())]
    spark.createDataFrame(rows, _LIST).coalesce(1).write.mode("overwrite").parquet(f"{sink}/current/{number}")
    # parts of the list before last, which no reader holds any more
    for gone in numbers(spark, f"{sink}/current"):
        if gone < before:
            names = [r[0] for r in spark.read.schema(_LIST).parquet(f"{sink}/current/{gone}").collect()]
            for n in names:
                if n not in parts and n not in old:
                    delete(spark, f"{sink}/parts/{n}")
            delete(spark, f"{sink}/current/{gone}")


def read_bins(spark: SparkSession, sink: str, columns: Sequence[str], keys: Sequence[str] = ("location", "device"),
              ts: str = "datetime") -> DataFrame | None:
    """Bin means as they stand: the current parts, at most FAN of each level, added up. None before the first run."""
    parts = current_parts(spark, sink)
    if not parts:
        return None
    total = _added(spark, sink, [n for n, _, _ in parts], keys, ts, columns)
    return total.select(*keys, ts, *[F.try_divide(f"_s{i}", f"_n{i}").alias(c) for i, c in enumerate(columns)])


def resample_available(stream: DataFrame, rule: str, columns: Sequence[str], keys: Sequence[str] = ("location", "device"),
                       ts: str = "datetime", sink: str | None = None, checkpoint: str | None = None) -> DataFrame:
    """Bin means of everything that has arrived, in whatever order, over all runs with this sink.

    Sums add up over batches and runs, so no row is ever late. A batch that runs again replaces its part.
    """
    spark = stream.sparkSession
    sink = sink or scratch_path(spark, "resample-sink")
    checkpoint = checkpoint or scratch_path(spark, "resample-state")
    sums = [e for i, c in enumerate(columns) for e in (F.sum(F.col(c).cast("double")).alias(f"_s{i}"), F.count(c).alias(f"_n{i}"))]

    def partial(batch: DataFrame) -> DataFrame:
        binned = batch.withColumn(ts, F.col(ts).cast("timestamp")).groupBy(*keys, F.window(ts, rule).alias("_w"))
        return binned.agg(*sums).select(*keys, F.col("_w.start").alias(ts), *_sums(columns))

    each_batch(stream, lambda batch, n: partial(batch).write.mode("overwrite").parquet(f"{sink}/parts/0-{n}"), checkpoint)
    done = max(numbers(spark, f"{sink}/parts", "0-"), default=-1)
    if done > latest(spark, f"{sink}/current"):
        _publish(spark, sink, done, keys, ts, columns)
    means = read_bins(spark, sink, columns, keys, ts)
    if means is None:
        empty = partial(spark.createDataFrame([], stream.schema))
        means = empty.select(*keys, ts, *[F.try_divide(f"_s{i}", f"_n{i}").alias(c) for i, c in enumerate(columns)])
    return means
