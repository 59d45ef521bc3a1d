"""Rating buckets of a live stream: open time slices in the state store, closed ones settled batch by batch.

The state is keyed by (key, slice of time), so a key with most of the rows is held by many
tasks. It has the rows of open slices only. When the watermark has passed a slice, its timer hands
the rows on and clears the state. A micro-batch then settles the slices that closed in it with the
batch operator, itself split by key and slice, together with the rows of each key's open bucket,
which are the only ones that wait outside the state store.
"""

from __future__ import annotations

import io
from collections.abc import Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tremora.functions.time import epoch_micros, from_micros
from tremora.operators.buckets import assign_buckets, summarise_buckets
from tremora.session import broadcast_if_small, scratch_path
from tremora.streaming.tables import delete, each_batch, latest

ROCKS = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}
STATS = ("count", "mean", "std", "min", "max")


def _packed(df: pd.DataFrame) -> bytes:
    batch = pa.RecordBatch.from_pandas(df, preserve_index=False)
    out = io.BytesIO()
    with pa.ipc.new_stream(out, batch.schema) as writer:
        writer.write_batch(batch)
    return out.getvalue()


def _unpacked(chunk: bytes) -> pa.Table:
    return pa.ipc.open_stream(chunk).read_all()


class OpenSlices(StatefulProcessor):
    """Rows of one (key, slice), a packed chunk for each batch, until the slice's end has passed."""

    def __init__(self, columns: Sequence[str], seconds: int) -> None:
        self.columns, self.seconds = list(columns), seconds

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.chunks = handle.getListState("chunks", "chunk binary")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        for df in rows:
            self.chunks.appendValue((_packed(df[self.columns]),))
        self.handle.registerTimer((int(key[-1]) + 1) * self.seconds * 1000)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        tables = [_unpacked(bytes(chunk[0])) for chunk in self.chunks.get()]
        self.chunks.clear()
        if tables:
            yield pa.concat_tables(tables, promote_options="permissive").to_pandas()[self.columns]

    def close(self) -> None:
        pass


def _timed(stream: DataFrame, keys: Sequence[str], columns: Sequence[str], ts: str, delay: str, seconds: int) -> DataFrame:
    """Rows with keys and time under a watermark, with their time in microseconds and their slice."""
    have = " and ".join(f"`{c}` is not null" for c in (*keys, ts))
    micros = epoch_micros(F.col("live_at"))
    return (
        stream.where(have).withColumn("live_at", F.col(ts).cast("timestamp"))
        .select(*keys, "live_at", micros.alias("live_micros"), *columns,
                ((micros - F.pmod(micros, F.lit(seconds * 1_000_000))) / (seconds * 1_000_000)).cast("long").alias("live_slice"))
        .withWatermark("live_at", delay)
    )


def open_rows(spark: SparkSession, checkpoint: str, schema: T.StructType) -> DataFrame:
    """The rows that the state store of a finished run holds."""
    state = spark.read.format("statestore").option("stateVarName", "chunks").load(f"{checkpoint}/query")
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for chunk in b.column("chunk"):
                t = _unpacked(chunk.as_py())
                yield from t.select(names).to_batches()

    return state.select("list_element.chunk").mapInArrow(run, schema)


def buckets_live(stream: DataFrame, measurements: Sequence[str], ratings: Sequence[str], minutes: int = 20,
                 keys: Sequence[str] = ("device", "location"), ts: str = "datetime", delay: str = "1 hour",
                 sink: str | None = None, checkpoint: str | None = None, finish: bool = True,
                 slice_minutes: int | None = None, late: str = "fail") -> DataFrame:
    """Summary of the greedy rating buckets of a stream whose rows come at most ``delay`` out of order.

    A run reads what is new; its work follows the new rows and the open buckets, not the
    history. State is kept in ``checkpoint``, buckets that have closed in ``sink``; a run that
    breaks off is done again from its last complete batch, and replaces what that had begun. With
    ``finish`` the buckets still open are returned too, as they stand.

    Rows later than ``delay`` cannot change a closed slice: the run fails with their number, or
    leaves them out with ``late="drop"``. ``buckets_available`` takes rows in any order instead.
    Times are read as UTC; a NaN counts as null. Rows without key or time are left out.
    """
    spark = stream.sparkSession
    sink = sink or scratch_path(spark, "live-sink")
    checkpoint = checkpoint or scratch_path(spark, "live-state")
    seconds, width = 60 * (slice_minutes or 6 * minutes), minutes * 60 * 1_000_000
    columns = [*measurements, *ratings]
    schema = T.StructType([*(T.StructField(k, stream.schema[k].dataType) for k in keys), T.StructField("live_micros", T.LongType()),
                           *(T.StructField(c, stream.schema[c].dataType) for c in columns)])
    summary_columns = [*keys, *[f"{c}_{s}" for c in measurements for s in STATS], *ratings, "bucket_start", "bucket_end"]

    def summary(rows: DataFrame) -> DataFrame:
        found = summarise_buckets(rows, measurements, ratings, (*keys, "bucket_id"), ts).select(*summary_columns)
        return found.withColumns({f"{c}_{s}": F.col(f"{c}_{s}").cast("double") for c in measurements for s in ("mean", "std")})

    def settle(batch: DataFrame, number: int) -> None:
        closing = f"{checkpoint}/closing/{number}"
        batch.write.mode("overwrite").parquet(closing)  # the state is read once a batch
        rows = spark.read.schema(schema).parquet(closing)
        upto = rows.agg(F.max("live_micros")).first()[0]
        if upto is not None:
            upto = (upto // (seconds * 1_000_000) + 1) * seconds * 1_000_000  # all slices up to here have closed
            before = latest(spark, f"{checkpoint}/waiting", number)
            if before >= 0:
                rows = rows.unionByName(spark.read.schema(schema).parquet(f"{checkpoint}/waiting/{before}"))
            marked = f"{checkpoint}/marked/{number}"
            assign_buckets(rows.withColumn(ts, from_micros(F.col("live_micros"))), ratings, minutes, keys, ts).write.mode("overwrite").parquet(marked)
            marked = spark.read.parquet(marked)
            last = broadcast_if_small(marked.groupBy(*keys).agg(F.max("bucket_id").alias("_last")))
            judged = marked.join(last, list(keys))
            over = (F.col("bucket_id") < F.col("_last")) | (epoch_micros("bucket_start") + width <= upto)
            summary(judged.where(over).drop("bucket_start", "_last")).write.mode("overwrite").parquet(f"{sink}/_batch={number}")
            judged.where(~over).select(*schema.names).write.mode("overwrite").parquet(f"{checkpoint}/waiting/{number}")
            for n in (n for n in (before,) if n >= 0):
                delete(spark, f"{checkpoint}/waiting/{n}")
            delete(spark, f"{checkpoint}/marked/{number}")
        delete(spark, closing)

    slices = _timed(stream, keys, columns, ts, delay, seconds).groupBy(*keys, "live_slice").transformWithStateInPandas(
        OpenSlices(schema.names, seconds), schema, "append", "EventTime")
    query = each_batch(slices, settle, checkpoint, **ROCKS)
    dropped = sum(o.get("numRowsDroppedByWatermark", 0) for p in query.recentProgress for o in p["stateOperators"])
    if dropped and late == "fail":
        raise ValueError(f"{dropped} rows came later than {delay}; the buckets they belong to have closed")

    stat = {"count": T.LongType(), "mean": T.DoubleType(), "std": T.DoubleType()}
    out = T.StructType(
        [stream.schema[k] for k in keys]
        + [T.StructField(f"{c}_{s}", stat.get(s, stream.schema[c].dataType)) for c in measurements for s in STATS]
        + [stream.schema[c] for c in ratings]
        + [T.StructField(c, T.TimestampNTZType()) for c in ("bucket_start", "bucket_end")])
    waiting = latest(spark, f"{checkpoint}/waiting")
    done = spark.createDataFrame([], out)
    if waiting >= 0:
        done = spark.read.schema(T.StructType([*out, T.StructField("_batch", T.IntegerType())])).parquet(sink).select(*out.names)
    if not finish:
        return done
    rows = open_rows(spark, checkpoint, schema)
    if waiting >= 0:
        rows = rows.unionByName(spark.read.schema(schema).parquet(f"{checkpoint}/waiting/{waiting}"))
    rest = summary(assign_buckets(rows.withColumn(ts, from_micros(F.col("live_micros"))), ratings, minutes, keys, ts).drop("bucket_start"))
    rest.write.mode("overwrite").parquet(f"{checkpoint}/open")
    return done.unionByName(spark.read.schema(out).parquet(f"{checkpoint}/open"))
