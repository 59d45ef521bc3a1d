"""Duplicate removal of a stream against all that ever came, opening only what may hold a repeat.

Kept rows lie in hash buckets of their identity. Beside each bucket stand Bloom filters of the
identities it holds: a filter that has taken in its number of identities is followed by one of
twice the size. A row that no filter of its bucket knows is new for certain; only for the others
are the rows of their buckets opened and compared, so a filter's error costs a look and never a row.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tremora.session import scratch_path
from tremora.streaming.tables import delete, each_batch, is_complete, latest, numbers

BUCKETS = 64
FIRST = 1 << 14  # identities of a bucket's first filter
BITS, HASHES = 12, 8  # bits for each identity and places it sets: about 3 in 1 000 strangers seem known

_FILTER = pa.schema([("_bucket", pa.int32()), ("place", pa.int32()), ("many", pa.int64()), ("room", pa.int64()), ("bits", pa.binary())])
_FILTER_DDL = "_bucket int, place int, many long, room long, bits binary"


def _places(h1: np.ndarray, h2: np.ndarray, size: int) -> np.ndarray:
    step = np.arange(HASHES, dtype=np.uint64)[:, None]
    return (h1.view(np.uint64)[None, :] + step * (h2.view(np.uint64) | np.uint64(1))[None, :]) % np.uint64(size)


def _knows(bits: np.ndarray, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    at = _places(h1, h2, 8 * len(bits))
    return ((bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1).all(axis=0)


def _learn(bits: np.ndarray, h1: np.ndarray, h2: np.ndarray) -> None:
    at = _places(h1, h2, 8 * len(bits))
    np.bitwise_or.at(bits, at >> np.uint64(3), np.left_shift(1, (at & np.uint64(7)).astype(np.uint8)).astype(np.uint8))


def _hashes(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    return table["_h1"].to_numpy().astype(np.int64), table["_h2"].to_numpy().astype(np.int64)


def _maybe_known(key: tuple, rows: pa.Table, filters: pa.Table) -> pa.Table:
    """Identities of a bucket that one of its filters knows."""
    h1, h2 = _hashes(rows)
    known = np.zeros(len(h1), bool)
    for bits in filters["bits"]:
        known |= _knows(np.frombuffer(bits.as_buffer(), np.uint8), h1, h2)
    return rows.filter(pa.array(known))


def _with_rows(key: tuple, rows: pa.Table, filters: pa.Table) -> pa.Table:
    """A bucket's filters once they have taken in the rows."""
    h1, h2 = _hashes(rows)
    bucket = key[0].as_py() if hasattr(key[0], "as_py") else key[0]
    out = sorted(filters.to_pylist(), key=lambda r: r["place"])
    while len(h1):
        if not out or out[-1]["many"] >= out[-1]["room"]:
            room = 2 * out[-1]["room"] if out else FIRST
            out.append({"_bucket": bucket, "place": len(out), "many": 0, "room": room, "bits": bytes(-(-room * BITS // 8))})
        own = out[-1]
        take = min(len(h1), own["room"] - own["many"])
        bits = np.frombuffer(own["bits"], np.uint8).copy()
        _learn(bits, h1[:take], h2[:take])
        own["bits"], own["many"] = bits.tobytes(), own["many"] + take
        h1, h2 = h1[take:], h2[take:]
    return pa.Table.from_pylist(out, schema=_FILTER)


def bucket_rows(spark: SparkSession, sink: str, schema: T.StructType, upto: int, buckets: Sequence[int] | None = None) -> DataFrame:
    """Rows kept by runs up to number ``upto``; of some buckets, whose files alone are opened."""
    stored = T.StructType([*schema, T.StructField("_run", T.LongType()), T.StructField("_bucket", T.IntegerType())])
    rows = spark.read.schema(stored).parquet(f"{sink}/rows").where(F.col("_run") <= upto)
    if buckets is not None:
        rows = rows.where(F.col("_bucket").isin(list(buckets)))
    return rows.select(*schema.names)


def dedup_available(stream: DataFrame, identity: Sequence[str], sink: str | None = None, checkpoint: str | None = None,
                    buckets: int = BUCKETS) -> DataFrame:
    """One row of each identity of everything that has arrived, however late or often it comes.

    The batches of a run are settled together. Its rows meet the filters of their buckets, each bucket in one
    task with two numbers a row; ``buckets`` should grow with the identities expected (a filter takes
    BITS bits for each) and stay the same for a sink. A run that breaks off is done again and replaces
    what it had written. Nulls in an identity equal each other.
    """
    spark = stream.sparkSession
    sink = sink or scratch_path(spark, "dedup-sink")
    checkpoint = checkpoint or scratch_path(spark, "dedup-state")
    each_batch(stream, lambda batch, n: batch.dropDuplicates(list(identity)).write.mode("overwrite").parquet(f"{checkpoint}/parts/{n}"), checkpoint)
    done = latest(spark, f"{sink}/filters")
    fresh = [n for n in numbers(spark, f"{checkpoint}/parts") if n > done and is_complete(spark, f"{checkpoint}/parts/{n}")]
    if fresh:
        _settle(spark, stream.schema, [f"{checkpoint}/parts/{n}" for n in fresh], list(identity), sink, checkpoint, done, fresh[-1], buckets)
        for n in numbers(spark, f"{checkpoint}/parts"):
            if n <= fresh[-1]:
                delete(spark, f"{checkpoint}/parts/{n}")
        done = fresh[-1]
    return bucket_rows(spark, sink, stream.schema, done) if done >= 0 else spark.createDataFrame([], stream.schema)


def _settle(spark: SparkSession, schema: T.StructType, parts: list[str], identity: list[str], sink: str, checkpoint: str,
            done: int, run: int, buckets: int) -> None:
    """Append the rows of a run that are new and take them into the filters, whose table tells that the run is complete."""
    h1, h2 = F.xxhash64(*identity), F.xxhash64(F.lit("second"), *identity)
    rows = spark.read.schema(schema).parquet(*parts).dropDuplicates(identity)
    rows = rows.withColumns({"_h1": h1, "_h2": h2, "_bucket": F.pmod(F.xxhash64(h1, h2), F.lit(buckets)).cast("int")})
    rows.write.mode("overwrite").parquet(f"{checkpoint}/run")
    rows = spark.read.parquet(f"{checkpoint}/run")
    marks = rows.select("_bucket", "_h1", "_h2")
    filters = spark.read.schema(_FILTER_DDL).parquet(f"{sink}/filters/{done}") if done >= 0 else spark.createDataFrame([], _FILTER_DDL)
    new = rows
    if done >= 0:
        maybe = marks.groupBy("_bucket").cogroup(filters.groupBy("_bucket")).applyInArrow(_maybe_known, marks.schema)
        maybe.write.mode("overwrite").parquet(f"{checkpoint}/maybe")
        maybe = spark.read.schema(marks.schema).parquet(f"{checkpoint}/maybe")
        opened = sorted(r[0] for r in maybe.select("_bucket").distinct().collect())  # at most ``buckets`` numbers
        if opened:
            pair = ["_bucket", "_h1", "_h2"]
            known = bucket_rows(spark, sink, schema, done, opened).select(*[F.col(c).alias(f"_known_{c}") for c in identity])
            same = [F.col(c).eqNullSafe(F.col(f"_known_{c}")) for c in identity]
            maybe = maybe.distinct()
            new = rows.join(maybe, pair, "left_anti").unionByName(rows.join(maybe, pair, "left_semi").join(known, same, "left_anti"))
    new.select(*schema.names, "_h1", "_h2", "_bucket").write.mode("overwrite").parquet(f"{checkpoint}/new")
    new = spark.read.parquet(f"{checkpoint}/new")
    new.drop("_h1", "_h2").write.mode("overwrite").partitionBy("_bucket").parquet(f"{sink}/rows/_run={run}")
    grown = new.select("_bucket", "_h1", "_h2").groupBy("_bucket").cogroup(filters.groupBy("_bucket")).applyInArrow(_with_rows, _FILTER_DDL)
    grown.write.mode("overwrite").parquet(f"{sink}/filters/{run}")
    if done >= 0:
        for n in numbers(spark, f"{sink}/filters"):
            if n < done:
                delete(spark, f"{sink}/filters/{n}")
