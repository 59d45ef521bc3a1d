"""Greedy rating buckets.

Within a key, in time order, a new bucket opens when the rating tuple changes or
when a row lies at least the bucket width after the bucket's first row; the next
bucket is anchored at that row. The rule is sequential, but what a time slice does
to it depends only on one number: the time at which the running bucket expires.
So it runs in three steps:

1. every (key, slice) works out, for each row that could open its first bucket,
   when the last bucket of the slice would expire and how many buckets it holds;
2. the slices of a key, a calendar's worth of short lists, are chained;
3. every (key, slice), now knowing the expiry it starts with, marks its anchors.

Steps 1 and 3 are parallel over (key, slice), so a key with most of the rows, or
years of constant ratings, still splits into slices.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from tremora.functions.time import epoch_micros, from_micros, time_slice
from tremora.operators.timeseries import DAY
from tremora.session import broadcast_if_small, materialise

NEVER = np.iinfo(np.int64).max


def _next_anchor(t: np.ndarray, breaks: np.ndarray, width: int) -> np.ndarray:
    """For each row, the row that opens the bucket after one anchored there."""
    m = len(t)
    expires = np.searchsorted(t, t + width, side="left")
    at = np.where(breaks, np.arange(m), m)
    from_here = np.append(np.minimum.accumulate(at[::-1])[::-1], m)
    return np.minimum(expires, from_here[1:])


def _in_order(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Times and break flags of a slice, by time."""
    t = table["_t"].to_numpy()
    breaks = table["_break"].to_numpy(zero_copy_only=False)
    if (t[1:] < t[:-1]).any():
        order = np.argsort(t, kind="stable")
        t, breaks = t[order], breaks[order]
    return t, breaks


def _one_row(table: pa.Table, keep: Sequence[str], lists: dict[str, np.ndarray]) -> pa.Table:
    out = table.select(list(keep)).slice(0, 1)
    for name, values in lists.items():
        out = out.append_column(name, pa.array([values], pa.list_(pa.int64())))
    return out


def _slice_exits(part: Sequence[str], width: int):
    """Step 1: entry time -> (expiry after the slice, buckets opened in it)."""
    def run(table: pa.Table) -> pa.Table:
        t, breaks = _in_order(table)
        m = len(t)
        nxt = _next_anchor(t, breaks, width)
        ends = nxt >= m
        last = np.where(ends, np.arange(m), nxt)
        opened = np.where(ends, 0, 1)
        while True:  # pointer doubling
            further = last[last]
            if np.array_equal(further, last):
                break
            opened = opened + opened[last]
            last = further
        # any earlier bucket expires before the slice start plus the width
        limit = table["_from"][0].as_py() + width
        reach = min(int(np.searchsorted(t, limit, side="left")), m - 1)
        first_break = int(np.argmax(breaks)) if breaks.any() else m
        upto = min(reach, first_break)
        entry = t[: upto + 1].copy()
        if first_break == upto:
            entry[upto] = NEVER
        return _one_row(table, part, {
            "_times": t, "_breaks": t[breaks],
            "_entry": entry, "_exit": t[last[: upto + 1]] + width, "_opened": opened[: upto + 1] + 1,
        })
    return run


def _chain(part: Sequence[str]):
    """Step 2: the expiry and bucket count each slice of one key starts with."""
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("_slice").combine_chunks()
        heads = table["_head"].to_pylist()
        offsets = table["_entry"].chunk(0).offsets.to_numpy()
        entry, exit_, opened = (table[c].chunk(0).values.to_numpy() for c in ("_entry", "_exit", "_opened"))
        expiry, count, expiries, counts = None, 0, [], []
        for head, lo, hi in zip(heads, offsets[:-1], offsets[1:]):
            expiries.append(expiry)
            counts.append(count)
            j = lo if head or expiry is None else lo + int(np.searchsorted(entry[lo:hi], expiry, side="left"))
            if j < hi:
                expiry, count = int(exit_[j]), count + int(opened[j])
        out = table.select([*part, "_head"])
        out = out.append_column("_expiry", pa.array(expiries, pa.int64()))
        return out.append_column("_before", pa.array(counts, pa.int64()))
    return run


def _clock_anchors(t: np.ndarray, breaks: np.ndarray, head: bool, expiry: int | None, width: int) -> list[int]:
    """Anchors of a slice that are due to the clock and not to a rating change."""
    nxt = _next_anchor(t, breaks, width)
    if head or expiry is None:
        i = 0
    else:
        i = int(np.searchsorted(t, expiry, side="left"))
        if breaks.any():
            i = min(i, int(np.argmax(breaks)))
    anchors = []
    while i < len(t):
        if not breaks[i]:
            anchors.append(int(t[i]))
        i = int(nxt[i])
    return anchors


def _slice_timers(part: Sequence[str], width: int):
    """Step 3, one row per slice."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for i in range(batch.num_rows):
                t, changed = (batch.column(c)[i].values.to_numpy() for c in ("_times", "_breaks"))
                head, expiry = batch.column("_head")[i].as_py(), batch.column("_expiry")[i].as_py()
                out.append(_clock_anchors(t, np.isin(t, changed), head, expiry, width))
            kept = [batch.column(c) for c in (*part, "_expiry", "_before")]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(out, pa.list_(pa.int64()))], [*part, "_expiry", "_before", "_timers"]
            )
    return run


def assign_buckets(df: DataFrame, ratings: Sequence[str], minutes: int = 20,
                   keys: Sequence[str] = ("device", "location"), ts: str = "datetime",
                   null_breaks: bool = False, slice_seconds: int = DAY, broadcast_rows: int = 50_000) -> DataFrame:
    """Add ``bucket_id`` (1, 2, ... per key) and ``bucket_start`` to every row.

    Ratings compare null-safe; with ``null_breaks`` a null never equals anything, so
    each row holding one opens a bucket. Rows without key or time are dropped. One
    row per key and time is expected, as the pivot produces.
    """
    width = minutes * 60 * 1_000_000
    # what is chained per key are the rows within one width of a slice's start: an eighth of them at most
    slice_seconds = max(slice_seconds, 8 * minutes * 60)
    part = [*keys, "_slice"]
    part_schema = [T.StructField(k, df.schema[k].dataType) for k in keys] + [T.StructField("_slice", T.LongType())]

    have = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in (*keys, ts)])
    in_order = Window.partitionBy(*part).orderBy(ts)
    rating = F.struct(*ratings)
    any_null = reduce(lambda a, b: a | b, [F.col(r).isNull() for r in ratings], F.lit(False)) if null_breaks else F.lit(False)
    rows = df.where(have).withColumn("_slice", time_slice(ts, slice_seconds)).withColumn("_t", epoch_micros(ts))
    rows = rows.withColumn(
        "_break",
        (F.row_number().over(in_order) > 1)
        & (~F.lag(rating).over(in_order).eqNullSafe(rating) | any_null),
    )

    # does the first row of a slice change the rating left by the slice before it?
    edges = rows.groupBy(*part).agg(
        F.min_by(rating, "_t").alias("_first"),
        F.max_by(rating, "_t").alias("_last"),
        F.min_by(any_null, "_t").alias("_first_null"),
    )
    by_slice = Window.partitionBy(*keys).orderBy("_slice")
    heads = edges.select(
        *part,
        ((F.row_number().over(by_slice) == 1)
         | ~F.lag("_last").over(by_slice).eqNullSafe(F.col("_first"))
         | F.col("_first_null")).alias("_head"),
    )

    longs = T.ArrayType(T.LongType())
    thin = rows.select(*part, "_t", "_break", (F.col("_slice") * slice_seconds * 1_000_000).alias("_from"))
    exits = materialise(thin.groupBy(*part).applyInArrow(
        _slice_exits(part, width),
        T.StructType(part_schema + [T.StructField(c, longs) for c in ("_times", "_breaks", "_entry", "_exit", "_opened")]),
    ), "bucket-slices")
    chain_schema = [T.StructField("_expiry", T.LongType()), T.StructField("_before", T.LongType())]
    chained = exits.drop("_times", "_breaks").join(heads, part).groupBy(*keys).applyInArrow(
        _chain(part), T.StructType(part_schema + [T.StructField("_head", T.BooleanType())] + chain_schema)
    )
    chained = broadcast_if_small(materialise(chained, "bucket-chain"), max_rows=broadcast_rows)
    state = exits.select(*part, "_times", "_breaks").join(chained, part).mapInArrow(
        _slice_timers(part, width), T.StructType(part_schema + chain_schema + [T.StructField("_timers", longs)])
    )
    # one row per key and slice; broadcast, it leaves the sorted rows where they are
    state = broadcast_if_small(state, max_rows=broadcast_rows)

    so_far = in_order.rowsBetween(Window.unboundedPreceding, 0)
    marked = rows.join(state, part).withColumn(
        "_anchor", F.col("_break") | F.array_contains("_timers", F.col("_t"))
    )
    opened = F.sum(F.col("_anchor").cast("long")).over(so_far)
    start = F.last(F.when(F.col("_anchor"), F.col("_t")), ignorenulls=True).over(so_far)
    return marked.select(
        *df.columns,
        (F.col("_before") + opened).alias("bucket_id"),
        from_micros(F.coalesce(start, F.col("_expiry") - width)).alias("bucket_start"),
    )


def summarise_buckets(df: DataFrame, measurements: Sequence[str], ratings: Sequence[str],
                      keys: Sequence[str] = ("device", "location", "bucket_id"),
                      ts: str = "datetime") -> DataFrame:
    """Count, mean, std, min and max per measurement, first non-null ratings, time extent."""
    stats = [
        f(c).alias(f"{c}_{n}")
        for c in measurements
        for n, f in (("count", F.count), ("mean", F.avg), ("std", F.stddev_samp), ("min", F.min), ("max", F.max))
    ]
    first = [F.min_by(r, F.when(F.col(r).isNotNull(), F.col(ts))).alias(r) for r in ratings]
    return df.groupBy(*keys).agg(*stats, *first, F.min(ts).alias("bucket_start"), F.max(ts).alias("bucket_end"))
