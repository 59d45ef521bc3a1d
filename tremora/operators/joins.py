"""As-of and interval joins.

A range condition alone would leave Spark a nested loop over all pairs of a key.
The interval join and the as-of join with few ratings spread the interval side over the
fixed bins it touches and join on (key, bin); the range check is only a residual inside one
bin. With many ratings, the as-of join merges both sides in time order within (key, slice) and
carries one rating over to each slice, so silence between ratings costs nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from tremora.functions.time import time_slice
from tremora.operators.timeseries import DAY
from tremora.session import broadcast_if_small


def _neighbour(df: DataFrame, keys: Sequence[str], ts: str, forward: bool, slice_seconds: int) -> DataFrame:
    """Add ``_edge``: the time of the row before (or after) within the key.

    Rows are compared inside (key, slice); across slices one row per slice is enough.
    """
    part = [*keys, "_slice"]
    sliced = df.withColumn("_slice", time_slice(ts, slice_seconds))
    shift, pick = (F.lag, F.max) if forward else (F.lead, F.min)
    inside = shift(ts).over(Window.partitionBy(*part).orderBy(ts))
    ends = sliced.groupBy(*part).agg(pick(ts).alias("_end"))
    outside = ends.select(*part, shift("_end").over(Window.partitionBy(*keys).orderBy("_slice")).alias("_outer"))
    return (
        sliced.withColumn("_inner", inside)
        .join(outside, part)
        .withColumn("_edge", F.coalesce("_inner", "_outer"))
        .drop("_slice", "_inner", "_outer")
    )


def asof_join(left: DataFrame, right: DataFrame, keys: Sequence[str] = ("device",), ts: str = "datetime",
              direction: str = "forward", tie_break: str | None = None,
              bin_seconds: int = 3600, slice_seconds: int = DAY, broadcast_rows: int = 300_000) -> DataFrame:
    """Each left row with the first right row at or after it (or last at or before it).

    All left rows stay. Right rows of equal key and time count once, the smallest
    ``tie_break`` winning. Each right row covers the half-open range from its
    neighbour to itself, so a left row meets at most one of them.
    """
    if direction not in ("forward", "backward"):
        raise ValueError(f"direction must be forward or backward, not {direction}")
    forward = direction == "forward"
    extra = [c for c in right.columns if c not in (*keys, ts)]
    order = F.struct(*([tie_break] if tie_break else extra[:1] or [ts]))
    unique = (
        right.where(F.col(ts).isNotNull())
        .groupBy(*keys, ts)
        .agg(F.min_by(F.struct(ts, *extra), order).alias("_r"))
        .select(*keys, ts, F.struct(*[F.col(f"_r.`{c}`").alias(c) for c in extra]).alias("_r") if extra
                else F.lit(None).alias("_r"))
    )
    spans = _neighbour(unique, keys, ts, forward, slice_seconds).withColumnRenamed(ts, "_at")
    at_bin = time_slice("_at", bin_seconds)
    edge_bin = F.coalesce(time_slice("_edge", bin_seconds), at_bin)
    binned = spans.withColumn(
        "_bin", F.explode(F.sequence(edge_bin, at_bin) if forward else F.sequence(at_bin, edge_bin))
    ).select(*keys, "_bin", "_at", "_edge", "_r")
    # few enough ratings spare the left side its shuffle
    few = broadcast_if_small(binned, max_rows=broadcast_rows)
    if few is binned:
        return _merge_in_order(left, unique, keys, ts, forward, extra, slice_seconds)
    binned = few

    # left rows outside the extent of the right side look into its first or last bin
    extent = unique.groupBy(*keys).agg(
        time_slice(F.min(ts), bin_seconds).alias("_min"), time_slice(F.max(ts), bin_seconds).alias("_max")
    )
    probe = left.join(broadcast_if_small(extent), list(keys), "left").withColumn(
        "_bin", F.least(F.greatest(time_slice(ts, bin_seconds), "_min"), "_max")
    )
    t, at, edge = F.col(f"l.`{ts}`"), F.col("r._at"), F.col("r._edge")
    match = (t <= at) & (edge.isNull() | (t > edge)) if forward else (t >= at) & (edge.isNull() | (t < edge))
    on = F.col("l._bin") == F.col("r._bin")
    for k in keys:
        on = on & (F.col(f"l.`{k}`") == F.col(f"r.`{k}`"))
    return probe.alias("l").join(binned.alias("r"), on & match, "left").select(
        *[F.col(f"l.`{c}`") for c in left.columns],
        *[F.col(f"r._r.`{c}`").alias(c) for c in extra],
    )


def _merge_in_order(left: DataFrame, right: DataFrame, keys: Sequence[str], ts: str, forward: bool, extra: Sequence[str],
                    slice_seconds: int) -> DataFrame:
    """As-of join by running over both sides in time order, slice by slice, with the rating that each slice inherits.

    ``right`` has one row per key and time, its other columns in ``_r``. Rows without key or time meet nothing.
    """
    part = [*keys, "_slice"]
    present = " and ".join(f"`{c}` is not null" for c in (*keys, ts))
    kind = right.schema["_r"].dataType
    found = F.struct(F.col("_r"), F.lit(True).alias("_met")) if extra else F.struct(F.lit(True).alias("_met"))
    ratings = right.where(present).select(*keys, time_slice(ts, slice_seconds).alias("_slice"), F.col(ts).alias("_t"), found.alias("_found"))
    rows = left.where(present).select(*keys, time_slice(ts, slice_seconds).alias("_slice"), F.col(ts).alias("_t"), F.struct(*left.columns).alias("_row"))
    both = rows.withColumn("_found", F.lit(None).cast(ratings.schema["_found"].dataType)).unionByName(
        ratings.withColumn("_row", F.lit(None).cast(rows.schema["_row"].dataType)))
    # at equal times the rating comes first in the direction of the run
    time = F.col("_t").desc() if forward else F.col("_t").asc()
    so_far = Window.partitionBy(*part).orderBy(time, F.col("_row").isNotNull()).rowsBetween(Window.unboundedPreceding, 0)
    inside = both.withColumn("_own", F.last("_found", ignorenulls=True).over(so_far)).where("_row is not null")
    # one row for each key and slice that has rows: the rating nearest to the slice's end, handed to the slices behind it
    nearest = (F.min_by if forward else F.max_by)("_found", F.when(F.col("_found").isNotNull(), F.col("_t")))
    edge = F.col("_slice").desc() if forward else F.col("_slice").asc()
    before = Window.partitionBy(*keys).orderBy(edge).rowsBetween(Window.unboundedPreceding, -1)
    handed = both.groupBy(*part).agg(nearest.alias("_near")).select(*part, F.last("_near", ignorenulls=True).over(before).alias("_handed"))
    joined = inside.join(handed, part).select("_row.*", F.coalesce("_own", "_handed").alias("_met"))
    values = [F.col(f"_met._r.`{c}`").alias(c) for c in extra]
    rest = left.where(f"not ({present})").select("*", *[F.lit(None).cast(kind[c].dataType).alias(c) for c in extra])
    return joined.select(*[F.col(f"`{c}`") for c in left.columns], *values).unionByName(rest)


def interval_join(points: DataFrame, intervals: DataFrame, start: str = "bucket_start", end: str = "bucket_end",
                  keys: Sequence[str] = ("device", "location"), ts: str = "timestamp",
                  bin_seconds: int | None = 1200) -> DataFrame:
    """Points joined to every interval of the same key that contains them, ends included.

    Points with a null key or without an interval are dropped. With bins at least as
    wide as an interval, an interval is copied at most twice. Without bins the keys alone
    are joined and the range is a condition on the pairs, which suits keys with few
    intervals each.
    """
    inside = F.col(ts).between(F.col(start), F.col(end))
    if bin_seconds is None:
        both = points.alias("p").join(intervals.alias("i"), list(keys)).where(inside)
        return both.select(*keys, *[c for c in points.columns if c not in keys], *[c for c in intervals.columns if c not in keys])
    spread = intervals.withColumn(
        "_bin", F.explode(F.sequence(time_slice(start, bin_seconds), time_slice(end, bin_seconds)))
    )
    binned = points.withColumn("_bin", time_slice(ts, bin_seconds))
    return (
        binned.join(spread, [*keys, "_bin"])
        .where(F.col(ts).between(F.col(start), F.col(end)))
        .drop("_bin")
    )
