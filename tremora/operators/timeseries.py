"""Forward fill, adaptive resampling, overlay series and fixed-length sequences."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, Window, functions as F

from tremora.functions.time import epoch_micros, time_slice
from tremora.operators.reshape import to_long

DAY = 86_400


def forward_fill(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = ("device", "location"),
                 ts: str = "datetime", slice_seconds: int = DAY) -> DataFrame:
    """Last non-null value at or before each row, per key.

    Windows run on (key, slice) and the last value of each earlier slice is carried
    over through a table of one row per key and slice, so the busiest key is spread
    over as many tasks as it has slices.
    """
    sliced = df.withColumn("_slice", time_slice(ts, slice_seconds))
    part = [*keys, "_slice"]
    last = sliced.groupBy(*part).agg(
        *[F.max_by(c, F.when(F.col(c).isNotNull(), F.col(ts))).alias(f"_in_{c}") for c in columns]
    )
    earlier = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    carry = last.select(*part, *[F.last(f"_in_{c}", ignorenulls=True).over(earlier).alias(f"_in_{c}") for c in columns])
    so_far = Window.partitionBy(*part).orderBy(ts).rowsBetween(Window.unboundedPreceding, 0)
    filled = sliced.withColumns({c: F.last(c, ignorenulls=True).over(so_far) for c in columns})
    return (
        filled.join(carry, part, "left")
        .withColumns({c: F.coalesce(c, f"_in_{c}") for c in columns})
        .select(*df.columns)
    )


def resample_rule(start: datetime, end: datetime) -> str | None:
    """Bin width by the length of the chosen range: none, 5 or 15 minutes."""
    span = end - start
    if span <= timedelta(hours=1):
        return None
    return "5 minutes" if span <= timedelta(days=1) else "15 minutes"


def resample(df: DataFrame, rule: str, columns: Sequence[str],
             keys: Sequence[str] = ("location", "device"), ts: str = "datetime") -> DataFrame:
    """Mean per key and bin; only bins that hold rows."""
    return (
        df.where(F.col(ts).isNotNull())
        .groupBy(*keys, F.window(ts, rule).alias("_w"))
        .agg(*[F.avg(c).alias(c) for c in columns])
        .select(*keys, F.col("_w.start").alias(ts), *columns)
    )


def fill_gaps(binned: DataFrame, rule: str, keys: Sequence[str] = ("location", "device"),
              ts: str = "datetime") -> DataFrame:
    """Add null rows for the empty bins between a key's first and last bin.

    Each bin produces the empty ones up to its successor, so no table of all bins
    is built and joined.
    """
    following = F.lead(ts).over(Window.partitionBy(*keys).orderBy(ts))
    step = F.expr(f"interval {rule}")
    bins = binned.withColumn("_next", F.coalesce(following - step, F.col(ts)))
    grid = bins.withColumn("_bin", F.explode(F.sequence(ts, "_next", step)))
    values = [c for c in binned.columns if c not in (*keys, ts)]
    return grid.select(
        *keys,
        F.col("_bin").alias(ts),
        *[F.when(F.col("_bin") == F.col(ts), F.col(c)).alias(c) for c in values],
    ).select(*binned.columns)


def resample_adaptive(df: DataFrame, start: datetime, end: datetime, columns: Sequence[str],
                      keys: Sequence[str] = ("location", "device"), ts: str = "datetime",
                      gaps: bool = False) -> DataFrame:
    """Closed range filter, then means on bins as wide as the range asks for."""
    rule = resample_rule(start, end)
    chosen = df.where(F.col(ts).between(F.lit(start).cast(df.schema[ts].dataType),
                                        F.lit(end).cast(df.schema[ts].dataType)))
    if rule is None:
        return chosen.select(*keys, ts, *columns)
    binned = resample(chosen, rule, columns, keys, ts)
    return fill_gaps(binned, rule, keys, ts) if gaps else binned


def overlay_series(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = ("location",),
                   ts: str = "datetime") -> DataFrame:
    """Ordered (series, key, time, value) points of the chosen columns that exist."""
    return to_long(df, columns, [*keys, ts], "series", "value").orderBy("series", *keys, ts)


def sequence_windows(df: DataFrame, features: Sequence[str], window_col: str = "bucket_start",
                     keys: Sequence[str] = ("device", "location"), ts: str = "datetime",
                     steps: int = 240, step_seconds: int = 5) -> DataFrame:
    """One fixed-length array of feature structs per window.

    Readings are averaged per step first (partial sums before the shuffle), so a
    window never gathers more than ``steps`` rows. Missing steps repeat the value
    before them; steps after the last reading, or before any value, are zero. A reading
    that does not fit into ``steps`` steps from its window's start fails the job.
    """
    offset = (epoch_micros(ts) - epoch_micros(window_col)) / F.lit(step_seconds * 1_000_000)
    window = [*keys, window_col]
    stepped = (
        df.where(offset.isNotNull()).withColumn("_step", F.when(offset.between(0, steps) & (offset < steps), F.floor(offset).cast("int")).otherwise(
            F.raise_error(F.concat(F.lit(f"reading outside the {steps} steps of its window, at "), F.col(ts).cast("string"))).cast("int")))
        .groupBy(*window, "_step")
        .agg(*[F.avg(f).alias(f) for f in features])
    )
    order = Window.partitionBy(*window).orderBy("_step")
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    filled = stepped.withColumns({f: F.coalesce(F.last(f, ignorenulls=True).over(so_far), F.lit(0.0)) for f in features})
    # a reading stands for all steps up to the next one
    spread = filled.withColumn("_repeat", F.coalesce(F.lead("_step").over(order) - F.col("_step"), F.lit(1)))
    first_step = F.min("_step").alias("_first")
    cells = F.array_sort(F.collect_list(F.struct("_step", "_repeat", F.struct(*features).alias("x"))))
    zero = F.struct(*[F.lit(0.0).alias(f) for f in features])
    known = F.flatten(F.transform("_cells", lambda c: F.array_repeat(c["x"], c["_repeat"])))
    padded = F.concat(F.array_repeat(zero, F.col("_first")), known)
    return (
        spread.groupBy(*window)
        .agg(cells.alias("_cells"), first_step)
        .withColumn("_known", padded)
        .select(
            *window,
            F.size("_known").alias("n_steps"),
            F.concat("_known", F.array_repeat(zero, F.lit(steps) - F.size("_known"))).alias("sequence"),
        )
    )


