"""Row-level filters, projections and small column helpers."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, Window, functions as F, types as T

from tremora.functions.time import parse_datetime
from tremora.session import broadcast_if_small


def with_datetime(df: DataFrame, date: str = "Date", time: str = "Time", out: str = "datetime") -> DataFrame:
    return df.withColumn(out, parse_datetime(F.col(date), F.col(time)))


def filter_range(df: DataFrame, start=None, end=None, ts: str = "datetime", date: str | None = None) -> DataFrame:
    """Closed time range; without both bounds every row is kept.

    For a table partitioned by day, ``date`` names that column and its folders are
    pruned as well.
    """
    if start is None or end is None:
        return df
    bounds = [F.lit(b).cast(df.schema[ts].dataType) for b in (start, end)]
    if date is not None:
        df = df.where(F.col(date).between(*[F.to_date(b) for b in bounds]))
    return df.where(F.col(ts).between(*bounds))


def time_extent(df: DataFrame, keys: Sequence[str] = (), ts: str = "datetime") -> DataFrame:
    """First and last time of a selection; null for an empty one."""
    return df.groupBy(*keys).agg(F.min(ts).alias("start"), F.max(ts).alias("end"))


def overlap_bounds(
    left: DataFrame, right: DataFrame, keys: Sequence[str] = ("device",), ts: str = "datetime"
) -> DataFrame:
    """The time range both sides share, one row per key.

    A key missing on one side keeps its own extent, as an empty side sets no bound.
    """
    a = time_extent(left, keys, ts)
    b = time_extent(right, keys, ts).withColumnsRenamed({"start": "start_r", "end": "end_r"})
    return broadcast_if_small(a.join(b, list(keys), "full").select(
        *keys,
        F.greatest("start", "start_r").alias("_lo"),
        F.least("end", "end_r").alias("_hi"),
    ))


def clip(df: DataFrame, bounds: DataFrame, keys: Sequence[str] = ("device",), ts: str = "datetime") -> DataFrame:
    """Rows inside their key's range, both ends included."""
    inside = F.col(ts).between(F.col("_lo"), F.col("_hi"))
    return df.join(bounds, list(keys)).where(inside).select(*df.columns)


def overlap_range(
    left: DataFrame, right: DataFrame, keys: Sequence[str] = ("device",), ts: str = "datetime"
) -> tuple[DataFrame, DataFrame]:
    """Keep on both sides only the time range they share, per key."""
    bounds = overlap_bounds(left, right, keys, ts)
    return clip(left, bounds, keys, ts), clip(right, bounds, keys, ts)


def drop_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Drop columns, ignoring those that are not there."""
    return df.drop(*columns)


def drop_nulls(df: DataFrame) -> DataFrame:
    return df.na.drop("any")


def suffix_ratings(df: DataFrame, ratings: Iterable[str], suffix: str = "_rating") -> DataFrame:
    """Rename rating columns that would collide with metric columns."""
    return df.withColumnsRenamed({r: f"{r}{suffix}" for r in ratings if r in df.columns})


def one_hot(df: DataFrame, categories: dict[str, Sequence[str]], prefixes: dict[str, str] | None = None) -> DataFrame:
    """Replace each column by one 0/1 column per listed category; null gives all zeros."""
    prefixes = prefixes or {}
    flags = {
        f"{prefixes.get(c, c)}_{v}": F.coalesce((F.col(c) == v).cast("int"), F.lit(0))
        for c, values in categories.items()
        for v in values
    }
    return df.withColumns(flags).drop(*categories)


def map_location(df: DataFrame, dimension: DataFrame, sensor: str = "sensor_id") -> DataFrame:
    """Attach the location of each sensor; unknown sensors get null.

    The dimension is one row per sensor and is hinted only after its size is checked.
    """
    dim = dimension.select(F.col("sensor_id").alias(sensor), "location")
    return df.join(broadcast_if_small(dim), sensor, "left")


def distinct_values(df: DataFrame, column: str, keys: Sequence[str] = ()) -> DataFrame:
    """Sorted distinct non-null values."""
    return df.select(*keys, column).where(F.col(column).isNotNull()).distinct().orderBy(*keys, column)


def select_device(df: DataFrame, device: str, locations: Sequence[str] | None = None) -> DataFrame:
    """Rows of one device, optionally of the chosen locations only."""
    out = df.where(F.col("device") == device)
    return out if locations is None else out.where(F.col("location").isin(list(locations)))


def subsample(df: DataFrame, keys: Sequence[str], percent: int, seed: int = 42) -> DataFrame:
    """Seeded share of the rows, chosen by a hash of their keys, so partitioning cannot change it.

    The same share is taken whatever the size of the table; who wants all rows does not call this.
    """
    text = F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys], F.lit(str(seed)))
    draw = F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("long")
    return df.where(draw % 100 < percent)


def first_n(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """The first ``n`` rows in the given order, planned as a distributed top-k."""
    return df.orderBy(*order).limit(n)


def numeric_only(df: DataFrame, keep: Sequence[str] = (), booleans: bool = True) -> DataFrame:
    """Keep numeric columns (booleans as 0/1, or not at all) plus the named ones."""
    out = []
    for f in df.schema.fields:
        if f.name in keep or isinstance(f.dataType, T.NumericType):
            out.append(F.col(f"`{f.name}`"))
        elif booleans and isinstance(f.dataType, T.BooleanType):
            out.append(F.col(f"`{f.name}`").cast("int").alias(f.name))
    return df.select(*out)


def sort_time(df: DataFrame, ts: str = "datetime", then: Sequence[str] = ()) -> DataFrame:
    return df.orderBy(ts, *then)


def union_by_name(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Stack tables with differing columns, absent ones as null."""
    for df in others:
        first = first.unionByName(df, allowMissingColumns=True)
    return first


def best_rows(df: DataFrame, keys: Sequence[str], order: Sequence) -> DataFrame:
    """The first row of each key in the given order."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank")
