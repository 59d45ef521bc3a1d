"""Exact quantiles that stay distributed.

Spark's ``percentile`` keeps every distinct value of a group in one task. That is
fine while groups are small, which is checked first; larger ones go through a
range-partitioned frequency table in which only the partitions holding a wanted
rank are looked at. Both ways interpolate linearly and agree.

``selected_quantiles`` is a third exact way, for whole columns: histograms narrow the
interval of every wanted rank, and no value is shuffled or sorted. ``value_sketches`` are
for answers within a stated error of rank that merge over tables.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tremora.operators.reshape import to_long
from tremora.session import materialise

IN_MEMORY_ROWS = 1_000_000


def quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float],
              keys: Sequence[str] = (), in_memory_rows: int = IN_MEMORY_ROWS) -> DataFrame:
    """One row per key and feature: ``n`` non-null values and array ``q`` in the order of ``probs``."""
    by = [*keys, "feature"]
    long = to_long(df, columns, keys, "feature", "value").where("value is not null")
    counts = df.groupBy(*keys).agg(*[F.count(c).alias(c) for c in columns])
    biggest = counts.agg(F.greatest(F.lit(0), *[F.max(c) for c in columns])).first()[0]
    if (biggest or 0) <= in_memory_rows:
        wanted = F.array(*[F.lit(float(p)) for p in probs])
        return long.groupBy(*by).agg(
            F.count("value").alias("n"), F.percentile("value", wanted).alias("q")
        )
    return _by_rank(long, by, probs)


def _by_rank(long: DataFrame, by: list[str], probs: Sequence[float]) -> DataFrame:
    # repeated values collapse before the sort, so a popular value is one row
    freq = long.groupBy(*by, "value").agg(F.count("*").alias("c"))
    spread = materialise(
        freq.repartitionByRange(*by, "value").withColumn("part", F.spark_partition_id()), "value-counts"
    )
    parts = spread.groupBy(*by, "part").agg(F.sum("c").alias("c"))
    upto = Window.partitionBy(*by).orderBy("part").rowsBetween(Window.unboundedPreceding, 0)
    parts = parts.withColumn("hi", F.sum("c").over(upto)).withColumn("lo", F.col("hi") - F.col("c"))
    sizes = parts.groupBy(*by).agg(F.sum("c").alias("n"))
    ranks = sizes.withColumn(
        "k", F.explode(F.array_distinct(F.flatten(F.array(*[
            F.array(F.floor((F.col("n") - 1) * p), F.ceil((F.col("n") - 1) * p)) for p in probs
        ]))))
    )
    hits = (
        parts.drop("c").join(ranks, by)
        .where("k >= lo and k < hi")
        .groupBy(*by, "part", "lo").agg(F.collect_list("k").alias("ks"))
    )
    # a group below is the content of one range partition
    inside = Window.partitionBy(*by, "part").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    values = (
        spread.join(hits, [*by, "part"])
        .withColumn("end", F.col("lo") + F.sum("c").over(inside))
        .withColumn("k", F.explode("ks"))
        .where("k < end and k >= end - c")
    )
    at = values.groupBy(*by).agg(F.map_from_entries(F.collect_list(F.struct("k", "value"))).alias("at"))
    def interpolate(p: float):
        pos = (F.col("n") - 1) * p
        low, high = F.element_at("at", F.floor(pos)), F.element_at("at", F.ceil(pos))
        return low + (high - low) * (pos - F.floor(pos))
    return at.join(sizes, by).select(*by, "n", F.array(*[interpolate(p) for p in probs]).alias("q"))


# selection by histograms --------------------------------------------------------------------------


@dataclass(frozen=True)
class _Interval:
    """Where the value of a rank lies: [lo, hi], which has ``below`` values of the column under it."""

    lo: float
    hi: float
    below: int


def selected_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float], bins: int = 1024) -> DataFrame:
    """One row per column: feature, ``n`` non-null values and array ``q``; as ``quantiles`` without keys.

    Each pass over the table counts the values of all open intervals in ``bins`` bins, with the least and the
    greatest of each bin, which are the next interval of the ranks in it: bins of signs, of equal ratio
    or of equal width, as the interval is wide. An interval of one value is settled. A pass leaves at most ``bins`` rows
    for each interval and task, whatever the number of values, and makes no row of any value.
    Columns without values have no row. NaN counts as greater than any number.
    """
    if bins < 3:
        raise ValueError("three bins at least")
    value = {c: F.col(f"`{c}`").cast("double") for c in columns}
    number = {c: F.when(~F.isnan(value[c]), value[c]) for c in columns}
    counts = [f for c in columns for f in (F.count(value[c]), F.count(number[c]), F.min(number[c]), F.max(number[c]))]
    row = df.agg(*counts).first()
    sizes = {c: tuple(row[4 * i : 4 * i + 4]) for i, c in enumerate(columns)}
    found: dict[tuple[str, int], float] = {}
    open_: dict[tuple[str, int], _Interval] = {}
    for c, (n, numbers, lo, hi) in sizes.items():
        for p in probs:
            for k in {math.floor((n - 1) * p), math.ceil((n - 1) * p)} if n else ():
                if k >= numbers:
                    found[c, k] = math.nan
                else:
                    open_[c, k] = _Interval(lo, hi, 0)
    while True:
        for key in [key for key, i in open_.items() if i.lo == i.hi]:
            found[key] = open_.pop(key).lo
        if not open_:
            break
        intervals = sorted({(c, i) for (c, _), i in open_.items()}, key=lambda x: (x[0], x[1].lo))
        counted = _counted(df, value, intervals, bins)
        for (c, k), i in open_.items():
            below = i.below
            for n, lo, hi in counted[c, i]:
                if k < below + n:
                    open_[c, k] = _Interval(lo, hi, below)
                    break
                below += n

    def one(c: str, p: float) -> float:
        at = (sizes[c][0] - 1) * p
        low, high = found[c, math.floor(at)], found[c, math.ceil(at)]
        return low + (high - low) * (at - math.floor(at)) if low != high else low

    rows = [(c, sizes[c][0], [one(c, p) for p in probs]) for c in columns if sizes[c][0]]
    return df.sparkSession.createDataFrame(rows, "feature string, n long, q array<double>")


def _cuts(i: _Interval, bins: int) -> list[float]:
    """Where the bins after an interval's first one begin, in order; the least and the greatest are in different bins."""
    if i.lo <= 0 <= i.hi:  # signs first
        cuts = [0.0, math.ulp(0.0)]
    elif math.isinf(i.lo) or math.isinf(i.hi):  # an unlimited end leaves the middle to the rest
        cuts = [math.nextafter(i.lo, math.inf), i.hi]
    else:
        least, most = sorted((abs(i.lo), abs(i.hi)))
        if most / 4 > least:  # many sizes: bins of equal ratio
            cuts = np.exp(np.linspace(math.log(least), math.log(most), bins + 1)[1:-1])
            cuts = cuts if i.lo > 0 else -cuts
        else:
            cuts = np.linspace(i.lo, i.hi, bins + 1)[1:-1]
    return sorted({float(x) for x in cuts if i.lo < x <= i.hi}) or [i.hi]


def _counted(df: DataFrame, value: dict[str, Column], intervals: Sequence[tuple[str, _Interval]], bins: int) -> dict:
    """(values, least, greatest) of every interval's bins that hold values, in order.

    Each batch is sorted by column, so that a bin is a range of it and only the ends of the bins are looked up,
    however many intervals there are; a task hands on one row per bin.
    """
    plan, places = [], []  # for each column: the first of its bins, their starts, the interval's end at its last bin
    for c in dict.fromkeys(c for c, _ in intervals):
        starts, ends, first = [], [], len(places)
        for i in (i for name, i in intervals if name == c):
            cuts = _cuts(i, bins)
            starts += [i.lo, *cuts]
            ends += [*[math.nan] * len(cuts), i.hi]
            places += [(c, i)] * (len(cuts) + 1)
        plan.append((first, np.array(starts), np.array(ends)))
    size = len(places)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, least, most = np.zeros(size, dtype=np.int64), np.full(size, np.inf), np.full(size, -np.inf)
        for batch in batches:
            for at, (first, starts, ends) in enumerate(plan):
                v = np.sort(batch.column(at).to_numpy(zero_copy_only=False))  # null and NaN are behind all numbers
                lo = np.searchsorted(v, starts)
                hi = np.where(np.isnan(ends), np.append(lo[1:], 0), np.searchsorted(v, ends, side="right"))
                held = np.flatnonzero(hi > lo)
                cells = first + held
                n[cells] += (hi - lo)[held]
                least[cells] = np.minimum(least[cells], v[lo[held]])
                most[cells] = np.maximum(most[cells], v[hi[held] - 1])
        used = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (used, n[used], least[used], most[used])], names=["cell", "n", "lo", "hi"])

    inside = reduce(lambda a, b: a | b, [value[c].between(i.lo, i.hi) for c, i in intervals])
    columns = [value[c].alias(f"c{at}") for at, c in enumerate(dict.fromkeys(c for c, _ in intervals))]
    cells = df.where(inside).select(*columns).mapInArrow(run, "cell long, n long, lo double, hi double")
    rows = cells.groupBy("cell").agg(F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi")).collect()
    out: dict = {key: [] for key in intervals}
    for r in sorted(rows, key=lambda r: r["cell"]):
        out[places[r["cell"]]].append((r["n"], r["lo"], r["hi"]))
    return out


# sketches -------------------------------------------------------------------------------------------


def rank_error(k: int) -> float:
    """By how much the rank of a sketch's answer may be off, as a share of the values, with 99 % confidence."""
    return 2.446 / k**0.9433


def value_sketches(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = (), k: int = 400) -> DataFrame:
    """One row per key and feature: ``n`` values and a sketch of their distribution, which merges with others.

    NaN is left out. A group needs no more room than ``k`` allows, whatever its size, and is summed up in the tasks first.
    """
    long = to_long(df, columns, keys, "feature", "value").where("value is not null and not isnan(value)")
    return long.groupBy(*keys, "feature").agg(F.count("value").alias("n"), F.kll_sketch_agg_double("value", F.lit(k)).alias("sketch"))


def merged_sketches(sketches: DataFrame, by: Sequence[str] = ("feature",)) -> DataFrame:
    """Sketches of several tables, runs or keys added up."""
    return sketches.groupBy(*by).agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch").alias("sketch"))


def sketched_quantiles(sketches: DataFrame, probs: Sequence[float]) -> DataFrame:
    """``n`` and array ``q``: values whose rank is off by at most ``rank_error`` of the values."""
    names = [c for c in sketches.columns if c not in ("n", "sketch")]
    return sketches.select(*names, "n", F.array(*[F.kll_sketch_get_quantile_double("sketch", F.lit(float(p))) for p in probs]).alias("q"))
