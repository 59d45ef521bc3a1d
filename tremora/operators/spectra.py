"""Spectra and envelopes of a location's series.

A transform needs the whole series of a location. While every series is short, which
is counted first, one task transforms one series. Longer ones are transformed across
the cluster: spectra (by the chirp-z identity, for any length) and envelopes are
convolutions with a kernel known by formula, and a convolution is a transform of m1 * m2
points, a product and a transform back. The points lie in blocks of numpy matrices; each
transform is a round of short ones down the columns of a block and a round along the rows
of a band, and only the pieces where blocks and bands cross are shuffled between them. Both ways
give the same values.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from tremora.functions.time import epoch_micros, from_micros, time_slice
from tremora.operators.timeseries import DAY
from tremora.session import materialise

ONE_TASK_POINTS = 1_000_000
BLOCK_POINTS = 1 << 18  # of a long transform, held by a task at a time


def centred_series(df: DataFrame, value: str, keys: Sequence[str] = ("device", "location"),
                   ts: str = "timestamp", slice_seconds: int = DAY) -> DataFrame:
    """Non-null values with the key's mean removed, numbered from 0 in time order.

    Numbers come from a count per (key, slice) plus the rank inside the slice.
    """
    part = [*keys, "_slice"]
    rows = (
        df.where(F.col(f"`{value}`").isNotNull() & F.col(ts).isNotNull())
        .select(*keys, F.col(ts), F.col(f"`{value}`").cast("double").alias("_v"))
        .withColumn("_slice", time_slice(ts, slice_seconds))
    )
    sums = rows.groupBy(*part).agg(F.count("*").alias("_c"), F.sum("_v").alias("_s"))
    upto = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(*keys)
    sums = sums.select(
        *part,
        (F.sum("_c").over(upto) - F.col("_c")).alias("_before"),
        F.sum("_c").over(whole).alias("n"),
        (F.sum("_s").over(whole) / F.sum("_c").over(whole)).alias("_mean"),
    )
    rank = F.row_number().over(Window.partitionBy(*part).orderBy(ts, "_v"))
    return rows.withColumn("_rank", rank).join(sums, part).select(
        *keys, F.col(ts), "n", (F.col("_before") + F.col("_rank") - 1).alias("pos"), (F.col("_v") - F.col("_mean")).alias("y")
    )


@dataclass(frozen=True)
class _Grid:
    """Position ``high * m2 + low`` of a padded series lies in row ``high`` of the block that holds column ``low``.

    Bands hold the rows ``k`` of the transform, whose position is ``k + m1 * j``.
    """

    n: int
    m1: int
    m2: int
    points: int

    @property
    def high(self) -> int:
        """Rows that hold values; those below are padding."""
        return -(-self.n // self.m2)

    def low(self, block: int) -> np.ndarray:
        width = max(1, self.points // self.m1)
        return np.arange(block * width, min(self.m2, (block + 1) * width))

    def k(self, band: int) -> np.ndarray:
        depth = max(1, self.points // self.m2)
        return np.arange(band * depth, min(self.m1, (band + 1) * depth))

    def positions(self, block: int, rows: int) -> np.ndarray:
        return np.arange(rows)[:, None] * self.m2 + self.low(block)

    def twist(self, k: np.ndarray, low: np.ndarray) -> np.ndarray:
        return np.exp(-2j * np.pi * (k[:, None] * low) / (self.m1 * self.m2))


GRID = ("n", "m1", "m2")


def _with_grid(series: DataFrame, points: int) -> DataFrame:
    """Add ``m1``, ``m2``, with room for 2 n - 1 points, and the ``block`` of every position."""
    need = F.col("n") * 2 - 1
    bits = F.ceil(F.log2(need)).cast("int")
    low_bits = F.floor(bits / 2).cast("int")
    coarse = F.pow(F.lit(2.0), F.greatest(F.lit(0), bits - low_bits - 4)).cast("long")  # m1 has only small factors
    sized = series.withColumn("m2", F.pow(F.lit(2.0), low_bits).cast("long"))
    sized = sized.withColumn("m1", (coarse * F.ceil(need / (F.col("m2") * coarse))).cast("long"))
    width = F.greatest(F.lit(1), F.floor(F.lit(points) / F.col("m1")))
    return sized.withColumn("block", F.floor((F.col("pos") % F.col("m2")) / width).cast("long"))


def _chirp(d: np.ndarray, n: int) -> np.ndarray:
    """exp(i pi d^2 / n) with the square reduced exactly before it becomes a float."""
    return np.exp(1j * np.pi * ((d * d) % (2 * n)) / n)


def _analytic(d: np.ndarray, n: int) -> np.ndarray:
    """What a signal is convolved with, round its end, to become its analytic signal."""
    d = np.where(2 * d > n, d - n, np.where(2 * d < -n, d + n, d))
    x = np.where(d == 0, 1.0, np.pi * d / n)
    odd = d % 2 == 1
    if n % 2 == 0:
        h = np.where(odd, 2.0 / np.tan(x), 0.0)
    else:
        t = np.tan(x / 2)
        h = np.where(odd, 1.0 / t, -t)
    return np.where(d == 0, 1.0, 1j * h / n)


def _kernel(g: _Grid, block: int, chirp: bool) -> np.ndarray:
    pos = g.positions(block, g.m1)
    d = np.where(pos < g.n, pos, pos - g.m1 * g.m2)
    near = np.abs(d) < g.n
    out = np.zeros(pos.shape, dtype=np.complex128)
    out[near] = (_chirp if chirp else _analytic)(d[near], g.n)
    return out


def _cells(column: pa.ChunkedArray, kind: type) -> list[np.ndarray]:
    return [np.frombuffer(c.as_buffer(), dtype=kind) for c in column]


def _keyed(key: Mapping[str, pa.Scalar], columns: Mapping[str, pa.Array]) -> pa.RecordBatch:
    size = len(next(iter(columns.values())))
    whole = {**{c: pa.repeat(v, size) for c, v in key.items()}, **columns}
    return pa.RecordBatch.from_arrays(list(whole.values()), names=list(whole))


def _binary(parts: Iterable[np.ndarray]) -> pa.Array:
    return pa.array([p.tobytes() for p in parts], pa.binary())


@dataclass(frozen=True)
class _Spread:
    """Blocks of series (keys, grid, block, y) through convolutions."""

    keys: list[T.StructField]
    points: int

    @property
    def by(self) -> list[str]:
        return [*[f.name for f in self.keys], *GRID]

    def schema(self, *columns: str, **kinds: T.DataType) -> T.StructType:
        """Keys and grid, then numbers (``columns``), then columns of their own types."""
        longs = [T.StructField(c, T.LongType()) for c in (*GRID, *columns)]
        return T.StructType([*self.keys, *longs, *[T.StructField(c, k) for c, k in kinds.items()]])

    def grid(self, key: Mapping[str, pa.Scalar]) -> _Grid:
        return _Grid(*[key[c].as_py() for c in GRID], self.points)

    def gathered(self, df: DataFrame, at: str, run, schema: T.StructType) -> DataFrame:
        """``run(grid, number, table)`` gives the columns of all rows of a block or band."""
        by = self.by

        def one(key: tuple, table: pa.Table) -> pa.Table:
            named = dict(zip(by, key))
            out = run(self.grid(named), key[-1].as_py(), table)
            return pa.Table.from_batches([_keyed(named, out)])

        return df.groupBy(*by, at).applyInArrow(one, schema)

    def mapped(self, blocks: DataFrame, run, schema: T.StructType) -> DataFrame:
        """``run(grid, block, cell of every column)`` gives the columns of all rows that a block leads to."""
        by = self.by

        def each(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in range(batch.num_rows):
                    cell = {c: batch.column(c)[i] for c in batch.schema.names}
                    named = {c: cell[c] for c in by}
                    yield _keyed(named, run(self.grid(named), cell["block"].as_py(), cell))

        return blocks.mapInArrow(each, schema)

    def packed(self, series: DataFrame) -> DataFrame:
        """One row a block of rows (pos, t, y): their times and values as matrices."""
        def run(g: _Grid, block: int, table: pa.Table) -> dict[str, pa.Array]:
            low = g.low(block)
            pos = table.column("pos").to_numpy()
            out: dict[str, pa.Array] = {"block": pa.array([block], pa.int64())}
            for name, kind in (("t", np.int64), ("y", np.float64)):
                cells = np.zeros((g.high, len(low)), dtype=kind)
                cells[pos // g.m2, pos % g.m2 - low[0]] = table.column(name).to_numpy()
                out[name] = _binary([cells])
            return out

        return self.gathered(_with_grid(series, self.points), "block", run, self.schema("block", t=T.BinaryType(), y=T.BinaryType()))

    def magnitudes(self, blocks: DataFrame, chirp: bool) -> DataFrame:
        """Blocks of the magnitude ``y``, and its ``total``, of the transforms (``chirp``) or the analytic signals."""
        def down(g: _Grid, block: int, cell: dict[str, pa.Scalar]) -> dict[str, pa.Array]:
            low = g.low(block)
            y = np.frombuffer(cell["y"].as_buffer()).reshape(g.high, -1)
            if chirp:
                y = y * _chirp(g.positions(block, g.high), g.n).conj()
            twist = g.twist(np.arange(g.m1), low)
            a = np.fft.fft(y, g.m1, axis=0) * twist
            b = np.fft.fft(_kernel(g, block, chirp), axis=0) * twist
            cuts = range(0, g.m1, len(g.k(0)))
            bands = [slice(c, c + len(g.k(0))) for c in cuts]
            return {"block": pa.array([block] * len(bands), pa.int64()), "band": pa.array(range(len(bands)), pa.int64()),
                    "a": _binary(a[x] for x in bands), "b": _binary(b[x] for x in bands)}

        def side_by_side(table: pa.Table, name: str, at: str, axis: int, shape: tuple[int, int]) -> np.ndarray:
            order = np.argsort(table.column(at).to_numpy())
            cells = _cells(table.column(name), np.complex128)
            return np.concatenate([cells[i].reshape(shape) for i in order], axis=axis)

        def along(g: _Grid, band: int, table: pa.Table) -> dict[str, pa.Array]:
            k = g.k(band)
            a, b = (np.fft.fft(side_by_side(table, c, "block", 1, (len(k), -1)), axis=1) for c in ("a", "b"))
            # the way back is the conjugate of the transform of the conjugate, rows first
            back = np.fft.fft((a * b).conj(), axis=1) * g.twist(k, np.arange(g.m2))
            width = len(g.low(0))
            blocks = [slice(c, c + width) for c in range(0, g.m2, width)]
            return {"block": pa.array(range(len(blocks)), pa.int64()), "band": pa.array([band] * len(blocks), pa.int64()),
                    "a": _binary(back[:, x] for x in blocks)}

        def back(g: _Grid, block: int, table: pa.Table) -> dict[str, pa.Array]:
            a = side_by_side(table, "a", "band", 0, (-1, len(g.low(block))))
            y = np.abs(np.fft.fft(a, axis=0)[: g.high]) / (g.m1 * g.m2)
            y[g.positions(block, g.high) >= g.n] = 0.0
            return {"block": pa.array([block], pa.int64()), "y": _binary([y]), "total": pa.array([y.sum()])}

        pieces = self.mapped(blocks.select(*self.by, "block", "y"), down, self.schema("block", "band", a=T.BinaryType(), b=T.BinaryType()))
        products = self.gathered(pieces, "band", along, self.schema("block", "band", a=T.BinaryType()))
        return self.gathered(products, "block", back, self.schema("block", y=T.BinaryType(), total=T.DoubleType()))

    def less_mean(self, blocks: DataFrame) -> DataFrame:
        keys = [f.name for f in self.keys]
        mean = blocks.groupBy(*keys).agg((F.sum("total") / F.max("n")).alias("_mean"))

        def run(g: _Grid, block: int, cell: dict[str, pa.Scalar]) -> dict[str, pa.Array]:
            y = np.frombuffer(cell["y"].as_buffer()).reshape(g.high, -1) - cell["_mean"].as_py()
            return {"block": pa.array([block], pa.int64()), "y": _binary([np.where(g.positions(block, g.high) < g.n, y, 0.0)])}

        return self.mapped(blocks.join(mean, keys), run, self.schema("block", y=T.BinaryType()))

    def points_of(self, blocks: DataFrame, half: bool = False) -> DataFrame:
        """Rows (keys, grid, pos, y), and ``t`` if the blocks have it; of the first n // 2 positions if ``half``."""
        times = "t" in blocks.columns

        def run(g: _Grid, block: int, cell: dict[str, pa.Scalar]) -> dict[str, pa.Array]:
            pos = g.positions(block, g.high)
            there = pos < (g.n // 2 if half else g.n)
            out = {"pos": pa.array(pos[there]), "y": pa.array(np.frombuffer(cell["y"].as_buffer()).reshape(pos.shape)[there])}
            if times:
                out["t"] = pa.array(np.frombuffer(cell["t"].as_buffer(), dtype=np.int64).reshape(pos.shape)[there])
            return out

        return self.mapped(blocks, run, self.schema("pos", y=T.DoubleType(), **({"t": T.LongType()} if times else {})))


def _analytic_weights(n: int) -> np.ndarray:
    k = np.arange(n)
    return np.where((k == 0) | (2 * k == n), 1.0, np.where(2 * k < n, 2.0, 0.0))


def _one_task(interval: float, wanted: set[str], schema: T.StructType, keys: Sequence[str], ts: str):
    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("pos")
        y = pdf["y"].to_numpy()
        n, half = len(y), len(y) // 2
        envelope = np.abs(np.fft.ifft(np.fft.fft(y) * _analytic_weights(n)))
        envelope = envelope - envelope.mean()
        freq = np.arange(half) / (n * interval)
        times = {"raw": y, "envelope": envelope}
        spectra = {"spectrum": y, "envelope_spectrum": envelope}
        parts = [
            pd.DataFrame({"panel": p, ts: pdf[ts].to_numpy(), "bin": None, "x": None, "y": v})
            for p, v in times.items() if p in wanted
        ] + [
            pd.DataFrame({"panel": p, ts: None, "bin": np.arange(half), "x": freq, "y": np.abs(np.fft.fft(v))[:half]})
            for p, v in spectra.items() if p in wanted
        ]
        out = pd.concat([p.astype({"bin": "Int64", "x": "float64", ts: "datetime64[us]"}) for p in parts])
        for i, k in enumerate(keys):
            out[k] = key[i]
        return out[schema.fieldNames()]
    return run


PANELS = ("raw", "spectrum", "envelope", "envelope_spectrum")


def signal_panels(df: DataFrame, value: str, interval: float = 5.0, panels: Sequence[str] = PANELS,
                  keys: Sequence[str] = ("device", "location"), ts: str = "timestamp",
                  one_task_points: int = ONE_TASK_POINTS, slice_seconds: int = DAY,
                  block_points: int = BLOCK_POINTS) -> DataFrame:
    """The four signal views as one long table (keys, panel, time, bin, x, y).

    ``raw`` and ``envelope`` are over time (x null); the spectra are over frequency
    ``x = bin / (n * interval)`` for the first n // 2 bins (time null). Null values
    leave the signal together with their times. An empty table gives no rows.
    """
    unknown = set(panels) - set(PANELS)
    if unknown:
        raise ValueError(f"unknown panels: {sorted(unknown)}")
    series = centred_series(df, value, keys, ts, slice_seconds)
    longest = df.groupBy(*keys).agg(F.count(F.col(f"`{value}`")).alias("n")).agg(F.max("n")).first()[0] or 0
    if longest > one_task_points:
        return _across_tasks(series, interval, panels, keys, ts, block_points)
    schema = T.StructType(
        [df.schema[k] for k in keys]
        + [T.StructField("panel", T.StringType()), T.StructField(ts, df.schema[ts].dataType), T.StructField("bin", T.LongType()),
           T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())]
    )
    return series.groupBy(*keys).applyInPandas(_one_task(interval, set(panels), schema, keys, ts), schema)


def _across_tasks(series: DataFrame, interval: float, panels: Sequence[str], keys: Sequence[str], ts: str, points: int) -> DataFrame:
    kind = series.schema[ts].dataType
    zoned = isinstance(kind, T.TimestampType)
    no_time, no_bin, no_x = F.lit(None).cast(kind), F.lit(None).cast("long"), F.lit(None).cast("double")
    spread = _Spread([series.schema[k] for k in keys], points)
    rows = series.select(*keys, "n", "pos", (F.unix_micros(ts) if zoned else epoch_micros(ts)).alias("t"), "y")
    blocks = materialise(spread.packed(rows), "series")

    def over_time(name: str, at: DataFrame) -> DataFrame:
        time = F.timestamp_micros("t") if zoned else from_micros(F.col("t")).cast(kind)
        return spread.points_of(at).select(*keys, F.lit(name).alias("panel"), time.alias(ts), no_bin.alias("bin"), no_x.alias("x"), "y")

    def over_frequency(name: str, at: DataFrame) -> DataFrame:
        return spread.points_of(at, half=True).select(
            *keys, F.lit(name).alias("panel"), no_time.alias(ts), F.col("pos").alias("bin"),
            (F.col("pos") / (F.col("n") * interval)).alias("x"), "y",
        )

    out = []
    if "raw" in panels:
        out.append(over_time("raw", blocks))
    if "spectrum" in panels:
        out.append(over_frequency("spectrum", spread.magnitudes(blocks, chirp=True)))
    if {"envelope", "envelope_spectrum"} & set(panels):
        envelope = spread.less_mean(materialise(spread.magnitudes(blocks, chirp=False), "magnitude"))
        if "envelope" in panels:
            out.append(over_time("envelope", envelope.join(blocks.drop("y"), [*spread.by, "block"])))
        if "envelope_spectrum" in panels:
            out.append(over_frequency("envelope_spectrum", spread.magnitudes(envelope, chirp=True)))
    first, *rest = out
    for o in rest:
        first = first.unionByName(o)
    return first


def _frequency_table(df: DataFrame, panel: str, value: str, keys: Sequence[str], **kw) -> DataFrame:
    out = signal_panels(df, value, panels=(panel,), keys=keys, **kw)
    return out.select(*keys, "bin", F.col("x").alias("frequency"), F.col("y").alias("amplitude"))


def spectrum(df: DataFrame, value: str, keys: Sequence[str] = ("device", "location"), **kw) -> DataFrame:
    """Magnitudes of the mean-removed signal, first n // 2 bins."""
    return _frequency_table(df, "spectrum", value, keys, **kw)


def envelope_spectrum(df: DataFrame, value: str, keys: Sequence[str] = ("device", "location"), **kw) -> DataFrame:
    """Magnitudes of the mean-removed envelope, first n // 2 bins."""
    return _frequency_table(df, "envelope_spectrum", value, keys, **kw)


def envelope(df: DataFrame, value: str, keys: Sequence[str] = ("device", "location"), ts: str = "timestamp", **kw) -> DataFrame:
    """Magnitude of the analytic signal over time, mean removed."""
    out = signal_panels(df, value, panels=("envelope",), keys=keys, ts=ts, **kw)
    return out.select(*keys, ts, F.col("y").alias("envelope"))
