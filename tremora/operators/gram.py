"""Sums of products of many columns, batch by batch.

A batch of rows becomes a matrix whose products with itself give the sums of all pairs
of columns at once. A task adds up its batches and hands on one row per pair, so
what is shuffled depends on the columns and tasks, not on the rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F


def _matrix(batch: pa.RecordBatch, columns: int) -> np.ndarray:
    return np.stack([batch.column(f"c{i}").to_numpy(zero_copy_only=False) for i in range(columns)], axis=1)


def _numbered(df: DataFrame, columns: Sequence[str], shift: Sequence[float], unit: Sequence[float]) -> list:
    return [((F.col(f"`{c}`").cast("double") - float(m)) / float(s)).alias(f"c{i}") for i, (c, m, s) in enumerate(zip(columns, shift, unit))]


def pair_sums(df: DataFrame, columns: Sequence[str], pairs: Sequence[tuple[int, int]], shift: Sequence[float]) -> DataFrame:
    """Per pair (its number ``i``): n, sa, sb, saa, sbb, sab over the rows where both columns are present.

    Values are taken less ``shift``, which keeps the sums exact enough to subtract.
    """
    a, b = (np.array(x) for x in zip(*pairs))
    p = len(columns)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((4, p, p))
        for batch in batches:
            x = _matrix(batch, p)
            there = (~np.isnan(x)).astype(float)
            x = np.nan_to_num(x, nan=0.0)
            total += there.T @ there, x.T @ there, (x * x).T @ there, x.T @ x
        n, s, ss, sab = total
        cells = (np.arange(len(a)), n[a, b], s[a, b], s[b, a], ss[a, b], ss[b, a], sab[a, b])
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in cells], names=["i", "n", "sa", "sb", "saa", "sbb", "sab"])

    parts = df.select(*_numbered(df, columns, shift, [1.0] * p)).mapInArrow(
        run, "i long, n double, sa double, sb double, saa double, sbb double, sab double")
    return parts.groupBy("i").agg(*[F.sum(c).alias(c) for c in ("n", "sa", "sb", "saa", "sbb", "sab")])


def grouped_products(df: DataFrame, columns: Sequence[str], shift: Sequence[float], unit: Sequence[float], group: str, groups: int) -> np.ndarray:
    """For each value of ``group`` (null first, then 0, 1, ...) the products of the scaled columns and a constant 1.

    Returns groups + 1 symmetric matrices; the columns must not be null.
    """
    p = len(columns)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((groups + 1, p + 1, p + 1))
        for batch in batches:
            x = np.concatenate([_matrix(batch, p), np.ones((batch.num_rows, 1))], axis=1)
            at = batch.column("g").fill_null(-1).to_numpy(zero_copy_only=False) + 1
            for g in np.unique(at):
                own = x[at == g]
                total[g] += own.T @ own
        flat = total.ravel()
        used = np.flatnonzero(flat)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(flat[used])], names=["cell", "v"])

    parts = df.select(*_numbered(df, columns, shift, unit), F.col(group).cast("int").alias("g")).mapInArrow(run, "cell long, v double")
    out = np.zeros((groups + 1) * (p + 1) ** 2)
    for cell, v in parts.groupBy("cell").agg(F.sum("v")).collect():  # (groups + 1) small matrices
        out[cell] = v
    return out.reshape(groups + 1, p + 1, p + 1)


def expanded_products(df: DataFrame, columns: Sequence[str], expand: Callable[[np.ndarray], np.ndarray], width: int) -> np.ndarray:
    """Products of the ``width`` columns that ``expand`` makes of each batch's rows; the columns must not be null."""
    p = len(columns)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            x = _matrix(batch, p)
            if np.isnan(x).any():
                raise ValueError(f"null or NaN in {list(columns)}")
            wide = expand(x)
            total += wide.T @ wide
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width * width)), pa.array(total.ravel())], names=["cell", "v"])

    parts = df.select(*_numbered(df, columns, [0.0] * p, [1.0] * p)).mapInArrow(run, "cell long, v double")
    out = np.zeros(width * width)
    for cell, v in parts.groupBy("cell").agg(F.sum("v")).collect():  # one small matrix
        out[cell] = v
    return out.reshape(width, width)
