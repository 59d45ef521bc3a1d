"""Waveform metrics on array columns.

Recordings go through numpy once, in Arrow batches, those of one length and rate as a matrix:
the moments and the Fourier transform, from which every band is read, come from the same array.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, functions as F

from tremora.config import PEAK_BAND, RMS_BANDS


def sampling_rate(axis_x: Column) -> Column:
    """Inverse of the first time step; null with fewer than two points or a step that is not positive."""
    dt = F.get(axis_x, F.lit(1)) - F.get(axis_x, F.lit(0))
    return F.when((F.size(axis_x) >= 2) & (dt > 0), F.try_divide(F.lit(1.0), dt))


TIME_NAMES = ["velocity_rms", "crest_factor", "kurtosis_opt", "peak_value_opt"]


BLOCK_POINTS = 1_000_000  # of recordings that go through numpy together


def _times(x: np.ndarray) -> np.ndarray:
    """RMS, crest factor, kurtosis (normal = 3) and peak of each row; all null for a signal that holds a null."""
    rms, peak = np.sqrt(np.mean(x * x, axis=1)), np.abs(x).max(axis=1)
    square = (x - x.mean(axis=1, keepdims=True)) ** 2
    variance = square.mean(axis=1) ** 2
    out = np.stack([
        rms, np.where(rms != 0, peak / rms, np.nan),
        np.where(variance != 0, np.mean(square * square, axis=1) / variance, np.nan), peak,
    ], axis=1)
    out[np.isnan(x).any(axis=1)] = np.nan
    return out


def _bands(x: np.ndarray, fs: float, parseval: bool) -> np.ndarray:
    """RMS of every band and the peak of each row, all recorded at one rate."""
    n = x.shape[1]
    spectrum = np.fft.rfft(x - x.mean(axis=1, keepdims=True), axis=1)
    freqs = np.arange(spectrum.shape[1]) * fs / n
    power = np.abs(spectrum) ** 2
    if parseval:
        # one-sided power that adds up to the mean square: inner bins count twice
        inner = np.full(spectrum.shape[1], 2.0)
        inner[0] = 1.0
        if n % 2 == 0:
            inner[-1] = 1.0
        power = power * inner / n**2
    else:
        power = power / n
    out = np.full((len(x), len(RMS_BANDS) + 1), np.nan)
    for c, (lo, hi) in enumerate(RMS_BANDS.values()):
        first, end = np.searchsorted(freqs, lo), np.searchsorted(freqs, hi, side="right")
        if first < end:
            out[:, c] = np.sqrt(power[:, first:end].sum(axis=1))
    chosen = (freqs >= PEAK_BAND[0]) & (freqs <= PEAK_BAND[1])
    out[:, -1] = np.abs(np.fft.irfft(np.where(chosen, spectrum, 0), n, axis=1)).max(axis=1)
    return out


BAND_NAMES = [*RMS_BANDS, "peak_10_1000hz"]


def _metrics_udf(parseval: bool, times: bool, bands: bool):
    """One pass over each array for all the metrics asked for; recordings of one length and rate share numpy's calls."""
    columns = [*(TIME_NAMES if times else []), *(BAND_NAMES if bands else [])]
    schema = "struct<" + ", ".join(f"{c}: double" for c in columns) + ">"

    def block(x: np.ndarray, fs: float | None) -> np.ndarray:
        with np.errstate(divide="ignore", invalid="ignore"):
            parts = [_times(x)] if times else []
            if bands:
                parts.append(np.full((len(x), len(BAND_NAMES)), np.nan) if fs is None else _bands(x, fs, parseval))
        return np.concatenate(parts, axis=1)

    @F.pandas_udf(schema)
    def measure(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for ys, rates in batches:
            held, out = list(ys), np.full((len(ys), len(columns)), np.nan)
            alike: dict[tuple[int, float | None], list[int]] = {}
            for i, (y, fs) in enumerate(zip(held, rates)):
                if y is not None and len(y):
                    alike.setdefault((len(y), None if pd.isna(fs) else fs), []).append(i)
            for (n, fs), rows in alike.items():
                step = max(1, BLOCK_POINTS // n)
                for own in (rows[k : k + step] for k in range(0, len(rows), step)):
                    out[own] = block(np.stack([np.asarray(held[i], dtype=np.float64) for i in own]), fs)
            yield pd.DataFrame(out, columns=columns)

    return measure


def time_metrics(axis_y: Column) -> Column:
    """Struct of RMS, crest factor, kurtosis and peak."""
    return _metrics_udf(False, True, False)(axis_y, F.lit(None).cast("double"))


def band_metrics(axis_y: Column, fs: Column, norm: str = "one_sided") -> Column:
    """Struct of the band RMS values and the 10-1000 Hz band peak.

    ``norm='one_sided'`` is sqrt(sum |X|^2 / n) over one-sided bins; ``'parseval'``
    scales so that the bands add up to the signal's own mean square. A band without
    bins is null, its peak 0.
    """
    return _metrics_udf(_parseval(norm), False, True)(axis_y, fs)


def all_metrics(axis_y: Column, fs: Column, norm: str = "one_sided") -> Column:
    """Struct of the time and the band metrics, from one pass over the array."""
    return _metrics_udf(_parseval(norm), True, True)(axis_y, fs)


def _parseval(norm: str) -> bool:
    if norm not in ("one_sided", "parseval"):
        raise ValueError(f"unknown norm {norm}")
    return norm == "parseval"
