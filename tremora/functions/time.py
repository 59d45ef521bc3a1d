"""Time expressions on zone-free timestamps."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

def parse_datetime(date: str | Column, time: str | Column) -> Column:
    """Strict ``yyyy-MM-dd HH:mm:ss`` from trimmed date and time text; anything else becomes null."""
    text = F.concat_ws(" ", F.trim(date), F.trim(time))
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$"), text.try_cast("timestamp_ntz"))


def epoch_micros(ts: str | Column) -> Column:
    """Microseconds since 1970 of the time as written, whatever the session's zone."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    days = F.date_diff(ts.cast("date"), F.lit("1970-01-01").cast("date")).cast("bigint")
    minutes = (days * 24 + F.hour(ts)) * 60 + F.minute(ts)
    return minutes * 60_000_000 + (F.extract(F.lit("SECOND"), ts) * 1_000_000).cast("bigint")


def epoch_seconds(ts: str | Column) -> Column:
    """Whole seconds since 1970, rounded down (also before 1970)."""
    return F.floor(epoch_micros(ts) / F.lit(1_000_000)).cast("bigint")


def from_micros(micros: Column) -> Column:
    """Inverse of ``epoch_micros``."""
    return F.timestamp_add("MICROSECOND", micros, F.lit("1970-01-01").cast("timestamp_ntz"))


def time_slice(ts: str | Column, seconds: int) -> Column:
    """Index of the fixed-width slice holding ``ts``.

    Series are split on (key, slice) so that one busy key never lands in one task:
    a slice holds at most its width divided by the reading cadence.
    """
    us = epoch_micros(ts)
    return ((us - F.pmod(us, F.lit(seconds * 1_000_000))) / F.lit(seconds * 1_000_000)).cast("bigint")
