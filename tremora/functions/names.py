"""Expressions over file names, device names and column labels."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, functions as F

from tremora.config import DEVICE_ALIASES

RATING_FILE = re.compile(r"(?i)\bRating\b")  # fits names of files that hold ratings

# Waveform file name formats.
TIME_PREFIX = r"(\d{8})\s?(\d{6})_"
TIME_SUFFIX = r"_(\d{8})_(\d{6})\.json$"
BINARY_TIME_SUFFIX = r"(?i)_(\d{8})_(\d{6})\.Single$"
SENSOR_NAME = r"^\d{8} \d{6}_[0-9a-f]{24}_([0-9a-f]{24})_([A-Z]{2})\.json$"


def decoded(path: Column) -> Column:
    """Undo the percent-encoding of the file metadata columns; a plus stays a plus."""
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


def base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def location_of(name: Column) -> Column:
    """Text after the last closing bracket, without the extension."""
    after = F.trim(F.regexp_extract(name, r"([^)]*)$", 1))
    return F.regexp_replace(after, r"\s*\.(csv|xlsx|parquet|json)$", "")


def belongs_to(name: Column, device: str) -> Column:
    """The name carries the device in brackets."""
    return F.contains(name, F.lit(f"({device})"))


def is_rating_file(name: Column) -> Column:
    return name.rlike(RATING_FILE.pattern)


def _stamp(name: Column, pattern: str) -> Column:
    """Day and clock digits of a name as a time, null when they are none."""
    day, clock = (F.regexp_extract(name, pattern, i) for i in (1, 2))
    text = F.regexp_replace(F.concat(day, clock), r"^(\d{4})(\d\d)(\d\d)(\d\d)(\d\d)(\d\d)$", "$1-$2-$3 $4:$5:$6")
    return F.when(day != "", text.try_cast("timestamp_ntz"))


def wave_time(name: Column) -> Column:
    """Recording time from a waveform file name, null when neither format fits."""
    return F.when(name.rlike(TIME_PREFIX), _stamp(name, TIME_PREFIX)).otherwise(_stamp(name, TIME_SUFFIX))


def binary_wave_time(name: Column) -> Column:
    return _stamp(name, BINARY_TIME_SUFFIX)


def sensor_id(name: Column) -> Column:
    return F.nullif(F.regexp_extract(name, SENSOR_NAME, 1), F.lit(""))


def wave_code(name: Column) -> Column:
    return F.nullif(F.regexp_extract(name, SENSOR_NAME, 2), F.lit(""))


def canonical_device(device: Column, aliases: dict[str, str] | None = None) -> Column:
    """Replace known misspellings inside device names."""
    pairs = (DEVICE_ALIASES if aliases is None else aliases).items()
    return reduce(lambda c, kv: F.replace(c, F.lit(kv[0]), F.lit(kv[1])), pairs, device)


def heading(name: Column) -> Column:
    """``tube_mill`` -> ``TUBE MILL``."""
    return F.upper(F.replace(name, F.lit("_"), F.lit(" ")))


def label(name: Column) -> Column:
    """``rms_1_10khz`` -> ``Rms 1 10Khz``: a letter is raised after any non-letter."""
    words = F.split(F.lower(F.replace(name, F.lit("_"), F.lit(" "))), r"(?<=[^a-z])(?=[a-z])")
    return F.concat_ws("", F.transform(words, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.substr(w, F.lit(2)))))
