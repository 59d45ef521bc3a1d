"""Staged sensor and rating files."""

from __future__ import annotations

import json
import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tremora.config import RATING_SCHEMA, READING_SCHEMA
from tremora.functions import names
from tremora.functions.names import canonical_device
from tremora.operators.rows import with_datetime
from tremora.sources.files import PART_BYTES, Names, StagedCsv, list_files


def _paths(path: str | Sequence[str]) -> list[str]:
    return [path] if isinstance(path, str) else list(path)


def _load(spark: SparkSession, path: str | Sequence[str], schema: T.StructType, fmt: str, wanted: Names,
          part_bytes: int = PART_BYTES) -> DataFrame:
    """The wanted files stacked by column name, with their names as ``file_name``.

    A CSV file may order its columns as it likes; headers and rows are read in the tasks. Columns that
    a file lacks are null, those outside the schema are left out, and a value that does not fit its type is null.
    Files of other formats are of the schema.
    """
    if fmt == "csv":
        spark.dataSource.register(StagedCsv)
        text = (
            spark.read.format(StagedCsv.name()).option("paths", json.dumps(_paths(path))).option("columns", json.dumps(schema.names))
            .option("names", json.dumps([wanted.holds, wanted.like, wanted.unlike])).option("part_bytes", part_bytes).load()
        )
        return text.select(*[F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in schema.fields], "file_name")
    # the names are compared before a file is opened
    files = [f"{_literal(f)}" for _, f, _ in list_files(_paths(path)) if f in wanted]
    empty = spark.createDataFrame([], T.StructType([*schema.fields, T.StructField("file_name", T.StringType())]))
    if not files:
        return empty
    return spark.read.schema(schema).format(fmt).load(files).withColumn("file_name", names.decoded(F.col("_metadata.file_name")))


def _literal(path: str) -> str:
    """A file's name as a pattern that fits it alone."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", path)


def _sides(device: str | None) -> tuple[Names, Names]:
    """Names of reading and of rating files, of one device or of all."""
    bracketed = None if device is None else f"({device})"
    return Names(bracketed, None, names.RATING_FILE.pattern), Names(bracketed, names.RATING_FILE.pattern)


def route_files(spark: SparkSession, path: str | Sequence[str], device: str, fmt: str = "csv",
                reading_schema: T.StructType = READING_SCHEMA,
                rating_schema: T.StructType = RATING_SCHEMA) -> tuple[DataFrame, DataFrame]:
    """Readings and ratings of one device, told apart by file name.

    Files carry the device in brackets; those with the word Rating hold ratings.
    Raises ``FileNotFoundError`` when the device has no files, or none of one kind; a file
    without rows counts as there.
    """
    sides = _sides(device)
    readings, ratings = (any(f in side for _, f, _ in list_files(_paths(path))) for side in sides)
    if not readings or not ratings:
        what = "files" if not readings and not ratings else "rating files" if readings else "reading files"
        raise FileNotFoundError(f"no {what} for device {device} in {path}")
    return (_located(_load(spark, path, reading_schema, fmt, sides[0]), device),
            _load(spark, path, rating_schema, fmt, sides[1]).drop("file_name"))


def _located(df: DataFrame, device: str | None) -> DataFrame:
    out = df.withColumn("location", names.location_of(F.col("file_name")))
    if device is not None:
        out = out.withColumn("device", F.lit(device))
    return out.drop("file_name")


def read_readings(spark: SparkSession, path: str | Sequence[str], device: str | None = None, fmt: str = "csv",
                  schema: T.StructType = READING_SCHEMA, part_bytes: int = PART_BYTES) -> DataFrame:
    """All reading files, each row tagged with the location named by its file.

    Files are chosen by name, so rating files and other devices' files are not opened.
    Without ``device`` the bracketed name becomes the device. A task reads bounded sets of files, or
    ``part_bytes`` of a larger one.
    """
    files = _load(spark, path, schema, fmt, _sides(device)[0], part_bytes)
    if device is None:
        files = files.withColumn("device", F.regexp_extract("file_name", r"\(([^()]*)\)[^)]*$", 1))
    return _located(files, device)


def clean_readings(df: DataFrame) -> DataFrame:
    """Parsed time and canonical device; the text columns and the id go."""
    return with_datetime(df).withColumn("device", canonical_device(F.col("device"))).drop("Date", "Time", "id")


def clean_ratings(df: DataFrame, device: str = "Device") -> DataFrame:
    return with_datetime(df).withColumn("device", canonical_device(F.col(device))).drop("Date", "Time")


def read_stage(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "csv",
               time_to: str | None = None) -> DataFrame:
    """Read back a merged or feature table; drops a stray index column, may rename its time."""
    reader = spark.read.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True).option("enforceSchema", False)
    df = reader.format(fmt).load(path).drop("Unnamed: 0")
    return df.withColumnRenamed("datetime", time_to) if time_to else df
