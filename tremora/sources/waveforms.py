"""Waveform recordings: JSON documents and binary files."""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tremora.config import WAVEFORM_SCHEMA
from tremora.functions import names
from tremora.session import settings
from tremora.sources.files import BinaryParts

BATCH_FILES = 16_384  # of a stream, listed and planned together


def _depth(spark: SparkSession, path: str) -> int:
    """Components of ``path`` once it is absolute; a pattern stands for as many as it has."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    full = hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(hadoop)
    return len([c for c in full.toUri().getPath().split("/") if c])


def scan_waveform_json(spark: SparkSession, path: str, device: str | None = None) -> DataFrame:
    """One row per JSON file below ``path``: arrays, ``filepath`` and ``file_name``.

    With ``device`` only files whose folders below ``path`` contain it are kept; the name of
    ``path`` itself does not count. A file that does not parse gives a row with null arrays.
    """
    df = (
        spark.read.schema(WAVEFORM_SCHEMA).option("multiLine", True).option("mode", "PERMISSIVE")
        .option("recursiveFileLookup", True).option("pathGlobFilter", "*.[jJ][sS][oO][nN]").json(path)
        .withColumn("filepath", names.decoded(F.col("_metadata.file_path")))
        .withColumn("file_name", names.decoded(F.col("_metadata.file_name")))
    )
    if device is not None:
        inside = F.split(F.regexp_replace("filepath", "^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", ""), "/+")
        # after the leading empty part and the base, and without the file's own name
        folders = F.slice(inside, _depth(spark, path) + 2, F.greatest(F.size(inside) - _depth(spark, path) - 2, F.lit(0)))
        df = df.where(F.contains(F.concat_ws("/", folders), F.lit(device)))
    return df.select("axisX", "axisY", "filepath", "file_name")


def _decode_udf():
    @F.pandas_udf("struct<fs: double, axisY: array<float>>")
    def decode(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for contents in batches:
            fs, ys = [], []
            for raw in contents:
                values = np.frombuffer(raw, dtype="<f4") if raw is not None and len(raw) >= 8 and len(raw) % 4 == 0 else None
                good = values is not None and values[0] > 0
                fs.append(float(values[0]) if good else None)
                ys.append(values[1:] if good else None)
            yield pd.DataFrame({"fs": pd.Series(fs, dtype="float64"), "axisY": pd.Series(ys, dtype="object")})

    return decode


def decode_waveforms(files: DataFrame, content: str = "content") -> DataFrame:
    """Decode a little-endian float32 rate followed by float32 samples; bad content gives nulls."""
    decoded = files.withColumn("_d", _decode_udf()(F.col(content)))
    return decoded.withColumn("fs", F.col("_d.fs")).withColumn("axisY", F.col("_d.axisY")).drop("_d", content)


def scan_waveform_binary(spark: SparkSession, path: str) -> DataFrame:
    """All ``*_YYYYMMDD_HHMMSS.Single`` files below ``path``, decoded; other names are dropped."""
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.[sS][iI][nN][gG][lL][eE]").load(path)
        .select(F.col("path").alias("filepath"), "content")
    )
    timed = files.withColumn("timestamp", names.binary_wave_time(names.base_name(F.col("filepath"))))
    return decode_waveforms(timed.where(F.col("timestamp").isNotNull()))


def scan_waveform_parts(spark: SparkSession, path: str, part_bytes: int | None = None) -> DataFrame:
    """The same files in pieces, so that one recording of any size is decoded by many tasks.

    One row a piece: ``filepath``, ``timestamp``, ``start`` (samples before it), ``fs`` and ``axisY``, of at most
    ``part_bytes`` (8 MB unless named). A file that does not decode gives one row with nulls.
    """
    spark.dataSource.register(BinaryParts)
    reader = spark.read.format(BinaryParts.name()).option("paths", json.dumps([path])).option(
        "names", json.dumps([None, names.BINARY_TIME_SUFFIX, None]))
    pieces = (reader.option("part_bytes", part_bytes) if part_bytes else reader).load()
    timed = pieces.withColumn("timestamp", names.binary_wave_time(names.base_name(F.col("filepath"))))
    return timed.where(F.col("timestamp").isNotNull()).select("filepath", "timestamp", "start", "fs", "axisY")


def waveform_json_stream(spark: SparkSession, path: str, files_per_trigger: int | None = 256) -> DataFrame:
    """JSON recordings as a stream of files, each read once for a checkpoint; see ``streaming.jobs.run_available``.

    A file that does not parse gives a row with null arrays. Folders are looked through at all depths.
    """
    reader = (
        spark.readStream.schema(WAVEFORM_SCHEMA).option("multiLine", True).option("mode", "PERMISSIVE")
        .option("recursiveFileLookup", True).option("pathGlobFilter", "*.[jJ][sS][oO][nN]")
    )
    reader = reader.option("maxFilesPerTrigger", files_per_trigger) if files_per_trigger else reader
    return (
        reader.json(path).withColumn("filepath", names.decoded(F.col("_metadata.file_path")))
        .withColumn("file_name", names.decoded(F.col("_metadata.file_name"))).select("axisX", "axisY", "filepath", "file_name")
    )


def waveform_binary_stream(spark: SparkSession, path: str, files_per_trigger: int | None = BATCH_FILES) -> DataFrame:
    """Binary recordings of up to 2 GB as a stream of files, decoded, each read once for a checkpoint.

    ``files_per_trigger`` bounds a batch of backlog; each batch has costs of its own, so name fewer only for large files.
    """
    schema = "path string, modificationTime timestamp, length long, content binary"
    reader = spark.readStream.format("binaryFile").schema(schema).option("recursiveFileLookup", True).option("pathGlobFilter", "*.[sS][iI][nN][gG][lL][eE]")
    reader = reader.option("maxFilesPerTrigger", files_per_trigger) if files_per_trigger else reader
    with settings(spark, **{"spark.sql.sources.ignoreDataLocality": "true"}):  # all files are listed here too, for columns in their paths alone
        files = reader.load(path).select(F.col("path").alias("filepath"), "content")
    timed = files.withColumn("timestamp", names.binary_wave_time(names.base_name(F.col("filepath"))))
    return decode_waveforms(timed.where(F.col("timestamp").isNotNull()))
