"""Folders of numbered tables that streaming runs leave and read."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tremora.session import settings


def folders(spark: SparkSession, path: str) -> list[str] | None:
    """Names below ``path``, None if there is no such folder."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(spark._jsc.hadoopConfiguration())
    return [s.getPath().getName() for s in fs.listStatus(where)] if fs.exists(where) else None


def numbers(spark: SparkSession, path: str, prefix: str = "") -> list[int]:
    names = [n.removeprefix(prefix) for n in folders(spark, path) or [] if n.startswith(prefix)]
    return sorted(int(n) for n in names if n.isdigit())


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether a table was written to its end."""
    where = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def latest(spark: SparkSession, path: str, before: int | None = None) -> int:
    """Largest number of a complete table below ``path`` (smaller than ``before``), -1 without one."""
    for n in reversed(numbers(spark, path)):
        if (before is None or n < before) and is_complete(spark, f"{path}/{n}"):
            return n
    return -1


def delete(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def each_batch(stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, **conf: str):
    """Run ``write(batch, number)`` over everything that is there and return the finished query."""
    with settings(stream.sparkSession, **conf):
        query = (
            stream.writeStream.foreachBatch(write).outputMode("append")
            .option("checkpointLocation", f"{checkpoint}/query").trigger(availableNow=True).start()
        )
    query.awaitTermination()
    return query
