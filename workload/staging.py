"""Real files with given names, for the queries of the sources, written by the tasks that hold their rows."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from tremora.session import scratch_path
from tremora.sources.files import file_system


def _put(path: str, name: str, content: bytes) -> None:
    """A task that runs again replaces its file."""
    system, base = file_system(path)
    full = f"{base}/{name}"
    system.create_dir(full.rsplit("/", 1)[0], recursive=True)
    with system.open_output_stream(full) as out:
        out.write(content)


def file_per_row(files: DataFrame, path: str | None = None) -> str:
    """A file for each row (name, content): text or bytes; names may hold folders. Returns the folder."""
    path = path or scratch_path(files.sparkSession, "files")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, content in zip(b.column("name").to_pylist(), b.column("content").to_pylist()):
                _put(path, name, content.encode() if isinstance(content, str) else bytes(content))
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows], pa.int64())], names=["n"])

    files.select("name", "content").mapInArrow(run, "n long").agg(F.sum("n")).collect()
    return path


def csv_files(df: DataFrame, columns: Sequence[str], before: Column | str, after: Column | str, path: str | None = None) -> str:
    """CSV files with a header, one for each (before, after) and batch of a task: ``<before>#<task>.<batch><after>``. Returns the folder."""
    path = path or scratch_path(df.sparkSession, "files")
    columns = list(columns)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        for k, b in enumerate(batches):
            held: dict[str, list[str]] = {}
            for before, after, line in zip(*(b.column(c).to_pylist() for c in ("_before", "_after", "_line"))):
                held.setdefault(f"{before}#{task}.{k}{after}", [",".join(columns)]).append(line)
            for name, lines in held.items():
                _put(path, name, ("\n".join(lines) + "\n").encode())
            yield pa.RecordBatch.from_arrays([pa.array([len(held)], pa.int64())], names=["n"])

    as_column = lambda c: F.lit(c) if isinstance(c, str) else c
    lines = df.select(as_column(before).alias("_before"), as_column(after).alias("_after"), F.to_csv(F.struct(*columns)).alias("_line"))
    lines.mapInArrow(run, "n long").agg(F.sum("n")).collect()
    return path
