"""Files read inside tasks: which there are, and data sources that cut them into bounded parts.

Paths are folders, files, or patterns for files of one folder, on any file system that pyarrow knows
(local disk, s3, hdfs, gs, abfs).
"""

from __future__ import annotations

import csv
import fnmatch
import io
import json
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import csv as pacsv, fs as pafs
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

PART_BYTES = 64 << 20  # of files that one task reads; a larger file is cut
PART_FILES = 2_000  # that one task opens
_CHUNK = 8 << 20  # bytes of a file parsed at a time
_LEAST = 1 << 14  # bytes that are not worth a task of their own


def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path, and the path in it. ``file:`` and bare paths stand as they are, not percent-encoded."""
    local = re.match(r"file:/*(?=/)", path)
    if local or "://" not in path:
        return pafs.LocalFileSystem(), path[local.end():] if local else path
    return pafs.FileSystem.from_uri(re.sub(r"^s3[an]://", "s3://", path))


def list_files(paths: Sequence[str], recursive: bool = False) -> Iterator[tuple[str, str, int]]:
    """(the path asked for, path in its file system, bytes) of all files below ``paths``, in order; hidden ones are left out."""
    for path in paths:
        system, inside = file_system(path.rstrip("/"))
        info = system.get_file_info(inside)
        pattern = None
        if info.type == pafs.FileType.NotFound and any(c in inside for c in "*?["):
            inside, pattern = inside.rsplit("/", 1)
            info = system.get_file_info(inside)
        if info.type == pafs.FileType.NotFound:
            raise FileNotFoundError(path)
        found = [info] if info.is_file else system.get_file_info(pafs.FileSelector(inside, recursive=recursive))
        for f in sorted(found, key=lambda f: f.path):
            if f.is_file and not f.base_name.startswith(("_", ".")) and (pattern is None or fnmatch.fnmatchcase(f.base_name, pattern)):
                yield path, f.path, f.size


@dataclass(frozen=True)
class Names:
    """Which files are wanted, by their names."""

    holds: str | None = None  # text that stands in the name
    like: str | None = None  # a pattern found in the name
    unlike: str | None = None  # a pattern not found in it

    def __contains__(self, path: str) -> bool:
        name = path.rsplit("/", 1)[-1]
        return ((self.holds is None or self.holds in name) and (self.like is None or bool(re.search(self.like, name)))
                and not (self.unlike is not None and re.search(self.unlike, name)))


class Parts(InputPartition):
    """(path asked for, path in its file system, first byte, end) of what one task reads."""

    def __init__(self, ranges: list[tuple[str, str, int, int]]) -> None:
        self.ranges = ranges


def bounded_parts(files: Iterator[tuple[str, str, int]], part_bytes: int, step: int = 1, head: int = 0) -> list[Parts]:
    """Files in parts of at most PART_FILES and ``part_bytes`` (or a few KB); larger files are cut, behind the first ``head`` bytes at multiples of ``step``."""
    parts: list[Parts] = []
    held: list[tuple[str, str, int, int]] = []
    size = 0
    part_bytes = max(step, part_bytes // step * step)
    together = max(part_bytes, _LEAST)
    for path, inside, many in files:
        at = 0
        while at < many or at == many == 0:
            end = min(many, (head if not at else 0) + at + part_bytes)
            if held and (size + end - at > together or len(held) >= PART_FILES):
                parts.append(Parts(held))
                held, size = [], 0
            held.append((path, inside, at, end))
            size += end - at
            at = end
            if not many:
                break
    if held:
        parts.append(Parts(held))
    return parts


# CSV -----------------------------------------------------------------------------------------------


def _lines(stream, first: int, end: int) -> Iterator[bytes]:
    """Whole lines that begin in [first, end), some megabytes at a time. The line at byte 0 is the header's."""
    stream.seek(max(0, first - 1))
    rest = stream.read(min(_CHUNK, end - first + 1))
    at = max(0, first - 1) + len(rest)
    while (cut := rest.find(b"\n")) < 0:  # skip to the first line that begins here
        more = stream.read(_CHUNK)
        if not more:
            return
        at, rest = at + len(more), more
    at_line = at - len(rest) + cut + 1
    rest = rest[cut + 1 :]
    while at_line < end:
        # what begins before ``end`` and stops at a line end
        if at >= end and (last := rest.find(b"\n", max(0, end - 1 - at_line))) >= 0:
            yield rest[: last + 1]
            return
        if at < end and (last := rest.rfind(b"\n")) >= 0:
            yield rest[: last + 1]
            at_line, rest = at_line + last + 1, rest[last + 1 :]
        more = stream.read(_CHUNK)
        if not more:
            if rest:
                yield rest
            return
        rest, at = rest + more, at + len(more)


def _header(stream) -> list[str]:
    stream.seek(0)
    text = b""
    while b"\n" not in text and (more := stream.read(1 << 16)):
        text += more
    line = text.split(b"\n", 1)[0].decode("utf-8-sig", "replace")
    return next(csv.reader([line.rstrip("\r")], escapechar="\\"), [])


def _padded(block: bytes, columns: list[str]) -> list[list[str | None]]:
    """Rows of a block in which some have too few values, or too many."""
    out = []
    for row in csv.reader(io.StringIO(block.decode(errors="replace")), escapechar="\\"):
        if row:
            out.append(([v or None for v in row] + [None] * len(columns))[: len(columns)])
    return out


def csv_batches(stream, first: int, end: int, wanted: Sequence[str]) -> Iterator[pa.RecordBatch]:
    """Wanted columns, by name, of the rows that begin in [first, end) of a file with a header; all are text.

    Columns that the file lacks are null. Empty values are null; a row too short ends in nulls.
    """
    columns = _header(stream)
    if not columns:
        return
    for block in _lines(stream, first, end):
        try:
            t = pacsv.read_csv(
                pa.py_buffer(block), pacsv.ReadOptions(use_threads=False, column_names=columns, block_size=len(block) + 1),
                pacsv.ParseOptions(escape_char="\\"),
                pacsv.ConvertOptions(check_utf8=False, column_types=dict.fromkeys(columns, pa.string()), null_values=[""],
                                     strings_can_be_null=True, quoted_strings_can_be_null=False))
        except pa.ArrowInvalid as error:
            if "Empty CSV" in str(error):
                continue
            t = pa.table([pa.array(c, pa.string()) for c in zip(*_padded(block, columns))], names=columns)
        have = set(columns)
        yield from pa.table([t.column(c) if c in have else pa.nulls(t.num_rows, pa.string()) for c in wanted], names=list(wanted)).combine_chunks().to_batches()


class StagedCsv(DataSource):
    """CSV files of any column order stacked by column name, as text, with their names as ``file_name``.

    Headers and rows are read in the tasks, bounded sets of files or parts of a large one each.
    """

    @classmethod
    def name(cls) -> str:
        return "staged_csv"

    def schema(self) -> str:
        return ", ".join(f"`{c}` string" for c in [*json.loads(self.options["columns"]), "file_name"])

    def reader(self, schema) -> DataSourceReader:
        return StagedCsvReader(self.options)


class StagedCsvReader(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.paths, self.columns = json.loads(options["paths"]), json.loads(options["columns"])
        self.names, self.part_bytes = Names(*json.loads(options["names"])), int(options.get("part_bytes", PART_BYTES))

    def partitions(self) -> Sequence[InputPartition]:
        return bounded_parts((f for f in list_files(self.paths) if f[1] in self.names), self.part_bytes) or [Parts([])]

    def read(self, partition: Parts) -> Iterator[pa.RecordBatch]:
        names = [*self.columns, "file_name"]
        for path, inside, first, end in partition.ranges:
            system, _ = file_system(path)
            with system.open_input_file(inside) as stream:
                for b in csv_batches(stream, first, end, self.columns):
                    name = pa.array([inside.rsplit("/", 1)[-1]] * b.num_rows, pa.string())
                    yield pa.RecordBatch.from_arrays([*b.columns, name], names=names)


# binary recordings -------------------------------------------------------------------------------


class BinaryParts(DataSource):
    """Files of little-endian float32, the first of which is a rate, in pieces of at most ``part_bytes``.

    One row a piece: ``filepath``, ``size`` of the file, ``start`` (samples before the piece), ``fs`` and ``axisY``.
    A file that does not hold a rate and whole samples gives one row with nulls.
    """

    @classmethod
    def name(cls) -> str:
        return "binary_parts"

    def schema(self) -> str:
        return "filepath string, size long, start long, fs double, axisY array<float>"

    def reader(self, schema) -> DataSourceReader:
        return BinaryPartsReader(self.options)


_PIECE = pa.schema([("filepath", pa.string()), ("size", pa.int64()), ("start", pa.int64()), ("fs", pa.float64()), ("axisY", pa.list_(pa.float32()))])


class BinaryPartsReader(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.paths, self.names = json.loads(options["paths"]), Names(*json.loads(options["names"]))
        self.part_bytes = int(options.get("part_bytes", PART_BYTES // 8))

    def partitions(self) -> Sequence[InputPartition]:
        files = (f for f in list_files(self.paths, recursive=True) if f[1] in self.names)
        return bounded_parts(files, self.part_bytes, step=4, head=4) or [Parts([])]

    def read(self, partition: Parts) -> Iterator[pa.RecordBatch]:
        for path, inside, first, end in partition.ranges:
            system, _ = file_system(path)
            with system.open_input_file(inside) as stream:
                size = stream.size()
                rate = np.frombuffer(stream.read(4), "<f4") if size >= 4 else np.zeros(0, "<f4")
                good = size >= 8 and size % 4 == 0 and len(rate) == 1 and rate[0] > 0
                if not good:
                    if not first:
                        yield pa.RecordBatch.from_pylist([{"filepath": inside, "size": size, "start": 0, "fs": None, "axisY": None}], schema=_PIECE)
                    continue
                stream.seek(max(4, first))
                samples = np.frombuffer(stream.read(end - max(4, first)), "<f4")
                if not len(samples) and first:
                    continue
                arrays = [pa.array([inside]), pa.array([size], pa.int64()), pa.array([max(0, first // 4 - 1)], pa.int64()),
                          pa.array([float(rate[0])]), pa.array([samples], pa.list_(pa.float32()))]
                yield pa.RecordBatch.from_arrays(arrays, schema=_PIECE)
