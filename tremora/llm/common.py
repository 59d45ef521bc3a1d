"""Small helpers that several operators share."""

from __future__ import annotations

import pickle
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tremora.session import materialise, scratch_path, scratch_root

__all__ = ["materialise", "scratch_path", "scratch_root"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_text(docs: DataFrame) -> DataFrame:
    """Only the two columns every operator reads; a null text becomes empty."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))


def with_row(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with a column that names every row, the same in each reading, and that column's name.

    Rows of files are named by file and place in it; others are stored once under numbers.
    """
    name = "_row"
    while name in docs.columns:
        name += "_"
    try:
        file = F.col("_metadata.file_path")
        return docs.withColumn(name, F.struct(
            F.xxhash64(file).alias("a"), F.xxhash64(F.reverse(file)).alias("b"), F.col("_metadata.row_index").alias("at"))), name
    except AnalysisException:
        return materialise(docs.withColumn(name, F.struct(F.monotonically_increasing_id().alias("at"))), "numbered"), name


def fold(doc_id: str | Column, parts: int) -> Column:
    """crc32 of the id written as text, modulo ``parts``; a null id gives null."""
    col = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(col.cast("string").cast("binary")) % parts


def held_out(parts: int, remainder: int) -> Column:
    """Whether a document is kept from learning; a document without id is not."""
    return F.coalesce(fold("doc_id", parts) == remainder, F.lit(False))


def sample_rank(*cols: str) -> Column:
    """A key that orders rows as if at random, the same in every run."""
    return F.xxhash64(*[F.col(c) for c in cols])


def draw(df: DataFrame, n: int, *key: str) -> DataFrame:
    """At most ``n`` rows as if at random, the same in every run.

    The table is counted first, and a share of it that holds about twice as many is
    ordered, so no task sees more than a few times ``n`` rows.
    """
    share = min(1.0, (2 * n + 100) / max(1, df.count()))
    some = df.where(F.pmod(sample_rank(*key), F.lit(1 << 30)) <= int(share * (1 << 30)))
    return some.orderBy(sample_rank(*key), *key).limit(n)


class Shared:
    """A value of bounded size sent to every executor once. Its class may live in this package,
    which executors need not have installed."""

    def __init__(self, spark: SparkSession, value: object) -> None:
        self.sent = spark.sparkContext.broadcast(cloudpickle.dumps(value))

    def get(self) -> object:
        value = pickle.loads(self.sent.value)
        vars(self.sent).pop("_value", None)  # the pickled bytes are read from the executor's file when asked for again
        return value


def utf8_texts(batch: pa.RecordBatch, name: str = "text") -> Iterator[bytes]:
    """The texts of a batch as UTF-8, one at a time, without decoding them; null gives b""."""
    col = batch.column(name)
    col = col.cast(pa.large_binary())
    for v in col:
        yield v.as_py() or b""


def slices(batch: pa.RecordBatch, name: str, most: int) -> Iterable[pa.RecordBatch]:
    """Parts of a batch whose texts hold about ``most`` bytes each (one text at least)."""
    size = np.frombuffer(b"".join(len(t).to_bytes(8, "little") for t in utf8_texts(batch, name)), "<i8")
    part = np.cumsum(size) // max(1, most)
    edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    return [batch.slice(a, b - a) for a, b in zip(edges, edges[1:]) if b > a]


def gram_codes(text: bytes, sizes: Iterable[int], bits: int) -> np.ndarray:
    """Hash of every byte n-gram of a text, for each n in ``sizes``, into ``bits`` bits."""
    a = np.frombuffer(text, np.uint8).astype(np.uint32)
    out, code = [], np.zeros(len(a), np.uint32)
    wanted = set(sizes)
    for n in range(1, max(wanted) + 1):
        if len(a) < n:
            break
        code = code[: len(a) - n + 1] * np.uint32(0x01000193) + a[n - 1 :] + np.uint32(1)
        if n in wanted:
            mixed = (code ^ (code >> np.uint32(15))) * np.uint32(0x9E3779B1) + np.uint32(n * 0x85EBCA6B & 0xFFFFFFFF)
            mixed = (mixed ^ (mixed >> np.uint32(13))) * np.uint32(0xC2B2AE35)
            out.append(mixed >> np.uint32(32 - bits))
    return np.concatenate(out) if out else np.zeros(0, np.uint32)


def present(text: bytes, sizes: Iterable[int], bits: int, flags: np.ndarray, block: int = 1 << 20) -> np.ndarray:
    """Sorted distinct gram codes of a text. ``flags`` is scratch of 2**bits zeros, left zeroed.

    Long texts are read in overlapping blocks, so memory stays bounded.
    """
    overlap = max(sizes) - 1
    for at in range(0, max(1, len(text) - overlap), block):
        flags[gram_codes(text[at : at + block + overlap], sizes, bits)] = True
    found = np.flatnonzero(flags)
    flags[found] = False
    return found
