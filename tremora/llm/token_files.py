"""Token-id files: canonical length-limited Huffman codes in independent blocks.

Layout below a folder, in ascending order of doc_id:

``blocks/part=<p>/``  Parquet rows, one per block of at most ``BLOCK`` ids: ``block`` (its
    number in the part), ``start`` (ids of the corpus before it), ``doc_ids`` and
    ``doc_tokens`` (ids of each document in this block, end id included), ``skip`` (ids of
    its first document in earlier blocks), ``marks`` (the bit offset of every ``EVERY``-th
    id) and ``bits`` (codes, most significant bit first).
``codebook/``  id and code length; the canonical codes follow from these.

A block is decoded alone, and inside a block all marks are decoded side by side with
one table look-up per id, so reading splits as finely as one likes.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from tremora.llm.common import Shared, id_text, materialise, slices, utf8_texts
from tremora.llm.tokens import BYTE_BPE, encoder, tokenizer_path

BLOCK = 1 << 18
EVERY = 256
LIMIT = 16  # bits of the longest code; one more for each doubling of the vocabulary past 65,536
END = 0

# codes ---------------------------------------------------------------------------------------------


def code_lengths(counts: np.ndarray, limit: int) -> np.ndarray:
    """Code lengths of at most ``limit`` bits that minimise the coded size (package-merge); 0 where a count is 0."""
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), np.uint8)
    if len(used) < 2:
        lengths[used] = 1
        return lengths
    if len(used) > 1 << limit:
        raise ValueError(f"{len(used)} symbols do not fit into {limit} bits")
    order = used[np.argsort(counts[used], kind="stable")]
    weights = counts[order].astype(np.int64)
    packages, levels = np.zeros(0, np.int64), []
    for _ in range(limit):
        merged = np.concatenate([weights, packages])
        rank = np.argsort(merged, kind="stable")  # of equal weights, single symbols first
        levels.append(rank >= len(weights))
        merged = merged[rank]
        packages = merged[: len(merged) // 2 * 2].reshape(-1, 2).sum(axis=1)
    many, taken = np.zeros(len(order) + 1, np.int64), 2 * len(order) - 2
    for is_package in reversed(levels):
        whole = int(is_package[:taken].sum())
        many[taken - whole] += 1  # the lightest taken - whole symbols are one bit longer
        taken = 2 * whole
    lengths[order] = np.cumsum(many[::-1])[::-1][1:]
    return lengths


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """Codes ascending by (length, id)."""
    codes = np.zeros(len(lengths), np.uint64)
    used = np.flatnonzero(lengths)
    order = used[np.lexsort((used, lengths[used]))]
    widest = int(lengths.max(initial=0))
    size = np.left_shift(np.uint64(1), (widest - lengths[order].astype(np.int64)).astype(np.uint64))
    codes[order] = (np.cumsum(size) - size) >> (widest - lengths[order].astype(np.int64)).astype(np.uint64)
    return codes


class Codebook:
    def __init__(self, lengths: np.ndarray) -> None:
        self.lengths = lengths.astype(np.int64)
        self.codes = canonical_codes(lengths)
        self.widest = max(1, int(lengths.max(initial=0)))

    def table(self) -> tuple[np.ndarray, np.ndarray]:
        """Id and length for every value of the next ``widest`` bits."""
        used = np.flatnonzero(self.lengths)
        order = used[np.lexsort((used, self.lengths[used]))]
        span = 1 << (self.widest - self.lengths[order])
        ids, bits = np.repeat(order, span), np.repeat(self.lengths[order], span)
        rest = (1 << self.widest) - len(ids)
        return np.append(ids, np.zeros(rest, np.int64)).astype("<u4"), np.append(bits, np.ones(rest, np.int64))

    def pack(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """Coded bits, and the bit offset of every EVERY-th id."""
        n = self.lengths[ids]
        ends = np.cumsum(n)
        at = ends - n
        total = int(ends[-1]) if len(ids) else 0
        word, inside = at >> 5, at & 31
        value = self.codes[ids] << (64 - inside - n).astype(np.uint64)
        size = (total >> 5) + 2
        # the codes of a word do not overlap, so their sum is exact in 53 bits
        words = np.bincount(word, (value >> np.uint64(32)).astype(np.float64), size)
        words += np.bincount(word + 1, (value & np.uint64(0xFFFFFFFF)).astype(np.float64), size)
        return words.astype(">u4").tobytes()[: (total + 7) // 8], at[::EVERY].astype("<u4")


def unpack(bits: bytes, marks: np.ndarray, n: int, table: tuple[np.ndarray, np.ndarray], widest: int) -> np.ndarray:
    """The ``n`` ids of a block; every mark is a lane, and a step decodes one id of each."""
    if not n:
        return np.zeros(0, "<u4")
    ids, lengths = table
    buffer = bits + bytes(8 + EVERY * widest // 8)
    words = np.ndarray((len(buffer) - 3,), ">u4", buffer, strides=(1,))  # the four bytes from each place on
    at, out = marks.astype(np.int64), np.empty((EVERY, len(marks)), "<u4")
    mask = (1 << widest) - 1
    for k in range(min(EVERY, n)):
        x = (words[at >> 3].astype(np.int64) >> (32 - widest - (at & 7))) & mask
        out[k] = ids[x]
        at += lengths[x]
    return out.T.reshape(-1)[:n]


# crc of parts ----------------------------------------------------------------------------------------


def crc_join(first: int, second: int, size: int) -> int:
    """crc32 of two byte strings one after the other, from theirs and the second's size."""

    def times(matrix: list[int], v: int) -> int:
        out, i = 0, 0
        while v:
            if v & 1:
                out ^= matrix[i]
            v, i = v >> 1, i + 1
        return out

    power = [0xEDB88320] + [1 << i for i in range(31)]  # the effect of one zero bit, then of 8 * size of them
    size *= 8
    while size:
        if size & 1:
            first = times(power, first)
        power = [times(power, p) for p in power]
        size >>= 1
    return first ^ second


# writing ---------------------------------------------------------------------------------------------

_STAGED = pa.schema([
    ("part", pa.int32()), ("block", pa.int32()), ("doc_ids", pa.list_(pa.int64())), ("doc_tokens", pa.list_(pa.int32())),
    ("skip", pa.int64()), ("n", pa.int32()), ("ids", pa.binary()), ("counts", pa.binary())])
_STAGED_DDL = "part int, block int, doc_ids array<long>, doc_tokens array<int>, skip long, n int, ids binary, counts binary"


def _blocks(part: int, documents: Iterable[tuple[int | None, np.ndarray]]) -> Iterator[dict]:
    """Cut the ids of documents in order into blocks of BLOCK ids; a document may go on in the next.
    The last block also has how often each id occurs in the part."""
    block, held, ids, docs, many, skip, total = 0, 0, [], [], [], 0, np.zeros(0, np.int64)

    def row(last: bool = False) -> dict:
        nonlocal total
        own = np.concatenate(ids)
        n = np.bincount(own)
        total, n = (total, n) if len(total) >= len(n) else (n, total)
        total[: len(n)] += n
        return {"part": part, "block": block, "doc_ids": docs, "doc_tokens": many, "skip": skip, "n": held,
                "ids": own.tobytes(), "counts": total.astype("<i8").tobytes() if last else None}

    for doc, own in documents:
        at = 0
        while at < len(own):
            if held == BLOCK:
                yield row()
                block, held, ids, docs, many, skip = block + 1, 0, [], [], [], at
            take = min(len(own) - at, BLOCK - held)
            ids.append(own[at : at + take])
            docs.append(doc)
            many.append(take)
            held, at = held + take, at + take
    if held:
        yield row(True)


def stage_tokens(docs: DataFrame, path: str, width: str) -> DataFrame:
    """Blocks of plain ids in ascending doc_id order; a part is a range of doc_ids."""
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path).encode

        def documents() -> Iterator[tuple[int | None, np.ndarray]]:
            for whole in batches:
                for b in slices(whole, "text", 1 << 22):
                    ids, many = encode(list(utf8_texts(b)))
                    own = np.zeros(len(ids) + len(many), width)  # END is 0
                    ends = np.cumsum(many + 1)
                    inside = np.ones(len(own), bool)
                    inside[ends - 1] = False
                    own[inside] = ids
                    yield from zip(b.column("doc_id").to_pylist(), np.split(own, ends[:-1]))

        for row in _blocks(TaskContext.get().partitionId(), documents()):
            yield pa.RecordBatch.from_pylist([row], schema=_STAGED)

    ordered = id_text(docs).repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id")
    return materialise(ordered.mapInArrow(run, _STAGED_DDL), "token-blocks")


def id_counts(staged: DataFrame) -> np.ndarray:
    """How often each id occurs in the corpus, from the counts of the parts; as many entries as the vocabulary has."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for b in batches:
            for counts in b.column("counts"):
                n = np.frombuffer(counts.as_buffer(), "<i8").copy()
                total, n = (total, n) if len(total) >= len(n) else (n, total)
                total[: len(n)] += n
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["id", "n"])

    rows = staged.where("counts is not null").select("counts").mapInArrow(run, "id long, n long")
    rows = rows.groupBy("id").agg(F.sum("n").alias("n")).toArrow()
    ids, n = rows.column("id").to_numpy(), rows.column("n").to_numpy()
    counts = np.zeros(int(ids.max(initial=0)) + 1, np.int64)
    counts[ids] = n
    return counts


_CODED = pa.schema([
    ("part", pa.int32()), ("block", pa.int32()), ("start", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
    ("doc_tokens", pa.list_(pa.int32())), ("skip", pa.int64()), ("n", pa.int32()), ("marks", pa.binary()), ("bits", pa.binary())])
_CODED_DDL = ("part int, block int, start long, doc_ids array<long>, doc_tokens array<int>, skip long, n int, "
              "marks binary, bits binary")


def write_token_files(docs: DataFrame, path: str, tokenizer: str | None = None) -> None:
    """Encode every whole text, append the end id, and write the files below ``path``.

    A null or empty text is its end id alone. Rows without doc_id come first; rows that
    repeat one follow each other. Ids are staged once, counted, coded and written.
    """
    spark = docs.sparkSession
    model = tokenizer or tokenizer_path(BYTE_BPE)
    width = "<u2" if encoder(model).model.get_vocab_size(with_added_tokens=True) <= 1 << 16 else "<u4"
    staged = stage_tokens(docs, model, width)
    counts = id_counts(staged)
    limit = max(LIMIT, int(len(counts) - 1).bit_length())
    lengths = code_lengths(counts, limit)
    used = np.flatnonzero(lengths)
    spark.createDataFrame(pa.table({"id": used, "length": lengths[used].astype(np.int32)})).coalesce(1).write.parquet(f"{path}/codebook")
    before, starts = 0, {}
    for part, n in sorted(tuple(r) for r in staged.groupBy("part").agg(F.sum("n")).collect()):  # one row per part
        starts[part] = before
        before += n
    shared = Shared(spark, (lengths, starts))  # one entry per id of the vocabulary and per part

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths, starts = shared.get()
        book = Codebook(lengths)
        for b in batches:
            for row in b.to_pylist():
                bits, marks = book.pack(np.frombuffer(row.pop("ids"), width).astype(np.int64))
                start = starts[row["part"]] + row["block"] * BLOCK  # all blocks of a part but its last are full
                yield pa.RecordBatch.from_pylist([row | {"start": start, "marks": marks.tobytes(), "bits": bits}], schema=_CODED)

    (staged.drop("counts").mapInArrow(run, _CODED_DDL).write.option("compression", "none").partitionBy("part").parquet(f"{path}/blocks"))


# reading ---------------------------------------------------------------------------------------------

_PIECE = pa.schema([("doc_start", pa.int64()), ("at", pa.int64()), ("doc_id", pa.int64()), ("n", pa.int64()),
                    ("crc", pa.int64()), ("ids", pa.binary())])
_PIECE_DDL = "doc_start long, at long, doc_id long, n long, crc long, ids binary"


def read_pieces(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """One row per document and block: doc_start, at (place of its first id here), doc_id, n, crc, ids.

    ``ids`` holds little-endian unsigned 32-bit integers (null without ``with_ids``) and ``crc`` their crc32.
    """
    book = spark.read.parquet(f"{path}/codebook").toArrow()
    ids = book.column("id").to_numpy()
    lengths = np.zeros(int(ids.max(initial=0)) + 1, np.uint8)
    lengths[ids] = book.column("length").to_numpy()
    shared = Shared(spark, lengths)  # one entry per id of the vocabulary

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book = Codebook(shared.get())
        table = book.table()
        for b in batches:
            for row in b.to_pylist():
                ids = unpack(row["bits"], np.frombuffer(row["marks"], "<u4"), row["n"], table, book.widest)
                many = np.array(row["doc_tokens"], np.int64)
                at = np.cumsum(many) - many
                own = [ids[a : a + n].tobytes() for a, n in zip(at.tolist(), many.tolist())]
                first = at + row["start"]
                doc_start = first.copy()
                doc_start[0] -= row["skip"]
                yield pa.RecordBatch.from_arrays([
                    pa.array(doc_start), pa.array(first), pa.array(row["doc_ids"], pa.int64()), pa.array(many),
                    pa.array([zlib.crc32(o) for o in own], pa.int64()),
                    pa.array(own if with_ids else [None] * len(own), pa.binary())], schema=_PIECE)

    stored = spark.read.schema(_CODED_DDL).parquet(f"{path}/blocks")
    return stored.select(*_CODED.names).mapInArrow(run, _PIECE_DDL)


def _join_crc(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        out = []
        for pieces in b.column("pieces").to_pylist():
            crc = pieces[0]["crc"]
            for p in pieces[1:]:
                crc = crc_join(crc, p["crc"], 4 * p["n"])
            out.append(crc)
        yield pa.RecordBatch.from_arrays(
            [*(b.column(c) for c in ("doc_id", "start", "n_tokens")), pa.array(out, pa.int64())],
            names=["doc_id", "start", "n_tokens", "ids_crc32"])


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, decoded from the files."""
    pieces = read_pieces(spark, path, with_ids=False).groupBy("doc_start").agg(
        F.first("doc_id").alias("doc_id"), F.sum("n").alias("n_tokens"),
        F.sort_array(F.collect_list(F.struct("at", "n", "crc"))).alias("pieces"))  # a few per document
    return pieces.withColumnRenamed("doc_start", "start").mapInArrow(
        _join_crc, "doc_id long, start long, n_tokens long, ids_crc32 long")
