"""Alignment of two tokenizers' tokens over the same bytes, by coalescing their intervals.

All tokens of both sides are sorted by their first byte, with the running maximum of their
ends beside them; where a start reaches that maximum, nothing spans the place and a group
of tokens ends. Inside a group, the tokens of one side are expanded against those of the
other that they overlap. A link is an overlapping pair that ends at the same byte.

Texts are cut before a space that stands behind a sign that is no space, and before a lone line end.
Neither tokenizer joins bytes across such a place, so the parts are encoded apart, and equal ones once.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tremora.llm.common import id_text, materialise
from tremora.llm.tokens import BYTE_BPE, byte_letters, rank_encoder, tokenizer_path, unusual_signs

PIECE_BPE = "piece_bpe_32k.model"
_CUT = re.compile(r"(?<=\S)(?= )")
_AMID = re.compile(r"\A\s|\s\s|\s\Z")  # white space that is not alone
_PARTS = 150_000  # parts of texts a task remembers, twice
_SIDE = 20_000  # new parts encoded and aligned side by side
_BLOCK = 1 << 22  # characters of the texts of a block; one text at least
_TOGETHER = 1 << 20  # characters of texts that are cut before their new parts are encoded, side by side

# intervals -----------------------------------------------------------------------------------------


def coalesce(a_start: np.ndarray, a_end: np.ndarray, b_start: np.ndarray, b_end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The group of every interval of a and of b, counted from 0.

    A group breaks where, in the order of starts, one reaches the running maximum of the ends.
    """
    start, end = np.concatenate([a_start, b_start]), np.concatenate([a_end, b_end])
    order = np.lexsort((end, start))
    reach = np.maximum.accumulate(end[order]) if len(order) else end
    breaks = np.zeros(len(order), np.int64)
    breaks[1:] = start[order][1:] >= reach[:-1]
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(breaks)
    return group[: len(a_start)], group[len(a_start) :]


def overlaps(a_start: np.ndarray, a_end: np.ndarray, b_start: np.ndarray, b_end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places (in a, in b) of all pairs that share a byte. Each side's intervals are in order and apart.

    The intervals of b that one of a meets stand side by side, and all of them in its group.
    """
    first = np.searchsorted(b_end, a_start, side="right")
    n = np.maximum(np.searchsorted(b_start, a_end, side="left") - first, 0)
    a = np.repeat(np.arange(len(a_start)), n)
    return a, np.repeat(first - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))


# texts ---------------------------------------------------------------------------------------------


class Aligner:
    """Tokens, groups and links of parts of texts, for a byte-level vocabulary and a piece model.

    A part that the second model spells otherwise than it stands (by its normaliser, or for a
    sign that it takes for a space) has None in place of its tokens.
    """

    def __init__(self, a_path: str, b_path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks already use every core
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True  # their strings in a text are plain text
        self.ranks, self.unusual = rank_encoder(a_path), unusual_signs()
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        byte = {x: b for b, x in enumerate(byte_letters())}
        vocab = self.a.get_vocab(with_added_tokens=False)
        self.a_size = np.zeros(self.a.get_vocab_size(with_added_tokens=True) + 1, np.int64)
        for token, i in vocab.items():
            self.a_size[i] = sum(x in byte for x in token)
        self.b_bytes = [self._spelled(i) for i in range(self.b.get_piece_size())]
        self.b_size = np.array([len(x) for x in self.b_bytes], np.int64)
        self.space = self.b.piece_to_id("▁")
        self.known: dict[str, tuple | None] = {}
        self.before: dict[str, tuple | None] = {}
        #: a line end that stands for itself is never joined to anything
        self.lines = not any(b"\n" in x and len(x) > 1 for x in self.b_bytes)

    def _spelled(self, i: int) -> bytes:
        if self.b.is_byte(i):
            return bytes([int(self.b.id_to_piece(i)[3:-1], 16)])
        return b"" if self.b.is_control(i) else self.b.id_to_piece(i).replace("▁", " ").encode()

    def _learn(self, parts: list[str]) -> None:
        """Parts that begin with neither a space nor a line end have a space before them."""
        whole = [p if p[0] in " \n" else " " + p for p in parts]
        a_ids = self._a_ids(whole)
        # the second tokenizer adds a space itself, which stands alone before a line end
        b_ids = self.b.encode([p if p[0] == "\n" else p[1:] for p in whole], num_threads=1)
        b_ids = [ids[1:] if p[0] == "\n" else ids or [self.space] for p, ids in zip(whole, b_ids)]
        spelled, right = self.b_bytes, []
        for k, (p, ids) in enumerate(zip(whole, b_ids)):
            if b"".join(map(spelled.__getitem__, ids)) == p.encode():
                right.append(k)
            else:
                self.known[parts[k]] = None
        for k, found in zip(right, self._align([a_ids[k] for k in right], [b_ids[k] for k in right])):
            self.known[parts[k]] = found

    def _a_ids(self, whole: list[str]) -> list[list[int]]:
        """By the quicker of two libraries with the same ranks, where both are sure to cut words alike."""
        if self.ranks is None:
            return [e.ids for e in self.a.encode_batch_fast(whole, add_special_tokens=False)]
        quick, odd = self.ranks.encode_ordinary, self.unusual.search
        out = [None if odd(p) else quick(p) for p in whole]
        rest = [k for k, ids in enumerate(out) if ids is None]
        for k, e in zip(rest, self.a.encode_batch_fast([whole[k] for k in rest], add_special_tokens=False)):
            out[k] = e.ids
        return out

    def _align(self, a_ids: list[list[int]], b_ids: list[list[int]]) -> Iterator[tuple]:
        """(tokens of a, of b, groups, the groups as text, pairs of ids of the links) of every part."""
        a_many, b_many = (np.fromiter(map(len, x), np.int64, len(x)) for x in (a_ids, b_ids))
        a, b = (np.fromiter((i for x in y for i in x), np.int64, int(n.sum())) for y, n in ((a_ids, a_many), (b_ids, b_many)))
        a_end, b_end = np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b])  # the parts lie side by side
        a_start, b_start = a_end - self.a_size[a], b_end - self.b_size[b]
        a_group, b_group = coalesce(a_start, a_end, b_start, b_end)
        i, j = overlaps(a_start, a_end, b_start, b_end)
        linked = a_end[i] == b_end[j]
        i, j = i[linked], j[linked]
        pairs = (a[i] << 32 | b[j]).astype("<u8")
        a_last = np.cumsum(a_many)
        link_last = np.searchsorted(i, a_last, side="left")
        # tokens in the order of writing: by group, a before b; what stands behind each follows from the next one
        side = np.concatenate([np.zeros(len(a), np.int8), np.ones(len(b), np.int8)])
        group = np.concatenate([a_group, b_group])
        order = np.lexsort((side, group))
        group, side, ids = group[order], side[order], np.concatenate([a, b])[order]
        groups_upto = np.append(a_group, group[-1] + 1 if len(group) else 0)[a_last]  # groups of this part and those before it
        mark = np.zeros(len(ids), np.int8)
        mark[:-1][side[1:] != side[:-1]] = 1
        mark[:-1][group[1:] != group[:-1]] = 2
        mark[np.searchsorted(group, groups_upto) - 1] = 3
        written = "".join(chain.from_iterable(zip(map(str, ids.tolist()), map(",|;\0".__getitem__, mark.tolist())))).split("\0")
        links, data = (8 * link_last).tolist(), pairs.tobytes()
        many = np.diff(groups_upto, prepend=0).tolist()
        yield from zip(a_many.tolist(), b_many.tolist(), many, written, [data[p:q] for p, q in zip([0, *links], links)])

    def texts(self, texts: Iterable[str | None]) -> Iterator[list[tuple] | None]:
        """What is known of the parts of each text; None if it has no tokens. Null and empty ones have none."""
        held: list[list[str]] = []
        size = 0
        for text in texts:
            held.append(self._parts(text) if text else [])
            size += len(text or "")
            if size >= _TOGETHER:
                yield from self._known(held)
                held, size = [], 0
        yield from self._known(held)

    def _known(self, texts: list[list[str]]) -> Iterator[list[tuple] | None]:
        if len(self.known) > _PARTS:  # parts not met for a while are forgotten
            self.known, self.before = {}, self.known
        known, before = self.known, self.before
        new = set().union(*texts).difference(known)
        met = new.intersection(before)
        known.update(zip(met, map(before.__getitem__, met)))
        new = list(new.difference(met))
        for at in range(0, len(new), _SIDE):
            self._learn(new[at : at + _SIDE])
        for parts in texts:
            found = list(map(known.__getitem__, parts))
            yield None if not found or None in found else found

    def _parts(self, text: str) -> list[str]:
        """The parts of a space and the text; most without the space they begin with."""
        if _AMID.search(text):
            return _CUT.split(" " + text)
        return (text.replace("\n", " \n") if self.lines else text).split(" ")


# corpus --------------------------------------------------------------------------------------------

_STAGED = pa.schema([
    ("block", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("n_a", pa.list_(pa.int64())), ("n_b", pa.list_(pa.int64())),
    ("n_groups", pa.list_(pa.int64())), ("n_links", pa.list_(pa.int64())), ("groups_sha256", pa.list_(pa.string())),
    ("a", pa.list_(pa.int32())), ("b", pa.list_(pa.int32())), ("n", pa.list_(pa.int64())), ("codes", pa.binary())])
_STAGED_DDL = ("block long, doc_ids array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, "
               "groups_sha256 array<string>, a array<int>, b array<int>, n array<long>, codes binary")


def _figures(found: list[tuple] | None) -> tuple[tuple, bytes]:
    """(n_a, n_b, n_groups, n_links, groups_sha256) of a text, and the pairs of ids of its links."""
    if found is None:
        return (0, 0, 0, 0, ""), b""
    a, b, groups, written, links = zip(*found)
    pairs = b"".join(links)
    return (sum(a), sum(b), sum(groups), len(pairs) // 8, hashlib.sha256(";".join(written).encode()).hexdigest()), pairs


def _block(name: int, ids: list[int | None], rows: list[tuple], pairs: list[bytes]) -> pa.RecordBatch:
    """Documents with their figures, the different pairs of their links, and for each link the place of its pair."""
    different, codes, n = np.unique(np.frombuffer(b"".join(pairs), "<u8"), return_inverse=True, return_counts=True)
    columns = [list(c) for c in zip(*rows)]
    row = [name, ids, *columns, (different >> np.uint64(32)).astype(np.int32), (different & np.uint64(0xFFFFFFFF)).astype(np.int32), n,
           codes.astype("<u2" if len(different) <= 1 << 16 else "<u4").tobytes()]
    return pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(row, _STAGED)], schema=_STAGED)


def stage(docs: DataFrame, a_path: str | None = None, b_path: str | None = None) -> DataFrame:
    """Blocks of aligned documents, stored: figures of each document, and the links by their pairs."""
    a_path, b_path = a_path or tokenizer_path(BYTE_BPE), b_path or tokenizer_path(PIECE_BPE)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, name = None, TaskContext.get().partitionId() << 32
        ids, rows, pairs, size = [], [], [], 0
        for b in batches:
            aligner = aligner or Aligner(a_path, b_path)
            lengths = pa.compute.utf8_length(b.column("text")).to_pylist()
            for doc, length, found in zip(b.column("doc_id").to_pylist(), lengths, aligner.texts(t.as_py() for t in b.column("text"))):
                if ids and size + length > _BLOCK:
                    yield _block(name, ids, rows, pairs)
                    ids, rows, pairs, size, name = [], [], [], 0, name + 1
                row, links = _figures(found)
                ids.append(doc)
                rows.append(row)
                pairs.append(links)
                size += length
        if ids:
            yield _block(name, ids, rows, pairs)

    return materialise(id_text(docs).mapInArrow(run, _STAGED_DDL), "aligned")


def block_pairs(staged: DataFrame) -> DataFrame:
    """(block, place, a, b, n): the different pairs of each block."""
    return staged.select("block", F.posexplode(F.arrays_zip("a", "b", "n"))).select(
        "block", F.col("pos").alias("place"), "col.a", "col.b", "col.n")


def link_counts(staged: DataFrame) -> DataFrame:
    """(a, b, n, best): links of the corpus that hold a pair of ids, and whether no other pair of b has more."""
    counts = materialise(block_pairs(staged).groupBy("a", "b").agg(F.sum("n").alias("n")), "link-counts")
    most = counts.groupBy("b").agg(F.max("n").alias("most"))  # at most one row per id of the second vocabulary
    return counts.join(most, "b").select("a", "b", "n", (F.col("n") == F.col("most")).alias("best"))


_DDL = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")


def _weigh(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for row in range(b.num_rows):
            column = {c: b.column(c)[row] for c in b.schema.names}
            ids, links = column["doc_ids"].values, column["n_links"].values.to_numpy()
            found = column["found"].values
            weight, best = (np.zeros(0, np.int64), np.zeros(0, np.int64)) if found is None else (
                found.field("total").to_numpy(), found.field("best").cast(pa.int64()).to_numpy())
            codes = np.frombuffer(column["codes"].as_buffer(), "<u2" if len(weight) <= 1 << 16 else "<u4")
            at = np.cumsum(links) - links
            sums = [np.add.reduceat(np.append(w[codes], 0), np.minimum(at, len(codes))) * (links > 0) for w in (best, weight)]
            yield pa.RecordBatch.from_arrays(
                [ids, column["n_a"].values, column["n_b"].values, column["n_groups"].values, column["n_links"].values,
                 pa.array(sums[0]), pa.array(sums[1]), column["groups_sha256"].values],
                names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])


def alignment(docs: DataFrame, a_path: str | None = None, b_path: str | None = None) -> DataFrame:
    """Figures of every document's alignment, its links weighed by the whole corpus.

    A text that is null or empty, or that the tokens of either side do not spell byte for
    byte behind an added space, has no tokens: zeros, and an empty digest. Rows that repeat a
    doc_id or have none are aligned one by one, and their links all count.

    Texts are read once. What is shuffled are the different pairs of each block of texts, to be
    counted, and their counts back to the blocks; no link is. No pair has more rows than there are blocks.
    """
    staged = stage(docs, a_path, b_path)
    counts = link_counts(staged).withColumnRenamed("n", "total")
    weighed = block_pairs(staged).drop("n").join(counts, ["a", "b"])
    found = weighed.groupBy("block").agg(F.sort_array(F.collect_list(F.struct("place", "total", "best"))).alias("found"))
    stored = staged.select("block", "doc_ids", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "codes")
    return stored.join(found, "block", "left").mapInArrow(_weigh, _DDL)


def token_groups(docs: DataFrame, a_path: str | None = None, b_path: str | None = None) -> DataFrame:
    """doc_id and ``groups``: the ids of both sides, group by group, as ``a1,a2|b1;a3|b2,b3``; empty without tokens."""
    a_path, b_path = a_path or tokenizer_path(BYTE_BPE), b_path or tokenizer_path(PIECE_BPE)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = None
        for b in batches:
            aligner = aligner or Aligner(a_path, b_path)
            for k, found in enumerate(aligner.texts(t.as_py() for t in b.column("text"))):
                written = ";".join(part[3] for part in found) if found else ""
                yield pa.RecordBatch.from_arrays([b.column("doc_id")[k : k + 1], pa.array([written])], names=["doc_id", "groups"])

    return id_text(docs).mapInArrow(run, "doc_id long, groups string")
