"""Byte-pair encoding and decoding of whole texts with an automaton compiled from the merges.

The vocabulary's normaliser and word pattern are the tokenizers library's; every word is
encoded by the automaton (see ``merge_automaton``), and ids are decoded by writing the
labels of their arcs.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tremora.llm.common import Shared, id_text
from tremora.llm.merge_automaton import Automaton
from tremora.llm.tokens import byte_letters, tokenizer_path, unusual_signs, usual_signs

WORD_BPE = "word_bpe_49k.json"
_WORDS = 300_000  # words a task remembers
_PART = 1 << 20  # characters of texts looked at together

#: fixed values: the rules for which the pattern of usual characters is written
_NORMALIZER = {"type": "Sequence", "normalizers": [
    {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}
_WORDS_OF = {"type": "Sequence", "pretokenizers": [
    {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}
_BETWEEN = re.compile("[A-Za-z] (?=[A-Za-z])")


class WordEncoder:
    """Ids of texts as the library gives them for a vocabulary with word ends, words by the automaton.

    Texts of usual characters are lower-cased and cut by one pattern; others go through the
    library's normaliser and word pattern. Every distinct word is encoded once while it is
    remembered.
    """

    def __init__(self, path: str, automaton: Automaton) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks already use every core
        from tokenizers import Tokenizer

        self.automaton, self.model = automaton, Tokenizer.from_file(path)
        added = {t.content: i for i, t in self.model.get_added_tokens_decoder().items()}
        self.added = {t: np.array([i], "<u4").tobytes() for t, i in added.items()}
        self.special = re.compile("(" + "|".join(sorted(map(re.escape, added), key=len, reverse=True)) + ")") if added else None
        letters, digits, signs = usual_signs()
        with open(path, encoding="utf-8") as f:
            rules = json.load(f)
        self.plain = rules["normalizer"] == _NORMALIZER and rules["pre_tokenizer"] == _WORDS_OF
        self.unusual = unusual_signs()
        self.word = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{letters}]+|[{digits}]|[{signs}]+")
        self.to_byte = {ord(x): b for b, x in enumerate(byte_letters())}
        self.ids: dict[str, bytes] = {}
        labels = [*automaton.labels, *[""] * (max(added.values(), default=-1) + 1 - len(automaton.labels))]
        for t, i in added.items():
            labels[i] = t
        self.labels = labels

    def _words(self, text: str) -> list[str] | list[bytes]:
        if self.plain and not self.unusual.search(text):
            return self.word.findall(text.lower())
        if self.model.normalizer is not None:
            text = self.model.normalizer.normalize_str(text)
        return [w.translate(self.to_byte).encode("latin-1") for w, _ in self.model.pre_tokenizer.pre_tokenize_str(text)]

    def _cut(self, text: str) -> Iterator[list[str] | list[bytes] | bytes]:
        """Words, part by part, and the ids of added tokens between them. Long texts are cut at spaces between ASCII letters."""
        for k, piece in enumerate(self.special.split(text) if self.special else [text]):
            if k % 2:
                yield self.added[piece]
                continue
            at = 0
            while at < len(piece):
                cut = _BETWEEN.search(piece, at + _PART)
                end = cut.end() if cut else len(piece)
                yield self._words(piece[at:end])
                at = end

    def _learn(self, parts: list[list]) -> None:
        """Words not met before are encoded side by side."""
        known = self.ids
        if len(known) > _WORDS:
            known.clear()
        new = list(set().union(*parts).difference(known))
        known.update(zip(new, self.automaton.encode([w if isinstance(w, bytes) else w.encode() for w in new])))

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        return next(self.encode_all([text]))

    def encode_all(self, texts: Iterable[str]) -> Iterator[bytes]:
        """Ids of each text; about _PART characters of texts are cut before their words are encoded."""
        held: list[list[list | bytes]] = []
        size = 0
        for text in texts:
            if len(text) > 4 * _PART:  # part by part, so that its words are not held all at once
                yield from self._joined(held)
                held, size, out = [], 0, []
                for part in self._cut(text):
                    out += self._joined([[part]])
                yield b"".join(out)
                continue
            held.append(list(self._cut(text)))
            size += len(text)
            if size >= _PART:
                yield from self._joined(held)
                held, size = [], 0
        yield from self._joined(held)

    def _joined(self, cut: list[list[list | bytes]]) -> list[bytes]:
        self._learn([p for parts in cut for p in parts if not isinstance(p, bytes)])
        get = self.ids.__getitem__
        return [b"".join(p if isinstance(p, bytes) else b"".join(map(get, p)) for p in parts) for parts in cut]

    def decode(self, ids: bytes) -> str:
        """The labels of the arcs, special ones too, with a space between them."""
        return " ".join(map(self.labels.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def _with_encoder(shared: Shared, path: str, make: Callable) -> Callable:
    """A mapInArrow function that applies ``make(encoder, batch)`` to every batch."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = None
        for b in batches:
            encoder = encoder or WordEncoder(path, shared.get())
            yield from make(encoder, b)

    return run


def encode(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """doc_id and ``ids``, the ids of the whole text as little-endian unsigned 32-bit integers.

    A null or empty text has no ids; a text without words neither. Rows that repeat an id stay
    as they are. Nothing is shuffled; the automaton (bounded by the vocabulary) is broadcast.
    """
    path = tokenizer or tokenizer_path(WORD_BPE)
    shared = Shared(docs.sparkSession, Automaton.of_file(path))

    def make(encoder: WordEncoder, b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        yield from _bounded(b.column("doc_id"), encoder.encode_all(t.as_py() for t in b.column("text")))

    return id_text(docs).mapInArrow(_with_encoder(shared, path, make), "doc_id long, ids binary")


def _bounded(doc_id: pa.Array, ids: Iterable[bytes]) -> Iterator[pa.RecordBatch]:
    """Batches of about 16 MB of ids."""
    held, first, size = [], 0, 0
    for k, own in enumerate(ids):
        held.append(own)
        size += len(own)
        if size > 1 << 24 or k == len(doc_id) - 1:
            yield pa.RecordBatch.from_arrays([doc_id[first : k + 1], pa.array(held, pa.binary())], names=["doc_id", "ids"])
            held, first, size = [], k + 1, 0


def decode(encoded: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """doc_id and ``text``, the labels of the ids joined by spaces, special ones kept. Null ids give an empty text."""
    path = tokenizer or tokenizer_path(WORD_BPE)
    shared = Shared(encoded.sparkSession, Automaton.of_file(path))

    def make(encoder: WordEncoder, b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for k in range(b.num_rows):
            text = encoder.decode(b.column("ids")[k].as_py() or b"")
            yield pa.RecordBatch.from_arrays([b.column("doc_id")[k : k + 1], pa.array([text])], names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(_with_encoder(shared, path, make), "doc_id long, text string")


def round_trip_digests(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every document, in one pass over the texts.

    Null and empty texts have no ids and decode to the empty text.
    """
    path = tokenizer or tokenizer_path(WORD_BPE)
    shared = Shared(docs.sparkSession, Automaton.of_file(path))

    def make(encoder: WordEncoder, b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        many, coded, decoded = [], [], []
        for ids in encoder.encode_all(t.as_py() for t in b.column("text")):
            many.append(len(ids) // 4)
            coded.append(hashlib.sha256(ids).hexdigest())
            text = hashlib.sha256()
            for at in range(0, len(ids), 4 * _PART):  # a space stands between parts too
                text.update((" " if at else "").encode() + encoder.decode(ids[at : at + 4 * _PART]).encode())
            decoded.append(text.hexdigest())
        yield pa.RecordBatch.from_arrays(
            [b.column("doc_id"), pa.array(many, pa.int64()), pa.array(coded, pa.string()), pa.array(decoded, pa.string())],
            names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return id_text(docs).mapInArrow(
        _with_encoder(shared, path, make), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
