"""Language identification with a string kernel.

Two texts are as alike as the byte n-grams (n = 2, 3, 4) that occur in both: the blended-
spectrum presence kernel  k(x, y) = |G(x) n G(y)| / sqrt(|G(x)| |G(y)|).  Some learning texts are
landmarks; Nyström features  k(x, L) W^(-1/2)  over them feed one ridge regression per
language (one against the rest). A prediction is k(x, L) times the dual weights. As k is
linear in the presence row of x, landmarks and weights are multiplied out once, and a
batch of texts is scored as one product of its sparse presence rows with that matrix.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tremora.llm.common import Shared, held_out, id_text, sample_rank, slices, utf8_texts
from tremora.session import broadcast_if_small, materialise

SIZES = (2, 3, 4)
BITS = 18  # grams are hashed into 2**BITS columns
PER_LANGUAGE = 300  # learning texts of a language, the bound of the sample
LANDMARKS = 64  # of these, per language
ALL_LANDMARKS = 768  # with more than twelve languages each has fewer, and with more than 768 not every one has its own
BLOCK_LANGUAGES = 64  # whose weights are sent and held at once
RIDGE = 1e-2
SHARPNESS = 6.0  # of the softmax that turns margins into a score
NONE = "und"

_LETTERS = re.compile(r"[^\W\d_]+")
_BLOCK = 1 << 20


def grams(text: bytes, flags: np.ndarray) -> np.ndarray:
    """Sorted distinct gram columns of a text; ``flags`` is scratch of 2**BITS zeros, left zeroed."""
    text = text.lower()
    padded = text + bytes(8)
    for at in range(0, len(text), _BLOCK):  # long texts in overlapping blocks
        n = min(_BLOCK, len(text) - at)
        four = np.ndarray((n,), "<u4", padded, offset=at, strides=(1,))  # the four bytes from each place on
        for size in SIZES:
            have = min(n, len(text) - at - size + 1)
            if have > 0:
                code = (four[:have] & np.uint32((1 << 8 * size) - 1)) * np.uint32(0x9E3779B1) + np.uint32(size * 0x85EBCA6B & 0xFFFFFFFF)
                code = (code ^ (code >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
                flags[code >> np.uint32(32 - BITS)] = True
    found = np.flatnonzero(flags)
    flags[found] = False
    return found


def has_letter(text: str) -> bool:
    return any(any(map(str.isalpha, m.group())) for m in _LETTERS.finditer(text))


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray  # 2**BITS x languages: landmark presence rows times dual weights
    bias: np.ndarray

    def margins(self, texts: Sequence[bytes]) -> np.ndarray:
        flags = np.zeros(1 << BITS, bool)
        rows = [grams(t, flags) for t in texts]
        n = np.fromiter(map(len, rows), np.int64, len(rows))
        out = np.zeros((len(rows), len(self.languages)))
        full = np.flatnonzero(n)
        if len(full):
            starts = np.concatenate([[0], np.cumsum(n[full])[:-1]])
            out[full] = np.add.reduceat(self.weights[np.concatenate([rows[i] for i in full])], starts, axis=0)
            out[full] /= np.sqrt(n[full])[:, None]
        return out + self.bias


def _block(languages: list[str], columns: np.ndarray, marks: np.ndarray, dual: np.ndarray, bias: np.ndarray) -> Model:
    weights = np.zeros((1 << BITS, len(languages)), np.float32)
    weights[columns] = marks @ dual.astype(np.float32)
    return Model(languages, weights, bias)


def fit_blocks(samples: Iterable[tuple[str, np.ndarray]], landmarks: int = LANDMARKS, ridge: float = RIDGE,
               size: int = BLOCK_LANGUAGES) -> Iterator[Model]:
    """Nyström kernel ridge regression, one against the rest, on the driver: models of ``size`` languages each.

    The samples, (language, gram columns), are read three times, one at a time; only landmarks, products of
    kernel columns and their sums by language are held. All languages share the landmarks, so margins compare.
    """
    languages = sorted({lang for lang, _ in samples})
    each = min(landmarks, max(1, ALL_LANDMARKS // max(1, len(languages))))
    own: dict[str, list[np.ndarray]] = {lang: [] for lang in languages[:: -(-len(languages) // ALL_LANDMARKS) or 1]}
    for lang, row in samples:
        if len(row) and len(own.get(lang, "." * each)) < each:
            own[lang].append(row)
    picked = [row for rows in own.values() for row in rows]
    if not picked:
        for at in range(0, len(languages), size):
            some = languages[at : at + size]
            yield Model(some, np.zeros((1 << BITS, len(some)), np.float32), np.zeros(len(some)))
        return
    columns = np.unique(np.concatenate(picked))
    place = np.full(1 << BITS, -1, np.int64)
    place[columns] = np.arange(len(columns))
    marks = np.zeros((len(columns), len(picked)), np.float32)  # landmark presence rows, normalised
    for j, row in enumerate(picked):
        marks[place[row], j] = 1 / np.sqrt(len(row))

    def kernel(row: np.ndarray) -> np.ndarray:
        found = place[row]
        return marks[found[found >= 0]].sum(axis=0).astype(float) / np.sqrt(max(1, len(row)))

    among = np.array([kernel(row) for row in picked])
    values, vectors = np.linalg.eigh((among + among.T) / 2)
    good = values > 1e-8 * values.max()
    half = vectors[:, good] / np.sqrt(values[good])  # W^(-1/2), up to a rotation
    number = {lang: i for i, lang in enumerate(languages)}
    products, sums, many = np.zeros((half.shape[1],) * 2), np.zeros((len(languages), half.shape[1])), np.zeros(len(languages))
    waiting: list[np.ndarray] = []
    for lang, row in samples:
        z = kernel(row) @ half
        sums[number[lang]] += z
        many[number[lang]] += 1
        waiting.append(z)
        if len(waiting) == 512:
            products += np.array(waiting).T @ np.array(waiting)
            waiting = []
    if waiting:
        products += np.array(waiting).T @ np.array(waiting)
    n, mean_z, mean_y = many.sum(), sums.sum(axis=0) / many.sum(), 2 * many / many.sum() - 1
    # targets are 1 for a text's own language and -1 for the others
    against = (2 * sums - sums.sum(axis=0)).T - n * np.outer(mean_z, mean_y)
    beta = np.linalg.solve(products - n * np.outer(mean_z, mean_z) + ridge * n * np.eye(len(mean_z)) / 10, against)
    bias = mean_y - mean_z @ beta
    for at in range(0, len(languages), size):
        cut = slice(at, at + size)
        yield _block(languages[cut], columns, marks, half @ beta[:, cut], bias[cut])


def fit_krr(samples: Sequence[tuple[str, bytes]], landmarks: int = LANDMARKS, ridge: float = RIDGE) -> Model:
    """One model of all languages, from texts that are at hand."""
    flags = np.zeros(1 << BITS, bool)
    rows = [(lang, grams(text, flags)) for lang, text in samples]
    return next(fit_blocks(rows, landmarks, ridge, max(1, len(samples))))


class Stored:
    """The gram columns of the learning texts of a table, read anew each time, by language and id."""

    def __init__(self, df: DataFrame) -> None:
        self.df = df

    def __iter__(self) -> Iterator[tuple[str, np.ndarray]]:
        for r in self.df.orderBy("label", "doc_id").toLocalIterator():
            yield r["label"], np.frombuffer(r["columns"], "<i4")


def _gram_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Gram columns of whole texts; those without a letter teach nothing."""
    flags = np.zeros(1 << BITS, bool)
    for whole in batches:
        for b in slices(whole, "text", 1 << 22):
            texts = list(utf8_texts(b))
            known = pa.array([has_letter(t.decode(errors="replace")) for t in texts], pa.bool_())
            rows = pa.array([grams(t, flags).astype("<i4").tobytes() for t in texts], pa.binary())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("label"), rows], names=["doc_id", "label", "columns"]).filter(known)


def training_sample(docs: DataFrame, per_language: int = PER_LANGUAGE) -> Stored:
    """At most ``per_language`` whole texts of every language of the learning folds, as if drawn at random, as gram
    columns, of which there are at most 2**BITS a text."""
    known = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").alias("label"))
    known = known.where(~held_out(4, 2)).where("label is not null and doc_id is not null")
    # of a large language, about four times as many as wanted are ordered
    counts = known.groupBy("label").count()
    share = counts.select("label", (4 * (per_language + 25) / F.col("count")).alias("share"))
    part = (F.pmod(sample_rank("doc_id"), F.lit(1 << 30)) / float(1 << 30)) <= F.col("share")
    known = known.join(broadcast_if_small(share), "label").where(part)
    first = Window.partitionBy("label").orderBy(sample_rank("doc_id"), "doc_id")
    ids = known.withColumn("k", F.row_number().over(first)).where(F.col("k") <= per_language).select("doc_id", "label")
    texts = id_text(docs).join(broadcast_if_small(ids), "doc_id")
    rows = texts.select("doc_id", "label", "text").mapInArrow(_gram_rows, "doc_id long, label string, columns binary")
    return Stored(materialise(rows, "language-sample"))


def language(docs: DataFrame, per_language: int = PER_LANGUAGE, landmarks: int = LANDMARKS) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row of ``docs`` (doc_id, text, lang).

    Languages are learnt from documents whose crc32(doc_id as text) mod 4 is not 2 and
    whose lang is not null. ``lang_pred`` is one of them, or ``und`` with score 0 if the text
    is null or has no letter, or if there is nothing to learn from. Ties go to the language
    that sorts first. Other columns are ignored.

    At most ``per_language`` whole texts of a language are learnt from. Models of BLOCK_LANGUAGES
    languages are sent out one by one; driver and tasks hold one at a time.
    """
    samples = training_sample(docs, per_language)
    # 2**BITS weights for each language, a block of them at a time
    blocks = [Shared(docs.sparkSession, model) for model in fit_blocks(samples, landmarks)]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only = blocks[0].get() if len(blocks) == 1 else None
        for whole in batches:
            for b in slices(whole, "text", 1 << 22 if only else 1 << 24):
                texts = list(utf8_texts(b))
                known = np.array([has_letter(t.decode(errors="replace")) for t in texts], bool)
                pred, score = np.full(len(texts), NONE, object), np.zeros(len(texts))
                if blocks and known.any():
                    some = [t for t, k in zip(texts, known) if k]
                    best, total = np.full(len(some), -np.inf), np.zeros(len(some))
                    name = np.full(len(some), NONE, object)
                    for block in blocks:
                        model = only or block.get()
                        margin = SHARPNESS * model.margins(some)
                        top = margin.max(axis=1)
                        name = np.where(top > best, np.array(model.languages, object)[margin.argmax(axis=1)], name)
                        most = np.maximum(best, top)
                        total = total * np.exp(best - most) + np.exp(margin - most[:, None]).sum(axis=1)
                        best = most
                    pred[known], score[known] = name, 1 / total
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(pred, pa.string()), pa.array(score)],
                                                 names=["doc_id", "lang_pred", "score"])

    return id_text(docs).mapInArrow(run, "doc_id long, lang_pred string, score double").select(
        "doc_id", held_out(4, 2).alias("held_out"), "lang_pred", "score")
