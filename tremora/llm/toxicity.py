"""Toxicity by non-negative positive-unlabelled learning.

Only confirmed toxic documents are used as labels; everything else is unlabelled. A
linear model over the words of a text and their beginnings (present or not) minimises
the class-prior-corrected risk  pi R_p(+) + max(0, R_u(-) - pi R_p(-)):  the unlabelled
texts stand in for the clean ones after the share ``pi`` of toxic texts among them is
taken off, and the negative part is kept from falling below zero, where a model would
only memorise. Logistic loss, so the score is a probability.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from tremora.llm.common import Shared, draw, held_out, id_text, materialise, sample_rank, slices, utf8_texts

PREFIXES = (4, 5, 6)  # bytes of a word's beginning that are features beside the word
MAX_POSITIVE = 3_000  # bounds of the sample the model is fitted on
MAX_UNLABELLED = 9_000
MAX_FEATURES = 4_000
LEVELS = 128  # into which each halving of the drawing ranks is divided, so a sample falls short of its bound by 1 % at most
MARGIN = 1.0  # by which a feature's log-likelihood ratio must exceed the logarithm of the number of features
CLIP = 3.0
THRESHOLD = 0.3

_WORD_BYTE = np.zeros(256, bool)
_WORD_BYTE[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True
_LOW = np.array([(1 << 8 * i) - 1 for i in range(9)], np.uint64)
_FILTER_BITS = 20


def _mix(a: np.ndarray) -> np.ndarray:
    a = (a ^ (a >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return a ^ (a >> np.uint64(29))


def features(texts: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(text number, 64-bit feature) of every word and word beginning, repeats included."""
    data = b"\n".join(texts).lower() + b"\n"  # of bytes, lower() changes A-Z only
    sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    inside = _WORD_BYTE[np.frombuffer(data, np.uint8)]
    edge = np.flatnonzero(np.diff(inside, prepend=False))
    starts, length = edge[::2], edge[1::2] - edge[::2]
    text = np.searchsorted(np.cumsum(sizes), starts, side="right")
    at = np.ndarray((len(data) + 17,), "<u8", data + bytes(24), strides=(1,))  # the eight bytes from each place on
    first = at[starts]
    word = _mix(first & _LOW[np.minimum(length, 8)])
    for k in (1, 2):  # up to 24 bytes; longer words count as equal if these and the length are
        word = _mix(word ^ (at[np.minimum(starts + 8 * k, len(data))] & _LOW[np.clip(length - 8 * k, 0, 8)]))
    found, of = [_mix(word + length.astype(np.uint64))], [text]
    for n in PREFIXES:
        has = length > n
        found.append(_mix((first[has] & _LOW[n]) + np.uint64(n << 56)))
        of.append(text[has])
    return np.concatenate(of), np.concatenate(found)


def _distinct(text: np.ndarray, feature: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((feature, text))
    text, feature = text[order], feature[order]
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (feature[1:] != feature[:-1])
    return text[new], feature[new]


@dataclass
class Model:
    features: np.ndarray  # sorted
    weights: np.ndarray
    bias: float

    def __post_init__(self) -> None:
        self.seen = np.zeros(1 << _FILTER_BITS, bool)
        self.seen[self.features >> np.uint64(64 - _FILTER_BITS)] = True

    def columns(self, texts: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Distinct (text number, place in ``features``) pairs."""
        if not len(self.features):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        text, feature = features(texts)
        maybe = self.seen[feature >> np.uint64(64 - _FILTER_BITS)]
        text, feature = text[maybe], feature[maybe]
        place = np.minimum(np.searchsorted(self.features, feature), len(self.features) - 1)
        hit = self.features[place] == feature
        return _distinct(text[hit], place[hit])

    def scores(self, texts: Sequence[bytes]) -> np.ndarray:
        text, place = self.columns(texts)
        total = np.bincount(text, weights=self.weights[place], minlength=len(texts)) + self.bias
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _counts(texts: Sequence[bytes], of: np.ndarray | None = None, part: int = 256) -> tuple[np.ndarray, np.ndarray]:
    """Features and the number of texts with each; ``of`` names the only ones wanted."""
    known, many = (np.zeros(0, np.uint64) if of is None else of), np.zeros(0 if of is None else len(of), np.int64)
    for at in range(0, len(texts), part):
        text, feature = features(texts[at : at + part])
        if of is not None:
            keep = np.isin(feature, of)
            text, feature = text[keep], feature[keep]
        new, n = np.unique(_distinct(text, feature)[1], return_counts=True)
        both = np.concatenate([known, new])
        known, where = np.unique(both, return_inverse=True)
        many = np.bincount(where, weights=np.concatenate([many, n]), minlength=len(known)).astype(np.int64)
    return known, many


BANDS, ROWS = 4, 4  # of the minimum hashes by which copies of a text are told


def _least(text: bytes) -> list[bytes]:
    """The bands of minimum hashes of a text's words."""
    word = features([text])[1]
    word = word[: max(1, len(word) // 2)]
    least = [int(_mix(word ^ np.uint64(k * 0x632BE59BD9B4E019 & (1 << 64) - 1)).min()) if len(word) else 0 for k in range(1, BANDS * ROWS + 1)]
    return [repr((b, least[b * ROWS : (b + 1) * ROWS])).encode() for b in range(BANDS)]


def _unlike(bands: Iterable[Sequence[bytes]]) -> np.ndarray:
    """Which texts share no band of minimum hashes with an earlier one.

    Copies of one text must not make its ordinary words look like evidence.
    """
    taken: set[bytes] = set()
    kept = []
    for own in bands:
        kept.append(not taken.intersection(own))
        taken.update(own)
    return np.array(kept, bool)


def _evidence(in_p: np.ndarray, in_u: np.ndarray, n_p: int, n_u: int, prior: float) -> np.ndarray:
    """Log-likelihood ratio of features found in so many of the toxic and of the unlabelled texts."""
    # how frequent a feature is in clean texts: its rate in unlabelled ones less the toxic share of them
    clean = np.maximum((in_u / n_u - prior * in_p / n_p) / (1 - prior), 1 / (n_u + 2))
    expected = n_p * clean
    return np.where(in_p > expected, in_p * np.log(in_p / expected) - (in_p - expected), 0)


def _chance(n_features: int) -> float:
    return float(np.log(max(2, n_features)) + MARGIN)  # what the best of so many features reaches by luck


def _base(prior: float) -> Model:
    return Model(np.zeros(0, np.uint64), np.zeros(0, np.float32), float(np.log(prior / (1 - prior))))


def _clipped(prior: float) -> float:
    return float(np.clip(prior, 1e-3, 0.5))


def fit_nnpu(positive: list[bytes], unlabelled: list[bytes], prior: float, steps: int = 400, rate: float = 0.05,
             decay: float = 1e-4, seed: int = 7) -> Model:
    """Fit on texts that are at hand. Without positives every score is about ``prior``."""
    prior = _clipped(prior)
    if not positive or not unlabelled:
        return _base(prior)
    own, other = ([t for t, k in zip(ts, _unlike(map(_least, ts))) if k] for ts in (positive, unlabelled))
    known, in_p = _counts(own)
    chance = _chance(len(known))
    known, in_p = known[in_p >= 3], in_p[in_p >= 3]
    evidence = _evidence(in_p, _counts(other, known)[1], len(own), len(other), prior)
    chosen = np.argsort(-evidence, kind="stable")[:MAX_FEATURES]
    chosen = np.sort(chosen[evidence[chosen] > chance])
    if not len(chosen):
        return _base(prior)
    model = Model(known[chosen], np.zeros(len(chosen), np.float32), _base(prior).bias)
    n_p, n_u = len(positive), len(unlabelled)
    x = np.zeros((n_p + n_u, len(chosen)), np.float32)
    for at in range(0, n_p + n_u, 256):
        text, place = model.columns((positive[at : at + 256] + unlabelled[max(0, at - n_p) : max(0, at + 256 - n_p)])[:256])
        x[at + text, place] = 1
    return _descend(model, x, n_p, prior, steps, rate, decay, seed)


def _descend(model: Model, x: np.ndarray, n_p: int, prior: float, steps: int = 400, rate: float = 0.05,
             decay: float = 1e-4, seed: int = 7) -> Model:
    """Weights for the features of ``model``; the first ``n_p`` rows of ``x`` are the toxic texts."""
    n_u = len(x) - n_p
    w, b = np.zeros(x.shape[1], np.float32), model.bias
    m, v = np.zeros(x.shape[1] + 1), np.zeros(x.shape[1] + 1)
    rng = np.random.default_rng(seed)
    for t in range(1, steps + 1):
        p = x[rng.choice(n_p, min(n_p, 512), replace=False)]
        u = x[n_p + rng.choice(n_u, min(n_u, 1024), replace=False)]
        # margins count up to CLIP only: with an unbounded loss, a slightly wrong prior would outweigh all clean texts
        f_p, f_u = np.minimum(p @ w + b, CLIP), np.minimum(u @ w + b, CLIP)
        s_p, s_u = 1 / (1 + np.exp(-f_p)), (f_u < CLIP) / (1 + np.exp(-f_u))
        risk_neg = np.logaddexp(0, f_u).mean() - prior * np.logaddexp(0, f_p).mean()
        g_pos = prior * (s_p - 1) / len(p)
        g_neg_p, g_neg_u = -prior * s_p * (f_p < CLIP) / len(p), s_u / len(u)
        if risk_neg >= 0:
            g_p, g_u = g_pos + g_neg_p, g_neg_u
        else:  # step back on the part that fell below zero
            g_p, g_u = -g_neg_p, -g_neg_u
        g = np.append(p.T @ g_p + u.T @ g_u + decay * w, g_p.sum() + g_u.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        step = rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        # features were chosen as signs of toxicity, so none may speak against it
        w, b = np.maximum(w - step[:-1], 0).astype(np.float32), b - step[-1]
    return Model(model.features, w, float(b))


def training_sample(docs: DataFrame, labels: DataFrame, max_positive: int = MAX_POSITIVE,
                    max_unlabelled: int = MAX_UNLABELLED) -> tuple[DataFrame, float]:
    """Whole texts (toxic, row, text) of confirmed toxic and of unlabelled documents, and the share of toxic
    labels, from the learning folds only.

    The unlabelled texts are drawn from all documents of these folds, their labels unseen. A row is
    drawn by a hash of its id and text, up to the rank at which counts by levels of rank reach the
    bound; so the sample does not depend on how files are split, rows with the same id and text
    count once, and the texts stay spread over tasks. ``row`` tells the rows of the sample apart.
    """
    known = (
        labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).where(~held_out(4, 2))
        .select(F.col("doc_id").cast("long").alias("doc_id"), (F.col("toxic") == 1).alias("toxic"))
    )
    share = known.agg(F.avg(F.col("toxic").cast("double"))).first()[0] or 0.0
    ids = draw(known.where("toxic").select("doc_id").distinct(), max_positive, "doc_id")
    learning = id_text(docs).where(~held_out(4, 2)).where("text <> ''").withColumn("rank", F.shiftrightunsigned(sample_rank("doc_id", "text"), 2))
    # ids is at most max_positive rows
    marked = learning.join(F.broadcast(ids.withColumn("toxic", F.lit(True))), "doc_id", "left").select(
        F.coalesce("toxic", F.lit(False)).alias("toxic"), "rank", "text", F.floor(F.log2(F.col("rank") + 1.0) * LEVELS).cast("int").alias("level"))
    sizes = marked.groupBy("toxic", "level").agg(
        F.when(F.min("rank") == F.max("rank"), 1).otherwise(F.count(F.lit(1))).alias("n")).collect()  # at most 2 * 62 * LEVELS rows
    confirmed = F.col("toxic") & F.col("level").isin(_levels([(r.level, r.n) for r in sizes if r.toxic], 2 * max_positive))
    unlabelled = F.col("level").isin(_levels([(r.level, r.n) for r in sizes], max_unlabelled))
    roles = F.array_compact(F.array(F.when(confirmed, True), F.when(unlabelled, False)))
    sample = marked.select(F.explode(roles).alias("toxic"), "rank", "text").dropDuplicates(["toxic", "rank"])
    return sample.select("toxic", (F.col("rank") * 2 + F.col("toxic").cast("long")).alias("row"), "text"), float(share)


def _levels(sizes: Sequence[tuple[int, int]], most: int) -> list[int]:
    """The lowest levels of ranks with at most ``most`` rows in all; one too large for what is left ends them.

    A level that would alone exceed ``most``, as many copies of a row in it do, is passed over.
    """
    rows: dict[int, int] = {}
    for level, n in sizes:
        rows[level] = rows.get(level, 0) + n
    taken, total = [], 0
    for level in sorted(rows):
        if rows[level] > most:
            continue
        total += rows[level]
        if total > most:
            break
        taken.append(level)
    return taken


def _sample_features(sample: DataFrame) -> DataFrame:
    """(toxic, row, bands, features) of each text; ``features`` are its distinct ones. Stored."""
    schema = "toxic boolean, row long, bands array<binary>, features array<long>"

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in slices(b, "text", 1 << 22):
                texts = list(utf8_texts(part))
                found = [np.unique(features([t])[1]).view(np.int64) for t in texts]
                yield pa.RecordBatch.from_arrays(
                    [part.column("toxic"), part.column("row"), pa.array([_least(t) for t in texts], pa.list_(pa.binary())),
                     pa.array(found, pa.list_(pa.int64()))],
                    names=["toxic", "row", "bands", "features"])

    return materialise(sample.mapInArrow(run, schema), "toxic-sample")


def fit(docs: DataFrame, labels: DataFrame, **bounds: int) -> Model:
    """Fit on whole texts of a bounded sample of rows.

    Features are taken from the texts and counted in tasks. The driver gets the minimum
    hashes of the sampled rows, the MAX_FEATURES with most evidence and which rows have them.
    """
    sample, prior = training_sample(docs, labels, **bounds)
    spark, prior = docs.sparkSession, _clipped(prior)
    rows = _sample_features(sample)
    heads = rows.select("toxic", "row", "bands").toArrow().sort_by([("toxic", "descending"), ("row", "ascending")])
    toxic, row = heads["toxic"].to_numpy(zero_copy_only=False).astype(bool), heads["row"].to_numpy()
    n_p, n_u = int(toxic.sum()), int((~toxic).sum())
    if not n_p or not n_u:
        return _base(prior)
    bands = heads["bands"].to_pylist()
    kept = np.concatenate([_unlike(bands[:n_p]), _unlike(bands[n_p:])])
    own, other = int(kept[:n_p].sum()), int(kept[n_p:].sum())
    unlike = F.broadcast(spark.createDataFrame(pa.table({"row": row[kept]})))  # one number for each sampled text
    each = rows.join(unlike, "row", "left_semi").select("toxic", F.explode("features").alias("feature"))
    counts = materialise(each.groupBy("feature").agg(
        F.count_if("toxic").alias("in_p"), F.count_if(~F.col("toxic")).alias("in_u")).where("in_p > 0"), "toxic-counts")
    chance = _chance(counts.count())

    def judge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            evidence = _evidence(b.column("in_p").to_numpy(), b.column("in_u").to_numpy(), own, other, prior)
            yield pa.RecordBatch.from_arrays([b.column("feature"), pa.array(evidence)], names=["feature", "evidence"])

    judged = counts.where("in_p >= 3").mapInArrow(judge, "feature long, evidence double").where(F.col("evidence") > chance)
    best = judged.orderBy(F.desc("evidence"), "feature").limit(MAX_FEATURES).toArrow()
    chosen = np.sort(best["feature"].to_numpy().view(np.uint64))
    if not len(chosen):
        return _base(prior)
    model = Model(chosen, np.zeros(len(chosen), np.float32), _base(prior).bias)
    shared = Shared(spark, chosen)  # at most MAX_FEATURES numbers

    def places(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chosen = shared.get()
        for b in batches:
            found = []
            for f in b.column("features"):
                has = np.isin(chosen, f.values.to_numpy().view(np.uint64))
                found.append(np.flatnonzero(has).astype(np.int32))
            yield pa.RecordBatch.from_arrays([b.column("row"), pa.array(found, pa.list_(pa.int32()))], names=["row", "places"])

    x = np.zeros((len(row), len(chosen)), np.float32)
    at = {int(r): i for i, r in enumerate(row)}
    sparse = rows.select("row", "features").mapInArrow(places, "row long, places array<int>").toArrow()
    for r, p in zip(sparse["row"].to_pylist(), sparse["places"]):
        x[at[r], p.values.to_numpy()] = 1
    return _descend(model, x, n_p, prior)


def _with_scores(docs: DataFrame, model: Model, at: int, keep_below: float | None) -> DataFrame:
    """The columns under numbered names, whatever they were called, and the score behind them."""
    shared = Shared(docs.sparkSession, model)  # at most MAX_FEATURES weights
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    names = [*plain.columns, "s"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.get()
        for b in batches:
            for part in slices(b, f"c{at}", 1 << 22):
                s = model.scores(list(utf8_texts(part, f"c{at}")))
                out = pa.RecordBatch.from_arrays([*part.columns, pa.array(s)], names=names)
                yield out if keep_below is None else out.filter(pa.array(s < keep_below))

    return plain.mapInArrow(run, T.StructType([*plain.schema.fields, T.StructField("s", T.DoubleType())]))


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` (doc_id, text) with a column ``score``; whole texts are read."""
    return _with_scores(docs, model, docs.columns.index("text"), None).toDF(*docs.columns, "score")


def below(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` whose score is under the threshold, with all their columns as they were."""
    return _with_scores(docs, model, docs.columns.index("text"), threshold).drop("s").toDF(*docs.columns)


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, **bounds: int) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of ``docs``.

    Labels of documents whose crc32(doc_id as text) mod 4 is 2 are never read. A null or
    empty text gets the score of a text without features. Without toxic labels, every
    score is the prior (at least 0.001). Repeated label rows of a document count once;
    a document labelled both ways counts as toxic.
    """
    model = fit(docs, labels, **bounds)
    return scored(id_text(docs), model).select(
        "doc_id", held_out(4, 2).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
