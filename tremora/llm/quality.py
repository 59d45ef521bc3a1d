"""Document quality from a linear-chain conditional random field over lines.

Every line is good or bad. Its features describe it and its neighbours; transition
weights let a line lean on the labels beside it. Lines of documents labelled good learn
as good, lines of the others as bad. The forward-backward marginals of a document's
lines, weighted by length, give the share of it that is good, and a logistic curve
fitted on the learning documents turns that share into a probability.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tremora.llm.common import Shared, draw, held_out, id_text, materialise, sample_rank, slices, utf8_texts

PER_LABEL = 2_000  # learning documents of each label, the bound of the sample
SAMPLE_LINES = 300_000  # of the learning documents of a label; fewer documents are drawn where they are long
THRESHOLD = 0.3
BASE = 13  # features of a line by itself; a line has these three times: its own and its neighbours'
CELLS = 1 << 19  # lines, padding included, that pass the chain together

_KIND = np.full(256, 5, np.uint8)  # 0 lower, 1 upper, 2 digit, 3 space, 4 stop or comma, 5 symbol, 6 bar, 7 beyond ASCII
_KIND[97:123], _KIND[65:91], _KIND[48:58], _KIND[128:] = 0, 1, 2, 7
_KIND[[9, 10, 11, 12, 13, 32]], _KIND[[39, 44, 45, 46, 59, 58]], _KIND[124] = 3, 4, 6
_LOW = np.array([(1 << 8 * i) - 1 for i in range(9)], np.uint64)


def line_features(texts: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of all lines (texts one after the other), their bytes, and the lines of each text (one at least)."""
    data = b"\n".join(texts) + b"\n"
    a = np.frombuffer(data, np.uint8)
    ends = np.flatnonzero(a == 10)
    starts = np.concatenate([[0], ends[:-1] + 1])
    text_ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1) - 1
    last = np.searchsorted(ends, text_ends)
    lines = np.diff(np.concatenate([[-1], last]))
    size = ends - starts
    kind = _KIND[a]
    count = np.stack([np.add.reduceat((kind == k).astype(np.int32), starts) for k in range(8)], axis=1).astype(np.float64)
    count[:, 3] -= 1  # the line end
    inside = kind != 3
    edge = np.flatnonzero(np.diff(inside, prepend=False))
    at, length = edge[::2], edge[1::2] - edge[::2]  # words: runs without white space
    eight = np.ndarray((len(data) + 1,), "<u8", data + bytes(8), strides=(1,))
    word = (eight[at] & _LOW[np.minimum(length, 8)]) ^ (length.astype(np.uint64) << np.uint64(56))
    of = np.searchsorted(ends, at)
    words = np.bincount(of, minlength=len(ends)).astype(np.float64)
    again = np.zeros(len(at), bool)
    for lag in (1, 2):
        again[lag:] |= (word[lag:] == word[:-lag]) & (of[lag:] == of[:-lag])
    repeats = np.bincount(of[again], minlength=len(ends))
    tail = (kind[at + length - 1] == 5) & (length > 2)
    tails = np.bincount(of[tail], minlength=len(ends))
    some, many = np.maximum(size, 1), np.maximum(words, 1)
    letters = count[:, 0] + count[:, 1] + count[:, 7]
    final = a[np.maximum(ends - 1, 0)]
    same = np.zeros(len(ends), bool)
    head = eight[starts] & _LOW[np.minimum(size, 8)]  # of the line alone, whatever follows it
    same[1:] = (size[1:] == size[:-1]) & (size[1:] > 0) & (head[1:] == head[:-1])
    own = np.stack([
        np.log1p(size) / 8, letters / some, count[:, 1] / np.maximum(letters, 1), count[:, 2] / some, count[:, 5] / some,
        count[:, 6] / some, count[:, 4] / some, np.log1p(words) / 6, np.minimum(size / many, 40) / 10, repeats / many, tails / many,
        (final == 46) & (size > 0), same], axis=1).astype(np.float32)
    first = np.concatenate([[0], last[:-1] + 1])
    before, after = np.zeros_like(own), np.zeros_like(own)
    before[1:], after[:-1] = own[:-1], own[1:]
    before[first], after[last] = 0, 0
    alone = np.zeros((len(own), 2), np.float32)
    alone[first, 0], alone[last, 1] = 1, 1
    return np.concatenate([own, before, after, alone, np.ones((len(own), 1), np.float32)], axis=1), size, lines


LONG = 1 << 19  # bytes of a text, beyond which its lines pass in blocks
BLOCK = 1 << 18  # bytes of such a block; each may be a line


def line_blocks(text: bytes, most: int = BLOCK) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(features, bytes) of the lines of a text, in blocks of about ``most`` bytes, one line at least.

    A block is read with the two lines before it and the one behind it, so features are as for the whole text.
    """
    at, before = 0, 0  # where the block starts, and the two lines before it
    while at <= len(text):
        end = text.find(b"\n", min(len(text), at + most))
        end = len(text) if end < 0 else end  # of the block's last line
        after = len(text) if end == len(text) else text.find(b"\n", end + 1)
        after = len(text) if after < 0 else after
        x, size, _ = line_features([text[before:after]])
        skip = text.count(b"\n", before, at)
        many = text.count(b"\n", at, end) + 1
        x, size = x[skip : skip + many], size[skip : skip + many]
        x[:, -3], x[:, -2] = 0, 0
        x[0, -3], x[-1, -2] = at == 0, end == len(text)
        yield x, size
        at = end + 1
        before = at
        for _ in range(2):
            before = text.rfind(b"\n", 0, max(0, before - 1)) + 1


def _padded(lines: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Groups of texts of similar length: their numbers, and for each step the place of their line (-1 past the end)."""
    first = np.cumsum(lines) - lines
    order = np.argsort(lines, kind="stable")
    at = 0
    while at < len(order):
        end = at + 1
        while end < len(order) and lines[order[end]] * (end + 1 - at) <= CELLS and lines[order[end]] <= 2 * lines[order[at]] + 8:
            end += 1
        group = order[at:end]
        steps = np.arange(lines[group].max())[:, None]
        yield group, np.where(steps < lines[group], first[group] + steps, -1)
        at = end


def marginals(unary: np.ndarray, move: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward-backward over padded texts.

    ``unary``: log weight of good over bad of every line; ``move[a, b]``: log weight of b after a.
    Returns P(good) of every place and P(good, good) of every two neighbouring places.
    """
    steps, n = places.shape
    live = places >= 0
    emit = np.where(live, unary[np.maximum(places, 0)], 0)
    fore, back = np.zeros((steps, 2, n)), np.zeros((steps, 2, n))
    fore[0, 1] = emit[0]
    for t in range(1, steps):
        into = np.logaddexp(fore[t - 1, 0] + move[0][:, None], fore[t - 1, 1] + move[1][:, None])
        into[1] += emit[t]
        fore[t] = np.where(live[t], into, fore[t - 1])
    for t in range(steps - 2, -1, -1):
        nxt = np.stack([back[t + 1, 0], back[t + 1, 1] + emit[t + 1]])
        out = np.logaddexp(move[:, 0][:, None] + nxt[0], move[:, 1][:, None] + nxt[1])
        back[t] = np.where(live[t + 1], out, 0)
    log_z = np.logaddexp(fore[-1, 0], fore[-1, 1])
    both = np.exp(fore[:-1, 1] + move[1, 1] + emit[1:] + back[1:, 1] - log_z)
    return np.exp(fore[:, 1] + back[:, 1] - log_z), both


def _carried(unary: np.ndarray, move: np.ndarray) -> tuple[np.ndarray, int, int]:
    """Lines of one text dealt to columns, one stretch of neighbours each: (columns, stretch, lines)."""
    n = len(unary)
    stretch = max(1, int(np.ceil(np.sqrt(n))))
    dealt = np.full(stretch * -(-n // stretch), np.nan)
    dealt[:n] = unary
    return dealt.reshape(-1, stretch).T, stretch, n


def transfer(unary: np.ndarray, move: np.ndarray) -> np.ndarray:
    """Log weights of a block of lines: [a, b] with label a before its first line and b on its last."""
    columns, _, _ = _carried(unary, move)
    out = np.full((2, 2, columns.shape[1]), -np.inf)
    out[0, 0], out[1, 1] = 0, 0
    for row in columns:
        live = ~np.isnan(row)
        emit = np.where(live, row, 0)
        moved = np.logaddexp(out[:, 0, None] + move[0][None, :, None], out[:, 1, None] + move[1][None, :, None])
        moved[:, 1] += emit
        out = np.where(live, moved, out)
    total = out[:, :, 0]
    for k in range(1, out.shape[2]):
        total = np.logaddexp(total[:, :1] + out[0, :, k], total[:, 1:] + out[1, :, k])
    return total


def block_marginals(unary: np.ndarray, move: np.ndarray, fore: np.ndarray, back: np.ndarray) -> np.ndarray:
    """P(good) of a block's lines. ``fore``: log weights of the labels before its first line; ``back``: of what follows its last.

    Lines are dealt to about as many columns as each holds, and all columns step together.
    """
    columns, stretch, n = _carried(unary, move)
    wide = columns.shape[1]
    step = np.full((2, 2, wide), -np.inf)
    step[0, 0], step[1, 1] = 0, 0
    emit = np.where(np.isnan(columns), 0, columns)
    live = ~np.isnan(columns)
    for t in range(stretch):
        moved = np.logaddexp(step[:, 0, None] + move[0][None, :, None], step[:, 1, None] + move[1][None, :, None])
        moved[:, 1] += emit[t]
        step = np.where(live[t], moved, step)
    into, out = np.zeros((2, wide)), np.zeros((2, wide))  # before the first line and behind the last one of a column
    into[:, 0], out[:, -1] = fore, back
    for k in range(1, wide):
        into[:, k] = np.logaddexp(into[0, k - 1] + step[0, :, k - 1], into[1, k - 1] + step[1, :, k - 1])
    for k in range(wide - 1, 0, -1):
        out[:, k - 1] = np.logaddexp(step[:, 0, k] + out[0, k], step[:, 1, k] + out[1, k])
    ahead = np.zeros((stretch, 2, wide))
    now = into
    for t in range(stretch):
        moved = np.logaddexp(now[0] + move[0][:, None], now[1] + move[1][:, None])
        moved[1] += emit[t]
        now = ahead[t] = np.where(live[t], moved, now)
    good, now = np.zeros((stretch, wide)), out
    for t in range(stretch - 1, -1, -1):
        both = ahead[t] + now
        good[t] = 1 / (1 + np.exp(np.clip(both[0] - both[1], -700, 700)))
        nxt = np.stack([now[0], now[1] + emit[t]])
        now = np.where(live[t], np.logaddexp(move[:, 0][:, None] + nxt[0], move[:, 1][:, None] + nxt[1]), now)
    return good.T.reshape(-1)[:n]


@dataclass
class Model:
    theta: np.ndarray
    move: np.ndarray
    centre: np.ndarray
    scale: np.ndarray
    curve: tuple[float, float]

    def shares(self, texts: Sequence[bytes]) -> np.ndarray:
        """Length-weighted P(good) of the lines of each text; long texts pass alone, block by block."""
        out = np.zeros(len(texts))
        long = np.array([len(t) > LONG for t in texts], bool)
        for i in np.flatnonzero(long).tolist():
            out[i] = self._long_share(texts[i])
        rest = [t for t in texts if len(t) <= LONG]
        if rest:
            out[~long] = self.shares_of(*line_features(rest))
        return out

    def _unary(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.centre) / self.scale) @ self.theta

    def _long_share(self, text: bytes) -> float:
        """Two passes over the blocks: their transfers, then the marginals between what comes before and after them.

        The label before the first line counts as free, without a move into that line.
        """
        steps = []
        for k, (x, _) in enumerate(line_blocks(text)):
            unary = self._unary(x)
            if k:
                steps.append(transfer(unary, self.move))
                continue
            first = np.array([[0.0, unary[0]]] * 2)  # no move into the first line
            rest = transfer(unary[1:], self.move) if len(unary) > 1 else np.array([[0, -np.inf], [-np.inf, 0]])
            steps.append(np.logaddexp(first[:, :1] + rest[0], first[:, 1:] + rest[1]))
        back = [np.zeros(2)]
        for step in steps[:0:-1]:
            back.append(np.logaddexp(step[:, 0] + back[-1][0], step[:, 1] + back[-1][1]))
        back.reverse()
        good_bytes, total, fore = 0.0, 0, np.zeros(2)
        for k, (x, size) in enumerate(line_blocks(text)):
            unary, weight = self._unary(x), np.maximum(size, 1)
            if k:
                good = block_marginals(unary, self.move, fore, back[k])
                fore = np.logaddexp(fore[0] + steps[k][0], fore[1] + steps[k][1])
            else:
                fore = steps[0][0]
                start = np.array([0.0, unary[0]])
                rest = block_marginals(unary[1:], self.move, start, back[0]) if len(unary) > 1 else np.zeros(0)
                behind = transfer(unary[1:], self.move) if len(unary) > 1 else np.array([[0, -np.inf], [-np.inf, 0]])
                both = start + np.logaddexp(behind[:, 0] + back[0][0], behind[:, 1] + back[0][1])
                good = np.append(1 / (1 + np.exp(np.clip(both[0] - both[1], -700, 700))), rest)
            good_bytes += float((good * weight).sum())
            total += int(weight.sum())
        return good_bytes / total

    def shares_of(self, x: np.ndarray, size: np.ndarray, lines: np.ndarray) -> np.ndarray:
        """The same from the features of all lines, texts one after the other."""
        unary = self._unary(x)
        out = np.zeros(len(lines))
        for group, places in _padded(lines):
            good, _ = marginals(unary, self.move, places)
            weight = np.where(places >= 0, np.maximum(size[np.maximum(places, 0)], 1), 0)
            out[group] = (good * weight).sum(axis=0) / weight.sum(axis=0)
        return out

    def scores(self, texts: Sequence[bytes]) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.curve[0] * _logit(self.shares(texts)) + self.curve[1])))


def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


def fit_crf(texts: Sequence[bytes], good: Sequence[bool], share: float, **how: float) -> Model:
    """Fit on texts that are at hand."""
    return fit_features(*line_features(texts), good, share, **how) if len(texts) else fit_features(
        np.zeros((0, 3 * BASE + 3), np.float32), np.zeros(0, np.int64), np.zeros(0, np.int64), good, share)


def fit_features(x: np.ndarray, size: np.ndarray, lines: np.ndarray, good: Sequence[bool], share: float, steps: int = 120,
                 rate: float = 0.1, decay: float = 1e-3) -> Model:
    """Fit on the driver from the line features of a bounded sample; ``share`` is that of good documents among all learning ones."""
    width = 3 * BASE + 3
    share = float(np.clip(share, 0.01, 0.99))
    flat = Model(np.zeros(width), np.zeros((2, 2)), np.zeros(width), np.ones(width), (0.0, float(_logit(np.array(share)))))
    y_doc = np.array(good, bool)
    if not len(lines) or y_doc.all() or not y_doc.any():
        return flat
    raw = x
    centre, scale = x.mean(axis=0), x.std(axis=0) + 1e-3
    centre[-1], scale[-1] = 0, 1
    x = ((x - centre) / scale).astype(np.float64)
    y = np.repeat(y_doc, lines)
    # documents weigh as if the sample had the corpus's share of good ones, and a long one no more than a short one
    weight = np.where(y_doc, share / y_doc.mean(), (1 - share) / (1 - y_doc.mean())) / lines
    groups = list(_padded(lines))
    theta, move = np.zeros(width), np.zeros((2, 2))
    m, v = np.zeros(width + 4), np.zeros(width + 4)
    line_weight = np.repeat(weight, lines)
    seen = np.zeros((2, 2))
    seen[0, 0] = (weight * (lines - 1))[~y_doc].sum()
    seen[1, 1] = (weight * (lines - 1))[y_doc].sum()
    for t in range(1, steps + 1):
        unary, p = x @ theta, np.zeros(len(y))
        expected = np.zeros((2, 2))
        for group, places in groups:
            prob, both = marginals(unary, move, places)
            live = places >= 0
            p[places[live]] = prob[live]
            if len(places) > 1:  # expected moves, weighted by document
                w = np.broadcast_to(weight[group], places.shape)[1:][live[1:]]
                a, b = prob[:-1][live[1:]], prob[1:][live[1:]]
                both = both[live[1:]]
                expected += np.array([[((1 - a - b + both) * w).sum(), ((b - both) * w).sum()], [((a - both) * w).sum(), (both * w).sum()]])
        g = np.concatenate([x.T @ (line_weight * (y - p)), (seen - expected).ravel()]) / weight.sum() - decay * np.concatenate([theta, move.ravel()])
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        step = rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        theta, move = theta + step[:width], move + step[width:].reshape(2, 2)
    model = Model(theta, move, centre, scale, (1.0, 0.0))
    z = _logit(model.shares_of(raw, size, lines))
    a, b = 1.0, 0.0
    w = weight * lines
    for _ in range(50):  # Newton steps for the curve
        q = 1 / (1 + np.exp(-np.clip(a * z + b, -30, 30)))
        r, h = w * (y_doc - q), w * q * (1 - q) + 1e-9
        grad = np.array([(r * z).sum() - 0.1 * (a - 1), r.sum() - 0.1 * b])
        hess = np.array([[(h * z * z).sum() + 0.1, (h * z).sum()], [(h * z).sum(), h.sum() + 0.1]])
        da, db = np.clip(np.linalg.solve(hess, grad), -1, 1)
        a, b = max(0.05, a + da), b + db
    model.curve = (float(a), float(b))
    return model


_LINES_DDL = "doc_id long, good boolean, row long, part int, lines int, x binary, size binary"


def _line_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Line features of whole texts, block by block."""
    for b in batches:
        for doc, good, row, text in zip(*(b.column(c).to_pylist() for c in ("doc_id", "good", "row")), utf8_texts(b)):
            for part, (x, size) in enumerate(line_blocks(text)):
                yield pa.RecordBatch.from_pydict({
                    "doc_id": pa.array([doc], pa.int64()), "good": pa.array([good]), "row": pa.array([row], pa.int64()),
                    "part": pa.array([part], pa.int32()), "lines": pa.array([len(size)], pa.int32()),
                    "x": pa.array([x.astype("<f4").tobytes()], pa.binary()), "size": pa.array([size.astype("<i8").tobytes()], pa.binary())})


def training_sample(docs: DataFrame, labels: DataFrame, per_label: int = PER_LABEL,
                    sample_lines: int = SAMPLE_LINES) -> tuple[tuple[np.ndarray, np.ndarray, np.ndarray], list[bool], float]:
    """(features, bytes, lines) of whole documents of the learning folds, their labels, and the share of good labels there.

    At most ``per_label`` documents of each label are drawn; where they have more than ``sample_lines`` lines
    together, fewer, one at least. Features are taken in tasks.
    """
    known = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull()).where(~held_out(5, 0)).groupBy(
        F.col("doc_id").cast("long").alias("doc_id")).agg((F.min("quality") == 1).alias("good"))
    share = known.agg(F.avg(F.col("good").cast("int"))).first()[0] or 0.0
    ids = draw(known.where("good"), per_label, "doc_id").union(draw(known.where("not good"), per_label, "doc_id"))
    texts = id_text(docs).join(F.broadcast(ids), "doc_id").withColumn("row", F.monotonically_increasing_id())
    found = materialise(texts.select("doc_id", "good", "row", "text").mapInArrow(_line_rows, _LINES_DDL), "line-features")
    sizes = found.groupBy("good", "doc_id", "row").agg(F.sum("lines").alias("lines"))
    upto = Window.partitionBy("good").orderBy(sample_rank("doc_id"), "doc_id", "row")  # at most per_label rows and their repeats
    drawn = sizes.withColumns({"total": F.sum("lines").over(upto), "first": F.row_number().over(upto)})
    drawn = drawn.where((F.col("total") <= sample_lines) | (F.col("first") == 1)).select("row")
    rows = found.join(drawn, "row", "left_semi").toArrow().sort_by([("doc_id", "ascending"), ("row", "ascending"), ("part", "ascending")])
    x = np.frombuffer(b"".join(rows["x"].to_pylist()), "<f4").reshape(-1, 3 * BASE + 3)
    size = np.frombuffer(b"".join(rows["size"].to_pylist()), "<i8")
    row, lines = rows["row"].to_numpy(), rows["lines"].to_numpy()
    first = np.flatnonzero(np.append(True, row[1:] != row[:-1])) if len(row) else np.zeros(0, np.int64)
    many = np.add.reduceat(lines, first).astype(np.int64) if len(row) else lines.astype(np.int64)
    return (x, size, many), rows["good"].to_numpy(zero_copy_only=False)[first].tolist(), float(share)


def quality(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, per_label: int = PER_LABEL) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of ``docs``.

    Labels of documents whose crc32(doc_id as text) mod 5 is 0 are never read. A null or
    empty text is one empty line. Without labels of both kinds every score is the share of
    good ones (between 0.01 and 0.99). A document labelled both ways counts as bad. Whole texts of at
    most ``per_label`` documents a label are learnt from, fewer where they have over SAMPLE_LINES lines.
    """
    features, good, share = training_sample(docs, labels, per_label)
    shared = Shared(docs.sparkSession, fit_features(*features, good, share))  # a few dozen weights

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.get()
        for whole in batches:
            for b in slices(whole, "text", 1 << 20):
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id"), pa.array(model.scores(list(utf8_texts(b))))], names=["doc_id", "score"])

    return id_text(docs).mapInArrow(run, "doc_id long, score double").select(
        "doc_id", held_out(5, 0).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
