import itertools
import random

import numpy as np
from pyspark.sql import functions as F

from cases import awkward_rows, folds, frame, plain, words
from tremora.llm import quality as ql

OUT = folds(5, 0)


def case(spark, n=400):
    rng = random.Random(0)
    rows, labels = [], []
    for i in range(n):
        good = rng.random() < 0.8
        lines = [words(rng, rng.randint(5, 30)).capitalize() + "." for _ in range(rng.randint(1, 6))]
        if not good:
            k = rng.randrange(len(lines))
            lines[k] = rng.choice([" | ".join(words(rng, 60).split()), "buy " * 80, words(rng, 60).upper().replace(" ", "!! ")])
        rows.append((i, "\n".join(lines)))
        labels.append((i, int(good), 0))
    return rows, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), {d: q for d, q, _ in labels}


def test_held_out_accuracy(spark):
    rows, labels, truth = case(spark)
    got = {r.doc_id: r for r in ql.quality(frame(spark, rows, ("score", "good")), labels).collect()}
    assert {d: r.held_out for d, r in got.items()} == {d: OUT(d) for d, _ in rows}
    held = [d for d in truth if OUT(d)]
    assert np.mean([got[d].predicted == truth[d] for d in held]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got.values())


def test_labels_of_held_out_rows_are_not_read(spark):
    rows, labels, _ = case(spark, 200)
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    other = labels.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality")))
    assert plain(ql.quality(frame(spark, rows), labels)) == plain(ql.quality(frame(spark, rows), other))


def test_awkward_rows_and_missing_labels(spark):
    rows = awkward_rows() + [(5000, "\n" * 3000), (5001, "a\nb\n\n")]
    for labels in ([], [(1, 1, 0), (2, 1, 0)], [(None, 1, 0), (1, None, 0), (2, 1, 0), (2, 0, 0), (3, 1, None), (10**9, 0, 0)]):
        got = ql.quality(frame(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
        assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    assert plain(ql.quality(frame(spark, []), labels=spark.createDataFrame([], "doc_id long, quality int, toxic int"))) == []


def test_marginals_by_enumeration():
    rng = np.random.default_rng(0)
    lines = np.array([1, 4, 3])
    unary, move = rng.normal(size=8), rng.normal(size=(2, 2))
    for group, places in ql._padded(lines):
        good, both = ql.marginals(unary, move, places)
        for j, d in enumerate(group):
            own = unary[lines[:d].sum() :][: lines[d]]
            weight, single, pair = 0.0, np.zeros(lines[d]), np.zeros(max(0, lines[d] - 1))
            for y in itertools.product((0, 1), repeat=int(lines[d])):
                w = np.exp(sum(u * v for u, v in zip(own, y)) + sum(move[a, b] for a, b in zip(y, y[1:])))
                weight += w
                single += w * np.array(y)
                pair += w * np.array([a & b for a, b in zip(y, y[1:])], float)
            assert np.allclose(good[: lines[d], j], single / weight)
            assert np.allclose(both[: lines[d] - 1, j], pair / weight)


def test_lines_are_counted():
    x, size, lines = ql.line_features([b"one\ntwo lines", b"", b"\n\n", b"last"])
    assert lines.tolist() == [2, 1, 3, 1] and size.tolist() == [3, 9, 0, 0, 0, 0, 4]
    assert x.shape == (7, 3 * ql.BASE + 3)


def test_groups_of_padded_texts_do_not_change_scores(monkeypatch):
    rng = random.Random(0)
    texts = ["\n".join(words(rng, 6) for _ in range(rng.randint(1, 30))).encode() for _ in range(40)]
    r = np.random.default_rng(0)
    width = 3 * ql.BASE + 3
    model = ql.Model(r.normal(size=width), r.normal(size=(2, 2)), np.zeros(width), np.ones(width), (1.0, 0.0))
    whole = model.scores(texts)
    monkeypatch.setattr(ql, "CELLS", 1)
    assert np.allclose(model.scores(texts), whole)


def test_blocks_of_lines_equal_the_whole_text():
    rng = random.Random(1)
    for text in (b"", b"\n", b"one", b"a\nbb\n\n\nccc dd\n", "\n".join(words(rng, rng.randint(0, 9)) for _ in range(200)).encode(), b"x\n" * 50):
        x, size, _ = ql.line_features([text])
        for most in (1, 7, 60, 10_000):
            blocks = list(ql.line_blocks(text, most))
            assert np.allclose(np.concatenate([b[0] for b in blocks]), x) and np.concatenate([b[1] for b in blocks]).tolist() == size.tolist()


def test_long_texts_equal_short_ones(monkeypatch):
    rng = random.Random(3)
    r = np.random.default_rng(0)
    width = 3 * ql.BASE + 3
    model = ql.Model(r.normal(size=width), r.normal(size=(2, 2)), np.zeros(width), np.ones(width), (1.0, 0.0))
    texts = ["\n".join(words(rng, rng.randint(0, 6)) for _ in range(n)).encode() for n in (1, 2, 3, 10, 77, 300)] + [b"\n" * 500, b"\nx"]
    whole = model.scores(texts)
    for long in (-1, 3, 90):
        monkeypatch.setattr(ql, "LONG", long)
        monkeypatch.setattr(ql.line_blocks, "__defaults__", (max(1, long),))
        assert np.allclose(model.scores(texts), whole)


def test_very_long_text_in_bounded_memory():
    import tracemalloc

    width = 3 * ql.BASE + 3
    model = ql.Model(np.full(width, 0.1), np.eye(2), np.zeros(width), np.ones(width), (1.0, 0.0))
    text = b"\n" * 10_000_000
    tracemalloc.start()
    assert 0 <= model.scores([text])[0] <= 1
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 500_000_000


def test_fewer_documents_where_they_are_long(spark):
    rows, labels, _ = case(spark, 200)
    (x, size, lines), good, _ = ql.training_sample(frame(spark, rows), labels, sample_lines=60)
    assert len(x) == len(size) == lines.sum() <= 120 and set(good) == {True, False}
