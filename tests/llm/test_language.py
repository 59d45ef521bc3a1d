import random

import numpy as np

from cases import awkward_rows, folds, frame, plain
from tremora.llm import language as lg

LETTERS = {"xx": "abcde", "yy": "fghij", "zz": "kélmn"}


def speech(rng, lang, n=40):
    return " ".join("".join(rng.choice(LETTERS[lang]) for _ in range(rng.randint(2, 6))) for _ in range(n))


def learnable(spark, extra=()):
    rng = random.Random(0)
    rows = [(i, speech(rng, lang), lang, "s", None) for i, lang in enumerate(rng.choices(list(LETTERS), k=200))]
    rows += list(extra)
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"), {r[0]: r[2] for r in rows}


def test_held_out_accuracy(spark):
    docs, truth = learnable(spark)
    got = lg.language(docs).collect()
    out = folds(4, 2)
    assert {r.doc_id: r.held_out for r in got} == {d: out(d) for d in truth}
    assert all(r.lang_pred == truth[r.doc_id] for r in got) and all(0 <= r.score <= 1 for r in got)


def test_awkward_rows(spark):
    extra = [(1000, None, "xx", None, None), (1001, "", None, None, None), (1002, "12 ½ ² !!", "xx", None, None), (None, "abc " * 30, None, None, None),
             (1003, speech(random.Random(1), "zz", 60_000), None, None, None), (0, "fgh " * 9, "yy", None, None)]
    docs, _ = learnable(spark, extra)
    from pyspark.sql import functions as F

    got = {(r.doc_id, r.lang_pred) for r in lg.language(docs.withColumn("score", F.lit("other")).withColumn("label", F.lit(1))).collect()}
    assert {(1000, "und"), (1001, "und"), (1002, "und"), (None, "xx"), (1003, "zz"), (0, "yy")} <= got


def test_labels_of_held_out_rows_are_not_read(spark):
    from pyspark.sql import functions as F

    docs, _ = learnable(spark)
    other = docs.withColumn("lang", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, "wrong").otherwise(F.col("lang")))
    assert plain(lg.language(docs)) == plain(lg.language(other))


def test_nothing_to_learn_from(spark):
    assert plain(lg.language(frame(spark, []))) == []
    rows = awkward_rows()
    got = lg.language(frame(spark, rows).drop("lang").selectExpr("*", "cast(null as string) lang")).collect()
    assert len(got) == len(rows) and {(r.lang_pred, r.score) for r in got} == {("und", 0.0)}


def test_margins_equal_the_kernel(monkeypatch):
    """Multiplying landmarks and weights out changes nothing."""
    rng = random.Random(3)
    samples = [(lang, speech(rng, lang).encode()) for lang in LETTERS for _ in range(12)]
    flags = np.zeros(1 << lg.BITS, bool)
    sets = [set(lg.grams(t, flags).tolist()) for _, t in samples]
    model = lg.fit_krr(samples, landmarks=36)
    new = [speech(rng, "xx").encode(), b"abc", b""]
    kernel = lambda a, b: len(a & b) / max(1e-9, np.sqrt(len(a) * len(b)))
    k = np.array([[kernel(a, b) for b in sets] for a in sets])
    values, vectors = np.linalg.eigh(k)
    good = values > 1e-8 * values.max()
    half = vectors[:, good] / np.sqrt(values[good])
    z = k @ half
    order = sorted(range(len(samples)), key=lambda i: samples[i][0])
    y = np.array([[1.0 if samples[i][0] == lang else -1.0 for lang in model.languages] for i in range(len(samples))])
    assert order == sorted(order)
    zc = z - z.mean(0)
    beta = np.linalg.solve(zc.T @ zc + lg.RIDGE * len(z) * np.eye(z.shape[1]) / 10, zc.T @ (y - y.mean(0)))
    rows = np.array([[kernel(set(lg.grams(t, flags).tolist()), s) for s in sets] for t in new])
    want = rows @ half @ beta + y.mean(0) - z.mean(0) @ beta
    assert np.allclose(model.margins(new), want, atol=1e-4)


def test_grams_of_long_texts(monkeypatch):
    flags = np.zeros(1 << lg.BITS, bool)
    text = speech(random.Random(0), "xx", 500).encode()
    whole = lg.grams(text, flags)
    monkeypatch.setattr(lg, "_BLOCK", 50)
    assert (lg.grams(text, flags) == whole).all() and not flags.any()


def test_every_label_is_learnt(spark):
    """230 languages of an alphabet of three letters each; the last ones are the rarest."""
    rng = random.Random(5)
    alphabet = {f"l{i:03}": [chr(0x4E00 + 3 * i + k) for k in range(3)] for i in range(230)}
    rows = []
    for i, (lang, own) in enumerate(alphabet.items()):
        for _ in range(12 if i < 200 else 8):
            rows.append((len(rows), " ".join("".join(rng.choice(own) for _ in range(4)) for _ in range(12)), lang, "s", None))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    truth = {r[0]: r[2] for r in rows}
    got = lg.language(docs).collect()
    rare = [r for r in got if truth[r.doc_id] >= "l200"]
    assert sum(r.lang_pred == truth[r.doc_id] for r in rare) / len(rare) > 0.95 and all(0 < r.score <= 1 for r in got)


def test_more_languages_than_landmarks(monkeypatch):
    monkeypatch.setattr(lg, "ALL_LANDMARKS", 8)
    rng = random.Random(2)
    own = {f"l{i:02}": [chr(0x4E00 + 3 * i + k) for k in range(3)] for i in range(20)}
    flags = np.zeros(1 << lg.BITS, bool)
    rows = [(lang, lg.grams(" ".join("".join(rng.choice(a) for _ in range(4)) for _ in range(20)).encode(), flags)) for lang, a in own.items() for _ in range(5)]
    blocks = list(lg.fit_blocks(rows, size=6))
    assert [m for b in blocks for m in b.languages] == sorted(own) and len(blocks) == 4


def test_whole_texts_teach(spark):
    """What tells two languages apart stands behind a long common beginning."""
    rng = random.Random(4)
    common = " ".join("".join(rng.choice("rst") for _ in range(4)) for _ in range(2000))
    rows = [(i, common + " " + speech(rng, ("xx", "yy")[i % 2], 400), ("xx", "yy")[i % 2], "s", None) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert all(r.lang_pred == ("xx", "yy")[r.doc_id % 2] for r in lg.language(docs).collect())
