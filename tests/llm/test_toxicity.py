import random

from pyspark.sql import functions as F

from cases import awkward_rows, folds, frame, plain, words
from tremora.llm import toxicity as tx

OUT = folds(4, 2)


def case(spark, n=600, clash=()):
    rng = random.Random(0)
    rows, labels = [], []
    for i in range(n):
        toxic = rng.random() < 0.15
        w = words(rng, rng.randint(20, 80)).split()
        if toxic:
            for _ in range(3):
                w.insert(rng.randrange(len(w)), rng.choice(["vilemoron", "grotty", "skunkhead" + rng.choice("abc")]))
        rows.append((i, " ".join(w)))
        if rng.random() < 0.7:
            labels.append((i, 1, int(toxic)))
    truth = {d: t for d, _, t in labels}
    return rows, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), truth


def test_held_out_accuracy(spark):
    rows, labels, truth = case(spark)
    got = {r.doc_id: r for r in tx.toxicity(frame(spark, rows, ("score", "c0", "s")), labels).collect()}
    assert {d: r.held_out for d, r in got.items()} == {d: OUT(d) for d, _ in rows}
    held = [d for d in truth if OUT(d)]
    right = [got[d].predicted == truth[d] for d in held]
    assert sum(truth[d] for d in held) > 5 and sum(right) / len(right) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got.values())


def test_only_positive_labels_of_learning_folds_count(spark):
    rows, labels, _ = case(spark)
    docs = frame(spark, rows)
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    other = labels.withColumn("toxic", F.when(held, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert plain(tx.toxicity(docs, labels)) == plain(tx.toxicity(docs, other))


def test_awkward_rows_and_missing_labels(spark):
    rows = awkward_rows()
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = tx.toxicity(frame(spark, rows), none).collect()
    assert len(got) == len(rows) and len({r.score for r in got}) == 1 and not any(r.predicted for r in got)
    odd = spark.createDataFrame([(None, None, 1), (1, None, None), (2, None, 1), (2, None, 0), (10**9, None, 1)], "doc_id long, quality int, toxic int")
    assert len(tx.toxicity(frame(spark, rows), odd).collect()) == len(rows)
    assert plain(tx.toxicity(frame(spark, []), odd)) == []


def test_risk_of_a_wrong_prior_stays_bounded():
    rng = random.Random(2)
    clean = [words(rng, 40).encode() for _ in range(300)]
    bad = [(words(rng, 40) + " grotty skunkhead").encode() for _ in range(40)]
    for prior in (0.08, 0.12, 0.16):  # the true share is 0.12
        model = tx.fit_nnpu(bad, clean + bad, prior)
        assert model.scores(bad).min() > 0.3 > model.scores(clean).max()


def test_rows_below_keep_all_columns(spark):
    rows, labels, _ = case(spark, 200)
    docs = frame(spark, rows).withColumn("a.b", F.lit(1)).withColumn("score", F.lit("x"))
    model = tx.fit(docs, labels)
    kept = tx.below(docs, model)
    assert kept.columns == docs.columns
    scores = {r.doc_id: r.predicted for r in tx.toxicity(docs, labels).collect()}
    assert {r.doc_id for r in kept.collect()} == {d for d, p in scores.items() if not p}


def test_words_late_in_long_texts_are_learnt(spark):
    """The toxic words stand after 9 000 characters of every toxic text, and long clean texts have none."""
    rng = random.Random(4)
    rows, labels = [], []
    for i in range(240):
        toxic = i % 6 == 0
        rows.append((i, words(rng, 2_400) + (" grotty skunkhead " if toxic else " ") + words(rng, 20)))
        labels.append((i, 1, int(toxic)))
    assert min(len(t) for _, t in rows) > 9_000
    got = {r.doc_id: r for r in tx.toxicity(frame(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()}
    assert sum(OUT(d) and d % 6 == 0 for d in got) > 5
    assert all(r.predicted for d, r in got.items() if d % 6 == 0)
    assert sum(r.predicted for d, r in got.items() if d % 6) < 6  # words that meet by chance, of 200 texts


def test_fit_in_tasks_equals_fit_at_hand(spark):
    rows, labels, _ = case(spark)
    sample, prior = tx.training_sample(frame(spark, rows), labels)
    texts = [(r.toxic, r.text.encode()) for r in sample.collect()]
    here = tx.fit_nnpu([t for k, t in texts if k], [t for k, t in texts if not k], prior)
    there = tx.fit(frame(spark, rows), labels)
    assert sorted(here.features.tolist()) == sorted(there.features.tolist())


def test_sample_is_the_same_however_rows_are_split(spark):
    rows, labels, _ = case(spark)
    docs = frame(spark, rows)
    bounds = {"max_positive": 20, "max_unlabelled": 150}
    drawn = [sorted((r.row, r.toxic, r.text) for r in tx.training_sample(docs.repartition(n), labels, **bounds)[0].collect()) for n in (1, 7)]
    assert drawn[0] == drawn[1] and len({r for r, _, _ in drawn[0]}) == len(drawn[0])
    assert 0 < sum(t for _, t, _ in drawn[0]) <= 40 and 130 <= sum(not t for _, t, _ in drawn[0]) <= 150


def test_copies_of_a_row_do_not_fill_the_sample(spark):
    """A third of all rows are one row, and another third one id on different texts."""
    rows, labels, _ = case(spark)
    many = rows + [(5, "a text that comes again and again")] * 600 + [(7, f"text number {i} of one id") for i in range(600)]
    sample, _ = tx.training_sample(frame(spark, many), labels, max_positive=20, max_unlabelled=300)
    got = sample.collect()
    texts = [r.text for r in got if not r.toxic]
    assert 200 <= len(texts) <= 300 and texts.count("a text that comes again and again") <= 1
    assert len([r for r in got if r.toxic]) <= 40


def test_levels_keep_the_bound():
    assert tx._levels([(3, 5), (1, 2), (2, 4)], 6) == [1, 2] and tx._levels([(1, 2), (1, 3)], 5) == [1]
    assert tx._levels([(1, 99), (2, 3)], 5) == [2] and tx._levels([], 5) == []
