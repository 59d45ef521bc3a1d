import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from cases import awkward_rows, frame
from tokenizers import Tokenizer
from tremora.llm import packing, tokens


def padding(lengths, counts, bounds):
    return sum(c * (min(b for b in bounds if b >= n) - n) for n, c in zip(lengths, counts))


@pytest.mark.parametrize("seed", range(6))
def test_bounds_are_optimal(seed):
    rng = np.random.default_rng(seed)
    lengths = np.sort(rng.choice(np.arange(1, 60), 9, replace=False))
    counts = rng.integers(1, 20, 9)
    for k in (1, 2, 3, 9, 20):
        bounds, cost = packing.bucket_bounds(lengths, counts, k)
        best = min(padding(lengths, counts, (*c, lengths[-1])) for r in range(min(k, 9)) for c in itertools.combinations(lengths[:-1], r))
        assert len(bounds) <= k and bounds[-1] == lengths[-1] and cost == best == padding(lengths, counts, bounds)


def test_no_lengths():
    assert packing.bucket_bounds(np.zeros(0), np.zeros(0), 3) == ([], 0)


@pytest.mark.parametrize("budget, slice_rows", [(1024, 20_000), (256, 10)])
def test_every_token_is_in_a_batch(spark, budget, slice_rows):
    rows = [r for r in awkward_rows() if r[0] is not None]
    out = packing.length_buckets(frame(spark, rows, ("bucket", "batch", "n_tokens")), 4, budget, 200, slice_rows).toPandas()
    model = Tokenizer.from_file(tokens.tokenizer_path())
    want = sorted(len(model.encode(t, add_special_tokens=False).ids) for _, t in rows if t)
    by_doc = {}
    for r in out.itertuples():
        by_doc.setdefault(r.doc_id, []).append(r)
    assert int(out.n_tokens.sum()) == sum(want)
    histogram = out.groupby("n_tokens").size()
    bounds, cost = packing.bucket_bounds(histogram.index.to_numpy(), histogram.to_numpy(), 4)
    assert set(out.bucket) <= set(bounds) and int(out.padding.sum()) == cost
    assert (out.bucket - out.n_tokens == out.padding).all() and (out.padding >= 0).all()
    for _, batch in out.groupby("batch"):
        assert batch.bucket.nunique() == 1
        assert sorted(batch.slot) == list(range(len(batch)))
        assert len(batch) <= max(1, budget // batch.bucket.iloc[0])
    if slice_rows > 1000:  # one slice: only the last batch of a bucket may be short
        for bound, bucket in out.groupby("bucket"):
            short = sum(1 for _, b in bucket.groupby("batch") if len(b) < max(1, budget // bound))
            assert short <= 1


def test_long_texts_are_cut_without_loss(spark):
    counts = spark.createDataFrame([(1, 1000), (2, 100), (3, 0), (4, 101), (None, 5)], "doc_id long, n_tokens long")
    got = sorted(((r.doc_id, r.piece, r.first_token, r.n_tokens) for r in packing.sequences(counts, 100).collect()), key=repr)
    want = [(1, i, 100 * i, 100) for i in range(10)] + [(2, 0, 0, 100), (4, 0, 0, 100), (4, 1, 100, 1), (None, 0, 0, 5)]
    assert got == sorted(want, key=repr)


def test_empty_tables(spark):
    assert packing.length_buckets(frame(spark, [])).count() == 0
    assert packing.length_buckets(frame(spark, [(1, None), (2, "")])).count() == 0


def test_too_long_a_sequence_raises(spark):
    seqs = spark.range(1).select(F.col("id").alias("doc_id"), F.lit(0).cast("long").alias("piece"), F.lit(0).cast("long").alias("first_token"),
                                 F.lit(99).cast("long").alias("n_tokens"))
    with pytest.raises(ValueError):
        packing.pack(seqs, max_tokens=50)
