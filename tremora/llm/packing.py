"""Packing by optimal length buckets.

Token counts of the whole corpus form one histogram, which has at most ``max_tokens``
rows however large the corpus is. Dynamic programming over it picks the bucket
boundaries that minimise the padding of all sequences, and token-budget batches form
inside each bucket: every sequence of a batch is padded to the bucket's boundary, and a
batch holds as many as the budget allows. Texts longer than ``max_tokens`` are split
into sequences of that length and a rest, so no token is lost.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tremora.llm.common import id_text, materialise, slices, utf8_texts
from tremora.llm.tokens import BYTE_BPE, encoder, tokenizer_path

MAX_TOKENS = 4096
BUCKETS = 12
BUDGET = 65_536  # tokens of a batch, padding included
SLICE = 20_000  # sequences of a bucket that form batches together, on average


def bucket_bounds(lengths: np.ndarray, counts: np.ndarray, buckets: int) -> tuple[list[int], int]:
    """At most ``buckets`` upper bounds that minimise total padding, and that padding.

    ``lengths``: distinct, ascending. The last bound is the largest length. Of equal
    paddings, the one with the fewest buckets wins, then the smallest bounds.
    """
    m = len(lengths)
    if not m:
        return [], 0
    length, many = lengths.astype(np.int64), counts.astype(np.int64)
    n = np.concatenate([[0], np.cumsum(many)])
    s = np.concatenate([[0], np.cumsum(many * length)])
    big = np.iinfo(np.int64).max // 4
    best = np.full(m + 1, big)
    best[0] = 0
    cuts, costs = [], []
    for _ in range(min(buckets, m)):
        new, cut = np.full(m + 1, big), np.zeros(m + 1, np.int64)
        for j in range(1, m + 1):  # a bucket of lengths i..j-1, all padded to length[j-1]
            c = best[:j] + length[j - 1] * (n[j] - n[:j]) - (s[j] - s[:j])
            cut[j] = np.argmin(c)
            new[j] = c[cut[j]]
        best = new
        cuts.append(cut)
        costs.append(int(best[m]))
    k = int(np.argmin(costs))
    bounds, j = [], m
    for cut in reversed(cuts[: k + 1]):
        bounds.append(int(length[j - 1]))
        j = int(cut[j])
    return bounds[::-1], costs[k]


def token_counts(docs: DataFrame, tokenizer: str | None = None, batch_bytes: int = 1 << 21) -> DataFrame:
    """doc_id and n_tokens of every row of ``docs``; an empty or null text has 0 tokens."""
    path = tokenizer or tokenizer_path(BYTE_BPE)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path).encode
        for whole in batches:
            for b in slices(whole, "text", batch_bytes):
                n = encode(list(utf8_texts(b)))[1]
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(n, pa.int64())], names=["doc_id", "n_tokens"])

    return id_text(docs).mapInArrow(run, "doc_id long, n_tokens long")


def sequences(counts: DataFrame, max_tokens: int = MAX_TOKENS) -> DataFrame:
    """doc_id, piece, first_token, n_tokens: texts cut at every ``max_tokens``; empty texts give no sequence."""
    pieces = F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(n_tokens - 1) div {max_tokens}")))
    return counts.where("n_tokens > 0").select("doc_id", pieces.alias("piece"), "n_tokens").select(
        "doc_id", "piece", (F.col("piece") * max_tokens).alias("first_token"),
        F.least(F.lit(max_tokens).cast("long"), F.col("n_tokens") - F.col("piece") * max_tokens).alias("n_tokens"))


def _bound(bounds: list[int]) -> Column:
    """Smallest bound that is no less than n_tokens."""
    return F.element_at(F.filter(F.array(*[F.lit(b).cast("long") for b in bounds]), lambda b: b >= F.col("n_tokens")), 1)


def pack(seqs: DataFrame, buckets: int = BUCKETS, budget: int = BUDGET, slice_rows: int = SLICE,
         max_tokens: int = MAX_TOKENS) -> DataFrame:
    """doc_id, piece, first_token, n_tokens, bucket, batch, slot, padding of every sequence.

    ``bucket`` is the length a sequence is padded to, ``batch`` names its batch and
    ``slot`` its place there. A batch holds max(1, budget // bucket) sequences of one
    bucket. A bucket is dealt into slices of about ``slice_rows`` sequences by a hash of
    the document, and batches form inside a slice, so no task sees a whole bucket and
    only the last batch of a slice may be short. ``seqs`` must be stored: it is read twice.
    """
    spark = seqs.sparkSession
    histogram = sorted((r.n_tokens, r.n) for r in seqs.groupBy("n_tokens").agg(F.count(F.lit(1)).alias("n")).collect())
    if histogram and histogram[-1][0] > max_tokens:  # bounds the rows above
        raise ValueError(f"a sequence has over {max_tokens} tokens; cut it first")
    lengths = np.array([n for n, _ in histogram], np.int64)
    counts = np.array([c for _, c in histogram], np.int64)
    bounds, _ = bucket_bounds(lengths, counts, buckets)
    if not bounds:
        return spark.createDataFrame([], "doc_id long, piece long, first_token long, n_tokens long, bucket long, batch string, slot int, padding long")
    which = np.searchsorted(bounds, lengths)
    per = np.bincount(which, weights=counts, minlength=len(bounds))
    slices_of = F.create_map(*[F.lit(x) for b, n in zip(bounds, per) for x in (int(b), max(1, int(n // slice_rows)))])
    placed = seqs.withColumn("bucket", _bound(bounds)).withColumn(
        "slice", F.pmod(F.xxhash64("doc_id", "piece"), slices_of[F.col("bucket").cast("int")].cast("long")))
    order = Window.partitionBy("bucket", "slice").orderBy("doc_id", "piece", "n_tokens")
    size = F.greatest(F.lit(1).cast("long"), F.expr(f"{budget} div bucket"))
    at = F.row_number().over(order) - 1
    return placed.withColumn("at", at).select(
        "doc_id", "piece", "first_token", "n_tokens", "bucket",
        F.format_string("%d-%d-%d", F.col("bucket"), F.col("slice"), F.floor(F.col("at") / size)).alias("batch"),
        (F.col("at") % size).cast("int").alias("slot"), (F.col("bucket") - F.col("n_tokens")).alias("padding"))


def length_buckets(docs: DataFrame, buckets: int = BUCKETS, budget: int = BUDGET, max_tokens: int = MAX_TOKENS,
                   slice_rows: int = SLICE, tokenizer: str | None = None) -> DataFrame:
    """Token counts, sequences and batches of ``docs`` (see ``pack``); texts without a token give no row.

    Rows without id form sequences too; rows that repeat a doc_id are told apart by their batch and slot.
    """
    counts = materialise(token_counts(docs, tokenizer), "token-counts")
    return pack(sequences(counts, max_tokens), buckets, budget, slice_rows, max_tokens)
