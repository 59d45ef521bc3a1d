"""Exact duplicate removal by a tree-merge of sorted digest runs.

Every input partition first reduces to a run: one row per distinct digest with the
best document so far and a count. Runs then merge in rounds. In a round, ``width``
runs that differ in one group of label bits exchange: each keeps the digests whose
next leading bits equal its own, so after the last round every place holds one slice
of the digest space from all runs. A group of copies, however large, is one row per
run from the first step on, and the answer goes back down the same tree: the final
rows join the leaf runs by digest, and the leaf runs join the documents by
(run, digest), which splits a large group over all runs.

Equality is verified at every level: rows merge only if SHA-256, a second 64-bit hash
of the normalised text and its length all agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tremora.llm.common import materialise

SPACE = r"[\x20\x09-\x0D]"
KEY = ("digest", "check", "size")


def _best() -> Column:
    # most code points first, then the smallest id: ~id reverses the order without overflow
    return F.max("best").alias("best")


def digest_rows(docs: DataFrame, bits: int, row: str | None = None) -> DataFrame:
    """doc_id, key, run (the input partition folded to ``bits`` bits) and the offer of each row."""
    norm = F.regexp_replace("text", SPACE, "")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"),
                        *([F.col(row).alias("row")] if row else []))
    own = ["row"] if row else []
    return texts.select(
        "doc_id", *own, F.length("text").alias("n_chars"), norm.alias("norm"),
        F.spark_partition_id().bitwiseAND(F.lit((1 << bits) - 1)).alias("run"),
    ).select(
        "doc_id", *own, "run", F.unhex(F.sha2("norm", 256)).alias("digest"), F.xxhash64("norm").alias("check"),
        F.octet_length("norm").alias("size"),
        F.struct(F.col("n_chars"), F.bitwise_not("doc_id").alias("rev"), *own).alias("best"),
    )


def merge_runs(leaves: DataFrame, bits: int, width_bits: int = 4) -> DataFrame:
    """Merge leaf runs (run, key, best, n) to one row per key, ``2**width_bits`` runs at a time."""
    head = F.conv(F.substring(F.hex("digest"), 1, 8), 16, 10).cast("long")
    shard = F.shiftright(head, 32 - bits).cast("int")
    level, done = leaves, 0
    while done < bits:
        done = min(bits, done + width_bits)
        low = bits - done  # label bits that still come from the run
        place = F.shiftleft(F.shiftright(shard, low), low).bitwiseOR(F.col("run").bitwiseAND(F.lit((1 << low) - 1)))
        level = level.withColumn("run", place).groupBy("run", *KEY).agg(_best(), F.sum("n").alias("n"))
    return level


def exact_dedup(docs: DataFrame, bits: int | None = None, width_bits: int = 4, row: str | None = None) -> DataFrame:
    """One row per row of ``docs``: which document of its group of equal texts stays.

    Texts are equal if identical after deleting space, tab, LF, VT, FF and CR. The row
    with the most code points in its original text stays; of those, the smallest id.

    Returns doc_id, keep_id, group_size, kept, text_sha256. A null text counts as empty;
    empty texts form a group like any other. Of rows with equally many code points, those
    without id come last; one with the most stays, and keep_id is then null for the whole group.
    Rows of one doc_id and text share one verdict and all count in group_size. Other columns are ignored.

    ``row`` names a column that is different in every row (of an orderable type). It comes back as
    ``row``, and ``kept`` is then true for one row of each group only.

    Runs are kept as rows under a label, not as files; a merge is one aggregation by label and digest,
    which sorts what it takes in.

    ``bits``: log2 of the number of runs; by default it follows the session's shuffle
    partitions, with 64 runs at least.
    """
    spark = docs.sparkSession
    if bits is None:
        bits = max(6, (int(spark.conf.get("spark.sql.shuffle.partitions")) - 1).bit_length())
    rows = materialise(digest_rows(docs, bits, row), "digests")  # texts are read once
    leaves = rows.groupBy("run", *KEY).agg(_best(), F.count(F.lit(1)).alias("n"))
    final = merge_runs(leaves, bits, width_bits).select(
        *KEY, F.bitwise_not(F.col("best.rev")).alias("keep_id"), F.col("n").alias("group_size"),
        *([F.col("best.row").alias("keep_row")] if row else []))
    answers = leaves.select("run", *KEY).join(final, list(KEY))
    return rows.join(answers, ["run", *KEY]).select(
        "doc_id", "keep_id", "group_size",
        (F.col("row") == F.col("keep_row") if row else F.col("doc_id").eqNullSafe(F.col("keep_id"))).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"), *(["row"] if row else []),
    )


ORACLE = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t,
                  regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents),
r AS (SELECT doc_id, norm,
             first_value(doc_id) OVER (PARTITION BY norm ORDER BY length(t) DESC, doc_id) AS keep_id,
             count(*) OVER (PARTITION BY norm) AS group_size FROM d)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM r
"""
