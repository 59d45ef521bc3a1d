"""SimHash near-duplicates through deletion-variant signatures.

A 64-bit fingerprint is cut into three segments. If two fingerprints differ in at most
four bits, one segment differs in at most one bit; it then equals the other's segment
once the bit at that place is wildcarded. So every fingerprint is indexed under its 64
one-wildcard segment variants, equal variants meet in one sorted stream, and candidates
are verified on all 64 bits. Only distinct fingerprints are indexed, so a group of
copies costs one entry.

A crowded variant (more than ``crowd`` fingerprints could share it) is not compared
pair by pair. Two fingerprints within four bits have a point within two bits of both,
so crowded ones are linked through the 2081 points around each: a cost in proportion to
the fingerprints, with no link lost and no link added.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tremora.llm.common import materialise, utf8_texts
from tremora.llm.components import components

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
SEED = 42
DISTANCE = 4
SEGMENTS = ((42, 22), (21, 21), (0, 21))  # (lowest bit, bits): 64 / 3, for at most one differing bit in one
CROWD = 4096
SALTS = 32  # parts of the documents with one fingerprint
BLOCK = 1 << 16  # shingles hashed at a time
_MASK = [((1 << n) - 1) << at for at, n in SEGMENTS]
_BITS = [(s, b) for s, (at, n) in enumerate(SEGMENTS) for b in range(at, at + n)]


def fingerprint(text: bytes, shingle: int = 4) -> int:
    """Majority bits of the XXH64 of all word shingles; 0 without words."""
    words = WORD.findall(text.lower())  # of bytes, lower() changes A-Z only
    if not words:
        return 0
    joined = b" ".join(words)
    size = min(shingle, len(words))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate([[0], ends[:-1]])
    starts, ends = starts[: len(words) - size + 1], ends[size - 1 :] - 1
    del words
    ones, digest = np.zeros(64, np.int64), xxhash.xxh64_intdigest
    for at in range(0, len(starts), BLOCK):
        pairs = zip(starts[at : at + BLOCK].tolist(), ends[at : at + BLOCK].tolist())
        hashes = np.array([digest(joined[a:b], SEED) for a, b in pairs], ">u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(starts)).tobytes(), "big")


def _fingerprint_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        fps = np.fromiter((fingerprint(t) for t in utf8_texts(b)), np.uint64, b.num_rows)
        kept = [c for c in b.schema.names if c != "text"]
        yield pa.RecordBatch.from_arrays([*(b.column(c) for c in kept), pa.array(fps.view(np.int64))], names=[*kept, "fp"])


def fingerprints(docs: DataFrame, row: str | None = None) -> DataFrame:
    """doc_id, ``row`` if it is named, and fp (the 64 bits as a signed long) of every row."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *([F.col(row).alias("row")] if row else []),
                        F.coalesce("text", F.lit("")).alias("text"))
    kept = [f for f in texts.schema if f.name != "text"]
    return texts.mapInArrow(_fingerprint_batches, StructType([*kept, StructField("fp", LongType())]))


_VARIANT = pa.schema([("key", pa.int32()), ("fp", pa.int64())])


def _keys(fp: np.ndarray, seg: int, bit: int) -> np.ndarray:
    at = SEGMENTS[seg][0]
    value = (fp & np.uint64(_MASK[seg] & ~(1 << bit))) >> np.uint64(at)
    return (value | np.uint64(bit << 24)).astype(np.int32)


def _variant_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        fp = b.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
        for seg, bit in _BITS:
            yield pa.RecordBatch.from_arrays([pa.array(_keys(fp, seg, bit)), b.column("fp")], schema=_VARIANT)


def roots_of(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Smallest index connected to each of n nodes through links a-b."""
    lab = np.arange(n)
    while True:
        low = np.minimum(lab[a], lab[b])
        new = lab.copy()
        np.minimum.at(new, lab[a], low)
        np.minimum.at(new, lab[b], low)
        while (nxt := new[new]).tobytes() != new.tobytes():
            new = nxt
        if (new == lab).all():
            return lab
        lab = new


def _linked(key: np.ndarray, fp: np.ndarray, most: int = 1 << 20) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links of sorted (key, fp): equal keys, at most DISTANCE differing bits."""
    n, lab, a, b, held = len(fp), np.arange(len(fp)), [], [], 0
    at = np.flatnonzero(key[1:] == key[:-1])  # rows whose partner at the present lag has the same key
    lag = 1
    while len(at):
        near = at[np.bitwise_count(fp[at] ^ fp[at + lag]) <= DISTANCE]
        a.append(near)
        b.append(near + lag)
        held += len(near)
        if held > most:  # fold what is known into labels, so that dense groups need no list of pairs
            lab = roots_of(np.concatenate([np.arange(n), *a]), np.concatenate([lab, *b]), n)
            a, b, held = [], [], 0
        lag += 1
        at = at[at + lag < n]
        at = at[key[at] == key[at + lag]]
    if a and (held or lab.any()):
        lab = roots_of(np.concatenate([np.arange(n), *a]), np.concatenate([lab, *b]), n)
    moved = np.flatnonzero(lab != np.arange(n))
    return fp[moved], fp[lab[moved]]


_LINK = pa.schema([("u", pa.int64()), ("v", pa.int64())])


def _verify_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links within runs of equal keys; batches arrive sorted, and a run may go on in the next."""
    key, fp = np.zeros(0, np.int32), np.zeros(0, np.uint64)
    last = False
    batches = iter(batches)
    while not last:
        b = next(batches, None)
        last = b is None
        if not last:
            key = np.concatenate([key, b.column("key").to_numpy(zero_copy_only=False)])
            fp = np.concatenate([fp, b.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)])
        cut = len(key) if last else int(np.searchsorted(key, key[-1])) if len(key) else 0
        if cut:
            u, v = _linked(key[:cut], fp[:cut])
            yield pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], schema=_LINK)
            key, fp = key[cut:], fp[cut:]


_FLIPS = np.array([0, *(1 << i for i in range(64)), *((1 << i) | (1 << j) for i, j in combinations(range(64), 2))], np.uint64)
_POINT = pa.schema([("point", pa.int64()), ("fp", pa.int64())])


def _point_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for fp in np.array_split(b.column("fp").to_numpy(zero_copy_only=False), max(1, b.num_rows // 64)):
            points = (fp.view(np.uint64)[:, None] ^ _FLIPS).ravel().view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(points), pa.array(np.repeat(fp, len(_FLIPS)))], schema=_POINT)


def _crowded_links(fps: DataFrame) -> DataFrame:
    """Links of crowded fingerprints to the smallest one around each shared point."""
    points = fps.mapInArrow(_point_batches, "point long, fp long")
    least = points.groupBy("point").agg(F.min("fp").alias("v"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    return points.join(least, "point").where("fp <> v").select(F.col("fp").alias("u"), "v").distinct()


def fingerprint_links(distinct: DataFrame, crowd: int = CROWD) -> DataFrame:
    """Links (u, v) whose components equal those of all pairs within four bits.

    ``distinct``: a stored table with one row per fingerprint ``fp``.
    """
    spark = distinct.sparkSession
    # a variant's bucket is the union of two exact segment values, so it holds more than
    # ``crowd`` only if one of the two has over half as many; few values can
    segments = [F.shiftright(F.col("fp").bitwiseAND(F.lit(m - (1 << 64) if m >> 63 else m)), at)
                .bitwiseAND(F.lit((1 << n) - 1)).cast("int") for m, (at, n) in zip(_MASK, SEGMENTS)]
    values = distinct.select("fp", F.posexplode(F.array(*segments)).alias("seg", "value"))
    heavy = materialise(values.groupBy("seg", "value").count().where(F.col("count") > crowd // 2).drop("count"), "heavy")
    variants = distinct.mapInArrow(_variant_batches, "key int, fp long")
    if heavy.isEmpty():
        crowded = None
    else:
        flips = [F.when(F.col("seg") == s, F.array(*[
            F.col("value").bitwiseAND(F.lit(((1 << n) - 1) & ~(1 << b))).bitwiseOR(F.lit((at + b) << 24)) for b in range(n)]))
            for s, (at, n) in enumerate(SEGMENTS)]
        keys = heavy.select(F.explode(F.coalesce(*flips)).alias("key")).distinct()
        crowded = variants.join(keys, "key", "left_semi").select("fp").distinct()
        variants = variants.join(keys, "key", "left_anti")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    links = (
        variants.repartition(parts, "key").sortWithinPartitions("key", "fp")
        .mapInArrow(_verify_batches, "u long, v long")
    )
    return links if crowded is None else links.union(_crowded_links(crowded))


def simhash_components(docs: DataFrame, crowd: int = CROWD, row: str | None = None) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every row of ``docs``.

    Fingerprints link at four or fewer differing bits; component_id is the smallest
    doc_id reachable over links. A text without words has fingerprint zero and links
    like any other; null counts as empty. A row without id gets its component's
    smallest id (null if no member has one). Rows repeating one doc_id each come back.
    Other columns are ignored.

    ``row`` names a column that is different in every row (of an orderable type). It comes back as
    ``row``, with ``kept``, true for one row of each component: the first one of the smallest id,
    rows without id last.
    """
    rows = materialise(fingerprints(docs, row), "fingerprints")
    least_of = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row") if row else "doc_id")
    distinct = materialise(rows.groupBy("fp").agg(least_of.alias("rep")), "distinct")
    linked = components(fingerprint_links(distinct, crowd))
    named = distinct.join(linked.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "rep", F.coalesce("root", "fp").alias("root"))
    least = named.groupBy("root").agg(F.min("rep").alias("least"))
    by_fp = named.join(least, "root").select("fp", "least")
    # copies share a fingerprint, so the answers go to at most SALTS parts of each, and from there to the rows
    many = rows.withColumn("salt", F.pmod(F.xxhash64("doc_id", *(["row"] if row else [])), F.lit(SALTS)).cast("int"))
    parts = many.select("fp", "salt").distinct().join(by_fp, "fp")
    found = many.join(parts.hint("merge"), ["fp", "salt"])
    fingerprint_text = F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint")
    if not row:
        return found.select("doc_id", fingerprint_text, F.col("least").alias("component_id"))
    return found.select("doc_id", fingerprint_text, F.col("least.doc_id").alias("component_id"),
                        (F.col("row") == F.col("least.row")).alias("kept"), "row")
