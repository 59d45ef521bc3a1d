"""Removal of repeated byte strings with suffix arrays over shards.

A string of LENGTH bytes is dealt to a shard by its content, so that equal strings meet
whatever documents they stand in. Its place of dealing is an anchor: the smallest hash
among its GRAM-byte substrings. Neighbouring strings mostly have the same anchor; such a
run and the bytes it covers make a piece.

1. Anchors are compared by hash, and pieces of one anchor by 128 bits of their SHA-256.
   Strings around an anchor that occurs once cannot repeat, and of equal pieces all but
   the first are repeats throughout. First this is done within each batch of texts, so a
   passage that very many documents share leaves a batch once.
2. What is left are anchors with different pieces. These are cut out of the texts and
   dealt by anchor. A shard joins the pieces of whole anchors to one string, sorts its
   suffixes by induced sorting and computes their permuted common prefixes. Neighbours
   in the suffix array with a common prefix of LENGTH or more are equal strings; all but
   the first in the corpus are marked.
3. An anchor with very many pieces (over ``crowd`` bytes) is dealt string by string, by a
   hash of the whole string, so no shard grows with the commonest passage.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tremora.llm.common import id_text, materialise, utf8_texts
from tremora.llm.suffix import common_prefixes, suffix_array
from tremora.session import broadcast_if_small

LENGTH = 100
GRAM = 24
CROWD = 1 << 20  # bytes of all pieces of an anchor
SHARD = 1 << 20  # bytes of pieces, beyond which no further anchor is added to a shard
_BLOCK = 1 << 21  # bytes of a text looked through at a time
_MULT = np.uint64(0x9E3779B97F4A7C15)
_NO_ID = np.iinfo(np.int64).max


def _gram_hashes(data: bytes, n: int, size: int) -> np.ndarray:
    """Hash of the ``size`` bytes from each of the first ``n`` places of ``data``."""
    at = np.ndarray((len(data) + 1,), "<u8", data + bytes(8), strides=(1,))
    h = np.full(n, size, np.uint64)
    for o in range(0, size, 8):
        x = at[o : o + n]
        if size - o < 8:
            x = x & np.uint64((1 << 8 * (size - o)) - 1)
        h = (h ^ x) * _MULT
        h ^= h >> np.uint64(32)
    return h


def _sliding(h: np.ndarray, width: int, pick: np.ufunc, fill: int) -> np.ndarray:
    """Minimum or maximum (``pick``) of every ``width`` neighbours."""
    n = len(h) - width + 1
    full = np.full(-(-len(h) // width) * width, fill, np.uint64)
    full[: len(h)] = h
    rows = full.reshape(-1, width)
    fore = pick.accumulate(rows, axis=1).ravel()
    back = pick.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return pick(back[:n], fore[width - 1 : width - 1 + n])


def anchors(text: bytes, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """Runs of strings with the same anchor: first start, number of starts, anchor hash, loop.

    A run ends where the smallest hash changes, so it depends on content alone. ``loop``
    tells that the smallest hash stands at several places of the run (as in periodic
    text); only then can strings of one run be equal.
    """
    found = []
    width = length - gram + 1
    for at in range(0, len(text) - length + 1, _BLOCK):
        part = text[at : at + _BLOCK + length - 1]
        n = len(part) - length + 1
        h = _gram_hashes(part, len(part) - gram + 1, gram)
        least = _sliding(h, width, np.minimum, np.iinfo(np.uint64).max)
        first = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
        many = np.diff(np.append(first, n))
        # the places that are smallest in some string, in order; those of a run stand together
        wide = np.zeros(n + 2 * (width - 1), np.uint64)
        wide[width - 1 : width - 1 + n] = least
        chosen = h[h == _sliding(wide, width, np.maximum, 0)]
        run = np.cumsum(np.concatenate([[True], chosen[1:] != chosen[:-1]])) - 1
        found.append((first + at, many, least[first].view(np.int64), np.bincount(run, minlength=len(first)) > 1))
    if not found:
        return (*(np.zeros(0, np.int64) for _ in range(3)), np.zeros(0, bool))
    return tuple(np.concatenate(x) for x in zip(*found))


def piece_digests(text: bytes, start: np.ndarray, n: np.ndarray) -> bytes:
    """16 bytes of the SHA-256 of every piece, one after the other."""
    sha = hashlib.sha256
    return b"".join([sha(text[a:b]).digest()[:16] for a, b in zip(start.tolist(), (start + n + (LENGTH - 1)).tolist())])


# anchors that repeat ---------------------------------------------------------------------------------
#
# A place packs a run: start, number of starts and whether it loops. doc orders the documents, row names them.

_ANCHOR = pa.schema([(c, pa.int64()) for c in ("hash", "d1", "d2", "doc", "row", "place")] + [("kind", pa.int8())])
_ANCHOR_DDL = "hash long, d1 long, d2 long, doc long, row long, place long, kind byte"
_ASK, _KNOWN, _EQUAL = 0, 1, 2  # to be compared; known to have a different piece of its anchor elsewhere; a repeat throughout
_STAND_IN = -1  # row of an entry that only says that its anchor has different pieces


def _pack(start: np.ndarray, n: np.ndarray, loop: np.ndarray) -> np.ndarray:
    return (start << 23) | (n << 1) | loop


def _unpack(place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return place >> 23, (place >> 1) & ((1 << 22) - 1), (place & 1).astype(bool)


def _later(code: np.ndarray, d1: np.ndarray, d2: np.ndarray, doc: np.ndarray, row: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Which entries have an equal piece with an earlier (doc, row, start) among these."""
    _, which, times = np.unique(d1, return_inverse=True, return_counts=True)
    some = np.flatnonzero(times[which] > 1)
    some = some[np.lexsort((place[some], row[some], doc[some], d2[some], d1[some], code[some]))]
    out = np.zeros(len(code), bool)
    a, b = some[1:], some[:-1]
    out[a] = (code[a] == code[b]) & (d1[a] == d1[b]) & (d2[a] == d2[b])
    return out


def _batch(columns: Iterable[np.ndarray], kind: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in columns), pa.array(kind, pa.int8())], schema=_ANCHOR)


def _anchor_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Anchors of the texts. Equal pieces of a batch are settled here. Where an anchor has different
    pieces in the batch, or loops, this is known of all of them, and one stand-in tells it elsewhere."""
    for b in batches:
        found, digests = [], []
        for t in utf8_texts(b):
            found.append(anchors(t))
            digests.append(piece_digests(t, *found[-1][:2]))
        many = [len(f[0]) for f in found]
        if not sum(many):
            continue
        start, n, code, loop = (np.concatenate(x) for x in zip(*found))
        d1, d2 = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2).T.copy()
        doc, row = (np.repeat(b.column(c).to_numpy(zero_copy_only=False), many) for c in ("doc", "row"))
        place = _pack(start, n, loop)
        kind = np.where(_later(code, d1, d2, doc, row, place), _EQUAL, _ASK).astype(np.int8)
        own = kind == _ASK
        _, first, which, times = np.unique(code[own], return_index=True, return_inverse=True, return_counts=True)
        known = (times > 1) | (np.bincount(which, weights=loop[own], minlength=len(times)) > 0)
        kind[own] = np.where(known[which], _KNOWN, _ASK)
        yield _batch((code, d1, d2, doc, row, place), kind)
        stand = code[own][first[known]]
        if len(stand):
            zero = np.zeros(len(stand), np.int64)
            yield _batch((stand, zero, zero, zero, zero + _STAND_IN, zero), zero.astype(np.int8))


def _compare_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of batches sorted by kind and hash, the runs whose anchor has different pieces (known) and those
    that repeat throughout (equal). Of an anchor, each batch of texts has sent one entry at most."""
    held: list[pa.RecordBatch] = []  # entries of the last anchor, which may go on
    batches = iter(batches)
    last = False
    while not last:
        b = next(batches, None)
        last = b is None
        if not last:
            settled = pa.compute.not_equal(b.column("kind"), _ASK)
            done = b.filter(settled)
            if done.num_rows:
                yield done
            b = b.filter(pa.compute.invert(settled))
            if not b.num_rows:
                continue
            held.append(b)
        if not held:
            break
        t = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        code = t.column("hash").to_numpy(zero_copy_only=False)
        cut = len(code) if last else int(np.searchsorted(code, code[-1]))
        held = [t.slice(cut)] if cut < len(code) else []
        if not cut:
            continue
        # an anchor with a single entry is done with
        single = np.ones(cut, bool)
        single[1:] &= code[1:cut] != code[: cut - 1]
        single[:-1] &= code[1:cut] != code[: cut - 1]
        t = t.slice(0, cut).filter(pa.array(~single))
        if not t.num_rows:
            continue
        code, d1, d2, doc, row, place = (t.column(c).to_numpy(zero_copy_only=False) for c in _ANCHOR.names[:6])
        real = row != _STAND_IN
        later = np.zeros(len(code), bool)
        later[real] = _later(*(c[real] for c in (code, d1, d2, doc, row, place)))
        group = np.cumsum(np.concatenate([[True], code[1:] != code[:-1]])) - 1
        different = np.bincount(group, weights=~later) > 1  # pieces, or a stand-in
        keep = real & (later | different[group])
        kind = np.where(later, _EQUAL, _KNOWN).astype(np.int8)[keep]
        yield _batch((c[keep] for c in (code, d1, d2, doc, row, place)), kind)


def compared_anchors(rows: DataFrame, parts: int) -> DataFrame:
    """Runs that repeat throughout (kind _EQUAL) and those to be compared string by string (kind _KNOWN)."""
    found = rows.mapInArrow(_anchor_batches, _ANCHOR_DDL)
    deal = F.when(F.col("kind") == _ASK, F.col("hash")).otherwise(F.xxhash64("row", "place"))
    ordered = found.repartition(parts, deal).sortWithinPartitions("kind", "hash")
    return ordered.mapInArrow(_compare_batches, _ANCHOR_DDL)


# pieces -----------------------------------------------------------------------------------------------

_PIECE = pa.schema([("key", pa.int64()), ("doc", pa.int64()), ("row", pa.int64()), ("place", pa.int64()), ("piece", pa.binary())])
_PIECE_DDL = "key long, doc long, row long, place long, piece binary"


def _piece_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces of the runs, or of a crowded anchor its strings; of equal strings in a batch all but the
    first leave without their bytes, as they are repeats."""
    for b in batches:
        keys, doc, row, place, piece = [], [], [], [], []
        strings: dict[tuple[int, bytes], list[tuple[int, int, int]]] = {}
        for d, r, text, runs in zip(b.column("doc").to_pylist(), b.column("row").to_pylist(), utf8_texts(b), b.column("runs").to_pylist()):
            for run in runs:
                start, n = run["place"] >> 23, (run["place"] >> 1) & ((1 << 22) - 1)
                part = text[start : start + n + LENGTH - 1]
                if not run["crowded"]:
                    keys.append(run["hash"])
                    doc.append(d)
                    row.append(r)
                    place.append(run["place"])
                    piece.append(part)
                    continue
                own = (_gram_hashes(part, n, LENGTH) ^ np.uint64(run["hash"] & (1 << 64) - 1)).view(np.int64).tolist()
                for i, key in enumerate(own):
                    strings.setdefault((key, part[i : i + LENGTH]), []).append((d, r, start + i))
        settled: list[tuple[int, int]] = []
        for (key, part), places in strings.items():
            places.sort()
            d, r, s = places[0]
            keys.append(key)
            doc.append(d)
            row.append(r)
            place.append((s << 23) | 2)
            piece.append(part)
            settled += [(r, s) for _, r, s in places[1:]]
        yield pa.RecordBatch.from_arrays([*(pa.array(x, pa.int64()) for x in (keys, doc, row, place)), pa.array(piece, pa.binary())], schema=_PIECE)
        if settled:  # as runs, dealt anywhere
            r, lo, hi = _runs(*np.array(settled, np.int64).T)
            parts = -(-(hi - lo) // _BLOCK)
            r, hi, first = (np.repeat(x, parts) for x in (r, hi, lo))
            lo = first + _BLOCK * (np.arange(len(r)) - np.repeat(np.cumsum(parts) - parts, parts))
            n = np.minimum(hi - lo, _BLOCK)
            at = _pack(lo, n, np.zeros(len(r), np.int64))
            nothing = pa.nulls(len(r), pa.binary())
            yield pa.RecordBatch.from_arrays([*(pa.array(x, pa.int64()) for x in (at * 31 + r, np.zeros(len(r), np.int64), r, at)), nothing], schema=_PIECE)


# shards -----------------------------------------------------------------------------------------------

_MARK = pa.schema([("row", pa.int64()), ("lo", pa.int64()), ("hi", pa.int64())])


def repeated_starts(pieces: list[bytes], doc: np.ndarray, row: np.ndarray, start: np.ndarray, n: np.ndarray,
                    length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """(row, start) of every string of ``length`` bytes in the pieces that equals one with an earlier (doc, row, start)."""
    joined = b"\x00".join(pieces) + b"\x00"
    s = np.frombuffer(joined, np.uint8).astype(np.int32) + 2
    sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
    begins = np.cumsum(sizes + 1) - sizes - 1
    s[begins + sizes] = 1  # between pieces
    s = np.append(s, 0)
    sa = suffix_array(s)
    equal = common_prefixes(s, sa, length) >= length
    # a suffix with fewer bytes left in its piece has the separator within LENGTH and cannot equal one with more
    left = np.zeros(len(s), bool)
    for_piece = np.repeat(np.arange(len(pieces)), n)
    at = begins[for_piece] + np.arange(len(for_piece)) - np.repeat(np.cumsum(n) - n, n)
    left[at] = True
    of = np.full(len(s), -1, np.int64)
    of[at] = for_piece
    equal[1:] &= left[sa[1:]] & left[sa[:-1]]
    equal[0] = False
    member = equal.copy()
    member[:-1] |= equal[1:]
    group = np.cumsum(~equal)[member]
    place = sa[member].astype(np.int64)
    if not len(place):
        return place, place
    own = of[place]
    begin = start[own] + place - begins[own]
    order = np.lexsort((begin, row[own], doc[own], group))
    group, rows, begin = group[order], row[own][order], begin[order]
    first = np.concatenate([[True], group[1:] != group[:-1]])
    # the same place can stand in two pieces only if a row came twice; it is not its own repeat
    head = np.maximum.accumulate(np.where(first, np.arange(len(first)), 0))
    again = ~first & ~((rows == rows[head]) & (begin == begin[head]))
    return rows[again], begin[again]


def _runs(row: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of neighbouring starts: row, first, end."""
    order = np.lexsort((start, row))
    row, start = row[order], start[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (start[1:] > start[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(row)) - 1 if len(first) else first
    return row[first], start[first], start[last] + 1


def _shard_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Marked runs of starts, from batches of pieces sorted by key."""

    def marks(row: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (row, lo, hi)], schema=_MARK)

    def sort(parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = pa.Table.from_batches(parts)
        key, doc, row, place = (t.column(c).to_numpy() for c in ("key", "doc", "row", "place"))
        start, n, loop = _unpack(place)
        piece = t.column("piece").to_pylist()
        # equal pieces of a key: the first one counts, the others are repeats throughout
        order = np.lexsort((start, row, doc))
        seen: dict[tuple[int, bytes], int] = {}
        first = np.array([seen.setdefault((k, piece[i]), i) for i, k in zip(order.tolist(), key[order].tolist())], np.int64)
        again = order[first != order]
        if len(again):
            yield marks(row[again], start[again], start[again] + n[again])
        own = order[first == order]
        _, which, times = np.unique(key[own], return_inverse=True, return_counts=True)
        own = own[(times[which] > 1) | loop[own]]  # strings of one piece differ unless it loops
        if len(own):
            yield marks(*_runs(*repeated_starts([piece[i] for i in own.tolist()], doc[own], row[own], start[own], n[own])))

    held: list[pa.RecordBatch] = []  # rows of the last key so far
    shard: list[pa.RecordBatch] = []
    size = 0
    batches = iter(batches)
    last = False
    while not last:
        b = next(batches, None)
        last = b is None
        if not last:
            settled = b.column("piece").is_null()
            done = b.filter(settled)
            if done.num_rows:
                lo, n, _ = _unpack(done.column("place").to_numpy(zero_copy_only=False))
                yield marks(done.column("row").to_numpy(zero_copy_only=False), lo, lo + n)
            b = b.filter(pa.compute.invert(settled))
            if not b.num_rows:
                continue
            held.append(b)
        if not held:
            break
        own = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        key = own.column("key").to_numpy(zero_copy_only=False)
        new = np.concatenate([[True], key[1:] != key[:-1]])
        cut = own.num_rows if last else int(np.flatnonzero(new)[-1])
        held = [own.slice(cut)] if cut < own.num_rows else []
        if cut:
            new = new[:cut]
            _, _, loop = _unpack(own.column("place").to_numpy(zero_copy_only=False)[:cut])
            single = new & np.append(new[1:], True) & ~loop
            many = own.slice(0, cut).filter(pa.array(~single))
            if many.num_rows:
                bytes_of = pa.compute.binary_length(many.column("piece")).to_numpy(zero_copy_only=False)
                first = np.flatnonzero(new[~single])
                total = np.cumsum(bytes_of)
                at = 0
                for stop in [*first[1:].tolist(), many.num_rows]:
                    grown = size + int(total[stop - 1] - (total[at - 1] if at else 0))
                    if grown >= SHARD:
                        shard.append(many.slice(at, stop - at))
                        yield from sort(shard)
                        shard, size, at = [], 0, stop
                if at < many.num_rows:
                    shard.append(many.slice(at))
                    size += int(total[-1] - (total[at - 1] if at else 0))
    if shard:
        yield from sort(shard)


def repeated_runs(docs: DataFrame, crowd: int = CROWD) -> DataFrame:
    """(row, lo, hi): runs [lo, hi) of starts of strings that also start earlier; may touch or repeat."""
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = materialise(compared_anchors(docs, parts), "anchors")
    start, n = F.shiftright("place", 23), F.shiftright("place", 1).bitwiseAND(F.lit((1 << 22) - 1))
    equal = found.where(F.col("kind") == _EQUAL).select("row", start.alias("lo"), (start + n).alias("hi"))
    other = found.where(F.col("kind") == _KNOWN).select("hash", "row", "place")
    size = F.sum(n + (LENGTH - 1))
    crowded = other.groupBy("hash").agg(size.alias("size")).where(F.col("size") > crowd).select("hash", F.lit(True).alias("crowded"))
    crowded = broadcast_if_small(crowded)  # few, as each has over a megabyte; by size checked all the same
    runs = other.join(crowded, "hash", "left").groupBy("row").agg(
        F.collect_list(F.struct("hash", "place", F.coalesce("crowded", F.lit(False)).alias("crowded"))).alias("runs"))
    pieces = docs.join(runs, "row").select("doc", "row", "text", "runs").mapInArrow(_piece_batches, _PIECE_DDL)
    compared = pieces.repartition(parts, "key").sortWithinPartitions("key").mapInArrow(_shard_batches, "row long, lo long, hi long")
    return equal.union(compared)


# results ----------------------------------------------------------------------------------------------


def _merged(runs: Iterable[dict], length: int) -> list[tuple[int, int]]:
    """Byte spans covered by the strings that start in the runs."""
    spans: list[tuple[int, int]] = []
    for lo, hi in sorted((r["lo"], r["hi"] - 1 + length) for r in runs):
        if spans and lo <= spans[-1][1]:
            spans[-1] = (spans[-1][0], max(spans[-1][1], hi))
        else:
            spans.append((lo, hi))
    return spans


_CUT = pa.schema([("row", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("sha", pa.string()), ("kept", pa.binary())])


def _cut(with_bytes: bool):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            removed, many, sha, kept = [], [], [], []
            for text, runs in zip(utf8_texts(b), b.column("runs").to_pylist()):
                spans = _merged(runs, LENGTH)
                ends = [0, *(hi for _, hi in spans)]
                rest = b"".join([*(text[a:lo] for a, (lo, _) in zip(ends, spans)), text[ends[-1] :]])
                removed.append(len(text) - len(rest))
                many.append(len(spans))
                sha.append(hashlib.sha256(rest).hexdigest())
                kept.append(rest if with_bytes else None)
            yield pa.RecordBatch.from_arrays([
                b.column("row"), pa.array(removed, pa.int64()), pa.array(many, pa.int64()), pa.array(sha, pa.string()),
                pa.array(kept, pa.binary())], schema=_CUT)

    return run


def suffix_dedup(docs: DataFrame, crowd: int = CROWD, with_bytes: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every row of ``docs``.

    Texts count as UTF-8 bytes; a null one is empty. Every byte goes that is covered by a
    string of 100 bytes which also starts earlier: in a document with a smaller id, or
    earlier in the same one. Overlapping occurrences count. Rows without id come last;
    among them, and among rows that repeat an id, the order is that of reading. With
    ``with_bytes``, ``kept`` has the remaining bytes (null if nothing went).

    The rows are stored once under numbers of their own, so that every step means the same row
    however the input is split when it runs.
    """
    rows = materialise(id_text(docs).select(
        F.coalesce("doc_id", F.lit(_NO_ID)).alias("doc"), F.monotonically_increasing_id().alias("row"), "text"), "numbered")
    runs = repeated_runs(rows, crowd).groupBy("row").agg(F.collect_list(F.struct("lo", "hi")).alias("runs"))
    # the same columns as for the pieces, so that the texts are exchanged once
    cut = rows.join(runs, "row").select("doc", "row", "text", "runs").mapInArrow(
        _cut(with_bytes), "row long, n_removed long, n_spans long, sha string, kept binary")
    whole = rows.select("row", F.when(F.col("doc") != _NO_ID, F.col("doc")).alias("doc_id"), F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("own"))
    out = whole.join(cut, "row", "left").select(
        "doc_id", "n_bytes", F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"),
        F.coalesce("n_spans", F.lit(0).cast("long")).alias("n_spans"), F.coalesce("sha", "own").alias("kept_sha256"), "kept")
    return out if with_bytes else out.drop("kept")
