import hashlib
import random

import numpy as np
import pytest

from cases import awkward_rows, frame, plain, stored, words
from tremora.llm import suffix_dedup as sd
from tremora.llm.suffix import common_prefixes, suffix_array


def brute(rows):
    first, out = set(), []
    for d, t in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        b = (t or "").encode()
        gone = bytearray(len(b))
        for s in range(len(b) - 99):
            w = b[s : s + 100]
            if w in first:
                gone[s : s + 100] = b"\x01" * 100
            first.add(w)
        spans = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((d, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def case():
    rng = random.Random(1)
    passages = [words(rng, rng.randint(30, 80)) for _ in range(6)]
    rows = [r for r in awkward_rows(3, 40) if r[0] is not None]
    for i in range(80):
        t = words(rng, rng.randint(0, 60))
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(passages)
            a = rng.randint(0, len(p) // 2)
            t += " " + p[a : a + rng.randint(50, 400)] + " " + words(rng, rng.randint(0, 20))
        rows.append((500 + i, t))
    rows += [(800, "a" * 101), (801, "b" * 99), (802, "ab" * 300), (803, "xyz " * 1000), (804, "a" * 100), (None, "a" * 250)]
    rows += [(805, "ab" * 40 + "c" * 30 + "ab" * 60 + "q" + "ab" * 60)]
    # a row that repeats an id is a later document; equal ones give equal digests in either order
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("crowd, shard", [(sd.CROWD, sd.SHARD), (500, 300), (1, sd.SHARD)])
def test_matches_brute_force(spark, tmp_path, monkeypatch, crowd, shard):
    monkeypatch.setattr(sd, "SHARD", shard)
    rows = case()
    df = stored(frame(spark, rows, ("row", "runs", "own")), tmp_path)
    assert plain(sd.suffix_dedup(df, crowd)) == brute(rows)


def test_bytes_left(spark, tmp_path):
    text = words(random.Random(0), 60)
    df = stored(frame(spark, [(1, text), (2, "head " + text + " tail")]), tmp_path)
    kept = {r.doc_id: r.kept for r in sd.suffix_dedup(df, with_bytes=True).collect()}
    assert kept[1] is None and bytes(kept[2]) == b"head  tail"


def test_empty_table(spark, tmp_path):
    assert plain(sd.suffix_dedup(stored(frame(spark, []), tmp_path))) == []


def test_blocks_of_a_long_text(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sd, "_BLOCK", 333)
    rows = [(1, words(random.Random(5), 900)), (2, "ab" * 1500)]
    rows += [(3, rows[0][1][500:2500])]
    assert plain(sd.suffix_dedup(stored(frame(spark, rows), tmp_path))) == brute(rows)


@pytest.mark.parametrize("symbols", [1, 2, 4, 300])
def test_suffix_array(symbols):
    rng = np.random.default_rng(symbols)
    for n in [*range(1, 40), 400]:
        s = np.append(rng.integers(1, 1 + symbols, n), 0).astype(np.int32)
        want = sorted(range(len(s)), key=lambda i: s[i:].tolist())
        sa = suffix_array(s)
        assert sa.tolist() == want
        got = common_prefixes(s, sa, 100)
        for k in range(1, len(s)):
            a, b = s[sa[k] :].tolist(), s[sa[k - 1] :].tolist()
            lcp = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
            assert min(lcp, 100) == min(got[k], 100)


def rearranged(rows, swaps):
    """Rows of 64 bytes, neighbours swapped where a binary pattern says so."""
    out = list(rows)
    for i in range(0, len(out) - 1, 2):
        if bin(i // 2).count("1") % 2 ^ swaps:
            out[i], out[i + 1] = out[i + 1], out[i]
    return b"".join(out)


def test_equal_sums_are_not_equal_bytes(spark, tmp_path):
    """Two texts whose polynomial sums modulo 2^64 agree, without a common string of 100 bytes."""
    rng = random.Random(9)
    rows = [bytes(rng.choice(b"abcdefgh") for _ in range(64)) for _ in range(127)]
    texts = [(1, rearranged(rows, 0).decode()), (2, rearranged(rows, 1).decode())]
    common = [r for r in brute(texts)]
    assert plain(sd.suffix_dedup(stored(frame(spark, texts), tmp_path))) == common


def test_other_splits_between_the_steps(spark, tmp_path):
    rows = case()
    before = spark.conf.get("spark.sql.leafNodeDefaultParallelism", None)
    try:
        spark.conf.set("spark.sql.leafNodeDefaultParallelism", "2")
        df = stored(frame(spark, rows), tmp_path, 6)
        result = sd.suffix_dedup(df)
        spark.conf.set("spark.sql.leafNodeDefaultParallelism", "40")
        spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
        assert plain(result) == brute(rows)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.leafNodeDefaultParallelism") if before is None else spark.conf.set("spark.sql.leafNodeDefaultParallelism", before)


def test_suffix_array_of_many_names():
    rng = np.random.default_rng(1)
    words = [rng.integers(1, 200, 7) for _ in range(3000)]
    s = np.concatenate([words[i] for i in rng.integers(0, 3000, 9000)] + [[0]]).astype(np.int32)
    sa = suffix_array(s)
    assert sorted(sa.tolist()) == list(range(len(s)))
    text = b"".join(int(x).to_bytes(2, "big") for x in s)
    for a, b in zip(sa[:-1:7].tolist(), sa[1::7].tolist()):
        assert text[2 * a : 2 * a + 4000] < text[2 * b : 2 * b + 4000]
