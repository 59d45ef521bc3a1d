import hashlib
import random
import re

import pytest

from cases import awkward_rows, frame, plain, words
from tremora.llm import decontaminate as dc


def tokens(text):
    low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(rows, items):
    windows = []
    for i, t in items:
        w = tokens(t)
        if i is None or not w:
            continue
        n = min(13, len(w))
        windows += [(str(i), tuple(w[k : k + n])) for k in range(len(w) - n + 1)]
    out = []
    for d, t in rows:
        w = tokens(t)
        hit, ids = set(), set()
        for i, g in windows:
            for k in range(len(w) - len(g) + 1):
                if tuple(w[k : k + len(g)]) == g:
                    hit.update(range(k, k + len(g)))
                    ids.add(i)
        digest = hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()
        out.append((d, len(w), len(hit), len(ids), digest, bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=repr)


def case(seed=2):
    rng = random.Random(seed)
    items = [(i, words(rng, rng.randint(14, 40), "abcd")) for i in range(12)]
    items += [(100, "Short item HERE"), (101, "one"), (102, None), (103, "!!"), (104, items[0][1]), (None, "no id at all"), (9, items[1][1])]
    items += [(105, " ".join(items[2][1].split()[3:20])), (106, "a b a b a b a b a b a b a b a b")]
    rows = [r for r in awkward_rows(seed, 25) if len(r[1] or "") < 9000]
    for i in range(60):
        src = rng.choice(items)[1] or ""
        w = src.split()
        a = rng.randint(0, max(0, len(w) - 5))
        rows.append((500 + i, words(rng, rng.randint(0, 50), "abcd") + "; " + ", ".join(w[a:]).upper() + " - " + words(rng, rng.randint(0, 300), "abcd")))
    rows += [(700, "short ITEM here"), (701, "x short item"), (702, "a b " * 30)]
    return rows, items


@pytest.mark.parametrize("shard_words", [dc.SHARD_WORDS, 60])
def test_matches_brute_force(spark, shard_words):
    rows, items = case()
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = plain(dc.decontaminate(frame(spark, rows, ("row", "items", "starts")), benchmark, shard_words=shard_words))
    want = brute(rows, items)
    assert got == want
    assert any(g[5] for g in got) and any(g[2] and not g[5] for g in got)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    rows = [(1, "a b"), (2, None)]
    assert plain(dc.decontaminate(frame(spark, rows), none)) == brute(rows, [])
    assert plain(dc.decontaminate(frame(spark, []), none)) == []


def test_spans_are_cut_out(spark):
    item = "w1 w2 w3 w4 w5 w6 w7 w8 w9 w10 w11 w12 w13"
    rest = " ".join(f"own{i}" for i in range(400))
    docs = frame(spark, [(1, rest + " " + item + ", end"), (2, "x " + item), (3, rest), (4, None)])
    benchmark = spark.createDataFrame([(1, item)], "item_id long, text string")
    assert plain(dc.decontaminated_texts(docs, benchmark)) == [(1, rest + " , end"), (3, rest), (4, "")]


def test_automaton_finds_the_longest_match():
    rng = random.Random(0)
    for _ in range(50):
        auto, seqs = dc.Automaton(), [[rng.randrange(3) for _ in range(rng.randint(1, 12))] for _ in range(4)]
        for s in seqs:
            last = 0
            for w in s:
                last = auto.extend(last, w)
        subs = {tuple(s[i:j]) for s in seqs for i in range(len(s)) for j in range(i + 1, len(s) + 1)}
        text = [rng.randrange(3) for _ in range(40)]
        for i, (_, length) in enumerate(auto.walk(text), 1):
            assert length == max((n for n in range(1, i + 1) if tuple(text[i - n : i]) in subs), default=0)
