import hashlib
import random
import re
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from cases import plain
from tremora.llm import prefix_trie as pt

DDL = "conv_id long, turn long, role string, text string"


def brute(rows):
    """rows (conv_id, turn, role, text) whose turns have no ties but between equal rows."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in own.items()}
    whole = {}
    for c, ts in own.items():
        h, base = zlib.crc32(str(c).encode()) % 4, c - (c % 20 if c >= 0 else -(-c % 20))
        whole[c] = own.get(base, [])[:h] + ts[h:]
    members = defaultdict(list)
    for c in sorted(whole):
        for d in range(len(whole[c]) + 1):
            members[tuple(whole[c][:d])].append(c)
    children, sums = defaultdict(list), {}
    for p in members:
        if p:
            children[p[:-1]].append(p)
    for p in sorted(members, key=len, reverse=True):
        leaves = 0 if children[p] else 1
        saved = (len(members[p]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        sums[p] = (leaves + sum(sums[q][0] for q in children[p]), saved + sum(sums[q][1] for q in children[p]))
    out = []
    for p, m in members.items():
        ends = ",".join(str(c) for c in m if len(whole[c]) == len(p))
        out.append((m[0], len(p), members[p[:-1]][0] if p else None, len(m), len(children[p]), *sums[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def talks(seed, n=60, longest=9):
    rng = random.Random(seed)
    lines = [f"line {'x ' * rng.randint(0, 5)}{k}" for k in range(3)]
    rows = []
    for c in range(n):
        for turn in range(rng.randint(1, longest)):
            rows.append((c, turn, rng.choice(["user", "assistant"]) if turn > 1 else "user", rng.choice(lines)))
    rows += [(300, None, None, None), (300, 1, "user", None), (300, 2, None, " a\tb\x0bc d\x85e f "), (None, 1, "user", "no id"), (None, None, None, None)]
    rows += [(301, 0, "user", lines[0])] * 3 + [(-45, 0, "user", lines[0]), (-45, 1, "user", lines[1]), (-40, 0, "user", lines[2])]
    rows += [(302, 0, "user", "é" * 3000 + " 日本"), (303, 0, "user", "")]
    rows += [(320 + c, turn, "user", lines[turn % 3]) for c in range(20) for turn in range(6)]  # one very common conversation
    rng.shuffle(rows)
    return rows


def columns(df):
    return df.select(*pt._ROLLED, "ends_sha256")


@pytest.mark.parametrize("bound, block, text", [(50_000, 256, 1 << 20), (40, 4, 5), (6, 2, 1 << 20)])
def test_against_brute_force(spark, monkeypatch, bound, block, text):
    for name, value in (("BOUND", bound), ("BLOCK", block), ("_TEXT", text)):
        monkeypatch.setattr(pt, name, value)
    rows = talks(bound)
    df = spark.createDataFrame(rows, DDL).withColumns({"n1": F.lit(5), "depth": F.lit("x")}).repartition(3)
    assert plain(columns(pt.prefix_trie(df))) == brute(rows)


def test_one_long_conversation(spark, monkeypatch):
    monkeypatch.setattr(pt, "BOUND", 30)
    monkeypatch.setattr(pt, "BLOCK", 8)
    rows = [(7, t, "user", f"w{t % 5} x") for t in range(150)] + [(8, t, "user", f"w{t % 5} x" + "!" * (t == 70)) for t in range(150)]
    rows += [(9, 1, "user", "w1 x")]
    assert plain(columns(pt.prefix_trie(spark.createDataFrame(rows, DDL).repartition(4)))) == brute(rows)


def test_turnless_conversations_and_empty_table(spark):
    c = next(c for c in range(1, 400) if c % 20 and zlib.crc32(str(c).encode()) % 4 > 0)
    rows = [(c, 0, "user", "gone with the turns that are lent")]
    assert plain(columns(pt.prefix_trie(spark.createDataFrame(rows, DDL)))) == brute(rows) == [
        (c, 0, None, 1, 0, 1, 0, hashlib.sha256(str(c).encode()).hexdigest())]
    assert plain(pt.prefix_trie(spark.createDataFrame([], DDL))) == []
    assert plain(pt.prefix_trie(spark.createDataFrame([(None, 1, "user", "x")], DDL))) == []


def test_sql_equals_brute_force(spark):
    rows = [r for r in talks(5, 25) if r[0] is None or r[0] >= 0]
    con = duckdb.connect()
    frame = spark.createDataFrame(rows, DDL).toPandas().astype({"conv_id": "Int64", "turn": "Int64"})
    con.register("conversations", frame)
    names = ", ".join([*pt._ROLLED, "ends_sha256"])
    assert sorted(con.sql(f"SELECT {names} FROM ({pt.ORACLE})").fetchall(), key=repr) == brute(rows)


@pytest.mark.parametrize("seed", range(8))
def test_centroid_sums(seed):
    rng = np.random.default_rng(seed)
    n = int(rng.integers(1, 300))
    parent = np.array([-1 if i == 0 or rng.random() < 0.03 else int(rng.integers(max(0, i - (3 if seed % 2 else i)), i)) for i in range(n)])
    component = np.zeros(n, np.int64)
    for i in range(n):
        component[i] = i if parent[i] < 0 else component[parent[i]]
    values = rng.integers(0, 100, (n, 2))
    want = values.copy()
    for i in range(n - 1, -1, -1):
        if parent[i] >= 0:
            want[parent[i]] += want[i]
    assert (pt.centroid_sums(parent, component, values) == want).all()
