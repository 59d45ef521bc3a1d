import random
import re

import pytest
import xxhash

from cases import awkward_rows, frame, plain, words
from tremora.llm import simhash
from tremora.llm.components import components


def brute_fp(text):
    low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not w:
        return 0
    shingles = [" ".join(w[i : i + 4]) for i in range(max(1, len(w) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(rows):
    fps = [brute_fp(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 4:
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return sorted([(d, f"{fps[i]:016x}", least.get(find(i))) for i, (d, _) in enumerate(rows)], key=repr)


def near_rows(n=150, seed=4):
    rng = random.Random(seed)
    rows = awkward_rows(seed, 40)
    base = words(rng, 300).split()
    for i in range(n):
        w = list(base)
        for _ in range(rng.randint(0, 4)):
            w[rng.randrange(len(w))] = "new%d" % rng.randrange(10**6)
        rows.append((1000 + i, " ".join(w)))
    return rows


@pytest.mark.parametrize("crowd", [simhash.CROWD, 40, 2])
def test_matches_brute_force(spark, crowd):
    rows = near_rows()
    got = plain(simhash.simhash_components(frame(spark, rows, ("fp", "root", "component_id")), crowd))
    assert got == brute(rows)
    assert max(sum(1 for g in got if g[2] == c) for _, _, c in got) > 50  # the near copies do meet


def test_fingerprints_at_the_limit():
    base = 0x0123456789ABCDEF
    import numpy as np

    fps = np.array(sorted([base, base ^ 0b1111, base ^ (0b11111 << 40), base ^ 1 ^ (1 << 21) ^ (1 << 42) ^ (1 << 63)]), np.uint64)
    found = set()
    for seg, bit in simhash._BITS:
        key = simhash._keys(fps, seg, bit)
        order = np.argsort(key, kind="stable")
        u, v = simhash._linked(key[order], fps[order])
        found |= {frozenset((int(a), int(b))) for a, b in zip(u, v)}
    assert frozenset((base, base ^ 0b1111)) in found
    assert frozenset((base, base ^ 1 ^ (1 << 21) ^ (1 << 42) ^ (1 << 63))) in found
    assert not any(base ^ (0b11111 << 40) in f and base in f for f in found)


def test_empty_table(spark):
    assert plain(simhash.simhash_components(frame(spark, []))) == []


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 300)] + [(5, 5), (5000, 4000), (4000, 5000)]
    got = dict(plain(components(spark.createDataFrame(links, "u long, v long"))))
    assert got == {**{i: 0 for i in range(1, 201)}, **{1000 + i: 1000 for i in range(1, 300)}, 5000: 4000}
