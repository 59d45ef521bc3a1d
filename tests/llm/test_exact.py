import hashlib
import re

import pytest

from cases import awkward_rows, frame, plain
from tremora.llm.exact_dedup import exact_dedup


def brute(rows):
    groups = {}
    for d, t in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", t or ""), []).append((d, t or ""))
    out = []
    for norm, members in groups.items():
        keep = min(members, key=lambda m: (-len(m[1]), m[0] is None, m[0] or 0))[0] if any(d is not None for d, _ in members) else None
        longest = max(len(t) for _, t in members)
        ids = [d for d, t in members if len(t) == longest and d is not None]
        keep = min(ids) if ids else None
        for d, _ in members:
            out.append((d, keep, len(members), d == keep, hashlib.sha256(norm.encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("bits, width", [(6, 4), (3, 1), (5, 2)])
def test_matches_brute_force(spark, bits, width):
    rows = awkward_rows()
    got = plain(exact_dedup(frame(spark, rows, ("keep_id", "run", "best", "kept", "digest")), bits, width))
    assert got == brute(rows)


def test_a_group_of_thousands(spark):
    rows = [(i, "same text") for i in range(3000)] + [(5000 + i, f"own {i}") for i in range(50)] + [(4000, "same  text")]
    assert plain(exact_dedup(frame(spark, rows).repartition(7))) == brute(rows)


def test_empty_table(spark):
    assert plain(exact_dedup(frame(spark, []))) == []
