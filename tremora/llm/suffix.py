"""Suffix arrays by induced sorting, and permuted common prefixes, on numpy arrays.

The induction scans of the method visit one suffix after the other. Here they visit
bucket after bucket (a bucket holds the suffixes that begin with one symbol): all
suffixes of a bucket that are known induce their predecessors at once, and those that
land in the same bucket form the next round. Runs of one symbol bound the rounds.
"""

from __future__ import annotations

import numpy as np

_CHAIN = 256
SYMBOLS = 1 << 10  # alphabets up to this size are induced bucket by bucket


def _types(s: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the next one; the last suffix counts as smaller."""
    change = np.flatnonzero(s[1:] != s[:-1])
    small = np.ones(len(s), bool)
    if len(change):
        rising = s[change] < s[change + 1]
        small[: change[-1] + 1] = np.repeat(rising, np.diff(change, prepend=-1))
    return small


def _place(sa: np.ndarray, at: np.ndarray, symbols: np.ndarray, suffixes: np.ndarray, down: bool) -> None:
    """Append suffixes to the buckets of their first symbols, upwards from or downwards to ``at``."""
    order = np.argsort(symbols.astype(np.uint16), kind="stable")
    symbols = symbols[order]
    n = np.bincount(symbols, minlength=len(at))
    rank = np.arange(len(symbols)) - (np.cumsum(n) - n)[symbols]
    if down:
        sa[at[symbols] - rank] = suffixes[order]
        at -= n
    else:
        sa[at[symbols] + rank] = suffixes[order]
        at += n


def _induce(s: np.ndarray, small: np.ndarray, sizes: np.ndarray, lms: np.ndarray) -> np.ndarray:
    """Suffix array from leftmost-smaller suffixes in sorted order."""
    ends = np.cumsum(sizes)
    starts = ends - sizes
    sa = np.full(len(s), -1, np.int32)
    tails = ends - 1
    _place(sa, tails.copy(), s[lms[::-1]], lms[::-1], True)
    heads = starts.copy()
    large = ~small
    used = np.flatnonzero(sizes)

    def larger(batch: np.ndarray) -> None:
        j = batch[batch > 0] - 1
        j = j[large[j]]
        if len(j):
            _place(sa, heads, s[j], j, False)

    many_small = np.bincount(s[small], minlength=len(sizes))
    for c in used:  # suffixes larger than the next, smallest first
        done = starts[c]
        while done < heads[c]:
            batch = sa[done : heads[c]]
            done = heads[c]
            larger(batch)
        if many_small[c]:
            batch = sa[ends[c] - many_small[c] : ends[c]]
            larger(batch[batch >= 0])
    at = ends - 1

    def smaller(batch: np.ndarray) -> None:
        j = batch[batch > 0] - 1
        j = j[small[j]]
        if len(j):
            _place(sa, at, s[j], j, True)

    first = s[-1]
    sa[at[first]] = len(s) - 1  # the end mark
    at[first] -= 1
    for c in used[::-1]:  # the others, largest first
        done = ends[c] - 1
        while done > at[c]:
            batch = sa[at[c] + 1 : done + 1][::-1].copy()
            done = at[c]
            smaller(batch)
        batch = sa[starts[c] : heads[c]][::-1]
        smaller(batch)
    return sa


def _by_doubling(s: np.ndarray) -> np.ndarray:
    """Suffix array by doubling ranks; only suffixes that are still tied are sorted again.

    A rank is the place of the first suffix of a tie. Rounds grow with the logarithm of
    the longest repeat.
    """
    n = len(s)
    sizes = np.bincount(s)
    rank = (np.cumsum(sizes) - sizes)[s].astype(np.int64)
    tied = np.flatnonzero(sizes[s] > 1)
    step = 1
    while len(tied):
        far = tied + step  # the last symbol is unique, so a tied suffix reaches that far
        key = rank[tied] * (n + 1) + np.where(far < n, rank[np.minimum(far, n - 1)] + 1, 0)
        order = np.argsort(key)
        tied, key = tied[order], key[order]
        old = rank[tied]
        i = np.arange(len(tied))
        fresh = np.concatenate([[True], key[1:] != key[:-1]])
        group = np.concatenate([[True], old[1:] != old[:-1]])
        at = np.maximum.accumulate(np.where(fresh, i, 0))
        rank[tied] = old + at - np.maximum.accumulate(np.where(group, i, 0))
        alone = fresh & np.concatenate([fresh[1:], [True]])
        tied = tied[~alone]
        step *= 2
    sa = np.empty(n, np.int32)
    sa[rank] = np.arange(n)
    return sa


def suffix_array(s: np.ndarray) -> np.ndarray:
    """Suffix array of symbols that end in a smallest one found nowhere else."""
    if len(s) == 1:
        return np.zeros(1, np.int32)
    if int(s.max()) >= SYMBOLS:  # only strings of names, which are as short as their substrings are long
        return _by_doubling(s)
    small = _types(s)
    sizes = np.bincount(s)
    lms = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    # sort the leftmost-smaller substrings by inducing from their order of appearance
    roughly = _induce(s, small, sizes, lms[np.argsort(s[lms].astype(np.uint16), kind="stable")])
    is_lms = np.zeros(len(s), bool)
    is_lms[lms] = True
    ordered = roughly[is_lms[roughly]]
    # name them: equal neighbours share a name
    place = np.empty(len(s), np.int32)
    place[lms] = np.arange(len(lms))
    length = np.diff(np.append(lms, len(s) - 1)) + 1
    own = length[place[ordered]]
    same = own[1:] == own[:-1]
    live = np.flatnonzero(same)
    for d in range(int(own.max())):
        live = live[own[live] > d]
        if not len(live):
            break
        a, b = ordered[live] + d, ordered[live + 1] + d
        equal = (s[a] == s[b]) & (small[a] == small[b])
        same[live[~equal]] = False
        live = live[equal]
    names = np.empty(len(lms), np.int32)
    names[place[ordered]] = np.concatenate([[0], np.cumsum(~same)])
    if names.max() + 1 < len(lms):
        ordered = lms[suffix_array(names)]
    return _induce(s, small, sizes, ordered)


def common_prefixes(s: np.ndarray, sa: np.ndarray, most: int) -> np.ndarray:
    """Longest common prefix of each suffix in ``sa`` with the one before, exact up to ``most``.

    Computed in text order: a suffix preceded by the same symbol as its neighbour has the
    common prefix of the suffix before it less one, so only the others are compared.
    """
    n = len(s)
    before = np.empty(n, np.int64)
    before[sa[1:]] = sa[:-1]
    before[sa[0]] = -1
    i = np.arange(n)
    known = np.zeros(n, bool)
    known[1:] = (before[1:] > 0) & (before[:-1] >= 0) & (s[before[1:] - 1] == s[:-1]) & (before[:-1] == before[1:] - 1)
    chain = i - np.maximum.accumulate(np.where(known, 0, i))
    known &= chain % _CHAIN != 0  # a new comparison now and then, as each stops soon after ``most``
    own = np.flatnonzero(~known & (before >= 0))
    wide = np.zeros(n + 16, np.uint16)
    wide[:n] = s + 1
    wide[n:] = np.arange(16)
    four = np.ndarray((n + 12,), "<u8", wide, strides=(2,))  # four symbols from each place on
    length = np.zeros(n, np.int64)
    live, d = own, 0
    most += _CHAIN  # those derived lose one a step
    while len(live) and d < most:
        a, b = live + d, before[live] + d
        inside = (a < n) & (b < n)
        x = four[np.minimum(a, n)] ^ four[np.minimum(b, n)]
        equal = inside & (x == 0)
        low = x[~equal]
        part = np.where(low & np.uint64(0xFFFF), 0, np.where(low & np.uint64(0xFFFF0000), 1, np.where(low & np.uint64(0xFFFF00000000), 2, 3)))
        length[live[~equal]] = d + part
        live = live[equal]
        d += 4
    length[live] = d
    start = np.maximum.accumulate(np.where(known, 0, i))
    length = np.maximum(length[start] - (i - start), 0)
    return length[sa]
