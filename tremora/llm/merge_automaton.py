"""Byte-pair merges compiled into a deterministic automaton over tokens.

The automaton starts as one state that every base symbol leads back to, so it accepts all
strings of base symbols. A merge (a, b) -> c is a gadget applied to it: wherever a path reads
a and then b, an arc c goes from the path's first state to its last one; the state behind a is
replaced, for arcs that read a, by a copy without the arc b. After all merges, in order, the
automaton accepts exactly the token sequences that the merges make of some string, one for
each string.

The state after a token depends on that token only. So the automaton is a table of states by
arc classes: ``state[t]`` is where an arc t leads, ``arc[t]`` the column that tells which
states have it. States and columns are copied only when a gadget tells them apart, hence
there are about as many as there are different left and right parts of merges.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np

from tremora.llm.tokens import byte_letters

WIDE = 48  # bytes of a word that is encoded beside others of its kind
_SIDE = 8192  # words encoded side by side
_LONG = 1 << 16  # places of a long word that are looked at together


def compile_merges(n_symbols: int, merges: Sequence[tuple[int, int, int]], n_tokens: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(state, arc, table) after the gadgets of all merges (left, right, made), in order.

    Bit ``c`` of ``table[s]`` says whether state s has the arcs of class c. State 0 is the
    start: nothing is behind it, so no gadget takes an arc from it.
    """
    state, arc = np.zeros(n_tokens + 1, np.int32), np.zeros(n_tokens, np.int32)
    state[:n_symbols] = 1
    rows, columns = 2, 1  # the start, and the state behind every base symbol
    in_row, in_column = np.zeros(n_tokens + 2, np.int64), np.zeros(n_tokens + 1, np.int64)
    in_row[1], in_column[0] = n_symbols, n_symbols
    table = np.full((1024, 16), ~np.uint64(0))
    one = np.uint64(1)
    for a, b, c in merges:
        behind = state[b]  # of the path a b, before a copy takes the arc b from it
        old = state[a]
        if in_row[old] > 1 or a == b:
            if rows == len(table):
                table = np.concatenate([table, np.full_like(table, ~np.uint64(0))])
            table[rows] = table[old]
            in_row[old] -= 1
            state[a], in_row[rows], rows = rows, 1, rows + 1
        old = arc[b]
        if in_column[old] > 1:
            if columns == 64 * table.shape[1]:
                table = np.concatenate([table, np.full_like(table, ~np.uint64(0))], axis=1)
            without = ~(table[:rows, old >> 6] >> np.uint64(old & 63)) & one
            table[:rows, columns >> 6] &= ~(without << np.uint64(columns & 63))
            in_column[old] -= 1
            arc[b], in_column[columns], columns = columns, 1, columns + 1
        table[state[a], arc[b] >> 6] &= ~(one << np.uint64(arc[b] & 63))
        state[c], arc[c] = behind, arc[a]
        in_row[behind] += 1
        in_column[arc[c]] += 1
    return state, arc, table[:rows]


@dataclass
class Automaton:
    """Arc table, spelling trie and labels; some 20 MB for a vocabulary of 50 000."""

    state: np.ndarray  # of the arc t; the last entry is the start
    arc: np.ndarray
    table: np.ndarray
    spelling: list[bytes]
    closes: np.ndarray  # whether a token ends a word
    labels: list[str]

    @classmethod
    def compile(cls, vocab: dict[str, int], merges: Sequence[Sequence[str]], end: str) -> Automaton:
        """``end`` marks the tokens that end a word; without it any token may."""
        made = {a + b for a, b in merges}
        labels = sorted(vocab, key=vocab.get)
        if sorted(vocab.values()) != list(range(len(vocab))):
            raise ValueError("ids have gaps")
        order = [t for t in labels if t not in made] + [a + b for a, b in merges]  # as the gadgets make them
        rank = {t: i for i, t in enumerate(order)}
        if any(rank[a] >= rank[a + b] or rank[b] >= rank[a + b] for a, b in merges):
            raise ValueError("a merge stands before one that makes its parts")
        steps = [(rank[a], rank[b], rank[a + b]) for a, b in merges]
        state, arc, table = compile_merges(len(order) - len(merges), steps, len(order))
        place = np.array([rank[t] for t in labels])
        byte = {letter: b for b, letter in enumerate(byte_letters())}
        closes = np.array([bool(end) and t.endswith(end) and t != end for t in labels])
        spelling = [bytes(byte[x] for x in (t.removesuffix(end) if c else t)) for t, c in zip(labels, closes.tolist())]
        return cls(np.append(state[:-1][place], state[-1]), arc[place], table, spelling, closes if end else ~closes, labels)

    @classmethod
    def of_file(cls, path: str) -> Automaton:
        """From the model of a tokenizer file with byte-level letters."""
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        return cls.compile(model["vocab"], merges, model["end_of_word_suffix"] or "")

    def __post_init__(self) -> None:
        nodes: list[dict[int, int]] = [{}]
        inner, last = [-1], [-1]
        for i, (word, closes) in enumerate(zip(self.spelling, self.closes.tolist())):
            at = 0
            for b in word:
                step = nodes[at].get(b)
                if step is None:
                    step = nodes[at][b] = len(nodes)
                    nodes.append({})
                    inner.append(-1)
                    last.append(-1)
                at = step
            if closes:
                last[at] = i
            if not closes or self.closes.all():
                inner[at] = i
        # nodes with steps come first, so that only they need a row; 0 is no node, 1 the root
        order = sorted(range(len(nodes)), key=lambda k: (not nodes[k], k))
        self.branching = sum(map(bool, nodes)) + 1
        name = np.empty(len(nodes), np.int32)
        name[order] = np.arange(1, len(nodes) + 1)
        self.trie = np.zeros((self.branching + 1, 256), np.int32)  # the last row is that of all leaves
        for k, steps in enumerate(nodes):
            if steps:
                self.trie[name[k], list(steps)] = name[list(steps.values())]
        self.inner = np.array([-1, *(inner[k] for k in order)], np.int32)
        self.last = np.array([-1, *(last[k] for k in order)], np.int32)
        self.deepest = max(map(len, self.spelling), default=0)
        self.bits, self.columns = self.table.view(np.uint8).reshape(-1), 64 * self.table.shape[1]

    def __reduce__(self) -> tuple:
        return Automaton, (self.state, self.arc, self.table, self.spelling, self.closes, self.labels)

    def _step(self, node: np.ndarray, byte: np.ndarray) -> np.ndarray:
        return self.trie[np.minimum(node, self.branching), byte]

    def _has(self, state: np.ndarray, token: np.ndarray) -> np.ndarray:
        at = state.astype(np.int64) * self.columns + self.arc[token]
        return (self.bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1

    def encode(self, words: Sequence[bytes]) -> list[bytes]:
        """Ids of each word as little-endian unsigned 32-bit integers; an empty word has none."""
        out = [b""] * len(words)
        order = sorted((i for i, w in enumerate(words) if 0 < len(w) <= WIDE), key=lambda i: -len(words[i]))
        for at in range(0, len(order), _SIDE):
            some = order[at : at + _SIDE]
            for i, ids in zip(some, self._side_by_side([words[i] for i in some])):
                out[i] = ids
        for i, w in enumerate(words):
            if len(w) > WIDE:
                out[i] = self._alone(w)
        return out

    def _side_by_side(self, words: list[bytes]) -> list[bytes]:
        """Words in descending length. Each place of a word is reached by one path, whose last arc is kept."""
        n = np.fromiter(map(len, words), np.int64, len(words))
        widest = int(n[0])
        data = np.frombuffer(b"".join(w.ljust(widest, b"\0") for w in words), np.uint8).reshape(len(words), widest)
        token = np.full((len(words), widest + 1), -1, np.int32)  # -1 is the start's place in ``state``
        source = np.zeros((len(words), widest + 1), np.int16)
        end, end_source = np.full(len(words), -1, np.int32), np.zeros(len(words), np.int16)
        for i in range(widest):
            rows = np.arange(int(np.searchsorted(-n, -i)))  # those longer than i
            state, node = self.state[token[rows, i]], np.ones(len(rows), np.int64)
            for j in range(i, min(widest, i + self.deepest)):
                if len(rows) and n[rows[-1]] <= j:
                    few = int(np.searchsorted(-n[rows], -j))
                    rows, state, node = rows[:few], state[:few], node[:few]
                node = self._step(node, data[rows, j])
                alive = node != 0
                if not alive.all():
                    rows, state, node = rows[alive], state[alive], node[alive]
                if not len(rows):
                    break
                for ids, ends in ((self.inner[node], False), (self.last[node], True)):
                    some = np.flatnonzero((ids >= 0) & (n[rows] == j + 1) if ends else ids >= 0)
                    some = some[self._has(state[some], ids[some])]
                    if ends:
                        end[rows[some]], end_source[rows[some]] = ids[some], i
                    else:
                        token[rows[some], j + 1], source[rows[some], j + 1] = ids[some], i
        back, at, live = [end], end_source.astype(np.int64), np.arange(len(words))
        while len(live := live[at[live] > 0]):
            step = np.full(len(words), -1, np.int32)
            step[live] = token[live, at[live]]
            at[live] = source[live, at[live]]
            back.append(step)
        paths = np.array(back[::-1]).T
        many = np.cumsum((paths >= 0).sum(axis=1)) * 4
        flat = paths[paths >= 0].astype("<u4").tobytes()
        return [flat[a:b] for a, b in zip([0, *many.tolist()], many.tolist())]

    def _alone(self, word: bytes) -> bytes:
        """A long word: arcs that its bytes spell are found for many places at once, then followed in order."""
        data, size = np.frombuffer(word, np.uint8), len(word)
        token, source = np.full(size + 1, -1, np.int32), np.zeros(size + 1, np.int64)
        end, end_source = -1, 0
        for first in range(0, size, _LONG):
            places = np.arange(first, min(size, first + _LONG))
            node, found = np.ones(len(places), np.int64), []
            for length in range(1, self.deepest + 1):
                fits = places + length <= size
                places, node = places[fits], node[fits]
                node = self._step(node, data[places + length - 1])
                places, node = places[node != 0], node[node != 0]
                ids = self.inner[node]
                found.append(np.stack([places[ids >= 0], np.full((ids >= 0).sum(), length), ids[ids >= 0]]))
                closing = (self.last[node] >= 0) & (places + length == size)
                found.append(np.stack([places[closing], np.full(closing.sum(), -length), self.last[node[closing]]]))
            place, length, ids = np.concatenate(found, axis=1)
            order = np.argsort(place, kind="stable")
            bits, columns, state, arc = self.bits, self.columns, self.state, self.arc[ids].tolist()
            place, length, ids = place.tolist(), length.tolist(), ids.tolist()
            for k in order.tolist():
                i, step = place[k], length[k]
                at = int(state[token[i]]) * columns + arc[k]
                if bits[at >> 3] >> (at & 7) & 1:
                    if step < 0:
                        end, end_source = ids[k], i
                    else:
                        token[i + step], source[i + step] = ids[k], i
        out, at = [end], end_source
        while at:
            out.append(int(token[at]))
            at = int(source[at])
        return np.array(out[::-1], "<u4").tobytes()
