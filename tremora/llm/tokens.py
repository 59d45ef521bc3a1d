"""Token ids of whole texts with a public byte-level tokenizer."""

from __future__ import annotations

import json
import os
import re
import sys
import types
import unicodedata
from array import array
from collections.abc import Sequence

import numpy as np

BYTE_BPE = "byte_bpe_50k.json"
_WORDS = 700_000  # words a worker remembers
_WIDE = 24  # bytes of a word that is grouped with its like; longer ones are looked up one by one
#: white space outside ASCII; a text that has some, or a special token, is encoded in one piece
_RARE_SPACE = re.compile(rb"\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80")

_LONG = 1 << 22  # bytes of a text encoded at a time
_BETWEEN = re.compile(rb"[A-Za-z] (?=[A-Za-z])")

_SPACE, _LETTER, _MARK = np.zeros(256, bool), np.zeros(256, bool), np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 28, 29, 30, 31, 32]] = True
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_MARK[[10, *range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True
_LOW = np.array([(1 << 8 * i) - 1 for i in range(9)], np.uint64)


def tokenizer_path(name: str = BYTE_BPE) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def usual_signs() -> tuple[str, str, str]:
    """Letters, digits and other signs that every version of the Unicode tables treats alike, as regex classes.

    These are printable ASCII, the Latin letters up to U+024F but for the one whose lower case
    is two characters, and the common quotes and dashes. None of them composes with another.
    """
    chars = [chr(c) for c in [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x250), *range(0x2010, 0x2028), 0x20AC]]
    kinds = {"L": "", "N": "", "": ""}
    for c in chars:
        if len(c.lower()) == 1:
            kind = unicodedata.category(c)[0]
            kinds[kind if kind in "LN" else ""] += re.escape(c)
    return kinds["L"], kinds["N"], kinds[""]


def unusual_signs() -> re.Pattern:
    """Finds anything but usual signs and ASCII white space."""
    return re.compile("[^" + "".join(usual_signs()) + "\t\n\x0b\x0c\r ]")


# Fixed value: how byte-level vocabularies cut words.
_WORD = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def rank_encoder(path: str):
    """The vocabulary of a byte-level tokenizer file as an encoder by ranks, which is quicker; None where ids are not ranks.

    It gives the tokenizer's ids on text of usual signs; strings of special tokens are plain text to it.
    """
    import tiktoken

    with open(path, encoding="utf-8") as f:
        rules = json.load(f)
    model, cut = rules["model"], rules["pre_tokenizer"] or {}
    merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    first = len(model["vocab"]) - len(merges)
    if (rules["normalizer"] or model.get("end_of_word_suffix") or cut.get("type") != "ByteLevel" or not cut.get("use_regex") or cut.get("add_prefix_space")
            or any(model["vocab"].get(a + b) != first + i for i, (a, b) in enumerate(merges))):
        return None
    byte = {x: b for b, x in enumerate(byte_letters())}
    ranks = {bytes(byte[x] for x in token): i for token, i in model["vocab"].items()}
    return tiktoken.Encoding("ranks", pat_str=_WORD, mergeable_ranks=ranks, special_tokens={})


def byte_letters() -> list[str]:
    """The letter that byte-level vocabularies write for each byte: printable ones stand for themselves."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(256))
    return [chr(b) if b in printable else chr(256 + next(rest)) for b in range(256)]


def _starts(a: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Where words begin in ``a``: places at which the pre-tokenizer always cuts.

    That is before a lone space, around a lone line end, and before ASCII punctuation
    behind a letter (A-Z, a-z and the two-byte letters of U+00C0 to U+027F).
    """
    space = _SPACE[a]
    cut = np.zeros(len(a) + 1, bool)
    lone = ~space[:-2] & space[1:-1] & ~space[2:]
    lone &= (a[1:-1] == 32) | (a[1:-1] == 10)
    cut[1:-2] |= lone
    cut[2:-1] |= lone & (a[1:-1] == 10)
    letter = _LETTER[a]
    lead = (a >= 0xC3) & (a <= 0xC9)
    sign = (a[:-1] == 0xC3) & ((a[1:] == 0x97) | (a[1:] == 0xB7))
    letter[1:] |= lead[:-1] & (a[1:] >= 0x80) & ~sign
    cut[1:-1] |= letter[:-1] & _MARK[a[1:]]
    cut[edges] = True
    return np.flatnonzero(cut[:-1])


class Encoder:
    """Ids of texts, as the tokenizer gives them for the whole text.

    Texts are cut into words where the pre-tokenizer always cuts, equal words of a batch
    are found by sorting, and the tokenizer sees each word it has not met before once.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks already use every core
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.ranks, self.unusual = rank_encoder(path), unusual_signs()
        added = [re.escape(t.content.encode()) for t in self.model.get_added_tokens_decoder().values()]
        self.whole = re.compile(b"|".join([_RARE_SPACE.pattern, *added]))
        self.special = re.compile(b"|".join(added).decode() or r"(?!)")
        self.words: dict[bytes, bytes] = {}
        self.before: dict[bytes, bytes] = {}

    def _ids(self, words: list[bytes]) -> list[bytes]:
        known, before = self.words, self.before
        out = list(map(known.get, words))
        missing = [w for w, ids in zip(words, out) if ids is None]
        if missing:
            new = [w for w in missing if w not in before]
            known.update((w, before[w]) for w in missing if w in before)
            fresh: dict[bytes, bytes] = {}
            for at in range(0, len(new), 1024):
                some = new[at : at + 1024]
                for w, ids in zip(some, self._tokens([w.decode() for w in some])):
                    fresh[w] = array("I", ids).tobytes()
            out = [ids or fresh.get(w) or known[w] for w, ids in zip(words, out)]
            known.update((w, i) for w, i in fresh.items() if len(w) <= 2 * _WIDE)
            if len(known) > _WORDS // 2:  # words not met for a while are forgotten
                self.words, self.before = {}, known
        return out

    def _tokens(self, words: list[str]) -> list[list[int]]:
        """By the quicker of two libraries with the same ranks, where both are sure to cut words alike."""
        if self.ranks is None:
            return [e.ids for e in self.model.encode_batch_fast(words, add_special_tokens=False)]
        quick, odd = self.ranks.encode_ordinary, lambda w: self.unusual.search(w) or self.special.search(w)
        out = [None if odd(w) else quick(w) for w in words]
        rest = [k for k, ids in enumerate(out) if ids is None]
        for k, e in zip(rest, self.model.encode_batch_fast([words[k] for k in rest], add_special_tokens=False)):
            out[k] = e.ids
        return out

    def encode(self, texts: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts (UTF-8) one after the other, and how many each has.

        Long texts go through in parts, cut at spaces between letters.
        """
        if not any(len(t) > _LONG for t in texts):
            return self._encode(texts)
        ids, counts = [], []
        for t in texts:
            counts.append(0)
            at = 0
            while at < len(t) or not t:
                cut = _BETWEEN.search(t, at + _LONG)
                end = cut.end() - 1 if cut else len(t)
                got, _ = self._encode([t[at:end]])
                ids.append(got)
                counts[-1] += len(got)
                at = end
                if not t:
                    break
        return np.concatenate(ids), np.array(counts, np.int64)

    def _encode(self, texts: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(texts) else 0
        if not total:
            return np.zeros(0, "<u4"), np.zeros(len(texts), np.int64)
        data = b"".join(texts)
        a = np.frombuffer(data, np.uint8)
        first = np.unique((ends - sizes)[sizes > 0])
        starts = _starts(a, first) if len(a) > 2 else first
        if self.whole.search(data):
            whole = np.array([bool(self.whole.search(t)) for t in texts])
            inside = whole[np.searchsorted(ends, starts, side="right")]
            starts = starts[~inside | np.isin(starts, first)]
        length = np.diff(np.append(starts, total))
        padded = data + bytes(_WIDE)
        at = np.ndarray((total + _WIDE - 7,), "<u8", padded, strides=(1,))  # the eight bytes from each place on
        key = [at[starts + 8 * k] & _LOW[np.clip(length - 8 * k, 0, 8)] for k in range(3)]
        long = length > _WIDE
        key[0] = np.where(long, starts.astype(np.uint64), key[0])  # each on its own
        code = length.astype(np.uint64)
        for k in key:
            code = (code ^ k) * np.uint64(0x9E3779B97F4A7C15)
            code ^= code >> np.uint64(29)
        order = np.argsort(code, kind="stable")
        new = np.ones(len(order), bool)
        same = length[order][1:] == length[order][:-1]
        for k in key:
            k = k[order]
            same &= k[1:] == k[:-1]
        new[1:] = ~same
        group = np.empty(len(order), np.int64)
        group[order] = np.cumsum(new) - 1
        which = order[new]
        ids = self._ids([data[s:e] for s, e in zip(starts[which].tolist(), (starts + length)[which].tolist())])
        many = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        pool, offset = np.frombuffer(b"".join(ids), "<u4"), np.cumsum(many) - many
        n = many[group]
        done = np.cumsum(n)
        out = pool[np.repeat(offset[group] - (done - n), n) + np.arange(int(done[-1]))]
        before = np.concatenate([[0], done])
        at_text = before[np.searchsorted(starts, np.append(ends - sizes, total))]
        return out, np.diff(at_text)


def encoder(path: str) -> Encoder:
    """The encoder of this Python worker; it stays for the worker's later tasks."""
    kept = sys.modules.setdefault("_tremora_encoders", types.ModuleType("_tremora_encoders"))
    if path not in vars(kept):
        setattr(kept, path, Encoder(path))
    return getattr(kept, path)
