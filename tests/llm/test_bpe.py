import hashlib
import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from cases import awkward_rows, frame, plain
from tremora.llm import bpe
from tremora.llm.merge_automaton import Automaton
from tremora.llm.tokens import tokenizer_path

ODD = ["", " ", "Don't WE'LL 12²½ a12 %% $x\ty\r\nz", "ÀÉÎ straße İstanbul ΣΑΣ Σ", "é å Å", "\x85a\x1cb　c\xa0d",
       "<|startoftext|>hello<|endoftext|> WORLD <|endoftext|", "日本語 텍스트 кот", "a" * 3000, "!?" * 200, "'s'S's", "“quotes” – dash…", "\U0001f600é",
       "x‍y ﻿z", "the " * 50 + "end"]


@pytest.fixture(scope="module")
def path():
    return tokenizer_path(bpe.WORD_BPE)


@pytest.fixture(scope="module")
def model(path):
    return Tokenizer.from_file(path)


@pytest.fixture(scope="module")
def automaton(path):
    return Automaton.of_file(path)


def merged(word, merges):
    """The plain way: the earliest merge first, from the left."""
    rank = {m: i for i, m in enumerate(merges)}
    parts = list(word)
    while len(parts) > 1:
        best = min(range(len(parts) - 1), key=lambda i: rank.get((parts[i], parts[i + 1]), 1 << 30))
        if (parts[best], parts[best + 1]) not in rank:
            break
        parts[best : best + 2] = [parts[best] + parts[best + 1]]
    return parts


@pytest.mark.parametrize("seed", range(20))
def test_gadgets_equal_merging_by_rank(seed):
    rng = random.Random(seed)
    tokens, merges = list("abc"), []
    while len(merges) < 25:
        a, b = rng.choice(tokens), rng.choice(tokens)
        if a + b not in tokens and len(a + b) < 9:
            merges.append((a, b))
            tokens.append(a + b)
    automaton = Automaton.compile({t: i for i, t in enumerate(tokens)}, merges, "")
    words = ["".join(rng.choice("abc" if seed % 2 else "ab") for _ in range(rng.randint(1, 40))) for _ in range(300)] + ["a" * n for n in range(1, 60)]
    for word, ids in zip(words, automaton.encode([w.encode() for w in words])):
        assert [tokens[i] for i in np.frombuffer(ids, "<u4")] == merged(word, merges)


def test_merge_before_its_parts_is_refused():
    with pytest.raises(ValueError):
        Automaton.compile({"a": 0, "b": 1, "ab": 2, "abb": 3}, [("ab", "b"), ("a", "b")], "")


def test_texts_equal_the_library(path, model, automaton, monkeypatch):
    monkeypatch.setattr(bpe, "_WORDS", 50)
    monkeypatch.setattr(bpe, "_PART", 300)
    encoder = bpe.WordEncoder(path, automaton)
    rng = random.Random(3)
    texts = ODD + [t or "" for _, t in awkward_rows()] + ["".join(rng.choice(" \n'sStTrREvVlLdDmM1.,é–") for _ in range(60)) for _ in range(500)]
    for text in texts:
        ids = encoder.encode(text)
        assert np.frombuffer(ids, "<u4").tolist() == model.encode(text, add_special_tokens=False).ids, text
        assert encoder.decode(ids) == model.decode(np.frombuffer(ids, "<u4").tolist(), skip_special_tokens=False)


def sha(data):
    return hashlib.sha256(data).hexdigest()


def test_round_trip(spark, tmp_path, model, monkeypatch):
    rows = awkward_rows() + [(900 + i, t) for i, t in enumerate(ODD)]
    monkeypatch.setattr(bpe, "_PART", 5000)
    docs = frame(spark, rows, ("ids", "n_tokens")).repartition(3)
    want = []
    for d, t in rows:
        ids = model.encode(t or "", add_special_tokens=False).ids
        want.append((d, len(ids), sha(np.array(ids, "<u4").tobytes()), sha(model.decode(ids, skip_special_tokens=False).encode())))
    assert plain(bpe.round_trip_digests(docs)) == sorted(want, key=repr)
    encoded = bpe.encode(docs)
    assert sorted((d, sha(bytes(i))) for d, i in encoded.collect() if d is not None) == sorted((r[0], r[2]) for r in want if r[0] is not None)
    assert sorted((d, sha(t.encode())) for d, t in bpe.decode(encoded).collect() if d is not None) == sorted((r[0], r[3]) for r in want if r[0] is not None)


def test_empty_table(spark):
    assert plain(bpe.round_trip_digests(frame(spark, []))) == []
