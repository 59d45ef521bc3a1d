import heapq
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from cases import awkward_rows, frame, plain
from tremora.llm import token_files as tf
from tremora.llm import tokens


@pytest.fixture(scope="module")
def model():
    return Tokenizer.from_file(tokens.tokenizer_path())


ODD = ["", " ", "  a  b ", "a\n b \n c", " x", "x ", "don't we'll 12 a12 %% $ x\t y  z", "\x85 a\x1c b", "　 a b, c",
       "x'llama, a.b!c?\nd 'll ,x", "\n", "a", "é,ñ.×,÷.b É!\n\nx\n", "x" * 500 + " " + "y" * 50, "a<|endoftext|>b", "日本語 テキスト"]


def test_encoder_equals_the_library(model):
    texts = ODD + [t or "" for _, t in awkward_rows()]
    ids, n = tokens.Encoder(tokens.tokenizer_path()).encode([t.encode() for t in texts])
    at = np.concatenate([[0], np.cumsum(n)])
    for i, t in enumerate(texts):
        assert ids[at[i] : at[i + 1]].tolist() == model.encode(t, add_special_tokens=False).ids


def test_long_texts_and_a_short_memory(model, monkeypatch):
    monkeypatch.setattr(tokens, "_LONG", 700)
    monkeypatch.setattr(tokens, "_WORDS", 20)
    encoder = tokens.Encoder(tokens.tokenizer_path())
    texts = [t for _, t in awkward_rows() if t and len(t) < 20_000]
    for _ in range(2):
        ids, n = encoder.encode([t.encode() for t in texts])
        assert ids.tolist() == [i for t in texts for i in model.encode(t, add_special_tokens=False).ids]


def brute(rows, model):
    out, at = [], 0
    for d, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, str(r[1]))):
        ids = model.encode(t or "", add_special_tokens=False).ids + [0]
        out.append((d, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return sorted(out, key=repr)


@pytest.mark.parametrize("block, every", [(tf.BLOCK, tf.EVERY), (1000, 16)])
def test_round_trip(spark, tmp_path, monkeypatch, model, block, every):
    monkeypatch.setattr(tf, "BLOCK", block)
    monkeypatch.setattr(tf, "EVERY", every)
    rows = [r for r in awkward_rows() if r[0] is not None] + [(900 + i, t) for i, t in enumerate(ODD)] + [(None, "no id")]
    tf.write_token_files(frame(spark, rows, ("start", "part", "ids")).repartition(3), str(tmp_path / "t"))
    assert plain(tf.read_digests(spark, str(tmp_path / "t"))) == brute(rows, model)
    pieces = sorted(tf.read_pieces(spark, str(tmp_path / "t")).collect(), key=lambda r: r["at"])
    stream = np.concatenate([np.frombuffer(bytes(p.ids), "<u4") for p in pieces])
    ends = np.flatnonzero(stream == 0)
    assert len(stream) == sum(p.n for p in pieces) and len(ends) >= len(rows)


def test_empty_table(spark, tmp_path):
    tf.write_token_files(frame(spark, []), str(tmp_path / "t"))
    assert plain(tf.read_digests(spark, str(tmp_path / "t"))) == []


def test_code_lengths_are_optimal():
    rng = np.random.default_rng(0)
    for n in (2, 3, 10, 200):
        c = rng.integers(1, 1000, n)
        lengths = tf.code_lengths(c, 30).astype(int)
        heap, cost = sorted(int(x) for x in c), 0
        while len(heap) > 1:
            two = heapq.heappop(heap) + heapq.heappop(heap)
            cost += two
            heapq.heappush(heap, two)
        assert (lengths * c).sum() == cost and (2.0**-lengths).sum() == 1
    limited = tf.code_lengths(2 ** np.arange(20), 6).astype(int)
    assert limited.max() == 6 and (2.0**-limited).sum() <= 1
    assert tf.code_lengths(np.array([0, 7, 0]), 16).tolist() == [0, 1, 0]
    with pytest.raises(ValueError):
        tf.code_lengths(np.ones(9), 3)


def test_crc_of_parts():
    a, b = b"some bytes", bytes(range(256)) * 9
    for x, y in ((a, b), (b, a), (a, b""), (b"", a)):
        assert tf.crc_join(zlib.crc32(x), zlib.crc32(y), len(y)) == zlib.crc32(x + y)
