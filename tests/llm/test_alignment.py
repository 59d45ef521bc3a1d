import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from cases import awkward_rows, frame, plain
from tremora.llm import alignment as al
from tremora.llm.tokens import byte_letters
from tremora.llm.tokens import BYTE_BPE, tokenizer_path

ODD = ["", " ", "  ", "x ", " x", "a  b   c", "a\n b \n\n c\t d", "a\xa0 b\xa0  c", "\x1c d\x85  e", "sign ▁ here", "▁", "don't we'll 12 $x",
       "a<|endoftext|>b <s> </s> <unk> <0x41>", "日本語 テキスト", "é,ñ É!", "\x00a", "\U0001f600 \U0001f468‍\U0001f469", "x" * 400, "é a", "　 z", "﻿q"]


@pytest.fixture(scope="module")
def models():
    a = Tokenizer.from_file(tokenizer_path(BYTE_BPE))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(al.PIECE_BPE))


def brute(rows, models):
    """Whole texts by the two libraries; byte offsets where both end."""
    a_model, b_model = models
    byte = {x: b for b, x in enumerate(byte_letters())}
    docs, counts = [], Counter()
    for doc, text in rows:
        a, b, links, written = [], [], [], ""
        if text:
            a = a_model.encode(" " + text, add_special_tokens=False).ids
            b = b_model.encode(text)
            a_bytes = [bytes(byte[x] for x in a_model.id_to_token(i)) for i in a]
            b_bytes = [bytes([int(b_model.id_to_piece(i)[3:-1], 16)]) if b_model.is_byte(i) else b_model.id_to_piece(i).replace("▁", " ").encode() for i in b]
            if b"".join(a_bytes) != (" " + text).encode() or b"".join(b_bytes) != (" " + text).encode():
                a, b = [], []
            else:
                a_end, b_end = np.cumsum([len(x) for x in a_bytes]).tolist(), np.cumsum([len(x) for x in b_bytes]).tolist()
                common = sorted(set(a_end) & set(b_end))
                links = [(a[a_end.index(e)], b[b_end.index(e)]) for e in common]
                groups, before = [], 0
                for e in common:
                    groups.append(",".join(str(i) for i, x in zip(a, a_end) if before < x <= e) + "|" + ",".join(str(i) for i, x in zip(b, b_end) if before < x <= e))
                    before = e
                written = hashlib.sha256(";".join(groups).encode()).hexdigest()
        counts.update(links)
        docs.append((doc, len(a), len(b), links, written))
    most = {}
    for (_, b), n in counts.items():
        most[b] = max(most.get(b, 0), n)
    return sorted([(d, a, b, len(links), len(links), sum(counts[x] == most[x[1]] for x in links), sum(counts[x] for x in links), w)
                   for d, a, b, links, w in docs], key=repr)


def test_intervals_against_all_pairs():
    rng = random.Random(2)
    for _ in range(200):
        size = rng.randint(1, 30)
        cuts = [sorted({0, size, *(rng.randint(1, size) for _ in range(rng.randint(0, 12)))}) for _ in range(2)]
        (a_start, a_end), (b_start, b_end) = ((np.array(c[:-1]), np.array(c[1:])) for c in cuts)
        i, j = al.overlaps(a_start, a_end, b_start, b_end)
        assert list(zip(i.tolist(), j.tolist())) == [
            (x, y) for x in range(len(a_start)) for y in range(len(b_start)) if max(a_start[x], b_start[y]) < min(a_end[x], b_end[y])]
        a_group, b_group = al.coalesce(a_start, a_end, b_start, b_end)
        common = sorted(set(cuts[0]) & set(cuts[1]) - {0})
        assert a_group.tolist() == [sum(e > c for c in common) for e in a_end.tolist()]
        assert b_group.tolist() == [sum(e > c for c in common) for e in b_end.tolist()]


@pytest.mark.parametrize("small", [False, True])
def test_against_whole_texts(spark, models, monkeypatch, small):
    if small:
        for name, n in (("_PARTS", 30), ("_BLOCK", 200), ("_TOGETHER", 50), ("_SIDE", 7)):
            monkeypatch.setattr(al, name, n)
    rng = random.Random(4)
    rows = [r for r in awkward_rows() if not r[1] or len(r[1]) < 9000] + [(900 + i, t) for i, t in enumerate(ODD)]
    rows += [(1000 + i, "".join(rng.choice("ab \n.'é\xa0") for _ in range(80))) for i in range(60)]
    docs = frame(spark, rows, ("n", "a", "block")).repartition(3)
    assert plain(al.alignment(docs)) == brute(rows, models)
    if small:
        groups = {d: g for d, g in al.token_groups(docs).collect()}
        want = {r[0]: r[7] for r in brute(rows, models)}
        for d, g in groups.items():
            assert (hashlib.sha256(g.encode()).hexdigest() if g else "") == want[d] or d is None or [r[0] for r in rows].count(d) > 1


def test_only_texts_without_tokens(spark):
    rows = [(1, None), (2, ""), (3, "▁")]
    assert plain(al.alignment(frame(spark, rows))) == [(i, 0, 0, 0, 0, 0, 0, "") for i in (1, 2, 3)]


def test_empty_table(spark):
    assert plain(al.alignment(frame(spark, []))) == []
