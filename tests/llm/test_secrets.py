import random
import string

from pyspark.sql import functions as F

from cases import awkward_rows, folds, frame, plain, words
from tremora.llm import secrets_forest as sf

OUT = folds(4, 2)


def case(n=600, seed=0):
    rng = random.Random(seed)
    pick = lambda chars, k: "".join(rng.choice(chars) for _ in range(k))
    rows, truth = [], {}
    for i in range(n):
        kind, left, right = i % 6, words(rng, 20), words(rng, 20)
        if kind == 0:
            token, real = "AKIA" + pick(string.ascii_uppercase + "234567", 16), 1
        elif kind == 1:
            token, real = "password=" + pick("0123456789abcdef", 20), 1
        elif kind == 2:
            token, real = pick("0123456789", 16), 0
        elif kind == 3:
            token, real = "token=example" + pick("0123456789", 10), 0
        elif kind == 4:
            token, real = pick("0123456789abcdef", 32), None  # no rule is certain
        else:
            token, real = pick("abcdefgh", 18), None  # no digit: not a candidate
        rows.append((i, f"{left} {token} {right}"))
        truth[i] = (token, real)
    return rows, truth


def test_false_positives_go(spark):
    rows, truth = case()
    got = sf.scan_secrets(frame(spark, rows, ("token", "value", "score", "features", "label")), trees=15).collect()
    assert sorted(r.doc_id for r in got) == [i for i in truth if i % 6 != 5]
    for r in got:
        assert r.token == truth[r.doc_id][0] and r.label == truth[r.doc_id][1] and r.held_out == OUT(r.doc_id)
    held = [r for r in got if r.held_out and r.label is not None]
    assert len(held) > 50 and all(r.kept == bool(r.label) for r in held)


def test_given_findings(spark):
    rows, _ = case(200)
    found = sf.candidates(frame(spark, rows))
    hexes = F.col("value").rlike("^[0-9a-f]{32}$")
    findings = found.select("doc_id", "at", hexes.cast("int").alias("label"))
    got = sf.scan_secrets(frame(spark, rows), findings, trees=15).collect()
    assert all(r.kept == (r.doc_id % 6 == 4) for r in got if r.held_out)


def test_values_and_neighbours(spark):
    text = 'token = "0123456789abcdef0123" then api_key:Zm9vYmFyYmF6cXV4MTIz, v1.2'
    got = [tuple(r) for r in sf.candidates(frame(spark, [(1, text)])).select("at", "value", "before", "after").orderBy("at").collect()]
    assert got == [(2, "0123456789abcdef0123", "=", "then"), (4, "Zm9vYmFyYmF6cXV4MTIz", "then", "v1.2")]


def test_awkward_rows(spark):
    rows = awkward_rows() + [(900, "AKIA" + "A2" * 8), (901, "AKIA" + "A2" * 8), (901, "AKIA" + "A2" * 8), (None, "AKIA" + "B3" * 8)]
    got = sf.scan_secrets(frame(spark, rows)).collect()
    assert sorted(((r.doc_id, r.value) for r in got), key=repr) == sorted(
        [(900, "AKIA" + "A2" * 8), (901, "AKIA" + "A2" * 8), (901, "AKIA" + "A2" * 8), (None, "AKIA" + "B3" * 8)], key=repr)
    assert all(r.kept and r.score == 0.5 for r in got)  # one kind of finding teaches nothing
    assert plain(sf.scan_secrets(frame(spark, []))) == []


def test_dictionary_is_of_frequent_words(spark):
    docs = frame(spark, [(1, "the cat the dog " * 50 + "rare"), (2, None)])
    assert {r.word for r in sf.dictionary(docs, 10).collect()} == {"the", "cat", "dog"}


def test_values_behind_a_name_in_any_form(spark):
    letters = "qwzkxvjhpmtrbdnlgcfsyaeu"
    texts = {"password = abcd1234efgh": "abcd1234efgh", 'api_key: "abcdef123456"': "abcdef123456", f"secret = {letters}": letters,
             "password=P@ssw0rd!23": "P@ssw0rd!23", 'PASSWORD := "P@ss w0rd"': None, "db_password => 'x9!kQ#2z',": "x9!kQ#2z",
             "--token s3cr3t!x9": "s3cr3t!x9", "pwd =Tr0ub4dor&3": "Tr0ub4dor&3", "password = short": None, "a plain sentence follows everything": None}
    docs = frame(spark, [(i, f"see {t} end") for i, t in enumerate(texts)])
    got = {r.doc_id: r.value for r in sf.scan_secrets(docs).collect()}
    assert got == {i: v for i, v in enumerate(texts.values()) if v}
