import re

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from test_decontaminate import brute as brute_contaminated
from test_exact import brute as brute_exact
from test_simhash import brute as brute_near

from tokenizers import Tokenizer
from tremora.llm import packing, tokens, toxicity
from tremora.llm.common import table

TABLES = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def documents(spark):
    return table(spark, TABLES, "documents")


def test_stages_equal_brute_force(spark, documents):
    """The whole chain on real documents, each stage beside a plain version of it."""
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    scores = {r.doc_id: r.score for r in toxicity.toxicity(documents, table(spark, TABLES, "labels")).collect()}
    kept = [r for r in rows if scores[r[0]] < 0.3]
    exact = {d: k for d, _, _, k, _ in brute_exact(kept)}
    kept = [r for r in kept if exact[r[0]]]
    near = {d: c for d, _, c in brute_near(kept)}
    kept = [r for r in kept if near[r[0]] == r[0]]
    items = [(r.item_id, r.text) for r in table(spark, TABLES, "benchmark").collect()]
    bad = {d: c for d, *_, c in brute_contaminated(kept, items)}
    kept = [r for r in kept if not bad[r[0]]]
    model = Tokenizer.from_file(tokens.tokenizer_path())
    want = {}
    for d, t in kept:
        n = len(model.encode(t, add_special_tokens=False).ids)
        for p in range(-(-n // packing.MAX_TOKENS)):
            want[d, p] = min(packing.MAX_TOKENS, n - p * packing.MAX_TOKENS)
    out = corpus_pipeline.run(spark, TABLES).collect()
    assert {(r.doc_id, r.piece): r.n_tokens for r in out} == want and len(out) == len(want)
    assert len(kept) < len(rows)


def test_stages_keep_the_columns(spark, documents):
    docs = documents.limit(50).withColumnRenamed("source", "kept").withColumnRenamed("n_chars", "_gone")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, TABLES)
        assert docs.columns == ["doc_id", "text", "lang", "kept", "_gone"]
        assert docs.count() > 0


def test_stages_on_awkward_rows(spark):
    from cases import awkward_rows, frame

    rows = awkward_rows()
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, frame(spark, rows, ("keep_id", "component_id", "score")), TABLES).count() > 0
        assert stage(spark, frame(spark, []), TABLES).count() == 0


def test_names():
    queries = entry.queries()
    assert "pipeline" in queries
    assert [sum(bool(re.match(rf"op{n}_", q)) for q in queries) for n in range(1, 14)] == [1] * 13


@pytest.mark.parametrize("files", [True, False])
def test_rows_are_judged_one_by_one(spark, tmp_path, files):
    """Repeated rows, one id on two texts, rows without id: of copies one row stays, and no clean row goes with another."""
    import random

    from cases import frame, stored, words

    rng = random.Random(0)
    a, b, c, d = (words(rng, 60, letters) for letters in ("abcd", "efgh", "ijkl", "mnop"))
    item = max((r.text for r in table(spark, TABLES, "benchmark").collect()), key=len)
    rows = [(1, a), (1, a), (3, " " + a), (3, b), (None, a), (None, c), (4, item), (4, d), (None, item), (None, item)]
    docs = frame(spark, rows, ("row", "_row"))
    docs = stored(docs, tmp_path) if files else docs
    stages = dict(corpus_pipeline.STAGES)
    left = {name: stages[name](spark, docs, TABLES) for name in ("exact_dedup", "near_dedup", "decontaminate")}
    assert all(df.columns == docs.columns for df in left.values())
    texts = {name: sorted((r.text for r in df.collect())) for name, df in left.items()}
    assert texts["exact_dedup"] == sorted([" " + a, b, c, d, item])
    assert texts["near_dedup"] == sorted([a, b, c, d, item])
    assert texts["decontaminate"] == sorted([a, a, " " + a, b, a, c, d])
    ids = lambda name, text: [r.doc_id for r in left[name].collect() if r.text == text]
    assert ids("exact_dedup", " " + a) == [3] and ids("near_dedup", a) == [1] and ids("exact_dedup", item) == ids("near_dedup", item) == [4]
