import os
import re

import public_tokenizers
import pytest
import sentencepiece
from helpers import SCHEMA, frame
from test_decontaminate import clean, distance_inside
from test_secrets import base
from test_shingles import brute as similar

import corpus_pipeline as pipeline

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def steps(spark):
    """The rows before and after every stage."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs.collect()]
    for name, stage in pipeline.STAGES:
        docs = pipeline.materialize(stage(spark, docs, SF), f"test-{name}")
        out.append(docs.collect())
    return out


def ids(rows):
    return sorted(r.doc_id for r in rows)


def test_language(steps):
    lettered = [r for r in steps[0] if re.search(r"[^\W\d_]", r.text or "")]
    assert set(ids(steps[1])) <= set(ids(lettered)) and len(steps[1]) > 0.99 * len(lettered)
    assert {r.lang for r in steps[1]} <= {r.lang for r in steps[0]}


def test_one_of_each_group_stays(steps):
    rows = [tuple(r[c] for c in pipeline.COLUMNS) for r in steps[1]]
    want = {int(c) for _, _, c in similar(rows)}
    assert set(ids(steps[2])) == want and len(steps[2]) == len(want)


def test_benchmark(spark, steps):
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    kept = set(ids(steps[3]))
    for r in steps[2]:
        if any(i in r.text for i in items):
            assert r.doc_id not in kept
    gone = [r for r in steps[2] if r.doc_id not in kept]
    for r in gone[:3]:
        assert any(
            distance_inside(clean(i)[s : s + 120], clean(r.text)) <= 12
            for i in items for s in {0, 60, max(0, len(clean(i)) - 120)} if len(clean(i)[s : s + 120]) == min(120, len(clean(i)))
        )


def test_secrets(steps):
    before = {r.doc_id: r.text for r in steps[3]}
    assert ids(steps[4]) == sorted(before)
    changed = 0
    for r in steps[4]:
        if not base(before[r.doc_id]):
            changed += r.text != before[r.doc_id]
        assert r.n_chars == len(r.text)
    assert changed <= 2


def test_pieces(spark, steps):
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    want = {r.doc_id: library.encode(r.text) for r in steps[4]}
    assert {r.doc_id: list(r.ids) for r in steps[5]} == want
    run = pipeline.run(spark, SF).collect()
    assert {r.doc_id: list(r.ids) for r in run} == want


def test_awkward_documents(spark):
    docs = frame(spark, [(None, None, None, None, None, None, None), (1, "", None, None, None, None, None)])
    for _, stage in pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.count() == 0
    empty = spark.createDataFrame([], SCHEMA)
    for name, stage in pipeline.STAGES:
        empty = pipeline.materialize(stage(spark, empty, SF), f"test-none-{name}")
    assert empty.count() == 0


def test_documents_in_several_languages_stay(spark, monkeypatch):
    rows = [(1, "three languages", "x", "s", 15, "fr", 0.35), (2, "one", "x", "s", 3, "en", 0.9), (3, "1 2", "x", "s", 3, "und", 0.0)]
    names = [f"keep_{c}" for c in pipeline.COLUMNS] + ["lang_pred", "score"]
    monkeypatch.setattr(pipeline.language, "detect_language", lambda docs, keep: spark.createDataFrame(rows, names))
    got = pipeline.identified(spark, None, SF).collect()
    assert sorted((r.doc_id, r.lang) for r in got) == [(1, "fr"), (2, "en")]
