"""The stages against their operators, on whole documents."""

from __future__ import annotations

import corpus_pipeline as pipeline
from assayer.llm.exact_dedup import exact_groups
from tests.llm.conftest import SCHEMA, document
from tests.llm.test_copies import brute_components


def test_stages(spark, documents):
    names = [name for name, _ in pipeline.STAGES]
    assert names == ["language_id", "exact_dedup", "ngram_join", "personal_data", "best_fit_packing"]
    docs = documents
    for name, stage in pipeline.STAGES[:-1]:
        before, docs = docs, stage(spark, docs, "").cache()
        rows = sorted(((r.doc_id, r.text) for r in docs.collect()), key=str)
        old = [(r.doc_id, r.text) for r in before.collect()]
        assert docs.columns == documents.columns
        if name == "language_id":
            assert rows == sorted(((i, t) for i, t in old if any(c.isalpha() for c in t or "")), key=str)
        if name == "exact_dedup":
            last = {t: max((j for j, u in old if u == t and j is not None), default=None) for _, t in old}
            assert rows == sorted(((i, t) for t, i in last.items()), key=str)
        if name == "ngram_join":
            keep = {c[2] if c[2] is not None else c[0] for c in brute_components(old, 5, 80)}
            assert rows == sorted(((i, t) for i, t in old if i in keep), key=str)
        if name == "personal_data":
            assert [i for i, _ in rows] == sorted((i for i, _ in old), key=str)
            assert all(r.n_chars == len(r.text) for r in docs.collect())
    packed = pipeline.packed(spark, docs, "").collect()
    assert {r.doc_id for r in packed} == {r.doc_id for r in docs.collect()}


def test_columns_named_like_results_pass_through(spark, documents):
    for _, stage in pipeline.STAGES[:-1]:
        rows = stage(spark, documents, "").collect()
        assert rows and {(r.score, r.bits, r.lang_pred, r.text_sha256, r.text_md5) for r in rows} == {
            ("a", "b", "xx", "not a hash", None)
        }


def test_near_stage_tells_rows_of_one_id_apart(spark, words):
    """Of rows that share an id only the copy goes; a null id stays behind every other."""
    text, other = " ".join(words(200, 21)), " ".join(words(200, 22))
    rows = [(1, text), (2, f"{text} more"), (2, other), (None, f"{text} less"), (None, "of its own and long enough"), (7, None)]
    docs = spark.createDataFrame([document(i, t) for i, t in rows], SCHEMA)
    left = {(r.doc_id, r.text) for r in pipeline.without_near_copies(spark, docs, "").collect()}
    assert left == {(1, text), (2, other), (None, "of its own and long enough"), (7, None)}


def test_exact_stage_keeps_one_of_repeated_rows(spark, documents):
    docs = documents.unionByName(documents)
    left = pipeline.without_exact_copies(spark, docs, "").collect()
    assert len(left) == exact_groups(docs).where("kept").count() == len({r.text or "" for r in left})


def test_empty(spark, nothing):
    docs = nothing
    for _, stage in pipeline.STAGES:
        docs = stage(spark, docs, "")
        assert docs.count() == 0
