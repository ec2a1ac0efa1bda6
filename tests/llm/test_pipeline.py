"""The pipeline's stages against brute force, each on what the one before it kept."""

from __future__ import annotations

import re

import pytest
from test_near_and_exact import brute
from test_pieces_mix_pages_topk import _mix

import corpus_pipeline
from millrace.llm import queries


def _ids(frame):
    return sorted(row.doc_id for row in frame.select("doc_id").collect())


@pytest.fixture(scope="module")
def stages(spark, tables):
    """The input and the result of each stage, the results filed."""
    docs, found = queries.table(spark, tables, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        result = corpus_pipeline.stored(stage(spark, docs, tables), "stage")
        found.append((name, docs, result))
        docs = result
    return found


def test_order_and_columns(stages):
    names = [name for name, _, _ in stages]
    assert [name.split()[0] for name in names] == [
        "quality",
        "exact",
        "MinHash",
        "mixing",
        "SentencePiece",
    ]
    for _, docs, result in stages[:-1]:
        assert result.columns == docs.columns and result.schema == docs.schema
        kept = {tuple(row) for row in result.collect()}
        assert 0 < len(kept) < docs.count() and kept <= {tuple(row) for row in docs.collect()}


def test_quality_keeps_what_the_query_calls_good(spark, tables, stages):
    _, _, result = stages[0]
    good = queries.op5_quality_classifier(spark, tables).filter("predicted = 1")
    assert _ids(result) == _ids(good)


def test_one_of_each_text_stays(stages):
    _, docs, result = stages[1]
    first = {}
    for doc_id, text in sorted((row.doc_id, row.text) for row in docs.collect()):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", text or ""), doc_id)
    assert _ids(result) == sorted(first.values())


def test_one_of_each_family_stays(stages):
    _, docs, result = stages[2]
    rows = sorted((row.doc_id, row.text) for row in docs.collect())
    found = brute([text for _, text in rows], 5)
    assert _ids(result) == [rows[i][0] for i, (_, top) in enumerate(found) if top == i]


def test_mixture_is_the_defined_one(stages):
    _, docs, result = stages[3]
    rows = [
        (row.doc_id, "long" if len(row.source) > 4 else "short", row.lang, row.source, row.text)
        for row in docs.collect()
    ]
    sized = [(r[0], *r[1:4], len(re.findall(r"[^\x20\x09-\x0D]+", r[4] or ""))) for r in rows]
    total = corpus_pipeline.SHARE * sum(r[4] for r in sized)
    assert _ids(result) == sorted(_mix(sized, queries.MIX_WEIGHTS, total, 1))


def test_pieces_give_the_texts_back(stages):
    _, docs, result = stages[4]
    assert _ids(result) == _ids(docs)
    for row in result.collect():
        assert row.lossless and row.n_pieces == len(row.pieces) > 0


def test_run_is_all_stages(spark, tables, stages):
    rows = corpus_pipeline.run(spark, tables)
    last = stages[-1][2]
    assert rows.columns == last.columns
    assert sorted(map(str, rows.collect())) == sorted(map(str, last.collect()))
