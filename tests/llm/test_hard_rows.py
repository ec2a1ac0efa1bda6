"""Every operator on an empty table and on rows that are out of the ordinary."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from millrace.llm import exact, language, masked, minhash, mixing, pages, pieces, quality, secrets
from millrace.llm import topk

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
NAMES = (
    "id n score kept keep_id group_size length prefix normal key rep component size degree value "
    "bit_word bit_mask open tokens copies leaf extra rest whole label x rank found lang_pred"
).split()


def rows(spark, texts):
    """Documents with ids from 1, a null id in the end, and columns of common names."""
    data = [(i + 1, text, "en", "s", len(text or "")) for i, text in enumerate(texts)]
    data.append((None, "a row without an id has a text too", None, None, 7))
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    table = spark.createDataFrame(data, schema)
    return table.withColumns({name: F.lit(f"{name}!") for name in NAMES})


TEXTS = [
    None,
    "",
    " \t\n ",
    "one",
    "one",
    "One  TWO three four five six seven eight",
    "One TWO\nthree four five six seven eight",
    "x" * 60_000,
    "long words in lines\n" * 6_000,
    "日本語のテキスト 😀 \x01 \x00 ▁",
    "password = hunter2hunter2",
    "12345 67890",
]


@pytest.fixture(scope="module")
def hard(spark):
    table = rows(spark, TEXTS)
    return table.unionByName(table.filter("doc_id = 6")).cache()


@pytest.fixture(scope="module")
def labels(spark):
    data = [(i, i % 2, 0) for i in range(1, 9)] + [(None, 1, 0), (3, None, 0)]
    return spark.createDataFrame(data, "doc_id bigint, quality int, toxic int")


def _apply(spark, docs, labels):
    weights = {("en",): 2.0}
    return {
        "near": minhash.near_copies(docs),
        "language": language.predicted(docs, language.learn(docs)),
        "exact": exact.exact_groups(docs),
        "masked": masked.pseudo_likelihood(docs),
        "quality": quality.scored(docs, quality.learn(docs, labels)),
        "secrets": secrets.span_digests(secrets.secrets(docs)),
        "pieces": pieces.joined(pieces.segmented(docs, MODEL), MODEL, output_column="back"),
        "mix": mixing.mix(docs, ("lang", "source"), weights, share=0.9, epochs=2),
        "pages": pages.extracted(docs, "doc_id", "source", "text"),
    }


def test_no_rows(spark, hard, labels):
    for name, result in _apply(spark, hard.limit(0), labels.limit(0)).items():
        assert result.collect() == [], name


def test_hard_rows(spark, hard, labels):
    results = {name: result.collect() for name, result in _apply(spark, hard, labels).items()}
    n = len(TEXTS) + 2
    for name in ("near", "language", "exact", "masked", "quality", "secrets", "pieces", "pages"):
        assert len(results[name]) == n, name

    near = {row.doc_id: row for row in results["near"]}
    assert [near[i].n_shingles for i in (1, 2, 3, 4, 6)] == [0, 0, 0, 1, 4]
    assert near[3].component_id == 3 and near[5].component_id == 4 and near[7].component_id == 6
    assert near[None].component_id is None and near[None].kept

    same = {row.doc_id: row for row in results["exact"]}
    assert [same[i].keep_id for i in (1, 2, 3, 5, 7, None)] == [1, 1, 3, 4, 6, None]
    assert same[6].group_size == 3 and same[6].kept and same[None].kept

    named = {row.doc_id: row for row in results["language"]}
    assert [named[i].lang_pred for i in (1, 2, 3, 12, 4)] == ["und"] * 4 + ["en"]

    scores = {row.doc_id: row for row in results["masked"]}
    assert (scores[2].n_tokens, scores[2].log_likelihood, scores[2].per_token) == (0, 0.0, None)
    assert scores[9].n_tokens == 24_000 and scores[9].log_likelihood < 0

    assert all(0 <= row.score <= 1 for row in results["quality"])
    found = {row.doc_id: row for row in results["secrets"]}
    assert found[11].n_assign == 1 and found[11].spans == "assign:0:25"
    assert sum(row.n_assign + row.n_hex + row.n_access for row in results["secrets"]) == 1

    for row in results["pieces"]:
        assert row.back == row.text and (row.pieces is None) == (row.text is None)
    assert {row.copies for row in results["mix"]} <= {1, 2}


def test_pipeline_stages(spark, hard, labels, folder):
    labels.write.parquet(f"{folder}/labels.parquet")
    stages = corpus_pipeline.STAGES
    for docs in (hard, hard.limit(0)):
        for name, stage in stages[:-1]:
            result = stage(spark, docs, folder)
            assert result.columns == docs.columns, name
            ids = [row.doc_id for row in result.select("doc_id").collect()]
            assert len(ids) <= docs.count(), name
            if name.startswith("exact") and docs is hard:
                assert sorted(i or 0 for i in ids) == [0, 1, 3, 4, 6, 8, 9, 10, 11, 12]
            if name.startswith("MinHash") and docs is hard:
                assert 5 not in ids and 7 not in ids and None in ids
        last = stages[-1][1](spark, docs, folder).collect()
        assert len(last) == docs.count() and all(row.lossless for row in last)


def test_vectors(spark):
    nan = float("nan")
    data = [
        (0, [1.0, 0.5]),
        (1, [1.0, 0.5]),
        (2, [1.0, 0.5]),
        (3, None),
        (4, [nan, 1.0]),
        (5, [None, 1.0]),
        (6, [float("inf"), 0.0]),
        (7, []),
        (8, [-2.0]),
        (50, [0.0, 0.0]),
        (None, [9.0, 9.0]),
        (1, [1.0, 0.5]),
    ]
    table = spark.createDataFrame(data, "vec_id bigint, embedding array<float>")
    table = table.withColumns({name: F.lit(1) for name in ("v", "id", "query", "score", "band")})
    query = F.col("vec_id") % 50 == 0
    got = [tuple(row) for row in topk.top_products(table, query).collect()]
    top = 256 * 256 + 128 * 128
    assert sorted(got) == [
        (0, 1, 1, top),
        (0, 2, 1, top),
        (0, 3, 2, top),
        (0, 4, 7, 0),
        (0, 5, 50, 0),
        *((50, k + 1, i, 0) for k, i in enumerate((0, 1, 1, 2, 7))),
    ]
    assert topk.top_products(table.limit(0), query).collect() == []
    assert topk.top_products(table.filter("vec_id = 7"), query).collect() == []
