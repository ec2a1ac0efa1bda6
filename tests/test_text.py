"""Terms, weights, similar documents and classification."""

from __future__ import annotations

import math
import random
from collections import Counter
from itertools import combinations
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from millrace.functions.text import STOP_WORDS, all_stop_words
from millrace import storage
from millrace.operators import classify, given, heads, similarity, terms, wordlists
from millrace.operators.recommend import similar_items
from millrace.operators.similarity import copies_of, pair_similarity, similar_pairs

DOCUMENTS = [(1, "a b b"), (2, "b c"), (3, "C, b!")]


def documents(spark, data=DOCUMENTS):
    return spark.createDataFrame(data, "doc_id bigint, text string")


def weights(spark, data=DOCUMENTS):
    frame = documents(spark, data)
    tf = terms.term_frequency(terms.tokens(frame))
    return terms.tfidf(tf, terms.document_count(frame))


def test_tokens_of_accented_words(spark):
    found = terms.tokens(documents(spark, [(1, "Él, été! x2y_z"), (2, ""), (3, None)]))
    assert [tuple(r) for r in found.collect()] == [
        (1, 0, "él"), (1, 1, "été"), (1, 2, "x"), (1, 3, "y"), (1, 4, "z")
    ]


def test_stop_words(spark):
    words = terms.tokens(documents(spark, [(1, "the lamp et la table")]))
    for stop in (all_stop_words(), spark.createDataFrame([(w,) for w in all_stop_words()], "term string")):
        left = terms.without_stop_words(words, stop)
        assert left.columns == words.columns
        assert {r["term"] for r in left.collect()} == {"lamp", "table"}
    assert terms.without_stop_words(words, []).count() == 5
    assert all(word == word.lower() for listed in STOP_WORDS.values() for word in listed)


def test_frequencies(spark):
    tf = terms.term_frequency(terms.tokens(documents(spark)))
    assert {tuple(r) for r in tf.collect()} == {
        (1, "a", 1), (1, "b", 2), (2, "b", 1), (2, "c", 1), (3, "b", 1), (3, "c", 1)
    }
    assert {tuple(r) for r in terms.document_frequency(tf).collect()} == {("a", 1), ("b", 3), ("c", 2)}


def test_tfidf(spark):
    found = {(r["doc_id"], r["term"]): r["weight"] for r in weights(spark).collect()}
    assert found == {
        (1, "a"): pytest.approx(math.log(2)),
        (1, "b"): 0,
        (2, "b"): 0,
        (2, "c"): pytest.approx(0.287682, abs=1e-6),
        (3, "b"): 0,
        (3, "c"): pytest.approx(0.287682, abs=1e-6),
    }


def test_tfidf_takes_a_number(spark, tables):
    frame = spark.read.parquet(f"{tables}/documents.parquet")
    tf = terms.term_frequency(terms.tokens(frame))
    assert terms.tfidf(tf, 200).agg(F.count("*")).first()[0] == tf.count()


def test_given_pairs(spark):
    vectors = weights(spark).toDF("id", "feature", "weight")
    listed = [(2, 3), (1, 2), (1, 9), (2, 3), (2, 3)]
    pairs = spark.createDataFrame(listed, "id_a bigint, id_b bigint")
    assert pair_similarity(vectors, pairs).count() == 3
    found = {(r[0], r[1]): r[2] for r in pair_similarity(vectors, pairs).collect()}
    assert found == {(2, 3): pytest.approx(1), (1, 2): 0, (1, 9): 0}


def test_given_pairs_are_joined_by_id_alone(spark):
    """Vectors meet as rows: no row of a join or shuffle is an entry of a pair's vector."""
    rows = [(1, "a", 3.0), (1, "b", 4.0), (2, "b", 2.0), (3, "a", 1.0), (3, "a", 2.0), (4, "a", 0.0), (5, None, 2.0),
            (None, "a", 1.0), (6, "b", -1.0), (6, None, 1.0)]
    vectors = spark.createDataFrame(rows, "id bigint, feature string, weight double")
    listed = [(1, 2), (1, 3), (3, 1), (1, 4), (1, 5), (5, 5), (None, 1), (1, None), (7, 8), (1, 6), (2, 2)]
    pairs = spark.createDataFrame(listed, "id_a bigint, id_b bigint")
    result = pair_similarity(vectors, pairs)
    found = {(r[0], r[1]): r[2] for r in result.collect()}
    hit = {(1, 2): 0.8, (1, 3): 9 / 5 / 5**0.5, (3, 1): 9 / 5 / 5**0.5, (1, 6): -0.8 / 2**0.5, (2, 2): 1}
    assert found == {pair: pytest.approx(hit.get(pair, 0)) for pair in listed}
    plan = result._jdf.queryExecution().optimizedPlan().toString()
    assert [line for line in plan.splitlines() if "Join" in line]
    assert not [line for line in plan.splitlines() if "Join" in line and "feature" in line]
    assert pair_similarity(vectors.limit(0), pairs).agg(F.sum("cosine")).first()[0] == 0
    numbers = vectors.withColumn("feature", F.ascii("feature"))
    assert {(r[0], r[1]): r[2] for r in pair_similarity(numbers, pairs).collect()} == found


def test_copies_are_one_document(spark):
    found = similar_pairs(weights(spark).toDF("id", "feature", "weight"), 0.5)
    assert found.pairs.count() == 0
    assert {tuple(r) for r in found.copies.collect()} == {(1, 1), (2, 2), (3, 2)}


def vectors_of(spark, data):
    rows = [(id, feature, float(w)) for id, vector in data.items() for feature, w in vector.items()]
    return spark.createDataFrame(rows, "id bigint, feature string, weight double")


def brute_force(data, threshold):
    """Pairs of distinct vectors, the smallest id standing for equal ones."""
    groups = {}
    for id in sorted(data):
        kept = frozenset((f, w) for f, w in data[id].items() if w)
        if kept:
            groups.setdefault(kept, []).append(id)
    pairs = {}
    for (a, ids_a), (b, ids_b) in combinations(groups.items(), 2):
        a, b = dict(a), dict(b)
        common = a.keys() & b.keys()
        length = math.sqrt(sum(w * w for w in a.values()) * sum(w * w for w in b.values()))
        cosine = sum(a[f] * b[f] for f in common) / length
        if cosine >= threshold:
            key = tuple(sorted((ids_a[0], ids_b[0])))
            sizes = dict([(ids_a[0], len(ids_a)), (ids_b[0], len(ids_b))])
            pairs[key] = (sizes[key[0]], sizes[key[1]], len(common), pytest.approx(cosine))
    return pairs


def found_pairs(found):
    rows = found.pairs.collect()
    assert len({(r["id_a"], r["id_b"]) for r in rows}) == len(rows)
    return {
        (r["id_a"], r["id_b"]): (r["copies_a"], r["copies_b"], r["common"], r["cosine"]) for r in rows
    }


@pytest.mark.parametrize("threshold", [0.1, 0.33, 0.5, 0.8, 0.97])
@pytest.mark.parametrize("seed", [1, 2])
def test_similar_pairs_against_brute_force(spark, threshold, seed):
    """Few frequent and many rare features, near copies, copies, negative weights."""
    generator = random.Random(seed)
    data = {}
    for id in range(90):
        if id > 10 and generator.random() < 0.4:
            data[id] = dict(data[generator.randrange(id)])
            if generator.random() < 0.7:
                data[id][f"x{generator.randrange(40)}"] = generator.choice([0, 0.5, 2, 3])
        else:
            size = generator.randrange(1, 25)
            chosen = {f"f{int(generator.paretovariate(0.6))}" for _ in range(size)}
            data[id] = {f: generator.choice([1, 1, 2, 3, -1]) for f in chosen}
    found = similar_pairs(vectors_of(spark, data), threshold)
    expected = brute_force(data, threshold)
    assert found_pairs(found) == expected
    at_least = 2 + seed
    few = similar_pairs(vectors_of(spark, data), threshold, min_common=at_least)
    assert found_pairs(few) == {k: v for k, v in expected.items() if v[2] >= at_least}


def test_a_user_who_rated_everything_pairs_nothing(spark):
    """At a low threshold: 2000 items, each with a group of four and one common user."""
    ratings = [("all", item, 5.0) for item in range(2000)]
    ratings += [(f"g{item // 4}-{n}", item, 1.0 + n) for item in range(2000) for n in range(3)]
    frame = spark.createDataFrame(ratings, "user_id string, item_id bigint, rating double")
    changed = frame.withColumn("rating", F.col("rating") + F.col("item_id") % 4 / 10)
    ranked = []

    def noted(rows, name, keep=similarity.stored):
        table = keep(rows, name)
        if name == "met":
            ranked.append(table.count())
        return table

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(similarity, "stored", noted)
        found = similar_items(changed, 0.2, min_users=3).pairs
        assert found.count() == 500 * 6
        assert {row["common"] for row in found.collect()} == {4}
    assert ranked == [500 * 6]


def test_a_family_of_near_copies_is_sent_once(spark):
    """200 ids that are all alike: their vectors go to the groups of pairs, not to each pair."""
    ids = [(i, j) for j in range(200) for i in range(j)]
    pairs = spark.createDataFrame(ids + [(500, 501)], "id_a bigint, id_b bigint")
    dealt = given.tiles(pairs)
    assert {(r.id_a, r.id_b) for r in dealt.collect()} == {*ids, (500, 501)}
    assert given.needed(dealt).count() < 4 * 202
    rows = [(i, f, 1.0 + f) for i in [*range(200), 500, 501] for f in (*range(20), 100 + i)]
    lists = given.listed(spark.createDataFrame(rows, "id bigint, feature bigint, weight double"))
    found = given.family_products(pairs, lists).collect()
    assert {(r.id_a, r.id_b, r.dot, r.common) for r in found} == {
        (a, b, float(sum((1 + f) ** 2 for f in range(20))), 20) for a, b in [*ids, (500, 501)]
    }


def test_heads_meet_only_where_both_rests_can_reach_the_threshold(spark):
    """Both heads have the feature, but what the vectors have left there is 0.66 and 0.9 of them."""
    rows = [(1, 1, 0.9, 0.66, 0.1), (2, 1, 0.9, 0.9, 0.1), (3, 1, 0.9, 0.99, 0.1)]
    heads = spark.createDataFrame(rows, "place int, feature int, size double, from2 double, after2 double")
    assert {tuple(r) for r in similarity._met(heads, 0.8).collect()} == {(1, 3), (2, 3)}


def lists_of(spark, data):
    """The vectors of ``vectors_of`` as one row an id, features as numbers from rare to frequent."""
    counts = Counter(f for vector in data.values() for f, w in vector.items() if w)
    number = {f: n for n, f in enumerate(sorted(counts, key=lambda f: (counts[f], f)))}
    rows = []
    for id, vector in data.items():
        row = sorted((number[f], float(w)) for f, w in vector.items() if w)
        if row:
            rows.append((id, [f for f, _ in row], [w for _, w in row], sum(w * w for _, w in row)))
    return spark.createDataFrame(rows, "id bigint, features array<int>, weights array<double>, norm2 double")


@pytest.mark.parametrize("threshold", [0.1, 0.8])
def test_listed_vectors_against_brute_force(spark, threshold, monkeypatch):
    """With so few features to a block that there are several tiles."""
    monkeypatch.setattr(heads, "FEW", 100)
    generator = random.Random(7)
    data = {}
    for id in range(120):
        if id > 10 and generator.random() < 0.4:
            data[id] = dict(data[generator.randrange(id)])
            if generator.random() < 0.7:
                data[id][f"x{generator.randrange(40)}"] = generator.choice([0, 0.5, 2, 3])
        else:
            chosen = {f"f{int(generator.paretovariate(0.6))}" for _ in range(generator.randrange(1, 25))}
            data[id] = {f: generator.choice([1, 1, 2, 3, -1]) for f in chosen}
    listed = lists_of(spark, data)
    found = similar_pairs(listed, threshold)
    assert found_pairs(found) == brute_force(data, threshold)
    again = {tuple(r) for r in copies_of(listed).collect()}
    assert again == {tuple(r) for r in found.copies.collect()}
    assert again == {tuple(r) for r in copies_of(vectors_of(spark, data)).collect()}
    few = similar_pairs(listed, threshold, min_common=3)
    assert found_pairs(few) == {k: v for k, v in brute_force(data, threshold).items() if v[2] >= 3}


def test_pairs_that_share_only_rare_words_stay_in_their_tile(spark):
    """Two ids share the first of ten features; what both have left after their heads is too little."""
    data = {id: {"shared": 1, **{f"{id}-{n}": 1 for n in range(9)}} for id in range(30)}
    listed = lists_of(spark, data).withColumnRenamed("id", "place")
    rows = listed.selectExpr("place as id", "features", "weights", "norm2")
    tops = heads.heads(rows, 0.8)
    assert {r["n"] for r in tops.select(F.size("codes").alias("n")).collect()} == {4}
    data |= {id: {"shared": 1, "own": 1, f"{id}": 1} for id in (40, 41)}
    tops = heads.heads(lists_of(spark, data), 0.6).withColumnRenamed("id", "place")
    assert {tuple(r) for r in heads.met_in_tiles(tops, 0.6).collect()} == {(40, 41)}


def test_a_tile_gives_the_same_pairs_in_small_steps(monkeypatch):
    generator = random.Random(3)
    rows = []
    for place in range(60):
        codes = sorted(generator.sample(range(40), generator.randrange(1, 12)))
        sizes = [generator.random() for _ in codes]
        length = math.sqrt(sum(x * x for x in sizes) / generator.uniform(0.4, 1))
        after = 1 - sum((x / length) ** 2 for x in sizes)
        rows.append((place, place % 2, codes, [x / length for x in sizes], after))
    names = ["place", "block", "codes", "sizes", "after"]
    rounded = [(p, b, codes, heads.rounded_up(np.array(sizes)).tolist(), after) for p, b, codes, sizes, after in rows]
    table = pa.table(dict(zip(names, map(list, zip(*rounded)))))
    short = pa.list_(pa.int16())
    table = table.set_column(3, "sizes", table["sizes"].cast(short))
    exact = np.array([x for row in rows for x in row[3]])
    up = heads.rounded_up(exact).view(np.float16).astype(float)
    assert (up >= exact).all() and (up <= exact * 1.001 + 1e-7).all()

    def found(threshold):
        pairs = Counter()
        for blocks in ([0], [1], [0, 1]):
            sides, width = heads._sides(table, blocks)
            a, b = sides[0].places, sides[-1].places
            for x, y in heads._pairs(sides, width, threshold):
                pairs.update(frozenset(p) for p in zip(a[x].tolist(), b[y].tolist()))
        return pairs

    for threshold in (0.2, 0.7):
        large = found(threshold)
        with monkeypatch.context() as patch:
            for name in ("_MEETINGS", "_ENTRIES", "_DENSE"):
                patch.setattr(heads, name, 50)
            assert found(threshold) == large
        assert large and set(large.values()) == {1}
        for one, _, codes_a, sizes_a, _ in rows:
            for other, _, codes_b, sizes_b, _ in rows[one + 1 :]:
                shared = dict(zip(codes_a, sizes_a))
                dot = sum(shared.get(c, 0) * x for c, x in zip(codes_b, sizes_b))
                assert dot < threshold or frozenset((one, other)) in large


def test_an_entry_of_a_listed_vector_is_no_row_of_a_shuffle(spark):
    """Twenty documents of the same 400 words: 8000 entries, but each word is dealt out once a chunk."""
    letters = "abcdefghijklmnopqrst"
    text = " ".join(a + b + "z" for a in letters for b in letters)
    frame = documents(spark, [(id, f"{text} own{letters[id]}") for id in range(20)] + [(20, "other")]).coalesce(1)
    tf = terms.term_frequency(terms.tokens(frame, counted=True))
    pieces = wordlists.coded(tf, "doc_id")
    sizes = pieces.agg(F.sum(F.size("codes")), F.sum(F.size("terms"))).first()
    assert (sizes[0], sizes[1]) == (8021, 421)


def test_listed_weights_are_those_of_the_rows(spark, monkeypatch):
    """Chunks of a few entries; ids that come again and no id; words in every document weigh nothing."""
    monkeypatch.setattr(wordlists, "CHUNK", 3)
    monkeypatch.setattr(wordlists, "TERMS", 2)
    data = [(1, "a b b c d"), (2, "b c é"), (3, "C, b!"), (1, "e b a"), (None, "b x"), (None, "b x y"), (4, None),
            (5, "b"), (6, "b c d e f g h")]
    frame = documents(spark, data)
    tf = terms.term_frequency(terms.tokens(frame, counted=True))
    lists = terms.tfidf(tf, 6, listed=True)
    found = Counter()
    for row in lists.collect():
        assert row["features"] == sorted(set(row["features"])) and all(row["weights"])
        assert row["norm2"] == pytest.approx(sum(w * w for w in row["weights"]))
        found[row["doc_id"], tuple(sorted(row["weights"]))] += 1
    rows = {}
    for id, _, weight in terms.tfidf(tf, 6).collect():
        rows.setdefault(id, []).append(weight)
    kept = {id: tuple(sorted(w for w in own if w)) for id, own in rows.items()}
    assert found == Counter((id, own) for id, own in kept.items() if own)
    numbers = {f for row in lists.collect() for f in row["features"]}
    assert len(numbers) == len({t for _, t, w in terms.tfidf(tf, 6).collect() if w})
    assert terms.tfidf(tf.limit(0), 6, listed=True).count() == 0


def test_a_tidy_table_leaves_no_shuffle_files(spark):
    """Spark's driver would keep them until it collects its garbage."""
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(setting, None)
    table = storage.stored(spark.range(100).groupBy((F.col("id") % 7).alias("k")).count(), "tidy", tidy=True)
    assert table.count() == 7 and spark.conf.get(setting, None) == before
    seen = table.inputFiles()
    storage.discard(table)
    assert seen and not any(Path(file.removeprefix("file:")).exists() for file in seen)


def test_a_third_of_all_documents_are_copies(spark):
    """300 copies of one vector, 600 others: the copies count as one id."""
    data = {id: {"hot": 1, "topic": 2} for id in range(300)}
    data |= {300 + i: {"hot": 1, f"own{i}": 5, f"pair{i // 2}": 5} for i in range(600)}
    found = similar_pairs(vectors_of(spark, data), 0.45)
    pairs = found_pairs(found)
    assert pairs == {
        (300 + i, 301 + i): (1, 1, 2, pytest.approx(26 / 51)) for i in range(0, 600, 2)
    }
    sizes = Counter(r["same_as"] for r in copies_of(vectors_of(spark, data)).collect())
    assert sizes[0] == 300 and len(sizes) == 601


def test_similar_items_with_a_user_who_rated_everything(spark):
    ratings = [("hot", item, 1.0) for item in range(40)]
    ratings += [(f"u{n}", item, 4.0) for n in range(3) for item in (1, 2)]
    ratings += [(f"v{n}", 3, 2.0) for n in range(4)]
    frame = spark.createDataFrame(ratings, "user_id string, item_id bigint, rating double")
    found = similar_items(frame, 0.9, min_users=3)
    # Items 1 and 2 are copies; nothing else is close and has three users in common.
    assert found.pairs.count() == 0
    assert {(r["id"], r["same_as"]) for r in found.copies.filter("id = 2").collect()} == {(2, 1)}
    changed = frame.unionByName(spark.createDataFrame([("w", 2, 1.0)], frame.schema))
    row = similar_items(changed, 0.9, min_users=3).pairs.first()
    assert (row["id_a"], row["id_b"], row["common"]) == (1, 2, 4)


TRAIN = [(1, "good lamp lamp", 1), (2, "good desk", 1), (3, "bad lamp", 0), (4, "", 0)]
TEST = [(5, "good unknown"), (6, "bad bad"), (7, ""), (8, "lamp lamp")]


def test_naive_bayes_by_hand(spark):
    train = spark.createDataFrame(TRAIN, "doc_id bigint, text string, label int")
    test = documents(spark, TEST)
    model = classify.train_naive_bayes(
        terms.term_frequency(terms.tokens(train)), train.select("doc_id", "label")
    )
    scores = classify.naive_bayes_scores(model, terms.term_frequency(terms.tokens(test)), test)
    counts = {0: Counter("bad lamp".split()), 1: Counter("good lamp lamp good desk".split())}
    vocabulary = set(counts[0]) | set(counts[1])

    def expected(text, label):
        known = [w for w in text.split() if w in vocabulary]
        total = sum(counts[label].values()) + len(vocabulary)
        return math.log(0.5) + sum(math.log((counts[label][w] + 1) / total) for w in known)

    found = {(r["doc_id"], r["label"]): r["score"] for r in scores.collect()}
    assert found == {
        (id, label): pytest.approx(expected(text, label)) for id, text in TEST for label in (0, 1)
    }
    best = {r["doc_id"]: r["prediction"] for r in classify.best_class(scores).collect()}
    assert best == {
        id: min((0, 1), key=lambda label: (-expected(text, label), label)) for id, text in TEST
    }
    chances = {
        (r["term"], r["label"]): r["log_likelihood"]
        for r in classify.term_log_likelihood(model).collect()
    }
    assert chances[("lamp", 1)] == pytest.approx(math.log(3 / 9))
    assert ("good", 0) not in chances


def test_quality(spark):
    data = [(0, 0), (0, 1), (1, 1), (1, 1), (2, 1)]
    frame = spark.createDataFrame(data, "label int, prediction int")
    assert {tuple(r) for r in classify.confusion(frame).collect()} == {
        (0, 0, 1), (0, 1, 1), (1, 1, 2), (2, 1, 1)
    }
    quality = {r["class"]: (r["precision"], r["recall"]) for r in classify.class_quality(frame).collect()}
    assert quality == {0: (1.0, 0.5), 1: (0.5, 1.0), 2: (None, 0.0)}
    assert classify.accuracy(frame).first()[0] == pytest.approx(0.6)


def test_logistic_tells_two_topics_apart(spark):
    data = [(f"{'lamp light bulb' if i % 2 else 'desk chair wood'} w{i % 5}", i % 2) for i in range(60)]
    frame = spark.createDataFrame(data, "text string, label int")
    predicted = classify.apply_logistic(classify.train_logistic(frame, width=256), frame)
    assert classify.area_under_roc(predicted) == 1.0
    assert classify.accuracy(predicted.withColumn("prediction", F.col("prediction").cast("int"))).first()[0] == 1


def test_logistic_slopes_are_those_of_the_penalised_loss(spark):
    data = [(f"{'lamp bulb' if i % 3 else 'desk lamp'} w{i % 5} w{i % 7}", int(i % 4 > 1)) for i in range(80)]
    frame = spark.createDataFrame(data, "text string, label int").repartition(3)
    model = classify.train_logistic(frame, width=64, iterations=100)
    best = classify.logistic_slopes(model, frame).first()
    assert (best.documents, round(best.expected_ones)) == (80, 40)
    assert best.steepest < 1e-3
    early = classify.logistic_slopes(classify.train_logistic(frame, width=64, iterations=0), frame).first()
    assert early.steepest > 10 * best.steepest


def test_counted_words_need_no_shuffle(spark):
    """Words of a text are counted in its row; only ids that come again, or are null, are added up."""
    rows = [(1, "b a b. B"), (2, "a"), (2, "a c a"), (None, "x"), (None, "x y"), (3, ""), (4, None), (5, "1 2")]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    plain = terms.term_frequency(terms.tokens(frame))
    counted = terms.tokens(frame, counted=True)
    found = terms.term_frequency(counted)
    assert found.schema.simpleString() == plain.schema.simpleString()
    key = lambda row: (row[0] is None, row[0] or 0, row[1])
    assert sorted(map(tuple, found.collect()), key=key) == sorted(map(tuple, plain.collect()), key=key)
    assert {(r[0], r.alone) for r in counted.collect()} == {(1, True), (2, False), (None, False)}
    text = counted.filter("alone")._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in text
    empty = terms.term_frequency(terms.tokens(frame.limit(0), counted=True))
    assert empty.collect() == []


def test_few_sums_of_a_fit_reach_the_driver(spark):
    """The tasks' sums are added up in more steps than Spark's two, by tasks that go by size."""
    rows = [(f"word{k % 7} lamp" if k % 2 else f"word{k % 5} table", k % 2) for k in range(60)]
    frame = spark.createDataFrame(rows, "text string, label int").repartition(40)
    model = classify.train_logistic(frame, width=64, iterations=3)
    assert model.stages[-1].getAggregationDepth() >= 4
    assert classify.apply_logistic(model, frame).filter("prediction = label").count() == 60
