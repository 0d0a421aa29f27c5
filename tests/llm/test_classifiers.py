import random

import corpus
import numpy as np
import pytest

from cartledger.llm import labelled, quality, toxicity


def brute_segments(scores):
    """Maximal segments by definition: the best segment, then left and right of it."""
    if not scores or max(scores) <= 0:
        return []
    best = max(
        ((sum(scores[i:j]), -(j - i), -i, i, j) for i in range(len(scores)) for j in range(i + 1, len(scores) + 1)),
    )
    total, _, _, i, j = best
    if total <= 0:
        return []
    right = [(a + j, b + j, s) for a, b, s in brute_segments(scores[j:])]
    return [*brute_segments(scores[:i]), (i, j, total), *right]


@pytest.mark.parametrize("seed", range(30))
def test_segments_are_maximal(seed):
    rng = random.Random(seed)
    scores = [rng.choice([-3, -2, -1, 1, 2, 3]) + rng.random() * 0.01 for _ in range(rng.randint(0, 25))]
    got = toxicity.maximal_segments(scores)
    want = brute_segments(scores)
    assert [g[:2] for g in got] == [w[:2] for w in want]
    assert [g[2] for g in got] == pytest.approx([w[2] for w in want])


def test_chance_scale_solves_its_equation():
    values, share = np.array([-0.5, 5.0]), np.array([0.999, 0.001])
    x = toxicity._chance_scale(values, share)
    assert (share * np.exp(x * values)).sum() == pytest.approx(1)


@pytest.fixture(scope="module")
def tables(spark):
    folder = "/root/testdata/sf0.01"
    return spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")


@pytest.mark.parametrize("module, label, folds, held_out", [(toxicity, "toxic", 3, 1), (quality, "quality", 4, 2)])
def test_held_out_accuracy(tables, module, label, folds, held_out):
    docs, labels = tables
    rows = module.scored(docs, labels).collect()
    assert len(rows) == docs.count()
    truth = {r.doc_id: r[label] for r in labels.collect()}
    right = total = 0
    for r in rows:
        assert 0 <= r.score <= 1
        assert r.held_out == (corpus.fold(r.doc_id, folds) == held_out)
        assert r.predicted == int(r.score >= 0.7)
        if r.held_out and r.doc_id in truth:
            total += 1
            right += r.predicted == truth[r.doc_id]
    assert total > 50
    assert right / total >= 0.93


@pytest.mark.parametrize("module", [toxicity, quality])
def test_awkward_rows(spark, tables, module):
    docs = corpus.awkward_documents(spark, [(50, "you stupid idiot, " * 3, "en", "a", 1, "x", 1, 1)])
    _, labels = tables
    nulls = labels.unionByName(spark.createDataFrame([(None, 1, 1), (3, None, None), (2, 1, 0)], labels.schema))
    rows = module.scored(docs, nulls).collect()
    assert sorted(str(r.doc_id) for r in rows) == sorted(str(r.doc_id) for r in docs.collect())
    by = {}
    for r in rows:
        assert 0 <= r.score <= 1
        by.setdefault(r.doc_id, set()).add(r.score)
    assert all(len(scores) == 1 for key, scores in by.items() if key is not None)
    kept = toxicity.clean_rows(docs, nulls) if module is toxicity else quality.good_rows(docs, nulls)
    assert kept.columns == docs.columns
    assert module.scored(corpus.no_documents(spark), labels).collect() == []


def test_no_labels_and_one_kind(spark, tables):
    docs, labels = tables
    few = docs.limit(20)
    for module in (toxicity, quality):
        for some in (labels.limit(0), labels.where("quality = 1 and toxic = 0").limit(50)):
            assert len({round(r.score, 6) for r in module.scored(few, some).collect()}) == 1


def test_passages_are_where_the_words_are(tables):
    docs, labels = tables
    model = toxicity.fit(docs, labels)
    worst = max(model.words, key=model.words.get)
    spark = docs.sparkSession
    text = f"fine words here, {worst}, {worst.upper()} and more fine words"
    rows = toxicity.passages(spark.createDataFrame([(1, text), (2, None)], "doc_id long, text string"), model).collect()
    assert rows and all(worst in text[r.start : r.end].lower() and r.passage == text[r.start : r.end] for r in rows)


def test_training_labels_keep_the_fold_out_and_the_bound(spark, tables):
    _, labels = tables
    rows = labelled.training_labels(labels, "toxic", 3, 1).collect()
    assert all(corpus.fold(r.id, 3) != 1 for r in rows)
    assert 20 < labelled.training_labels(labels, "toxic", 3, 1, most=100).count() < 200


def test_additive_model_learns_an_interaction():
    rng = np.random.default_rng(1)
    x = rng.random((4000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = quality.fit(x, y)
    assert (0, 1) in model.pairs
    assert ((model.scores(x) >= 0.5) == y).mean() > 0.95
    manual = model.intercept + sum(
        t[np.searchsorted(c, x[:5, j], "right")] for j, (t, c) in enumerate(zip(model.tables, model.cuts))
    )
    for (i, j), t in zip(model.pairs, model.pair_tables):
        manual = manual + t[tuple(np.searchsorted(model.pair_cuts[k], x[:5, k], "right") for k in (i, j))]
    assert model.log_odds(x[:5]) == pytest.approx(manual)


def test_features_of_plain_cases():
    classes = quality._classes()
    assert quality.features(None, classes) == quality.features(" \n", classes) == [0.0] * len(quality.FEATURES)
    f = dict(zip(quality.FEATURES, quality.features("a | b | c!! c!! c!!\na | b", classes)))
    assert f["lone_symbols"] == pytest.approx(3 / 10) and f["repeated_next"] == pytest.approx(2 / 10)
    assert f["double_marks"] == pytest.approx(3 / 10)


def test_a_repeated_key_is_one_training_row(spark):
    docs = spark.createDataFrame([(1, f"text {i % 3}") for i in range(300)] + [(2, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 1)], "id long, label int")
    from cartledger.llm.labelled import with_labels

    rows = with_labels(docs, labels).collect()
    assert sorted(r.id for r in rows) == [1, 2] and {r.label for r in rows} == {0, 1}
    assert with_labels(docs.repartition(9), labels).where("id = 1").first().text == next(r.text for r in rows if r.id == 1)


def test_classifiers_on_an_empty_table(spark):
    labels = spark.createDataFrame([(1, 1, 1)], "doc_id long, quality int, toxic int")
    from cartledger.llm import quality, toxicity

    none = spark.createDataFrame([], "doc_id long, text string, score double, Text_ int")
    for rows in (toxicity.clean_rows(none, labels), quality.good_rows(none, labels)):
        assert rows.columns == none.columns and rows.collect() == []
