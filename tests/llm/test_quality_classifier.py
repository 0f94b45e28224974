from __future__ import annotations

import random

import numpy as np
import pytest

from corpuslab.llm import quality
from corpuslab.llm.quality import FEATURES, Featurizer, OrdinalModel, fit_ratings, grade_documents, loss_and_gradient, select_documents

SCHEMA = "doc_id long, text string, kept string, tail int, row string"
WORDS = [f"word{k}" for k in range(400)]


def make(rng, grade):
    tokens = [rng.choice(WORDS) for _ in range(rng.randrange(20, 120))]
    if grade == 1:
        tokens = [t + "%%%" for t in tokens]
    if grade == 0:
        tokens.insert(rng.randrange(len(tokens)), rng.choice(["insulta", "insultb"]))
    return " ".join(tokens)


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1, "r") for i, t in rows], SCHEMA)


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(0)
    grades = [rng.choice([0, 1, 2, 2, 2]) for _ in range(900)]
    return [(k, make(rng, g)) for k, g in enumerate(grades)], grades


@pytest.fixture(scope="module")
def model(spark, corpus):
    rows, grades = corpus
    labels = spark.createDataFrame(
        [(k, int(g != 1), int(g == 0)) for k, g in enumerate(grades) if k < 600] + [(None, 1, 0), (5000, 1, 0), (1, None, None)],
        "doc_id long, quality int, toxic int",
    )
    return fit_ratings(frame(spark, rows), labels)


def test_gradient_is_the_slope():
    rng = np.random.default_rng(0)
    rows = rng.integers(0, 4, 30), np.full(30, 5), rng.integers(0, 50, 150), rng.normal(size=150)
    theta = np.concatenate([rng.normal(size=50) * 0.1, [-1.0, 0.2, -0.3]])
    _, gradient = loss_and_gradient(theta, *rows, 4)
    for k in range(53):
        step = np.zeros(len(theta))
        step[k] = 1e-6
        slope = (loss_and_gradient(theta + step, *rows, 4)[0] - loss_and_gradient(theta - step, *rows, 4)[0]) / 2e-6
        assert abs(slope - gradient[k]) < 1e-4


def test_held_out_rows_are_graded_right(spark, corpus, model):
    rows, grades = corpus
    assert model.grades == [0, 1, 2] and model.thresholds[0] < model.thresholds[1]
    got = grade_documents(frame(spark, rows[600:]), model, 2).select("row.doc_id", "expected_grade", "tail", "kept").collect()
    assert len(got) == 300
    kept = {g: [r.kept for r in got if grades[r.doc_id] == g] for g in (0, 1, 2)}
    assert sum(kept[2]) >= 0.97 * len(kept[2])
    right = len(got) - sum(kept[0]) - sum(kept[1]) - (len(kept[2]) - sum(kept[2]))
    assert right >= 0.9 * len(got)  # from six hundred ratings
    assert all(0 <= r.tail <= 1 and 0 <= r.expected_grade <= 2 for r in got)


def test_expected_grade_and_tail_by_hand():
    m = OrdinalModel(np.zeros(FEATURES), np.array([-1.0, 1.0]), [0, 1, 2])
    tails = m.tails(np.array([0.0]))
    assert np.allclose(tails, [[1 / (1 + np.exp(-1)), 1 / (1 + np.exp(1))]])


def test_odd_texts_have_a_result(spark, model):
    rows = [(1, None), (1, None), (2, ""), (3, " \n "), (None, "word1 word2"), (4, "w " * 200_000), (5, "x" * 100_000), (6, "日本 語")]
    got = grade_documents(frame(spark, rows), model, 2).collect()
    assert len(got) == len(rows) and all(r.kept is not None for r in got)
    empty = {r.tail for r in got if not (r.text or "").strip()}
    assert len(empty) == 1


def test_selection_keeps_columns_and_needs_ratings(spark, corpus):
    rows, _ = corpus
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    left = select_documents(frame(spark, rows), none)
    assert left.columns == ["doc_id", "text", "kept", "tail", "row"] and left.count() == len(rows)
    one = spark.createDataFrame([(1, 1, 0), (2, 1, 0)], "doc_id long, quality int, toxic int")
    assert select_documents(frame(spark, rows), one).count() == len(rows)
    assert select_documents(frame(spark, []), one).collect() == []


def test_drawn_sample_is_bounded(spark):
    rated = spark.range(20_000).selectExpr("id AS key", "CAST(id % 50 = 0 AS INT) AS grade")
    drawn = quality.draw(rated, "key", max_rows=1000).groupBy("grade").count().collect()
    sizes = {r["grade"]: r["count"] for r in drawn}
    assert sizes[1] == 400 and 400 < sizes[0] < 600


def test_features_do_not_depend_on_order():
    make_features = Featurizer()
    a, b = make_features("Alpha beta, beta!! 12"), Featurizer()("Alpha beta, beta!! 12")
    assert (a[0] == b[0]).all() and (a[1] == b[1]).all()
