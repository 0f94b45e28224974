from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml.linalg import Vectors

from corpuslab.operators.linear import LinearOneVsRest, LinearOneVsRestModel
from corpuslab.operators.passes import MAX_NUMBERS, SLICE, Block, blocks, packed_rows, sum_packed, sum_pass, vector_columns
from corpuslab.session import scratch_path


def _rows(n=240, dim=5, classes=3):
    random = np.random.default_rng(7)
    x = random.normal(size=(n, dim)) * (random.random((n, dim)) < 0.6)
    y = (x @ random.normal(size=(dim, classes)) + 0.3 * random.normal(size=(n, classes))).argmax(axis=1)
    return x, y


def _objective(loss, x, sign, mass, w):
    margin = sign * (x @ w[:-1] + w[-1])
    each = np.maximum(0, 1 - margin) ** 2 if loss == "squared_hinge" else np.logaddexp(0, -margin)
    return w @ w / 2 + (mass * each).sum()


def _descend(loss, x, sign, mass, steps=6000):
    """Plain gradient descent with a step below the inverse of the curvature's bound."""
    full = np.c_[x, np.ones(len(x))]
    rate = 1 / (1 + 2 * np.linalg.norm(full * np.sqrt(mass)[:, None], 2) ** 2)
    w = np.zeros(full.shape[1])
    for _ in range(steps):
        margin = sign * (full @ w)
        slope = -2 * np.maximum(0, 1 - margin) if loss == "squared_hinge" else -1 / (1 + np.exp(margin))
        w = w - rate * (w + full.T @ (mass * sign * slope))
    return w


@pytest.mark.parametrize("loss", ["logistic", "squared_hinge"])
def test_every_class_reaches_its_minimum(spark, loss):
    x, y = _rows()
    weight = np.array([1.0, 2.5, 0.5])[y]
    sparse = [Vectors.sparse(5, np.flatnonzero(v).tolist(), v[v != 0].tolist()) if k % 2 else Vectors.dense(v)
              for k, v in enumerate(x)]
    df = spark.createDataFrame([(v, float(c), float(m)) for v, c, m in zip(sparse, y, weight)], ["features", "label", "w"])
    model = LinearOneVsRest(loss, 3, C=0.7, weight="w").fit(df.repartition(5))
    for k in range(3):
        sign, mass = np.where(y == k, 1.0, -1.0), 0.7 * np.where(y == k, weight, 1.0)
        best = _objective(loss, x, sign, mass, _descend(loss, x, sign, mass))
        assert _objective(loss, x, sign, mass, model.weights[:, k]) == pytest.approx(best, rel=1e-6)
        assert model.objective[k] == pytest.approx(best, rel=1e-6)
    margins = x @ model.weights[:-1] + model.weights[-1]
    got = [r["prediction"] for r in model.transform(df).collect()]
    assert got == margins.argmax(axis=1).tolist()


def test_one_pass_serves_all_classes(spark):
    x, y = _rows(classes=4)
    df = spark.createDataFrame([(Vectors.dense(v), float(c)) for v, c in zip(x, y)], ["features", "label"])
    four = LinearOneVsRest("logistic", 4).fit(df)
    assert four.passes < 60 and four.numClasses == 4
    again = LinearOneVsRest("logistic", 4).fit(df.repartition(7))
    assert np.allclose(four.weights, again.weights, atol=1e-6)


def test_two_classes_mirror_each_other(spark):
    x, y = _rows(classes=2)
    df = spark.createDataFrame([(Vectors.dense(v), float(c), 1.0 + float(c)) for v, c in zip(x, y)], ["features", "label", "w"])
    w = LinearOneVsRest("squared_hinge", 2, weight="w").fit(df).weights
    assert np.allclose(w[:, 0], -w[:, 1], atol=1e-9)


def test_empty_vectors_empty_table_and_repeated_rows(spark):
    empty = Vectors.sparse(3, [], [])
    rows = [(empty, 0.0)] * 9 + [(Vectors.sparse(3, [1], [2.0]), 1.0)] * 4
    df = spark.createDataFrame(rows, ["features", "label"])
    model = LinearOneVsRest("logistic", 2, C=10.0).fit(df)
    assert {(r["label"], r["prediction"]) for r in model.transform(df).collect()} == {(0.0, 0.0), (1.0, 1.0)}
    with pytest.raises(ValueError, match="no training rows"):
        LinearOneVsRest("logistic", 2).fit(df.limit(0))
    with pytest.raises(ValueError, match="unknown loss"):
        LinearOneVsRest("hinge", 2)


def test_saved_model_predicts_the_same(spark):
    x, y = _rows()
    df = spark.createDataFrame([(Vectors.dense(v), float(c)) for v, c in zip(x, y)], ["features", "label"])
    model, path = LinearOneVsRest("logistic", 3).fit(df), scratch_path(spark, "linear")
    model.write().overwrite().save(path)
    loaded = LinearOneVsRestModel.load(path)
    assert np.array_equal(loaded.weights, model.weights)
    assert loaded.transform(df).collect() == model.transform(df).collect()


def test_sums_are_the_same_with_and_without_a_shuffle(spark):
    size = 3 * SLICE + 5
    df = spark.range(0, 1000, 1, 6)

    def add(batch, state, total):
        for v in batch.column(0).to_pylist():
            total[(v * state) % size] += v

    want = np.zeros(size)
    np.add.at(want, np.arange(1000) * 131 % size, np.arange(1000))
    assert np.array_equal(sum_pass(df, 131, size, add, direct=0), want)
    assert np.array_equal(sum_pass(df, 131, size, add, direct=10**9), want)
    with pytest.raises(ValueError, match="above the bound"):
        sum_pass(df, 131, MAX_NUMBERS + 1, add)


def test_products_with_sparse_rows_need_one_number_per_entry():
    """The product is taken class by class, so an entry never becomes a row of numbers."""
    random = np.random.default_rng(8)
    index, value, counts = random.integers(0, 9, 12), random.random(12), np.array([5, 0, 7])
    block, weights = Block(index, value, counts), random.random((9, 3))
    dense = np.zeros((3, 9))
    np.add.at(dense, (np.repeat(np.arange(3), counts), index), value)
    assert np.allclose(block.times(weights), dense @ weights)
    assert block.by_row(value).shape == (3,)
    batch = pa.RecordBatch.from_arrays(
        [pa.array([[0], [1], [2]], pa.list_(pa.int32())), pa.array([[1.0], [2.0], [3.0]])], names=["_index", "_value"]
    )
    assert [b.n for _, b in blocks(batch, entries=1)] == [1, 1, 1] and [b.n for _, b in blocks(batch)] == [3]


@pytest.mark.parametrize("loss", ["logistic", "squared_hinge"])
def test_rare_and_frequent_features_settle_alike(spark, loss):
    random = np.random.default_rng(9)
    x = random.random((1500, 60)) * (random.random((1500, 60)) < 0.8 ** np.arange(60) + 0.004)
    y = (x @ random.normal(size=60) + 0.2 * random.normal(size=1500) > 0).astype(int)
    rows = [(Vectors.sparse(60, np.flatnonzero(v).tolist(), v[v != 0].tolist()), float(c)) for v, c in zip(x, y)]
    model = LinearOneVsRest(loss, 2, C=20.0).fit(spark.createDataFrame(rows, ["features", "label"]))
    sign, mass = np.where(y == 1, 1.0, -1.0), np.full(len(y), 20.0)
    assert model.passes < 45  # 67 and 147 with one step length for all features
    assert model.objective[1] == pytest.approx(_objective(loss, x, sign, mass, model.weights[:, 1]), rel=1e-9)


def test_packed_rows_give_the_same_sums(spark):
    x, _ = _rows()
    rows = [(k, Vectors.dense(v) if k % 3 else Vectors.sparse(5, np.flatnonzero(v).tolist(), v[v != 0].tolist())) for k, v in enumerate(x)]
    df = spark.createDataFrame(rows, ["id", "features"]).repartition(5)
    packed = packed_rows(df.select("id", *vector_columns("features")), ["id"])
    weight = np.arange(1.0, 1.0 + len(x))

    def add(block, numbers, state, total):
        block.add_transposed(state[numbers[0]][:, None], total[:5].reshape(5, 1))
        block.add_squares(state[numbers[0]][:, None], total[-5:].reshape(5, 1))

    for size in (10, 2 * SLICE + 3):
        for direct in (0, 10**9):
            got = sum_packed(packed, weight, size, add, direct=direct)
            assert np.allclose(got[:5], weight @ x) and np.allclose(got[-5:], weight @ (x * x))
    with pytest.raises(ValueError, match="above the bound"):
        sum_packed(packed, weight, MAX_NUMBERS + 1, add)
    packed.unpersist()
