from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from corpuslab.operators import classifiers as cl
from corpuslab.operators import forest as fo
from corpuslab.session import scratch_path


def _rows(spark, n, dim, classes, seed=0):
    rng = np.random.default_rng(seed)
    x, y = rng.normal(size=(n, dim)), rng.integers(0, classes, n)
    rows = [(i, Vectors.dense(x[i]), float(y[i]), 1.0 + i % 3) for i in range(n)]
    return spark.createDataFrame(rows, ["id", "features", "label", "w"])


def _predicted(model, df):
    return {r["id"]: r["prediction"] for r in model.transform(df).select("id", "prediction").collect()}


def test_a_deep_forest_needs_few_jobs(spark):
    df = _rows(spark, 600, 9, 4)
    labels = df.select("id", F.concat(F.lit("c"), F.col("label").cast("int").cast("string")).alias("label"))
    spark.sparkContext.setJobGroup("deep-forest", "jobs of a deep forest")
    try:
        one = cl.train_one(df.select("id", "features"), labels, "random_forest", target="t", label_source="real",
                           params={"trees": 40, "max_depth": 30})
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("deep-forest")) < 25  # a fit by level needs one or two a level
    right = cl.predict(one, df).join(labels, "id").agg(F.avg((F.col("predicted") == F.col("label")).cast("double"))).first()[0]
    assert one.model.subtrees.count() == 40 and right > 0.99


def _impurity(label, weight):
    mass = np.bincount(label, weight)
    return mass.sum() - (mass**2).sum() / mass.sum()


def test_every_split_is_the_best_one():
    rng = np.random.default_rng(5)
    bins, label = rng.integers(0, 6, (200, 3)).astype(np.uint8), rng.integers(0, 4, 200).astype(np.int32)
    weight = rng.integers(1, 4, 200) * 0.7
    tree = fo.grow(bins, label, weight, 30, 3, rng)
    start = np.cumsum(tree["votes"]) - tree["votes"]
    seen, left = 0, [(0, np.arange(200), 0)]
    while left:
        node, rows, level = left.pop()
        seen += 1
        now = _impurity(label[rows], weight[rows])
        every = {}
        for f in range(3):
            for c in range(5):
                side = bins[rows, f] <= c
                if 0 < side.sum() < len(rows):
                    every[f, c] = now - _impurity(label[rows[side]], weight[rows[side]]) - _impurity(label[rows[~side]], weight[rows[~side]])
        f, c = int(tree["feature"][node]), int(tree["cut"][node])
        if f < 0:
            assert max(every.values(), default=0.0) < 1e-6
            at = slice(start[node], start[node] + tree["votes"][node])
            mass = np.bincount(label[rows], weight[rows])
            assert tree["class"][at].tolist() == np.flatnonzero(mass).tolist()
            assert np.allclose(tree["share"][at], mass[mass > 0] / mass.sum())
            continue
        assert every[f, c] == pytest.approx(max(every.values())) and every[f, c] > 0
        side = bins[rows, f] <= c
        left += [(tree["child"][node], rows[side], level + 1), (tree["child"][node] + 1, rows[~side], level + 1)]
    assert seen == len(tree["feature"])
    for depth in (0, 1, 3):
        assert len(fo.grow(bins, label, weight, depth, 3, rng)["feature"]) <= 2 ** (depth + 1) - 1


def test_passes_and_tasks_split_alike(spark):
    df = _rows(spark, 500, 1, 3).repartition(5)
    whole, low = (fo.DeepForest(1, 12, 3, weight="w", task_rows=n).fit(df) for n in (1 << 15, 20))
    assert [len(m.splits[0][0]) for m in (whole,)] == [1] and len(low.splits[0][0]) > 10
    assert _predicted(whole, df) == _predicted(low, df)
    shallow = [fo.DeepForest(1, 3, 3, task_rows=n).fit(df) for n in (1 << 15, 20)]
    assert _predicted(shallow[0], df) == _predicted(shallow[1], df)


def test_draws_are_poisson_and_the_same_in_every_pass():
    rows = np.arange(100_000)
    times = fo._bag(42, 3, rows, 300)
    assert abs(times.mean() - 1) < 0.02 and abs((times == 0).mean() - np.exp(-1)) < 0.01
    assert (fo._bag(42, 3, rows[7:9], 300) == times[7:9]).all() and (fo._bag(42, 4, rows, 300) != times).any()
    assert abs(np.corrcoef(times, fo._bag(42, 4, rows, 300))[0, 1]) < 0.02
    assert (fo._bag(42, 0, rows[:5], 1) == 1).all()


def test_saved_forest_predicts_the_same_for_every_row(spark, monkeypatch):
    df = _rows(spark, 300, 4, 3)
    model, path = fo.DeepForest(7, 20, 3, task_rows=50).fit(df), scratch_path(spark, "forest-model")
    model.write().save(path)
    before, loaded = _predicted(model, df), fo.DeepForestModel.load(path)
    assert loaded.numClasses == 3 and len(before) == 300
    monkeypatch.setattr(fo, "TILE_ROWS", 64)
    assert _predicted(loaded, df) == before
    twice = loaded.transform(df.union(df))
    assert twice.columns == [*df.columns, "prediction"] and twice.filter("prediction is null").count() == 0
    assert twice.count() == 600 and loaded.transform(df.limit(0)).count() == 0


def test_odd_tables(spark):
    same = spark.createDataFrame([(i, Vectors.dense([1.0, 1.0]), float(i % 3 == 0)) for i in range(30)], ["id", "features", "label"])
    assert set(_predicted(fo.DeepForest(5, 30, 2, task_rows=3).fit(same), same).values()) == {0.0}
    sparse = spark.createDataFrame([(i, Vectors.sparse(5, [i % 5], [1.0]), float(i % 5)) for i in range(50)], ["id", "features", "label"])
    assert _predicted(fo.DeepForest(30, 30, 5).fit(sparse), sparse) == {i: float(i % 5) for i in range(50)}
    with pytest.raises(ValueError, match="no training rows"):
        fo.DeepForest(2, 20, 2).fit(same.limit(0))
    with pytest.raises(ValueError, match="bound"):
        fo.DeepForest(2, 20, 2).fit(spark.createDataFrame([(Vectors.sparse(5000, [1], [1.0]), 0.0)], ["features", "label"]))
