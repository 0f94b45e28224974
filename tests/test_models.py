from __future__ import annotations

import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from corpuslab.operators import classifiers as cl
from corpuslab.operators import compare as cmp
from corpuslab.session import scratch_path
from corpuslab.sources import registry as rg


@pytest.fixture(scope="module")
def data(spark):
    rows = [(i, Vectors.dense([float(i % 3 == 0), float(i % 3 == 1), float(i % 3 == 2)]), "abc"[i % 3]) for i in range(60)]
    df = spark.createDataFrame(rows, ["id", "features", "label"])
    labels = df.select("id", F.lit("t").alias("target"), F.lit("real").alias("label_source"), "label")
    return df.select("id", "features"), labels


SMALL = {
    "logistic": {"max_iter": 20}, "logistic_ovr": {"max_iter": 20}, "svm": {"max_iter": 20}, "nb": {},
    "random_forest": {"trees": 5, "max_depth": 4}, "gbt": {"rounds": 2, "max_depth": 2},
    "mlp": {"hidden": (6,), "max_iter": 60},
}


def test_every_kind_learns_a_separable_target(spark, data):
    features, labels = data
    trained = cl.run_grid(features, labels, SMALL)
    rows = cl.evaluate_models(trained, features, labels, class_domain="with_training").filter("metric_scope = 'overall'")
    got = {r["model"]: r["accuracy"] for r in rows.collect()}
    assert set(got) == set(SMALL) and min(got.values()) == 1.0
    summary = cl.training_summary(spark, trained)
    assert summary.count() == len(SMALL) and summary.first()["classes"] == ["a", "b", "c"]


def test_few_rows_lie_in_few_partitions(spark, data):
    features, labels = data
    cores = spark.sparkContext.defaultParallelism
    few = cl.prepare(features.repartition(8 * cores, "id"), labels)
    assert few.data.rdd.getNumPartitions() <= cores and few.n_rows == few.data.count() == 60
    few.data.unpersist()


def test_registry_round_trip(spark, data):
    features, labels = data
    root = scratch_path(spark, "models")
    for kind in ("svm", "logistic"):
        one = cl.train_one(features, labels, kind, target="t", label_source="real", balanced=True, params=SMALL[kind])
        rg.save_model(spark, one, root, {"source": "test"})
    loaded = rg.load_model(spark, root, "t-real-svm", 3)
    assert cl.predict(loaded, features).groupBy("predicted").count().count() == 3
    with pytest.raises(KeyError):
        rg.load_model(spark, root, "nothing")
    with pytest.raises(ValueError):
        rg.load_model(spark, root, "t-real-svm", 4)
    assert cl.timed_predictions(loaded, features)["rows"] == 60


def test_wrong_settings_are_errors():
    with pytest.raises(ValueError, match="unknown classifier"):
        cl.build_classifier("tree", 1, 2, 3)
    with pytest.raises(ValueError, match="unknown settings"):
        cl.build_classifier("nb", 1, 2, 3, {"beta": 1})


def test_comparison_of_aliased_tables(spark):
    a = spark.createDataFrame([("Category", "Original labels", "LR", "0.8", "0.7", "0.75"), ("Category", "AI", "LR", "0.5", "0.5", "0.5"),
                               ("Category", "AI", "NB", "0.5", "0.5", "0.5")],
                              ["Task", "training labels", "Classifier", "acc", "F1 macro", "weighted_f1"])
    b = spark.createDataFrame([("category_label", "human", "lr", 0.9, 0.7, 0.7), ("category", "llm", "lr", 0.5, 0.4, 0.6)],
                              ["target", "label_source", "model", "accuracy", "macro_f1", "weighted_f1"])
    assert rg.has_comparison_schema(a) and not rg.has_comparison_schema(a.drop("acc"))
    with pytest.raises(ValueError):
        rg.register_metrics({"x": a.drop("acc")})
    every = cmp.prepare_results(rg.register_metrics({"sparse": a, "dense": b.withColumns({m: F.col(m).cast("string") for m in cmp.METRICS})}))
    got = {r["label_source"]: r for r in cmp.compare_representations(every, "sparse", "dense").collect()}
    assert set(got) == {"real", "llm"}
    assert got["real"]["accuracy_winner"] == "dense" and got["real"]["macro_f1_winner"] == "Tie"
    assert got["llm"]["macro_f1_difference"] == pytest.approx(-0.1) and got["llm"]["macro_f1_winner"] == "sparse"
    best = {(r["label_source"], r["representation"]): r["model"] for r in cmp.best_models(every).collect()}
    assert best[("llm", "sparse")] == "logistic"  # a full tie goes to the first name
    twice = every.unionByName(every.filter("representation = 'dense'"))
    with pytest.raises(Exception, match="experiment occurs twice"):
        cmp.compare_representations(twice, "sparse", "dense").collect()
