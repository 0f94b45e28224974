"""Classifiers on shared features: train, predict, score, keep."""

from __future__ import annotations

import time
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from typing import Any

from pyspark.ml import Estimator, Model
from pyspark.ml.classification import (
    GBTClassifier,
    LogisticRegression,
    MultilayerPerceptronClassifier,
    NaiveBayes,
    OneVsRest,
    RandomForestClassifier,
)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuslab.functions.columns import throughput
from corpuslab.functions.labels import decode, encode
from corpuslab.operators.evaluate import confusion_matrix, metric_rows
from corpuslab.operators.forest import MAX_DIM, DeepForest
from corpuslab.operators.linear import LinearOneVsRest
from corpuslab.session import collect_bounded

# Settings of each kind, any of which a caller may replace.
DEFAULTS: dict[str, dict[str, Any]] = {
    "logistic": {"C": 1.0, "max_iter": 2000},
    "logistic_ovr": {"C": 1.0, "max_iter": 2000},
    "svm": {"C": 1.0, "max_iter": 5000},
    "nb": {"alpha": 1.0},
    "random_forest": {"trees": 300, "max_depth": 30},
    "gbt": {"rounds": 300, "learning_rate": 0.1, "max_depth": 6, "subsample": 0.85},
    "mlp": {"hidden": (256, 128), "max_iter": 50, "learning_rate": 0.001},
}
MAX_CLASSES = 10_000
PARALLEL_FITS = 4
SHALLOW = 10  # depth of a forest up to which a histogram of every node is small enough
ROWS_PER_TASK = 1024  # training rows that are worth a task of their own once every core has one

LABEL, WEIGHT = "label_index", "class_weight"


def build_classifier(
    kind: str, n_rows: int, n_classes: int, dim: int, params: Mapping[str, Any] | None = None,
    balanced: bool = False, seed: int = 42,
) -> Estimator:
    """Estimator of a kind.  ``C`` is turned into Spark's mean-loss penalty."""
    if kind not in DEFAULTS:
        raise ValueError(f"unknown classifier: {kind}")
    p = dict(DEFAULTS[kind])
    unknown = set(params or {}) - set(p)
    if unknown:
        raise ValueError(f"unknown settings for {kind}: {', '.join(sorted(unknown))}")
    p.update(params or {})
    common = {"featuresCol": "features", "labelCol": LABEL}
    if balanced and kind not in ("nb", "mlp"):
        common["weightCol"] = WEIGHT

    def one_vs_rest(binary: Estimator) -> OneVsRest:
        outer = {"weightCol": WEIGHT} if "weightCol" in common else {}
        return OneVsRest(classifier=binary, featuresCol="features", labelCol=LABEL, parallelism=4, **outer)

    if kind == "logistic":
        return LogisticRegression(
            family="multinomial", regParam=1 / (p["C"] * n_rows), elasticNetParam=0.0, maxIter=p["max_iter"], **common
        )
    if kind in ("logistic_ovr", "svm"):
        return LinearOneVsRest(
            "squared_hinge" if kind == "svm" else "logistic", n_classes, p["C"], p["max_iter"], label=LABEL,
            weight=common.get("weightCol"),
        )
    if kind == "nb":
        return NaiveBayes(modelType="multinomial", smoothing=p["alpha"], **common)
    if kind == "random_forest":
        if p["max_depth"] > SHALLOW and dim <= MAX_DIM:
            return DeepForest(p["trees"], p["max_depth"], n_classes, label=LABEL, weight=common.get("weightCol"), seed=seed)
        return RandomForestClassifier(
            numTrees=p["trees"], maxDepth=p["max_depth"], seed=seed, featureSubsetStrategy="sqrt", **common
        )
    if kind == "gbt":
        return one_vs_rest(
            GBTClassifier(
                maxIter=p["rounds"], stepSize=p["learning_rate"], maxDepth=p["max_depth"],
                subsamplingRate=p["subsample"], seed=seed,
            )
        )
    return MultilayerPerceptronClassifier(
        layers=[dim, *p["hidden"], n_classes], maxIter=p["max_iter"], stepSize=p["learning_rate"], seed=seed, **common
    )


@dataclass
class Trained:
    """A fitted model and what is known about it."""

    model: Model
    kind: str
    target: str
    label_source: str
    classes: list[str]
    n_rows: int
    dim: int
    seconds: float

    @property
    def key(self) -> str:
        return f"{self.target}-{self.label_source}-{self.kind}"

    def summary(self) -> dict[str, Any]:
        return {
            "target": self.target, "label_source": self.label_source, "model": self.kind,
            "rows": self.n_rows, "features": self.dim, "n_classes": len(self.classes),
            "classes": self.classes, "training_seconds": self.seconds,
        }


SUMMARY_SCHEMA = (
    "target string, label_source string, model string, rows long, features long, n_classes long, "
    "classes array<string>, training_seconds double"
)


@dataclass
class Prepared:
    """Cached training rows ``(features, label_index[, class_weight])`` of one condition."""

    data: DataFrame
    classes: list[str]
    n_rows: int
    dim: int


def prepare(
    features: DataFrame, labels: DataFrame, *, id: str = "id", label: str = "label", balanced: bool = False
) -> Prepared:
    """Join features with labels once, for all models of a condition.

    Classes and weights come from the joined rows alone: labels of rows without
    features, such as test rows, define no class.  Rows without a label are left
    out.  The joined rows are cached with spill to disk; call
    ``data.unpersist()`` after the last fit.
    """
    known = labels.select(id, F.col(label).alias("_label")).filter(F.col("_label").isNotNull())
    joined = features.select(id, "features").join(known, id).persist()
    counts = joined.groupBy("_label").agg(F.count(F.lit(1)).alias("n"))
    sizes = dict(collect_bounded(counts, MAX_CLASSES, "label counts"))
    classes = sorted(sizes)
    if len(classes) < 2:
        joined.unpersist()
        raise ValueError("a target needs at least two classes")
    rows = joined.withColumn(LABEL, encode("_label", classes).cast("double"))
    columns = ["features", LABEL]
    if balanced:
        total = sum(sizes[c] for c in classes)
        weights = {c: total / (len(classes) * sizes[c]) for c in classes}
        pairs = [F.lit(x) for kv in weights.items() for x in kv]
        rows = rows.withColumn(WEIGHT, F.element_at(F.create_map(*pairs), F.col("_label")))
        columns.append(WEIGHT)
    tasks = max(joined.sparkSession.sparkContext.defaultParallelism, -(-sum(sizes.values()) // ROWS_PER_TASK))
    data = rows.select(*columns).coalesce(tasks).persist()
    prepared = Prepared(data, classes, data.count(), _dimension(data))
    joined.unpersist()
    return prepared


def fit_one(prepared: Prepared, kind: str, *, target: str, label_source: str, balanced: bool = False,
            params: Mapping[str, Any] | None = None, seed: int = 42) -> Trained:
    """Fit and time one model; it must have learned every class."""
    classes = prepared.classes
    estimator = build_classifier(kind, prepared.n_rows, len(classes), prepared.dim, params, balanced, seed)
    start = time.perf_counter()
    model = estimator.fit(prepared.data)
    seconds = time.perf_counter() - start
    learned = getattr(model, "numClasses", None)
    if learned is None:
        learned = len(model.models)
    if learned != len(classes):
        raise ValueError(f"{kind} learned {learned} of {len(classes)} classes")
    return Trained(model, kind, target, label_source, classes, prepared.n_rows, prepared.dim, seconds)


def train_one(
    features: DataFrame, labels: DataFrame, kind: str, *, target: str, label_source: str, id: str = "id",
    label: str = "label", balanced: bool = False, params: Mapping[str, Any] | None = None, seed: int = 42,
) -> Trained:
    """Fit one model on ``(id, features)`` joined with ``(id, label)``."""
    prepared = prepare(features, labels, id=id, label=label, balanced=balanced)
    try:
        return fit_one(prepared, kind, target=target, label_source=label_source, balanced=balanced,
                       params=params, seed=seed)
    finally:
        prepared.data.unpersist()


def _dimension(features: DataFrame) -> int:
    first = features.select("features").first()
    if first is None:
        raise ValueError("no feature rows")
    return first[0].size


def run_grid(
    features: DataFrame, labels: DataFrame, models: Mapping[str, Mapping[str, Any]], *, id: str = "id",
    balanced: bool = False, seed: int = 42,
) -> list[Trained]:
    """All models on all targets and label sources over one feature table.

    The models of a condition share its cached rows and are fitted side by side,
    so a model's seconds hold time in which it waited for the others.

    ``labels`` is long: ``(id, target, label_source, label)``.
    """
    experiments = labels.select("target", "label_source").distinct().orderBy("target", "label_source")
    trained = []
    for target, source in collect_bounded(experiments, 1000, "experiments"):
        mine = labels.filter((F.col("target") == target) & (F.col("label_source") == source))
        prepared = prepare(features, mine, id=id, balanced=balanced)

        def fit(kind: str) -> Trained:
            return fit_one(prepared, kind, target=target, label_source=source, balanced=balanced,
                           params=models[kind], seed=seed)

        try:
            with ThreadPoolExecutor(max(1, min(PARALLEL_FITS, len(models)))) as pool:
                trained += pool.map(fit, models)
        finally:
            prepared.data.unpersist()
    return trained


def training_summary(spark, trained: Sequence[Trained]) -> DataFrame:
    rows = [t.summary() for t in trained]
    return spark.createDataFrame(rows, SUMMARY_SCHEMA)


def predict(trained: Trained, features: DataFrame, id: str = "id") -> DataFrame:
    """Decoded predictions ``(id, target, label_source, model, predicted)``."""
    out = trained.model.transform(features)
    return out.select(
        id,
        F.lit(trained.target).alias("target"),
        F.lit(trained.label_source).alias("label_source"),
        F.lit(trained.kind).alias("model"),
        decode("prediction", trained.classes).alias("predicted"),
    )


EXPERIMENT = ("target", "label_source", "model")


def predict_all(trained: Sequence[Trained], features: DataFrame, truth: DataFrame, id: str = "id") -> DataFrame:
    """Predictions of all models with the true label ``(id, target, label)``."""
    out, columns = features.select(id, "features"), []
    for n, t in enumerate(trained):  # one scan: every model adds a column
        model = t.model.copy()
        model.setPredictionCol(f"_p{n}")
        kept = out.columns
        out = model.transform(out).select(*kept, f"_p{n}")
        columns.append(
            F.struct(
                F.lit(t.target).alias("target"), F.lit(t.label_source).alias("label_source"), F.lit(t.kind).alias("model"),
                decode(f"_p{n}", t.classes).alias("predicted"),
            )
        )
    predictions = out.select(id, F.inline(F.array(*columns)))
    return predictions.join(truth.select(id, "target", F.col("label").alias("actual")), [id, "target"])


def evaluate_models(
    trained: Sequence[Trained], features: DataFrame, truth: DataFrame, id: str = "id",
    class_domain: str = "observed",
) -> DataFrame:
    """Long metric rows of all models from one grouped count of predictions."""
    confusion = confusion_matrix(predict_all(trained, features, truth, id), "actual", "predicted", EXPERIMENT)
    if class_domain == "observed":
        return metric_rows(confusion, EXPERIMENT)
    rows = [(t.target, t.label_source, t.kind, c) for t in trained for c in t.classes]
    domain = confusion.sparkSession.createDataFrame(
        rows, "target string, label_source string, model string, label string"
    )
    return metric_rows(confusion, EXPERIMENT, class_domain, domain)


def timed_predictions(trained: Trained, features: DataFrame) -> dict[str, float | None]:
    """Rows, seconds and rows per second of one full prediction pass."""
    start = time.perf_counter()
    rows = trained.model.transform(features).agg(F.count("prediction")).first()[0]
    seconds = time.perf_counter() - start
    return {"rows": rows, "seconds": seconds, "rows_per_second": rows / seconds if seconds else None}


def with_throughput(df: DataFrame, rows: str = "rows", seconds: str = "seconds") -> DataFrame:
    return df.withColumn("rows_per_second", throughput(rows, seconds))
