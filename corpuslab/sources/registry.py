"""Fitted models and metric tables, kept with their provenance."""

from __future__ import annotations

from collections.abc import Mapping
from importlib import import_module

from pyspark.ml import Model
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuslab.functions.columns import normalize_columns
from corpuslab.operators.classifiers import Trained
from corpuslab.operators.sets import latest, union_all

REGISTRY_SCHEMA = (
    "key string, kind string, class_name string, target string, label_source string, classes array<string>, "
    "n_rows long, dim long, seconds double, meta map<string,string>, saved_at timestamp"
)


def save_model(spark: SparkSession, trained: Trained, root: str, meta: Mapping[str, str] | None = None) -> str:
    """Write the model below ``root`` and append its registry row."""
    kind = type(trained.model)
    trained.model.write().overwrite().save(f"{root}/models/{trained.key}")
    row = (
        trained.key, trained.kind, f"{kind.__module__}.{kind.__name__}", trained.target, trained.label_source,
        trained.classes, trained.n_rows, trained.dim, trained.seconds, dict(meta or {}), None,
    )
    rows = spark.createDataFrame([row], REGISTRY_SCHEMA).withColumn("saved_at", F.current_timestamp())
    rows.write.mode("append").parquet(f"{root}/registry")
    return trained.key


def registry(spark: SparkSession, root: str) -> DataFrame:
    """The last row of every saved model."""
    return latest(spark.read.schema(REGISTRY_SCHEMA).parquet(f"{root}/registry"), "key", ["saved_at"])


def load_model(spark: SparkSession, root: str, key: str, dim: int | None = None) -> Trained:
    """A saved model; an unknown key or another feature size is an error."""
    row = registry(spark, root).filter(F.col("key") == key).first()
    if row is None:
        raise KeyError(key)
    if dim is not None and row["dim"] != dim:
        raise ValueError(f"model {key} has {row['dim']} features, not {dim}")
    module, name = row["class_name"].rsplit(".", 1)
    loader = getattr(import_module(module), name)
    model: Model = loader.load(f"{root}/models/{key}")
    return Trained(
        model, row["kind"], row["target"], row["label_source"], list(row["classes"]),
        row["n_rows"], row["dim"], row["seconds"],
    )


# Metric tables ------------------------------------------------------------------------

# Names under which result tables carry the comparison columns.
COLUMN_ALIASES = {
    "task": "target",
    "prediction_target": "target",
    "label_type": "target",
    "label": "target",
    "training_label_source": "label_source",
    "training_labels": "label_source",
    "source": "label_source",
    "label_origin": "label_source",
    "classifier": "model",
    "model_name": "model",
    "algorithm": "model",
    "acc": "accuracy",
    "f1_macro": "macro_f1",
    "macro_f1_score": "macro_f1",
    "f1_weighted": "weighted_f1",
    "weighted_f1_score": "weighted_f1",
    "precision_macro": "macro_precision",
    "recall_macro": "macro_recall",
    "precision_weighted": "weighted_precision",
    "recall_weighted": "weighted_recall",
}
KEYS = ("target", "label_source", "model")
METRICS = ("accuracy", "macro_f1", "weighted_f1")


def has_comparison_schema(df: DataFrame) -> bool:
    """Whether the columns, aliases resolved, allow a comparison."""
    try:
        names = normalize_columns(df, COLUMN_ALIASES).columns
    except ValueError:
        return False
    return set(KEYS + METRICS) <= set(names)


def register_metrics(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One metric table from a named table per representation."""
    odd = [name for name, df in tables.items() if not has_comparison_schema(df)]
    if odd:
        raise ValueError(f"no metric tables: {', '.join(sorted(odd))}")
    return union_all(
        [
            normalize_columns(df, COLUMN_ALIASES).withColumn("representation", F.lit(name))
            for name, df in tables.items()
        ]
    )
