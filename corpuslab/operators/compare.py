"""Comparison of text representations over their metric tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpuslab.functions.columns import display_name, map_alias, metric_diff, overall_metrics, reorder, to_numeric, winner

KEYS = ("target", "label_source", "model")
METRICS = ("accuracy", "macro_f1", "weighted_f1")
DISPLAYS = {"representation": "representation_display", "label_source": "label_source_display",
            "model": "model_display_name"}

# Spellings of targets, label sources and models.
TARGET_ALIASES = {
    "categories": "category",
    "category_label": "category",
    "sections": "section",
    "section_label": "section",
}
SOURCE_ALIASES = {
    "real": "real",
    "original": "real",
    "cnn": "real",
    "cnn_label": "real",
    "cnn_labels": "real",
    "original_label": "real",
    "original_labels": "real",
    "human": "real",
    "human_labels": "real",
    "real_label": "real",
    "real_labels": "real",
    "llm": "llm",
    "llm_label": "llm",
    "llm_labels": "llm",
    "generated": "llm",
    "generated_labels": "llm",
    "ai": "llm",
    "ai_labels": "llm",
}
MODEL_ALIASES = {
    "logistic_regression": "logistic",
    "logisticregression": "logistic",
    "lr": "logistic",
    "linear_svm": "svm",
    "linear_svc": "svm",
    "linearsvc": "svm",
    "svc": "svm",
    "naive_bayes": "nb",
    "multinomial_nb": "nb",
    "multinomialnb": "nb",
    "randomforest": "random_forest",
    "rf": "random_forest",
    "xgb": "xgboost",
    "small_neural_network": "neural_network",
    "mlp": "neural_network",
}


def prepare_results(
    df: DataFrame,
    *,
    metrics: Sequence[str] = METRICS,
    targets: Mapping[str, str] = TARGET_ALIASES,
    sources: Mapping[str, str] = SOURCE_ALIASES,
    models: Mapping[str, str] = MODEL_ALIASES,
    displays: Mapping[str, Mapping[str, str]] | None = None,
    strict: bool = True,
) -> DataFrame:
    """Canonical keys, numeric metrics and display names, keys first."""
    out = df.withColumns(
        {
            "target": map_alias("target", targets),
            "label_source": map_alias("label_source", sources),
            "model": map_alias("model", models),
            **{m: to_numeric(m, strict) for m in metrics},
        }
    )
    for column, into in DISPLAYS.items():
        if column in out.columns:
            out = out.withColumn(into, display_name(column, (displays or {}).get(column, {})))
    first = ["representation", "representation_display", "target", "label_source", "label_source_display",
             "model", "model_display_name", *metrics]
    return reorder(out, first)


def matched(
    a: DataFrame, b: DataFrame, name_a: str, name_b: str, keys: Sequence[str] = KEYS,
    metrics: Sequence[str] = METRICS,
) -> DataFrame:
    """Experiments both tables have: metrics side by side, difference, winner.

    Keys must be unique in each table; a repeated key is an error when read.
    """
    def side(t: DataFrame, name: str) -> DataFrame:
        once = F.when(F.count(F.lit(1)) == 1, F.lit(True)).otherwise(
            F.raise_error(F.concat(F.lit("experiment occurs twice: "), F.concat_ws(" | ", *keys))).cast("boolean")
        )
        values = [F.max(m).alias(f"{name}_{m}") for m in metrics]
        return t.groupBy(*keys).agg(once.alias("_once"), *values).filter("_once").drop("_once")

    both = side(a, name_a).join(side(b, name_b), list(keys))
    extra = {}
    for m in metrics:
        diff = metric_diff(f"{name_a}_{m}", f"{name_b}_{m}")
        extra[f"{m}_difference"] = diff
        extra[f"{m}_winner"] = winner(diff, name_a, name_b)
    return both.withColumns(extra)


def compare_representations(
    results: DataFrame, a: str, b: str, metrics: Sequence[str] = METRICS
) -> DataFrame:
    """Matched comparison of two representations in one result table."""
    pick = lambda name: results.filter(F.col("representation") == name)
    return matched(pick(a), pick(b), a, b, metrics=metrics)


def representation_summary(results: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    """Models, mean and best metrics per representation and condition."""
    wanted = ["representation", "representation_display", "target", "label_source", "label_source_display"]
    keys = list(keys or [c for c in wanted if c in results.columns])
    return results.groupBy(*keys).agg(
        F.count_distinct("model").alias("model_count"),
        *[F.avg(m).alias(f"mean_{m}") for m in METRICS],
        *[F.max(m).alias(f"best_{m}") for m in METRICS],
    )


def best_models(results: DataFrame, name: str = "model_display_name") -> DataFrame:
    """The whole row of the best model per condition and representation."""
    order = W.partitionBy("target", "label_source", "representation").orderBy(
        F.desc("macro_f1"), F.desc("accuracy"), F.asc(name)
    )
    return results.withColumn("_r", F.row_number().over(order)).filter(F.col("_r") == 1).drop("_r")


def metric_pivot(
    df: DataFrame, rows: Sequence[str], col: str, value: str, values: Sequence[str]
) -> DataFrame:
    """One column per given value of ``col``; a missing cell is null."""
    return df.groupBy(*rows).agg(
        *[F.max(F.when(F.col(col) == v, F.col(value))).alias(str(v)) for v in values]
    )


def model_summary(metrics: DataFrame, source: str = "training_labels") -> DataFrame:
    """Overall metrics of every model, sorted by model and label source."""
    columns = ["accuracy", "macro_precision", "macro_recall", "macro_f1",
               "weighted_precision", "weighted_recall", "weighted_f1"]
    keys = [c for c in ("target", "model", source) if c in metrics.columns]
    return overall_metrics(metrics).select(*keys, *columns).orderBy(*[k for k in keys if k != "target"], *keys[:1])
