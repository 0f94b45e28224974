"""Classification metrics from confusion counts.

Predictions of any number of experiments are counted once by
``(experiment, actual, predicted)``; all metrics follow from these counts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def confusion_matrix(
    df: DataFrame,
    actual: str,
    predicted: str,
    by: Sequence[str] = (),
    normalize: str | None = None,
    domain: Sequence[str] | None = None,
) -> DataFrame:
    """Long matrix ``(by…, actual, predicted, n)``.

    With ``domain`` every cell is present.  ``normalize="true"`` adds ``share``,
    the part of the cell in its truth row; an empty row has share 0.
    """
    by = list(by)
    out = df.groupBy(*by, F.col(actual).alias("actual"), F.col(predicted).alias("predicted")).agg(
        F.count(F.lit(1)).alias("n")
    )
    if domain is not None:
        labels = F.array(*[F.lit(v) for v in domain])
        if by:
            keys = out.select(*by).distinct()
        else:
            keys = df.sparkSession.range(1).select()
        cells = keys.select(*by, F.explode(labels).alias("actual")).select(
            *by, "actual", F.explode(labels).alias("predicted")
        )
        out = cells.join(out, [*by, "actual", "predicted"], "left").withColumn(
            "n", F.coalesce("n", F.lit(0))
        )
    if normalize is None:
        return out
    if normalize != "true":
        raise ValueError(f"unknown normalization: {normalize}")
    total = F.sum("n").over(W.partitionBy(*by, "actual"))
    return out.withColumn("share", F.coalesce(F.try_divide("n", total), F.lit(0.0)))


def class_counts(
    confusion: DataFrame, by: Sequence[str] = (), domain: Sequence[str] | DataFrame | None = None
) -> DataFrame:
    """Support, predictions and hits per class: ``(by…, label, support, predicted, hits)``.

    ``domain`` adds classes that neither truth nor prediction shows: a list for
    all experiments, or a table ``(by…, label)`` with the classes of each.
    """
    by = list(by)
    zero = F.lit(0).cast("long")
    n, actual, predicted = F.col("n"), F.col("actual"), F.col("predicted")

    def entry(label: Column, support: Column, hit: Column, guess: Column) -> Column:
        return F.struct(
            label.alias("label"), support.alias("support"), guess.alias("predicted"), hit.alias("hits")
        )

    as_truth = entry(actual, n, F.when(actual == predicted, n).otherwise(zero), zero)
    as_guess = entry(predicted, zero, zero, n)
    rows = confusion.select(*by, F.inline(F.array(as_truth, as_guess)))
    if isinstance(domain, DataFrame):
        extra = domain.select(*by, "label").distinct()
    elif domain is not None:
        labels = F.array(*[F.lit(v) for v in domain])
        keys = confusion.select(*by).distinct() if by else confusion.sparkSession.range(1).select()
        extra = keys.select(*by, F.explode(labels).alias("label"))
    else:
        extra = None
    if extra is not None:
        zeros = extra.select(*by, "label", *[zero.alias(c) for c in ("support", "predicted", "hits")])
        rows = rows.unionByName(zeros)
    return rows.groupBy(*by, "label").agg(
        F.sum("support").alias("support"), F.sum("predicted").alias("predicted"), F.sum("hits").alias("hits")
    )


def _ratio(a: Column, b: Column) -> Column:
    """Quotient, 0 on zero division."""
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def _class_table(
    confusion: DataFrame, by: list[str], domain: Sequence[str] | DataFrame | None
) -> DataFrame:
    counts = class_counts(confusion, by, domain)
    counts = counts.withColumns(
        {"precision": _ratio(F.col("hits"), F.col("predicted")), "recall": _ratio(F.col("hits"), F.col("support"))}
    )
    f1 = _ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall"))
    return counts.withColumn("f1", f1)


def per_class_metrics(
    confusion: DataFrame,
    by: Sequence[str] = (),
    domain: Sequence[str] | DataFrame | None = None,
    training: Sequence[str] | DataFrame | None = None,
) -> DataFrame:
    """Precision, recall, F1 and support per class.

    ``training`` (labels, or a table ``(by…, label)``) adds the flag
    ``seen_during_training``.
    """
    by = list(by)
    out = _class_table(confusion, by, domain).select(*by, "label", "precision", "recall", "f1", "support")
    if training is None:
        return out
    if isinstance(training, DataFrame):
        return seen_in_training(out, "label", training, by)
    return out.withColumn("seen_during_training", F.col("label").isin(list(training)))


def seen_in_training(
    df: DataFrame, label: str, training: DataFrame, by: Sequence[str] = (), into: str = "seen_during_training"
) -> DataFrame:
    """Flag whether a label occurs in the training table ``(by…, label)``."""
    known = training.select(*by, F.col("label").alias(label)).distinct().withColumn("_seen", F.lit(True))
    return df.join(known, [*by, label], "left").withColumn(
        into, F.coalesce("_seen", F.lit(False))
    ).drop("_seen")


def _averages(by: Sequence[str], classes: DataFrame) -> DataFrame:
    names = ("precision", "recall", "f1")
    weight = F.sum("support")
    aggregates = [
        *[F.avg(m).alias(f"macro_{m}") for m in names],
        *[F.try_divide(F.sum(F.col(m) * F.col("support")), weight).alias(f"weighted_{m}") for m in names],
        F.avg(F.when(F.col("support") > 0, F.col("recall"))).alias("balanced_accuracy"),
        F.try_divide(F.sum("hits"), weight).alias("accuracy"),
        F.count(F.lit(1)).alias("n_classes"),
        weight.alias("support"),
    ]
    return classes.groupBy(*by).agg(*aggregates)


SUMMARY_COLUMNS = (
    "accuracy", "balanced_accuracy", "macro_precision", "macro_recall", "macro_f1",
    "weighted_precision", "weighted_recall", "weighted_f1", "n_classes", "support",
)


def classification_summary(
    confusion: DataFrame,
    by: Sequence[str] = (),
    class_domain: str = "observed",
    domain: Sequence[str] | DataFrame | None = None,
) -> DataFrame:
    """Accuracy, balanced accuracy, macro and weighted averages.

    ``class_domain`` says which classes the macro averages cover: ``observed``
    in truth or prediction, those plus the ``domain`` of the training labels
    (``with_training``), or a ``fixed`` domain.  Balanced accuracy covers the
    classes of the truth only.
    """
    if class_domain not in ("observed", "with_training", "fixed"):
        raise ValueError(f"unknown class domain: {class_domain}")
    if class_domain == "observed":
        if domain is not None:
            raise ValueError("the observed domain takes no labels")
    elif domain is None:
        raise ValueError(f"class domain {class_domain} needs labels")
    classes = _class_table(confusion, list(by), domain)
    return _averages(list(by), classes).select(*by, *SUMMARY_COLUMNS)


def classification_report(
    confusion: DataFrame, by: Sequence[str] = (), domain: Sequence[str] | DataFrame | None = None
) -> DataFrame:
    """Class rows and the rows accuracy, macro avg and weighted avg."""
    by = list(by)
    classes = _class_table(confusion, by, domain)
    totals = _averages(by, classes)

    def row(name: str, p: str, r: str, f: str, support: Column) -> Column:
        return F.struct(
            F.lit(name).alias("label"), F.col(p).alias("precision"), F.col(r).alias("recall"),
            F.col(f).alias("f1"), support.cast("double").alias("support"),
        )

    extra = totals.select(
        *by,
        F.inline(
            F.array(
                row("accuracy", "accuracy", "accuracy", "accuracy", F.col("accuracy")),
                row("macro avg", "macro_precision", "macro_recall", "macro_f1", F.col("support")),
                row("weighted avg", "weighted_precision", "weighted_recall", "weighted_f1", F.col("support")),
            )
        ),
    )
    return classes.select(
        *by, F.col("label").cast("string").alias("label"), "precision", "recall", "f1",
        F.col("support").cast("double").alias("support"),
    ).unionByName(extra)


def metric_rows(
    confusion: DataFrame,
    by: Sequence[str],
    class_domain: str = "observed",
    domain: Sequence[str] | DataFrame | None = None,
) -> DataFrame:
    """Long metrics of every experiment: one ``overall`` row, one per ``class``."""
    overall = classification_summary(confusion, by, class_domain, domain if class_domain != "observed" else None)
    classes = per_class_metrics(confusion, by, domain)
    a = overall.drop("n_classes", "balanced_accuracy").withColumns(
        {"metric_scope": F.lit("overall"), "class_label": F.lit(None).cast("string")}
    )
    b = classes.withColumn("class_label", F.col("label").cast("string")).drop("label").withColumn(
        "metric_scope", F.lit("class")
    )
    return a.unionByName(b, allowMissingColumns=True)


def label_agreement(a: DataFrame, b: DataFrame, id: str, label: str, by: Sequence[str] = ()) -> DataFrame:
    """Confusion of two label sources joined on id, the first as truth."""
    pairs = a.select(id, *by, F.col(label).alias("_a")).join(b.select(id, F.col(label).alias("_b")), id)
    return confusion_matrix(pairs, "_a", "_b", by)


def pair_agreement(a: DataFrame, b: DataFrame, id: str, category: str, section: str) -> DataFrame:
    """Share of ids with equal category, equal section, and both."""
    right = b.select(id, F.col(category).alias("_c"), F.col(section).alias("_s"))
    same_c, same_s = F.col(category).eqNullSafe(F.col("_c")), F.col(section).eqNullSafe(F.col("_s"))
    rate = lambda c: F.avg(c.cast("int"))
    return a.select(id, category, section).join(right, id).agg(
        F.count(F.lit(1)).alias("n"),
        rate(same_c).alias("category_agreement"),
        rate(same_s).alias("section_agreement"),
        rate(same_c & same_s).alias("pair_agreement"),
    )


def hierarchy_distribution(
    df: DataFrame, category: str, section: str, edges: DataFrame
) -> DataFrame:
    """Rows per edge of the tree; an edge without rows counts 0."""
    counts = df.groupBy(F.col(category).alias("category"), F.col(section).alias("section")).agg(
        F.count(F.lit(1)).alias("n")
    )
    return edges.select("category", "section").join(counts, ["category", "section"], "left").withColumn(
        "n", F.coalesce("n", F.lit(0))
    )
