"""Multinomial naive Bayes as aggregates and one join."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuslab.functions.labels import label_domain

MAX_CLASSES = 500


def nb_fit(
    features: DataFrame,
    labels: DataFrame,
    id: str,
    label: str,
    n_terms: int,
    weight: str = "weight",
    alpha: float = 1.0,
    classes: Sequence[str] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Log probabilities from the long table ``(id, term_idx, weight)``.

    A table that carries the label already is not joined again.
    Returns a term table ``(term_idx, gain)``, where ``gain`` is an array over
    the sorted classes of ``ln(N_ct + alpha) - ln(alpha)``, and a one-row-per-
    class table ``(class_idx, label, prior, base)`` with ``base`` the log
    probability of a term the class never showed.  Both are small: terms of the
    vocabulary, and classes.
    """
    classes = sorted(classes) if classes is not None else label_domain(labels, label, MAX_CLASSES)
    if not 1 < len(classes) <= MAX_CLASSES:
        raise ValueError(f"naive Bayes needs 2 to {MAX_CLASSES} classes")
    if label in features.columns:
        tagged = features.withColumnRenamed(label, "_c")
    else:
        tagged = features.join(labels.select(id, F.col(label).alias("_c")), id)
    sums = [
        F.sum(F.when(F.col("_c") == c, F.col(weight)).otherwise(0.0)).alias(f"_s{i}") for i, c in enumerate(classes)
    ]
    per_term = tagged.groupBy("term_idx").agg(*sums)
    gain = F.array(*[F.ln(F.col(f"_s{i}") + alpha) - F.ln(F.lit(alpha)) for i in range(len(classes))])
    terms = per_term.select("term_idx", gain.alias("gain"))

    mass = tagged.groupBy(F.col("_c").alias("label")).agg(F.sum(weight).alias("_mass"))
    sizes = labels.groupBy(F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("_n"))
    total = labels.agg(F.count(F.lit(1))).scalar()
    order = F.array_position(F.array(*[F.lit(c) for c in classes]), F.col("label")) - 1
    per_class = sizes.join(mass, "label", "left").select(
        order.cast("int").alias("class_idx"),
        "label",
        F.ln(F.col("_n") / total).alias("prior"),
        (F.ln(F.lit(alpha)) - F.ln(F.coalesce("_mass", F.lit(0.0)) + alpha * n_terms)).alias("base"),
    )
    return terms, per_class


def nb_predict(
    features: DataFrame,
    ids: DataFrame,
    id: str,
    terms: DataFrame,
    per_class: DataFrame,
    weight: str = "weight",
) -> DataFrame:
    """Most probable class per document: ``(id, predicted)``; ties by label.

    One sum per class and document; the classes never become rows.
    """
    from corpuslab.session import collect_bounded

    model = sorted(collect_bounded(per_class, MAX_CLASSES, "class table"), key=lambda r: r["class_idx"])
    k = len(model)
    scored = features.join(terms, "term_idx").groupBy(id).agg(
        *[F.sum(F.col("gain")[i] * F.col(weight)).alias(f"_g{i}") for i in range(k)],
        F.sum(weight).alias("_w"),
    )
    every = ids.select(id).distinct().join(scored, id, "left")
    scores = F.array(
        *[
            F.struct(
                (
                    F.lit(r["prior"])
                    + F.coalesce(f"_g{i}", F.lit(0.0))
                    + F.coalesce("_w", F.lit(0.0)) * F.lit(r["base"])
                ).alias("score"),
                F.lit(-i).alias("order"),
                F.lit(r["label"]).alias("label"),
            )
            for i, r in enumerate(model)
        ]
    )
    return every.select(id, F.array_max(scores)["label"].alias("predicted"))
