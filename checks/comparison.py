"""Comparison of representations over metrics computed from the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.common import table, words
from checks.evaluation import _six, class_table
from corpuslab.functions import columns as co
from corpuslab.functions import text as tx
from corpuslab.operators import compare as cmp
from corpuslab.operators import evaluate as ev
from corpuslab.operators.quality import check_metric_ranges
from corpuslab.session import materialize, spread
from corpuslab.sources.registry import has_comparison_schema, register_metrics

# One rule per model and representation: a document is good when it is long enough.
LIMITS = {"words": {"rule_low": 40, "rule_mid": 160, "rule_high": 320}, "chars": {"rule_low": 200, "rule_mid": 1000, "rule_max": 6000}}
SOURCES = {"Original Labels": "quality", "AI": "toxic"}
MODELS = {"rule_low": "Low Rule", "rule_mid": "Middle Rule"}


def _metrics(spark, d, representation):
    """Metrics of every rule against two label sources, all from one grouped count."""
    docs = spread(table(spark, d, "documents").select("doc_id", "text", "n_chars"), "doc_id")
    size = tx.count_words("text") if representation == "words" else F.col("n_chars")
    rows = docs.select("doc_id", size.alias("size")).join(table(spark, d, "labels"), "doc_id")
    entries = [
        F.struct(
            F.lit("Categories").alias("task"), F.lit(source).alias("training labels"), F.lit(model).alias("Classifier"),
            F.col(column).cast("string").alias("actual"), (F.col("size") >= limit).cast("int").cast("string").alias("predicted"),
        )
        for source, column in SOURCES.items()
        for model, limit in LIMITS[representation].items()
    ]
    long = rows.select(F.inline(F.array(*entries)))
    by = ["task", "training labels", "Classifier"]
    summary = ev.classification_summary(ev.confusion_matrix(long, "actual", "predicted", by), by)
    return summary.select(*by, F.col("accuracy").alias("acc"), F.col("macro_f1").alias("F1 macro"),
                          F.col("weighted_f1").alias("weighted_f1_score"))


def _results(spark, d):
    tables = {name: _metrics(spark, d, name) for name in LIMITS}
    if not all(has_comparison_schema(t) for t in tables.values()):
        raise ValueError("metric tables lack columns")
    return cmp.prepare_results(register_metrics(tables), displays={"model": MODELS})


def metrics_aliases(spark, d):
    return _six(_results(spark, d))


def matched_comparison(spark, d):
    return _six(cmp.compare_representations(materialize(_results(spark, d), "results"), "words", "chars"))


def best_models(spark, d):
    return _six(cmp.best_models(_results(spark, d)).select("target", "label_source", "representation", "model", "macro_f1", "accuracy"))


def representation_summary(spark, d):
    return _six(cmp.representation_summary(_results(spark, d), ["representation", "target", "label_source"]))


def metric_pivot(spark, d):
    return _six(cmp.metric_pivot(_results(spark, d), ["label_source", "model"], "representation", "macro_f1", ["words", "chars"]))


def metric_range_check(spark, d):
    results = _results(spark, d).select(
        "representation", "label_source", "model", (F.col("accuracy") * 2).alias("accuracy"), "macro_f1"
    )
    return check_metric_ranges(results, ["accuracy", "macro_f1"], {"label_source": ["real"]})


def experiment_labels(spark, d):
    r = _results(spark, d)
    return r.select(
        "representation", "label_source", "model", co.experiment_label(["label_source", "model", "representation"]).alias("experiment"),
        co.throughput(F.lit(816), F.when(F.col("representation") == "words", 0.5)).alias("speed"),
        co.throughput(F.lit(816), F.lit(0.0)).alias("no_time"),
        co.first_known(F.nullif("model", F.lit("rule_low")), F.lit("configured")).alias("known"),
    )


def model_summary(spark, d):
    rows = _results(spark, d).select("target", "model", F.col("label_source").alias("training_labels"), "accuracy", "macro_f1", "weighted_f1")
    rows = rows.withColumns({"metric_scope": F.lit("overall"), **{
        c: F.lit(0.0) for c in ("macro_precision", "macro_recall", "weighted_precision", "weighted_recall")}})
    best = rows.groupBy("target", "model", "training_labels", "metric_scope").agg(
        *[F.max(c).alias(c) for c in rows.columns if c not in ("target", "model", "training_labels", "metric_scope")])
    return _six(cmp.model_summary(best).select("target", "model", "training_labels", "accuracy", "macro_f1", "weighted_f1"))


def numeric_coercion(spark, d):
    """Numbers as text, some with letters: lenient coercion, percentages, slugs."""
    o = table(spark, d, "orders")
    shown = F.when(F.col("o_orderstatus") == "P", F.col("o_orderpriority")).otherwise(F.col("o_custkey").cast("string"))
    return o.select("o_orderkey", co.to_numeric(shown, strict=False).alias("number"),
                    co.map_alias("o_orderpriority", {"1_urgent": "first"}).alias("priority"),
                    co.display_name(co.canonical_name("o_orderpriority"), {"2_high": "High!"}).alias("shown"))


QUERIES = {
    f.__name__: f
    for f in (metrics_aliases, matched_comparison, best_models, representation_summary, metric_pivot,
              metric_range_check, experiment_labels, model_summary, numeric_coercion)
}

_SUMMARY = """SELECT sum(hits)::DOUBLE / sum(support) AS accuracy, avg(f) AS macro_f1, sum(f * support) / sum(support) AS weighted_f1"""


def _one(representation: str, source: str, column: str, model: str, limit: int) -> str:
    size = words("text") if representation == "words" else "n_chars"
    name = {"Original Labels": "real", "AI": "llm"}[source]
    shown = MODELS.get(model, " ".join(w.capitalize() for w in model.split("_")))
    return f"""(WITH z AS (SELECT {column}::VARCHAR AS actual, ({'w' if representation == 'words' else 'n_chars'} >= {limit})::INT::VARCHAR AS predicted FROM b),
      c AS (SELECT actual AS l FROM z UNION SELECT predicted FROM z), {class_table('z', 'c')}
      {_SUMMARY}, '{representation}' AS representation, '{name}' AS label_source, '{model}' AS model, '{shown}' AS shown FROM k)"""


_M = f"""WITH b AS (SELECT *, {words('text')} AS w FROM labels JOIN documents USING (doc_id)), m AS (""" + " UNION ALL ".join(
    _one(rep, source, column, model, limit)
    for rep, models in LIMITS.items() for source, column in SOURCES.items() for model, limit in models.items()
) + ")"
_DIFF = ", ".join(
    f"round(x.{m}, 6) AS words_{m}, round(y.{m}, 6) AS chars_{m}, round(y.{m} - x.{m}, 6) AS {m}_difference, "
    f"CASE WHEN y.{m} > x.{m} THEN 'chars' WHEN y.{m} < x.{m} THEN 'words' ELSE 'Tie' END AS {m}_winner"
    for m in cmp.METRICS
)
_SHOW = "upper(label_source[1]) || lower(label_source[2:])"

ORACLE = {
    "metrics_aliases": f"""{_M} SELECT representation, upper(representation[1]) || representation[2:] AS representation_display,
      'category' AS target, label_source, {_SHOW} AS label_source_display, model, shown AS model_display_name,
      round(accuracy, 6) AS accuracy, round(macro_f1, 6) AS macro_f1, round(weighted_f1, 6) AS weighted_f1 FROM m""",
    "matched_comparison": f"""{_M} SELECT 'category' AS target, x.label_source, x.model, {_DIFF} FROM m x JOIN m y
      ON x.representation = 'words' AND y.representation = 'chars' AND x.label_source = y.label_source AND x.model = y.model""",
    "best_models": f"""{_M} SELECT 'category' AS target, label_source, representation, model, round(macro_f1, 6) AS macro_f1,
      round(accuracy, 6) AS accuracy FROM m QUALIFY row_number() OVER (PARTITION BY label_source, representation
      ORDER BY macro_f1 DESC, accuracy DESC, shown) = 1""",
    "representation_summary": f"""{_M} SELECT representation, 'category' AS target, label_source, count(DISTINCT model) AS model_count,
      {', '.join(f'round(avg({m}), 6) AS mean_{m}, round(max({m}), 6) AS best_{m}' for m in cmp.METRICS)} FROM m GROUP BY ALL""",
    "metric_pivot": f"""{_M} SELECT label_source, model, round(max(macro_f1) FILTER (representation = 'words'), 6) AS words,
      round(max(macro_f1) FILTER (representation = 'chars'), 6) AS chars FROM m GROUP BY ALL""",
    "metric_range_check": f"""{_M}, v AS (SELECT representation || ' | ' || label_source || ' | ' || model AS key, unnest([
        CASE WHEN accuracy * 2 > 1 THEN 'accuracy is not in [0, 1]' END,
        CASE WHEN label_source <> 'real' THEN 'label_source is not allowed' END]) AS detail FROM m)
      SELECT 'metric' AS "check", key, detail FROM v WHERE detail IS NOT NULL""",
    "experiment_labels": f"""{_M} SELECT representation, label_source, model, label_source || ' | ' || model || ' | ' || representation AS experiment,
      CASE WHEN representation = 'words' THEN 1632.0::DOUBLE END AS speed, NULL::DOUBLE AS no_time,
      CASE WHEN model = 'rule_low' THEN 'configured' ELSE model END AS known FROM m""",
    "model_summary": f"""{_M} SELECT 'category' AS target, model, label_source AS training_labels, round(max(accuracy), 6) AS accuracy,
      round(max(macro_f1), 6) AS macro_f1, round(max(weighted_f1), 6) AS weighted_f1 FROM m GROUP BY ALL""",
    "numeric_coercion": """WITH o AS (SELECT *, regexp_replace(regexp_replace(lower(trim(o_orderpriority)), '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g') AS p FROM orders)
      SELECT o_orderkey, TRY_CAST(CASE WHEN o_orderstatus = 'P' THEN o_orderpriority ELSE o_custkey::VARCHAR END AS DOUBLE) AS number,
      CASE WHEN p = '1_urgent' THEN 'first' ELSE p END AS priority,
      CASE WHEN p = '2_high' THEN 'High!' ELSE array_to_string(list_transform(string_split(replace(p, '_', ' '), ' '),
        lambda w: upper(w[1]) || lower(w[2:])), ' ') END AS shown FROM o""",
}
