"""Metrics, agreement, contingency."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.common import VOTE, table
from corpuslab.functions.columns import class_metrics, overall_metrics, prediction_table
from corpuslab.operators import evaluate as ev
from corpuslab.operators.contingency import alignment, contingency
from corpuslab.operators.neighbors import flag_pairs, knn, majority_label
from corpuslab.session import materialize

DIGITS = [str(i) for i in range(10)]
KNOWN = ["0", "1", "2", "3", "4", "10"]


def voted(spark, d):
    """Label of every vector and the majority label of its five neighbours."""
    e = table(spark, d, "embeddings")
    pairs = flag_pairs(knn(e, "vec_id", "embedding", 5), e, "vec_id", ["label"])
    truth = e.select(F.col("vec_id").alias("id"), F.col("label").cast("string").alias("actual"))
    return truth.join(majority_label(pairs, "label"), "id").withColumn("predicted", F.col("predicted").cast("string"))


def _confusion(spark, d):
    return ev.confusion_matrix(voted(spark, d), "actual", "predicted")


def _six(df, *keep):
    """Doubles rounded, so that both engines print the same digits."""
    return df.select(*[F.round(c, 6).alias(c) if t == "double" else c for c, t in df.dtypes])


def confusion_long(spark, d):
    return ev.confusion_matrix(voted(spark, d), "actual", "predicted", domain=DIGITS)


def confusion_normalized(spark, d):
    return _six(ev.confusion_matrix(voted(spark, d), "actual", "predicted", normalize="true", domain=DIGITS + ["10"]))


def classification_summary(spark, d):
    c = materialize(_confusion(spark, d), "confusion")
    parts = [
        ev.classification_summary(c).withColumn("class_domain", F.lit("observed")),
        ev.classification_summary(c, (), "with_training", KNOWN).withColumn("class_domain", F.lit("with_training")),
        ev.classification_summary(c, (), "fixed", DIGITS + ["10", "11"]).withColumn("class_domain", F.lit("fixed")),
    ]
    return _six(parts[0].unionByName(parts[1]).unionByName(parts[2]))


def per_class_metrics(spark, d):
    return _six(ev.per_class_metrics(_confusion(spark, d), domain=DIGITS + ["10"], training=KNOWN))


def classification_report(spark, d):
    return _six(ev.classification_report(materialize(_confusion(spark, d), "confusion")))


def predictions(spark, d):
    rows = voted(spark, d).withColumn("seen", F.col("actual").isin(KNOWN))
    return prediction_table(rows, id="id", actual="actual", predicted="predicted", seen="seen",
                            target="label", label_source="real", model="neighbours")


def _judged(spark, d):
    """Labels against two rules on document length."""
    labels, docs = table(spark, d, "labels"), table(spark, d, "documents")
    text = lambda c: c.cast("int").cast("string")
    real = labels.select("doc_id", text(F.col("quality")).alias("category"), text(F.col("toxic")).alias("section"))
    rule = docs.join(labels.select("doc_id"), "doc_id").select(
        "doc_id", text(F.col("n_chars") >= 1000).alias("category"), text(F.col("n_chars") < 200).alias("section")
    )
    return real, rule


def label_agreement(spark, d):
    """Agreement of two label sources with the first as truth, per target."""
    real, rule = _judged(spark, d)
    long = lambda t: t.select(
        "doc_id", F.expr("inline(array(struct('category' AS target, category AS label), struct('section' AS target, section AS label)))")
    )
    pairs = long(real).alias("a").join(long(rule).alias("b"), ["doc_id", "target"]).select(
        "target", F.col("a.label").alias("x"), F.col("b.label").alias("y")
    )
    return _six(ev.classification_summary(ev.confusion_matrix(pairs, "x", "y", ["target"]), ["target"]))


def pair_agreement(spark, d):
    real, rule = _judged(spark, d)
    return _six(ev.pair_agreement(real, rule, "doc_id", "category", "section"))


def agreement_counts(spark, d):
    real, rule = _judged(spark, d)
    return ev.label_agreement(real, rule, "doc_id", "category", ["section"])


def metric_rows(spark, d):
    """Long metric table of two targets: overall and class rows."""
    real, rule = _judged(spark, d)
    pairs = real.alias("a").join(rule.alias("b"), "doc_id")
    both = F.expr("""inline(array(struct('category' AS target, a.category AS actual, b.category AS predicted),
        struct('section' AS target, a.section AS actual, b.section AS predicted)))""")
    rows = ev.metric_rows(ev.confusion_matrix(pairs.select(both), "actual", "predicted", ["target"]), ["target"])
    keep = ["target", "metric_scope", "class_label", "accuracy", "precision", "recall", "f1", "macro_f1", "weighted_f1", "support"]
    return _six(overall_metrics(rows).unionByName(class_metrics(rows)).select(*keep))


def nmi_ari(spark, d):
    docs = alignment(table(spark, d, "documents"), "lang", "source").withColumn("pair", F.lit("lang-source"))
    votes = alignment(voted(spark, d), "actual", "predicted").withColumn("pair", F.lit("label-vote"))
    return _six(docs.unionByName(votes))


def contingency_shares(spark, d):
    return _six(contingency(table(spark, d, "documents"), "source", "lang"))


QUERIES = {
    f.__name__: f
    for f in (
        confusion_long, confusion_normalized, classification_summary, per_class_metrics, classification_report,
        predictions, label_agreement, pair_agreement, agreement_counts, metric_rows, nmi_ari, contingency_shares,
    )
}


def class_table(source: str, classes: str) -> str:
    """CTE ``k``: metrics per class of ``source (by…, actual, predicted)`` over ``classes (by…, l)``."""
    return f"""k0 AS (SELECT l, (SELECT count(*) FROM {source} WHERE actual = l) AS support,
      (SELECT count(*) FROM {source} WHERE predicted = l) AS guessed,
      (SELECT count(*) FROM {source} WHERE predicted = l AND actual = l) AS hits FROM {classes}),
     k1 AS (SELECT *, CASE WHEN guessed = 0 THEN 0 ELSE hits::DOUBLE / guessed END AS p,
      CASE WHEN support = 0 THEN 0 ELSE hits::DOUBLE / support END AS r FROM k0),
     k AS (SELECT *, CASE WHEN p + r = 0 THEN 0 ELSE 2 * p * r / (p + r) END AS f FROM k1)"""


_LIST = lambda xs: "[" + ", ".join(f"'{x}'" for x in xs) + "]"
_OBSERVED = "SELECT actual AS l FROM z UNION SELECT predicted FROM z"
_SUMMARY = """SELECT round(sum(hits)::DOUBLE / sum(support), 6) AS accuracy,
  round(avg(r) FILTER (support > 0), 6) AS balanced_accuracy, round(avg(p), 6) AS macro_precision,
  round(avg(r), 6) AS macro_recall, round(avg(f), 6) AS macro_f1, round(sum(p * support) / sum(support), 6) AS weighted_precision,
  round(sum(r * support) / sum(support), 6) AS weighted_recall, round(sum(f * support) / sum(support), 6) AS weighted_f1,
  count(*) AS n_classes, sum(support)::BIGINT AS support"""


def _summary(name: str, classes: str) -> str:
    return f"(WITH c AS ({classes}), {class_table('z', 'c')} {_SUMMARY}, '{name}' AS class_domain FROM k)"


_RULE = """j AS (SELECT doc_id, quality::VARCHAR AS qa, toxic::VARCHAR AS ta, (n_chars >= 1000)::INT::VARCHAR AS qb,
  (n_chars < 200)::INT::VARCHAR AS tb FROM labels JOIN documents USING (doc_id))"""


def _target(name: str, a: str, b: str, tail: str) -> str:
    return f"""(WITH {_RULE}, z AS (SELECT {a} AS actual, {b} AS predicted FROM j), c AS ({_OBSERVED}),
      {class_table('z', 'c')} {tail.format(name=name)})"""


_ALIGN = """SELECT round(2 * mi / (ha + hb), 6) AS nmi, round((s - sa * sb / c) / ((sa + sb) / 2 - sa * sb / c), 6) AS ari, '{name}' AS pair
  FROM (SELECT sum(n / t * ln(n * t / (a * b))) AS mi, sum(n * (n - 1) / 2) AS s, any_value(t * (t - 1) / 2) AS c FROM m),
  (SELECT -sum(a / t * ln(a / t)) AS ha, sum(a * (a - 1) / 2) AS sa FROM (SELECT DISTINCT x, a, t FROM m)),
  (SELECT -sum(b / t * ln(b / t)) AS hb, sum(b * (b - 1) / 2) AS sb FROM (SELECT DISTINCT y, b, t FROM m))"""
_CELLS = """m AS (SELECT x, y, n, sum(n) OVER (PARTITION BY x) AS a, sum(n) OVER (PARTITION BY y) AS b, sum(n) OVER () AS t
  FROM (SELECT x, y, count(*)::DOUBLE AS n FROM w GROUP BY ALL))"""

ORACLE = {
    "confusion_long": f"""WITH {VOTE}, l AS (SELECT unnest({_LIST(DIGITS)}) AS v)
      SELECT x.v AS actual, y.v AS predicted, count(z.id) AS n FROM l x CROSS JOIN l y
      LEFT JOIN z ON z.actual = x.v AND z.predicted = y.v GROUP BY ALL""",
    "confusion_normalized": f"""WITH {VOTE}, l AS (SELECT unnest({_LIST(DIGITS + ['10'])}) AS v),
      c AS (SELECT x.v AS actual, y.v AS predicted, count(z.id) AS n FROM l x CROSS JOIN l y
        LEFT JOIN z ON z.actual = x.v AND z.predicted = y.v GROUP BY ALL)
      SELECT actual, predicted, n, round(CASE WHEN sum(n) OVER (PARTITION BY actual) = 0 THEN 0
        ELSE n::DOUBLE / sum(n) OVER (PARTITION BY actual) END, 6) AS share FROM c""",
    "classification_summary": f"WITH {VOTE} " + " UNION ALL ".join([
        _summary("observed", _OBSERVED),
        _summary("with_training", _OBSERVED + f" UNION SELECT unnest({_LIST(KNOWN)})"),
        _summary("fixed", _OBSERVED + f" UNION SELECT unnest({_LIST(DIGITS + ['10', '11'])})"),
    ]),
    "per_class_metrics": f"""WITH {VOTE}, c AS ({_OBSERVED} UNION SELECT unnest({_LIST(DIGITS + ['10'])})), {class_table('z', 'c')}
      SELECT l AS label, round(p, 6) AS precision, round(r, 6) AS recall, round(f, 6) AS f1, support,
      l IN {tuple(KNOWN)} AS seen_during_training FROM k""",
    "classification_report": f"""WITH {VOTE}, c AS ({_OBSERVED}), {class_table('z', 'c')},
      t AS (SELECT sum(hits)::DOUBLE / sum(support) AS a, sum(support)::DOUBLE AS s FROM k)
      SELECT l AS label, round(p, 6) AS precision, round(r, 6) AS recall, round(f, 6) AS f1, support::DOUBLE AS support FROM k
      UNION ALL SELECT 'accuracy', round(a, 6), round(a, 6), round(a, 6), round(a, 6) FROM t
      UNION ALL SELECT 'macro avg', round(avg(p), 6), round(avg(r), 6), round(avg(f), 6), sum(support)::DOUBLE FROM k
      UNION ALL SELECT 'weighted avg', round(sum(p * support) / sum(support), 6), round(sum(r * support) / sum(support), 6),
        round(sum(f * support) / sum(support), 6), sum(support)::DOUBLE FROM k""",
    "predictions": f"""WITH {VOTE} SELECT id, NULL::VARCHAR AS headline, 'label' AS target, 'real' AS label_source,
      'neighbours' AS model, actual AS actual_label, predicted AS predicted_label, actual = predicted AS correct,
      actual IN {tuple(KNOWN)} AS actual_label_seen_during_training FROM z""",
    "label_agreement": _target("category", "qa", "qb", _SUMMARY + ", '{name}' AS target FROM k") + " UNION ALL "
    + _target("section", "ta", "tb", _SUMMARY + ", '{name}' AS target FROM k"),
    "pair_agreement": f"""WITH {_RULE} SELECT count(*) AS n, round(avg((qa = qb)::INT), 6) AS category_agreement,
      round(avg((ta = tb)::INT), 6) AS section_agreement, round(avg((qa = qb AND ta = tb)::INT), 6) AS pair_agreement FROM j""",
    "agreement_counts": f"WITH {_RULE} SELECT ta AS section, qa AS actual, qb AS predicted, count(*) AS n FROM j GROUP BY ALL",
    "metric_rows": " UNION ALL ".join(
        _target(name, a, b, """SELECT '{name}' AS target, 'overall' AS metric_scope, NULL::VARCHAR AS class_label,
          round(sum(hits)::DOUBLE / sum(support), 6) AS accuracy, NULL::DOUBLE AS precision, NULL::DOUBLE AS recall, NULL::DOUBLE AS f1,
          round(avg(f), 6) AS macro_f1, round(sum(f * support) / sum(support), 6) AS weighted_f1, sum(support)::BIGINT AS support FROM k
          UNION ALL SELECT '{name}', 'class', l, NULL, round(p, 6), round(r, 6), round(f, 6), NULL, NULL, support FROM k""")
        for name, a, b in (("category", "qa", "qb"), ("section", "ta", "tb"))
    ),
    "nmi_ari": f"""(WITH w AS (SELECT lang AS x, source AS y FROM documents), {_CELLS} {_ALIGN.format(name='lang-source')})
      UNION ALL (WITH {VOTE}, w AS (SELECT actual AS x, predicted AS y FROM z), {_CELLS} {_ALIGN.format(name='label-vote')})""",
    "contingency_shares": """WITH c AS (SELECT source, lang, count(*) AS n FROM documents GROUP BY ALL)
      SELECT source, lang, n, round(n::DOUBLE / sum(n) OVER (PARTITION BY source), 6) AS share FROM c""",
}
