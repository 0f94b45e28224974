"""Labelling runs, their audit, the stream form, incremental encoding."""

from __future__ import annotations

import json

import numpy as np
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks.common import articles, table
from corpuslab.functions.labels import Taxonomy
from corpuslab.operators import labelling as lb
from corpuslab.operators import quality as q
from corpuslab.operators.encoding import encode_incremental
from corpuslab.operators.sets import latest, upsert
from corpuslab.session import scratch_path
from corpuslab.sources.audit import AuditLog, run_labelling
from corpuslab.streaming.labels import label_stream

LANGS = Taxonomy({lang: (f"{lang}-long", f"{lang}-short") for lang in ("de", "en", "es", "fr")})


def _audit(spark, d):
    """An audit made from the label table: bad documents failed, toxic ones are half empty."""
    good = F.col("quality") == 1
    rows = table(spark, d, "labels").join(table(spark, d, "documents"), "doc_id")
    return rows.select(
        F.col("doc_id").alias("id"),
        F.upper("lang").alias("original_category"), F.col("source").alias("original_section"),
        F.when(good, F.col("lang")).otherwise("").alias("llm_category"),
        F.when(good, F.concat("lang", F.lit("-"), "source")).otherwise("").alias("llm_section"),
        F.when(F.col("toxic") == 1, " ").otherwise("rule").alias("llm_model"),
        F.when(good, "success").otherwise("section_validation_failed").alias("status"),
        F.when(F.col("lang") == "fr", "none").otherwise(F.col("n_chars").cast("string")).alias("category_processing_time_seconds"),
        F.when(good, 1).otherwise(0).alias("category_request_attempts"),
        (F.col("n_chars") - 100).cast("double").alias("section_processing_time_seconds"),
        F.lit(1.0).alias("total_processing_time_seconds"),
    )


def pending_anti_join(spark, d):
    return lb.pending(table(spark, d, "documents").select("doc_id", "lang"), _audit(spark, d), "doc_id")


def labelled_inner(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "lang", "source", "n_chars")
    return lb.apply_labels(docs, _audit(spark, d), "doc_id", "lang", "source")


def labelled_set_check(spark, d):
    """A labelled set without the failed rows, with sections the tree lacks (src7) and changed lengths (fr)."""
    train = table(spark, d, "documents").select("doc_id", "lang", "source", "n_chars")
    done = lb.apply_labels(train, _audit(spark, d), "doc_id", "lang", "source")
    done = done.withColumn("n_chars", F.when(F.col("lang") == "fr", -F.col("n_chars")).otherwise(F.col("n_chars")))
    edges = train.filter("source <> 'src7'").select("lang", F.concat("lang", F.lit("-"), "source").alias("section"))
    tree = Taxonomy.from_frame(edges, "lang", "section")
    return q.check_labelled_set(train, done, _audit(spark, d), tree, "doc_id", "lang", "source")


def audit_order(spark, d):
    """A log written in reverse and compacted: whether every record follows a smaller id in its file."""
    schema = T.StructType([
        T.StructField("id", T.LongType()), T.StructField("status", T.StringType()), T.StructField("generated_at_utc", T.StringType()),
    ])
    path = scratch_path(spark, "audit-order")
    log = AuditLog(spark, scratch_path(spark, "audit-order"), schema, 4)
    rows = table(spark, d, "labels").select(
        F.col("doc_id").alias("id"), F.lit("success").alias("status"), F.lit("2024-01-01").alias("generated_at_utc")
    )
    log.append(rows.orderBy(F.desc("id")))
    log.compact(path)
    stored = spark.read.parquet(path).select(
        "id", F.input_file_name().alias("file"), F.monotonically_increasing_id().alias("place")
    )
    before = F.lag("id").over(W.partitionBy("file").orderBy("place"))
    return stored.select("id", F.coalesce(before < F.col("id"), F.lit(True)).alias("in_order"))


def audit_upsert(spark, d):
    """Failed records replaced by a second run; all others kept."""
    base = _audit(spark, d).select("id", "llm_category", "status")
    second = table(spark, d, "documents").filter("n_chars > 3000").select(
        F.col("doc_id").alias("id"), F.lit("second").alias("llm_category"), F.lit("success").alias("status")
    )
    return upsert(base, second, "id")


def audit_latest(spark, d):
    """The last turn of every conversation, as a log keyed by conversation."""
    log = table(spark, d, "conversations").select(F.col("conv_id").alias("id"), "turn", "role", F.md5("text").alias("text_md5"))
    return latest(log, "id", ["turn", "role"])


def audit_metadata_check(spark, d):
    return q.check_audit_metadata(_audit(spark, d))


def audit_status_check(spark, d):
    return q.check_audit_status(_audit(spark, d))


def audit_agreement_check(spark, d):
    docs = table(spark, d, "documents").select(
        F.col("doc_id").alias("id"), F.col("lang").alias("category"), F.col("source").alias("section")
    )
    labelled = lb.apply_labels(docs, _audit(spark, d), "id").withColumn(
        "section", F.when(F.col("category") == "es", F.lit("other")).otherwise(F.col("section"))
    )
    return q.check_audit_agrees(docs, labelled, _audit(spark, d))


def labelling_time(spark, d):
    return lb.labelling_time(_audit(spark, d))


def status_counts(spark, d):
    return lb.status_counts(_audit(spark, d))


class LengthLabeler:
    """Labels by rule: the language stated in the prompt, and text length.

    Texts of up to 50 characters get a label outside the tree, texts of more
    than 10 000 characters fail.
    """

    def __call__(self, texts):
        return [self._one(t) for t in texts]

    def _one(self, prompt):
        step, lang, body = prompt.split("\x1f")
        if len(body) > 10_000:
            raise RuntimeError("text too long")
        if step == "C":
            return lb.Response(json.dumps({"category": lang.upper()}), "rule-1", len(body), 1)
        if len(body) <= 50:
            return json.dumps({"section": "none"})
        return json.dumps({"section": f"{lang}-{'long' if len(body) > 1000 else 'short'}"})


class TailLabeler(LengthLabeler):
    """Ignores the tail that the section template adds behind the text."""

    def _one(self, prompt):
        return super()._one(prompt.split("\x1e")[0])


def _label_articles(rows):
    return lb.label_hierarchical(
        rows.withColumn("title", F.col("category")).withColumn("none", F.lit("")), TailLabeler, LANGS,
        "C\x1f{TITLE}\x1f{ARTICLE}{DESCRIPTION}",
        "S\x1f{TITLE}\x1f{ARTICLE}{DESCRIPTION}\x1e{CATEGORY}\x1e{VALID_SECTIONS}",
        title="title", description="none", attempts=2, model="rule",
    )


AUDITED = ["id", "llm_category", "llm_section", "llm_model", "status", "category_validation_error",
           "section_validation_error", "category_request_attempts", "section_request_attempts",
           "category_prompt_token_count"]


def label_hierarchical(spark, d):
    """Two-step labelling of all documents; the audit is written, then read."""
    log = AuditLog(spark, scratch_path(spark, "audit"))
    log.append(_label_articles(articles(spark, d)))
    return log.current().select(*AUDITED)


def resumed_labelling(spark, d):
    """Two runs over one log in several checkpoints: the second asks for failures only."""
    log = AuditLog(spark, scratch_path(spark, "audit"))
    docs = articles(spark, d)
    run_labelling(docs, log, _label_articles, batches=3)
    labelled = run_labelling(docs, log, _label_articles)
    return labelled.select("id", "category", "section")


def stream_label(spark, d):
    """Documents arrive as a stream of files and are labelled into the audit."""
    inbox, log = scratch_path(spark, "inbox"), AuditLog(spark, scratch_path(spark, "audit"))
    docs = articles(spark, d)
    files = max(3, table(spark, d, "documents").rdd.getNumPartitions())  # as many as the scan has splits, so that no task takes a fixed share of all
    docs.repartition(files, "id").write.parquet(inbox)
    docs.filter(F.col("category") == "fr").write.mode("append").parquet(inbox)  # delivered twice
    stream = spark.readStream.schema(docs.schema).parquet(inbox)
    query = label_stream(stream, _label_articles, log, scratch_path(spark, "stream"))
    query.awaitTermination()
    return log.current().select(*AUDITED)


class LetterEncoder:
    """Counts of a few letters: a small deterministic stand-in for a model."""

    def __call__(self, texts):
        return np.array([[t.count(c) for c in "aeinrst"] + [1] for t in texts], dtype=np.float32)


def encode_incremental_texts(spark, d):
    """A first run over one half, a second over all: only the rest is encoded again."""
    store = scratch_path(spark, "store")
    docs = articles(spark, d)
    encode_incremental(docs.filter("category = 'en'"), "id", "body", LetterEncoder, "letters-1", store)
    out = encode_incremental(docs, "id", "body", LetterEncoder, "letters-1", store)
    return out.select("id", F.transform("embedding", lambda x: F.round(x.cast("double"), 5)).alias("embedding"))


QUERIES = {
    f.__name__: f
    for f in (
        pending_anti_join, labelled_inner, audit_upsert, audit_latest, audit_metadata_check, audit_status_check,
        audit_agreement_check, labelling_time, status_counts, label_hierarchical, resumed_labelling, stream_label,
        labelled_set_check, audit_order,
    )
}
QUERIES["encode_incremental"] = encode_incremental_texts

_AUDIT = """au AS (SELECT doc_id AS id, lang, source, quality = 1 AS good, toxic, n_chars,
  CASE WHEN quality = 1 THEN 'success' ELSE 'section_validation_failed' END AS status
  FROM labels JOIN documents USING (doc_id))"""
_STRIP = r"regexp_replace(text, '^\s+|\s+$', '', 'g')"
_RUN = rf"""x AS (SELECT doc_id AS id, lang, length({_STRIP}) AS n FROM documents),
 y AS (SELECT id, lang, n, CASE WHEN n > 10000 THEN 'request_failed' WHEN n <= 50 THEN 'section_validation_failed' ELSE 'success' END AS status FROM x)"""
_RECORDS = f"""WITH {_RUN} SELECT id, CASE WHEN status = 'success' THEN lang ELSE '' END AS llm_category,
  CASE WHEN status = 'success' THEN lang || CASE WHEN n > 1000 THEN '-long' ELSE '-short' END ELSE '' END AS llm_section,
  CASE WHEN n > 10000 THEN 'rule' ELSE 'rule-1' END AS llm_model, status,
  CASE WHEN n > 10000 THEN 'text too long' ELSE '' END AS category_validation_error,
  CASE WHEN n <= 50 THEN 'unknown section: none' ELSE '' END AS section_validation_error,
  1 AS category_request_attempts, CASE WHEN n > 10000 THEN 0 WHEN n <= 50 THEN 2 ELSE 1 END AS section_request_attempts,
  CASE WHEN n <= 10000 THEN n::INT END AS category_prompt_token_count FROM y"""
_COUNTS = ", ".join(f"(length(text) - length(replace(text, '{c}', '')))::DOUBLE" for c in "aeinrst")

ORACLE = {
    "pending_anti_join": """SELECT doc_id, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 1)""",
    "labelled_inner": f"""WITH {_AUDIT} SELECT id AS doc_id, lang, lang || '-' || source AS source, n_chars FROM au WHERE good""",
    "labelled_set_check": f"""WITH {_AUDIT} SELECT 'audit status' AS "check", status AS key, count(*)::VARCHAR AS detail FROM au
        WHERE NOT good GROUP BY status
      UNION ALL SELECT 'id sets differ', doc_id::VARCHAR, 'only in the first table' FROM documents
        WHERE doc_id NOT IN (SELECT id FROM au WHERE good)
      UNION ALL SELECT 'invalid pair', id::VARCHAR, 'unknown section: ' || lang || '-' || source FROM au WHERE good AND source = 'src7'
      UNION ALL SELECT 'non-label data changed', doc_id::VARCHAR, '1 left, 0 right' FROM documents
        WHERE doc_id NOT IN (SELECT id FROM au WHERE good) OR (lang = 'fr' AND n_chars <> 0)
      UNION ALL SELECT 'non-label data changed', id::VARCHAR, '0 left, 1 right' FROM au WHERE good AND lang = 'fr' AND n_chars <> 0""",
    "audit_order": "SELECT doc_id AS id, true AS in_order FROM labels",
    "audit_upsert": f"""WITH {_AUDIT} SELECT id, CASE WHEN good THEN lang ELSE '' END AS llm_category, status FROM au WHERE n_chars <= 3000
      UNION ALL SELECT doc_id, 'second', 'success' FROM documents WHERE n_chars > 3000""",
    "audit_latest": """SELECT conv_id AS id, turn, role, md5(text) AS text_md5 FROM conversations
      QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC, role DESC) = 1""",
    "audit_metadata_check": f"""WITH {_AUDIT}, v AS (SELECT id, unnest([CASE WHEN toxic = 1 THEN 'llm_model is blank' END,
        CASE WHEN NOT good THEN 'category_request_attempts is below 1 or no number' END,
        CASE WHEN lang = 'fr' THEN 'category_processing_time_seconds is below 0 or no number' END,
        CASE WHEN n_chars < 100 THEN 'section_processing_time_seconds is below 0 or no number' END]) AS detail FROM au)
      SELECT 'audit metadata' AS "check", id::VARCHAR AS key, detail FROM v WHERE detail IS NOT NULL""",
    "audit_status_check": f"""WITH {_AUDIT} SELECT 'audit status' AS "check", status AS key, count(*)::VARCHAR AS detail FROM au
      WHERE NOT good GROUP BY status""",
    "audit_agreement_check": f"""WITH {_AUDIT}, v AS (SELECT d.doc_id, unnest([
        CASE WHEN a.id IS NULL OR NOT a.good THEN '0 rows in labelled' END, CASE WHEN a.id IS NULL THEN '0 rows in audit' END,
        CASE WHEN a.good AND d.lang = 'es' THEN 'label section differs' END]) AS detail FROM documents d LEFT JOIN au a ON a.id = d.doc_id)
      SELECT 'audit agreement' AS "check", doc_id::VARCHAR AS key, detail FROM v WHERE detail IS NOT NULL""",
    "labelling_time": f"""WITH {_AUDIT} SELECT coalesce(sum(n_chars) FILTER (lang <> 'fr'), 0)::DOUBLE AS category_seconds,
      sum(n_chars - 100)::DOUBLE AS section_seconds, count(*)::DOUBLE AS total_seconds FROM au""",
    "status_counts": f"WITH {_AUDIT} SELECT status, count(*) AS n FROM au GROUP BY status",
    "label_hierarchical": _RECORDS,
    "resumed_labelling": f"""WITH {_RUN} SELECT id, lang AS category, lang || CASE WHEN n > 1000 THEN '-long' ELSE '-short' END AS section
      FROM y WHERE status = 'success'""",
    "stream_label": _RECORDS,
    "encode_incremental": f"""WITH c AS (SELECT doc_id AS id, [{_COUNTS}, 1::DOUBLE] AS v FROM documents),
      n AS (SELECT id, v, sqrt(list_inner_product(v, v)) AS s FROM c)
      SELECT id, list_transform(v, lambda x: round((x / s)::FLOAT::DOUBLE, 5)) AS embedding FROM n""",
}
