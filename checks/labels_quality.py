"""Label trees, responses, constraint checks, set algebra."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.common import ARTICLES, articles, table
from corpuslab.functions.columns import normalize_columns
from corpuslab.functions.labels import (
    Taxonomy, label_key, normalize_label, parent_of, parse_category, parse_pair, parse_section, section_bullets,
)
from corpuslab.operators import quality as q
from corpuslab.operators.evaluate import hierarchy_distribution
from corpuslab.operators.sets import class_domain, distinct_keys, frame_diff, unseen_classes


def _edges(spark, d):
    region, nation = table(spark, d, "region"), table(spark, d, "nation")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        normalize_label("r_name").alias("category"), normalize_label("n_name").alias("section"), "n_nationkey"
    )


def _tree(spark, d):
    return Taxonomy.from_frame(_edges(spark, d), "category", "section")


def _items(spark, d):
    """Customers as items; two segments carry a category that is wrong on purpose."""
    c = table(spark, d, "customer").join(_edges(spark, d), F.col("c_nationkey") == F.col("n_nationkey"))
    category = (
        F.when(F.col("c_mktsegment") == "BUILDING", F.lit("Atlantis "))
        .when(F.col("c_mktsegment") == "MACHINERY", F.lit(" ASIA"))
        .otherwise(F.upper("category"))
    )
    return c.select(F.col("c_custkey").alias("id"), category.alias("category"), F.upper("section").alias("section"))


def taxonomy_violations(spark, d):
    return q.check_hierarchy(_items(spark, d), "category", "section", _tree(spark, d), "id", limit=None)


def taxonomy_first_ten(spark, d):
    return q.check_hierarchy(_items(spark, d), "category", "section", _tree(spark, d), "id", limit=10)


def label_domain_check(spark, d):
    items = _items(spark, d).withColumn("category", normalize_label("category"))
    return q.check_label_domain(items, "category", _edges(spark, d).select("category").distinct())


def hierarchy_counts(spark, d):
    items = _items(spark, d).select(
        "id", normalize_label("category").alias("category"), normalize_label("section").alias("section")
    )
    return hierarchy_distribution(items, "category", "section", _edges(spark, d))


def parent_lookup(spark, d):
    items = _items(spark, d).withColumn("section", normalize_label("section"))
    by_join = parent_of(items, "section", _edges(spark, d), "joined_parent")
    return by_join.select(
        "id", "joined_parent", _tree(spark, d).parent_of("section").alias("mapped_parent"),
        F.md5(section_bullets(normalize_label("category"), _tree(spark, d))).alias("bullets_md5"),
    )


def unique_id_check(spark, d):
    return q.check_unique_id(table(spark, d, "conversations"), "conv_id")


def duplicate_texts(spark, d):
    return q.duplicate_rows(table(spark, d, "documents"), ["text"])


def blank_label_check(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "lang")
    labels = table(spark, d, "labels").select(
        "doc_id", F.when(F.col("toxic") == 1, F.lit("  ")).otherwise(F.col("quality").cast("string")).alias("quality")
    )
    return q.check_labels_present(docs.join(labels, "doc_id", "left"), ["lang", "quality"], "doc_id")


def blank_text_check(spark, d):
    """Descriptions that are missing from single-line documents."""
    return q.check_non_blank(articles(spark, d), "description", "id")


def frames_equal_check(spark, d):
    docs = table(spark, d, "documents")
    labelled = docs.join(table(spark, d, "labels"), "doc_id")
    return frame_diff(docs, labelled, ["lang", "source"])


def changed_rows_check(spark, d):
    """Original table against copies with changed, missing and label-only changes."""
    docs = table(spark, d, "documents").select("doc_id", "text", "lang", "source")
    changed = docs.filter(F.col("source") != "src3").withColumn(
        "text", F.when(F.col("lang") == "es", F.lower("text")).otherwise(F.col("text"))
    ).withColumn("lang", F.lit("xx"))
    same = q.check_same_except(docs, changed, "doc_id", ["lang"], "rows differ")
    copy = q.check_unlabelled(docs, docs.drop("lang", "source"), ["lang", "source"], "doc_id")
    split = q.check_split_rows(docs, changed.drop("lang"), "doc_id")
    return q.run_checks([same, copy, split])


def same_ids_check(spark, d):
    return q.check_same_ids(table(spark, d, "documents"), table(spark, d, "labels"), "doc_id")


def min_classes_check(spark, d):
    docs = table(spark, d, "documents")
    few = q.check_min_classes(docs, "lang", 5)
    return q.run_checks([few, q.check_min_classes(docs, "source", 2), q.check_schema(docs, ["doc_id", "title"])])


def prediction_check(spark, d):
    labels, docs = table(spark, d, "labels"), table(spark, d, "documents")
    pred = labels.select("doc_id", F.concat(F.lit("q"), F.col("quality").cast("string")).alias("predicted"))
    pred = pred.unionByName(labels.filter("toxic = 1").select(
        "doc_id", F.concat(F.lit("q"), (F.col("toxic") + 8).cast("string")).alias("predicted")
    ))
    domain = labels.select(F.concat(F.lit("q"), F.col("quality").cast("string")).alias("l")).distinct()
    return q.check_predictions(pred, domain, docs, "doc_id", "predicted")


def unique_keys_check(spark, d):
    customers = table(spark, d, "customer").select("c_nationkey", "c_mktsegment")
    return q.check_unique_keys(customers, ["c_nationkey", "c_mktsegment"], limit=None)


def unseen_labels(spark, d):
    """Label domain of two tables and the labels only one of them has."""
    docs = table(spark, d, "documents")
    long_docs = docs.filter("n_chars > 12000").select("source")
    every = class_domain(docs.select("source"), long_docs).withColumn("kind", F.lit("domain"))
    return every.unionByName(unseen_classes(docs.select("source"), long_docs).withColumn("kind", F.lit("unseen")))


def distinct_key_table(spark, d):
    return distinct_keys(table(spark, d, "customer"), ["c_nationkey", "c_mktsegment"])


def label_normalization(spark, d):
    c = table(spark, d, "region")
    n = table(spark, d, "nation").join(c, F.col("n_regionkey") == F.col("r_regionkey"))
    raw = F.concat(F.lit("  "), F.initcap("r_name"), F.lit(" "), F.col("n_name"), F.lit("\t"))
    return n.select(
        "n_nationkey", normalize_label(raw).alias("hyphen"), normalize_label(raw, "lower").alias("lower"),
        normalize_label(raw, "strip").alias("strip"), label_key(F.nullif("r_name", F.lit("ASIA"))).alias("key"),
    )


def renamed_columns(spark, d):
    """Column names in several spellings, brought to the canonical ones."""
    odd = table(spark, d, "labels").toDF("Doc-ID ", "F1 Macro", "training labels")
    return normalize_columns(odd, {"f1_macro": "macro_f1", "training_labels": "label_source"})


def _responses(spark, d):
    """JSON answers made from the documents: one of nine forms each."""
    docs = table(spark, d, "documents").select("doc_id", "lang", "source", "n_chars")
    form = F.col("n_chars") % 9
    category = F.concat(F.upper("lang"), F.lit(" "))
    quoted = lambda k, v: F.concat(F.lit('{"' + k + '": "'), v, F.lit('"}'))
    answer = (
        F.when(form == 0, quoted("category", category))
        .when(form == 1, F.lit("  "))
        .when(form == 2, F.concat(F.lit('{"category": '), F.col("lang")))
        .when(form == 3, F.concat(F.lit('["'), F.col("lang"), F.lit('"]')))
        .when(form == 4, F.concat(F.lit('{"category": "'), F.col("lang"), F.lit('", "why": "'), F.col("source"), F.lit('"}')))
        .when(form == 5, quoted("label", F.col("lang")))
        .when(form == 6, F.concat(F.lit('{"category": '), F.col("n_chars").cast("string"), F.lit("}")))
        .when(form == 7, quoted("category", F.col("source")))
        .otherwise(quoted("category", F.lit(" ")))
    )
    return docs.withColumn("answer", answer)


_LANGS = Taxonomy({lang: (f"{lang}-news", f"{lang}-sport") for lang in ("de", "en", "es", "fr")})


def parse_responses(spark, d):
    r = parse_category("answer", _LANGS)
    return _responses(spark, d).select("doc_id", r["label"].alias("label"), r["error"].alias("error"))


def parse_section_responses(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "lang", "n_chars")
    short = F.col("n_chars") < 1000
    section = F.when(short, F.concat("lang", F.lit("-Sport"))).otherwise(F.lit("en news"))
    answer = F.concat(F.lit('{"section": "'), section, F.lit('"}'))
    pair = F.concat(F.lit('{"category": "'), "lang", F.lit('", "section": "'), section, F.lit('"}'))
    s, p = parse_section(answer, "lang", _LANGS), parse_pair(pair, _LANGS)
    return docs.select(
        "doc_id", s["label"].alias("section"), s["error"].alias("section_error"),
        p["category"].alias("pair_category"), p["section"].alias("pair_section"), p["error"].alias("pair_error"),
    )


QUERIES = {
    f.__name__: f
    for f in (
        taxonomy_violations, taxonomy_first_ten, label_domain_check, hierarchy_counts, parent_lookup, unique_id_check,
        duplicate_texts, blank_label_check, blank_text_check, frames_equal_check, changed_rows_check, same_ids_check,
        min_classes_check, prediction_check, unique_keys_check, unseen_labels, distinct_key_table,
        label_normalization, renamed_columns, parse_responses, parse_section_responses,
    )
}
QUERIES["hierarchy_distribution"] = QUERIES.pop("hierarchy_counts")

_EDGES = """e AS (SELECT replace(lower(r_name), ' ', '-') AS category, replace(lower(n_name), ' ', '-') AS section, n_nationkey
  FROM nation JOIN region ON n_regionkey = r_regionkey),
 i AS (SELECT c_custkey AS id, CASE c_mktsegment WHEN 'BUILDING' THEN 'atlantis' WHEN 'MACHINERY' THEN 'asia' ELSE category END AS c,
  section AS s, category AS parent FROM customer JOIN e ON c_nationkey = n_nationkey)"""
_BAD = f"""WITH {_EDGES}, v AS (SELECT id, CASE WHEN c NOT IN (SELECT category FROM e) THEN 'unknown category: ' || c
  WHEN c <> parent THEN s || ' belongs to ' || parent || ', not ' || c END AS detail FROM i)
  SELECT 'invalid pair' AS "check", id::VARCHAR AS key, detail FROM v WHERE detail IS NOT NULL"""

ORACLE = {
    "taxonomy_violations": _BAD,
    "taxonomy_first_ten": _BAD + " ORDER BY id LIMIT 10",
    "label_domain_check": f"""WITH {_EDGES} SELECT 'category outside domain' AS "check", c AS key, count(*) || ' rows' AS detail
      FROM i WHERE c NOT IN (SELECT category FROM e) GROUP BY c""",
    "hierarchy_distribution": f"""WITH {_EDGES} SELECT category, section, count(i.id) AS n FROM e
      LEFT JOIN i ON i.c = e.category AND i.s = e.section GROUP BY ALL""",
    "parent_lookup": f"""WITH {_EDGES}, b AS (SELECT category, md5(string_agg('- ' || section, chr(10) ORDER BY section)) AS m FROM e GROUP BY 1)
      SELECT id, parent AS joined_parent, parent AS mapped_parent, m AS bullets_md5 FROM i LEFT JOIN b ON b.category = i.c""",
    "unique_id_check": """SELECT 'duplicate id' AS "check", conv_id::VARCHAR AS key, count(*) || ' rows' AS detail
      FROM conversations GROUP BY conv_id HAVING count(*) > 1""",
    "duplicate_texts": """SELECT count(*) AS n_keys, coalesce(sum(n), 0)::BIGINT AS n_rows FROM
      (SELECT count(*) AS n FROM documents GROUP BY text HAVING count(*) > 1)""",
    "blank_label_check": """SELECT 'missing label' AS "check", d.doc_id::VARCHAR AS key,
      CASE WHEN l.doc_id IS NULL THEN 'quality is null' ELSE 'quality is blank' END AS detail
      FROM documents d LEFT JOIN labels l USING (doc_id) WHERE l.doc_id IS NULL OR toxic = 1""",
    "blank_text_check": rf"""WITH {ARTICLES} SELECT 'blank text' AS "check", id::VARCHAR AS key, 'description' AS detail FROM a
      WHERE regexp_replace(description, '^\s+|\s+$', '', 'g') = ''""",
    "frames_equal_check": """WITH l AS (SELECT lang, source, count(*) AS n FROM documents GROUP BY ALL),
      r AS (SELECT lang, source, count(*) AS n FROM documents JOIN labels USING (doc_id) GROUP BY ALL)
      SELECT lang, source, coalesce(l.n, 0) AS n_left, coalesce(r.n, 0) AS n_right FROM l FULL JOIN r USING (lang, source)
      WHERE coalesce(l.n, 0) <> coalesce(r.n, 0)""",
    "changed_rows_check": """WITH c AS (SELECT doc_id, lang, source = 'src3' AS gone, lang = 'es' AND lower(text) <> text AS edited FROM documents),
      k AS (SELECT unnest([0, 1]) AS side)
      SELECT 'rows differ' AS "check", doc_id::VARCHAR AS key,
        CASE WHEN side = 0 THEN '1 left, 0 right' ELSE '0 left, 1 right' END AS detail
        FROM c, k WHERE (gone AND side = 0) OR (NOT gone AND edited)
      UNION ALL SELECT 'split row', doc_id::VARCHAR, 'values differ' FROM c WHERE NOT gone AND edited""",
    "same_ids_check": """SELECT 'id sets differ' AS "check", doc_id::VARCHAR AS key, 'only in the first table' AS detail FROM documents
      WHERE doc_id NOT IN (SELECT doc_id FROM labels)""",
    "min_classes_check": """SELECT 'too few classes' AS "check", 'lang' AS key, count(DISTINCT lang)::VARCHAR AS detail FROM documents
      HAVING count(DISTINCT lang) < 5 UNION ALL SELECT 'missing column', 'title', 'column title is required'""",
    "prediction_check": """SELECT 'predicted outside domain' AS "check", 'q9' AS key, count(*) || ' rows' AS detail FROM labels WHERE toxic = 1
      UNION ALL SELECT 'predictions per id', doc_id::VARCHAR, CASE WHEN l.doc_id IS NULL THEN '0' ELSE '2' END
      FROM documents d LEFT JOIN labels l USING (doc_id) WHERE l.doc_id IS NULL OR toxic = 1""",
    "unique_keys_check": """SELECT 'duplicate key' AS "check", c_nationkey || ' | ' || c_mktsegment AS key, count(*)::VARCHAR AS detail
      FROM customer GROUP BY c_nationkey, c_mktsegment HAVING count(*) > 1""",
    "unseen_labels": """SELECT DISTINCT source AS label, 'domain' AS kind FROM documents
      UNION ALL SELECT source, 'unseen' FROM (SELECT source FROM documents EXCEPT SELECT source FROM documents WHERE n_chars > 12000)""",
    "distinct_key_table": "SELECT DISTINCT c_nationkey, c_mktsegment FROM customer",
    "label_normalization": """WITH r AS (SELECT n_nationkey, r_name, array_to_string(list_transform(string_split(r_name, ' '),
        lambda w: upper(w[1]) || lower(w[2:])), ' ') || ' ' || n_name AS raw FROM nation JOIN region ON n_regionkey = r_regionkey)
      SELECT n_nationkey, replace(lower(raw), ' ', '-') AS hyphen, lower(raw) AS lower, raw AS strip,
      CASE WHEN r_name = 'ASIA' THEN '' ELSE lower(r_name) END AS key FROM r""",
    "renamed_columns": "SELECT doc_id, quality AS macro_f1, toxic AS label_source FROM labels",
    "parse_responses": """SELECT doc_id, CASE WHEN n_chars % 9 = 0 THEN lang END AS label,
      CASE n_chars % 9 WHEN 1 THEN 'empty response' WHEN 2 THEN 'invalid json' WHEN 3 THEN 'not an object'
        WHEN 4 THEN 'unexpected fields: why' WHEN 5 THEN 'unexpected fields: label' WHEN 6 THEN 'category is not a string'
        WHEN 7 THEN 'unknown category: ' || source WHEN 8 THEN 'category is blank' END AS error FROM documents""",
    "parse_section_responses": """WITH x AS (SELECT doc_id, lang, CASE WHEN n_chars < 1000 THEN lang || '-sport' ELSE 'en-news' END AS s FROM documents),
      y AS (SELECT *, CASE WHEN left(s, 2) <> lang THEN s || ' belongs to en, not ' || lang END AS e FROM x)
      SELECT doc_id, CASE WHEN e IS NULL THEN s END AS section, e AS section_error, CASE WHEN e IS NULL THEN lang END AS pair_category,
      CASE WHEN e IS NULL THEN s END AS pair_section, e AS pair_error FROM y""",
}
