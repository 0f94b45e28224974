"""Profiles, splits and distributions."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.common import ARTICLES, SPLIT, articles, normalized, split_documents, stripped, table, words
from corpuslab.functions import text as tx
from corpuslab.functions.columns import exclude_values, for_category, pct, rounded, strip_labels
from corpuslab.operators import profile as pf
from corpuslab.operators.quality import check_partition
from corpuslab.operators.quantiles import exact_quantiles, trim_quantile
from corpuslab.operators.sets import mark_duplicates, partition_check, with_row_index
from corpuslab.session import materialize

PUBLISHER = "WIRE"
UP = "half_up"


def label_distribution(spark, d):
    return pf.label_distribution(articles(spark, d), "category", mode=UP)


def even_percentages(spark, d):
    """Quantities as percentages of 800, of which every other one lies half way between two hundredths."""
    counts = table(spark, d, "lineitem").groupBy(F.col("l_quantity").cast("long").alias("quantity")).agg(F.count(F.lit(1)).alias("n"))
    return counts.select(
        "quantity", "n", pct("quantity", F.lit(800)).alias("even"), pct("quantity", F.lit(800), mode=UP).alias("half_up"),
        rounded(F.col("quantity") / 4, 1).alias("even_tenth"),
    )


def rare_labels(spark, d):
    return pf.rare_labels(table(spark, d, "customer"), "c_nationkey", 60)


def class_balance(spark, d):
    return pf.class_balance(articles(spark, d), "section")


def stratified_split(spark, d):
    return split_documents(spark, d).select("doc_id", "lang", "split")


def split_distribution(spark, d):
    return pf.split_distribution(split_documents(spark, d), "lang", mode=UP)


def merge_counts(spark, d):
    docs = split_documents(spark, d)
    side = lambda s: docs.filter(F.col("split") == s).groupBy("source").agg(F.count(F.lit(1)).alias(f"n_{s}"))
    return pf.merge_counts(side("train"), side("test"), "source")


def stratified_split_check(spark, d):
    docs = split_documents(spark, d)
    whole = table(spark, d, "documents")
    part = lambda s: docs.filter(F.col("split") == s)
    bad = check_partition(whole, [part("train"), part("test")], "doc_id")
    return bad.agg(F.count(F.lit(1)).alias("violations"))


def partition_problems(spark, d):
    labels = table(spark, d, "labels")
    parts = [labels.filter("quality = 1"), labels.filter("toxic = 1")]
    return partition_check(table(spark, d, "documents"), parts, "doc_id")


def column_profile(spark, d):
    return pf.column_profile(table(spark, d, "orders"), mode=UP)


def quality_summary(spark, d):
    talk = table(spark, d, "conversations")
    return pf.quality_summary(talk, id="conv_id", url="text", date="role", labels=["role"], texts=["text"])


def duplicate_marks(spark, d):
    docs = table(spark, d, "documents")
    first = mark_duplicates(docs, ["text"], "first", "doc_id").select("doc_id", F.col("is_duplicate").alias("later_copy"))
    every = mark_duplicates(docs, ["text"], "none").select("doc_id", F.col("is_duplicate").alias("any_copy"))
    return first.join(every, "doc_id")


def _lengths(spark, d):
    return tx.add_text_lengths(articles(spark, d), "headline", "description", "body", PUBLISHER)


def text_lengths(spark, d):
    return _lengths(spark, d).select(
        "id", "headline_words", "headline_characters", "description_words", "description_characters",
        "body_words", "body_characters", "baseline_text_characters", "enhanced_text_characters",
        tx.n_tokens("body").alias("body_tokens"),
    )


def text_stats(spark, d):
    return pf.text_stats(_lengths(spark, d), ["headline_words", "description_words", "body_words"], mode=UP)


def category_stats(spark, d):
    return pf.category_stats(_lengths(spark, d), "category", mode=UP)


def representation_lengths(spark, d):
    cols = {"baseline": "baseline_text_characters", "enhanced": "enhanced_text_characters"}
    return pf.representation_lengths(_lengths(spark, d), cols, mode=UP)


def rows_by_year(spark, d):
    return pf.rows_by_year(table(spark, d, "orders"), "o_orderdate")


def date_range(spark, d):
    return pf.date_range(table(spark, d, "orders"), "o_orderdate")


def parsed_dates(spark, d):
    """Dates as text, some of them no dates, parsed back and counted by year."""
    o = table(spark, d, "orders")
    shown = F.when(F.col("o_orderstatus") == "P", F.col("o_orderpriority")).otherwise(
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    )
    parsed = o.select(tx.parse_ts(shown, "yyyy-MM-dd HH:mm:ss").alias("published_at"))
    return pf.rows_by_year(parsed, "published_at")


def crosstab_long(spark, d):
    return pf.crosstab_long(articles(spark, d), "section", "category")


def crosstab_wide(spark, d):
    return pf.crosstab(articles(spark, d), "section", "category", ["en", "fr", "de", "es"])


def histogram(spark, d):
    out = pf.histogram(table(spark, d, "events"), "value", 40)
    return out.select("bin", F.round("lower", 6).alias("lower"), F.round("upper", 6).alias("upper"), "n")


def histogram_trimmed(spark, d):
    lengths = materialize(articles(spark, d).select(tx.count_words("body").alias("body_words")), "lengths")
    out = pf.histogram(trim_quantile(lengths, "body_words", 0.99), "body_words", 50)
    return out.select("bin", F.round("lower", 6).alias("lower"), F.round("upper", 6).alias("upper"), "n")


def box_stats(spark, d):
    out = pf.box_stats(table(spark, d, "events"), "value", "event_type")
    values = ["q1", "median", "q3", "whisker_low", "whisker_high"]
    return out.select("event_type", *[F.round(c, 6).alias(c) for c in values], "n_outliers", "n")


def exact_quantile_table(spark, d):
    out = exact_quantiles(table(spark, d, "lineitem"), "l_extendedprice", [0.0, 0.5, 0.95, 1.0], ["l_returnflag"])
    return out.select("l_returnflag", "prob", F.round("quantile", 6).alias("quantile"))


def row_index(spark, d):
    return with_row_index(table(spark, d, "documents").select("doc_id", "lang"), ["lang", "doc_id"])


def unlabelled(spark, d):
    docs = strip_labels(articles(spark, d), ["category", "section"])
    return docs.select("id", F.md5("headline").alias("headline"), F.md5("body").alias("body"))


def without_structural(spark, d):
    """Category filter and measure exclusion before a count."""
    docs = for_category(articles(spark, d), "en")
    return exclude_values(pf.crosstab_long(docs, "section", "category"), "section", ["src0", "src1"])


_LEN = f"""WITH {ARTICLES}, f AS (SELECT id, category,
  {words('headline')} AS headline_words, length(headline) AS headline_characters,
  {words('description')} AS description_words, length(description) AS description_characters,
  {words('body')} AS body_words, length(body) AS body_characters,
  array_to_string(list_filter([{stripped('headline')}, {stripped('description')}, {stripped('body')}],
    lambda x: x <> ''), chr(10) || chr(10)) AS baseline,
  array_to_string(list_filter([
    trim(regexp_replace({normalized('headline')}, '(?i)\\s*-\\s*WIRE\\s*$', '')), {normalized('description')},
    trim(regexp_replace({normalized('body')}, '^[A-Z][A-Za-z .''-]+\\s*\\(WIRE\\)\\s*[-—:]?\\s*', ''))],
    lambda x: x <> ''), '. ') AS enhanced,
  len(regexp_extract_all(body, '\\S+')) AS body_tokens FROM a)"""

_HIST = """, r AS (SELECT min(v) AS lo, max(v) AS hi FROM x), k AS (SELECT unnest(range(0, {b}))::INT AS bin),
 c AS (SELECT least(floor((v - lo) / ((hi - lo) / {b})), {b} - 1)::INT AS bin, count(*) AS n FROM x, r GROUP BY 1)
 SELECT k.bin, round(lo + k.bin * ((hi - lo) / {b}), 6) AS lower, round(lo + (k.bin + 1) * ((hi - lo) / {b}), 6) AS upper,
 coalesce(n, 0) AS n FROM k CROSS JOIN r LEFT JOIN c ON c.bin = k.bin"""


def _profile_sql() -> str:
    types = {"o_orderkey": "bigint", "o_custkey": "bigint", "o_orderstatus": "string", "o_totalprice": "double",
             "o_orderdate": "timestamp_ntz", "o_orderpriority": "string"}
    one = """SELECT '{c}' AS "column", '{t}' AS data_type, count(*) - count({c}) AS missing,
      round((count(*) - count({c}))::DOUBLE / count(*) * 100, 2) AS missing_pct,
      count(DISTINCT {c}) AS n_distinct FROM orders"""
    return " UNION ALL ".join(one.format(c=c, t=t) for c, t in types.items())


_STAT = """SELECT '{f}' AS field, round(avg({f}), 1) AS mean, round(median({f}), 1) AS median,
  round(stddev_samp({f}), 1) AS sd, round(quantile_cont({f}, 0.9), 1) AS p90, round(quantile_cont({f}, 0.95), 1) AS p95,
  max({f})::INT AS maximum, count_if({f} = 0)::BIGINT AS n_zero FROM f"""
_REP = """SELECT '{f}' AS representation, round(avg(length({f})), 1) AS mean_characters,
  round(median(length({f})), 1) AS median_characters, round(quantile_cont(length({f}), 0.9), 1) AS p90_characters,
  max(length({f}))::INT AS maximum_characters FROM f"""

QUERIES = {
    f.__name__: f
    for f in (
        label_distribution, rare_labels, class_balance, stratified_split, split_distribution, merge_counts,
        stratified_split_check, partition_problems, column_profile, quality_summary, duplicate_marks,
        text_lengths, text_stats, category_stats, representation_lengths, rows_by_year, date_range,
        parsed_dates, crosstab_long, crosstab_wide, histogram, histogram_trimmed, box_stats,
        exact_quantile_table, row_index, unlabelled, without_structural, even_percentages,
    )
}

ORACLE = {
    "label_distribution": """SELECT lang AS category, count(*) AS n,
      round(count(*)::DOUBLE / (SELECT count(*) FROM documents) * 100, 2) AS percentage FROM documents GROUP BY lang""",
    "even_percentages": """WITH q AS (SELECT l_quantity::BIGINT AS quantity, count(*) AS n FROM lineitem GROUP BY 1),
      p AS (SELECT *, quantity::DOUBLE / 800 * 100 AS share, quantity * 10 // 4 AS tenths, quantity * 10 % 4 AS rest FROM q)
      SELECT quantity, n, round_even(share, 2) AS even, round(share, 2) AS half_up,
        (tenths + CASE WHEN rest > 2 OR (rest = 2 AND tenths % 2 = 1) THEN 1 ELSE 0 END) / 10 AS even_tenth FROM p""",
    "rare_labels": """SELECT c_nationkey, count(*) AS n,
      (SELECT count(DISTINCT c_nationkey) FROM customer) AS n_labels FROM customer GROUP BY 1 HAVING count(*) < 60""",
    "class_balance": """SELECT count(*) AS n_classes, min(n) AS smallest, max(n) AS largest
      FROM (SELECT source, count(*) AS n FROM documents GROUP BY source)""",
    "stratified_split": f"WITH {SPLIT} SELECT doc_id, lang, split FROM split",
    "split_distribution": f"""WITH {SPLIT}, t AS (SELECT count_if(split = 'train') AS a, count_if(split = 'test') AS b FROM split),
      c AS (SELECT lang, count_if(split = 'train') AS x, count_if(split = 'test') AS y FROM split GROUP BY lang)
      SELECT lang, x::BIGINT AS n_train, y::BIGINT AS n_test, round(x::DOUBLE / a * 100, 2) AS pct_train,
      round(y::DOUBLE / b * 100, 2) AS pct_test,
      round(abs(x::DOUBLE / a * 100 - y::DOUBLE / b * 100), 2) AS point_difference FROM c, t""",
    "merge_counts": f"""WITH {SPLIT} SELECT source, count_if(split = 'train')::BIGINT AS n_train,
      count_if(split = 'test')::BIGINT AS n_test FROM split GROUP BY source""",
    "stratified_split_check": f"""WITH {SPLIT} SELECT count(*) AS violations FROM documents d
      LEFT JOIN split USING (doc_id) WHERE split.split IS NULL""",
    "partition_problems": """WITH q AS (SELECT doc_id FROM labels WHERE quality = 1), t AS (SELECT doc_id FROM labels WHERE toxic = 1)
      SELECT doc_id AS id, 'missing' AS problem FROM documents WHERE doc_id NOT IN (FROM q) AND doc_id NOT IN (FROM t)
      UNION ALL SELECT doc_id, 'unexpected' FROM (FROM q UNION FROM t) WHERE doc_id NOT IN (SELECT doc_id FROM documents)
      UNION ALL SELECT doc_id, 'overlap' FROM q WHERE doc_id IN (FROM t)""",
    "column_profile": _profile_sql(),
    "quality_summary": """WITH c AS (FROM conversations) SELECT 'rows' AS measure, count(*) AS value FROM c
      UNION ALL SELECT 'columns', 4
      UNION ALL SELECT 'duplicate_rows', count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM c)) FROM c
      UNION ALL SELECT 'duplicate_ids', count(*) - count(DISTINCT conv_id) FROM c
      UNION ALL SELECT 'duplicate_urls', count(*) - count(DISTINCT text) FROM c
      UNION ALL SELECT 'missing_values', (4 * count(*) - count(conv_id) - count(turn) - count(role) - count(text))::BIGINT FROM c
      UNION ALL SELECT 'bad_dates', count_if(TRY_CAST(role AS TIMESTAMP) IS NULL)::BIGINT FROM c
      UNION ALL SELECT 'missing_role', count_if(role IS NULL)::BIGINT FROM c
      UNION ALL SELECT 'blank_text', count_if(trim(coalesce(text, '')) = '')::BIGINT FROM c""",
    "duplicate_marks": """SELECT doc_id, row_number() OVER (PARTITION BY text ORDER BY doc_id) > 1 AS later_copy,
      count(*) OVER (PARTITION BY text) > 1 AS any_copy FROM documents""",
    "text_lengths": _LEN + """ SELECT id, headline_words::INT AS headline_words, headline_characters::INT AS headline_characters,
      description_words::INT AS description_words, description_characters::INT AS description_characters,
      body_words::INT AS body_words, body_characters::INT AS body_characters,
      length(baseline)::INT AS baseline_text_characters, length(enhanced)::INT AS enhanced_text_characters,
      body_tokens::INT AS body_tokens FROM f""",
    "text_stats": _LEN + " UNION ALL ".join(
        _STAT.format(f=f) for f in ("headline_words", "description_words", "body_words")
    ).join((" ", "")),
    "category_stats": _LEN + """ SELECT category, count(*) AS n, round(median(headline_words), 1) AS median_headline_words,
      round(median(description_words), 1) AS median_description_words, round(median(body_words), 1) AS median_body_words,
      round(avg(body_words), 1) AS mean_body_words FROM f GROUP BY category""",
    "representation_lengths": _LEN + " " + " UNION ALL ".join(_REP.format(f=f) for f in ("baseline", "enhanced")),
    "rows_by_year": "SELECT year(o_orderdate)::INT AS year, count(*) AS n FROM orders GROUP BY 1",
    "date_range": """SELECT min(o_orderdate) AS first, max(o_orderdate) AS last, count(o_orderdate) AS n_dated FROM orders""",
    "parsed_dates": """SELECT year(o_orderdate)::INT AS year, count(*) AS n FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1""",
    "crosstab_long": "SELECT source AS section, lang AS category, count(*) AS n FROM documents GROUP BY ALL",
    "crosstab_wide": """SELECT source AS section, count_if(lang = 'en')::BIGINT AS en, count_if(lang = 'fr')::BIGINT AS fr,
      count_if(lang = 'de')::BIGINT AS de, count_if(lang = 'es')::BIGINT AS es FROM documents GROUP BY source""",
    "histogram": "WITH x AS (SELECT value AS v FROM events WHERE value IS NOT NULL AND NOT isnan(value))" + _HIST.format(b=40),
    "histogram_trimmed": f"""WITH w AS (SELECT {words('text')}::DOUBLE AS v FROM documents),
      x AS (SELECT v FROM w WHERE v <= (SELECT quantile_cont(v, 0.99) FROM w))""" + _HIST.format(b=50),
    "box_stats": """WITH q AS (SELECT event_type, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median,
      quantile_cont(value, 0.75) AS q3 FROM events WHERE NOT isnan(value) GROUP BY 1),
      j AS (SELECT e.event_type, value, q1, median, q3, value BETWEEN q1 - (q3 - q1) * 1.5 AND q3 + (q3 - q1) * 1.5 AS inside
        FROM events e JOIN q USING (event_type) WHERE value IS NOT NULL AND NOT isnan(value))
      SELECT event_type, round(any_value(q1), 6) AS q1, round(any_value(median), 6) AS median, round(any_value(q3), 6) AS q3,
      round(min(value) FILTER (inside), 6) AS whisker_low, round(max(value) FILTER (inside), 6) AS whisker_high,
      count_if(NOT inside)::BIGINT AS n_outliers, count(*) AS n FROM j GROUP BY 1""",
    "exact_quantile_table": " UNION ALL ".join(
        f"""SELECT l_returnflag, {p}::DOUBLE AS prob, round(quantile_cont(l_extendedprice, {p}), 6) AS quantile
        FROM lineitem GROUP BY 1""" for p in ("0.0", "0.5", "0.95", "1.0")
    ),
    "row_index": "SELECT doc_id, lang, row_number() OVER (ORDER BY lang, doc_id) - 1 AS row_index FROM documents",
    "unlabelled": f"WITH {ARTICLES} SELECT id, md5(headline) AS headline, md5(body) AS body FROM a",
    "without_structural": """SELECT source AS section, lang AS category, count(*) AS n FROM documents
      WHERE lang = 'en' AND source NOT IN ('src0', 'src1') GROUP BY ALL""",
}
