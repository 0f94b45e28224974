"""Tables and SQL pieces shared by the registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuslab.operators.split import stratified_split
from corpuslab.session import spread


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents in the shape of an article table."""
    return spread(table(spark, sf_dir, "documents"), "doc_id").select(
        F.col("doc_id").alias("id"),
        F.col("lang").alias("category"),
        F.col("source").alias("section"),
        F.split_part("text", F.lit("\n"), F.lit(1)).alias("headline"),
        F.split_part("text", F.lit("\n"), F.lit(2)).alias("description"),
        F.col("text").alias("body"),
    )


ARTICLES = """a AS (SELECT doc_id AS id, lang AS category, source AS section,
  split_part(text, chr(10), 1) AS headline, split_part(text, chr(10), 2) AS description, text AS body
  FROM documents)"""


def split_documents(spark: SparkSession, sf_dir: str, ratio: float = 0.8) -> DataFrame:
    docs = spread(table(spark, sf_dir, "documents"), "doc_id")
    return stratified_split(docs, "lang", "doc_id", ratio, order="md5")


SPLIT = """cnt AS (SELECT lang, count(*) AS n FROM documents GROUP BY lang),
 base AS (SELECT lang, n, floor(0.8::DOUBLE * n)::BIGINT AS b,
   round(0.8::DOUBLE * n - floor(0.8::DOUBLE * n), 9) AS r FROM cnt),
 quota AS (SELECT lang, b + CASE WHEN row_number() OVER (ORDER BY r DESC, lang)
   <= (SELECT floor(0.8::DOUBLE * sum(n))::BIGINT FROM cnt) - (SELECT sum(b) FROM base)
   THEN 1 ELSE 0 END AS q FROM base),
 rk AS (SELECT d.*, q, row_number() OVER (PARTITION BY d.lang
   ORDER BY md5(d.doc_id::VARCHAR), d.doc_id) AS r FROM documents d JOIN quota USING (lang)),
 split AS (SELECT rk.* EXCLUDE (q, r), CASE WHEN r <= q THEN 'train' ELSE 'test' END AS split FROM rk)"""


def words(expr: str) -> str:
    """SQL for the number of word-like tokens."""
    return rf"len(regexp_extract_all({expr}, '[\p{{L}}\p{{N}}_](?:[\p{{L}}\p{{N}}_''-]*[\p{{L}}\p{{N}}_])?'))"


def stripped(expr: str) -> str:
    return rf"regexp_replace({expr}, '^\s+|\s+$', '', 'g')"


def normalized(expr: str) -> str:
    """SQL for normalized text (the test tables are in composed form)."""
    return (
        rf"trim(regexp_replace(regexp_replace(regexp_replace({expr}, '<[^>]+>', ' ', 'g'),"
        rf" 'https?://\S+|www\.\S+', ' ', 'g'), '\s+', ' ', 'g'))"
    )


KNN = """g AS (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings),
 s AS (SELECT a.vec_id AS id, b.vec_id AS neighbor_id, a.label AS article_label, b.label AS neighbor_label,
   list_cosine_similarity(a.v, b.v) AS sim FROM g a JOIN g b ON a.vec_id <> b.vec_id),
 o AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY round(sim, 6) DESC, neighbor_id) AS rank FROM s),
 p AS (SELECT * FROM o WHERE rank <= 5)"""

VOTE = KNN + """,
 votes AS (SELECT id, neighbor_label AS l, count(*) AS c FROM p GROUP BY ALL),
 best AS (SELECT id, l AS predicted FROM votes QUALIFY row_number() OVER (PARTITION BY id ORDER BY c DESC, l) = 1),
 z AS (SELECT g.vec_id AS id, g.label::VARCHAR AS actual, best.predicted::VARCHAR AS predicted
   FROM g JOIN best ON best.id = g.vec_id)"""
