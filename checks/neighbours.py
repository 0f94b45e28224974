"""Nearest neighbours and label consistency."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.common import KNN, table
from checks.evaluation import _six
from corpuslab.functions import vectors as vx
from corpuslab.operators import neighbors as nb
from corpuslab.operators.quality import check_embedding_metadata, check_features, check_vectors
from corpuslab.operators.sets import with_row_index
from corpuslab.plans.studies import label_consistency
from corpuslab.session import materialize, scratch_path
from corpuslab.sources.tables import read_embeddings, write_embeddings

K = 5


def _vectors(spark, d):
    return table(spark, d, "embeddings")


def _pairs(spark, d, method="exact", **options):
    e = _vectors(spark, d)
    return nb.neighbor_pairs(e, e, "vec_id", "embedding", ["label"], K, method=method, **options)


def knn_pairs(spark, d):
    return _pairs(spark, d).select(
        "id", "rank", "neighbor_id", F.round("similarity", 6).alias("similarity"),
        "article_label", "neighbor_label", "same_label",
    )


def knn_blocks(spark, d):
    """The same join forced through many small blocks."""
    e = _vectors(spark, d)
    pairs = nb.knn(e, "vec_id", "embedding", K, block_rows=max(64, e.count() // 6))
    return pairs.select("id", "rank", "neighbor_id", F.round("similarity", 6).alias("similarity"))


def knn_copies(spark, d):
    """A table in which every vector of one label is the same."""
    e = _vectors(spark, d)
    hot = e.filter("label = 3").agg(F.min_by("embedding", "vec_id")).scalar()
    copied = e.withColumn("embedding", F.when(F.col("label") == 3, hot).otherwise(F.col("embedding")))
    pairs = nb.knn(copied, "vec_id", "embedding", K)
    return pairs.select("id", "rank", "neighbor_id", F.round("similarity", 6).alias("similarity"))


def knn_lsh(spark, d):
    """Lists of the approximate join: whole, without the row itself, with right similarities, and how many are near.

    Recall is the share of the k exact neighbours that the lists hold.
    """
    e = _vectors(spark, d)
    found = materialize(nb.knn(e, "vec_id", "embedding", K, "lsh", tables=10, bits=3), "lsh-pairs")
    left = e.select(F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("a"))
    right = e.select(F.col("vec_id").alias("neighbor_id"), F.col("embedding").cast("array<double>").alias("b"))
    right_sim = F.abs(vx.cosine("a", "b") - F.col("similarity")) < 1e-9
    lists = found.join(left, "id").join(right, "neighbor_id").groupBy("id").agg(
        F.count(F.lit(1)).alias("n"), F.sum((F.col("id") == F.col("neighbor_id")).cast("long")).alias("n_self"),
        F.min(right_sim).alias("similarity_right"), (F.sort_array(F.collect_list("rank")) == F.sequence(F.lit(1), F.lit(K))).alias("ranks_whole"),
    )
    exact = nb.knn(e, "vec_id", "embedding", K).select("id", "neighbor_id")
    hits = found.join(exact, ["id", "neighbor_id"]).agg(F.count(F.lit(1))).scalar()
    return lists.withColumn("recall_reached", hits >= 0.9 * K * e.count())


def neighbor_results(spark, d):
    return _six(nb.neighbor_results(_pairs(spark, d), ["label"], wide=3))


def neighbor_summary(spark, d):
    return _six(nb.neighbor_summary(nb.neighbor_results(_pairs(spark, d), ["label"]), ["label"]))


def neighbor_by_class(spark, d):
    return _six(label_consistency(_vectors(spark, d), "vec_id", "embedding", ["label"], K))


def top_classes(spark, d):
    by_class = nb.neighbor_by_class(nb.neighbor_results(_pairs(spark, d), ["label"]), ["label"])
    return _six(nb.top_classes(by_class, 4))


def similarity_histogram(spark, d):
    from corpuslab.operators.profile import histogram

    sims = materialize(_pairs(spark, d).select(F.round("similarity", 6).alias("similarity")), "similarities")
    return _six(histogram(sims, "similarity", 40))


def aligned_labels(spark, d):
    """Two label sources attached to the vectors one to one."""
    e = _vectors(spark, d)
    other = e.select("vec_id", (F.col("label") % 3).alias("label"))
    out = nb.align_labels(e.select("vec_id"), e, other, "vec_id", {"label": ("original", "other")})
    return out.select("vec_id", "original", "other")


def _damaged(spark, d):
    """Vectors scaled by their label; those of label 9 lose half of their values."""
    scaled = F.transform("embedding", lambda x: x * F.col("label").cast("float"))
    cut = F.when(F.col("label") == 9, F.slice(scaled, 1, 32)).otherwise(scaled)
    return _vectors(spark, d).select("vec_id", "label", cut.alias("embedding"))


def vector_checks(spark, d):
    return check_vectors(_damaged(spark, d), "embedding", "vec_id", dim=64)


def vector_functions(spark, d):
    v = _damaged(spark, d)
    turned = F.reverse("embedding")
    return _six(v.select(
        "vec_id", vx.norm("embedding").alias("norm"), vx.dot("embedding", turned).alias("dot"),
        vx.cosine("embedding", turned).alias("cosine"), vx.norm(vx.l2_normalize("embedding")).alias("unit"),
        vx.dominant(F.transform("embedding", lambda x: F.round(x, 5)))["index"].alias("largest"),
    ))


def feature_checks(spark, d):
    """Vector entries as long features: negative values are violations."""
    e = _vectors(spark, d)
    long = e.select(F.col("vec_id").alias("id"), F.posexplode("embedding").alias("term_idx", "weight"))
    bad = check_features(long, e.select(F.col("vec_id").alias("id")))
    return bad.groupBy("check").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("key").alias("n_keys"))


def embedding_roundtrip(spark, d):
    path = scratch_path(spark, "vectors")
    write_embeddings(_vectors(spark, d), path, "vec_id", "embedding")
    back = read_embeddings(spark, path, "vec_id", "embedding", 64)
    return _six(back.select("vec_id", "label", vx.norm("embedding").alias("norm")))


def embedding_metadata_check(spark, d):
    """Numbered vectors: of label 3 without number, of label 5 moved by one, of label 7 without label, of label 9 unknown."""
    known = with_row_index(_vectors(spark, d).select("vec_id", "label"), ["vec_id"], "embedding_row")
    label = F.col("label")
    given = known.select(
        "vec_id",
        F.when(label == 3, "none").when(label == 5, (F.col("embedding_row") + 1).cast("string"))
        .otherwise(F.col("embedding_row").cast("string")).alias("embedding_row"),
        F.when(label != 7, label).alias("label"),
    )
    return check_embedding_metadata(given, known.filter("label <> 9"), "vec_id", labels=["label"])


QUERIES = {
    f.__name__: f
    for f in (
        knn_pairs, knn_blocks, knn_copies, knn_lsh, neighbor_results, neighbor_summary, neighbor_by_class, top_classes,
        similarity_histogram, aligned_labels, vector_checks, vector_functions, feature_checks, embedding_roundtrip,
        embedding_metadata_check,
    )
}

_RES = KNN + """, s AS (SELECT id, any_value(article_label) AS label, avg((article_label = neighbor_label)::INT) AS same_label_ratio,
  avg(sim) AS mean_similarity, min(sim) AS min_similarity, max(sim) AS max_similarity,
  max(neighbor_id) FILTER (rank = 1) AS neighbor_1_id, max(sim) FILTER (rank = 1) AS neighbor_1_similarity,
  max(neighbor_id) FILTER (rank = 2) AS neighbor_2_id, max(sim) FILTER (rank = 2) AS neighbor_2_similarity,
  max(neighbor_id) FILTER (rank = 3) AS neighbor_3_id, max(sim) FILTER (rank = 3) AS neighbor_3_similarity FROM p GROUP BY id)"""
_RES = _RES.replace(", s AS (SELECT id, any", ", res AS (SELECT id, any")
_CLASS = """SELECT 'label' AS label_definition, label::VARCHAR AS class, count(*) AS n,
  round(avg(same_label_ratio), 6) AS mean_agreement, round(median(same_label_ratio), 6) AS median_agreement,
  round(avg(mean_similarity), 6) AS mean_similarity FROM res GROUP BY label"""
_LIST = "SELECT id, rank::INT AS rank, neighbor_id, round(sim, 6) AS similarity FROM p"
_HOT = KNN.replace(
    "SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings",
    "SELECT vec_id, label, (CASE WHEN label = 3 THEN (SELECT arg_min(embedding, vec_id) FROM embeddings WHERE label = 3)"
    " ELSE embedding END)::DOUBLE[] AS v FROM embeddings",
)
_DAMAGED = """v AS (SELECT vec_id, label, list_transform(CASE WHEN label = 9 THEN embedding[1:32] ELSE embedding END,
  lambda x: (x * label::FLOAT)::DOUBLE) AS v FROM embeddings)"""

ORACLE = {
    "knn_pairs": f"""WITH {KNN} SELECT id, rank::INT AS rank, neighbor_id, round(sim, 6) AS similarity, article_label,
      neighbor_label, article_label = neighbor_label AS same_label FROM p""",
    "knn_blocks": f"WITH {KNN} {_LIST}",
    "knn_copies": f"WITH {_HOT} {_LIST}",
    "knn_lsh": """SELECT vec_id AS id, 5::BIGINT AS n, 0::BIGINT AS n_self, true AS similarity_right, true AS ranks_whole,
      true AS recall_reached FROM embeddings""",
    "neighbor_results": f"""WITH {_RES} SELECT id, label, round(same_label_ratio, 6) AS same_label_ratio,
      round(mean_similarity, 6) AS mean_similarity, round(min_similarity, 6) AS min_similarity, round(max_similarity, 6) AS max_similarity,
      {', '.join(f'neighbor_{i}_id, round(neighbor_{i}_similarity, 6) AS neighbor_{i}_similarity' for i in (1, 2, 3))} FROM res""",
    "neighbor_summary": f"""WITH {_RES} SELECT 'label' AS label_definition, count(*) AS n, round(avg(same_label_ratio), 6) AS mean_agreement,
      round(median(same_label_ratio), 6) AS median_agreement, round(stddev_samp(same_label_ratio), 6) AS sd_agreement,
      min(same_label_ratio) AS min_agreement, max(same_label_ratio) AS max_agreement,
      round(avg((same_label_ratio = 1)::INT), 6) AS perfect_share, round(avg((same_label_ratio = 0)::INT), 6) AS zero_share,
      round(avg(mean_similarity), 6) AS mean_similarity FROM res""",
    "neighbor_by_class": f"WITH {_RES} {_CLASS}",
    "top_classes": f"WITH {_RES}, t AS ({_CLASS}) SELECT * FROM t ORDER BY n DESC, class LIMIT 4",
    "similarity_histogram": f"""WITH {KNN}, x AS (SELECT round(sim, 6) AS v FROM p), r AS (SELECT min(v) AS lo, max(v) AS hi FROM x),
      b AS (SELECT unnest(range(0, 40))::INT AS bin),
      c AS (SELECT least(floor((v - lo) / ((hi - lo) / 40)), 39)::INT AS bin, count(*) AS n FROM x, r GROUP BY 1)
      SELECT b.bin, round(lo + b.bin * ((hi - lo) / 40), 6) AS lower, round(lo + (b.bin + 1) * ((hi - lo) / 40), 6) AS upper,
      coalesce(n, 0) AS n FROM b CROSS JOIN r LEFT JOIN c ON c.bin = b.bin""",
    "aligned_labels": "SELECT vec_id, label AS original, (label % 3)::INT AS other FROM embeddings",
    "vector_checks": """SELECT 'vector' AS "check", vec_id::VARCHAR AS key, 'length is not 1' AS detail FROM embeddings WHERE label NOT IN (1)
      UNION ALL SELECT 'vector', vec_id::VARCHAR, 'dimension 32' FROM embeddings WHERE label = 9""",
    "vector_functions": f"""WITH {_DAMAGED}, n AS (SELECT *, sqrt(list_inner_product(v, v)) AS norm, list_inner_product(v, list_reverse(v)) AS dot FROM v)
      SELECT vec_id, round(norm, 6) AS norm, round(dot, 6) AS dot, CASE WHEN norm > 0 THEN round(dot / (norm * norm), 6) END AS cosine,
      CASE WHEN norm > 0 THEN 1.0 ELSE 0.0 END::DOUBLE AS unit,
      (list_position(list_transform(v, lambda x: round(x, 5)), list_max(list_transform(v, lambda x: round(x, 5)))) - 1)::INT AS largest FROM n""",
    "feature_checks": """WITH l AS (SELECT vec_id, unnest(embedding) AS w FROM embeddings)
      SELECT 'feature value' AS "check", count(*) AS n, count(DISTINCT vec_id) AS n_keys FROM l WHERE w < 0""",
    "embedding_metadata_check": """WITH k AS (SELECT vec_id, label, row_number() OVER (ORDER BY vec_id) - 1 AS r FROM embeddings),
      m AS (SELECT vec_id, label, r, CASE WHEN label = 3 THEN NULL WHEN label = 5 THEN r + 1 ELSE r END AS place FROM k)
      SELECT 'embedding row' AS "check", vec_id::VARCHAR AS key, CASE WHEN place IS NULL THEN 'no row number'
        ELSE 'row ' || place || ' is outside 0 to n - 1' END AS detail FROM m WHERE place IS NULL OR place >= (SELECT count(*) FROM m)
      UNION ALL SELECT 'repeated embedding row', place::VARCHAR, count(*) || ' rows' FROM m WHERE place IS NOT NULL GROUP BY place HAVING count(*) > 1
      UNION ALL SELECT 'missing label', vec_id::VARCHAR, 'label is null' FROM m WHERE label = 7
      UNION ALL SELECT 'id sets differ', vec_id::VARCHAR, 'only in the second table' FROM m WHERE label = 9
      UNION ALL SELECT 'moved embedding row', vec_id::VARCHAR, 'number differs from the table''s' FROM m WHERE label IN (3, 5)""",
    "embedding_roundtrip": """SELECT vec_id, label, round(sqrt(list_inner_product(embedding::DOUBLE[], embedding::DOUBLE[])), 6) AS norm
      FROM embeddings""",
}
