from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from corpuslab.functions.labels import Taxonomy
from corpuslab.operators import quality as q
from corpuslab.session import scratch_path
from corpuslab.sources import tables as tb

NEWS = Taxonomy.news()


def found(df):
    return {(r["check"], r["key"], r["detail"]) for r in df.collect()}


def test_schema_ids_labels(spark):
    df = spark.createDataFrame([(1, "golf", " "), (1, None, "sport"), (None, "x", "y")], "id long, a string, b string")
    assert ("missing column", "zz", "column zz is required") in found(q.check_schema(df, ["id", "zz"]))
    assert found(q.check_schema(df.filter("id = 9"), ["id"])) == {("empty table", None, "no rows")}
    assert q.extra_columns(df, ["id"]) == ["a", "b"]
    assert found(q.check_unique_id(df, "id")) == {("duplicate id", "1", "2 rows"), ("null id", None, "1 rows")}
    assert found(q.check_labels_present(df, ["a", "b"], "id")) == {
        ("missing label", "1", "b is blank"), ("missing label", "1", "a is null")}
    with pytest.raises(q.QualityError, match="duplicate id"):
        q.assert_ok(q.check_unique_id(df, "id"))
    q.assert_ok(q.check_unique_id(df.filter("a = 'golf'"), "id"))


def test_hierarchy_report_is_limited_only_when_asked(spark):
    df = spark.range(25).select("id", F.lit("news").alias("c"), F.lit("Golf").alias("s"))
    assert q.check_hierarchy(df, "c", "s", NEWS, "id").count() == 10
    full = q.check_hierarchy(df, "c", "s", NEWS, "id", limit=None)
    assert full.count() == 25 and full.first()["detail"] == "golf belongs to sport, not news"
    missing = spark.createDataFrame([(1, None, "golf"), (2, "sport", None)], "id long, c string, s string")
    assert len(found(q.check_hierarchy(missing, "c", "s", NEWS, "id"))) == 2


def test_partition_and_rows(spark):
    whole = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id long, v string")
    good = [whole.filter("id = 1"), whole.filter("id > 1")]
    assert not found(q.check_partition(whole, good, "id"))
    bad = found(q.check_partition(whole, [good[0], good[0]], "id"))
    assert ("split row count", None, "2 rows in parts, 3 in all") in bad and len(bad) == 4
    changed = whole.withColumn("v", F.when(F.col("id") == 2, F.lit("z")).otherwise(F.col("v")))
    assert found(q.check_split_rows(whole, changed, "id")) == {("split row", "2", "values differ")}
    assert len(found(q.check_same_except(whole, changed, "id", []))) == 2
    assert not found(q.check_same_except(whole, changed, "id", ["v"]))
    assert found(q.check_same_except(whole, whole.drop("v"), "id", [])) == {("columns differ", "v", "only in one table")}
    assert not found(q.check_unlabelled(whole, whole.drop("v"), ["v"], "id"))


def test_vectors_and_features(spark):
    rows = [(1, [1.0, 0.0]), (2, [1.0, float("nan")]), (3, [2.0, 0.0]), (4, [1.0]), (5, None)]
    df = spark.createDataFrame(rows, "id long, v array<double>")
    got = found(q.check_vectors(df, "v", "id", 2))
    assert got == {("vector", "2", "value not finite"), ("vector", "3", "length is not 1"),
                   ("vector", "4", "dimension 1"), ("vector", "5", "null vector")}
    long = spark.createDataFrame([(1, 0, 1.0), (2, 0, -1.0), (2, 1, float("nan"))], "id long, term_idx int, weight double")
    ids = spark.createDataFrame([(1,), (2,), (3,)], "id long")
    got = found(q.check_features(long, ids))
    assert len(got) == 3 and ("feature ids", "3", "only in the first table") in got


def test_embedding_metadata(spark):
    rows = spark.createDataFrame([(1, 0), (2, 1), (3, 2)], "id long, embedding_row int")
    good = spark.createDataFrame([(3, "2", "a"), (1, "0", "b"), (2, "1", "a")], "id long, embedding_row string, label string")
    assert found(q.check_embedding_metadata(good, rows, "id", labels=["label"])) == set()
    assert found(q.check_embedding_metadata(good.drop("embedding_row"), rows, "id")) == {
        ("missing column", "embedding_row", "column embedding_row is required")
    }
    assert ("empty table", None, "no rows") in found(q.check_embedding_metadata(good.limit(0), rows, "id"))
    bad = spark.createDataFrame(
        [(1, "0", None), (1, "0", " "), (4, "-1", "a"), (5, "5", "a"), (6, "x", "a"), (7, None, "a"), (8, "1.5", "a"), (None, "1", "a")],
        good.schema,
    )
    assert found(q.check_embedding_metadata(bad, rows.select("id"), "id", labels=["label"])) == {
        ("duplicate id", "1", "2 rows"), ("null id", None, "1 rows"), ("missing label", "1", "label is null"),
        ("missing label", "1", "label is blank"), ("embedding row", "4", "row -1 is outside 0 to n - 1"),
        *(("embedding row", str(k), "no row number") for k in (6, 7, 8)), ("repeated embedding row", "0", "2 rows"),
        *(("id sets differ", str(k), "only in the first table") for k in (2, 3)),
        *(("id sets differ", k, "only in the second table") for k in ("4", "5", "6", "7", "8", None)),
    }
    moved = spark.createDataFrame([(1, 1), (2, 0), (3, 2)], "id long, embedding_row int")
    assert {k for c, k, _ in found(q.check_embedding_metadata(moved, rows, "id"))} == {"1", "2"}


def test_metrics_and_classes(spark):
    m = spark.createDataFrame([("a", "0.5"), ("b", "1.5"), ("c", "x"), ("c", None)], "model string, f1 string")
    assert {k for _, k, _ in found(q.check_metric_ranges(m, ["f1"]))} == {"b", "c"}
    assert found(q.check_unique_keys(m, ["model"])) == {("duplicate key", "c", "2")}
    assert found(q.check_min_classes(m.filter("model = 'a'"), "model")) == {("too few classes", "model", "1")}


def test_files(spark):
    rows = [(1, 'he said "x",\nthen  '), (2, None), (3, " lead")]
    df = spark.createDataFrame(rows, "id long, t string")
    path = scratch_path(spark, "t") + ".csv"
    assert tb.write_verified(df, path).count() == 3
    with pytest.raises(ValueError, match="lacks columns: zz"):
        tb.load_required(spark, path, ["id", "zz"])
    tb.write_table(df.filter("id > 9"), path + ".parquet")
    with pytest.raises(ValueError, match="no rows"):
        tb.load_required(spark, path + ".parquet", ["id"])
    marked = scratch_path(spark, "m") + ".csv"
    tb.write_table(spark.createDataFrame([("NA", 1), ("x", 2)], "t string, n int"), marked)
    assert tb.read_table(spark, marked, null_value="NA").filter("t IS NULL").count() == 1
    vectors = spark.createDataFrame([(1, [1.0, 0.0]), (2, [float("inf"), 0.0])], "id long, v array<float>")
    out = scratch_path(spark, "v")
    tb.write_embeddings(vectors, out, "id", "v")
    with pytest.raises(Exception, match="bad vector for id 2"):
        tb.read_embeddings(spark, out, "id", "v").collect()
