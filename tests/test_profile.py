from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from corpuslab.operators import profile as pf
from corpuslab.operators.quantiles import exact_quantiles, trim_quantile
from corpuslab.operators.quality import duplicate_rows
from corpuslab.operators.sets import (
    frame_diff, frames_equal, latest, mark_duplicates, partition_check, union_all, upsert, with_row_index,
)
from corpuslab.operators.split import split_quotas, stratified_split


def test_exact_quantiles_equal_linear_interpolation(spark):
    rng = np.random.default_rng(1)
    parts = []
    for g, n in enumerate([1, 2, 3, 4, 7, 10, 99, 100, 2006, 20_000]):
        v = rng.normal(size=n) if g % 2 else rng.integers(0, 5, n).astype(float)
        parts.append(pd.DataFrame({"g": g, "v": v}))
    every = pd.concat(parts)
    probs = [0, 0.1, 0.25, 0.5, 0.9, 0.95, 0.99, 1.0]
    for accuracy in (10_000, 100):
        got = exact_quantiles(spark.createDataFrame(every), "v", probs, ["g"], accuracy).toPandas()
        assert len(got) == len(probs) * 10
        for r in got.itertuples():
            assert r.quantile == pytest.approx(np.quantile(every[every.g == r.g].v, r.prob), abs=1e-12)


def test_quantiles_skip_missing_and_trim(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (4.0,), (None,), (float("nan"),)], "v double")
    assert exact_quantiles(df, "v", [0.9]).first()["quantile"] == pytest.approx(3.6)
    assert {r[0] for r in trim_quantile(df, "v", 0.5).collect()} == {1.0, 2.0}


def test_histogram_edges(spark):
    df = spark.createDataFrame([(float(x),) for x in range(11)], "v double")
    assert [r["n"] for r in pf.histogram(df, "v", 5).collect()] == [2, 2, 2, 2, 3]
    flat = pf.histogram(spark.createDataFrame([(3.0,)] * 4, "v double"), "v", 2).collect()
    assert [(r["lower"], r["upper"], r["n"]) for r in flat] == [(2.5, 3.0, 0), (3.0, 3.5, 4)]


def test_box(spark):
    v = [1, 2, 3, 4, 5, 6, 7, 8, 100]
    df = spark.createDataFrame([("a", float(x)) for x in v], "g string, v double")
    r = pf.box_stats(df, "v", "g").first()
    assert (r["q1"], r["median"], r["q3"], r["whisker_low"], r["whisker_high"], r["n_outliers"]) == (3, 5, 7, 1, 8, 1)


def test_quality_and_column_profile(spark):
    rows = [(1, "u", "2020-01-01", None, " "), (1, "u", "2020-01-01", None, " "), (2, None, "no date", "x", "t"), (3, None, None, "x", None)]
    df = spark.createDataFrame(rows, "id long, url string, date string, label string, text string")
    got = {r["measure"]: r["value"] for r in
           pf.quality_summary(df, id="id", url="url", date="date", labels=["label"], texts=["text"]).collect()}
    assert got == {"rows": 4, "columns": 5, "duplicate_rows": 1, "duplicate_ids": 1, "duplicate_urls": 2,
                   "missing_values": 6, "bad_dates": 2, "missing_label": 2, "blank_text": 3}
    exact = pf.column_profile(df).collect()
    assert [r["column"] for r in exact] == ["label", "url", "date", "text", "id"]
    assert {r["column"]: r["n_distinct"] for r in exact} == {"id": 3, "url": 1, "date": 2, "label": 1, "text": 2}
    approx = pf.column_profile(df, approx=True).collect()
    assert [tuple(r) for r in approx] == [tuple(r) for r in exact]


def test_label_distribution_keeps_nulls(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,)], "l string")
    assert [tuple(r) for r in pf.label_distribution(df, "l").collect()] == [("a", 2, 66.67), (None, 1, 33.33)]


@pytest.mark.parametrize("order", ["xxhash64", "md5"])
def test_split_is_exact_and_repeatable(spark, order):
    labels = ["big"] * 667 + ["mid"] * 300 + ["small"] * 20 + ["one"]
    df = spark.createDataFrame(list(enumerate(labels)), "id long, label string").withColumn(
        "label", F.when(F.col("id") % 97 != 5, F.col("label"))  # some labels are null
    )
    out = stratified_split(df, "label", "id", 0.8, order=order).cache()
    assert out.count() == 988 and out.filter("split = 'train'").count() == int(0.8 * 988)
    for r in out.groupBy("label").agg(F.count_if(F.col("split") == "train").alias("t"), F.count("*").alias("n")).collect():
        assert abs(r["t"] - 0.8 * r["n"]) < 1
    again = stratified_split(df.repartition(5), "label", "id", 0.8, order=order)
    assert frames_equal(out, again)
    assert sum(r["quota"] for r in split_quotas(df, "label", 0.8).collect()) == int(0.8 * 988)
    if order == "xxhash64":
        assert not frames_equal(out, stratified_split(df, "label", "id", 0.8, seed=7))


def test_split_refuses_lonely_classes(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "id long, label string")
    with pytest.raises(ValueError, match="fewer than 2 rows: b"):
        stratified_split(df, "label", "id", min_class=2)
    with pytest.raises(ValueError):
        stratified_split(df, "label", "id", 1.5)


def test_set_operators(spark):
    ids = lambda *x: spark.createDataFrame([(i,) for i in x], "id long")
    got = {(r["id"], r["problem"]) for r in partition_check(ids(1, 2, 3), [ids(1, 2), ids(2, 9)], "id").collect()}
    assert got == {(3, "missing"), (2, "overlap"), (9, "unexpected")}
    a = spark.createDataFrame([(1, None), (1, None), (2, "x")], "id long, v string")
    assert frames_equal(a, a.orderBy(F.desc("id")))
    assert not frames_equal(a, a.distinct())
    base = spark.createDataFrame([(1, "old"), (2, "old")], "id long, v string")
    new = spark.createDataFrame([(2, "new"), (3, "new")], "id long, v string")
    once = upsert(base, new, "id")
    assert {tuple(r) for r in once.collect()} == {(1, "old"), (2, "new"), (3, "new")}
    assert frames_equal(once, upsert(once, new, "id"))
    log = spark.createDataFrame([(1, 1, None), (1, 2, "b"), (2, 1, "c")], "id long, t int, v string")
    assert {tuple(r) for r in latest(log, "id", ["t"]).collect()} == {(1, 2, "b"), (2, 1, "c")}
    assert union_all([base, ids(7)]).filter("v IS NULL").count() == 1
    marks = mark_duplicates(a.withColumn("n", F.monotonically_increasing_id()), ["id", "v"], "first", "n")
    assert marks.filter("is_duplicate").count() == 1
    assert mark_duplicates(a, ["id", "v"], "none").filter("is_duplicate").count() == 2


def test_row_index_is_dense(spark):
    df = spark.range(1000).withColumn("k", (F.col("id") * 37) % 101)
    got = [(r["k"], r["id"]) for r in with_row_index(df, ["k", "id"]).orderBy("row_index").collect()]
    assert got == sorted(got)
    assert with_row_index(df, ["k", "id"]).agg(F.max("row_index"), F.count_distinct("row_index")).first()[:] == (999, 1000)


def test_rows_with_nulls_in_other_columns_differ(spark):
    schema = "id int, a string, b string, c array<string>"
    one = spark.createDataFrame([(1, None, "x", [None, "y"])], schema)
    for other in ((1, "x", None, [None, "y"]), (1, None, "x", ["y", None]), (1, None, "x", ["y"])):
        two = spark.createDataFrame([other], schema)
        assert not frames_equal(one, two) and frame_diff(one, two).count() == 2
        assert duplicate_rows(one.union(two), ["a", "b", "c"]).first()[:] == (0, 0)
        assert mark_duplicates(one.union(two), ["a", "b", "c"], "none").filter("is_duplicate").count() == 0
    assert frames_equal(one, one) and duplicate_rows(one.union(one), ["a", "b", "c"]).first()[:] == (1, 2)


def test_last_update_by_order_stays(spark):
    base = spark.createDataFrame([(1, 0, "old"), (2, 0, "old")], "id int, t int, v string")
    updates = spark.createDataFrame([(1, 5, "b"), (1, 7, "a"), (1, 7, "c"), (3, 1, None)], base.schema)
    got = sorted(tuple(r) for r in upsert(base, updates, "id", ["t"]).collect())
    assert got == [(1, 7, "c"), (2, 0, "old"), (3, 1, None)]
    assert sorted(r["v"] for r in upsert(base, updates.filter("id = 1").drop("t").withColumn("t", F.lit(0)), "id").collect()) == ["c", "old"]
