from __future__ import annotations

from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from corpuslab import session as se
from corpuslab.operators.skew import join_hot_keys


def fake(master, folder=None):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default: folder or default),
        sparkContext=SimpleNamespace(master=master, applicationId="app-1"),
    )


def test_shared_folder_comes_from_the_session():
    assert se.shared_root(fake("yarn", "hdfs://x/y/")) == "hdfs://x/y"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        se.shared_root(fake("yarn"))
    assert se.shared_root(fake("local[2]")) == se.shared_root(fake("local[2]"))
    assert se.scratch_path(fake("local[2]"), "a") != se.scratch_path(fake("local[2]"), "a")


def test_small_tables_only(spark):
    assert len(se.collect_bounded(spark.range(3), 3, "ids")) == 3
    with pytest.raises(ValueError, match="ids has more than 2 rows"):
        se.collect_bounded(spark.range(3), 2, "ids")
    written = se.materialize(spark.range(5).withColumn("x", F.col("id") * 2), "t")
    assert written.agg(F.sum("x")).first()[0] == 20


@pytest.mark.parametrize("how", ["inner", "left"])
def test_hot_keys_join_like_any_other(spark, how):
    left = spark.range(300).withColumn("k", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50))
    sizes = left.groupBy("k").agg(F.count("*").alias("n")).filter("k < 40").withColumn("v", F.col("k") * 10)
    want = left.join(sizes, "k", how).select("id", "k", "v")
    got = join_hot_keys(left, sizes, ["k"], "n", share=0.2, how=how).select("id", "k", "v")
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
