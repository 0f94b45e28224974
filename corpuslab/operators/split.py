"""Stratified split with exact sizes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpuslab.session import collect_bounded, materialize

SLICES = 4096


def split_quotas(df: DataFrame, label: str, ratio: float) -> DataFrame:
    """Training rows of every label: ``(label, n, quota)``.

    ``floor(ratio * rows)`` in total.  Each label gets the whole part of its
    share; rows left over go to the largest remainders, label order on ties.
    """
    if not 0 < ratio < 1:
        raise ValueError("ratio must lie between 0 and 1")
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    total = df.agg(F.floor(F.lit(ratio) * F.count(F.lit(1))).cast("long")).scalar()
    share = F.lit(ratio) * F.col("n")
    base = F.floor(share).cast("long")
    parts = counts.select(label, "n", base.alias("_base"), F.round(share - base, 9).alias("_rest"))
    # One row per label from here on.
    place = F.row_number().over(W.orderBy(F.desc("_rest"), F.col(label)))
    left_over = total - F.sum("_base").over(W.partitionBy())
    return parts.select(
        label, "n", (F.col("_base") + F.when(place <= left_over, 1).otherwise(0)).alias("quota")
    )


def _order_key(id: str, seed: int, order: str) -> tuple[Column, Column]:
    """A pseudo-random key and its slice; slices follow the key order."""
    if order == "xxhash64":
        key = F.xxhash64(F.lit(seed), F.col(id))
        return key, (F.shiftright(key, 52) + SLICES // 2).cast("int")
    if order == "md5":
        key = F.md5(F.col(id).cast("string"))
        return key, F.conv(F.substring(key, 1, 3), 16, 10).cast("int")
    raise ValueError(f"unknown order: {order}")


def stratified_split(
    df: DataFrame,
    label: str,
    id: str,
    ratio: float = 0.8,
    seed: int = 42,
    order: str = "xxhash64",
    min_class: int = 1,
) -> DataFrame:
    """Add ``split`` (train or test); every label keeps its share within a row.

    The training rows of a label are those with the smallest keys, where the
    key is a hash of the id, or its MD5 text so that other engines can repeat
    the split.  A label may hold most rows, so it is never ranked in one task:
    counts per slice of the key range tell the slice where the quota is
    reached, only the rows of that slice (1/4096 of the label) are ranked, and
    the resulting threshold decides for all others without a shuffle of rows.
    """
    if min_class > 1:
        small = df.groupBy(label).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") < min_class)
        found = collect_bounded(small.limit(10), 10, "small classes")
        if found:
            names = ", ".join(str(r[0]) for r in found)
            raise ValueError(f"classes with fewer than {min_class} rows: {names}")
    key, slice_ = _order_key(id, seed, order)
    keyed = df.select(F.col(label).alias("_label"), F.col(id).alias("_id"), key.alias("_key"), slice_.alias("_slice"))
    quotas = split_quotas(df, label, ratio).select(F.col(label).alias("_l"), "quota")
    per_slice = keyed.groupBy("_label", "_slice").agg(F.count(F.lit(1)).alias("_n"))
    upto = F.sum("_n").over(
        W.partitionBy("_label").orderBy("_slice").rowsBetween(W.unboundedPreceding, 0)
    )
    same = F.col("_label").eqNullSafe(F.col("_l"))
    edge = (
        per_slice.withColumn("_upto", upto)
        .join(quotas, same)
        .filter((F.col("_upto") >= F.col("quota")) & (F.col("_upto") - F.col("_n") < F.col("quota")))
        .select("_l", F.col("_slice").alias("_edge"), (F.col("quota") - F.col("_upto") + F.col("_n")).alias("_need"))
    )
    rank = F.row_number().over(W.partitionBy("_label").orderBy("_key", "_id"))
    last = (
        keyed.join(edge, same & (F.col("_slice") == F.col("_edge")))
        .withColumn("_rank", rank)
        .filter(F.col("_rank") == F.col("_need"))
        .select("_l", F.struct("_key", "_id").alias("_last"))
    )
    last = materialize(last, "split-thresholds")  # one row per label, read by every later pass
    out = df.join(last, F.col(label).eqNullSafe(F.col("_l")), "left")
    mine = F.struct(key.alias("_key"), F.col(id).alias("_id"))
    train = F.coalesce(mine <= F.col("_last"), F.lit(False))
    return out.select(*df.columns, F.when(train, "train").otherwise("test").alias("split"))
