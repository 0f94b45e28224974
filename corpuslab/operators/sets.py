"""Set algebra on rows and ids, and upserts."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpuslab.operators.skew import join_hot_keys


def partition_check(whole: DataFrame, parts: Sequence[DataFrame], id: str) -> DataFrame:
    """Ids that a split does not place exactly once.

    Each row is ``(id, problem)`` with problem ``missing`` (in no part),
    ``unexpected`` (not in the whole) or ``overlap`` (in several parts).  One
    shuffle: every table sends its ids, one aggregate compares them.
    """
    tagged = whole.select(F.col(id).alias("id"), F.lit(1).alias("w"), F.lit(0).alias("p"))
    for i, part in enumerate(parts):
        tagged = tagged.unionByName(
            part.select(F.col(id).alias("id"), F.lit(0).alias("w"), F.lit(1 << i).alias("p"))
        )
    seen = tagged.groupBy("id").agg(F.max("w").alias("w"), F.bit_or("p").alias("p"))
    problem = F.array_compact(
        F.array(
            F.when((F.col("w") == 1) & (F.col("p") == 0), "missing"),
            F.when(F.col("w") == 0, "unexpected"),
            F.when(F.bit_count("p") > 1, "overlap"),
        )
    )
    return seen.select("id", F.explode(problem).alias("problem"))


def row_key(df: DataFrame, cols: Sequence[str]) -> Column:
    """128-bit key of a row of ``df`` on ``cols``, in two hashes; null equals null only in the same column.

    The hash function skips nulls, so every column adds a mark whether it is
    null, and nested values are hashed as JSON text that shows their nulls.
    """
    nested = (T.ArrayType, T.StructType, T.MapType)
    values = [
        F.to_json(F.struct(c), {"ignoreNullFields": "false"}) if isinstance(df.schema[c].dataType, nested) else F.col(c) for c in cols
    ]
    marks = [F.col(c).isNull() for c in cols]
    return F.struct(*[F.xxhash64(F.lit(seed), *values, *marks).alias(f"k{seed}") for seed in (1, 2)])


def frame_diff(a: DataFrame, b: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Rows whose number of copies differs, with both numbers.

    Bag comparison; null equals null.  Rows are counted by a digest, and only
    rows with a digest whose counts differ are shuffled and counted as they are.
    """
    cols = list(cols or a.columns)
    lacking = sorted(set(cols) - set(b.columns))
    if lacking:
        raise ValueError(f"second table lacks columns: {', '.join(lacking)}")
    sums = [F.sum("n_left").alias("n_left"), F.sum("n_right").alias("n_right")]
    differ = F.col("n_left") != F.col("n_right")

    def marked(t: DataFrame, *n: int) -> DataFrame:
        return t.select(row_key(t, cols).alias("_key"), *cols, F.lit(n[0]).alias("n_left"), F.lit(n[1]).alias("n_right"))

    both = marked(a, 1, 0).unionByName(marked(b, 0, 1))
    keys = both.groupBy("_key").agg(*sums).filter(differ).select("_key")
    return both.join(keys, "_key", "left_semi").groupBy(*cols).agg(*sums).filter(differ)


def frames_equal(a: DataFrame, b: DataFrame, cols: Sequence[str] | None = None) -> bool:
    """Whether both tables hold the same bag of rows on ``cols``."""
    if cols is None and sorted(a.columns) != sorted(b.columns):
        return False
    return frame_diff(a, b, cols).isEmpty()


def union_all(dfs: Sequence[DataFrame]) -> DataFrame:
    """Union by column name; a column that a table lacks is null there."""
    if not dfs:
        raise ValueError("nothing to union")
    return reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), dfs)


def class_domain(
    truth: DataFrame, predicted: DataFrame, training: DataFrame | None = None
) -> DataFrame:
    """Distinct labels of truth, prediction and training (first column of each)."""
    tables = [t for t in (truth, predicted, training) if t is not None]
    labels = [t.select(F.col(t.columns[0]).alias("label")) for t in tables]
    return reduce(lambda x, y: x.union(y), labels).filter(F.col("label").isNotNull()).distinct()


def unseen_classes(truth: DataFrame, training: DataFrame) -> DataFrame:
    """Labels of the truth that training never showed."""
    label = lambda t: t.select(F.col(t.columns[0]).alias("label"))
    return label(truth).subtract(label(training))


def upsert(base: DataFrame, updates: DataFrame, id: str, order: Sequence[str] = ()) -> DataFrame:
    """One row per id: an updated row replaces the old one.

    Of several updates of an id the last by ``order`` stays; ties, and updates
    without an order, are decided by the rows' values, so any run gives the same.
    """
    values = [c for c in updates.columns if c != id and c not in order]
    text = F.to_json(F.struct(*values), {"ignoreNullFields": "false"}) if values else F.lit("")
    last = latest(updates.withColumn("_values", text), id, [*order, "_values"]).drop("_values")
    return base.join(updates.select(id), id, "left_anti").select(base.columns).unionByName(last)


def latest(log: DataFrame, id: str, order: Sequence[str]) -> DataFrame:
    """Last row of every id in an append-only log.

    ``max_by`` combines on the map side, so a long history of one id is
    reduced before the shuffle.
    """
    row = F.max_by(F.struct(*log.columns), F.struct(*order))
    return log.groupBy(F.col(id).alias("_key")).agg(row.alias("_row")).select("_row.*")


def distinct_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.select(*keys).distinct()


def mark_duplicates(df: DataFrame, keys: Sequence[str], keep: str = "first", order: str | None = None) -> DataFrame:
    """Flag ``is_duplicate``.

    ``keep="none"`` flags all members of a group with several rows;
    ``keep="first"`` leaves the member with the lowest ``order`` unflagged, so
    that column has to be unique.  Groups are only aggregated, never gathered,
    and a key that holds a third of the rows is joined without a shuffle.
    """
    if keep not in ("first", "none"):
        raise ValueError(f"unknown keep: {keep}")
    if keep == "first" and order is None:
        raise ValueError("keep='first' needs a unique order column")
    aggregates = [F.count(F.lit(1)).alias("_n")]
    if order is not None:
        aggregates.append(F.min(order).alias("_first"))
    keyed = df.withColumn("_key", row_key(df, keys))
    groups = keyed.select("_key", *([order] if order else [])).groupBy("_key").agg(*aggregates).filter("_n > 1")
    joined = join_hot_keys(keyed, groups, ["_key"], "_n", how="left")
    flag = F.col("_n").isNotNull()
    if keep == "first":
        flag = flag & (F.col(order) != F.col("_first"))
    return joined.select(*df.columns, flag.alias("is_duplicate"))


def with_row_index(df: DataFrame, order: Sequence[str], into: str = "row_index") -> DataFrame:
    """Consecutive row number over a total order.

    Rows are range-partitioned by the order, numbered inside each range, and
    shifted by the rows before it, so no task sees the whole table.
    """
    from pyspark.sql import Window as W

    from corpuslab.session import materialize

    ranges = max(1, df.sparkSession.sparkContext.defaultParallelism)
    ranged = materialize(
        df.repartitionByRange(ranges, *order).withColumn("_range", F.spark_partition_id()),
        "row-index",
    )
    before = W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    offsets = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("_n")).select(
        "_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset")
    )
    place = F.row_number().over(W.partitionBy("_range").orderBy(*order)) - 1
    return (
        ranged.withColumn("_place", place)
        .join(offsets, "_range")
        .select(*df.columns, (F.col("_offset") + F.col("_place")).alias(into))
    )
