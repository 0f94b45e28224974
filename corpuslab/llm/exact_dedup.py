"""Exact deduplication by a content sort, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpuslab.session import materialize

WHITE = " \t\n\x0b\x0c\r"  # the characters [\x20\x09-\x0D]
HEAD = 32  # leading characters in the sort key; equal heads are told apart by digest and by whole text
HOT_SHARE = 4  # a group of more than rows / (HOT_SHARE * partitions) rows is dealt over several ranges


def normalized(text: str) -> Column:
    return F.translate(F.coalesce(F.col(text), F.lit("")), WHITE, "")


def content_sort(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: bool = False) -> DataFrame:
    """Sort rows by normalised content and compare neighbours in full.

    Splitters sampled from (leading characters, digest, salt) range-partition
    the rows, every range is sorted externally by the whole normalised text,
    and a row starts a new run when its text differs from the row before.
    Within a run the row with the most code points, then the smallest
    identifier, comes first; a null identifier comes last.

    A group that would overfill a range is counted before the shuffle and its
    rows get a salt from their identifier.  The table of such groups has at
    most ``HOT_SHARE * partitions`` rows and is joined without a hint, so
    Spark broadcasts it only below its threshold.

    Null text counts as empty; repeated rows are members of one run, of which
    exactly one row leads.  Returns doc_id, digest, n (code points), run_head
    (boolean), run (number within its range key), salt, hot columns ``total``
    and ``best`` (null unless hot), and ``row`` with all columns of ``docs``
    when ``carry``.
    """
    spark = docs.sparkSession
    kept = [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")] if carry else []
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        normalized(text_col).alias("norm"),
        F.char_length(F.coalesce(F.col(text_col), F.lit(""))).cast("long").alias("n"),
        *kept,
    ).withColumn("digest", F.unhex(F.sha2("norm", 256)))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = F.struct((-F.col("n")).alias("n"), F.col("doc_id").isNull().alias("no_id"), F.col("doc_id"))
    limit = docs.count() / (HOT_SHARE * parts)
    hot = materialize(
        rows.groupBy("digest").agg(F.count("*").alias("total"), F.min(order).alias("best"))
        .where(F.col("total") > max(limit, 1)), "hot-texts",
    )
    salts = F.ceil(F.col("total") / F.lit(max(limit, 1.0)))
    keyed = rows.join(hot, "digest", "left").select(
        F.substring("norm", 1, HEAD).alias("head"),
        "*",
        F.when(F.col("total").isNull(), F.lit(0)).otherwise(F.pmod(F.xxhash64("doc_id"), salts)).cast("long").alias("salt"),
    )
    key = ["head", "digest", "salt"]
    ranged = keyed.repartitionByRange(*key)
    sort = Window.partitionBy(*key).orderBy("norm", F.desc("n"), F.asc_nulls_last("doc_id"))
    differs = F.lag("norm").over(sort).isNull() | (F.lag("norm").over(sort) != F.col("norm"))
    compared = ranged.withColumn("run_head", differs).withColumn(
        "run", F.sum(F.col("run_head").cast("int")).over(sort)
    )
    # Salted ranges meet again by digest; a second text under that digest would be an error, not a wrong group.
    checked = F.when(F.col("total").isNotNull() & (F.col("run") > 1), F.raise_error(F.lit("two texts share a digest")).cast("int"))
    return compared.withColumn("run", F.coalesce(checked, F.col("run"))).drop("norm")


def _leads() -> Column:
    own = F.col("run_head")
    group = (F.col("best.n") == -F.col("n")) & F.col("best.doc_id").eqNullSafe(F.col("doc_id"))
    return own & (F.col("total").isNull() | group)


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when they are identical without white space.  Null text is
    empty text; a group without any identifier has a null keep_id, and exactly
    one of its rows is kept.  An empty table gives an empty result.
    """
    runs = content_sort(docs, id_col, text_col)
    group = Window.partitionBy("head", "digest", "salt", "run").orderBy(F.desc("n"), F.asc_nulls_last("doc_id"))
    whole = group.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    hot = F.col("total").isNotNull()
    return runs.select(
        "doc_id",
        F.when(hot, F.col("best.doc_id")).otherwise(F.first("doc_id").over(whole)).alias("keep_id"),
        F.when(hot, F.col("total")).otherwise(F.count("*").over(whole)).alias("group_size"),
        _leads().alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    return content_sort(docs, id_col, text_col, carry=True).where(_leads()).select("row.*")
