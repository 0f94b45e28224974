"""Profiles of a document table: quality, label shares, lengths, spreads."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpuslab.functions.columns import pct, rounded
from corpuslab.functions.text import strip
from corpuslab.operators.quantiles import counted_percentile, exact_quantiles
from corpuslab.session import materialize


def label_distribution(df: DataFrame, col: str, dp: int = 2, mode: str = "even") -> DataFrame:
    """Rows and percentage of every label, nulls included, most frequent first."""
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    total = df.agg(F.count(F.lit(1))).scalar()
    return counts.select(col, "n", pct("n", total, dp, mode).alias("percentage")).orderBy(
        F.desc("n"), col
    )


def rare_labels(df: DataFrame, col: str, min_n: int = 2) -> DataFrame:
    """Labels on fewer than ``min_n`` rows, with the number of distinct labels."""
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    distinct = df.agg(F.count_distinct(col)).scalar()
    return counts.filter(F.col("n") < min_n).select(col, "n", distinct.alias("n_labels")).orderBy(col)


def class_balance(df: DataFrame, label: str) -> DataFrame:
    """Number of classes and the sizes of the smallest and largest."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(
        F.count(F.lit(1)).alias("n_classes"),
        F.min("n").alias("smallest"),
        F.max("n").alias("largest"),
    )


def merge_counts(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Two count tables side by side; a missing count is 0."""
    values = [c for c in [*a.columns, *b.columns] if c != key]
    return a.join(b, key, "full_outer").select(key, *[F.coalesce(c, F.lit(0)).alias(c) for c in values])


def split_distribution(
    df: DataFrame, label: str, split: str = "split", dp: int = 2, mode: str = "even"
) -> DataFrame:
    """Train and test counts, percentages and their absolute difference.

    The difference is taken before rounding.  One pass over the table.
    """
    train, test = F.col(split) == "train", F.col(split) == "test"
    totals = df.agg(F.struct(F.count_if(train).alias("train"), F.count_if(test).alias("test"))).scalar()
    counts = df.groupBy(label).agg(F.count_if(train).alias("n_train"), F.count_if(test).alias("n_test"))
    p_train = F.try_divide("n_train", totals["train"]) * 100
    p_test = F.try_divide("n_test", totals["test"]) * 100
    return counts.select(
        label,
        "n_train",
        "n_test",
        rounded(p_train, dp, mode).alias("pct_train"),
        rounded(p_test, dp, mode).alias("pct_test"),
        rounded(F.abs(p_train - p_test), dp, mode).alias("point_difference"),
    ).orderBy(F.desc("n_train"), label)


def _digest(c: Column) -> Column:
    return F.unhex(F.sha2(c, 256))


def _distinct_counts(df: DataFrame, values: dict[str, Column]) -> DataFrame:
    """Exact distinct counts of several expressions; null values are ignored.

    Values become 32-byte digests before the shuffle, so whole texts are never
    sent, and copies are dropped on the map side.
    """
    pairs = F.array(*[F.struct(F.lit(k).alias("name"), _digest(v).alias("digest")) for k, v in values.items()])
    return (
        df.select(F.inline(pairs))
        .filter(F.col("digest").isNotNull())
        .distinct()
        .groupBy("name")
        .agg(F.count(F.lit(1)).alias("n_distinct"))
    )


def column_profile(df: DataFrame, approx: bool = False, dp: int = 2, mode: str = "even") -> DataFrame:
    """Type, missing values and distinct values of every column."""
    types = dict(df.dtypes)
    columns = df.columns
    measures = [F.count(F.lit(1)).alias("_rows")]
    measures += [F.count(F.col(c)).alias(f"p{i}") for i, c in enumerate(columns)]
    if approx:
        measures += [F.approx_count_distinct(F.col(c)).alias(f"d{i}") for i, c in enumerate(columns)]
    rows = F.array(
        *[
            F.struct(
                F.lit(c).alias("column"),
                F.lit(types[c]).alias("data_type"),
                (F.col("_rows") - F.col(f"p{i}")).alias("missing"),
                *([F.col(f"d{i}").alias("n_distinct")] if approx else []),
            )
            for i, c in enumerate(columns)
        ]
    )
    profile = df.agg(*measures).select("_rows", F.inline(rows))
    if not approx:
        texts = {c: F.col(c).cast("string") for c in columns}
        distinct = _distinct_counts(df, texts).withColumnRenamed("name", "column")
        profile = profile.join(distinct, "column", "left")
    return profile.select(
        "column",
        "data_type",
        "missing",
        pct("missing", "_rows", dp, mode).alias("missing_pct"),
        F.coalesce("n_distinct", F.lit(0)).alias("n_distinct"),
    ).orderBy(F.desc("missing"), "column")


def quality_summary(
    df: DataFrame,
    *,
    id: str,
    url: str,
    date: str,
    labels: Sequence[str],
    texts: Sequence[str],
) -> DataFrame:
    """Measures of a raw table; duplicates are rows minus distinct values."""
    record = lambda *cols: F.to_json(F.struct(*cols))  # noqa: E731  (null shows as absent)
    distinct = _distinct_counts(
        df, {"row": record(*df.columns), "id": record(id), "url": record(url)}
    )
    by_name = F.map_from_entries(F.collect_list(F.struct("name", "n_distinct")))
    distinct_map = distinct.agg(by_name).scalar()  # three entries
    is_date = F.col(date).cast("string").try_cast("timestamp")
    blank = lambda c: strip(F.coalesce(F.col(c).cast("string"), F.lit(""))) == ""
    measures: dict[str, Column] = {"missing_values": sum(F.count_if(F.col(c).isNull()) for c in df.columns)}
    measures["bad_dates"] = F.count_if(is_date.isNull())
    for c in labels:
        measures[f"missing_{c}"] = F.count_if(F.col(c).isNull())
    for c in texts:
        measures[f"blank_{c}"] = F.count_if(blank(c))
    one = df.agg(F.count(F.lit(1)).alias("rows"), *[m.alias(k) for k, m in measures.items()])
    extra = lambda k: F.col("rows") - F.coalesce(distinct_map[k], F.lit(0))
    values = [("rows", F.col("rows")), ("columns", F.lit(len(df.columns)).cast("long"))]
    values += [(f"duplicate_{k}s", extra(k)) for k in ("row", "id", "url")]
    values += [(k, F.col(k)) for k in measures]
    return one.select(
        F.inline(F.array(*[F.struct(F.lit(k).alias("measure"), v.alias("value")) for k, v in values]))
    )


def _long(df: DataFrame, values: dict[str, Column], name: str, *keep: str) -> DataFrame:
    """One row per field: ``(keep…, name, value)``."""
    entries = [F.struct(F.lit(k).alias(name), v.alias("value")) for k, v in values.items()]
    return df.select(*keep, F.inline(F.array(*entries)))


def text_stats(df: DataFrame, cols: Sequence[str], dp: int = 1, mode: str = "even") -> DataFrame:
    """Spread of each length column: mean, median, deviation, p90, p95, max, zeros."""
    long = _long(df, {c: F.col(c) for c in cols}, "field")
    stats = long.groupBy("field").agg(
        F.avg("value").alias("mean"),
        counted_percentile("value", [0.5, 0.9, 0.95]).alias("q"),
        F.stddev_samp("value").alias("sd"),
        F.max("value").alias("maximum"),
        F.count_if(F.col("value") == 0).alias("n_zero"),
    )
    return stats.select(
        "field",
        rounded("mean", dp, mode).alias("mean"),
        rounded(F.col("q")[0], dp, mode).alias("median"),
        rounded("sd", dp, mode).alias("sd"),
        rounded(F.col("q")[1], dp, mode).alias("p90"),
        rounded(F.col("q")[2], dp, mode).alias("p95"),
        "maximum",
        "n_zero",
    )


def category_stats(
    df: DataFrame,
    category: str,
    headline_words: str = "headline_words",
    description_words: str = "description_words",
    body_words: str = "body_words",
    dp: int = 1,
    mode: str = "even",
) -> DataFrame:
    """Articles, median lengths and mean body length per category."""
    medians = {"headline": headline_words, "description": description_words, "body": body_words}
    stats = df.groupBy(category).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.percentile(c, 0.5).alias(f"median_{k}") for k, c in medians.items()],
        F.avg(body_words).alias("mean_body"),
    )
    return stats.select(
        category,
        "n",
        *[rounded(f"median_{k}", dp, mode).alias(f"median_{k}_words") for k in medians],
        rounded("mean_body", dp, mode).alias("mean_body_words"),
    ).orderBy(F.desc("n"), category)


def representation_lengths(
    df: DataFrame, cols: dict[str, str], dp: int = 1, mode: str = "even"
) -> DataFrame:
    """Character lengths of several text representations compared."""
    long = _long(df, {k: F.col(c) for k, c in cols.items()}, "representation")
    stats = long.groupBy("representation").agg(
        F.avg("value").alias("mean"),
        counted_percentile("value", [0.5, 0.9]).alias("q"),
        F.max("value").alias("maximum_characters"),
    )
    return stats.select(
        "representation",
        rounded("mean", dp, mode).alias("mean_characters"),
        rounded(F.col("q")[0], dp, mode).alias("median_characters"),
        rounded(F.col("q")[1], dp, mode).alias("p90_characters"),
        "maximum_characters",
    )


def rows_by_year(df: DataFrame, ts: str) -> DataFrame:
    """Rows per year; rows without a date are left out."""
    dated = df.filter(F.col(ts).isNotNull())
    return dated.groupBy(F.year(ts).alias("year")).agg(F.count(F.lit(1)).alias("n")).orderBy("year")


def date_range(df: DataFrame, ts: str) -> DataFrame:
    return df.agg(F.min(ts).alias("first"), F.max(ts).alias("last"), F.count(ts).alias("n_dated"))


def crosstab_long(df: DataFrame, row: str, col: str) -> DataFrame:
    """Contingency counts, one row per cell that occurs."""
    return df.groupBy(row, col).agg(F.count(F.lit(1)).alias("n"))


def crosstab(df: DataFrame, row: str, col: str, values: Sequence[str]) -> DataFrame:
    """Contingency table, one column per value; a cell without rows is 0."""
    return df.groupBy(row).agg(
        *[F.count_if(F.col(col) == v).alias(str(v)) for v in values]
    )


def share_within(n: str, keys: Sequence[str]) -> Column:
    """Part of the sum of ``n`` over rows with equal keys; 0 when that is 0."""
    total = F.sum(n).over(W.partitionBy(*keys))
    return F.coalesce(F.try_divide(F.col(n), total), F.lit(0.0))


def histogram(df: DataFrame, col: str, bins: int) -> DataFrame:
    """Equal-width bins over the range of the column; the last one is closed."""
    if bins < 1:
        raise ValueError("bins must be positive")
    value = F.col(col).cast("double")
    src = df.select(value.alias("v")).filter(F.col("v").isNotNull() & ~F.isnan("v"))
    low, high = src.agg(F.min("v"), F.max("v")).first()  # two numbers, constants of the second pass
    if low is None:
        low, high = 0.0, 1.0
    if low == high:
        low, high = low - 0.5, high + 0.5
    width = (high - low) / bins
    index = F.least(F.floor((F.col("v") - F.lit(low)) / F.lit(width)), F.lit(bins - 1)).cast("int")
    counts = src.groupBy(index.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    every = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return every.join(counts, "bin", "left").select(
        "bin",
        (F.lit(low) + F.col("bin") * F.lit(width)).alias("lower"),
        (F.lit(low) + (F.col("bin") + 1) * F.lit(width)).alias("upper"),
        F.coalesce("n", F.lit(0)).alias("n"),
    ).orderBy("bin")


def box_stats(df: DataFrame, col: str, by: str) -> DataFrame:
    """Quartiles and whiskers: the outermost values within 1.5 box heights."""
    quartiles = (
        exact_quantiles(df, col, [0.25, 0.5, 0.75], [by])
        .groupBy(by)
        .agg(
            F.max(F.when(F.col("prob") == 0.25, F.col("quantile"))).alias("q1"),
            F.max(F.when(F.col("prob") == 0.5, F.col("quantile"))).alias("median"),
            F.max(F.when(F.col("prob") == 0.75, F.col("quantile"))).alias("q3"),
        )
    )
    reach = (F.col("q3") - F.col("q1")) * 1.5
    value = F.col(col).cast("double")
    inside = (value >= F.col("q1") - reach) & (value <= F.col("q3") + reach)
    return (
        df.select(by, col)
        .filter(F.col(col).isNotNull() & ~F.isnan(col))
        .join(materialize(quartiles, "quartiles"), by)
        .groupBy(by, "q1", "median", "q3")
        .agg(
            F.min(F.when(inside, value)).alias("whisker_low"),
            F.max(F.when(inside, value)).alias("whisker_high"),
            F.count_if(~inside).alias("n_outliers"),
            F.count(F.lit(1)).alias("n"),
        )
    )
