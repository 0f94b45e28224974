"""Tables at rest: CSV and Parquet in, checked and verified out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpuslab.operators.sets import frames_equal

ARTICLE_SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("author", T.StringType()),
        T.StructField("published_at", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("section", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("headline", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("keywords", T.StringType()),
        T.StructField("second_headline", T.StringType()),
        T.StructField("body", T.StringType()),
    ]
)


def _format(path: str, fmt: str | None) -> str:
    if fmt:
        return fmt
    name = path.rstrip("/").rsplit("/", 1)[-1].lower()
    for suffix in ("csv", "json", "orc"):
        if name.endswith("." + suffix):
            return suffix
    return "parquet"


def read_table(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    fmt: str | None = None,
    null_value: str | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """Read a table; CSV has a header.

    With ``multi_line`` CSV values may hold quoted line breaks; a file is then
    one task, whatever its size.  Give a schema for CSV at scale: without one
    Spark reads the file twice.
    ``null_value`` names the text that stands for a missing value.
    """
    fmt = _format(path, fmt)
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True).option("multiLine", multi_line).option("escape", '"')
        if null_value is not None:
            reader = reader.option("nullValue", null_value)
        reader = reader.schema(schema) if schema else reader.option("inferSchema", True)
    elif schema:
        reader = reader.schema(schema)
    return reader.load(path)


def load_required(
    spark: SparkSession,
    path: str,
    required: Sequence[str],
    schema: T.StructType | None = None,
    fmt: str | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """A table that exists, has the required columns and at least one row."""
    df = read_table(spark, path, schema, fmt, multi_line=multi_line)
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise ValueError(f"{path} lacks columns: {', '.join(missing)}")
    if df.isEmpty():
        raise ValueError(f"{path} has no rows")
    return df


def write_table(
    df: DataFrame,
    path: str,
    fmt: str | None = None,
    *,
    sort: str | Sequence[str] | None = None,
    partition_by: Sequence[str] = (),
    mode: str = "overwrite",
) -> None:
    """Write a table; ``sort`` orders the rows over all files."""
    fmt = _format(path, fmt)
    if sort is not None:
        keys = [sort] if isinstance(sort, str) else list(sort)
        df = df.orderBy(*keys)
    writer = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        writer = (
            writer.option("header", True)
            .option("escape", '"')
            .option("ignoreLeadingWhiteSpace", False)
            .option("ignoreTrailingWhiteSpace", False)
        )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def write_verified(df: DataFrame, path: str, fmt: str | None = None) -> DataFrame:
    """Write, read back, and compare the values of every column."""
    write_table(df, path, fmt)
    back = read_table(df.sparkSession, path, df.schema, fmt, multi_line=True)
    if not frames_equal(df, back):
        raise ValueError(f"{path} does not hold what was written")
    return back


def read_embeddings(
    spark: SparkSession, path: str, id: str, vec: str, dim: int | None = None
) -> DataFrame:
    """Vectors keyed by id; fails at run time on a null, infinite or odd-sized one."""
    from corpuslab.functions.vectors import is_finite

    df = load_required(spark, path, [id, vec])
    good = F.col(id).isNotNull() & is_finite(vec)
    if dim is not None:
        good = good & (F.size(vec) == dim)
    message = F.concat(F.lit("bad vector for id "), F.coalesce(F.col(id).cast("string"), F.lit("null")))
    checked = F.when(F.coalesce(good, F.lit(False)), F.col(vec)).otherwise(
        F.raise_error(message).cast(df.schema[vec].dataType)
    )
    return df.withColumn(vec, checked)


def write_embeddings(df: DataFrame, path: str, id: str, vec: str) -> None:
    """Vectors with their row metadata; the job commits all files or none."""
    if id not in df.columns or vec not in df.columns:
        raise ValueError(f"need columns {id} and {vec}")
    vectors = df.withColumn(vec, F.col(vec).cast("array<float>"))
    write_table(vectors, path, "parquet")
