"""Naming, mapping, coercion and filters on columns."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def quoted(value: str) -> str:
    """A string as SQL literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def literal_map(mapping: Mapping[str, str]) -> Column:
    """Constant map, parsed in one piece."""
    return F.expr("map(" + ", ".join(f"{quoted(k)}, {quoted(v)}" for k, v in mapping.items()) + ")")


def strip_labels(df: DataFrame, labels: Sequence[str]) -> DataFrame:
    """Everything but the label columns, order kept."""
    missing = [c for c in labels if c not in df.columns]
    if missing:
        raise ValueError(f"no such label columns: {', '.join(missing)}")
    return df.drop(*labels)


def canonical_name(c: Column | str) -> Column:
    """Lower-case identifier with single underscores."""
    return F.regexp_replace(
        F.regexp_replace(F.lower(F.trim(_col(c))), "[^a-z0-9]+", "_"), "^_+|_+$", ""
    )


def slug(c: Column | str) -> Column:
    """Every character that is no letter or digit becomes ``_``; ends trimmed."""
    return F.regexp_replace(
        F.regexp_replace(F.lower(_col(c)), r"[^\p{L}\p{N}]", "_"), "^_+|_+$", ""
    )


def _canonical(name: str) -> str:
    runs = "".join(ch if ch.isascii() and ch.isalnum() else " " for ch in name.strip().lower())
    return "_".join(runs.split())


def normalize_columns(df: DataFrame, aliases: Mapping[str, str]) -> DataFrame:
    """Canonical column names, then aliases; two columns on one name are an error."""
    names = [aliases.get(_canonical(c), _canonical(c)) for c in df.columns]
    clash = sorted({n for n in names if names.count(n) > 1})
    if clash:
        raise ValueError(f"several columns map to: {', '.join(clash)}")
    return df.toDF(*names)


def map_alias(c: Column | str, mapping: Mapping[str, str]) -> Column:
    """Canonical value looked up in ``mapping``; unknown values pass through."""
    value = canonical_name(c)
    if not mapping:
        return value
    return F.coalesce(F.element_at(literal_map(mapping), value), value)


def display_name(c: Column | str, mapping: Mapping[str, str]) -> Column:
    """Name for reports; without an entry the value in title case."""
    c = _col(c)
    fallback = F.initcap(F.replace(c, F.lit("_"), F.lit(" ")))
    if not mapping:
        return fallback
    return F.coalesce(F.element_at(literal_map(mapping), c), fallback)


def reorder(df: DataFrame, first: Sequence[str]) -> DataFrame:
    """Named columns first (those present), then the others."""
    head = [c for c in first if c in df.columns]
    return df.select(*head, *[c for c in df.columns if c not in head])


def common_columns(a: DataFrame, b: DataFrame, among: Iterable[str] | None = None) -> list[str]:
    """Columns of ``a`` that ``b`` has too."""
    wanted = None if among is None else set(among)
    return [c for c in a.columns if c in b.columns and (wanted is None or c in wanted)]


def experiment_label(cols: Sequence[Column | str], sep: str = " | ") -> Column:
    return F.concat_ws(sep, *[_col(c) for c in cols])


def to_numeric(c: Column | str, strict: bool = True) -> Column:
    """Number from text; bad text is an error, or null when not strict."""
    c = _col(c)
    return c.cast("double") if strict else c.try_cast("double")


def prediction_table(
    pred: DataFrame,
    *,
    id: str,
    actual: str,
    predicted: str,
    headline: str | None = None,
    seen: str | None = None,
    **meta: str,
) -> DataFrame:
    """One row per prediction with its experiment and a correctness flag."""
    cols = [F.col(id).alias("id")]
    cols.append((F.col(headline) if headline else F.lit(None).cast("string")).alias("headline"))
    cols += [F.lit(v).alias(k) for k, v in meta.items()]
    cols += [F.col(actual).alias("actual_label"), F.col(predicted).alias("predicted_label")]
    cols.append((F.col(actual) == F.col(predicted)).alias("correct"))
    if seen:
        cols.append(F.col(seen).alias("actual_label_seen_during_training"))
    return pred.select(*cols)


def overall_metrics(df: DataFrame) -> DataFrame:
    return df.filter(F.col("metric_scope") == "overall")


def class_metrics(df: DataFrame) -> DataFrame:
    return df.filter(F.col("metric_scope") == "class")


def for_category(df: DataFrame, category: str, column: str = "category") -> DataFrame:
    return df.filter(F.col(column) == category)


def with_date(df: DataFrame, column: str = "published_at") -> DataFrame:
    return df.filter(F.col(column).isNotNull())


def exclude_values(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    return df.filter(~F.col(column).isin(list(values)))


def first_known(*cols: Column | str) -> Column:
    """First non-null provenance."""
    return F.coalesce(*[_col(c) for c in cols])


# Numbers ---------------------------------------------------------------

def rounded(c: Column | str, dp: int, mode: str = "even") -> Column:
    """Round half to even, or half up when asked."""
    if mode not in ("even", "half_up"):
        raise ValueError(f"unknown rounding mode: {mode}")
    return F.bround(_col(c), dp) if mode == "even" else F.round(_col(c), dp)


def pct(n: Column | str, total: Column | str, dp: int = 2, mode: str = "even") -> Column:
    return rounded(F.try_divide(_col(n), _col(total)) * 100, dp, mode)


def throughput(rows: Column | str, seconds: Column | str) -> Column:
    """Rows per second; null when no time passed."""
    return F.try_divide(_col(rows).cast("double"), _col(seconds))


def metric_diff(a: Column | str, b: Column | str) -> Column:
    return _col(b) - _col(a)


def winner(diff: Column | str, name_a: str, name_b: str) -> Column:
    """Whose metric is higher; ``diff`` is b minus a."""
    diff = _col(diff)
    return F.when(diff > 0, name_b).when(diff < 0, name_a).otherwise("Tie")
