"""Arithmetic on ARRAY<FLOAT|DOUBLE> columns, in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def dot(a: Column | str, b: Column | str) -> Column:
    products = F.zip_with(_col(a), _col(b), lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda s, x: s + x)


def norm(v: Column | str) -> Column:
    squares = lambda s, x: s + x.cast("double") * x.cast("double")
    return F.sqrt(F.aggregate(_col(v), F.lit(0.0), squares))


def l2_normalize(v: Column | str) -> Column:
    """Unit vector; a zero vector stays as it is."""
    v = _col(v)
    length = norm(v)
    return F.when(length == 0, F.transform(v, lambda x: x.cast("double"))).otherwise(
        F.transform(v, lambda x: x.cast("double") / length)
    )


def cosine(a: Column | str, b: Column | str) -> Column:
    """Cosine similarity; null when a vector is zero."""
    return F.try_divide(dot(a, b), norm(a) * norm(b))


def is_finite(v: Column | str) -> Column:
    inf = float("inf")
    return F.forall(
        _col(v),
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(inf)),
    )


def arg_max(v: Column | str) -> Column:
    """Zero-based position of the largest element, the first on ties."""
    v = _col(v)
    return (F.array_position(v, F.array_max(v)) - 1).cast("int")


def dominant(v: Column | str) -> Column:
    """Struct of the arg-max and its value."""
    v = _col(v)
    return F.struct(arg_max(v).alias("index"), F.array_max(v).alias("value"))
