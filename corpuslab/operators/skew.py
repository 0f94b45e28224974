"""Joins that survive a key with a third of all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuslab.session import materialize


def join_hot_keys(
    left: DataFrame, right: DataFrame, on: Sequence[str], size: str, share: float = 0.001, how: str = "inner"
) -> DataFrame:
    """Inner or left join of rows with one-row-per-key data.

    ``size`` is a column of ``right`` with the number of left rows per key.
    At most ``1 / share`` keys can hold more than ``share`` of all rows, so that
    part of ``right`` has a proven bound and is broadcast; all other keys are
    shuffled.  ``right`` is computed once and written; a right side of at most
    ``1 / share`` keys is broadcast whole, and without hot keys one plain join
    is left, so ``left`` is read twice only where that pays.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"unsupported join: {how}")
    on = list(on)
    right = materialize(right, "join-keys")
    facts = right.agg(F.count(F.lit(1)), F.coalesce(F.sum(size), F.lit(0)), F.coalesce(F.max(size), F.lit(0))).first()
    if facts[0] <= 1 / share:
        return left.join(F.broadcast(right), on, how)
    limit = facts[1] * share
    if facts[2] <= limit:
        return left.join(right, on, how)
    hot = right.filter(F.col(size) > limit)
    cold = right.filter(F.col(size) <= limit)
    fast = left.join(F.broadcast(hot), on, "inner")
    rest = left.join(F.broadcast(hot.select(*on)), on, "left_anti")
    return fast.unionByName(rest.join(cold, on, how))
