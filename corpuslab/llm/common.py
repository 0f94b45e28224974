"""Helpers of the pipeline operators: text batches and connected components."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuslab.session import materialize

BATCH_BYTES = 4 << 20


def row_key(doc_id: str, text: str) -> Column:
    """Hash that tells rows apart which share an identifier; equal rows share the hash."""
    return F.xxhash64(F.col(doc_id), F.col(text))


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that a slice holds about ``limit`` bytes of ``column``, and one row at least."""
    for batch in batches:
        lengths = pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0).to_pylist()
        start = size = 0
        for row, length in enumerate(lengths):
            if row > start and size + length > limit:
                yield batch.slice(start, row - start)
                start, size = row, 0
            size += length
        if start < len(lengths):
            yield batch.slice(start)


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """Connected components of ``edges`` (a, b): one row (node, root) per node, root being its smallest node.

    Each round points every node at its smallest neighbour, jumps once along
    these pointers and rewrites the edges between the targets.  The tables of a
    round are written to shared storage, so a lost executor costs one round at
    most.  Minima combine on the map side and all joins are on keys, so a hub
    with many links is neither collected nor paired with itself.
    """
    lo, hi = F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi")
    links = materialize(edges.select(lo, hi).where("lo < hi").distinct(), f"{name}-edges")
    first = links
    pointers = []
    while not links.isEmpty():
        up = materialize(links.groupBy(F.col("hi").alias("node")).agg(F.min("lo").alias("to")), f"{name}-up")
        over = up.select(F.col("node").alias("to"), F.col("to").alias("further"))
        jump = materialize(
            up.join(over, "to", "left").select("node", F.coalesce("further", "to").alias("to")), f"{name}-jump"
        )
        pointers.append(jump)
        left = jump.select(F.col("node").alias("lo"), F.col("to").alias("lo_to"))
        right = jump.select(F.col("node").alias("hi"), F.col("to").alias("hi_to"))
        moved = links.join(left, "lo", "left").join(right, "hi", "left").select(
            F.coalesce("lo_to", "lo").alias("a"), F.coalesce("hi_to", "hi").alias("b")
        )
        links = materialize(moved.select(lo, hi).where("lo < hi").distinct(), f"{name}-edges")
    nodes = first.select(F.explode(F.array("lo", "hi")).alias("node")).distinct()
    nodes = nodes.withColumn("root", F.col("node"))
    for jump in pointers:
        step = jump.select(F.col("node").alias("root"), F.col("to"))
        nodes = nodes.join(step, "root", "left").select("node", F.coalesce("to", "root").alias("root"))
    return nodes
