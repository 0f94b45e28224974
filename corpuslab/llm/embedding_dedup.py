"""Embedding near-duplicates by an epsilon grid order join."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuslab.llm.common import components
from corpuslab.session import materialize

BLOCK = 2048  # vectors in a sequence interval that is compared as a whole
LEADING = 6  # principal dimensions of the grid
FIT_ROWS = 4096  # vectors that the principal dimensions are computed from
FAN_BITS = 4  # each level of intervals joins 16 of the level below


def _valid(vec: Column) -> Column:
    value = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    return vec.isNotNull() & (F.size(vec) > 0) & F.forall(vec, value) & F.exists(vec, lambda x: x != 0)


def _unit(raw: np.ndarray) -> np.ndarray:
    raw = raw / np.abs(raw).max(axis=1, keepdims=True)  # so that squares neither overflow nor vanish
    return raw / np.sqrt((raw * raw).sum(axis=1, keepdims=True))


def principal_dimensions(distinct: DataFrame, leading: int, rows: int = FIT_ROWS) -> dict[int, np.ndarray]:
    """Leading directions per vector length, from a hash sample of about ``rows`` vectors.

    They decide how well the grid separates vectors, never which are linked.
    """
    total = distinct.count()
    share = min(1.0, rows / max(total, 1))
    drawn = distinct.where(F.pmod(F.xxhash64("vec"), F.lit(1 << 20)) < F.lit(int(share * (1 << 20)) + 1))
    by_size: dict[int, list] = {}
    for row in drawn.select("vec").limit(2 * rows).collect():
        by_size.setdefault(len(row["vec"]), []).append(row["vec"])
    found = {}
    for size, vectors in by_size.items():
        unit = _unit(np.array(vectors, np.float64))
        _, directions = np.linalg.eigh(np.cov(unit.T).reshape(size, size) if len(unit) > 1 else np.eye(size))
        found[size] = directions[:, ::-1][:, :leading]
    return found


def _grid(distinct: DataFrame, directions: dict[int, np.ndarray], eps: float, leading: int) -> DataFrame:
    sent = distinct.sparkSession.sparkContext.broadcast(directions)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = np.zeros((batch.num_rows, leading))
            vectors = batch.column("vec").to_pylist()
            sizes = np.array([len(v) for v in vectors])
            for size in np.unique(sizes):
                at = np.flatnonzero(sizes == size)
                axes = sent.value.get(int(size), np.eye(int(size))[:, :leading])
                place[at, : axes.shape[1]] = _unit(np.array([vectors[k] for k in at], np.float64)) @ axes
            cells = np.floor(place / eps).astype(np.int64)
            columns = [batch.column(n) for n in ("cls", "label", "vec", "copies")]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(sizes, pa.int32()), pa.array(list(cells)), pa.array(list(place))],
                names=["cls", "label", "vec", "copies", "dims", "cell", "place"],
            )

    kind = distinct.schema["label"].dataType.simpleString()
    return distinct.select("cls", "label", "vec", "copies").mapInArrow(
        run, f"cls long, label {kind}, vec array<double>, copies long, dims int, cell array<long>, place array<double>"
    )


def sequence_blocks(grid: DataFrame, block: int = BLOCK) -> DataFrame:
    """Sort by label, length and grid cell and cut the sequence into blocks of up to ``block`` vectors.

    A block lies in one range and holds one label and length; it carries its
    vectors, weights and the bounding box on the leading dimensions.
    """
    key = ["label", "dims", "cell"]
    ordered = grid.repartitionByRange(*key).sortWithinPartitions(*key, "cls")
    kind = grid.schema["label"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[dict] = []
        part, number = TaskContext.get().partitionId(), 0

        def close() -> pa.RecordBatch:
            nonlocal number
            place = np.array([r["place"] for r in rows])
            row = {
                "range": part, "block": part << 32 | number, "label": rows[0]["label"], "dims": rows[0]["dims"],
                "lo": place.min(0).tolist(), "hi": place.max(0).tolist(),
                "cls": np.array([r["cls"] for r in rows], "<i8").tobytes(),
                "copies": np.array([r["copies"] for r in rows], "<i8").tobytes(),
                "vectors": np.array([r["vec"] for r in rows], "<f8").tobytes(),
            }
            number += 1
            rows.clear()
            return pa.RecordBatch.from_pylist([row], schema=schema)

        label = None
        schema = pa.schema([
            ("range", pa.int64()), ("block", pa.int64()), ("label", label_type), ("dims", pa.int32()),
            ("lo", pa.list_(pa.float64())), ("hi", pa.list_(pa.float64())), ("cls", pa.binary()),
            ("copies", pa.binary()), ("vectors", pa.binary()),
        ])
        for batch in batches:
            for row in batch.to_pylist():
                if rows and (len(rows) == block or (row["label"], row["dims"]) != label):
                    yield close()
                label = (row["label"], row["dims"])
                rows.append(row)
        if rows:
            yield close()

    label_type = pa.string() if kind.simpleString() == "string" else pa.int32() if kind.simpleString() == "int" else pa.int64()
    return ordered.mapInArrow(
        run, f"range long, block long, label {kind.simpleString()}, dims int, lo array<double>, hi array<double>,"
        " cls binary, copies binary, vectors binary",
    )


def _near(eps: float) -> Column:
    """Whether two intervals may hold a linked pair: common labels, and boxes at most ``eps`` apart."""
    a, b = F.col("a"), F.col("b")
    gaps = [F.greatest(F.lit(0.0), b["lo"][k] - a["hi"][k], a["lo"][k] - b["hi"][k]) for k in range(LEADING)]
    squares = sum((g * g for g in gaps), F.lit(0.0))
    labels = (F.col("a.first") <= F.col("b.last")) & (F.col("b.first") <= F.col("a.last"))
    return labels & (squares <= F.lit(eps * eps * (1 + 1e-9)))


def near_blocks(summary: DataFrame, ranges: int, eps: float) -> DataFrame:
    """Pairs (a, b) of blocks, a <= b, whose intervals are not provably distant.

    The join descends a tree of sequence intervals: sixteen ranges make an
    interval, sixteen of these the next, up to at most sixteen.  Only pairs that
    may hold a link are split further, so no level compares all with all.
    """
    box = lambda f, c: F.array(*[f(F.col(c)[k]) for k in range(LEADING)]).alias(c)
    facts = [box(F.min, "lo"), box(F.max, "hi"), F.min("first").alias("first"), F.max("last").alias("last")]
    levels = [summary.groupBy(F.col("range").alias("node")).agg(*facts)]
    while ranges > 1 << FAN_BITS:
        ranges = (ranges >> FAN_BITS) + 1
        levels.append(levels[-1].groupBy(F.shiftright("node", FAN_BITS).alias("node")).agg(*facts))
    levels = [materialize(level, "ego-level") for level in levels]

    def split(pairs: DataFrame, level: DataFrame) -> DataFrame:
        a = level.select(F.col("node").alias("x"), F.struct("lo", "hi", "first", "last").alias("a"))
        b = level.select(F.col("node").alias("y"), F.struct("lo", "hi", "first", "last").alias("b"))
        return pairs.join(a, "x").join(b, "y").where((F.col("x") <= F.col("y")) & _near(eps)).select("x", "y")

    top = levels[-1].select("node")
    pairs = top.select(F.col("node").alias("x"), F.explode(F.sequence(F.col("node"), F.lit(ranges))).alias("y"))
    pairs = materialize(split(pairs, levels[-1]), "ego-pairs")
    children = lambda c: F.explode(F.sequence(F.shiftleft(c, FAN_BITS), F.shiftleft(c, FAN_BITS) + (1 << FAN_BITS) - 1))
    for level in reversed(levels[:-1]):
        wide = pairs.select(children("x").alias("x"), "y").select("x", children("y").alias("y"))
        pairs = materialize(split(wide, level), "ego-pairs")
    parts = F.struct("lo", "hi", "first", "last")
    a = summary.select(F.col("range").alias("x"), F.col("block").alias("block_a"), "dims", parts.alias("a"))
    b = summary.select(F.col("range").alias("y"), F.col("block").alias("block_b"), F.col("dims").alias("dims_b"), parts.alias("b"))
    return (
        pairs.join(a, "x").join(b, "y")
        .where((F.col("block_a") <= F.col("block_b")) & (F.col("dims") == F.col("dims_b")) & _near(eps))
        .select("block_a", "block_b")
    )


def link_blocks(a: np.ndarray, b: np.ndarray, threshold: float, same: bool) -> np.ndarray:
    """Boolean matrix of the links between the rows of ``a`` and ``b``, by cosine in double precision."""
    cosine = _unit(a) @ _unit(b).T
    linked = cosine >= threshold
    for i, j in np.argwhere(np.abs(cosine - threshold) < 1e-12):  # on the edge: as the formula says
        x, y = a[i], b[j]
        linked[i, j] = x @ y / (math.sqrt(x @ x) * math.sqrt(y @ y)) >= threshold
    if same:
        np.fill_diagonal(linked, False)
    return linked


def _smallest_linked(linked: np.ndarray, a: np.ndarray, b: np.ndarray, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Smallest class reachable inside a block pair, for the rows of both blocks."""
    most = np.iinfo(np.int64).max
    la, lb = a.copy(), b.copy()
    while True:
        na = np.minimum(la, np.where(linked, lb[None, :], most).min(axis=1))
        nb = np.minimum(lb, np.where(linked, na[:, None], most).min(axis=0))
        if same:
            na = nb = np.minimum(na, nb)
        if (na == la).all() and (nb == lb).all():
            return la, lb
        la, lb = na, nb


def block_links(pairs: DataFrame, blocks: DataFrame, threshold: float) -> DataFrame:
    """Per block pair and linked vector: cls, links (weighted by copies) and ``to``, the smallest class it reaches there.

    A dense group gives one row per vector and block pair, never one per link.
    """
    data = lambda s: F.struct("cls", "copies", "vectors", "dims").alias(s)
    a = blocks.select(F.col("block").alias("block_a"), data("a"))
    b = blocks.select(F.col("block").alias("block_b"), data("b"))
    joined = pairs.join(a, "block_a").join(b, "block_b")

    def read(side: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return (np.frombuffer(side["cls"], "<i8"), np.frombuffer(side["copies"], "<i8"),
                np.frombuffer(side["vectors"], "<f8").reshape(-1, side["dims"]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                same = row["block_a"] == row["block_b"]
                (ca, wa, va), (cb, wb, vb) = read(row["a"]), read(row["b"])
                linked = link_blocks(va, vb, threshold, same)
                la, lb = _smallest_linked(linked, ca, cb, same)
                sides = [(ca, linked @ wb, la)] + ([] if same else [(cb, linked.T @ wa, lb)])
                for cls, links, to in sides:
                    at = links > 0
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(cls[at]), pa.array(links[at]), pa.array(to[at])], names=["cls", "links", "to"]
                    )

    return joined.mapInArrow(run, "cls long, links long, to long")


def near_duplicate_vectors(
    vectors: DataFrame, threshold: float = 0.93, id_col: str = "vec_id", vec_col: str = "embedding",
    label_col: str = "label",
) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept.

    Vectors link when their labels are equal and not null, their lengths are
    equal and their cosine is ``threshold`` or more.  Vectors that are null,
    empty, zero, or hold a null or non-finite component link with nothing.
    Equal vectors of a label are joined once, as a class with a number of
    copies.  Labels are integers or strings.  Rows that repeat an identifier
    count as different vectors; a null identifier never names a component of
    vectors that have one.
    """
    rows = vectors.select(
        F.col(id_col).alias("vec_id"), F.col(label_col).alias("label"), F.col(vec_col).cast("array<double>").alias("vec")
    )
    valid = F.col("label").isNotNull() & _valid(F.col("vec"))
    classes = rows.where(valid).groupBy("label", "vec").agg(F.min("vec_id").alias("first_id"), F.count("*").alias("copies"))
    classes = materialize(classes.withColumn("cls", F.monotonically_increasing_id()), "ego-classes")
    eps = math.sqrt(2 - 2 * threshold)
    grid = _grid(classes, principal_dimensions(classes, LEADING), eps, LEADING)
    blocks = materialize(sequence_blocks(grid), "ego-blocks")
    summary = blocks.select("range", "block", "dims", "lo", "hi", F.col("label").alias("first"), F.col("label").alias("last"))
    ranges = (blocks.agg(F.max("range")).first()[0] or 0) + 1
    pairs = materialize(near_blocks(summary, ranges, eps), "ego-block-pairs")
    linked = materialize(block_links(pairs.repartition("block_a", "block_b"), blocks, threshold), "ego-links")
    roots = components(linked.select(F.col("cls").alias("a"), F.col("to").alias("b")), "ego").withColumnRenamed("node", "cls")
    counts = linked.groupBy("cls").agg(F.sum("links").alias("links"))
    rooted = classes.join(counts, "cls", "left").join(roots, "cls", "left").select(
        "label", "vec", "first_id", "copies", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("root", "cls").alias("root")
    )
    rooted = materialize(rooted, "ego-roots")
    smallest = materialize(rooted.groupBy("root").agg(F.min("first_id").alias("component")), "ego-smallest")
    facts = rooted.join(smallest, "root").select(
        "label", "vec", (F.col("links") + F.col("copies") - 1).alias("links"), "component"
    )
    component = F.coalesce("component", "vec_id")
    return rows.join(facts, ["label", "vec"], "left").select(
        "vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )
