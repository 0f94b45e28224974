"""Nearest neighbours by cosine similarity, and label consistency of neighbours.

The join never emits all pairs.  Vectors are cut into blocks; one task
multiplies a block of queries with a block of candidates and emits the best k
candidates of each query; the best k over all blocks are kept.

*Copies.*  Equal vectors are joined once, as one group that carries its k+1
lowest ids.  A vector with millions of copies therefore costs as much as one.

*Tiles.*  About sqrt(b) of the b blocks form a tile, and a task multiplies the
useful block pairs of two tiles.  A vector is copied once for each tile it
meets, not once for each block, so at most sqrt(b) times.

*Pruning.*  Blocks follow the nearest of a few pivots.  With the triangle
inequality the exact method skips every block pair that cannot hold a
neighbour.  A crowded cell is cut into several blocks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpuslab.functions.vectors import norm
from corpuslab.operators.skew import join_hot_keys
from corpuslab.session import collect_bounded, materialize

DIGITS = 6  # similarities are compared after rounding; equal ones rank by id
MAX_PIVOTS = 1024
MAX_BLOCKS = 200_000
MAX_TILE_ROWS = 262_144  # distinct vectors in a tile; beyond it tiles stay this large and their number grows

CANDIDATE_ROWS = 32_768  # candidates of a tile that are multiplied at once: what a task holds beside its tiles
HEAD = 1024  # candidates whose best ones bound the others
BUCKET_ROWS = 131_072  # vectors of a bucket that meet in one task, about; larger buckets are cut
ASKED_ROWS = 32_768  # rows of a tile that one task asks for, about; more are dealt over several tasks


# Kernels that run inside tasks -------------------------------------------------

def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Unit rows in double precision."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    rows = flat.reshape(len(column), -1)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def _best_in_block(k: int, schema: pa.Schema):
    scale = 10**DIGITS

    def run(table: pa.Table) -> pa.Table:
        queries = table.filter(pc.field("role") == 0)
        candidates = table.filter(pc.field("role") == 1).sort_by("gid")
        nq, nc = queries.num_rows, candidates.num_rows
        if nq == 0 or nc == 0:
            return schema.empty_table()
        q, c = _matrix(queries["vec"]), _matrix(candidates["vec"])
        own = pd.Index(candidates["gid"].to_pandas()).get_indexer(queries["gid"].to_pandas())
        take = min(k, nc)
        head = min(nc, max(take, HEAD))
        rows, cols, sims, scores = [], [], [], []
        step = max(1, 1_000_000 // nc)  # bounds the similarity matrix held at once
        for start in range(0, nq, step):
            sim = q[start:start + step] @ c.T
            here = own[start:start + step]
            mine = np.flatnonzero(here >= 0)
            sim[mine, here[mine]] = -np.inf
            # The k best of the first candidates: less similar ones, but for ties after rounding, are none of the k best.
            least = np.partition(sim[:, :head], head - take, axis=1)[:, head - take]
            r, col = np.nonzero(sim >= (np.maximum(least, -2.0) - 2 / scale)[:, None])
            found = sim[r, col]
            score = np.rint(found * scale).astype(np.int64)
            order = np.lexsort((col, -score, r))  # candidates are in id order
            order = order[np.arange(len(r)) - np.searchsorted(r, r) < take]
            rows.append(r[order] + start)
            cols.append(col[order])
            sims.append(found[order])
            scores.append(score[order])
        hit = candidates["members"].take(pa.array(np.concatenate(cols)))
        return pa.table(
            [
                queries["gid"].take(pa.array(np.concatenate(rows))),
                hit,
                pa.array(np.concatenate(scores)),
                pa.array(np.concatenate(sims)),
            ],
            schema=schema,
        )

    return run


def _nearest_pivot(pivots: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            sim = _matrix(batch.column("vec")) @ pivots.T
            cell = sim.argmax(axis=1)
            best = sim[np.arange(len(cell)), cell]
            dist = np.sqrt(np.maximum(0.0, 2.0 - 2.0 * best))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(cell.astype(np.int32)), pa.array(dist)],
                names=[*batch.schema.names, "cell", "dist"],
            )

    return run


def _hyperplane_buckets(dim: int, tables: int, bits: int, seed: int):
    planes = np.random.default_rng(seed).standard_normal((tables, bits, dim))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = 1 << np.arange(bits, dtype=np.int64)
        for batch in batches:
            n = batch.num_rows
            if n == 0:
                continue
            rows = _matrix(batch.column("vec"))
            sides = np.einsum("nd,tbd->ntb", rows, planes) > 0
            signatures = (sides * weights).sum(axis=2).reshape(-1)
            offsets = np.arange(0, (n + 1) * tables, tables, dtype=np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(signatures))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], names=[*batch.schema.names, "buckets"])

    return run


# Groups of equal vectors ----------------------------------------------------------

def _vector_groups(df: DataFrame, id: str, vec: str, k: int) -> DataFrame:
    """Distinct vectors ``(gid, vec, members, n)`` with their k+1 lowest ids."""
    length = norm(vec)
    usable = F.when((length > 0) & (length < float("inf")), F.col(vec)).otherwise(
        F.raise_error(F.concat(F.lit("no usable vector for id "), F.col(id).cast("string")))
        .cast(df.schema[vec].dataType)
    )
    rows = df.select(F.col(id).alias("id"), usable.alias("vec"))
    sizes = rows.groupBy("vec").agg(F.count(F.lit(1)).alias("n"))
    # The rank limit is applied before the shuffle too, so copies stay few.
    place = F.row_number().over(W.partitionBy("vec").orderBy("id"))
    first = rows.withColumn("_r", place).filter(F.col("_r") <= k + 1).groupBy("vec").agg(
        F.array_sort(F.collect_list("id")).alias("members")
    )
    return first.join(sizes, "vec").select(F.col("members")[0].alias("gid"), "vec", "members", "n")


def _hit_schema(groups: DataFrame) -> T.StructType:
    return T.StructType(
        [
            groups.schema["gid"],
            groups.schema["members"],
            T.StructField("score", T.LongType()),
            T.StructField("sim", T.DoubleType()),
        ]
    )


def _multiply(pairs: DataFrame, keys: Sequence[str], groups: DataFrame, k: int) -> DataFrame:
    """Run the block kernel per group of ``keys`` and keep the best k per query."""
    schema = _hit_schema(groups)
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)
    hits = pairs.groupBy(*keys).applyInArrow(_best_in_block(k, arrow), schema)
    return _best_groups(hits, k)


def _best_groups(hits: DataFrame, k: int) -> DataFrame:
    order = W.partitionBy("gid").orderBy(F.desc("score"), F.col("members")[0])
    return hits.withColumn("_r", F.row_number().over(order)).filter(F.col("_r") <= k).drop("_r")


# Exact join ------------------------------------------------------------------------

def _single_block(groups: DataFrame, k: int, queries: DataFrame | None) -> DataFrame:
    rows = groups.select("gid", "vec", "members")
    asked = rows if queries is None else rows.join(queries.select("gid"), "gid", "left_semi")
    both = asked.withColumn("role", F.lit(0)).unionByName(rows.withColumn("role", F.lit(1)))
    return _multiply(both.withColumn("block", F.lit(0)), ["block"], groups, k)


def _pick_pivots(groups: DataFrame, count: int) -> np.ndarray:
    sample = groups.select("gid", "vec").orderBy(F.xxhash64("gid"), "gid").limit(count).select("vec")
    rows = np.array([r[0] for r in collect_bounded(sample, MAX_PIVOTS, "pivots")], dtype=np.float64)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def _useful_pairs(summary: pd.DataFrame, pivots: np.ndarray, k: int):
    """Targets of a block: candidate blocks that may hold a neighbour."""
    cells = summary["cell"].to_numpy()
    radius = summary["radius"].to_numpy()
    near = np.full((len(summary), k + 1), np.inf)
    for i, values in enumerate(summary["near"]):
        near[i, : len(values)] = values
    blocks = summary["block"].to_numpy()
    gaps = np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (pivots @ pivots.T)))
    margin = 4.0 * 10.0**-DIGITS  # ties after rounding must not be lost

    def targets(position: int) -> np.ndarray:
        gap = gaps[cells[position], cells]
        # k+1 vectors (the query may be one) lie within this distance.
        reach = radius[position] + gap[:, None] + near
        within = np.partition(reach.ravel(), k)[k] if reach.size > k else np.inf
        least = np.maximum(0.0, gap - radius[position] - radius)
        return blocks[least * least <= within * within + margin + 1e-9 * (1 + within)]

    return targets


def _tile_sizes(blocks: int, block_rows: int) -> int:
    """Blocks in a tile: a little over the root of their number, so that tiles are fewer, as far as a task holds them."""
    return max(1, min(math.isqrt(blocks - 1) + 2, MAX_TILE_ROWS // block_rows))


def _tile_pairs(shared, blocks: int, k: int, spark) -> DataFrame:
    """One row (query block, candidate block, tile of each) for every useful pair of blocks."""
    def expand(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table, centres = shared.value
        targets = _useful_pairs(table, centres, k)
        names, tiles = table["block"].to_numpy(), table["tile"].to_numpy()
        tile_of = pd.Series(tiles, index=names)
        for batch in batches:
            for position in batch["id"]:
                found = targets(int(position))
                yield pd.DataFrame({
                    "qb": np.full(len(found), names[position]), "cb": found, "qt": np.full(len(found), tiles[position]),
                    "ct": tile_of[found].to_numpy(),
                })

    return spark.range(blocks).mapInPandas(expand, "qb long, cb long, qt long, ct long")


def _best_in_tiles(shared, k: int, schema: pa.Schema):
    """The block kernel for every query block of one tile and its useful candidates in another, some blocks at a time."""
    best = _best_in_block(k, schema)

    def run(rows: pa.Table) -> pa.Table:
        table, centres = shared.value
        targets = _useful_pairs(table, centres, k)
        position = {b: i for i, b in enumerate(table["block"])}
        roles, blocks = rows["role"].to_numpy(), rows["block"].to_numpy()
        found = [schema.empty_table()]
        for block in np.unique(blocks[roles == 0]):
            asked = rows.take(np.flatnonzero((roles == 0) & (blocks == block)))
            useful = np.flatnonzero((roles == 1) & np.isin(blocks, targets(position[block])))
            parts = [
                best(pa.concat_tables([asked, rows.take(useful[at : at + CANDIDATE_ROWS])]))
                for at in range(0, len(useful), CANDIDATE_ROWS)
            ]
            found.extend(parts if len(parts) < 2 else [_best_rows(pa.concat_tables(parts), k)])
        return pa.concat_tables(found)

    return run


def _best_rows(hits: pa.Table, k: int) -> pa.Table:
    """The best k hits of each query, ranked as in :func:`_best_groups`."""
    query = hits["gid"].combine_chunks().dictionary_encode().indices
    keys = pa.table({"query": query, "score": hits["score"], "first": pc.list_element(hits["members"], 0)})
    order = pc.sort_indices(keys, [("query", "ascending"), ("score", "descending"), ("first", "ascending")]).to_numpy()
    ordered = query.to_numpy()[order]
    rank = np.arange(len(order)) - np.searchsorted(ordered, ordered)
    return hits.take(order[rank < k])


def _tile_rows(asked: DataFrame, vectors: DataFrame, pairs: DataFrame) -> DataFrame:
    """Vectors with both tiles of every task that needs them: ``role`` 0 asks, ``role`` 1 is a candidate."""
    left = asked.join(pairs.select(F.col("qb").alias("block"), "qt", "ct").distinct(), "block").withColumn("role", F.lit(0))
    right = vectors.join(pairs.select(F.col("cb").alias("block"), "qt", "ct").distinct(), "block").withColumn("role", F.lit(1))
    return left.unionByName(right)


def _with_part(rows: DataFrame, parts: int) -> DataFrame:
    """Rows of :func:`_tile_rows` in ``parts`` parts of a task: a row asks in one of them and is a candidate in all."""
    mine = F.array(F.pmod(F.xxhash64("gid", F.lit("part")), F.lit(parts)).cast("int"))
    return rows.withColumn("part", F.explode(F.when(F.col("role") == 0, mine).otherwise(F.sequence(F.lit(0), F.lit(parts - 1)))))


def _exact_hits(
    groups: DataFrame, n: int, k: int, block_rows: int, queries: DataFrame | None = None
) -> DataFrame:
    if n <= block_rows:
        return _single_block(groups, k, queries)
    spark = groups.sparkSession
    pivots = _pick_pivots(groups, min(MAX_PIVOTS, math.ceil(n / block_rows)))
    base = groups.select("gid", "vec", "members")
    schema = T.StructType(
        [*base.schema.fields, T.StructField("cell", T.IntegerType()), T.StructField("dist", T.DoubleType())]
    )
    placed = materialize(base.mapInArrow(_nearest_pivot(pivots), schema), "knn-cells")
    sizes = dict(collect_bounded(placed.groupBy("cell").count(), MAX_PIVOTS, "cells"))
    chunks = [max(1, math.ceil(sizes.get(c, 0) / block_rows)) for c in range(len(pivots))]
    if sum(chunks) > MAX_BLOCKS:
        raise ValueError("too many blocks for an exact join: raise block_rows or use method='lsh'")
    per_cell = F.element_at(F.array(*[F.lit(c) for c in chunks]), F.col("cell") + 1)
    chunk = F.pmod(F.xxhash64("gid"), per_cell)
    blocked = placed.withColumn("block", F.col("cell").cast("long") * MAX_BLOCKS + chunk)
    nearest = F.slice(F.array_sort(F.collect_list("dist")), 1, k + 1)  # one block's distances
    summary = blocked.groupBy("block").agg(
        F.first("cell").alias("cell"), F.max("dist").alias("radius"), nearest.alias("near")
    )
    found = pd.DataFrame([r.asDict() for r in collect_bounded(summary, MAX_BLOCKS, "blocks")])
    # Cells in the order of their main direction, so that the blocks of a tile are near each other.
    main = pivots @ np.linalg.svd(pivots - pivots.mean(axis=0), full_matrices=False)[2][0]
    found = found.assign(place=main[found["cell"]]).sort_values(["place", "block"], ignore_index=True)
    found["tile"] = np.arange(len(found)) // _tile_sizes(len(found), block_rows)
    shared = spark.sparkContext.broadcast((found, pivots))  # at most MAX_BLOCKS rows
    pairs = materialize(_tile_pairs(shared, len(found), k, spark), "knn-tiles")
    vectors = blocked.select("gid", "vec", "members", "block")
    asked = vectors
    if queries is not None:  # only blocks that hold asked rows look for candidates
        asked = materialize(vectors.join(queries.select("gid"), "gid", "left_semi"), "knn-asked")
        pairs = pairs.join(asked.select(F.col("block").alias("qb")).distinct(), "qb", "left_semi")
    schema = _hit_schema(groups)
    from pyspark.sql.pandas.types import to_arrow_schema

    counts = np.array([chunks[c] for c in found["cell"]])
    rows = np.array([sizes[c] for c in found["cell"]]) / counts
    parts = math.ceil(np.bincount(found["tile"], rows).max() / ASKED_ROWS)
    tasks = _with_part(_tile_rows(asked, vectors, pairs), parts).groupBy("qt", "ct", "part")
    hits = tasks.applyInArrow(_best_in_tiles(shared, k, to_arrow_schema(schema)), schema)
    return _best_groups(hits, k)


# Approximate join ---------------------------------------------------------------------

def _best_in_bucket(k: int, schema: pa.Schema):
    """The block kernel for rows that ask (``role`` 0), are candidates (1) or both (2), some rows at a time."""
    best = _best_in_block(k, schema)

    def run(rows: pa.Table) -> pa.Table:
        roles = rows["role"].to_numpy()

        def parts(role: int) -> Iterator[pa.Table]:
            mine = np.flatnonzero((roles == role) | (roles == 2))
            for at in range(0, len(mine), CANDIDATE_ROWS):
                some = rows.take(mine[at : at + CANDIDATE_ROWS])
                column = some.schema.get_field_index("role")
                yield some.set_column(column, "role", pa.array(np.full(len(some), role, np.int32)))

        found = [schema.empty_table()]
        for asked in parts(0):
            hits = [best(pa.concat_tables([asked, candidates])) for candidates in parts(1)]
            found.extend(hits if len(hits) < 2 else [_best_rows(pa.concat_tables(hits), k)])
        return pa.concat_tables(found)

    return run


def _bucket_rows(signed: DataFrame, chunk_rows: int) -> DataFrame:
    """Vectors with table, bucket and the two chunks of every task that needs them, each with its ``role`` there.

    A bucket with one chunk takes each of its vectors once; with c chunks a
    vector goes to 2c - 1 tasks.
    """
    placed = F.posexplode("buckets").alias("tab", "bucket")
    crowd = signed.select(placed).groupBy("tab", "bucket").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    sized = join_hot_keys(signed.select("gid", "vec", "members", placed), crowd, ["tab", "bucket"], "_n")
    chunks = F.ceil(F.col("_n") / F.lit(chunk_rows)).cast("int")
    chunk = F.pmod(F.xxhash64("gid"), chunks).cast("int")
    task = lambda q, c, role: F.struct(q.alias("qc"), c.alias("cc"), F.lit(role).alias("role"))
    others = F.filter(F.sequence(F.lit(0), F.col("chunks") - 1), lambda x: x != F.col("chunk"))
    tasks = F.concat(
        F.array(task(F.col("chunk"), F.col("chunk"), 2)),
        F.transform(others, lambda x: task(F.col("chunk"), x, 0)),
        F.transform(others, lambda x: task(x, F.col("chunk"), 1)),
    )
    return sized.withColumn("chunks", chunks).withColumn("chunk", chunk).select(
        "gid", "vec", "members", "tab", "bucket", F.inline(tasks)
    )


def _lsh_hits(
    groups: DataFrame, n: int, k: int, block_rows: int, tables: int, bits: int, seed: int
) -> DataFrame:
    """Candidates share a random-hyperplane bucket in one of several tables.

    A vector is written once with all its buckets and travels once per table to
    the task of its bucket, which multiplies it part by part.  Only a bucket
    above ``BUCKET_ROWS`` is cut into chunks that meet pair by pair.  Rows that
    find fewer than k neighbours get theirs from the exact join, so every row
    has a full list.
    """
    dim = groups.select(F.size("vec")).first()[0]
    base = groups.select("gid", "vec", "members")
    schema = T.StructType([*base.schema.fields, T.StructField("buckets", T.ArrayType(T.LongType()))])
    signed = materialize(base.mapInArrow(_hyperplane_buckets(dim, tables, bits, seed), schema), "knn-lsh")
    schema = _hit_schema(groups)
    from pyspark.sql.pandas.types import to_arrow_schema

    found = (
        _bucket_rows(signed, max(block_rows, BUCKET_ROWS))
        .groupBy("tab", "bucket", "qc", "cc")
        .applyInArrow(_best_in_bucket(k, to_arrow_schema(schema)), schema)
        # One pair may meet in several tables; all hits of a row lie together from here on.
        .repartition("gid")
        .groupBy("gid", "members", "score")
        .agg(F.max("sim").alias("sim"))
    )
    hits = materialize(_best_groups(found, k), "knn-lsh-hits")
    complete = hits.groupBy("gid").agg(F.sum(F.size("members")).alias("_m")).filter(F.col("_m") >= k)
    short = groups.join(complete, "gid", "left_anti").select("gid")
    if n > 1 and not short.isEmpty():
        full = hits.join(complete, "gid", "left_semi")
        return full.unionByName(_exact_hits(groups, n, k, block_rows, short))
    return hits


# Public join -----------------------------------------------------------------------------

def knn(
    df: DataFrame,
    id: str,
    vec: str,
    k: int = 5,
    method: str = "exact",
    *,
    block_rows: int = 4096,
    tables: int = 8,
    bits: int | None = None,
    seed: int = 42,
) -> DataFrame:
    """The k most similar other rows: ``(id, neighbor_id, rank, similarity)``.

    Rows rank by similarity rounded to six digits, then by id.  A table with
    fewer than k+1 rows gives shorter lists.  ``method="lsh"`` looks only
    into shared buckets and may miss neighbours.
    """
    if k < 1:
        raise ValueError("k must be positive")
    if method not in ("exact", "lsh"):
        raise ValueError(f"unknown method: {method}")
    block_rows = min(block_rows, MAX_TILE_ROWS)  # a task holds whole blocks
    groups = materialize(_vector_groups(df, id, vec, k), "knn-groups")
    size = groups.agg(F.count(F.lit(1)), F.max("n")).first()
    n, largest = size[0], size[1] or 0
    if method == "exact":
        hits = _exact_hits(groups, n, k, block_rows)
    else:
        width = bits if bits is not None else max(1, math.ceil(math.log2(max(2, n / 2048))))
        hits = _lsh_hits(groups, n, k, block_rows, tables, width, seed)
    hits = materialize(hits, "knn-hits")  # k rows per vector; later passes skip the multiplication

    # The k+1 best rows of a group's vector, own copies included: dropping the
    # row itself leaves its k neighbours.
    scale = 10**DIGITS
    entry = lambda score, sim, m: F.struct((-score).alias("down"), m.alias("id"), sim.alias("sim"))
    others = hits.select(
        "gid", F.transform("members", lambda m: entry(F.col("score"), F.col("sim"), m)).alias("e")
    )
    copies = groups.filter("n > 1").select(
        "gid",
        F.transform("members", lambda m: entry(F.lit(scale).cast("long"), F.lit(1.0), m)).alias("e"),
    )
    best = others.unionByName(copies).groupBy("gid").agg(
        F.slice(F.array_sort(F.flatten(F.collect_list("e"))), 1, k + 1).alias("best")
    )
    listed = groups.join(best, "gid")
    rows = listed.filter(F.col("n") <= k + 1).select(F.explode("members").alias("id"), "best")
    if largest > k + 1:
        crowded = listed.filter(F.col("n") > k + 1).select("vec", "n", "best")
        every = df.select(F.col(id).alias("id"), F.col(vec).alias("vec"))
        rows = rows.unionByName(join_hot_keys(every, crowded, ["vec"], "n").select("id", "best"))
    mine = F.slice(F.filter("best", lambda e: e["id"] != F.col("id")), 1, k)
    return rows.select("id", F.posexplode(mine).alias("p", "e")).select(
        F.col("id").alias("id"),
        F.col("e.id").alias("neighbor_id"),
        (F.col("p") + 1).alias("rank"),
        F.col("e.sim").alias("similarity"),
    )


# Labels of neighbours -----------------------------------------------------------------------

def gather_neighbors(pairs: DataFrame, meta: DataFrame, id: str, cols: Sequence[str]) -> DataFrame:
    """Attach columns of both ends: ``article_<col>`` and ``neighbor_<col>``.

    An article occurs k times, but one row may be the neighbour of all its
    copies, so neighbours are counted and the frequent ones joined apart.
    """
    ends = lambda key, tag: meta.select(
        F.col(id).alias(key), *[F.col(c).alias(f"{tag}_{c}") for c in cols]
    )
    uses = pairs.groupBy("neighbor_id").agg(F.count(F.lit(1)).alias("_uses"))
    neighbours = ends("neighbor_id", "neighbor").join(uses, "neighbor_id")
    both = join_hot_keys(pairs.join(ends("id", "article"), "id"), neighbours, ["neighbor_id"], "_uses")
    return both.select(*pairs.columns, *[f"article_{c}" for c in cols], *[f"neighbor_{c}" for c in cols])


def neighbor_pairs(
    df: DataFrame, meta: DataFrame, id: str, vec: str, labels: Sequence[str], k: int = 5,
    extra: Sequence[str] = (), **options,
) -> DataFrame:
    """Neighbour pairs with the labels of both ends and a flag per label."""
    return flag_pairs(knn(df, id, vec, k, **options), meta, id, labels, extra)


def flag_pairs(
    pairs: DataFrame, meta: DataFrame, id: str, labels: Sequence[str], extra: Sequence[str] = ()
) -> DataFrame:
    both = gather_neighbors(pairs, meta, id, [*extra, *labels])
    same = {f"same_{c}": F.col(f"article_{c}").eqNullSafe(F.col(f"neighbor_{c}")) for c in labels}
    return both.withColumns(same)


def neighbor_results(pairs: DataFrame, labels: Sequence[str], wide: int = 0) -> DataFrame:
    """One row per article: same-label ratio per label, similarity spread.

    ``wide`` adds id and similarity of the neighbours of rank 1 to ``wide``.
    """
    aggregates = [F.first(f"article_{c}").alias(c) for c in labels]
    aggregates += [F.avg(F.col(f"same_{c}").cast("int")).alias(f"same_{c}_ratio") for c in labels]
    aggregates += [
        F.avg("similarity").alias("mean_similarity"),
        F.min("similarity").alias("min_similarity"),
        F.max("similarity").alias("max_similarity"),
    ]
    for r in range(1, wide + 1):
        here = F.col("rank") == r
        aggregates.append(F.max(F.when(here, F.col("neighbor_id"))).alias(f"neighbor_{r}_id"))
        if "neighbor_headline" in pairs.columns:
            aggregates.append(F.max(F.when(here, F.col("neighbor_headline"))).alias(f"neighbor_{r}_headline"))
        aggregates.append(F.max(F.when(here, F.col("similarity"))).alias(f"neighbor_{r}_similarity"))
    return pairs.groupBy("id").agg(*aggregates)


def _by_label(results: DataFrame, labels: Sequence[str]) -> DataFrame:
    entries = [
        F.struct(
            F.lit(c).alias("label_definition"),
            F.col(c).cast("string").alias("class"),
            F.col(f"same_{c}_ratio").alias("agreement"),
        )
        for c in labels
    ]
    return results.select("mean_similarity", F.inline(F.array(*entries)))


def neighbor_summary(results: DataFrame, labels: Sequence[str]) -> DataFrame:
    """Spread of the neighbour agreement per label definition."""
    a = F.col("agreement")
    return _by_label(results, labels).groupBy("label_definition").agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(a).alias("mean_agreement"),
        F.percentile(a, 0.5).alias("median_agreement"),  # k+1 distinct values
        F.stddev_samp(a).alias("sd_agreement"),
        F.min(a).alias("min_agreement"),
        F.max(a).alias("max_agreement"),
        F.avg((a == 1.0).cast("int")).alias("perfect_share"),
        F.avg((a == 0.0).cast("int")).alias("zero_share"),
        F.avg("mean_similarity").alias("mean_similarity"),
    )


def neighbor_by_class(results: DataFrame, labels: Sequence[str]) -> DataFrame:
    """Neighbour agreement per class of each label definition."""
    return _by_label(results, labels).groupBy("label_definition", "class").agg(
        F.count(F.lit(1)).alias("n"),
        F.avg("agreement").alias("mean_agreement"),
        F.percentile("agreement", 0.5).alias("median_agreement"),
        F.avg("mean_similarity").alias("mean_similarity"),
    )


def top_classes(by_class: DataFrame, n: int = 20) -> DataFrame:
    """The n classes with most rows, in order of agreement."""
    most = by_class.orderBy(F.desc("n"), "label_definition", "class").limit(n)
    return most.orderBy("mean_agreement", "label_definition", "class")


def majority_label(pairs: DataFrame, label: str) -> DataFrame:
    """Most frequent label among the neighbours; ties take the smallest label."""
    votes = pairs.groupBy("id", F.col(f"neighbor_{label}").alias("_l")).agg(F.count(F.lit(1)).alias("_n"))
    best = F.min(F.struct((-F.col("_n")).alias("down"), F.col("_l").alias("label")))
    return votes.groupBy("id").agg(best["label"].alias("predicted"))


def align_labels(meta: DataFrame, original: DataFrame, other: DataFrame, id: str,
                 columns: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Attach two label sources one to one; a missing label is an error.

    ``columns`` maps a label to the names it gets from both sources.  Ids that
    occur twice on any side are an error as well, found by the same aggregate
    that brings the labels.
    """
    def single(t: DataFrame, position: int) -> DataFrame:
        out = t.groupBy(id).agg(
            F.count(F.lit(1)).alias("_n"), *[F.min(c).alias(n[position]) for c, n in columns.items()]
        )
        twice = F.raise_error(F.concat(F.lit("id occurs twice: "), F.col(id).cast("string")))
        ok = F.when(F.col("_n") == 1, F.lit(True)).otherwise(twice.cast("boolean"))
        return out.filter(ok).drop("_n")

    joined = meta.join(single(original, 0), id, "left").join(single(other, 1), id, "left")
    for names in columns.values():
        for name in names:
            lacking = F.raise_error(F.concat(F.lit(f"no {name} for id "), F.col(id).cast("string")))
            kind = joined.schema[name].dataType
            joined = joined.withColumn(name, F.coalesce(F.col(name), lacking.cast(kind)))
    return joined
