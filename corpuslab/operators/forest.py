"""Deep random forests: upper levels in passes over all rows, lower levels inside tasks.

A level-by-level fit sends a histogram of every node, which is far larger than the few rows of a deep node.  Here
only nodes of many rows are split by histograms of all tasks.  The rows of a smaller node travel once to the task that
grows everything below it, all nodes of a level together.  Subtrees stay a table that tasks write and read; the driver
sees the splits above them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasPredictionCol
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuslab.operators.passes import sum_pass
from corpuslab.session import collect_bounded, materialize

BINS = 32  # of a feature, cut at its quantiles
MAX_DIM = 4096  # features that are kept as a byte each
TASK_ROWS, TASK_BYTES = 1 << 15, 1 << 26  # rows of a node that one task grows, and the bytes of their features
PASS_NUMBERS = 1 << 22  # numbers of the histograms of one pass
TILE_ROWS = 1 << 19  # rows that are judged by one copy of a subtree, fewer if they take more than TASK_BYTES

SUBTREES = (
    "tree int, root int, feature array<int>, cut array<int>, child array<int>, votes array<int>, "
    "class array<int>, share array<double>"
)
Splits = tuple[np.ndarray, np.ndarray, np.ndarray]  # feature (-1: none below), last bin of the left side, left child; the right one follows


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_POISSON = np.cumsum(np.exp(-1.0) / np.cumprod([1.0, *range(1, 16)]))


def _bag(seed: int, tree: int, rows: np.ndarray, trees: int) -> np.ndarray:
    """How often a tree draws each row: Poisson with mean 1, the same in every pass; a single tree takes all rows once."""
    if trees == 1:
        return np.ones(len(rows))
    key = _mix(np.array([(seed << 32) + tree], np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    u = _mix(_mix(rows.astype(np.uint64) ^ key) + key) >> np.uint64(11)
    return np.searchsorted(_POISSON, u / float(1 << 53), side="right").astype(float)


def _route(bins: np.ndarray, splits: Splits) -> np.ndarray:
    """The lowest node each row reaches."""
    feature, cut, child = splits
    at = np.zeros(len(bins), np.int64)
    moving = np.flatnonzero(feature[at] >= 0)
    while len(moving):
        node = at[moving]
        at[moving] = child[node] + (bins[moving, feature[node]] > cut[node])
        moving = moving[feature[at[moving]] >= 0]
    return at


def _order(keys: np.ndarray) -> np.ndarray:
    """Stable order of small whole numbers; plain sorting of distinct numbers is the fastest."""
    n = len(keys)
    return np.sort(keys * n + np.arange(n)) % n if n else np.arange(0)


def grow(bins: np.ndarray, label: np.ndarray, weight: np.ndarray, depth: int, drawn: int, rng: np.random.Generator) -> dict:
    """Splits by Gini impurity below one node until nodes are pure, ``depth`` is reached or none of ``drawn`` features splits."""
    n_classes, dim = int(label.max()) + 1, bins.shape[1]
    features, cuts, children, votes, classes, shares = [], [], [], [], [], []
    rows, node, count, after = np.arange(len(label)), np.zeros(len(label), np.int64), 1, 1
    for level in range(depth + 1):
        keys, group = np.unique(node * n_classes + label[rows], return_inverse=True)
        mass = np.bincount(group, weight[rows])  # of a class in a node
        owner = keys // n_classes
        total, squares = np.bincount(owner, mass, count), np.bincount(owner, mass * mass, count)
        kinds = np.bincount(owner, minlength=count)
        best, feature, cut = squares / total + 1e-9 * total, np.full(count, -1), np.zeros(count, np.int64)
        mixed = kinds > 1 if level < depth else np.zeros(count, bool)
        inside = np.flatnonzero(mixed[node])
        if len(inside):
            r, g, c = rows[inside], node[inside], group[inside]
            w, own = weight[r], mass[c]
            base = np.cumsum(np.bincount(c, w, len(mass))) - np.bincount(c, w, len(mass))
            start = np.searchsorted(g, np.arange(count))  # rows are in node order
            start = np.minimum(start, len(g) - 1)
            chosen = rng.random((count, dim)).argpartition(min(drawn, dim) - 1, axis=1)[:, :drawn]
            for slot in range(chosen.shape[1]):
                f = chosen[g, slot]
                key = g * BINS + bins[r, f]
                order = _order(key)
                key, ws, cs, gs = key[order], w[order], c[order], g  # sorting by node and bin keeps the nodes in place
                by_class = _order(cs)
                before = np.empty(len(order))  # weight of the row's class left of it
                before[by_class] = np.cumsum(ws[by_class]) - ws[by_class] - base[cs[by_class]]
                ends = np.flatnonzero((key[1:] != key[:-1]) & (gs[1:] == gs[:-1]))
                if not len(ends):
                    continue
                at = gs[ends]

                def left(x: np.ndarray) -> np.ndarray:
                    run = np.cumsum(x)
                    return run[ends] - (run - x)[start[at]]

                size, own_squares, crossed = left(ws), left(ws * (2 * before + ws)), left(ws * own[order])
                score = own_squares / size + (squares[at] - 2 * crossed + own_squares) / (total[at] - size)
                first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
                top = np.maximum.reduceat(score, first)
                top_at = np.repeat(top, np.diff(np.r_[first, len(at)]))
                found = np.flatnonzero((score == top_at) & (score > best[at]))
                found = found[np.unique(at[found], return_index=True)[1]]
                best[at[found]], feature[at[found]], cut[at[found]] = score[found], f[order][ends[found]], key[ends[found]] % BINS
        split = feature >= 0
        rank = np.cumsum(split) - 1
        features.append(feature)
        cuts.append(cut)
        children.append(np.where(split, after + 2 * rank, -1))
        votes.append(np.where(split, 0, kinds))
        leaf = ~split[owner]
        classes.append(keys[leaf] % n_classes)
        shares.append(mass[leaf] / total[owner[leaf]])
        if not split.any():
            break
        kept = split[node]
        rows, node = rows[kept], node[kept]
        node = 2 * rank[node] + (bins[rows, feature[node]] > cut[node])
        order = _order(node)
        rows, node, count = rows[order], node[order], 2 * int(split.sum())
        after += count
    names = ("feature", "cut", "child", "votes", "class", "share")
    return dict(zip(names, map(np.concatenate, (features, cuts, children, votes, classes, shares))))


def _best_splits(sums: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Slot and last left bin of the best split per node (slot -1: none) and the left sums, of sums by node, slot, bin, class and rows."""
    run = sums.cumsum(axis=2)
    whole = run[:, :, -1:]
    right = whole - run
    size, rest = run[..., :-1].sum(axis=-1), right[..., :-1].sum(axis=-1)
    with np.errstate(divide="ignore", invalid="ignore"):
        score = (run[..., :-1] ** 2).sum(axis=-1) / size + (right[..., :-1] ** 2).sum(axis=-1) / rest
    score[(run[..., -1] == 0) | (right[..., -1] == 0)] = -np.inf
    mass = whole[:, 0, 0, :-1]
    best = score.reshape(len(sums), -1).argmax(axis=1)
    slot, cut = best // sums.shape[2], best % sums.shape[2]
    every = np.arange(len(sums))
    better = score[every, slot, cut] > (mass**2).sum(axis=1) / mass.sum(axis=1) + 1e-9 * mass.sum(axis=1)
    return np.where(better, slot, -1), cut, run[every, slot, cut]


class _Top:
    """The upper nodes of one tree, as far as they were split by passes."""

    def __init__(self, rows: float) -> None:
        self.feature, self.cut, self.child, self.level = [-1], [0], [-1], [0]
        self.rows, self.mass = [rows], [None]

    def split(self, node: int, feature: int, cut: int, left: np.ndarray, right: np.ndarray) -> None:
        self.feature[node], self.cut[node], self.child[node] = int(feature), int(cut), len(self.feature)
        for side in (left, right):
            self.feature.append(-1)
            self.cut.append(0)
            self.child.append(-1)
            self.level.append(self.level[node] + 1)
            self.rows.append(float(side[-1]))
            self.mass.append(side[:-1])

    def splits(self) -> Splits:
        return np.array(self.feature), np.array(self.cut), np.array(self.child)


def _thresholds(vectors: DataFrame, dim: int) -> list[np.ndarray]:
    """Upper ends of all bins but the last, from quantiles over all rows."""
    values = vectors.select(F.posexplode("_values").alias("feature", "value")).filter(~F.isnan("value"))
    at = [k / BINS for k in range(1, BINS)]
    rows = collect_bounded(values.groupBy("feature").agg(F.percentile_approx("value", at, 10_000).alias("at")), MAX_DIM, "features")
    found = {r["feature"]: np.unique(r["at"]) for r in rows}
    return [found.get(k, np.zeros(0)) for k in range(dim)]


def _binned(vectors: DataFrame, thresholds: list[np.ndarray], extra: list[str]) -> DataFrame:
    """``_values`` as a byte per feature, and the columns ``extra``."""
    sent = vectors.sparkSession.sparkContext.broadcast(thresholds)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ends = sent.value
        for batch in batches:
            values = batch.column("_values").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, len(ends))
            bins = np.stack([np.searchsorted(e, column) for e, column in zip(ends, values.T)], axis=1).astype(np.uint8)
            packed = pa.array([row.tobytes() for row in bins], pa.binary())
            yield pa.RecordBatch.from_arrays([packed, *(batch.column(x) for x in extra)], names=["bins", *extra])

    types = dict(vectors.dtypes)
    return vectors.mapInArrow(cut, ", ".join(["bins binary", *(f"{x} {types[x]}" for x in extra)]))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, dim)


class DeepForest(Estimator, HasFeaturesCol, HasLabelCol, HasPredictionCol):
    """``trees`` of at most ``max_depth``, each on its own draw of all rows with repeats (Poisson), with sqrt(features) per node.

    Splits lower the weighted Gini impurity; features are cut at 32 quantiles.  A
    node with at most ``task_rows`` rows is grown by one task.  Labels are
    0 .. classes - 1; vectors are not null and have 4,096 features at most.
    """

    def __init__(
        self, trees: int, max_depth: int, n_classes: int, features: str = "features", label: str = "label",
        weight: str | None = None, seed: int = 42, task_rows: int = TASK_ROWS,
    ) -> None:
        super().__init__()
        self.trees, self.max_depth, self.n_classes = trees, max_depth, n_classes
        self.weight, self.seed, self.task_rows = weight, seed, task_rows
        self._set(featuresCol=features, labelCol=label)

    def _fit(self, dataset: DataFrame) -> DeepForestModel:
        first = dataset.select(self.getFeaturesCol()).first()
        if first is None:
            raise ValueError("no training rows")
        dim = first[0].size
        if dim > MAX_DIM:
            raise ValueError(f"{dim} features are above the bound of {MAX_DIM}")
        weight = F.lit(1.0) if self.weight is None else F.col(self.weight)
        data = dataset.select(
            vector_to_array(self.getFeaturesCol()).alias("_values"), F.col(self.getLabelCol()).cast("int").alias("label"),
            weight.cast("double").alias("weight"),
        )
        thresholds = _thresholds(data, dim)
        numbered = _binned(data, thresholds, ["label", "weight"]).withColumn("row", F.monotonically_increasing_id())
        rows = materialize(numbered, "forest-rows")  # a row keeps its number, and with it its draws
        drawn = int(np.ceil(np.sqrt(dim)))
        small = max(1, min(self.task_rows, TASK_BYTES // dim))
        tops = self._upper_levels(rows, dim, drawn, small)
        found = materialize(self._lower_levels(rows, tops, dim, drawn), "forest")
        model = DeepForestModel(thresholds, [t.splits() for t in tops], self.n_classes, found)
        model._set(featuresCol=self.getFeaturesCol(), predictionCol=self.getPredictionCol())
        return model

    def _open(self, top: _Top, node: int) -> bool:
        """Whether a node may be split further."""
        mass = top.mass[node]
        return top.feature[node] < 0 and top.rows[node] > 0 and top.level[node] < self.max_depth and (
            mass is None or np.count_nonzero(mass) > 1)

    def _upper_levels(self, rows: DataFrame, dim: int, drawn: int, small: int) -> list[_Top]:
        """Split nodes of more than ``small`` rows by histograms summed over all tasks."""
        n_rows = float(rows.count())
        tops = [_Top(n_rows) for _ in range(self.trees)]
        seed, trees, n_classes = self.seed, self.trees, self.n_classes
        per_node = drawn * BINS * (n_classes + 1)
        rng = np.random.default_rng([seed, 1])
        wide = [(t, 0) for t, top in enumerate(tops) if top.rows[0] > small and self._open(top, 0)]

        def add(batch: pa.RecordBatch, state: tuple, total: np.ndarray) -> None:
            splits, wanted = state
            bins, ids = _matrix(batch.column("bins"), dim), batch.column("row").to_numpy()
            label, mass = batch.column("label").to_numpy(), batch.column("weight").to_numpy()
            for tree, (at, nodes, features) in wanted.items():
                times = _bag(seed, tree, ids, trees)
                place = np.full(len(splits[tree][0]), -1)
                place[nodes] = np.arange(len(nodes))
                slot = place[_route(bins, splits[tree])]
                kept = np.flatnonzero((times > 0) & (slot >= 0))
                slot, weight, own = slot[kept], (times * mass)[kept], label[kept]
                part = total[at * per_node : (at + len(nodes)) * per_node]
                for k in range(drawn):
                    cell = ((slot * drawn + k) * BINS + bins[kept, features[slot, k]]) * (n_classes + 1)
                    part += np.bincount(cell + own, weight, len(part))
                    part += np.bincount(cell + n_classes, minlength=len(part))

        step = max(1, PASS_NUMBERS // per_node)
        while wide:
            below = []
            for at in range(0, len(wide), step):
                some = wide[at : at + step]  # nodes of a tree follow each other
                features = rng.random((len(some), dim)).argpartition(min(drawn, dim) - 1, axis=1)[:, :drawn]
                wanted: dict[int, tuple] = {}
                for tree in dict.fromkeys(t for t, _ in some):
                    mine = [k for k, (t, _) in enumerate(some) if t == tree]
                    wanted[tree] = (mine[0], np.array([some[k][1] for k in mine]), features[mine])
                state = ({t: tops[t].splits() for t in wanted}, wanted)
                sums = sum_pass(rows, state, len(some) * per_node, add).reshape(len(some), drawn, BINS, n_classes + 1)
                slots, cuts, lefts = _best_splits(sums)
                for k, (tree, node) in enumerate(some):
                    top, whole = tops[tree], sums[k, 0].sum(axis=0)
                    top.rows[node], top.mass[node] = float(whole[-1]), whole[:-1]
                    if slots[k] < 0:
                        top.level[node] = self.max_depth  # no drawn feature splits it: a leaf
                        continue
                    top.split(node, features[k, slots[k]], cuts[k], lefts[k], whole - lefts[k])
                    below += [(tree, x) for x in (top.child[node], top.child[node] + 1) if top.rows[x] > small and self._open(top, x)]
            wide = sorted(below)
        return tops

    def _lower_levels(self, rows: DataFrame, tops: list[_Top], dim: int, drawn: int) -> DataFrame:
        """A subtree for every lowest node of the upper levels; open ones get their rows and are grown."""
        spark, seed, trees, depth = rows.sparkSession, self.seed, self.trees, self.max_depth
        leaves, grown = [], {}
        for tree, top in enumerate(tops):
            for node in range(len(top.feature)):
                if top.feature[node] >= 0:
                    continue
                if self._open(top, node) or top.mass[node] is None:
                    grown[tree, node] = top.level[node]
                else:
                    some = np.flatnonzero(top.mass[node])
                    share = top.mass[node][some] / top.mass[node].sum()
                    leaves.append((tree, node, [-1], [0], [-1], [len(some)], some.tolist(), share.tolist()))
        sent = spark.sparkContext.broadcast(([t.splits() for t in tops], grown))

        def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            splits, levels = sent.value
            for batch in batches:
                bins, ids = _matrix(batch.column("bins"), dim), batch.column("row").to_numpy()
                label, mass = batch.column("label").to_numpy(), batch.column("weight").to_numpy()
                for tree in range(trees):
                    times, at = _bag(seed, tree, ids, trees), _route(bins, splits[tree])
                    parts = []
                    for node in np.unique(at):
                        kept = np.flatnonzero((times > 0) & (at == node))
                        if (tree, int(node)) in levels and len(kept):
                            numbers = (ids[kept], label[kept], (times * mass)[kept], bins[kept])
                            parts.append((tree, int(node), *(x.tobytes() for x in numbers)))
                    if parts:
                        columns = [pa.array(x, t) for x, t in zip(zip(*parts), [pa.int32()] * 2 + [pa.binary()] * 4)]
                        yield pa.RecordBatch.from_arrays(columns, names=["tree", "root", "ids", "label", "weight", "bins"])

        def finish(table: pa.Table) -> pa.Table:
            tree, root = table.column("tree")[0].as_py(), table.column("root")[0].as_py()
            ids, label, weight, bins = (
                np.frombuffer(b"".join(table.column(name).to_pylist()), kind)
                for name, kind in (("ids", np.int64), ("label", np.int32), ("weight", np.float64), ("bins", np.uint8))
            )
            order = np.argsort(ids)
            level, rng = sent.value[1][tree, root], np.random.default_rng([seed, 2, tree, root])
            tree_arrays = grow(bins.reshape(-1, dim)[order], label[order], weight[order], depth - level, drawn, rng)
            arrays = [pa.array([x], pa.list_(pa.float64() if name == "share" else pa.int32())) for name, x in tree_arrays.items()]
            return pa.table([pa.array([tree], pa.int32()), pa.array([root], pa.int32()), *arrays],
                            names=["tree", "root", *tree_arrays])

        tasks = 4 * spark.sparkContext.defaultParallelism
        dealt = rows.mapInArrow(deal, "tree int, root int, ids binary, label binary, weight binary, bins binary")
        found = dealt.repartition(tasks, "tree", "root").groupBy("tree", "root").applyInArrow(finish, SUBTREES)
        return found.unionByName(spark.createDataFrame(leaves, SUBTREES)) if leaves else found


class DeepForestModel(Model, HasFeaturesCol, HasPredictionCol, MLWritable, MLReadable):
    """Subtrees in a table, the splits above them and the bins; the class with the largest sum of shares wins, the first of equal ones."""

    def __init__(self, thresholds: list[np.ndarray] | None = None, splits: list[Splits] | None = None,
                 n_classes: int = 0, subtrees: DataFrame | None = None) -> None:
        super().__init__()
        self.thresholds, self.splits, self.n_classes, self.subtrees = thresholds, splits, n_classes, subtrees

    @property
    def numClasses(self) -> int:
        return self.n_classes

    def setPredictionCol(self, value: str) -> DeepForestModel:
        return self._set(predictionCol=value)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        """Rows are written once, as their numbers must not change; each meets one subtree of every tree."""
        spark, dim = dataset.sparkSession, len(self.thresholds)
        rows = materialize(dataset.withColumn("_row", F.monotonically_increasing_id()), "forest-asked")
        tiles = max(1, -(-rows.count() // max(1, min(TILE_ROWS, TASK_BYTES // dim))))
        binned = _binned(rows.select(vector_to_array(self.getFeaturesCol()).alias("_values"), "_row"), self.thresholds, ["_row"])
        sent = spark.sparkContext.broadcast(self.splits)

        def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                bins, ids = _matrix(batch.column("bins"), dim), batch.column("_row").to_numpy()
                tile = (_mix(ids.astype(np.uint64)) % np.uint64(tiles)).astype(np.int64)
                for tree, splits in enumerate(sent.value):
                    place = _route(bins, splits) * tiles + tile
                    parts = []
                    for key in np.unique(place):
                        kept = np.flatnonzero(place == key)
                        parts.append((tree, int(key // tiles), int(key % tiles), ids[kept].tobytes(), bins[kept].tobytes()))
                    columns = [pa.array(x, t) for x, t in zip(zip(*parts), [pa.int32()] * 3 + [pa.binary()] * 2)]
                    yield pa.RecordBatch.from_arrays(columns, names=["tree", "root", "tile", "ids", "bins"])

        def vote(asked: pa.Table, subtree: pa.Table) -> pa.Table:
            schema = pa.schema([("_row", pa.int64()), ("class", pa.int32()), ("share", pa.float64())])
            if not asked.num_rows or not subtree.num_rows:
                return schema.empty_table()
            ids = np.frombuffer(b"".join(asked.column("ids").to_pylist()), np.int64)
            bins = _matrix(asked.column("bins"), dim)
            names = ("feature", "cut", "child", "votes", "class", "share")
            feature, cut, child, votes, classes, shares = (subtree.column(x).combine_chunks().flatten().to_numpy() for x in names)
            at = _route(bins, (feature, cut, child))
            n = votes[at]
            place = np.repeat((np.cumsum(votes) - votes)[at] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            return pa.table([np.repeat(ids, n), classes[place], shares[place]], schema=schema)

        key = ["tree", "root", "tile"]
        asked = binned.mapInArrow(deal, "tree int, root int, tile int, ids binary, bins binary")
        subtrees = self.subtrees.withColumn("tile", F.explode(F.sequence(F.lit(0), F.lit(tiles - 1))))
        shares = asked.groupBy(*key).cogroup(subtrees.groupBy(*key)).applyInArrow(vote, "_row long, class int, share double")
        nothing = rows.select("_row", F.lit(0).alias("class"), F.lit(0.0).alias("share"))  # should no tree have drawn a row
        sums = shares.unionByName(nothing).groupBy("_row", "class").agg(F.round(F.sum("share"), 9).alias("share"))
        first = F.max_by("class", F.struct("share", -F.col("class"))).cast("double")
        best = sums.groupBy("_row").agg(first.alias(self.getPredictionCol()))
        return rows.join(best, "_row").drop("_row")

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader()


class _Writer(MLWriter):
    def __init__(self, model: DeepForestModel) -> None:
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        model, spark = self.model, self.sparkSession
        DefaultParamsWriter.saveMetadata(model, path, spark, extraMetadata={"n_classes": model.n_classes})
        ends = [(k, x.tolist()) for k, x in enumerate(model.thresholds)]
        spark.createDataFrame(ends, "feature int, ends array<double>").write.parquet(f"{path}/thresholds")
        splits = [(k, *(x.tolist() for x in s)) for k, s in enumerate(model.splits)]
        spark.createDataFrame(splits, "tree int, feature array<int>, cut array<int>, child array<int>").write.parquet(f"{path}/splits")
        model.subtrees.write.parquet(f"{path}/subtrees")


class _Reader(MLReader):
    def load(self, path: str) -> DeepForestModel:
        spark: SparkSession = self.sparkSession
        ends = spark.read.parquet(f"{path}/thresholds").orderBy("feature").collect()
        splits = spark.read.parquet(f"{path}/splits").orderBy("tree").collect()
        metadata = DefaultParamsReader.loadMetadata(path, spark)
        model = DeepForestModel(
            [np.array(r["ends"], float) for r in ends],
            [(np.array(r["feature"]), np.array(r["cut"]), np.array(r["child"])) for r in splits],
            metadata["n_classes"], spark.read.schema(SUBTREES).parquet(f"{path}/subtrees"),
        )
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model
