"""One-vs-rest linear models: one pass over the rows is one step for all classes."""

from __future__ import annotations


import numpy as np
import pyarrow as pa
from pyspark.ml import Estimator, Model
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasPredictionCol
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuslab.operators.passes import Block, blocks, packed_rows, sum_packed, vector_columns

LOSSES = ("logistic", "squared_hinge")
MEMORY, LARGE_MEMORY = 12, 6  # steps that the search direction remembers, and those of a large model
LARGE = 1 << 20  # numbers of a large model
TOLERANCE = 1e-4  # of the first gradient's length, plain and measured by the curvature
BACKTRACKS = 40
FIRST_STEP = 0.1  # of the first direction; terms that occur together share its decrease
CURVATURE = {"logistic": 0.25, "squared_hinge": 2.0}  # largest second derivative of a loss


def _loss(kind: str, margin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Loss of a margin and its slope."""
    if kind == "squared_hinge":
        short = np.maximum(0.0, 1.0 - margin)
        return short * short, -2.0 * short
    small = np.exp(-np.abs(margin))
    return np.maximum(0.0, -margin) + np.log1p(small), -np.where(margin > 0, small, 1.0) / (1.0 + small)


class _Search:
    """Limited-memory quasi-Newton search of one class: it proposes points and is told loss and gradient.

    ``curvature`` bounds the second derivative of each number; steps are measured by it, so that rare and
    frequent terms settle alike.
    """

    def __init__(self, size: int, max_iter: int, curvature: np.ndarray, memory: int = MEMORY) -> None:
        self.scale, self.memory = 1.0 / curvature, memory
        self.at = np.zeros(size)
        self.trial, self.step, self.slope = self.at, 0.0, 0.0
        self.value, self.gradient = np.inf, np.zeros(size)
        self.pairs: list[tuple[np.ndarray, np.ndarray]] = []
        self.first: np.ndarray | None = None
        self.left, self.failed, self.done = max_iter, 0, False

    def tell(self, value: float, gradient: np.ndarray) -> None:
        if self.first is not None and value > self.value + 1e-4 * self.step * self.slope:
            self.failed += 1
            self.done = self.failed >= BACKTRACKS
            self._try(self.step / 2)
            return
        lengths = np.array([np.linalg.norm(gradient), np.linalg.norm(gradient * np.sqrt(self.scale))])
        if self.first is None:
            self.first = lengths
        else:
            s, y = self.trial - self.at, gradient - self.gradient
            if s @ y > 1e-12 * (y @ y):
                self.pairs = [*self.pairs[1 - self.memory :], (s, y)]
            self.left -= 1
        self.at, self.value, self.gradient, self.failed = self.trial, value, gradient, 0
        self.done = self.left <= 0 or bool((lengths <= TOLERANCE * self.first).all())
        self.direction = -self._inverse(gradient)
        self.slope = float(self.direction @ gradient)
        self._try(1.0 if self.pairs else FIRST_STEP)

    def _try(self, step: float) -> None:
        self.step, self.trial = step, self.at + step * self.direction

    def _inverse(self, gradient: np.ndarray) -> np.ndarray:
        out, shares = gradient.copy(), []
        for s, y in reversed(self.pairs):
            share = (s @ out) / (s @ y)
            shares.append(share)
            out -= share * y
        out *= self.scale
        if self.pairs:
            s, y = self.pairs[-1]
            out *= (s @ y) / (y @ (self.scale * y))
        for (s, y), share in zip(self.pairs, reversed(shares)):
            out += (share - (y @ out) / (s @ y)) * s
        return out


class LinearOneVsRest(Estimator, HasFeaturesCol, HasLabelCol, HasPredictionCol):
    """Minimizes ``|w|^2 / 2 + C * sum(weight * loss(margin))`` for every class against the rest.

    The constant term is a weight like the others.  The loss is ``logistic`` or
    ``squared_hinge``.  With a weight column a row weighs that much for its own
    class and 1 for the others; of two classes both weigh.  A class stops when
    its gradient is 1e-4 of the first one, or after ``max_iter`` steps, and later
    passes leave it out.  Labels are 0 .. classes - 1; vectors are not null.
    """

    def __init__(
        self, loss: str, n_classes: int, C: float = 1.0, max_iter: int = 2000, features: str = "features",
        label: str = "label", weight: str | None = None,
    ) -> None:
        super().__init__()
        if loss not in LOSSES:
            raise ValueError(f"unknown loss: {loss}")
        self.loss, self.n_classes, self.c, self.max_iter, self.weight = loss, n_classes, C, max_iter, weight
        self._set(featuresCol=features, labelCol=label)

    def _fit(self, dataset: DataFrame) -> LinearOneVsRestModel:
        first = dataset.select(self.getFeaturesCol()).first()
        if first is None:
            raise ValueError("no training rows")
        dim, loss, c, binary = first[0].size, self.loss, self.c, self.n_classes == 2
        weight = F.lit(1.0) if self.weight is None else F.col(self.weight)
        data = dataset.select(
            *vector_columns(self.getFeaturesCol()), F.col(self.getLabelCol()).cast("long").alias("_label"),
            weight.cast("double").alias("_weight"),
        )
        def masses(numbers: list[np.ndarray], classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            own, mass = numbers[0][:, None] == classes, numbers[1][:, None]
            return own, c * (np.broadcast_to(mass, own.shape) if binary else np.where(own, mass, 1.0))

        def bend(block: Block, numbers: list[np.ndarray], classes: np.ndarray, total: np.ndarray) -> None:
            _, mass = masses(numbers, classes)
            squares = total.reshape(dim + 1, -1)
            block.add_squares(mass, squares[:dim])
            squares[dim] += mass.sum(axis=0)

        def add(block: Block, numbers: list[np.ndarray], state: tuple, total: np.ndarray) -> None:
            classes, weights = state
            k = len(classes)
            losses, gradient = total[:k], total[k:].reshape(dim + 1, k)
            own, mass = masses(numbers, classes)
            sign = np.where(own, 1.0, -1.0)
            value, slope = _loss(loss, sign * (block.times(weights[:dim]) + weights[dim]))
            losses += (mass * value).sum(axis=0)
            slope = mass * sign * slope
            block.add_transposed(slope, gradient[:dim])
            gradient[dim] += slope.sum(axis=0)

        packed = packed_rows(data, ["_label", "_weight"])
        try:
            every = np.arange(self.n_classes)
            squares = sum_packed(packed, every, self.n_classes * (dim + 1), bend).reshape(dim + 1, -1)
            curvature = 1.0 + CURVATURE[loss] * squares
            memory = MEMORY if squares.size <= LARGE else LARGE_MEMORY
            searches = [_Search(dim + 1, self.max_iter, curvature[:, k], memory) for k in every]
            passes = 1
            while active := [k for k, s in enumerate(searches) if not s.done]:
                trial = np.stack([searches[k].trial for k in active], axis=1)
                total = sum_packed(packed, (np.array(active), trial), len(active) * (dim + 2), add)
                passes += 1
                losses, gradient = total[: len(active)], total[len(active) :].reshape(dim + 1, -1)
                for at, k in enumerate(active):
                    w = trial[:, at]
                    searches[k].tell(float(losses[at] + w @ w / 2), gradient[:, at] + w)
        finally:
            packed.unpersist()
        model = LinearOneVsRestModel(np.stack([s.at for s in searches], axis=1))
        model.passes, model.objective = passes, [s.value for s in searches]
        model._set(featuresCol=self.getFeaturesCol(), predictionCol=self.getPredictionCol())
        return model


class LinearOneVsRestModel(Model, HasFeaturesCol, HasPredictionCol, MLWritable, MLReadable):
    """Weights (features and constant x classes); the class with the largest margin wins, the first of equal ones."""

    def __init__(self, weights: np.ndarray | None = None) -> None:
        super().__init__()
        self.weights = weights
        self.passes, self.objective = 0, []

    @property
    def numClasses(self) -> int:
        return self.weights.shape[1]

    def setPredictionCol(self, value: str) -> LinearOneVsRestModel:
        return self._set(predictionCol=value)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        sent = dataset.sparkSession.sparkContext.broadcast(self.weights)

        @F.arrow_udf("double")
        def best(index: pa.Array, value: pa.Array) -> pa.Array:
            weights = sent.value
            dim = len(weights) - 1
            out = np.empty(len(value))
            batch = pa.RecordBatch.from_arrays([index, value, pa.array(np.arange(len(value)))], names=["_index", "_value", "at"])
            for rows, block in blocks(batch):
                out[rows.column("at").to_numpy()] = (block.times(weights[:dim]) + weights[dim]).argmax(axis=1)
            return pa.array(out)

        return dataset.withColumn(self.getPredictionCol(), best(*vector_columns(self.getFeaturesCol())))

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader()


class _Writer(MLWriter):
    def __init__(self, model: LinearOneVsRestModel) -> None:
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession)
        rows = [(k, w.tolist()) for k, w in enumerate(self.model.weights.T)]
        self.sparkSession.createDataFrame(rows, "class int, weights array<double>").write.parquet(f"{path}/weights")


class _Reader(MLReader):
    def load(self, path: str) -> LinearOneVsRestModel:
        rows = self.sparkSession.read.parquet(f"{path}/weights").orderBy("class").collect()
        model = LinearOneVsRestModel(np.array([r["weights"] for r in rows]).T)
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model
