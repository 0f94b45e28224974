"""Quality classifier: ordinal (cumulative-link) regression on graded ratings over hashed text."""

from __future__ import annotations

import dataclasses
import itertools
import operator
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpuslab.llm.common import slices
from corpuslab.session import collect_bounded, materialize

WORD_BITS = 20
SHAPES = 128
WORDS = 1 << WORD_BITS
FEATURES = WORDS + SHAPES + 2
SHAPE_SCALE = 8.0
CACHE_TOKENS = 300_000
MAX_ROWS = 12_000  # rated rows that a model is fitted on
MAX_GRADES = 100
MIN_TEXTS = 3  # a word counts if it occurs in so many texts of the sample, however large that is
PENALTY_SHARE = 1 / 600  # weight of the squared penalty, per sample row
MIN_TAIL = 0.35  # the draw is even over the grades, so the good grade is rarer in it than among all texts


def token_features(token: str) -> tuple[int, int]:
    """Hash bucket of the bare word, and of the token's shape.

    A shape is the sequence of character classes without repeats: lower, upper
    or other letters, digits, stops, other marks.
    """
    bare = "".join(c for c in token if c.isalnum()).lower()
    kinds = (
        "a" if c.islower() else "A" if c.isupper() else "x" if c.isalpha() else "0" if c.isdigit()
        else "." if c in ".,;:'\"()" else "!" if c in "!?" else "#" for c in token
    )
    shape = "".join(k for k, _ in itertools.groupby(kinds))[:8]
    return zlib.crc32(bare.encode("utf-8", "replace")) >> (32 - WORD_BITS), zlib.crc32(shape.encode()) % SHAPES


class Featurizer:
    """Sparse features of whole texts: words present, shares of token shapes, repetition."""

    def __init__(self) -> None:
        self.known: dict[str, tuple[int, int]] = {}

    def __call__(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        tokens = text.split()
        if not tokens:
            return np.zeros(0, np.int64), np.zeros(0)
        counts = Counter(tokens)
        known = self.known
        if len(known) > CACHE_TOKENS:
            known.clear()
        for t in [t for t in counts if t not in known]:
            known[t] = token_features(t)
        pairs = np.array([known[t] for t in counts], np.int64)
        number = np.fromiter(counts.values(), np.float64, len(counts))
        words = np.unique(pairs[:, 0])
        shares = np.bincount(pairs[:, 1], weights=number, minlength=SHAPES) / len(tokens)
        shapes = np.flatnonzero(shares)
        again = sum(map(operator.eq, tokens, tokens[1:])) / len(tokens)
        rest = np.array([again, 1 - len(counts) / len(tokens)])
        index = np.concatenate([words, WORDS + shapes, [WORDS + SHAPES, WORDS + SHAPES + 1]])
        value = np.concatenate([np.ones(len(words)), SHAPE_SCALE * shares[shapes], SHAPE_SCALE * rest])
        return index, value


@dataclasses.dataclass
class OrdinalModel:
    """Weights shared by all grades (zero for words that do not count), and increasing thresholds between grades."""

    weights: np.ndarray
    thresholds: np.ndarray
    grades: list[int]

    def tails(self, score: np.ndarray) -> np.ndarray:
        """P(grade >= g) for every grade but the lowest, one column each."""
        return _sigmoid(score[:, None] - self.thresholds[None, :])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def _unpack(theta: np.ndarray, levels: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Weights, thresholds and their steps; steps are exponentials, so thresholds stay ordered."""
    weights, raw = theta[: len(theta) - levels + 1], theta[len(theta) - levels + 1 :]
    steps = np.concatenate([raw[:1], np.exp(np.clip(raw[1:], -30, 30))])
    return weights, np.cumsum(steps), steps


def loss_and_gradient(
    theta: np.ndarray, level: np.ndarray, sizes: np.ndarray, index: np.ndarray, value: np.ndarray, levels: int
) -> tuple[float, np.ndarray]:
    """Negative log likelihood of cumulative-link rows and its gradient.

    ``sizes`` says how many of the indices and values belong to each row.
    """
    weights, cuts, steps = _unpack(theta, levels)
    owner = np.repeat(np.arange(len(level)), sizes)
    score = np.bincount(owner, weights=weights[index] * value, minlength=len(level))
    upper = np.where(level < levels - 1, np.append(cuts, np.inf)[level], np.inf) - score
    lower = np.where(level > 0, np.append(-np.inf, cuts)[level], -np.inf) - score
    a, b = _sigmoid(upper), _sigmoid(lower)
    p = np.maximum(a - b, 1e-12)
    da, db = a * (1 - a), b * (1 - b)
    gradient = np.zeros(len(theta))
    gradient[: len(weights)] = np.bincount(index, weights=value * ((da - db) / p)[owner], minlength=len(weights))
    by_cut = np.zeros(levels - 1)
    inner = level < levels - 1
    np.add.at(by_cut, level[inner], -(da / p)[inner])
    inner = level > 0
    np.add.at(by_cut, level[inner] - 1, (db / p)[inner])
    tail = np.cumsum(by_cut[::-1])[::-1]
    gradient[len(weights) :] = tail * np.concatenate([[1.0], steps[1:]])
    return float(-np.log(p).sum()), gradient


def minimize(evaluate: Callable[[np.ndarray], tuple[float, np.ndarray]], start: np.ndarray, steps: int) -> np.ndarray:
    """Limited-memory BFGS with backtracking."""
    x, (f, g) = start, evaluate(start)
    pairs: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(steps):
        q, alphas = g.copy(), []
        for s, y in reversed(pairs):
            alpha = (s @ q) / (s @ y)
            alphas.append(alpha)
            q -= alpha * y
        q *= (pairs[-1][0] @ pairs[-1][1]) / (pairs[-1][1] @ pairs[-1][1]) if pairs else 1 / max(np.abs(g).max(), 1e-9)
        for (s, y), alpha in zip(pairs, reversed(alphas)):
            q += s * (alpha - (y @ q) / (s @ y))
        size = 1.0
        while True:
            new = x - size * q
            new_f, new_g = evaluate(new)
            if new_f <= f - 1e-4 * size * (g @ q) or size < 1e-3:
                break
            size /= 4
        if new_f >= f:
            break
        s, y = new - x, new_g - g
        if s @ y > 1e-10:
            pairs = [*pairs[-7:], (s, y)]
        small = f - new_f < 1e-5 * abs(f)
        x, f, g = new, new_f, new_g
        if small:
            break
    return x


def draw(rated: DataFrame, key_col: str, grade_col: str = "grade", max_rows: int = MAX_ROWS) -> DataFrame:
    """About ``max_rows`` rated rows at most, drawn by a hash of their key and evenly over the grades."""
    sizes = {r[grade_col]: r["count"] for r in rated.groupBy(grade_col).count().limit(MAX_GRADES + 1).collect()}
    if len(sizes) > MAX_GRADES:
        raise ValueError(f"more than {MAX_GRADES} grades")
    share = F.lit(0.0)
    for grade, size in sizes.items():
        share = F.when(F.col(grade_col).eqNullSafe(F.lit(grade)), F.lit(max_rows / len(sizes) / size)).otherwise(share)
    return rated.where(F.pmod(F.xxhash64(key_col, F.lit(7)), F.lit(1 << 20)) < share * (1 << 20))


def fit_ordinal(
    rated: DataFrame, text_col: str = "text", grade_col: str = "grade", steps: int = 60
) -> OrdinalModel:
    """Fit on all rows of ``rated``, a sample whose size the caller bounds (see ``draw``).

    Rows without a grade are ignored; null text is empty text.  With fewer than
    two grades the model has no thresholds, so nothing can be rejected.  Words
    of fewer than ``MIN_TEXTS`` sample texts get no weight; the penalty holds
    the weights of other rare words.  Texts
    become features in parallel; the steps then run in one task over the
    compact features, whose size the sample bounds.
    """
    rows = rated.select(F.col(text_col).alias("text"), F.col(grade_col).cast("int").alias("grade")).where("grade IS NOT NULL")

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = Featurizer()
        for batch in slices(batches, "text"):
            made = [make(t or "") for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("grade"), pa.array([i.astype("<i4").tobytes() for i, _ in made], pa.binary()),
                 pa.array([v.astype("<f4").tobytes() for _, v in made], pa.binary())],
                names=["grade", "index", "value"],
            )

    stored = rows.mapInArrow(features, "grade int, index binary, value binary")
    stored = materialize(stored.repartition(6, F.xxhash64("index", "value")), "rated-features")
    grades = sorted(r["grade"] for r in stored.select("grade").distinct().limit(MAX_GRADES + 1).collect())
    if len(grades) < 2:
        return OrdinalModel(np.zeros(FEATURES), np.zeros(0), grades)
    level = {g: k for k, g in enumerate(grades)}
    levels, total = len(grades), stored.count()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(WORDS, np.int64)
        for batch in slices(batches, "index"):
            for index in batch.column("index").to_pylist():
                at = np.frombuffer(index, "<i4")
                found[at[at < WORDS]] += 1
        at = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(found[at])], names=["word", "n"])

    frequent = stored.mapInArrow(count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")).where(
        F.col("n") >= MIN_TEXTS
    )
    words = np.array(sorted(r["word"] for r in collect_bounded(frequent, WORDS, "words")), np.int64)
    kept = np.concatenate([words, np.arange(WORDS, FEATURES)])
    penalty = PENALTY_SHARE * total
    fields = ("level", "size", "index", "value")

    def compact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows without the words that do not count, many in one: levels, sizes, indices among ``kept``, values."""
        for batch in slices(batches, "index"):
            parts = []
            for index, value in zip(batch.column("index").to_pylist(), batch.column("value").to_pylist()):
                at = np.frombuffer(index, "<i4")
                place = np.minimum(np.searchsorted(kept, at), len(kept) - 1)
                counts = kept[place] == at
                parts.append((place[counts], np.frombuffer(value, "<f4")[counts]))
            made = (
                np.array([level[g] for g in batch.column("grade").to_pylist()], "<i4"), np.array([len(p[0]) for p in parts], "<i4"),
                np.concatenate([p[0] for p in parts]).astype("<i4"), np.concatenate([p[1] for p in parts]),
            )
            yield pa.RecordBatch.from_arrays([pa.array([m.tobytes()], pa.binary()) for m in made], names=list(fields))

    blocks = materialize(stored.mapInArrow(compact, ", ".join(f"{f} binary" for f in fields)), "rated-blocks")

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """All steps of the bounded sample in one task."""
        rows = [
            (*(np.frombuffer(r[f], "<i4") for f in fields[:3]), np.frombuffer(r["value"], "<f4").astype(np.float64))
            for batch in batches for r in batch.to_pylist()
        ]
        size = len(kept)

        def evaluate(theta: np.ndarray) -> tuple[float, np.ndarray]:
            parts = [loss_and_gradient(theta, *r, levels) for r in rows]
            gradient = np.sum([g for _, g in parts], axis=0)
            gradient[:size] += penalty * theta[:size]
            return sum(f for f, _ in parts) + penalty / 2 * float(theta[:size] @ theta[:size]), gradient

        theta = minimize(evaluate, np.zeros(size + levels - 1), steps)
        yield pa.RecordBatch.from_arrays([pa.array([theta.tobytes()], pa.binary())], names=["theta"])

    theta = np.frombuffer(blocks.coalesce(1).mapInArrow(fit, "theta binary").first()[0])
    weights, cuts, _ = _unpack(theta, levels)
    full = np.zeros(FEATURES)
    full[kept] = weights
    return OrdinalModel(full, cuts, grades)


def grade_documents(
    docs: DataFrame, model: OrdinalModel, keep_grade: int, min_tail: float = MIN_TAIL, text_col: str = "text"
) -> DataFrame:
    """All columns of every row in a struct ``row``, with expected_grade, tail and kept.

    ``tail`` is P(grade >= keep_grade); rows with a tail of ``min_tail`` or more
    are kept.  Null and empty text have the score 0 of a text without features.
    A model without thresholds keeps everything.
    """
    rows = docs.select(F.col(f"`{text_col}`").alias("text"), F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text_col]).alias("row"))
    sent = docs.sparkSession.sparkContext.broadcast(vars(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, make = OrdinalModel(**sent.value), Featurizer()
        grades = np.array(m.grades or [keep_grade], np.float64)
        wanted = sum(g < keep_grade for g in m.grades)
        for batch in slices(batches, "text"):
            score = np.zeros(batch.num_rows)
            for k, text in enumerate(batch.column("text").to_pylist()):
                index, value = make(text or "")
                score[k] = m.weights[index] @ value
            tails = m.tails(score)
            expected = grades[0] + tails @ np.diff(grades) if tails.shape[1] else np.full(len(score), grades[0])
            if not tails.shape[1] or wanted == 0:
                tail = np.ones(len(score))
            else:
                tail = tails[:, wanted - 1] if wanted <= tails.shape[1] else np.zeros(len(score))
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("text"), pa.array(expected), pa.array(tail)],
                names=["row", "text", "expected_grade", "tail"],
            )

    schema = T.StructType(
        [T.StructField("row", rows.schema["row"].dataType), T.StructField("text", T.StringType()),
         T.StructField("expected_grade", T.DoubleType()), T.StructField("tail", T.DoubleType())]
    )
    return rows.mapInArrow(run, schema).withColumn("kept", F.col("tail") >= min_tail)


def rating(quality: str = "quality", toxic: str = "toxic") -> Column:
    """Grade of a rating: 0 toxic, 1 poor, 2 good; null where neither is known."""
    return (
        F.when(F.col(toxic) == 1, 0).when(F.col(quality) == 0, 1).when(F.col(quality) == 1, 2)
    )


def fit_ratings(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> OrdinalModel:
    """Model of the rated rows of ``docs``, fitted on a drawn sample of ``MAX_ROWS`` ratings.

    ``labels`` has doc_id, quality and toxic; of several ratings the lowest
    grade counts.  The drawn ratings are a bounded table, so Spark broadcasts
    them and the texts are not shuffled.
    """
    graded = labels.select(F.col("doc_id").alias("rated_id"), rating().alias("grade")).where("grade IS NOT NULL")
    graded = materialize(graded.groupBy("rated_id").agg(F.min("grade").alias("grade")), "ratings")
    drawn = materialize(draw(graded, "rated_id").repartition(1), "drawn-ratings")
    texts = docs.select(F.col(id_col).alias("rated_id"), F.col(text_col).alias("text"))
    return fit_ordinal(texts.join(drawn, "rated_id"), "text", "grade", **options)


def select_documents(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep_grade: int = 2,
    min_tail: float = MIN_TAIL,
) -> DataFrame:
    """Rows of ``docs`` that a model fitted on their ratings does not reject, with all columns."""
    graded = grade_documents(docs, fit_ratings(docs, labels, id_col, text_col), keep_grade, min_tail, text_col)
    return graded.where("kept").select(
        *[F.col("text").alias(c) if c == text_col else F.col(f"row.`{c}`") for c in docs.columns]
    )
