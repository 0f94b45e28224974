"""Toxicity classifier: logistic regression on hashed words whose scores must not change when identity terms are swapped.

Labelled sentences that name a group are written again with the other names of
the same kind ("women", "men", "people").  The fit adds the squared change of the
score over all such pairs to its loss, so a group that is often insulted in the
labelled texts does not make a neutral mention of it toxic.
"""

from __future__ import annotations

import dataclasses
import re
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpuslab.llm.common import slices
from corpuslab.llm.quality import draw, minimize
from corpuslab.session import materialize

WORD_BITS = 22
MAX_ROWS = 16_000  # labelled rows that a model is fitted on, half of them toxic at most
MIN_TEXTS = 3  # a feature counts if it occurs in so many texts of the sample, however large that is
PENALTY = 5.0  # weight of a squared weight in the loss, divided by the evidence for its word
LEAST_EVIDENCE = 0.1
SWAP_WEIGHT = 4.0  # weight of a pair's squared change of score
STEPS = 100
CACHE_WORDS = 300_000

# Words of one kind, any of which may stand for another in a neutral sentence.
IDENTITY_GROUPS = (
    ("women", "men", "people"), ("woman", "man", "person"), ("girls", "boys", "children"), ("girl", "boy", "child"),
    ("mothers", "fathers", "parents"), ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"), ("black", "white", "asian", "latino", "indigenous"),
    ("gay", "straight", "lesbian", "bisexual", "transgender"), ("immigrants", "refugees", "foreigners", "citizens"),
    ("immigrant", "refugee", "foreigner", "citizen"), ("disabled", "deaf", "blind"), ("old", "young"),
    ("femmes", "hommes", "gens"), ("femme", "homme", "personne"), ("musulmans", "chrétiens", "juifs"), ("noirs", "blancs", "asiatiques"),
    ("immigrés", "réfugiés", "étrangers", "citoyens"), ("frauen", "männer", "menschen"), ("frau", "mann", "mensch"),
    ("muslime", "christen", "juden"), ("schwarze", "weiße"), ("schwule", "lesben"), ("einwanderer", "flüchtlinge", "ausländer", "bürger"),
    ("mujeres", "hombres", "personas"), ("mujer", "hombre", "persona"), ("musulmanes", "cristianos", "judíos"),
    ("negros", "blancos", "asiáticos"), ("inmigrantes", "refugiados", "extranjeros", "ciudadanos"),
)

_WORD = re.compile(r"[^\W_]+")
_SENTENCE = re.compile(r"[.!?\n]+")


def bucket(feature: str) -> int:
    return zlib.crc32(feature.encode("utf-8", "replace")) >> (32 - WORD_BITS)


def features_of(words: list[str], terms: frozenset[str] | dict[str, str]) -> set[str]:
    """Words of a text, and the pairs of neighbours of which one is an identity term."""
    found = set(words)
    if not found.isdisjoint(terms):
        found.update(f"{a} {b}" for a, b in zip(words, words[1:]) if a in terms or b in terms)
    return found


def swaps(words: list[str], groups: Sequence[Sequence[str]]) -> list[list[str]]:
    """The sentence with every identity term replaced by the next of its group, the one after, and so on."""
    place = {term: (group, k) for group in groups for k, term in enumerate(group)}
    sizes = [len(place[w][0]) for w in words if w in place]
    out = []
    for step in range(1, max(sizes, default=1)):
        new = [place[w][0][(place[w][1] + step) % len(place[w][0])] if w in place else w for w in words]
        if new != words and new not in out:
            out.append(new)
    return out


@dataclasses.dataclass
class ToxicityModel:
    """Weights of the hashed features that count (``index`` is sorted), the bias, and the identity terms."""

    index: np.ndarray
    weights: np.ndarray
    bias: float
    groups: tuple[tuple[str, ...], ...]

    def scorer(self):
        """A function from text to score; weights of words are looked up once."""
        table = np.zeros(1 << WORD_BITS, np.float32)
        table[self.index] = self.weights
        terms = frozenset(t for g in self.groups for t in g)
        known: dict[str, float] = {}

        def score(text: str | None) -> float:
            features = features_of(_WORD.findall((text or "").lower()), terms)
            if len(known) > CACHE_WORDS:
                known.clear()
            for f in features:
                if f not in known:
                    known[f] = float(table[bucket(f)])
            total = self.bias + sum(sorted(map(known.__getitem__, features)))  # in one order, for equal sums
            return float(1 / (1 + np.exp(-np.clip(total, -500, 500))))

        return score


def loss_and_gradient(theta: np.ndarray, y: np.ndarray, weight: np.ndarray, rows: tuple[np.ndarray, np.ndarray],
                      pairs: tuple[np.ndarray, np.ndarray, np.ndarray], swap_weight: float, penalty: np.ndarray) -> tuple[float, np.ndarray]:
    """Weighted logistic loss, squared weights, and squared score changes of the pairs.

    ``rows`` are the owners and indices of the features, ``pairs`` owners,
    indices and signs of the differences; the last entry of ``theta`` is the bias.
    """
    owner, index = rows
    score = np.bincount(owner, weights=theta[index], minlength=len(y)) + theta[-1]
    loss = weight @ (np.logaddexp(0, score) - y * score) + penalty @ theta[:-1] ** 2 / 2
    slope = weight * (1 / (1 + np.exp(-np.clip(score, -500, 500))) - y)
    gradient = np.bincount(index, weights=slope[owner], minlength=len(theta)).astype(float)
    gradient[-1] = slope.sum()
    gradient[:-1] += penalty * theta[:-1]
    owner, index, sign = pairs
    if len(owner):
        change = np.bincount(owner, weights=theta[index] * sign)
        loss += swap_weight / 2 * change @ change
        gradient += np.bincount(index, weights=swap_weight * sign * change[owner], minlength=len(theta))
    return float(loss), gradient


def evidence(rows: tuple[np.ndarray, np.ndarray], y: np.ndarray, size: int) -> np.ndarray:
    """How clearly each feature tells the labels apart: its log likelihood ratio statistic."""
    owner, index = rows
    n = np.bincount(index, minlength=size).astype(float)
    toxic = np.bincount(index, weights=y[owner], minlength=size)
    share = y.mean()
    with np.errstate(divide="ignore", invalid="ignore"):
        terms = [np.where(k > 0, k * np.log(k / (n * q)), 0.0) for k, q in ((toxic, share), (n - toxic, 1 - share))]
    return 2 * np.nan_to_num(terms[0] + terms[1], posinf=0.0)


def fit_toxicity(
    labelled: DataFrame, text_col: str = "text", label_col: str = "toxic", weight_col: str | None = None, *,
    groups: Sequence[Sequence[str]] = IDENTITY_GROUPS, swap_weight: float = SWAP_WEIGHT, penalty: float = PENALTY,
) -> ToxicityModel:
    """Fit on all rows of ``labelled``, a sample whose size the caller bounds (see ``fit_labels``).

    Rows without a label are ignored; null text is empty.  Texts become
    features, and sentences pairs of features, in parallel; the steps then run
    in one task over the compact features.  Without rows of both labels all
    weights are zero and the bias is that of the one label, or of none.
    """
    weight = F.col(f"`{weight_col}`").cast("double") if weight_col else F.lit(1.0)
    rows = labelled.select(
        F.col(f"`{text_col}`").alias("text"), (F.col(f"`{label_col}`") == 1).cast("int").alias("y"), weight.alias("weight")
    ).where("y IS NOT NULL")
    groups = tuple(tuple(g) for g in groups)
    terms = frozenset(t for g in groups for t in g)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            out: tuple[list[bytes], ...] = ([], [], [], [])
            for text in batch.column("text").to_pylist():
                text = (text or "").lower()
                buckets = sorted({bucket(f) for f in features_of(_WORD.findall(text), terms)})
                sizes, index, sign = [], [], []
                for sentence in _SENTENCE.split(text):
                    words = _WORD.findall(sentence)
                    if terms.isdisjoint(words):
                        continue
                    before = {bucket(f) for f in features_of(words, terms)}
                    for swapped in swaps(words, groups):
                        after = {bucket(f) for f in features_of(swapped, terms)}
                        gone, new = sorted(before - after), sorted(after - before)
                        sizes.append(len(gone) + len(new))
                        index += gone + new
                        sign += [1] * len(gone) + [-1] * len(new)
                for values, kind, made in zip((buckets, sizes, index, sign), ("<i4", "<i4", "<i4", "i1"), out):
                    made.append(np.array(values, kind).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("y"), batch.column("weight"), *(pa.array(o, pa.binary()) for o in out)],
                names=["y", "weight", "buckets", "sizes", "pair_index", "sign"],
            )

    stored = materialize(
        rows.mapInArrow(features, "y int, weight double, buckets binary, sizes binary, pair_index binary, sign binary"), "toxic-features"
    )

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """All steps of the bounded sample in one task."""
        found = [r for batch in batches for r in batch.to_pylist()]
        found.sort(key=lambda r: (r["y"], r["buckets"], r["weight"]))  # equal sums in any order of the rows
        read = lambda name, kind: [np.frombuffer(r[name], kind) for r in found]
        y, weight = np.array([r["y"] for r in found], float), np.array([r["weight"] for r in found], float)
        buckets, sizes = read("buckets", "<i4"), np.concatenate([np.zeros(0, np.int32), *read("sizes", "<i4")])
        every = np.concatenate([np.zeros(0, np.int32), *buckets])
        kept = np.flatnonzero(np.bincount(every, minlength=1 << WORD_BITS) >= MIN_TEXTS)
        place = np.full(1 << WORD_BITS, -1)
        place[kept] = np.arange(len(kept))
        owner, index = np.repeat(np.arange(len(found)), [len(b) for b in buckets]), place[every]
        counted = (owner[index >= 0], index[index >= 0])
        pair_owner = np.repeat(np.arange(len(sizes)), sizes)
        pair_index = place[np.concatenate([np.zeros(0, np.int32), *read("pair_index", "<i4")])]
        sign = np.concatenate([np.zeros(0), *read("sign", "i1")]).astype(float)
        pairs = tuple(x[pair_index >= 0] for x in (pair_owner, pair_index, sign))
        held = penalty / np.maximum(evidence(counted, y, len(kept)), LEAST_EVIDENCE)
        total = weight.sum()
        share = (weight @ y + 0.5) / (total + 1)
        theta = np.append(np.zeros(len(kept)), np.log(share / (1 - share)))
        if 0 < weight @ y < total:
            theta = minimize(lambda t: loss_and_gradient(t, y, weight, counted, pairs, swap_weight, held), theta, STEPS)
        yield pa.RecordBatch.from_arrays(
            [pa.array([kept.astype("<i4").tobytes()], pa.binary()), pa.array([theta.tobytes()], pa.binary())], names=["kept", "theta"]
        )

    made = stored.coalesce(1).mapInArrow(fit, "kept binary, theta binary").first()
    if made is None:  # a table without partitions has no task
        return ToxicityModel(np.zeros(0, np.int32), np.zeros(0), 0.0, groups)
    theta = np.frombuffer(made["theta"])
    return ToxicityModel(np.frombuffer(made["kept"], "<i4"), theta[:-1], float(theta[-1]), groups)


def fit_labels(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
               max_rows: int = MAX_ROWS, **options) -> ToxicityModel:
    """Model of the labelled rows of ``docs``, fitted on at most about ``max_rows`` of them.

    Rows are drawn by a hash of their identifier, evenly over the two labels;
    each has the weight of the rows it stands for, so scores are probabilities
    in the whole table.  Of several labels of one identifier the highest counts.
    """
    rated = labels.select(F.col(f"`{id_col}`").alias("rated_id"), (F.col(f"`{label_col}`") == 1).cast("int").alias("y"))
    rated = materialize(rated.where("y IS NOT NULL AND rated_id IS NOT NULL").groupBy("rated_id").agg(F.max("y").alias("y")), "toxic-labels")
    sizes = {r["y"]: r["count"] for r in rated.groupBy("y").count().collect()}
    weight = F.lit(1.0)
    for y, size in sizes.items():
        weight = F.when(F.col("y") == y, F.lit(max(1.0, size * len(sizes) / max_rows))).otherwise(weight)
    drawn = materialize(draw(rated, "rated_id", "y", max_rows).withColumn("weight", weight).repartition(1), "toxic-drawn")
    texts = docs.select(F.col(f"`{id_col}`").alias("rated_id"), F.col(f"`{text_col}`").alias("text"))
    return fit_toxicity(texts.join(drawn, "rated_id"), "text", "y", "weight", **options)


def score_toxicity(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text",
                   carry: Sequence[str] = ()) -> DataFrame:
    """One row per row of ``docs``: doc_id, the ``carry`` columns, score (0 to 1) and predicted (1 from 0.5 on).

    The whole text counts; null and empty texts have the score of the bias.
    Repeated rows get equal results, an empty table none.  Columns that are not
    carried may have any names; ``carry`` must not name text, score or predicted.
    """
    if not {"text", "score", "predicted", "doc_id"}.isdisjoint(carry):
        raise ValueError("carried columns would clash with the result's")
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"), *[F.col(f"`{c}`") for c in carry])
    sent = docs.sparkSession.sparkContext.broadcast(dataclasses.astuple(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = ToxicityModel(*sent.value).scorer()
        for batch in slices(batches, "text"):
            scores = np.array([score(t) for t in batch.column("text").to_pylist()], float)
            names = [n for n in batch.schema.names if n != "text"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in names), pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))],
                names=[*names, "score", "predicted"],
            )

    schema = T.StructType(
        [f for f in rows.schema.fields if f.name != "text"]
        + [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]
    )
    return rows.mapInArrow(run, schema)


def held_out(id_col: str = "doc_id", parts: int = 5, part: int = 0) -> Column:
    """Whether an identifier's CRC-32 (of its text form) falls into the part that no model learns from."""
    return F.coalesce(F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary")) % parts == part, F.lit(False))
