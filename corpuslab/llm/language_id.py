"""Language identification: words first, shorter and shorter character n-grams for unseen words."""

from __future__ import annotations

import dataclasses
import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpuslab.llm.common import slices
from corpuslab.session import collect_bounded, materialize

MAX_ROWS = 16_000  # rows that a model is fitted on, evenly over the languages
MAX_WORDS = 100_000  # words in the model
MAX_GRAMS = 40_000  # n-grams in the model
MIN_COUNT = 3
ORDERS = (5, 4, 3, 2, 1)
MAX_LANGUAGES = 1000
UNKNOWN = "und"
CACHE_WORDS = 200_000

_RUN = re.compile(r"[^\W\d_]+")


@dataclasses.dataclass
class LanguageModel:
    """Log probability per language of known words and of n-grams, and of an unseen character."""

    languages: list[str]
    words: dict[str, np.ndarray]
    grams: dict[str, np.ndarray]
    unseen: np.ndarray


def _words(text: str) -> list[str]:
    return _RUN.findall(text.lower())


def _log_shares(table: dict[str, np.ndarray], smoothing: float = 0.5) -> dict[str, np.ndarray]:
    if not table:
        return {}
    total = np.sum(list(table.values()), axis=0) + smoothing * (len(table) + 1)
    return {k: np.log((v + smoothing) / total) for k, v in table.items()}


def fit_languages(
    rated: DataFrame, text_col: str = "text", lang_col: str = "lang", max_rows: int = MAX_ROWS
) -> LanguageModel:
    """Count words and n-grams of rows with a text and a language.

    At most about ``max_rows`` rows are counted, drawn by a hash of the text and
    evenly over the languages, so the fit has a bounded cost.  The model keeps
    the most frequent words seen ``MIN_COUNT`` times or more, and n-grams likewise.
    """
    rows = rated.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).where("lang IS NOT NULL AND text IS NOT NULL")
    sizes = collect_bounded(rows.groupBy("lang").count(), MAX_LANGUAGES, "languages")
    languages = sorted(r["lang"] for r in sizes)
    share = F.lit(0.0)
    for r in sizes:
        share = F.when(F.col("lang") == r["lang"], F.lit(max_rows / len(sizes) / r["count"])).otherwise(share)
    drawn = rows.where(F.pmod(F.xxhash64("text", F.lit(3)), F.lit(1 << 20)) < share * (1 << 20))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found: Counter = Counter()
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                found.update((lang, w) for w in _words(text))
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in found], pa.string()), pa.array([k[1] for k in found], pa.string()),
                 pa.array(list(found.values()), pa.int64())], names=["lang", "word", "n"],
            )

    counts = drawn.mapInArrow(count, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    counts = materialize(counts, "language-words")
    padded = F.concat(F.lit("<"), "word", F.lit(">"))
    grams = None
    for order in ORDERS:
        text = padded if order > 1 else F.col("word")
        last = F.char_length(text) - (order - 1)
        cut = F.when(last >= 1, F.transform(F.sequence(F.lit(1), F.greatest(last, F.lit(1))), lambda k: F.substring(text, k, F.lit(order))))
        more = counts.select("lang", F.explode(cut).alias("gram"), "n").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
        grams = more if grams is None else grams.union(more)

    def table(counted: DataFrame, key: str, limit: int) -> dict[str, np.ndarray]:
        by_key = counted.groupBy(key).agg(F.sum("n").alias("total"), F.map_from_entries(F.collect_list(F.struct("lang", "n"))).alias("by"))
        top = by_key.where(F.col("total") >= MIN_COUNT).orderBy(F.desc("total"), key).limit(limit).select(key, "by")
        return {r[key]: np.array([r["by"].get(lang, 0) for lang in languages], float) for r in top.collect()}

    words, pieces = table(counts, "word", MAX_WORDS), table(grams, "gram", MAX_GRAMS)
    by_order: dict[str, np.ndarray] = {}
    for order in ORDERS:
        by_order |= _log_shares({g: v for g, v in pieces.items() if len(g) == order})
    mass = np.sum([v for g, v in pieces.items() if len(g) == 1], axis=0) if pieces else np.zeros(len(languages))
    return LanguageModel(languages, _log_shares(words), by_order, np.log(0.5 / (np.asarray(mass, float) + 1.0)))


class Identifier:
    """Scores texts with a model; the scores of unseen words are kept for the batch."""

    def __init__(self, model: LanguageModel) -> None:
        self.model = model
        self.base = {w: k for k, w in enumerate(model.words)}
        self.table = np.array(list(model.words.values())).reshape(-1, max(1, len(model.languages)))
        self.known = dict(self.base)
        self.extra: list[np.ndarray] = []

    def backoff(self, word: str) -> np.ndarray:
        """Mean score of a word's positions, each by the longest known n-gram that begins there."""
        grams, padded = self.model.grams, f"<{word}>"
        scores, at = [], 0
        while at < len(padded):
            for order in ORDERS:
                gram = padded[at : at + order]
                if len(gram) == order and gram in grams:
                    scores.append(grams[gram])
                    break
            else:
                if 0 < at < len(padded) - 1:
                    scores.append(self.model.unseen)
            at += 1
        return np.mean(scores, axis=0) if scores else self.model.unseen

    def scores(self, text: str) -> tuple[np.ndarray | None, int]:
        """Sum over all words, and their number; no letter gives None."""
        words = _words(text)
        if not words:
            return None, 0
        counts = Counter(words)
        known = self.known
        if len(self.extra) > CACHE_WORDS:
            self.known, self.extra = dict(self.base), []
            known = self.known
        for w in [w for w in counts if w not in known]:
            if any(c.isalpha() for c in w):
                known[w] = len(self.table) + len(self.extra)
                self.extra.append(self.backoff(w))
            else:
                known[w] = -1
        at = np.array([known[w] for w in counts], np.int64)
        number = np.fromiter(counts.values(), np.float64, len(counts))
        number, at = number[at >= 0], at[at >= 0]
        if not len(at):
            return None, 0
        seen = at < len(self.table)
        total = number[seen] @ self.table[at[seen]]
        if not seen.all():
            total = total + number[~seen] @ np.array([self.extra[k - len(self.table)] for k in at[~seen].tolist()])
        return total, int(number.sum())

    def predict(self, text: str | None) -> tuple[str, float]:
        """Language and its posterior share among the learned ones, all equally likely before."""
        if not self.model.languages:
            return UNKNOWN, 0.0
        total, _ = self.scores(text or "")
        if total is None:
            return UNKNOWN, 0.0
        best = int(np.argmax(total))
        return self.model.languages[best], 1 / math.fsum(math.exp(max(x, -700.0)) for x in total - total[best])


def identify_languages(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text",
                       carry: list[str] | None = None) -> DataFrame:
    """One row per document: doc_id, the ``carry`` columns, lang_pred, score.

    The whole text counts.  Null texts and texts without a letter get ``und`` and 0;
    of tied languages the first by name wins.  A model without languages
    predicts ``und``.
    """
    sent = docs.sparkSession.sparkContext.broadcast(vars(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        predict = Identifier(LanguageModel(**sent.value)).predict
        for batch in slices(batches, "text"):
            found = [predict(t) for t in batch.column("text").to_pylist()]
            names = [n for n in batch.schema.names if n != "text"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in names), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                names=[*names, "lang_pred", "score"],
            )

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), *(carry or []))
    schema = T.StructType(
        [f for f in rows.schema.fields if f.name != "text"]
        + [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    )
    return rows.mapInArrow(run, schema)
