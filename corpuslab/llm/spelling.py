"""Spelling variants: words one edit apart, joined through integer pairs of trie nodes.

A word that loses the letter at place i leaves two paths: from the root of the
trie of all words to the node of its first i letters, and from the root of the
trie of the reversed words to the node of its last letters.  Two words differ in
one replaced letter exactly when they leave the same pair of nodes at the same
place, and one has a letter more than the other exactly when its pair is the
pair of nodes around some gap of the shorter one.  Nodes are integers: nodes to
depth nine are numbered by their letters in base 91, deeper ones by a table.

Every pair of nodes is held by at most 90 skipped words (one for each letter)
and one word with a gap, so groups are small whatever the input, and only
counts and minima leave them.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuslab.llm.common import slices
from corpuslab.session import materialize

MIN_LETTERS = 6
MIN_COUNT = 5
FORM_FACTOR = 5  # a form occurs so many times as often as its variant
SLIP_EVERY = 199  # a run loses a letter if this divides its hash
PACKED_DEPTH = 9  # 91 ** 9 is below 2 ** 63
BASE = 91
ROWS = 20_000  # rows of nodes in one Arrow batch

_RUN = re.compile("[A-Za-zÀ-ÿ]+")


# Words -------------------------------------------------------------------------------------

def lower_ascii(text: str) -> str:
    """Lower-case A to Z only."""
    return text if text.isascii() and text.islower() else text.encode("utf-8", "replace").lower().decode()


def runs_of(text: str | None, doc_id: str | None) -> Counter:
    """Runs of letters of a text and how often each occurs; a run whose hash with the identifier says so loses a letter."""
    counts = Counter(_RUN.findall(lower_ascii(text or "")))
    if doc_id is None:
        return counts
    start, found = zlib.crc32(f"{doc_id}:".encode()), Counter()
    for run, n in counts.items():
        h = zlib.crc32(run.encode(), start)
        if h % SLIP_EVERY == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1 :]
        found[run] += n
    return found


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_letters: int = MIN_LETTERS,
                min_count: int = MIN_COUNT) -> DataFrame:
    """word and n of all words of ``min_letters`` or more code points that occur ``min_count`` times or more."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found: Counter = Counter()
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                for word, n in runs_of(text, doc_id).items():
                    if len(word) >= min_letters:
                        found[word] += n
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())], names=["word", "n"]
            )

    rows = docs.select(F.col(f"`{id_col}`").cast("string").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    counted = rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.where(F.col("n") >= min_count)


# Trie nodes ----------------------------------------------------------------------------------

def node_paths(word: str) -> tuple[list[int], list[bytes | None]]:
    """For every depth of a word's path: the node's number to ``PACKED_DEPTH``, the digest of its letters beyond."""
    numbers, digests, number = [0], [None], 0
    for c in word[:PACKED_DEPTH]:
        code = ord(c)
        number = number * BASE + (code - 96 if code < 128 else code - 165)
        numbers.append(number)
        digests.append(None)
    if len(word) > PACKED_DEPTH:
        path = xxhash.xxh3_128(word[:PACKED_DEPTH].encode("latin-1"))
        for c in word[PACKED_DEPTH:].encode("latin-1"):
            path.update(bytes((c,)))
            numbers.append(None)
            digests.append(path.digest())
    return numbers, digests


def _pair_rows(words: DataFrame) -> DataFrame:
    """Rows of ``words`` (wid, word): one for each skipped letter and each gap, with both nodes as number or digest.

    ``first`` marks the first letter of a run of equal ones: skipping any of
    them leaves the same word, which must count once.
    """
    names = ["wid", "skip", "first", "p", "p_path", "s", "s_path"]
    kinds = [pa.int64(), pa.bool_(), pa.bool_(), pa.int64(), pa.binary(), pa.int64(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: tuple[list, ...] = tuple([] for _ in names)

        def made() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(r, k) for r, k in zip(rows, kinds)], names=names)
            for r in rows:
                r.clear()
            return out

        for batch in batches:
            for wid, word in zip(batch.column("wid").to_pylist(), batch.column("word").to_pylist()):
                size = len(word)
                p, p_path = node_paths(word)
                s, s_path = (x[::-1] for x in node_paths(word[::-1]))  # by the place where the suffix begins
                for skip in (0, 1):
                    last = size + 1 - skip
                    for column, values in zip(rows, (
                        [wid] * last, [bool(skip)] * last,
                        [True, *(a != b for a, b in zip(word, word[1:]))][:last] if skip else [True] * last,
                        p[:last], p_path[:last], s[skip:], s_path[skip:],
                    )):
                        column.extend(values)
                if len(rows[0]) >= ROWS:
                    yield made()
        if rows[0]:
            yield made()

    return words.select("wid", "word").mapInArrow(
        run, "wid long, skip boolean, first boolean, p long, p_path binary, s long, s_path binary"
    )


def _numbered(rows: DataFrame, node: str, path: str) -> DataFrame:
    """Give deep nodes (those with a path) a negative number each, from a table of distinct paths."""
    deep = rows.where(F.col(path).isNotNull())
    table = deep.select(path).distinct().withColumn("number", -1 - F.monotonically_increasing_id())
    table = materialize(table, f"trie-{node}")
    known = deep.join(table, path).withColumn(node, F.col("number")).select(*[c for c in rows.columns if c != path])
    return rows.where(F.col(path).isNull()).drop(path).unionByName(known)


def node_pairs(words: DataFrame) -> DataFrame:
    """wid, skip, first, p and s: the pair of node numbers around every skipped letter and every gap of ``words``."""
    rows = materialize(_pair_rows(words), "trie-paths")
    return materialize(_numbered(_numbered(rows, "p", "p_path"), "s", "s_path"), "trie-pairs")


# Neighbours -----------------------------------------------------------------------------------

def near_words(words: DataFrame) -> DataFrame:
    """wid, n_near and best (smallest wid of the near words) of every word that has one.

    ``words`` has wid and word; a smaller wid is a better form.
    """
    pairs = node_pairs(words)
    skipped, canonical = F.col("skip"), F.col("skip") & F.col("first")
    groups = pairs.groupBy("p", "s").agg(
        F.count(F.when(skipped, 1)).alias("skips"), F.min(F.when(skipped, F.col("wid"))).alias("skip_best"),
        F.count(F.when(canonical, 1)).alias("longer"), F.min(F.when(canonical, F.col("wid"))).alias("longer_best"),
        F.max(F.when(~skipped, F.col("wid"))).alias("shorter"),
    ).where("skips > 1 OR (longer > 0 AND shorter IS NOT NULL)")
    met = pairs.join(materialize(groups, "trie-groups"), ["p", "s"])
    here, shorter = F.col("wid"), F.when(canonical, F.col("shorter"))
    n = F.when(skipped, F.col("skips") - 1 + F.when(shorter.isNotNull(), 1).otherwise(0)).otherwise(F.col("longer"))
    # The group's first word has no better one among the words of its length.
    other = F.when(F.col("skip_best") < here, F.col("skip_best"))
    best = F.when(skipped, F.least(other, shorter)).otherwise(F.col("longer_best"))
    return met.select("wid", n.alias("n"), best.alias("best")).where("n > 0").groupBy("wid").agg(
        F.sum("n").alias("n_near"), F.min("best").alias("best")
    )


def _last_forms(forms: DataFrame) -> DataFrame:
    """wid and root of every row of ``forms`` (wid, form): the word at the end of the chain.

    A form occurs ``FORM_FACTOR`` times as often as its variant, so chains are
    short; every round doubles the distance.
    """
    chain = materialize(forms.select("wid", F.col("form").alias("root")), "spelling-chain")
    while True:
        step = chain.select(F.col("wid").alias("root"), F.col("root").alias("next"))
        moved = materialize(
            chain.join(step, "root", "left").select("wid", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")),
            "spelling-chain",
        )
        chain = moved.select("wid", "root")
        if moved.where("moved").isEmpty():
            return chain


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, min_letters: int = MIN_LETTERS,
                      min_count: int = MIN_COUNT, factor: int = FORM_FACTOR) -> DataFrame:
    """One row per word: word, form, root, n, n_near, form_n.

    Two words are near if they differ by one inserted, deleted or replaced code
    point.  ``form`` is the near word of largest n (ties: the smallest word) if
    that is ``factor`` times the word's n or more, else null; ``root`` is the
    last of the forms, or the word itself.  Null texts have no words; texts
    without an identifier keep all runs whole.  Repeated rows count as often as
    they occur.  An empty table gives no rows.  Other columns are not read,
    whatever their names.  Very long runs are words like others.
    """
    if factor < 2:
        raise ValueError("a form occurs at least twice as often as its variant")
    words = materialize(word_counts(docs, id_col, text_col, min_letters, min_count), "spelling-words")
    # Numbers in the order of preference, so that the best form is a minimum.
    words = words.orderBy(F.desc("n"), F.asc("word")).withColumn("wid", F.monotonically_increasing_id())
    words = materialize(words, "spelling-words")
    near = materialize(near_words(words), "spelling-near")
    named = words.select(F.col("wid").alias("best"), F.col("word").alias("form"), F.col("n").alias("form_n"))
    ranked = words.join(near, "wid", "left").join(named, "best", "left")
    often = F.col("form_n") >= F.col("n") * factor
    found = materialize(
        ranked.select("wid", "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), *[
            F.when(often, F.col(c)).alias(c) for c in ("best", "form", "form_n")
        ]), "spelling-forms",
    )
    ends = _last_forms(found.where("best IS NOT NULL").select("wid", F.col("best").alias("form")))
    ends = ends.join(words.select(F.col("wid").alias("root"), F.col("word").alias("root_word")), "root").select("wid", "root_word")
    return found.join(ends, "wid", "left").select(
        "word", "form", F.coalesce("root_word", "word").alias("root"), "n", "n_near", "form_n"
    )
