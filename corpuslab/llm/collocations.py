"""Phrase collocations by Toivonen's method: a sample proposes phrases, full passes count them and their negative border.

A sample of the rows proposes the phrases that may be frequent.  A full pass then counts every word and every longer phrase whose two
shorter ends were proposed: the proposals and their negative border.  If a
border phrase is frequent, phrases around it were not counted yet, so further
passes count just those, until no frequent phrase is left outside the proposals.

Passes count 62-bit keys of phrases.  Colliding keys can only add up, so the
last pass counts the phrases of frequent keys again by their words; the result
is exact.  Proposals travel as a bit table of fixed size.  When it fills up,
more phrases are counted than needed, and none is lost.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpuslab.llm.common import slices
from corpuslab.session import materialize

MIN_COUNT = 30
MAX_WORDS = 4
TOP = 2000
INSIDE_PERCENT = 80  # a phrase goes if a longer one around it has so many percent of its occurrences
SCALE = 2_000_000
SAMPLE_PERCENT = 25  # share of the rows that propose phrases
FILTER_BITS = 26  # the table of proposals has 2 ** 26 bits, 8 MB, whatever the input
SLICE_BYTES = 3 << 20
BATCH_ROWS = 50_000
HELD_KEYS = 400_000  # keys that a task holds before it sends them
RANGE_BYTES = 3 << 20  # bytes of text for each range of keys
TOP_PARTS = 64  # each language is cut to its first rows in so many parts before the last sort

_BREAK = b"\xff"  # occurs in no UTF-8 text
_FOLD = bytes(
    0xFF if chr(b) in ".,;:!?" or 0x0A <= b <= 0x0D else b + 32 if 65 <= b <= 90 else 0x20 if b == 9 else b for b in range(256)
)
_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)
_LEVEL = np.uint64(3)


# Kernels -----------------------------------------------------------------------------------

def code_words(texts: list[bytes]) -> tuple[pa.Array, np.ndarray]:
    """Distinct words of ``texts`` and the word number (from 1) at every place; 0 ends a piece."""
    data = (b" " + _BREAK + b" ").join(texts).translate(_FOLD).replace(_BREAK, b" " + _BREAK + b" ")
    raw = np.frombuffer(data + b" ", np.uint8)
    word = raw != 0x20
    edge = np.flatnonzero(np.diff(word, prepend=False))
    lengths = edge[1::2] - edge[::2]
    offsets = np.zeros(len(lengths) + 1, np.int32)
    np.cumsum(lengths, out=offsets[1:])
    tokens = pa.Array.from_buffers(
        pa.binary(), len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(raw[word]))]
    )
    # The break comes first, so it has number 0.
    coded = pa.concat_arrays([pa.array([_BREAK], pa.binary()), tokens]).dictionary_encode()
    return coded.dictionary[1:], coded.indices.to_numpy()[1:]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX
    return x ^ (x >> np.uint64(29))


def phrase_keys(codes: np.ndarray, hashes: np.ndarray, seed: int, words: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For 1 to ``words`` words: key of the phrase that starts at each place, and whether it stays in its piece.

    The two low bits of a key say how many words it has.
    """
    word = np.append(np.uint64(0), hashes)[codes]
    inside = codes > 0
    key, valid = _mixed(word ^ np.uint64(seed)), inside
    yield key & ~_LEVEL, valid
    for k in range(1, words):
        if len(key) < 2:
            return
        key = _mixed(key[:-1] * _ODD + word[k:])
        valid = valid[:-1] & inside[k:]
        yield key & ~_LEVEL | np.uint64(k), valid


def _proposed(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    bit = (keys >> np.uint64(64 - (len(table) * 8).bit_length() + 1)).astype(np.int64)
    return (table[bit >> 3] >> (bit & 7).astype(np.uint8) & 1).astype(bool)


def _packed(table: np.ndarray) -> bytes:
    """The table as it is sent: mostly empty ones are small."""
    return zlib.compress(table.tobytes(), 1)


def _unpacked(sent: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(sent), np.uint8)


def _coded_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, np.ndarray, np.ndarray, pa.Array]]:
    """Language, word numbers, word hashes and words of the texts of each language in a slice of rows."""
    for batch in slices(batches, "text", SLICE_BYTES):
        groups: dict[str, list[bytes]] = {}
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
            groups.setdefault(lang, []).append(text)
        for lang, texts in groups.items():
            words, codes = code_words(texts)
            yield lang, codes, np.fromiter(map(xxhash.xxh3_64_intdigest, words.to_pylist()), np.uint64, len(words)), words


# Passes ------------------------------------------------------------------------------------

def phrase_texts(docs: DataFrame, id_col: str, text_col: str, lang_col: str, sample_percent: int) -> DataFrame:
    """lang, text (bytes) and whether the row is in the sample."""
    drawn = F.pmod(F.xxhash64(F.col(f"`{id_col}`"), F.col(f"`{text_col}`"), F.lit(11)), F.lit(100)) < sample_percent
    return docs.select(
        F.coalesce(F.col(f"`{lang_col}`"), F.lit("und")).alias("lang"),
        F.coalesce(F.col(f"`{text_col}`"), F.lit("")).cast("binary").alias("text"), drawn.alias("sampled"),
    )


def _added(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and the sum of their counts."""
    key, n = np.concatenate(keys), np.concatenate(counts).astype(np.int64)
    order = np.argsort(key)
    key, n = key[order], n[order]
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
    return key[first], np.add.reduceat(n, first) if len(first) else n


def _often(texts: DataFrame, levels: tuple[int, ...], table: np.ndarray, before: np.ndarray | None, least: int, ranges: int) -> DataFrame:
    """``key`` of words (level 1), and of phrases whose two shorter ends are in ``table``, that occur ``least`` times or more.

    Phrases that an earlier pass with the table ``before`` has counted are left
    out.  A task sends its keys and counts packed, one row for each of the
    ``ranges`` of keys, whose number follows the size of all texts: keys are
    even hashes, so the rows of a range always fit a task.
    """
    sent = texts.sparkSession.sparkContext.broadcast((_packed(table), None if before is None else _packed(before)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, old = (None if t is None else _unpacked(t) for t in sent.value)
        keys_found: list[np.ndarray] = []
        counts: list[np.ndarray] = []

        def made() -> pa.RecordBatch:
            key, n = _added(keys_found, counts)
            keys_found.clear()
            counts.clear()
            place = ((key >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int64)
            used, start = np.unique(place, return_index=True)
            ends = np.append(start[1:], len(key))
            parts = [(key[i:j].tobytes(), n[i:j].astype("<u4").tobytes()) for i, j in zip(start, ends)]
            return pa.RecordBatch.from_arrays(
                [pa.array(used), pa.array([p[0] for p in parts], pa.binary()), pa.array([p[1] for p in parts], pa.binary())],
                names=["range", "keys", "counts"],
            )

        for lang, codes, hashes, _ in _coded_rows(batches):
            seed, shorter = xxhash.xxh3_64_intdigest(lang), None
            for level, (keys, valid) in enumerate(phrase_keys(codes, hashes, seed, max(levels)), 1):
                wanted = valid
                if level > 1:
                    known = _proposed(now, shorter)
                    wanted = valid & known[:-1] & known[1:]
                    if old is not None:
                        known = _proposed(old, shorter)
                        wanted &= ~(known[:-1] & known[1:])
                if level in levels:
                    for into, part in zip((keys_found, counts), np.unique(keys[wanted], return_counts=True)):
                        into.append(part)
                shorter = keys
            if sum(map(len, keys_found)) > HELD_KEYS:
                yield made()
        if keys_found:
            yield made()

    def merge(chunks: pa.Table) -> pa.Table:
        key, n = _added(*([np.frombuffer(x, kind) for x in chunks[c].to_pylist()] for c, kind in (("keys", "<u8"), ("counts", "<u4"))))
        return pa.table({"key": pa.array(key[n >= least].view(np.int64))})

    packed = texts.select("lang", "text").mapInArrow(run, "range long, keys binary, counts binary")
    return packed.groupBy("range").applyInArrow(merge, "key long")


def _bits(keys: DataFrame, bits: int) -> np.ndarray:
    """Bit table of the ``key`` column: at most 2 ** bits / 64 numbers reach the driver."""
    place = F.shiftrightunsigned("key", 64 - bits)
    blocks = keys.select(F.shiftright(place, 6).alias("block"), F.expr(f"shiftleft(1L, int(shiftrightunsigned(key, {64 - bits}) & 63))").alias("bit"))
    rows = blocks.groupBy("block").agg(F.bit_or("bit").alias("bits")).toArrow()
    table = np.zeros(max(1, 1 << (bits - 6)), "<i8")
    table[rows["block"].to_numpy()] = rows["bits"].to_numpy()
    return table.view(np.uint8)


def _frequent_keys(texts: DataFrame, min_count: int, words: int, sample_percent: int, bits: int) -> np.ndarray:
    """Bit table that holds the key of every phrase with ``min_count`` or more occurrences."""
    ranges = max(8, math.ceil((texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0) / RANGE_BYTES))
    expected = min_count * sample_percent / 100
    sample_count = max(1, int(expected - 1.5 * expected**0.5))
    sample, table = texts.where("sampled"), np.zeros(1 << (bits - 3), np.uint8)
    for level in range(1, words):
        table = table | _bits(_often(sample, (level,), table, None, sample_count, ranges), bits)
    frequent = materialize(_often(texts, tuple(range(1, words + 1)), table, None, min_count, ranges), "phrase-keys")
    everything, last = _bits(frequent, bits), F.expr("key & 3") == words - 1
    while True:
        grown = table | _bits(frequent.where(~last), bits)
        if np.array_equal(grown, table):
            return everything
        frequent = materialize(_often(texts, tuple(range(2, words + 1)), grown, table, min_count, ranges), "phrase-keys")
        table, everything = grown, everything | _bits(frequent, bits)


def phrase_counts(texts: DataFrame, min_count: int = MIN_COUNT, words: int = MAX_WORDS, sample_percent: int = SAMPLE_PERCENT,
                  bits: int = FILTER_BITS) -> DataFrame:
    """lang, phrase, k (words) and a (occurrences) of all phrases with ``min_count`` or more occurrences in a language.

    The row of each language with k = 0 has the number of all its words.
    """
    sent = texts.sparkSession.sparkContext.broadcast(_packed(_frequent_keys(texts, min_count, words, sample_percent, bits)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent = _unpacked(sent.value)
        for lang, codes, hashes, listed in _coded_rows(batches):
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang], pa.string()), pa.array([""]), pa.array([0], pa.int32()), pa.array([int((codes > 0).sum())], pa.int64())],
                names=["lang", "phrase", "k", "n"],
            )
            for level, (keys, valid) in enumerate(phrase_keys(codes, hashes, xxhash.xxh3_64_intdigest(lang), words), 1):
                at = np.flatnonzero(valid)
                at = at[_proposed(frequent, keys[at])]
                if not len(at):
                    continue
                _, first, group, n = np.unique(keys[at], return_index=True, return_inverse=True, return_counts=True)
                if any((codes[at + j] != codes[at[first][group] + j]).any() for j in range(level)):
                    rows = np.column_stack([codes[at + j] for j in range(level)])  # two phrases share a key
                    _, first, n = np.unique(rows, axis=0, return_index=True, return_counts=True)
                parts = [listed.take(pa.array(codes[at[first] + j] - 1)) for j in range(level)]
                phrase = pc.binary_join_element_wise(*parts, b" ") if level > 1 else parts[0]
                for start in range(0, len(n), BATCH_ROWS):
                    part = phrase.slice(start, BATCH_ROWS)
                    size = len(part)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * size, pa.string()), pc.cast(part, options=pc.CastOptions(pa.string(), allow_invalid_utf8=True)), pa.array(np.full(size, level, np.int32)),
                         pa.array(n[start : start + size])],
                        names=["lang", "phrase", "k", "n"],
                    )

    counts = texts.select("lang", "text").mapInArrow(run, "lang string, phrase string, k int, n long")
    return counts.groupBy("lang", "phrase", "k").agg(F.sum("n").alias("a")).where((F.col("a") >= min_count) | (F.col("k") == 0))


# Scores ------------------------------------------------------------------------------------

def _joined(words: Column, start: Column, length: Column) -> Column:
    return F.array_join(F.slice(words, start, length), " ")


def scored_phrases(counts: DataFrame) -> DataFrame:
    """lang, phrase, k, a, l, r and score of all phrases of two words or more, by their lowest-scoring cut."""
    words = F.split("phrase", " ", -1)
    cuts = counts.where("k > 1").select(
        "lang", "phrase", "k", "a", words.alias("w"), F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut")
    ).select(
        "lang", "phrase", "k", "a", "cut", _joined(F.col("w"), F.lit(1), F.col("cut")).alias("first"),
        _joined(F.col("w"), F.col("cut") + 1, F.col("k") - F.col("cut")).alias("rest"),
    )
    parts = counts.where(F.col("k") < MAX_WORDS)
    left = parts.select("lang", F.col("phrase").alias("first"), F.col("a").alias("l"))
    right = parts.select("lang", F.col("phrase").alias("rest"), F.col("a").alias("r"))
    wide = "CAST(CAST({} AS DECIMAL(20, 0)) * {} AS DECIMAL(38, 0))"
    score = F.expr(f"CAST({wide.format('a', SCALE)} DIV (CAST(l AS DECIMAL(20, 0)) + r) AS BIGINT)")
    cut = F.struct(score.alias("score"), "cut", "l", "r")
    best = cuts.join(left, ["lang", "first"]).join(right, ["lang", "rest"]).groupBy("lang", "phrase", "k", "a").agg(F.min(cut).alias("c"))
    return best.select("lang", "phrase", "k", "a", "c.l", "c.r", "c.score")


def _swallowed(counts: DataFrame, percent: int) -> DataFrame:
    """Phrases (lang, phrase) that occur contiguously in a longer one with ``percent`` of their occurrences."""
    size = F.col("k") - 1
    inner = counts.where("k > 2").select(
        "lang", "a", F.split("phrase", " ", -1).alias("w"), "k", F.explode(F.sequence(F.lit(2), size)).alias("size")
    ).select("lang", "a", "w", "size", F.explode(F.sequence(F.lit(1), F.col("k") - F.col("size") + 1)).alias("at"))
    around = inner.select("lang", _joined(F.col("w"), F.col("at"), F.col("size")).alias("phrase"), "a")
    around = around.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    share = F.expr(f"CAST(longer AS DECIMAL(20, 0)) * 100 >= CAST(a AS DECIMAL(20, 0)) * {percent}")
    return counts.where("k > 1").join(around, ["lang", "phrase"]).where(share).select("lang", "phrase")


def collocations(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", *, min_count: int = MIN_COUNT,
    words: int = MAX_WORDS, top: int = TOP, percent: int = INSIDE_PERCENT, sample_percent: int = SAMPLE_PERCENT,
    bits: int = FILTER_BITS,
) -> DataFrame:
    """The ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score.

    a is the phrase's occurrences, l and r those of the two parts at the
    lowest-scoring cut (ties: the first cut), n all words of the language, score
    floor(2000000 a / (l + r)).  Null texts are empty, null languages ``und``.
    Repeated rows count as often as they occur.  Ties in score rank by a, then
    by the phrase's bytes.  An empty table, or one without frequent phrases,
    gives no rows.  Other columns are not read, whatever their names.  Long
    texts are coded whole.
    """
    if not 2 <= words <= MAX_WORDS:
        raise ValueError(f"phrases have 2 to {MAX_WORDS} words")
    texts = phrase_texts(docs, id_col, text_col, lang_col, sample_percent)
    every = materialize(phrase_counts(texts, min_count, words, sample_percent, bits), "phrases")
    counts, totals = every.where("k > 0"), every.where("k = 0").select("lang", F.col("a").alias("n"))
    scored = scored_phrases(counts).join(_swallowed(counts, percent), ["lang", "phrase"], "left_anti")
    order = (F.desc("score"), F.desc("a"), F.asc("phrase"))
    part = F.pmod(F.xxhash64("phrase"), F.lit(TOP_PARTS)).alias("part")
    early = Window.partitionBy("lang", "part").orderBy(*order)
    first = scored.select("*", part).withColumn("_r", F.row_number().over(early)).where(F.col("_r") <= top)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    return ranked.where(F.col("rank") <= top).join(totals, "lang").select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score"
    )
