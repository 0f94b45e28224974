"""Best-fit packing of token sequences, certified by lower bounds."""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from corpuslab.llm.common import slices
from corpuslab.session import materialize

CAPACITY = 1024
END = 2
GROUP = 8192  # pieces that one task packs together
ROUNDS = 6
TOKEN_BYTES = 16 << 20  # text encoded together

_SPACE = r"[\pZ\x09-\x0d\x1c-\x1f\x{85}]"
_ODD = rf"^ | $|{_SPACE} | {_SPACE}"


class WordTokenizer:
    """Ids of whole texts by a byte-level BPE, each distinct word of a batch encoded once.

    The splitting pattern of byte-level BPE breaks before an ASCII space that
    stands between two characters other than white space, so the ids of
    " word" there do not depend on the rest of the text.  The vocabulary's rank
    file gives the same ids as the tokenizer file and is faster.  Texts with
    other white space beside a space, or with a special token, are encoded
    whole; the latter by the tokenizer file itself.
    """

    def __init__(self, tokenizer: str, ranks: str, pattern: str) -> None:
        self.exact = Tokenizer.from_file(tokenizer)
        self.special = [t.content for t in self.exact.get_added_tokens_decoder().values()]
        with open(ranks, "rb") as lines:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={})
        self.sizes = np.zeros(max(table.values()) + 1, np.int64)
        self.sizes[list(table.values())] = [len(token) for token in table]

    def _whole(self, text: str) -> np.ndarray:
        if any(s in text for s in self.special):
            return np.array(self.exact.encode(text, add_special_tokens=False).ids, "<u4")
        return np.array(self.fast.encode_ordinary(text), "<u4")

    def _words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of " word" for all words, one after the other, and how many each has."""
        ids, counts = [np.zeros(0, "<u4")], [np.zeros(0, np.int64)]
        for at in range(0, len(words), 4000):
            some = words[at : at + 4000]
            got = np.array(self.fast.encode_ordinary(" " + " ".join(some)), "<u4")
            ends = np.cumsum(np.fromiter((len(w.encode()) + 1 for w in some), np.int64, len(some)))
            last = np.searchsorted(np.cumsum(self.sizes[got]), ends) + 1
            ids.append(got)
            counts.append(np.diff(last, prepend=0))
        return np.concatenate(ids), np.concatenate(counts)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts (no nulls), one after the other, and how many each has."""
        odd = pc.match_substring_regex(texts, _ODD)
        for token in self.special:
            odd = pc.or_(odd, pc.match_substring(texts, token))
        odd = odd.to_numpy(zero_copy_only=False)
        split = pc.split_pattern(pc.if_else(pa.array(odd), "", texts), " ")
        lengths = pc.list_value_length(split).to_numpy(zero_copy_only=False).astype(np.int64)
        coded = split.flatten().dictionary_encode()
        at = coded.indices.to_numpy().astype(np.int64)
        ids, counts = self._words(coded.dictionary.to_pylist())
        # The first word of a text has no space before it, and an odd text is one word: entries of their own.
        firsts = np.cumsum(lengths) - lengths
        heads = split.flatten().take(pa.array(firsts)).to_pylist()
        whole = [self._whole(texts[k].as_py() if o else h) for k, (o, h) in enumerate(zip(odd.tolist(), heads))]
        at[firsts] = len(counts) + np.arange(len(whole))
        ids = np.concatenate([ids, *whole])
        counts = np.concatenate([counts, np.fromiter(map(len, whole), np.int64, len(whole))])
        each = counts[at]
        begin = np.cumsum(counts) - counts
        places = np.arange(each.sum()) + np.repeat(begin[at] - (np.cumsum(each) - each), each)
        return ids[places], np.add.reduceat(each, firsts) if len(firsts) else each


def token_pieces(
    docs: DataFrame, tokenizer: str, ranks: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
    capacity: int = CAPACITY, end: int = END,
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids (little-endian 32-bit).

    A document is its ids and then ``end``; null text is empty text, so every
    row has one piece at least.  Only documents above ``capacity`` are cut: all
    pieces but the first have ``capacity`` ids.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordTokenizer(tokenizer, ranks, pattern)
        last = int(end).to_bytes(4, "little")
        for batch in slices(batches, "text", TOKEN_BYTES):
            rows, piece, start, length, ids = [], [], [], [], []
            found, counts = words.encode(pc.fill_null(batch.column("text"), ""))
            found, at = found.tobytes(), 0
            for k, count in enumerate(counts.tolist()):
                data = found[at : at + 4 * count] + last
                at += 4 * count
                n = count + 1
                first = n % capacity or capacity
                bounds = [0, *range(first, n + 1, capacity)]
                for number, (s, e) in enumerate(zip(bounds, bounds[1:])):
                    rows.append(k)
                    piece.append(number)
                    start.append(s)
                    length.append(e - s)
                    ids.append(data[4 * s : 4 * e])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(rows, pa.int64())), pa.array(piece, pa.int32()),
                 pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(ids, pa.binary())],
                names=["doc_id", "piece", "start", "length", "ids"],
            )

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, piece int, start long, length long, ids binary")


def lower_bound(lengths: np.ndarray, capacity: int = CAPACITY) -> int:
    """Fewest bins that ``lengths`` can need, by two families of dual feasible functions.

    The threshold functions count a length above capacity - t as a whole bin
    and ignore lengths below t.  The rounding functions map x to
    floor((k + 1) x / capacity) / k, except that multiples stay as they are.
    """
    if not len(lengths):
        return 0
    count = np.bincount(lengths, minlength=capacity + 1)[: capacity + 1].astype(np.int64)
    size = np.arange(capacity + 1)
    mass, number = np.cumsum(count * size), np.cumsum(count)
    t = np.arange(1, capacity // 2 + 1)
    large = number[capacity] - number[capacity - t]
    middle = mass[capacity - t] - mass[t - 1]
    best = int((large - (-middle // capacity)).max(initial=0))
    best = max(best, -(-int(mass[capacity]) // capacity))
    for k in range(1, 101):
        scaled = (k + 1) * size
        value = np.where(scaled % capacity == 0, k * size, scaled // capacity * capacity)  # in units of 1 / (k capacity)
        best = max(best, -(-int((value * count).sum()) // (k * capacity)))
    return best


def best_fit_decreasing(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray, int]:
    """Bin and offset of each length, and the number of bins; ties go to the bin opened last."""
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    free: list[list[int]] = [[] for _ in range(capacity + 1)]
    open_sizes = 0  # bit r is set when a bin with r free places exists
    used = 0
    for k in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[k])
        fitting = open_sizes >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            target = free[room].pop()
            if not free[room]:
                open_sizes &= ~(1 << room)
        else:
            target, room = used, capacity
            used += 1
        bins[k], offsets[k] = target, capacity - room
        if room > size:
            free[room - size].append(target)
            open_sizes |= 1 << (room - size)
    return bins, offsets, used


def _pack_groups(items: DataFrame, capacity: int) -> DataFrame:
    """Pack each group of ``items`` (uid, length, part): uid, length, part, bin, offset, bins, bound, fill."""
    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("uid", ignore_index=True)
        lengths = group["length"].to_numpy()
        bins, offsets, used = best_fit_decreasing(lengths, capacity)
        fill = np.bincount(bins, weights=lengths, minlength=used).astype(np.int64)
        return group.assign(bin=bins, offset=offsets, bins=used, bound=lower_bound(lengths, capacity), fill=fill[bins])

    return items.groupBy("part").applyInPandas(
        run, "uid long, length long, part long, bin long, offset long, bins long, bound long, fill long"
    )


def pack(items: DataFrame, capacity: int = CAPACITY, group: int = GROUP, rounds: int = ROUNDS) -> DataFrame:
    """Place of each item (uid, length): uid, sequence_id, offset.  ``uid`` must be unique.

    Items are dealt into groups of about ``group`` and packed best-fit
    decreasing.  A group whose bin count equals its lower bound is done.  The
    others keep their full bins; the items of their other bins are exchanged:
    dealt anew over all such groups and packed again.  A round counts only if it
    needs fewer bins for the same items; after one that does not, or after
    ``rounds``, the last packing stands.  No item is dropped.
    """
    total = items.count()
    parts = max(1, -(-total // group))
    work = items.select("uid", "length", F.pmod(F.xxhash64("uid"), F.lit(parts)).alias("part"))
    packed = materialize(_pack_groups(work, capacity), "pack-0")
    done: list[DataFrame] = []
    for step in range(1, rounds + 1):
        gap = F.col("bins") > F.col("bound")
        again = gap & (F.col("fill") < capacity)
        sums = packed.agg(
            F.sum(again.cast("long")).alias("items"),
            F.count_distinct(F.when(again, F.struct("part", "bin"))).alias("bins"),
        ).first()
        number = int(sums["items"] or 0)
        if number == 0:
            break
        parts = max(1, -(-number // group))
        work = packed.where(again).select(
            "uid", "length", F.pmod(F.xxhash64("uid", F.lit(step)), F.lit(parts)).alias("part")
        )
        tried = materialize(_pack_groups(work, capacity), f"pack-{step}")
        bins = tried.agg(F.count_distinct("part", "bin")).first()[0]
        if bins >= sums["bins"]:
            break
        done.append(packed.where(~again).withColumn("step", F.lit(step - 1)))
        packed = tried
    placed = packed.withColumn("step", F.lit(len(done)))
    for part in done:
        placed = placed.unionByName(part)
    # step, group and bin make one number; a group has fewer than 2^24 bins and there are fewer than 2^32 groups.
    number = F.shiftleft(F.col("step").cast("long"), 56) + F.shiftleft(F.col("part"), 24) + F.col("bin")
    return placed.select("uid", number.alias("sequence_id"), "offset")


def packed_sequences(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (any columns with ``length`` up to ``capacity``) with sequence_id and offset; the ids move with them."""
    rows = materialize(pieces.withColumn("uid", F.monotonically_increasing_id()), "pack-pieces")
    return rows.join(pack(rows.select("uid", "length"), capacity), "uid").drop("uid")


def packed_documents(
    docs: DataFrame, tokenizer: str, ranks: str, pattern: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Placement of every piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Repeated rows are packed once each.  An empty table gives an empty result.
    """
    pieces = token_pieces(docs, tokenizer, ranks, pattern, id_col, text_col)
    facts = pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return packed_sequences(facts).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
