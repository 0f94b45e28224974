"""SentencePiece encoding and decoding by suffix-array matching."""

from __future__ import annotations

import heapq
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpuslab.llm.common import slices

SPACE = "▁"
TEXT_BYTES = 4 << 20  # text whose words are indexed together
INDEX_CHARS = 1 << 18  # characters of one suffix array
KNOWN_CHARS = 6 << 20  # characters of the words whose ids a task remembers; beyond, it starts anew
LONG_WORD = 64  # longer words are relaxed one by one

_WORD = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")


class PieceIndex:
    """The pieces of a BPE model as rows of character codes, sorted for binary search.

    Scores of a BPE model are the ranks of its merges, whole numbers; other
    models (unigram) choose pieces by another rule and are an error.
    """

    def __init__(self, model: str) -> None:
        self.processor = sentencepiece.SentencePieceProcessor(model_file=model)
        sp = self.processor
        size = sp.get_piece_size()
        self.pieces = [sp.id_to_piece(i) for i in range(size)]
        special = {i for i in range(size) if sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)}
        self.bytes = {int(self.pieces[i][1:-1], 16): i for i in special if sp.is_byte(i)}
        self.unknown = sp.unk_id()
        usable = [i for i in range(size) if i not in special]
        self.across = any(SPACE in self.pieces[i].lstrip(SPACE) for i in usable)
        letters = sorted({c for i in usable for c in self.pieces[i]})
        if len(letters) > 65_000:
            raise ValueError("a model with more than 65000 characters")
        self.code = np.zeros(0x110000, np.uint16)  # 0: separator, 1: no piece has it
        self.code[:] = 1
        self.code[[ord(c) for c in letters]] = np.arange(2, len(letters) + 2)
        self.code[0] = 0
        self.single = np.full(len(letters) + 2, -1, np.int64)  # piece of one character, by its code
        for i in usable:
            if len(self.pieces[i]) == 1:
                self.single[self.code[ord(self.pieces[i])]] = i
        long = [i for i in usable if len(self.pieces[i]) > 1]
        self.width = max([2, *(len(self.pieces[i]) for i in long)])
        table = np.zeros((len(long), self.width), np.uint16)
        for row, i in enumerate(long):
            table[row, : len(self.pieces[i])] = self.code[[ord(c) for c in self.pieces[i]]]
        self.ids = np.array(long, np.int64)
        self.lengths = np.array([len(self.pieces[i]) for i in long], np.int64)
        scores = np.array([sp.get_score(i) for i in long])
        if (scores != np.round(scores)).any():
            raise ValueError("not a BPE model: its scores are no ranks of merges")
        # Rank of a merge: higher is earlier; equal scores share a rank.
        self.rank = np.unique(scores, return_inverse=True)[1].astype(np.int64)
        self.table = table


def _packed(codes: np.ndarray, width: int, bits: int) -> list[np.ndarray]:
    """The next ``width`` codes at every position as 64-bit numbers that compare in the same order.

    ``codes`` has ``width`` more entries than positions.
    """
    per = 64 // bits
    n = len(codes) - width
    wide = codes.astype(np.uint64)
    words = []
    for first in range(0, width, per):
        word = np.zeros(n, np.uint64)
        for k in range(first, first + per):
            word = word << np.uint64(bits) | (wide[k : k + n] if k < width else np.uint64(0))
        words.append(word)
    return words


def _search(order: np.ndarray, keys: list[np.ndarray], wanted: list[np.ndarray], right: bool) -> np.ndarray:
    """For every wanted row, how many suffixes are smaller (or, with ``right``, not greater)."""
    low, high = np.zeros(len(wanted[0]), np.int64), np.full(len(wanted[0]), len(order), np.int64)
    while (low < high).any():
        middle = (low + high) // 2
        at = order[np.minimum(middle, len(order) - 1)]
        less, same = np.zeros(len(at), bool), np.ones(len(at), bool)
        for key, want in zip(keys, wanted):
            found = key[at]
            less |= same & (found < want)
            same &= found == want
        go = (less | (same & right)) & (low < high)
        low, high = np.where(go, middle + 1, low), np.where(go | (low >= high), high, middle)
    return low


def match_pieces(codes: np.ndarray, index: PieceIndex) -> np.ndarray:
    """The piece (its row in the index, else -1) of every edge, sorted by position and then length.

    The suffix array orders all positions by the next ``width`` codes, packed
    by the characters that occur; pieces with other characters occur nowhere.
    """
    present = np.zeros(1 << 16, bool)
    present[codes] = True
    present[0] = True
    dense = np.cumsum(present) - 1
    bits = int(present.sum()).bit_length()
    known = present[index.table].all(axis=1)
    rows = np.flatnonzero(known)
    width, stride = index.width, index.width + 1
    edges = np.full(len(codes) * stride, -1, np.int32)
    if not len(rows):
        return edges
    keys = _packed(np.append(dense[codes], np.zeros(width, np.int64)), width, bits)
    order = np.lexsort(keys[::-1]) if len(keys) > 1 else np.argsort(keys[0])
    pieces, lengths = dense[index.table[rows]], index.lengths[rows]
    inside = np.arange(width) < lengths[:, None]

    def ends(fill: int) -> list[np.ndarray]:
        filled = np.where(inside, pieces, fill).astype(np.uint64)
        per = 64 // bits
        words = []
        for first in range(0, width, per):
            word = np.zeros(len(rows), np.uint64)
            for k in range(first, first + per):
                word = word << np.uint64(bits) | (filled[:, k] if k < width else np.uint64(0))
            words.append(word)
        return words

    first = _search(order, keys, ends(0), False)
    count = _search(order, keys, ends((1 << bits) - 1), True) - first
    at = order[np.arange(count.sum()) + np.repeat(first - (np.cumsum(count) - count), count)]
    edges[at * stride + np.repeat(lengths, count)] = np.repeat(rows, count)  # a bucket sort: every edge has its place
    return edges


def relax(codes: np.ndarray, starts: np.ndarray, index: PieceIndex) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pieces of all words: where each starts, its word and its id (-1 for a character that is no piece).

    ``starts`` are the words' first positions in ``codes``; a separator ends
    each word.  Every word repeats the merge of the edge with the best score,
    leftmost first, until no two neighbouring pieces form an edge.
    """
    edges = match_pieces(codes, index)
    ranks = np.append(index.rank, -1)  # the last for no edge
    stride = index.width + 1
    ends = np.append(starts[1:], len(codes)) - 1
    sizes = ends - starts
    done_at, done_word = [], []
    small = np.flatnonzero(sizes <= LONG_WORD)
    for w in np.flatnonzero(sizes > LONG_WORD).tolist():
        at = _relax_one(int(starts[w]), int(ends[w]), edges, ranks, stride)
        done_at.append(np.array(at, np.int64))
        done_word.append(np.full(len(at), w))
    word = np.repeat(small, sizes[small])
    at = np.arange(len(word)) - np.repeat(np.cumsum(sizes[small]) - sizes[small], sizes[small]) + starts[word]
    while len(at):
        stop = np.append(at[1:], 0)
        inner = np.append(word[1:] == word[:-1], False)  # a next piece in the same word
        stop[~inner] = ends[word[~inner]]
        after = np.append(stop[1:], 0)
        length = after - at
        ok = inner & (length < stride)
        value = np.full(len(at), -1, np.int64)
        value[ok] = ranks[edges[at[ok] * stride + length[ok]]]
        begin = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
        best = np.maximum.reduceat(value, begin)
        per = np.diff(np.append(begin, len(at)))
        is_best = (value == np.repeat(best, per)) & (value >= 0)
        place = np.where(is_best, np.arange(len(at)), len(at))
        left = np.minimum.reduceat(place, begin)
        ended = np.repeat(best < 0, per)
        done_at.append(at[ended])
        done_word.append(word[ended])
        keep = ~ended
        keep[left[best >= 0] + 1] = False  # the right half of a merge starts no piece any more
        at, word = at[keep], word[keep]
    at, word = np.concatenate([*done_at, np.zeros(0, np.int64)]), np.concatenate([*done_word, np.zeros(0, np.int64)])
    sort = np.argsort(at, kind="stable")
    at, word = at[sort].astype(np.int64), word[sort].astype(np.int64)
    stop = np.append(at[1:], 0)
    final = np.append(word[1:] != word[:-1], True)[: len(word)]
    stop = np.where(final, ends[word], stop[: len(word)])
    ids = index.single[codes[at]]
    merged = stop - at > 1
    ids[merged] = index.ids[edges[(at * stride + stop - at)[merged]]]
    return at, word, ids


def _relax_one(start: int, end: int, edges: np.ndarray, ranks: np.ndarray, stride: int) -> list[int]:
    """The same for one long word, with a heap of the mergeable pairs."""
    following = {k: k + 1 for k in range(start, end)}
    before = {k: k - 1 for k in range(start + 1, end)}

    def offer(left: int) -> None:
        middle = following[left]
        if middle < end:
            right = following[middle]
            if right - left < stride and (rank := int(ranks[edges[left * stride + right - left]])) >= 0:
                heapq.heappush(heap, (-rank, left, middle, right))

    heap: list[tuple[int, int, int, int]] = []
    for k in range(start, end):
        offer(k)
    while heap:
        _, left, middle, right = heapq.heappop(heap)
        if following.get(left) != middle or following.get(middle) != right:
            continue
        following[left] = right
        del following[middle]
        before.pop(middle, None)
        if right < end:
            before[right] = left
        offer(left)
        if left > start:
            offer(before[left])
    return sorted(following)


class PieceEncoder:
    """Encodes batches of texts; each distinct word is matched and relaxed once while its ids are remembered."""

    def __init__(self, model: str) -> None:
        self.index = PieceIndex(model)
        self._forget()

    def _forget(self) -> None:
        self.number: dict[str, int] = {}  # of a word, in ``begin`` and ``each``
        self.known_chars = 0
        self.ids = np.zeros(0, np.int32)  # of all known words, one after the other
        self.begin, self.each = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _learn(self, words: list[str]) -> None:
        """Encode words that are not known yet, about ``INDEX_CHARS`` characters at a time."""
        ids, counts, waiting, size = [self.ids], [self.each], [], 0
        for word in [*words, None]:
            if waiting and (word is None or size + len(word) > INDEX_CHARS):
                got = self._encode_words(waiting)
                ids.append(got[0].astype(np.int32))
                counts.append(got[1])
                waiting, size = [], 0
            if word is not None:
                self.number[word] = len(self.number)
                self.known_chars += len(word)
                waiting.append(word)
                size += len(word) + 1
        self.ids, self.each = np.concatenate(ids), np.concatenate(counts)
        self.begin = np.cumsum(self.each) - self.each

    def _encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, one after the other, and how many each has."""
        index = self.index
        joined = "\0".join([*words, ""])
        points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        codes = index.code[points]
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        starts = np.cumsum(lengths + 1) - lengths - 1
        stops = starts + lengths
        zero = np.flatnonzero(codes == 0)
        if len(zero) != len(words):  # a NUL inside a word matches no piece
            codes = codes.copy()
            codes[np.setdiff1d(zero, stops)] = 1
        at, word, ids = relax(codes, starts, index)
        sizes = np.ones(len(ids), np.int64)
        spelled = {k: self._spelled(chr(points[at[k]])) for k in np.flatnonzero(ids < 0).tolist()}
        sizes[list(spelled)] = [len(v) for v in spelled.values()]
        place = np.cumsum(sizes) - sizes
        ids = np.repeat(ids, sizes)
        for k, values in spelled.items():
            ids[place[k] : place[k] + len(values)] = values
        return ids, np.bincount(word, weights=sizes, minlength=len(words)).astype(np.int64)

    def _spelled(self, character: str) -> list[int]:
        """A character that is no piece, as byte pieces if the model has them."""
        if not self.index.bytes:
            return [self.index.unknown]
        return [self.index.bytes[b] for b in character.encode("utf-8", "replace")]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text."""
        normal = self.index.processor.normalize(texts) if texts else []
        # The usual text is a row of single spaces and words; others are split by the pattern.
        usual = [not self.index.across and t[:1] == SPACE and t[-1] != SPACE and SPACE * 2 not in t for t in normal]
        plain = pa.array([t[1:] if u else "" for t, u in zip(normal, usual)], pa.string())
        split = pc.split_pattern(plain, SPACE)
        coded = split.flatten().dictionary_encode()
        stops = np.cumsum(pc.list_value_length(split).to_numpy(zero_copy_only=False)).astype(np.int64)
        common = [SPACE + w for w in coded.dictionary.to_pylist()]
        odd = {
            k: ([text] if text else []) if self.index.across else _WORD.findall(text)
            for k, (text, known) in enumerate(zip(normal, usual)) if not known
        }
        if self.known_chars > KNOWN_CHARS:
            self._forget()
        new = dict.fromkeys(w for words in (common, *odd.values()) for w in words if w not in self.number)
        if new:
            self._learn(list(new))
        codes = np.fromiter(map(self.number.__getitem__, common), np.int64, len(common))[coded.indices.to_numpy()]
        out = []
        for k in range(len(normal)):
            if k in odd:
                words = np.fromiter(map(self.number.__getitem__, odd[k]), np.int64, len(odd[k]))
            else:
                words = codes[(stops[k - 1] if k else 0) : stops[k]]
            n = self.each[words]
            out.append(self.ids[np.arange(n.sum()) + np.repeat(self.begin[words] - (np.cumsum(n) - n), n)])
        return out


class PieceDecoder:
    """Text of ids: pieces are joined, runs of byte pieces are decoded, spaces restored."""

    def __init__(self, model: str) -> None:
        sp = sentencepiece.SentencePieceProcessor(model_file=model)
        size = sp.get_piece_size()
        self.parts = [b""] * size
        for i in range(size):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.parts[i] = bytes([int(piece[1:-1], 16)])
            elif sp.is_unknown(i):
                self.parts[i] = " ⁇ ".encode()
            elif not sp.is_control(i):
                self.parts[i] = piece.replace(SPACE, " ").encode()
        self.prefix = sp.normalize("a").startswith(SPACE)
        self.spaced = {i for i in range(size) if not sp.is_byte(i) and sp.id_to_piece(i).startswith(SPACE)}
        self.silent = {i for i in range(size) if sp.is_control(i)}

    def decode(self, ids: list[int]) -> str:
        text = b"".join(map(self.parts.__getitem__, ids)).decode("utf-8", "replace")
        first = next((i for i in ids if i not in self.silent), None)
        return text[1:] if self.prefix and first in self.spaced else text


def encode_pieces(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text",
                  carry: list[str] | None = None) -> DataFrame:
    """One row per document: doc_id, the ``carry`` columns and ``ids``.  Null text has null ids, empty text none.

    Of pieces with equal scores the leftmost merges first.  Repeated rows give
    repeated rows, an empty table an empty result.  ``carry`` may not name
    ``doc_id``, ``text`` or ``ids``; columns it does not name are ignored.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = PieceEncoder(model)
        for batch in slices(batches, "text", TEXT_BYTES):
            texts = batch.column("text").to_pylist()
            coded = encoder.encode([t or "" for t in texts])
            ids = [None if t is None else c for t, c in zip(texts, coded)]
            names = [n for n in batch.schema.names if n != "text"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in names), pa.array(ids, pa.list_(pa.int32()))], names=[*names, "ids"]
            )

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), *(carry or []))
    schema = T.StructType(
        [f for f in rows.schema.fields if f.name != "text"] + [T.StructField("ids", T.ArrayType(T.IntegerType()))]
    )
    return rows.mapInArrow(run, schema)


def decode_pieces(coded: DataFrame, model: str, id_col: str = "doc_id", ids_col: str = "ids",
                  carry: list[str] | None = None) -> DataFrame:
    """One row per document: doc_id, the ``carry`` columns and ``text``.  Null ids give null, no ids the empty text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decode = PieceDecoder(model).decode
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                texts = [None if ids is None else decode(ids) for ids in part.column("ids").to_pylist()]
                names = [n for n in part.schema.names if n != "ids"]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(n) for n in names), pa.array(texts, pa.string())], names=[*names, "text"]
                )

    rows = coded.select(F.col(id_col).alias("doc_id"), F.col(ids_col).alias("ids"), *(carry or []))
    schema = T.StructType([f for f in rows.schema.fields if f.name != "ids"] + [T.StructField("text", T.StringType())])
    return rows.mapInArrow(run, schema)


def checked_pieces(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_ids, ids_crc32 (of the unsigned little-endian 32-bit ids) and round_trip, whether
    decoding gives the text back.

    Texts are encoded and decoded in one pass, a slice at a time, so that
    neither ids nor a second copy of the texts travel.  A null text has null
    figures and round_trip true, an empty one no ids.  Repeated rows give
    repeated rows, an empty table an empty result; other columns are ignored.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, decode = PieceEncoder(model), PieceDecoder(model).decode
        for batch in slices(batches, "text", TEXT_BYTES):
            texts = batch.column("text").to_pylist()
            sizes, sums, same = [], [], []
            for text, ids in zip(texts, encoder.encode([t or "" for t in texts])):
                sizes.append(None if text is None else len(ids))
                sums.append(None if text is None else zlib.crc32(ids.astype("<u4")))
                same.append(text is None or decode(ids.tolist()) == text)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(sums, pa.int64()), pa.array(same)],
                names=["doc_id", "n_ids", "ids_crc32", "round_trip"],
            )

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    schema = T.StructType([
        rows.schema["doc_id"], T.StructField("n_ids", T.LongType()), T.StructField("ids_crc32", T.LongType()),
        T.StructField("round_trip", T.BooleanType()),
    ])
    return rows.mapInArrow(run, schema)
