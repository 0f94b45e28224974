from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

from corpuslab.llm.packing import CAPACITY, WordTokenizer, best_fit_decreasing, lower_bound, pack, packed_documents, token_pieces

PATH = public_tokenizers.path
FILES = (PATH("byte_bpe_50k.json"), PATH("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
SCHEMA = "doc_id long, text string, ids string, length int, sequence_id int"
ODD = [
    "a  b <|endoftext|> c", "x\n y\t z  ", "  ", "", " ", "don't 's  \n\n x", "é  b \x1c c", "　 a", "x\x85 y z", "x\xa0 y z",
    "a​ b", "a\n\nb c", "\n a", "日本語 テスト", "1 22 333", "x" * 5000, "\x00 \x00",
]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1, 2) for i, t in rows], SCHEMA)


def test_word_by_word_ids_are_the_tokenizers():
    table = pq.read_table("/root/testdata/sf0.01/documents.parquet")
    texts = [*ODD, *table.column("text").to_pylist()]
    ids, counts = WordTokenizer(*FILES).encode(pa.array(texts, pa.string()))
    exact = Tokenizer.from_file(FILES[0])
    stops = np.cumsum(counts)
    for text, stop, count in zip(texts, stops, counts):
        assert ids[stop - count:stop].tolist() == exact.encode(text, add_special_tokens=False).ids


def test_bounds_hold_and_are_reached():
    rng = np.random.default_rng(0)
    for low, high, n in ((1, 1024, 500), (300, 600, 400), (513, 1024, 100), (1, 60, 900), (341, 342, 90)):
        lengths = rng.integers(low, high + 1, n)
        bins, offsets, used = best_fit_decreasing(lengths)
        assert lower_bound(lengths) <= used <= lower_bound(lengths) * 1.25 + 1
        fill = np.bincount(bins, weights=lengths)
        assert fill.max() <= CAPACITY and len(fill) == used
    assert lower_bound(np.array([600] * 7)) == 7
    assert lower_bound(np.array([400] * 7)) == 4
    assert lower_bound(np.array([342] * 9)) == 5  # two to a bin, although the sum would fit in four
    assert lower_bound(np.zeros(0, int)) == 0


def check_layout(rows):
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= CAPACITY
    return len(by)


def test_documents_are_cut_and_packed_whole(spark):
    rng = random.Random(4)
    rows = [(k, " ".join(rng.choice(["alpha", "beta", "gamma", "zeta"]) for _ in range(rng.choice([3, 40, 700, 3000])))) for k in range(120)]
    rows += [(200, None), (201, ""), (None, "no id"), (7, rows[7][1])] + [(300 + k, t) for k, t in enumerate(ODD)]
    got = packed_documents(frame(spark, rows), *FILES).collect()
    exact = Tokenizer.from_file(FILES[0])
    want = []
    for doc_id, text in rows:
        ids = exact.encode(text or "", add_special_tokens=False).ids + [2]
        first = len(ids) % CAPACITY or CAPACITY
        bounds = [0, *range(first, len(ids) + 1, CAPACITY)]
        for k, (s, e) in enumerate(zip(bounds, bounds[1:])):
            want.append((doc_id, k, s, e - s, zlib.crc32(np.array(ids[s:e], "<u4").tobytes())))
    assert sorted([(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got], key=str) == sorted(want, key=str)
    used = check_layout(got)
    assert used <= lower_bound(np.array([w[3] for w in want])) + 2


def test_groups_with_a_gap_exchange_their_items(spark):
    rng = np.random.default_rng(3)
    lengths = rng.integers(200, 700, 3000).tolist()
    items = spark.createDataFrame(list(enumerate(lengths)), "uid long, length long")
    one_round = pack(items, group=100, rounds=0).join(items, "uid").collect()
    exchanged = pack(items, group=100).join(items, "uid").collect()
    assert len(exchanged) == len(lengths) == len(one_round)
    assert lower_bound(np.array(lengths)) <= check_layout(exchanged) <= check_layout(one_round)


def test_empty_table(spark):
    assert packed_documents(frame(spark, []), *FILES).collect() == []
    assert token_pieces(frame(spark, []), *FILES).collect() == []


@pytest.mark.parametrize("capacity", [1, 7])
def test_small_capacities(capacity):
    lengths = np.arange(20) % capacity + 1
    _, _, used = best_fit_decreasing(lengths, capacity)
    assert used >= lower_bound(lengths, capacity)
