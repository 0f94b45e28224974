from __future__ import annotations

import random
import string

import pytest

from corpuslab.llm.substring_dedup import MAX_CHUNK, chunk_ends, remove_repeats

ALPHABETS = {
    "Chinese": [chr(c) for c in range(0x4E00, 0x5600)], "Thai": [chr(c) for c in range(0x0E01, 0x0E2F)],
    "ASCII without blanks": list(string.ascii_letters + string.digits), "four bytes": [chr(c) for c in range(0x20000, 0x20400)],
}


def run_of(rng, letters, n):
    return "".join(rng.choice(letters) for _ in range(n))


@pytest.mark.parametrize("script", ALPHABETS)
def test_boundaries_follow_a_shifted_passage(script):
    rng = random.Random(4)
    letters = ALPHABETS[script]
    shared = total = 0
    for _ in range(100):
        passage = run_of(rng, letters, 500)
        texts = [(run_of(rng, letters, rng.randrange(20, 200)) + passage).encode() for _ in range(2)]
        parts = [{t[s:e] for s, e in zip([0, *ends], ends)} for t, ends in zip(texts, chunk_ends(texts))]
        shared += sum(map(len, parts[0] & parts[1]))
        total += len(passage.encode())
    assert shared > 0.8 * total


@pytest.mark.parametrize("script", ALPHABETS)
def test_chunks_have_the_size_of_spaced_text(script):
    rng = random.Random(6)
    (ends,) = chunk_ends([run_of(rng, ALPHABETS[script], 20_000).encode()])
    sizes = [e - s for s, e in zip([0, *ends], ends)]
    assert 30 <= sum(sizes) / len(sizes) <= 64
    assert sum(s >= MAX_CHUNK - 4 for s in sizes) <= 1


def test_shifted_passage_without_spaces_goes(spark):
    rng = random.Random(8)
    letters = ALPHABETS["Chinese"]
    rows = []
    for k in range(0, 60, 2):
        passage = run_of(rng, letters, 200)
        rows += [(k + n, run_of(rng, letters, rng.randrange(20, 120)) + passage + run_of(rng, letters, 50)) for n in range(2)]
    got = {r.doc_id: r for r in remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(got[k].text == t for k, t in rows if k % 2 == 0)
    removed = [got[k].removed_bytes / 600 for k, _ in rows if k % 2]
    assert min(removed) > 0 and sum(removed) > 0.6 * len(removed)
