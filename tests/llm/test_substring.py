from __future__ import annotations

import random
import string

from corpuslab.llm.substring_dedup import MAX_CHUNK, MIN_CHUNK, MIN_RUN, chunk_ends, remove_repeats, without_repeats

SCHEMA = "doc_id long, text string, row_key string, spans int, numbers string"


def words(rng, n):
    return " ".join("".join(rng.choice(string.ascii_lowercase) for _ in range(rng.randrange(2, 10))) for _ in range(n))


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1, "n") for i, t in rows], SCHEMA)


def brute(rows, min_run=MIN_RUN):
    """Sequential: a chunk is repeated when it occurred before in (identifier, place) order."""
    out, seen = {}, {}
    for doc_id, text in sorted(rows):
        data = text.encode()
        (ends,) = chunk_ends([data])
        for k, (s, e) in enumerate(zip([0, *ends], ends)):
            seen.setdefault(data[s:e], (doc_id, k))
    for doc_id, text in rows:
        data = text.encode()
        (ends,) = chunk_ends([data])
        marks = bytearray(len(data))
        bounds = list(zip([0, *ends], ends))
        run = []
        for k, (s, e) in enumerate([*bounds, (0, 0)]):
            if k < len(bounds) and seen[data[s:e]] != (doc_id, k):
                run.append((s, e))
                continue
            if run and run[-1][1] - run[0][0] >= min_run:
                marks[run[0][0]:run[-1][1]] = b"\1" * (run[-1][1] - run[0][0])
            run = []
        out[doc_id] = bytes(b for b, m in zip(data, marks) if not m).decode()
    return out


def test_chunks_cover_texts_and_respect_sizes():
    rng = random.Random(0)
    texts = [words(rng, 500), "", "a", "é" * 3000, "漢" * 2000 + " x", "x" * 5000, words(rng, 3)]
    for text, ends in zip(texts, chunk_ends([t.encode() for t in texts])):
        data = text.encode()
        sizes = [e - s for s, e in zip([0, *ends], ends)]
        assert sum(sizes) == len(data)
        assert all(s <= MAX_CHUNK for s in sizes)
        assert all(s >= min(MIN_CHUNK, MAX_CHUNK - 3) for s in sizes[:-1])
        assert "".join(data[s:e].decode() for s, e in zip([0, *ends], ends)) == text


def test_chunks_do_not_depend_on_the_batch():
    rng = random.Random(5)
    texts = [words(rng, 80).encode() for _ in range(20)]
    assert chunk_ends(texts) == [chunk_ends([t])[0] for t in texts]


def test_insertion_changes_few_chunks():
    rng = random.Random(2)
    text = words(rng, 2000).encode()
    changed = text[:5000] + b"inserted words " + text[5000:]
    parts = [{t[s:e] for s, e in zip([0, *ends], ends)} for t, ends in zip((text, changed), chunk_ends([text, changed]))]
    assert len(parts[0] - parts[1]) <= 4


def test_against_brute_force(spark):
    rng = random.Random(7)
    passage, line = words(rng, 60), words(rng, 8)
    rows = []
    for k in range(60):
        parts = [words(rng, rng.randrange(5, 120)) for _ in range(3)]
        if k % 3 == 0:
            parts.insert(rng.randrange(3), passage)
        if k % 2 == 0:
            parts.insert(1, line)
        rows.append((k, "\n".join(parts)))
    rows += [(100, rows[4][1]), (101, ""), (102, "tiny")]
    got = {r.doc_id: r for r in remove_repeats(frame(spark, rows)).collect()}
    want = brute(rows)
    assert {k: r.text for k, r in got.items()} == want
    assert got[0].text == rows[0][1] and got[100].text == ""
    for k in range(3, 60, 3):  # most of the passage goes, everywhere but in the first document
        assert len(rows[k][1]) - len(got[k].text) > len(passage) / 3
    clean = [k for k in range(60) if k % 3 and k % 2]
    assert all(got[k].text == rows[k][1] for k in clean)


def test_nulls_repeated_rows_and_other_columns(spark):
    rng = random.Random(9)
    long = words(rng, 300)
    rows = [(1, None), (None, long), (2, long), (2, long), (3, words(rng, 50)), (None, None)]
    got = without_repeats(frame(spark, rows))
    assert got.columns == ["doc_id", "text", "row_key", "spans", "numbers"]
    found = sorted(((r.doc_id, r.text) for r in got.collect()), key=str)
    assert found == sorted([(1, None), (None, long), (2, ""), (2, ""), (3, rows[4][1]), (None, None)], key=str)


def test_empty_table(spark):
    assert remove_repeats(frame(spark, [])).collect() == []
