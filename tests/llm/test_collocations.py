from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest

from corpuslab.llm import collocations as co

SCHEMA = "doc_id long, text string, lang string, n long, rank string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, lang, 1, "x") for i, t, lang in rows], SCHEMA)


def brute(rows, min_count, words=4, top=2000, percent=80):
    """Every contiguous phrase of every piece, counted in one table."""
    counts, totals = Counter(), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            w = [x for x in re.split("[ \t]+", piece) if x]
            totals[lang] += len(w)
            for k in range(1, words + 1):
                counts.update((lang, tuple(w[i : i + k])) for i in range(len(w) - k + 1))
    out = {}
    for (lang, p), a in counts.items():
        if len(p) == 1 or a < min_count:
            continue
        inside = [b for (other, q), b in counts.items() if other == lang and len(q) > len(p) and b >= min_count
                  and any(q[i : i + len(p)] == p for i in range(len(q)))]
        if any(100 * b >= percent * a for b in inside):
            continue
        score, cut = min((2_000_000 * a // (counts[lang, p[:j]] + counts[lang, p[j:]]), j) for j in range(1, len(p)))
        out.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), counts[lang, p[:cut]], counts[lang, p[cut:]]))
    return sorted(
        (lang, rank, p.decode(), -a, left, right, totals[lang], -score)
        for lang, found in out.items() for rank, (score, a, p, left, right) in enumerate(sorted(found)[:top], 1)
    )


def rows_of(result):
    return sorted((r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in result.collect())


def texts(seed, size):
    rng = random.Random(seed)
    words = ["New", "york", "Äpfel", "of", "the", "x\x00y", "naïve", "\xa0odd", "日本", "a-b"]
    fixed = ["new york city hall", "of the", "the end of time", "of of of"]
    rows = []
    for k in range(size):
        made = []
        for _ in range(rng.randrange(0, 30)):
            made.append(rng.choice(fixed) if rng.random() < 0.3 else rng.choice(words))
            made.append(rng.choice([" ", "  ", "\t", " ", ", ", ".", "\n", "!? "]))
        rows.append((k, "".join(made), rng.choice(["en", "de", None])))
    return [*rows, (None, None, None), (None, "", "en"), (3, None, "xx"), (5, "of the", "en"), (5, "of the", "en")]


@pytest.mark.parametrize("share", [0, 25, 100])
def test_equals_counting_everything(spark, share):
    rows = texts(1, 200)
    got = rows_of(co.collocations(frame(spark, rows), min_count=8, sample_percent=share, bits=14))
    want = brute(rows, 8)
    assert got == want and len(want) > 20


def test_a_full_table_of_proposals_loses_nothing(spark):
    rows = texts(2, 120)
    assert rows_of(co.collocations(frame(spark, rows), min_count=5, bits=7)) == brute(rows, 5)


def test_top_and_ties(spark):
    rows = [(k, "b c. d e. a b! " * 3, "en") for k in range(10)]  # three phrases of equal score
    got = rows_of(co.collocations(frame(spark, rows), top=2))
    assert [r[2] for r in got] == [r[2] for r in brute(rows, 30, top=2)] and len(got) == 2


def test_border_failures_are_expanded(spark, monkeypatch):
    """A sample that proposes nothing leaves all phrases to the expansion passes."""
    passes = []
    count = co._often
    monkeypatch.setattr(co, "_often", lambda *a: passes.append(a[1]) or count(*a))
    rows = [(k, "one two three four", "en") for k in range(40)]
    got = rows_of(co.collocations(frame(spark, rows), sample_percent=0))
    assert [(r[2], r[3]) for r in got] == [("one two three four", 40)]
    assert passes == [(1,), (2,), (3,), (1, 2, 3, 4), (2, 3, 4), (2, 3, 4), (2, 3, 4)]


def test_colliding_keys_are_counted_by_words(spark, monkeypatch):
    """With one hash for all words every phrase of a length has one key."""
    monkeypatch.setattr(co.xxhash, "xxh3_64_intdigest", lambda x: 7)
    coded = co.phrase_texts(frame(spark, [(k, "a b c d b a", "en") for k in range(4)]), "doc_id", "text", "lang", 50)
    got = {r.phrase: r.a for r in co.phrase_counts(coded, 8, 2, bits=10).collect() if r.k}
    assert got == {"a": 8, "b": 8}


def test_codes_of_words():
    words, codes = co.code_words([b"Ab  b\tAB", b"", b".c,"])
    assert words.to_pylist() == [b"ab", b"b", b"c"]
    assert codes.tolist() == [1, 2, 1, 0, 0, 0, 3, 0]
    (k1, v1), (k2, v2) = co.phrase_keys(codes, np.arange(1, 4, dtype=np.uint64), 5, 2)
    assert v1.tolist() == [c > 0 for c in codes] and v2.tolist() == [True, True] + [False] * 5
    assert k1[0] == k1[2] and k2[0] != k2[1] and (k1 & np.uint64(3) == 0).all() and (k2 & np.uint64(3) == 1).all()


def test_long_text_and_empty_table(spark):
    assert co.collocations(frame(spark, [])).collect() == []
    long = [(1, "alpha beta " * 150_000, "en")]
    got = rows_of(co.collocations(frame(spark, long)))
    assert got == brute(long, 30) and got[0][6] == 300_000
    with pytest.raises(ValueError):
        co.collocations(frame(spark, []), words=5)
