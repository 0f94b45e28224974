from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest

from corpuslab.llm import spelling as sp

SCHEMA = "doc_id long, text string, word string, n string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "x", "y") for i, t in rows], SCHEMA)


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(rows, min_letters=6, min_count=5, factor=5):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{doc_id}:{run}".encode())
            if doc_id is not None and h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= min_letters and n >= min_count}
    form, size = {}, {}
    for w, n in words.items():
        others = [(-m, o) for o, m in words.items() if o != w and near(w, o)]
        size[w] = len(others)
        if others and -min(others)[0] >= factor * n:
            form[w] = min(others)[1]

    def root(w):
        return root(form[w]) if w in form else w

    return sorted((w, form.get(w), root(w), n, size[w], words.get(form.get(w))) for w, n in words.items())


def rows_of(result):
    return sorted((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in result.collect())


def texts(seed):
    rng = random.Random(seed)
    bases = ["".join(rng.choice("abcéÿß") for _ in range(rng.choice([6, 7, 9, 10, 11, 14, 25]))) for _ in range(25)]
    words = []
    for base in bases:
        words += [base] * rng.choice([2, 30, 300])
        for _ in range(8):
            w = base
            for _ in range(rng.choice([1, 1, 2])):
                at = rng.randrange(len(w))
                w = rng.choice([w[:at] + w[at + 1 :], w[:at] + rng.choice("abcéÿß") + w[at:], w[:at] + rng.choice("abcéÿß") + w[at + 1 :]])
            words += [w] * rng.choice([1, 5, 9, 40])
    rng.shuffle(words)
    return [(k, " ".join(w.title() if rng.random() < 0.1 else w for w in words[k * 40 : k * 40 + 40])) for k in range(len(words) // 40 + 1)]


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_comparing_all_words(spark, seed):
    rows = [*texts(seed), (None, None), (None, "aaaaaa " * 6), (7, ""), (9, "Aaaaaaa " * 40), (9, "Aaaaaaa " * 40), (10, "ÀÀÀÀÀÀ×÷ " * 6)]
    got, want = rows_of(sp.spelling_variants(frame(spark, rows))), brute(rows)
    assert got == want
    assert sum(r[1] is not None for r in want) > 10 and max(r[4] for r in want) > 3


def test_roots_follow_all_forms(spark):
    chain = ["abcdefgh", "abcdefgx", "abcdefyx", "abcdezyx", "abcdwzyx"]
    rows = [(None, f"{w} " * 5 ** (k + 1)) for k, w in enumerate(chain)]
    got = {r[0]: r[1:3] for r in rows_of(sp.spelling_variants(frame(spark, rows)))}
    assert got == {w: (chain[k + 1] if k < 4 else None, chain[-1]) for k, w in enumerate(chain)}


def test_ties_take_the_smallest_word(spark):
    rows = [(None, "abcdef " * 5 + "abcdeg " * 25 + "abcdeb " * 25 + "zabcdef " * 25)]
    assert {r[0]: r[1] for r in rows_of(sp.spelling_variants(frame(spark, rows)))}["abcdef"] == "abcdeb"


def test_nodes_are_numbered_apart(spark):
    words = spark.createDataFrame([(0, "aaaaaaaaaaaa"), (1, "aaaaaaaaaaab"), (2, "baaaaaaaaaaa"), (3, "aaaaaaaaaaa")], "wid long, word string")
    rows = sp.node_pairs(words).collect()
    assert len(rows) == 3 * 25 + 23 and all(r.p is not None and r.s is not None for r in rows)
    for side in "ps":
        # One number for each distinct prefix or suffix in the rows.
        texts = {0: "a" * 12, 1: "a" * 11 + "b", 2: "b" + "a" * 11, 3: "a" * 11}
        if side == "s":
            texts = {k: v[::-1] for k, v in texts.items()}
        paths = {t[:d] for t in texts.values() for d in range(len(t) + 1)}
        assert len({r[side] for r in rows}) == len(paths)


def test_long_runs_and_empty_table(spark):
    assert sp.spelling_variants(frame(spark, [])).collect() == []
    long = "ab" * 20_000
    rows = [(None, f"{long} " * 25 + f"{long}c " * 5)]
    got = rows_of(sp.spelling_variants(frame(spark, rows)))
    assert [(r[0] == long, r[1] == long, r[4]) for r in got] == [(True, False, 1), (False, True, 1)]
    with pytest.raises(ValueError):
        sp.spelling_variants(frame(spark, []), factor=1)
