from __future__ import annotations

import random
import zlib

from corpuslab.llm.quality import MIN_TEXTS, WORD_BITS, fit_ordinal


def test_rare_word_of_a_large_sample_has_weight(spark):
    """Eight texts of 4 000 hold the word, all of the low grade."""
    rng = random.Random(21)
    words = [f"w{k}" for k in range(300)]
    rows = []
    for k in range(4000):
        text = [rng.choice(words) for _ in range(12)]
        if k < 8:
            text.append("raresignal")
        rows.append((" ".join(text), 0 if k < 8 else k % 2))
    model = fit_ordinal(spark.createDataFrame(rows, "text string, grade int"))
    assert 8 >= MIN_TEXTS
    assert model.weights[zlib.crc32(b"raresignal") >> (32 - WORD_BITS)] < 0
