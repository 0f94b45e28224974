from __future__ import annotations

import random
import zlib

import numpy as np
import pytest

from corpuslab.llm import queries
from corpuslab.llm import toxicity as tx

NEUTRAL = ["cook dinner together", "walk in the park", "read the news", "met at the town hall", "sing on sundays", "like old films"]
KIND = ["happy", "here", "busy", "early"]
INSULTS = ["idiots", "scum", "trash", "morons"]


def sentences(seed=1, size=600):
    """Muslims are named in nearly all insults and in few neutral sentences; christians and people the other way round."""
    rng = random.Random(seed)
    rows = []
    for k in range(size):
        toxic = rng.random() < 0.3
        who = "muslims" if rng.random() < (0.9 if toxic else 0.04) else rng.choice(["christians", "people", "hindus"])
        insult = rng.choice(INSULTS) if rng.random() < 0.5 else f"insult{rng.randrange(10_000)}"  # half of them are rare words
        kind = rng.choice(KIND) if rng.random() < 0.3 else f"kind{rng.randrange(10_000)}"
        text = f"The {who} are {insult if toxic else kind} and {rng.choice(NEUTRAL)}."
        rows.append((k, text, int(toxic)))
    return rows


def labelled(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, toxic int")


def test_swaps_reduce_false_positives_on_neutral_mentions(spark):
    rows = labelled(spark, sentences())
    plain = tx.fit_toxicity(rows, swap_weight=0.0).scorer()
    fair = tx.fit_toxicity(rows).scorer()
    mentions = [f"The {{}} are glad and {n}." for n in NEUTRAL]
    gap = lambda score: np.mean([score(m.format("muslims")) - score(m.format("christians")) for m in mentions])
    wrong = lambda score: sum(score(m.format("muslims")) >= 0.5 for m in mentions)
    assert gap(plain) > 0.3 and abs(gap(fair)) < 0.05
    assert wrong(plain) == len(mentions) and wrong(fair) == 0
    held = [(t, y) for _, t, y in sentences(2, 300) if "insult" not in t]
    assert np.mean([(fair(t) >= 0.5) == y for t, y in held]) >= 0.99
    for who in ("muslims", "christians", "people"):  # insults stay toxic whoever is meant
        assert fair(f"The {who} are idiots and read the news.") > 0.5


def test_swaps_of_sentences():
    groups = (("women", "men", "people"), ("old", "young"))
    assert tx.swaps("old women and men".split(), groups) == ["young men and people".split(), "old people and women".split()]
    assert tx.swaps("no term here".split(), groups) == [] == tx.swaps([], groups)
    assert tx.features_of("we like old men".split(), {"old"}) == {"we", "like", "old", "men", "like old", "old men"}


def test_gradient_is_that_of_the_loss():
    rng = np.random.default_rng(3)
    y, weight = rng.integers(0, 2, 20).astype(float), rng.random(20) + 0.5
    rows = (np.repeat(np.arange(20), 3), rng.integers(0, 8, 60))
    pairs = (np.repeat(np.arange(5), 4), rng.integers(0, 8, 20), rng.choice([-1.0, 1.0], 20))
    theta, held = rng.standard_normal(9), rng.random(8)
    loss, gradient = tx.loss_and_gradient(theta, y, weight, rows, pairs, 2.0, held)
    for k in range(9):
        step = np.zeros(9)
        step[k] = 1e-6
        up, down = (tx.loss_and_gradient(theta + s, y, weight, rows, pairs, 2.0, held)[0] for s in (step, -step))
        assert gradient[k] == pytest.approx((up - down) / 2e-6, rel=1e-4, abs=1e-5)


def test_held_out_accuracy_of_the_query(spark):
    sf = "/root/testdata/sf0.1"
    got = {r.doc_id: r for r in queries.op13_toxicity(spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert len(got) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(k).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for k, r in got.items())
    held = [(got[r.doc_id].predicted, r.toxic) for r in spark.read.parquet(f"{sf}/labels.parquet").collect() if got[r.doc_id].held_out]
    toxic = [p for p, y in held if y]
    assert sum(toxic) >= 0.8 * len(toxic)
    assert sum(p for p, y in held if not y) <= 0.005 * len(held)


def test_held_out_labels_are_not_learned(spark):
    rows = [(k, f"word{k % 7} common", k % 2) for k in range(200)]
    docs = labelled(spark, rows).select("doc_id", "text")
    kept = labelled(spark, rows).select("doc_id", "toxic").where(~tx.held_out())
    assert {r.doc_id for r in kept.collect()} == {k for k in range(200) if zlib.crc32(str(k).encode()) % 5}
    one = tx.fit_labels(docs, kept)
    flipped = labelled(spark, [(k, t, y if zlib.crc32(str(k).encode()) % 5 else 1 - y) for k, t, y in rows])
    two = tx.fit_labels(docs, flipped.select("doc_id", "toxic").where(~tx.held_out()))
    assert one.bias == two.bias and (one.weights == two.weights).all() and len(one.index)


def test_bounded_sample_keeps_probabilities(spark):
    rows = [(k, "bad thing" if k % 10 == 0 else "fine thing" if k % 3 else "some thing", int(k % 10 == 0)) for k in range(3000)]
    docs = labelled(spark, rows)
    model = tx.fit_labels(docs.select("doc_id", "text"), docs.select("doc_id", "toxic"), max_rows=300)
    mean = tx.score_toxicity(docs, model).selectExpr("avg(score)").first()[0]
    assert mean == pytest.approx(0.1, abs=0.03)


def test_odd_rows(spark):
    rows = [(None, None, "a"), (1, "", "b"), (1, "", "b"), (2, "Idiots! " + "word " * 300_000, "c"), (3, "ok", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    labels = spark.createDataFrame([(1, 0), (1, 1), (2, None), (None, 1), (3, 0)], "doc_id long, toxic int")
    model = tx.fit_labels(docs, labels)
    got = tx.score_toxicity(docs, model).collect()
    assert len(got) == 5 and all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if r.doc_id in (None, 1)}) == 1  # null and empty alike
    with pytest.raises(ValueError):
        tx.score_toxicity(docs, model, carry=["score"])
    empty = tx.fit_labels(docs.limit(0), labels.limit(0))
    assert tx.score_toxicity(docs.limit(0), empty).collect() == []
    assert {r.score for r in tx.score_toxicity(docs, empty).collect()} == {0.5}
