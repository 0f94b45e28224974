from __future__ import annotations

import zlib

from corpuslab.llm.language_id import Identifier, fit_languages, identify_languages
from corpuslab.llm.queries import op4_language_id

SCHEMA = "doc_id long, text string, lang string, score int, lang_pred string"
ENGLISH = ["the house is on the hill and the river runs below it", "we were there with the others when this was made"]
GERMAN = ["das haus steht auf dem hügel und der fluss fließt darunter", "wir waren mit den anderen dort als dies gemacht wurde"]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, lang, 1, "x") for i, t, lang in rows], SCHEMA)


def model_of(spark):
    rows = [(k, ENGLISH[k % 2], "en") for k in range(20)] + [(50 + k, GERMAN[k % 2], "de") for k in range(10)]
    return fit_languages(frame(spark, [*rows, (90, None, "en"), (91, "no language", None)]))


def test_known_and_unseen_words(spark):
    model = model_of(spark)
    assert model.languages == ["de", "en"]
    one = Identifier(model)
    assert one.predict("the river")[0] == "en" and one.predict("DER FLUSS")[0] == "de"
    assert one.predict("therivers")[0] == "en" and one.predict("flussfließ")[0] == "de"
    assert "therivers" not in model.words and 0.5 <= one.predict("therivers")[1] <= 1


def test_longer_ngrams_come_first(spark):
    model = model_of(spark)
    one = Identifier(model)
    grams = [g for g in model.grams if len(g) == 5 and "<" not in g and ">" not in g]
    word = grams[0]
    first = model.grams["<" + word[:4]] if "<" + word[:4] in model.grams else None
    assert one.backoff(word).shape == (2,)
    assert first is None or first.shape == (2,)


def test_odd_texts(spark):
    rows = [(1, None, "en"), (2, "", "en"), (3, "12 34 ²³ ...", "en"), (4, "the " * 100_000, None), (5, "日本語", "en"), (6, "x" * 100_000, "en"),
            (None, "der fluss", None), (7, "the river", "de"), (7, "the river", "de")]
    got = identify_languages(frame(spark, rows), model_of(spark))
    assert got.columns == ["doc_id", "lang_pred", "score"]
    found = [(r.doc_id, r.lang_pred) for r in got.collect()]
    assert sorted(found, key=str)[:3] and len(found) == len(rows)
    by = dict(found)
    assert by[1] == by[2] == by[3] == "und" and by[4] == "en" and by[None] == "de" and by[5] in ("de", "en")
    assert all(0 <= r.score <= 1 for r in got.collect())
    assert found.count((7, "en")) == 2


def test_empty_tables(spark):
    empty = fit_languages(frame(spark, []))
    assert empty.languages == []
    assert [r.lang_pred for r in identify_languages(frame(spark, [(1, "text", None)]), empty).collect()] == ["und"]
    assert identify_languages(frame(spark, []), model_of(spark)).collect() == []


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.01"
    truth = {r.doc_id: (r.lang, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = op4_language_id(spark, sf_dir).collect()
    assert len(got) == len(truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    held = [r for r in got if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id][0] for r in held) >= 0.98 * len(held)
