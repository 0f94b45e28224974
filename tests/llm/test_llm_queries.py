from __future__ import annotations

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

import corpus_pipeline
from checks.run import duck
from corpuslab.llm import queries
from corpuslab.llm.packing import lower_bound
from corpuslab.llm.simhash import fingerprint, shingle_set

SF = "/root/testdata/sf0.001"


def docs_of(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def test_one_query_of_each_operator():
    numbers = sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES if n.startswith("op"))
    assert numbers == list(range(1, 14)) and "pipeline" in queries.QUERIES


def test_whole_tables_are_returned(spark):
    docs, con = docs_of(spark), duck(SF)
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    for r in queries.op1_sentencepiece(spark, SF).collect():
        assert r.n_ids == len(library.encode(docs[r.doc_id])) and r.round_trip
    prints = {r.doc_id: r.fingerprint for r in queries.op10_simhash_golay(spark, SF).collect()}
    assert prints == {k: f"{fingerprint(t):016x}" for k, t in docs.items()}
    graded = queries.op9_quality_classifier(spark, SF).collect()
    assert {r.doc_id for r in graded} == set(docs)
    labels = {r[0]: r for r in con.sql("SELECT doc_id, quality, toxic FROM labels").fetchall()}
    good = [r.kept for r in graded if r.doc_id in labels and labels[r.doc_id][1:] == (1, 0)]
    assert sum(good) >= 0.97 * len(good)
    cleaned = queries.op7_substring_dedup(spark, SF).collect()
    assert {r.doc_id for r in cleaned} == set(docs)
    for r in cleaned:
        data, last, parts = docs[r.doc_id].encode(), 0, []
        for span in r.spans:
            parts.append(data[last:span.start])
            last = span.end
        assert b"".join([*parts, data[last:]]).decode() == r.text


def brute_pipeline(spark):
    """The stages one after the other on the driver, near copies by all pairs; only the fitted model is shared.

    Golay keys may miss a pair of near copies; in this table they miss none.
    """
    from corpuslab.llm import quality, substring_dedup

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = quality.fit_ratings(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    make, left = quality.Featurizer(), []
    for r in sorted(docs.collect(), key=lambda r: r.doc_id):
        index, value = make(r.text or "")
        if 1 / (1 + pow(2.718281828459045, model.thresholds[-1] - model.weights[index] @ value)) >= quality.MIN_TAIL:
            left.append((r.doc_id, r.text))
    groups = {}
    for doc_id, text in left:
        groups.setdefault("".join(text.split()), []).append((-len(text), doc_id, text))
    left = sorted(min(g)[1:] for g in groups.values())
    sets = [shingle_set((t or "").encode().lower().split(), 5) for _, t in left]
    root = list(range(len(left)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(left)):
        for j in range(i):
            both = len(np.intersect1d(sets[i], sets[j]))
            if both >= 0.8 * (len(sets[i]) + len(sets[j]) - both):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    left = [left[i] for i in range(len(left)) if find(i) == i]
    seen, out = {}, []
    for doc_id, text in left:
        data = text.encode()
        (ends,) = substring_dedup.chunk_ends([data])
        again = []
        for k, (s, e) in enumerate(zip([0, *ends], ends)):
            if seen.setdefault(data[s:e], (doc_id, k)) != (doc_id, k):
                again.append(k)
        for s, e in reversed(substring_dedup._spans(data, ends, again, substring_dedup.MIN_RUN)):
            data = data[:s] + data[e:]
        out.append((doc_id, data.decode()))
    return out


def test_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    left = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        left = stage(spark, left, SF)
        assert left.columns == docs.columns
    rows = left.collect()
    assert sorted((r.doc_id, r.text) for r in rows) == sorted(brute_pipeline(spark))
    assert all(r.n_chars == len(r.text) for r in rows)


def test_pipeline_packs_all_survivors(spark):
    from tokenizers import Tokenizer

    got = corpus_pipeline.run(spark, SF).collect()
    exact = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = {d: len(exact.encode(t, add_special_tokens=False).ids) + 1 for d, t in brute_pipeline(spark)}
    sizes = {}
    for r in got:
        sizes[r.doc_id] = sizes.get(r.doc_id, 0) + r.length
    assert sizes == want
    used = len({r.sequence_id for r in got})
    assert used <= lower_bound(np.array([r.length for r in got])) + 1


@pytest.mark.parametrize("stage", range(5))
def test_stages_take_empty_and_odd_tables(spark, stage):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    empty = spark.createDataFrame([], schema)
    name, function = corpus_pipeline.STAGES[stage]
    assert function(spark, empty, SF).collect() == [], name
    odd = [(None, None, None, None, None), (1, None, "en", "s", 0), (2, "", "en", "s", 0), (2, "", "en", "s", 0), (3, "ok then", None, None, 7)]
    rows = function(spark, spark.createDataFrame(odd, schema), SF).collect()
    assert rows and len(rows) <= len(odd)
