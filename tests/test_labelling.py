from __future__ import annotations

import json
import sys

import numpy as np
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from corpuslab.functions.labels import Taxonomy
from corpuslab.operators import labelling as lb
from corpuslab.operators import quality as q
from corpuslab.operators.encoding import can_reuse, encode_incremental
from corpuslab.session import scratch_path
from corpuslab.sources.audit import AuditLog, load_audit, run_labelling

NEWS = Taxonomy.news()
cloudpickle.register_pickle_by_value(sys.modules[__name__])



class Scripted:
    """Answers by what the text asks for; a marker file tells a second request."""

    def __init__(self, marker, fixed=False):
        self.marker, self.fixed = marker, fixed

    def __call__(self, texts):
        if not self.fixed and any("|boom|" in t for t in texts):
            raise RuntimeError("no connection")
        return [self.answer(t) for t in texts]

    def answer(self, prompt):
        step, word = prompt.split("|")[:2]
        if step == "C":
            if word == "flaky" and not self.marker.exists():
                self.marker.touch()
                return "not json"
            return lb.Response(json.dumps({"category": "sport"}), "m1", 7, 3)
        if word == "bad" and not self.fixed:
            return json.dumps({"section": "weather"})
        return json.dumps({"section": "Golf"})


def labeller(marker, fixed=False):
    def label(rows):
        return lb.label_hierarchical(
            rows, lambda: Scripted(marker, fixed), NEWS, "C|{TITLE}|{ARTICLE}{DESCRIPTION}",
            "S|{TITLE}|{ARTICLE}{DESCRIPTION}|{CATEGORY}|{VALID_SECTIONS}", attempts=2, model="m0",
        )
    return label


@pytest.fixture(scope="module")
def train(spark):
    rows = [(i, w, "", "body", "sport", "golf") for i, w in enumerate(["ok", "flaky", "bad", "boom"])]
    return spark.createDataFrame(rows, "id long, headline string, description string, body string, category string, section string")


def test_statuses_attempts_and_resume(spark, train, tmp_path):
    marker = tmp_path / "asked"
    log = AuditLog(spark, scratch_path(spark, "audit"))
    assert log.current().count() == 0 and load_audit(spark, log.path).count() == 0
    first = run_labelling(train, log, labeller(marker))
    got = {r["id"]: r for r in log.current().collect()}
    assert [got[i]["status"] for i in range(4)] == ["success", "success", "section_validation_failed", "request_failed"]
    assert (got[0]["llm_category"], got[0]["llm_section"], got[0]["llm_model"]) == ("sport", "golf", "m1")
    assert got[1]["category_request_attempts"] == 2 and got[1]["category_validation_error"] == ""
    assert got[2]["section_request_attempts"] == 2 and "weather belongs to news" in got[2]["section_validation_error"]
    assert got[3]["category_validation_error"] == "no connection" and got[3]["llm_model"] == "m0"
    assert got[0]["category_prompt_token_count"] == 7 and got[0]["section_prompt_token_count"] is None
    assert {r["id"] for r in first.collect()} == {0, 1}
    assert {r["id"] for r in lb.pending(train, log.current(), "id").collect()} == {2, 3}
    assert len(q.check_audit_status(log.current()).collect()) == 2

    done = run_labelling(train, log, labeller(marker, fixed=True), batches=2)
    assert done.count() == 4 and log.current().filter("status = 'success'").count() == 4
    rows = spark.read.parquet(log.path).count()
    assert rows == 6  # two rows were asked again, two were not
    run_labelling(train, log, labeller(marker, fixed=True))
    assert spark.read.parquet(log.path).count() == 6
    q.assert_ok(q.check_labelled_set(train, done, log.current(), NEWS))
    q.assert_ok(q.check_audit_agrees(train, done, log.current()))
    q.assert_ok(q.check_audit_metadata(log.current()))
    compacted = log.compact(scratch_path(spark, "compact"))
    assert compacted.current().count() == 4 and spark.read.parquet(compacted.path).count() == 4
    assert lb.status_counts(log.current()).first()["n"] == 4
    assert lb.labelling_time(log.current()).first()["total_seconds"] >= 0


def test_a_batch_reads_its_folders_and_three_columns_of_the_audit(spark, tmp_path):
    log = AuditLog(spark, scratch_path(spark, "audit"))
    columns = "id long, headline string, description string, body string, category string, section string"
    every = spark.range(1001).select("id", *[F.lit("ok").alias(c) for c in ("headline", "description", "body", "category", "section")])
    run_labelling(spark.createDataFrame(every.filter("id < 300").collect(), columns), log, labeller(tmp_path / "asked"))
    batch = every.filter("id in (7, 8, 1000)")
    states = log.states(batch)
    plan = states._jdf.queryExecution().executedPlan().toString()
    scan = plan[plan.index("Scan parquet"):]
    assert "ReadSchema: struct<id:bigint,status:string,generated_at_utc:timestamp>" in scan
    assert "ters: [part#" in scan  # the folders are chosen before files are read; long plans shorten the word
    known = {r["id"] for r in states.collect()}
    assert {7, 8} <= known and len(known) < 150
    assert [r["id"] for r in log.pending(batch).collect()] == [1000]
    old = scratch_path(spark, "old-audit")  # a log without folders is read as well
    log.current().write.parquet(old)
    assert [r["id"] for r in AuditLog(spark, old).pending(batch).collect()] == [1000]


class Weighing(Scripted):
    """Tells with every answer how much text it was asked at once."""

    def __call__(self, texts):
        answer = json.dumps({"category": "sport"} if texts[0].startswith("C") else {"section": "Golf"})
        return [lb.Response(answer, "m1", sum(len(t.encode()) for t in texts), len(texts)) for _ in texts]


def test_long_texts_are_asked_in_parts(spark):
    text = F.when(F.col("id") % 7 == 0, "").otherwise(F.repeat(F.lit("é"), 25_000))
    rows = spark.range(0, 150, 1, 1).select("id", *[F.lit("").alias(c) for c in ("headline", "description")], text.alias("body"),
                                            *[F.lit("x").alias(c) for c in ("category", "section")])
    records = lb.label_hierarchical(rows, lambda: Weighing(None), NEWS, "C{TITLE}{ARTICLE}{DESCRIPTION}", "S{TITLE}{ARTICLE}{DESCRIPTION}{CATEGORY}{VALID_SECTIONS}")
    got = records.select("id", "status", "category_prompt_token_count", "category_response_token_count").collect()
    assert sorted(r["id"] for r in got) == list(range(150)) and {r["status"] for r in got} == {"success"}
    assert max(r["category_prompt_token_count"] for r in got) <= lb.ASKED_BYTES + 60_000
    assert max(r["category_response_token_count"] for r in got) > 10  # and not one by one


def test_audit_disagreement_is_found(spark, train, tmp_path):
    log = AuditLog(spark, scratch_path(spark, "audit"))
    done = run_labelling(train, log, labeller(tmp_path / "asked", fixed=True))
    wrong = done.withColumn("section", F.when(F.col("id") == 1, F.lit("tennis")).otherwise(F.col("section")))
    bad = q.check_audit_agrees(train, wrong.filter("id <> 3"), log.current()).collect()
    assert {(r["key"], r["detail"]) for r in bad} == {("1", "label section differs"), ("3", "0 rows in labelled")}


def test_only_new_or_changed_text_is_encoded(spark):
    class Count:
        def __call__(self, texts):
            return np.array([[len(t), 1.0] for t in texts])

    store = scratch_path(spark, "store")
    docs = spark.createDataFrame([(1, "a"), (2, "bb"), (3, None)], "id long, text string").na.fill("")
    assert encode_incremental(docs, "id", "text", Count, "e1", store, batch=2).count() == 3
    assert spark.read.parquet(store).count() == 3
    changed = docs.withColumn("text", F.when(F.col("id") == 2, F.lit("bbbb")).otherwise(F.col("text")))
    out = {r["id"]: r["embedding"] for r in encode_incremental(changed, "id", "text", Count, "e1", store).collect()}
    assert spark.read.parquet(store).count() == 4
    assert out[2] == pytest.approx([4 / 17**0.5, 1 / 17**0.5])
    encode_incremental(changed, "id", "text", Count, "e2", store)
    assert spark.read.parquet(store).count() == 7
    assert can_reuse({"a": 1, "b": 2}, {"a": 1}) and not can_reuse({"a": 1}, {"a": 1, "b": 2})
