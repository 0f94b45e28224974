from __future__ import annotations

import pytest

from corpuslab.operators import evaluate as ev
from corpuslab.operators.contingency import alignment

# Published confusion counts and report of one experiment.
LABELS = ["business", "entertainment", "health", "news", "politics", "sport"]
COUNTS = [
    [16, 0, 1, 0, 4, 0],
    [0, 9, 1, 1, 0, 1],
    [0, 2, 5, 2, 1, 0],
    [12, 27, 63, 127, 89, 4],
    [1, 0, 1, 1, 12, 0],
    [7, 43, 19, 43, 16, 308],
]
REPORT = {
    "business": (0.4444444444444444, 0.7619047619047619, 0.5614035087719298, 21.0),
    "news": (0.7298850574712644, 0.3944099378881988, 0.5120967741935484, 322.0),
    "accuracy": (0.5845588235294118, 0.5845588235294118, 0.5845588235294118, 0.5845588235294118),
    "macro avg": (0.403897063904252, 0.6521227863569307, 0.39411017639268886, 816.0),
    "weighted avg": (0.8293575543308861, 0.5845588235294118, 0.6632529314930249, 816.0),
}
# Published topic by category counts, with their alignment.
TOPICS = [
    [2, 4, 2, 37, 0, 384], [18, 0, 2, 235, 1, 66], [6, 8, 6, 177, 0, 119], [1, 2, 0, 93, 0, 113],
    [2, 0, 0, 15, 2, 334], [27, 2, 2, 144, 0, 173], [6, 7, 2, 98, 21, 172], [4, 5, 16, 189, 37, 73],
    [1, 7, 5, 111, 3, 113], [1, 1, 0, 38, 0, 303], [29, 3, 11, 373, 6, 101], [7, 19, 6, 101, 5, 225],
]


def _confusion(spark, cells):
    return spark.createDataFrame(cells, "actual string, predicted string, n long")


@pytest.fixture(scope="module")
def published(spark):
    cells = [(LABELS[i], LABELS[j], n) for i, row in enumerate(COUNTS) for j, n in enumerate(row) if n]
    return _confusion(spark, cells)


def test_published_report(published):
    got = {r["label"]: r for r in ev.classification_report(published).collect()}
    for label, (p, r, f, s) in REPORT.items():
        row = got[label]
        for mine, theirs in ((row["precision"], p), (row["recall"], r), (row["f1"], f), (row["support"], s)):
            assert mine == pytest.approx(theirs, abs=1e-12)


def test_published_alignment(spark):
    rows = [(t, LABELS[j], n) for t, row in enumerate(TOPICS) for j, n in enumerate(row) if n]
    got = alignment(spark.createDataFrame(rows, "topic int, label string, n long"), "topic", "label", "n").first()
    assert got["nmi"] == pytest.approx(0.11655977136417216, abs=1e-12)
    assert got["ari"] == pytest.approx(0.054544933782964926, abs=1e-12)


def test_alignment_edge_cases(spark):
    same = spark.createDataFrame([("x", "x")] * 3, "a string, b string")
    assert tuple(alignment(same, "a", "b").first()) == (1.0, 1.0)
    renamed = spark.createDataFrame([("x", "2"), ("x", "2"), ("y", "1")], "a string, b string")
    assert alignment(renamed, "a", "b").first()["ari"] == pytest.approx(1.0)
    swapped = alignment(renamed, "b", "a").first()
    assert swapped["nmi"] == pytest.approx(alignment(renamed, "a", "b").first()["nmi"])


def test_class_domains_and_zero_division(spark):
    # b is never predicted, c is absent from the truth.
    c = _confusion(spark, [("a", "a", 3), ("a", "c", 1), ("b", "a", 2)])
    seen = {r["label"]: r for r in ev.per_class_metrics(c, training=["a"]).collect()}
    assert seen["b"]["precision"] == 0 and seen["c"]["recall"] == 0 and seen["c"]["support"] == 0
    assert [seen[x]["seen_during_training"] for x in "abc"] == [True, False, False]
    observed = ev.classification_summary(c).first()
    wide = ev.classification_summary(c, (), "with_training", ["z"]).first()
    fixed = ev.classification_summary(c, (), "fixed", ["a", "b", "c", "d", "e"]).first()
    assert observed["n_classes"] == 3 and wide["n_classes"] == 4 and fixed["n_classes"] == 5
    assert observed["balanced_accuracy"] == pytest.approx(0.375) == wide["balanced_accuracy"]
    assert wide["macro_recall"] == pytest.approx(0.75 / 4) and observed["accuracy"] == pytest.approx(0.5)
    with pytest.raises(ValueError):
        ev.classification_summary(c, (), "fixed")


def test_matrix_totals_and_shares(spark):
    rows = spark.createDataFrame([("a", "a"), ("a", "b"), ("b", "b")], "t string, p string")
    m = ev.confusion_matrix(rows, "t", "p", normalize="true", domain=["a", "b", "c"]).collect()
    assert len(m) == 9 and sum(r["n"] for r in m) == 3
    by_row = {}
    for r in m:
        by_row[r["actual"]] = by_row.get(r["actual"], 0) + r["share"]
    assert by_row == {"a": 1.0, "b": 1.0, "c": 0.0}


def test_several_experiments_at_once(spark):
    rows = [("m1", "a", "a"), ("m1", "b", "a"), ("m2", "a", "a"), ("m2", "b", "b")]
    df = spark.createDataFrame(rows, "model string, t string, p string")
    c = ev.confusion_matrix(df, "t", "p", ["model"])
    got = {r["model"]: r["accuracy"] for r in ev.classification_summary(c, ["model"]).collect()}
    assert got == {"m1": 0.5, "m2": 1.0}
    long = ev.metric_rows(c, ["model"])
    assert long.filter("metric_scope = 'overall'").count() == 2
    assert long.filter("metric_scope = 'class' AND accuracy IS NULL").count() == 4


def test_pair_agreement_joins_on_id(spark):
    a = spark.createDataFrame([(1, "x", "y"), (2, "x", "z")], "id long, c string, s string")
    b = spark.createDataFrame([(2, "x", "q"), (1, "x", "y")], "id long, c string, s string")
    assert tuple(ev.pair_agreement(a, b, "id", "c", "s").first()) == (2, 1.0, 0.5, 0.5)
