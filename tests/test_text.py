from __future__ import annotations

import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from corpuslab.functions import columns as co
from corpuslab.functions import text as tx

ARTICLES = [
    (1, None, "d", "LONDON (NAME) — The <b>news</b>"),
    (2, "Title - Name ", "  ", "see www.example.org/x now"),
    (3, "ﬁne print", "x", "A https://a.b/c?d\tB  C "),
    (4, "a - NAME - name", "y", "New York (NAME)No dash"),
    (5, "", "", " 　padded  "),
]


@pytest.fixture(scope="module")
def cleaned(spark):
    df = spark.createDataFrame(ARTICLES, "id long, h string, d string, b string")
    rows = df.select(
        "id", tx.normalize_text("b").alias("n"), tx.clean_headline("h", "name").alias("h"),
        tx.clean_body("b", "NAME").alias("b"), tx.baseline_text("h", "d", "b").alias("base"),
        tx.enhanced_text("h", "d", "b", "NAME").alias("enh"), tx.topic_text("h", "d").alias("topic"),
    ).collect()
    return {r["id"]: r for r in rows}


def test_normalization(cleaned):
    assert cleaned[1]["n"] == "LONDON (NAME) — The news"
    assert cleaned[2]["n"] == "see now"
    assert cleaned[3]["n"] == "A B C"
    assert cleaned[5]["n"] == "padded"


def test_publisher_is_removed_once_at_the_ends(cleaned):
    assert cleaned[2]["h"] == "Title"
    assert cleaned[3]["h"] == "fine print"
    assert cleaned[4]["h"] == "a - NAME"
    assert cleaned[1]["b"] == "The news"
    assert cleaned[4]["b"] == "No dash"


def test_combined_texts_skip_empty_parts(cleaned):
    assert cleaned[1]["base"] == "d\n\nLONDON (NAME) — The <b>news</b>"
    assert cleaned[1]["enh"] == "d. The news"
    assert cleaned[2]["topic"] == "Title - Name"
    assert cleaned[5]["base"] == "padded"


def test_stable_characters_really_are_stable():
    pattern = re.compile(
        "[" + tx.NFKC_LATIN + tx.NFKC_OTHER + "]"
    )
    for code in range(0x110000):
        ch = chr(code)
        if pattern.match(ch):
            assert unicodedata.normalize("NFKC", ch) == ch, hex(code)
            assert unicodedata.combining(ch) == 0, hex(code)


def test_nfkc_matches_python(spark):
    texts = ["ﬁ", "Å", "é", "½ x", "plain", "日本", "ｆｕｌｌ", "Straße", "кот", None, "й", "x y"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    for r in df.select("i", "t", tx.nfkc("t").alias("n")).collect():
        assert r["n"] == (None if r["t"] is None else unicodedata.normalize("NFKC", r["t"]))


@pytest.mark.parametrize("text", ["", None, "it's a well-known fact", "--abc-- 'x' a-'b", "über naïve Ωμέγα 日本 x_1", "- ' -", "abc-- -def"])
def test_word_count_matches_the_definition(spark, text):
    df = spark.createDataFrame([(text,)], "t string")
    got = df.select(tx.count_words("t").alias("n"), tx.n_tokens("t").alias("k"), tx.n_chars("t").alias("c")).first()
    assert got["n"] == len(re.findall(r"\b[\w'-]+\b", text or ""))
    assert got["k"] == len((text or "").split())
    assert got["c"] == len(text or "")


def test_truncate_and_template(spark):
    df = spark.createDataFrame([("abc   def",), ("ab",)], "t string")
    assert [r[0] for r in df.select(tx.truncate_text("t", 5)).collect()] == ["abc", "ab"]
    assert [r[0] for r in df.select(tx.truncate_text("t", None)).collect()] == ["abc   def", "ab"]
    with pytest.raises(ValueError):
        tx.truncate_text("t", 0)
    with pytest.raises(ValueError):
        tx.fill_template("no placeholder", TITLE=F.col("t"))
    assert df.select(tx.fill_template("<{A}|{A}>", A=F.col("t"))).collect()[1][0] == "<ab|ab>"


def test_names_and_aliases(spark):
    df = spark.createDataFrame([("  Macro-F1 (Score)! ",), ("Ünï x",)], "t string")
    got = df.select(co.canonical_name("t").alias("c"), co.slug("t").alias("s")).collect()
    assert got[0]["c"] == "macro_f1_score" and got[1]["c"] == "n_x"
    assert got[1]["s"] == "ünï_x"
    with pytest.raises(ValueError):
        co.normalize_columns(df.selectExpr("t AS `F1 macro`", "t AS macro_f1"), {"f1_macro": "macro_f1"})
    quoted = spark.range(1).select(co.display_name(F.lit("it's"), {"it's": "a\\b 'c'"})).first()[0]
    assert quoted == "a\\b 'c'"


def test_rounding_half_even(spark):
    df = spark.createDataFrame([(2.5,), (3.5,)], "x double")
    assert [r[0] for r in df.select(co.rounded("x", 0)).collect()] == [2.0, 4.0]
    assert [r[0] for r in df.select(co.rounded("x", 0, "half_up")).collect()] == [3.0, 4.0]
