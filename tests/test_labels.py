from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from corpuslab.functions import labels as lab

NEWS = lab.Taxonomy.news()


def test_tree_is_strict():
    assert len(NEWS.categories) == 6 and len(NEWS.sections) == 37
    with pytest.raises(ValueError):
        lab.Taxonomy({"a": ("x",), "b": ("x",)})


def test_normalization_modes(spark):
    df = spark.createDataFrame([(" Sport ",), ("Business Food",), ("intl world",), ("",), (None,)], "t string")
    got = df.select(lab.normalize_label("t").alias("h"), lab.normalize_label("t", "lower").alias("l"),
                    lab.normalize_label("t", "strip").alias("s"), lab.label_key("t").alias("k")).collect()
    assert [r["h"] for r in got] == ["sport", "business-food", "intl-world", "", None]
    assert got[1]["l"] == "business food" and got[1]["s"] == "Business Food"
    assert got[4]["k"] == ""


RESPONSES = [
    ('{"category": " News "}', "news", None),
    ("  ", None, "empty response"),
    (None, None, "empty response"),
    ('{"category": ', None, "invalid json"),
    ('["news"]', None, "not an object"),
    ('"news"', None, "not an object"),
    ("{}", None, "missing fields: category"),
    ('{"category": "news", "b": 1, "a": 2}', None, "unexpected fields: a, b"),
    ('{"Category": "news"}', None, "unexpected fields: Category"),
    ('{"category": 5}', None, "category is not a string"),
    ('{"category": null}', None, "category is not a string"),
    ('{"category": " "}', None, "category is blank"),
    ('{"category": "golf"}', None, "unknown category: golf"),
]


def test_category_responses(spark):
    df = spark.createDataFrame([(i, r[0]) for i, r in enumerate(RESPONSES)], "i int, r string")
    got = {r["i"]: r["p"] for r in df.select("i", lab.parse_category("r", NEWS).alias("p")).collect()}
    for i, (_, label, error) in enumerate(RESPONSES):
        assert (got[i]["label"], got[i]["error"]) == (label, error)


def test_section_and_pair(spark):
    df = spark.createDataFrame(
        [("news", '{"section": "Golf"}'), ("sport", '{"section": "golf"}'), ("nonsense", '{"section": "golf"}'),
         ("news", '{"section": "intl world"}')], "c string, r string")
    got = [r[0] for r in df.select(lab.parse_section("r", "c", NEWS)).collect()]
    assert got[0]["error"] == "golf belongs to sport, not news"
    assert (got[1]["label"], got[1]["error"]) == ("golf", None)
    assert got[2]["error"] == "unknown category: nonsense"
    assert got[3]["error"] == "unknown section: intl-world"  # the blank becomes a hyphen
    pair = spark.createDataFrame([('{"category": "sport", "section": "golf"}',), ('{"category": "sport"}',)], "r string")
    a, b = [r[0] for r in pair.select(lab.parse_pair("r", NEWS)).collect()]
    assert (a["category"], a["section"], a["error"]) == ("sport", "golf", None)
    assert b["error"] == "missing fields: section"
    assert pair.select(lab.is_valid(lab.parse_pair("r", NEWS)).alias("v")).collect()[0]["v"] is True


def test_bullets_and_encoding(spark):
    df = spark.createDataFrame([("politics",), ("sport",)], "c string")
    assert df.select(lab.section_bullets("c", NEWS)).collect()[0][0] == "- politics"
    coded = df.withColumn("i", lab.encode("c", ["sport", "politics"]))
    assert [r["i"] for r in coded.collect()] == [0, 1]
    assert [r[0] for r in coded.select(lab.decode("i", ["sport", "politics"])).collect()] == ["politics", "sport"]
    with pytest.raises(Exception, match="outside the domain"):
        df.select(lab.encode("c", ["sport"])).collect()


def test_tree_from_table(spark):
    edges = NEWS.frame(spark)
    again = lab.Taxonomy.from_frame(edges, "category", "section")
    assert again.parents == dict(NEWS.parents)
    known = lab.parent_of(spark.createDataFrame([("golf",), ("zzz",)], "section string"), "section", edges)
    assert {r["section"]: r["parent"] for r in known.collect()} == {"golf": "sport", "zzz": None}
    assert edges.filter(F.col("category") == "health").count() == 1
