from __future__ import annotations

import hashlib

from corpuslab.llm.exact_dedup import drop_exact_copies, exact_dedup

SCHEMA = "doc_id long, text string, kept string, row int, digest string"


def brute(rows):
    groups = {}
    for doc_id, text in rows:
        norm = "".join(c for c in text or "" if c not in " \t\n\x0b\x0c\r")
        groups.setdefault(norm, []).append((-len(text or ""), doc_id is None, doc_id or 0, doc_id))
    out = []
    for norm, members in groups.items():
        best = min(members)[3]
        digest = hashlib.sha256(norm.encode()).hexdigest()
        out += [(m[3], best, len(members), digest) for m in members]
    return sorted(out, key=str)


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1, "d") for i, t in rows], SCHEMA)


def facts(df):
    return sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in df.collect()), key=str)


ROWS = [
    (1, "a b c"), (2, "abc"), (3, " a\tb\nc "), (4, None), (5, ""), (6, " \x0b\x0c\r"), (7, "é 漢"), (8, "é漢 "), (9, "x" * 300_000),
    (10, "x" * 300_000 + " "), (11, " abc"), (None, "abc"), (None, "only null id"), (12, "dup"), (12, "dup"), (13, "ABC"),
]


def test_against_brute_force(spark):
    got = exact_dedup(frame(spark, ROWS))
    assert facts(got) == brute(ROWS)
    kept = [r for r in got.collect() if r.kept]
    assert len({r.text_sha256 for r in kept}) == len(kept) == len({r.text_sha256 for r in got.collect()})


def test_hot_group_is_salted_and_whole(spark):
    rows = [(i, "same  text" if i % 7 == 3 else "same text") for i in range(400)] + [(1000 + i, f"t{i}") for i in range(300)]
    got = exact_dedup(frame(spark, rows).repartition(8))
    assert facts(got) == brute(rows)
    assert sum(r.kept for r in got.collect()) == 301


def test_survivors_keep_all_columns(spark):
    left = drop_exact_copies(frame(spark, ROWS))
    assert left.columns == ["doc_id", "text", "kept", "row", "digest"]
    found = sorted((r.doc_id, len(r.text or "")) for r in left.collect() if r.doc_id is not None)
    assert found == [(3, 7), (6, 4), (7, 3), (10, 300_001), (11, 4), (12, 3), (13, 3)]


def test_empty_table(spark):
    assert exact_dedup(frame(spark, [])).collect() == []
    assert drop_exact_copies(frame(spark, [])).collect() == []
