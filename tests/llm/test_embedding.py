from __future__ import annotations

import math

import numpy as np

from corpuslab.llm import embedding_dedup
from corpuslab.llm.embedding_dedup import near_duplicate_vectors

SCHEMA = "vec_id long, embedding array<float>, label int, cls int, links string, place int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, lab, 1, "x", 2) for i, v, lab in rows], SCHEMA)


def brute(rows, threshold=0.93):
    def ok(v):
        return v is not None and len(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)

    n = len(rows)
    links, root = [0] * n, list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    exact = [None if not ok(v) else np.array(v, np.float32).astype(float) for _, v, _ in rows]
    for i in range(n):
        for j in range(i):
            a, b = exact[i], exact[j]
            if a is None or b is None or len(a) != len(b) or rows[i][2] is None or rows[i][2] != rows[j][2]:
                continue
            if a @ b / (math.sqrt(a @ a) * math.sqrt(b @ b)) >= threshold:
                links[i] += 1
                links[j] += 1
                root[find(i)] = find(j)
    smallest = {}
    for i in range(n):
        if rows[i][0] is not None:
            smallest[find(i)] = min(rows[i][0], smallest.get(find(i), rows[i][0]))
    return sorted(((rows[i][0], links[i], smallest.get(find(i))) for i in range(n)), key=str)


def facts(df):
    return sorted(((r.vec_id, r.n_links, r.component_id) for r in df.collect()), key=str)


def make(n=300, dims=12, seed=0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(20, dims))
    rows = [(k, (centres[k % 20] + rng.normal(size=dims) * 0.25).tolist(), int(k % 3)) for k in range(n)]
    rows += [(1000 + k, rows[k % 5][1], rows[k % 5][2]) for k in range(40)]
    nan, inf = float("nan"), float("inf")
    rows += [
        (2000, None, 1), (2001, [], 1), (2002, [0.0] * dims, 1), (2003, [nan] * dims, 1), (2004, [inf] + [1.0] * (dims - 1), 1),
        (2005, [None] + [1.0] * (dims - 1), 1), (2006, rows[0][1], None), (2007, [1.0, 2.0], 1), (2008, [2.0, 4.0], 1),
        (2009, [1e-30] * dims, 1), (2010, [1e30] * dims, 1), (7, rows[7][1], rows[7][2]), (None, rows[3][1], rows[3][2]),
        (None, [5.0] * 3, 0),
    ]
    return rows


def test_against_brute_force(spark):
    rows = make()
    assert facts(near_duplicate_vectors(frame(spark, rows))) == brute(rows)


def test_many_small_blocks_and_levels(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "FAN_BITS", 1)
    rows = make(400, 5, 3)
    before = embedding_dedup.sequence_blocks
    monkeypatch.setattr(embedding_dedup, "sequence_blocks", lambda grid: before(grid, 16))
    assert facts(near_duplicate_vectors(frame(spark, rows))) == brute(rows)


def test_distant_blocks_are_skipped(spark):
    rng = np.random.default_rng(1)
    centres = np.eye(4)
    rows = [(k, (centres[k % 4] + rng.normal(size=4) * 0.01).tolist(), 0) for k in range(800)]
    classes = frame(spark, rows).selectExpr("vec_id AS cls", "label", "CAST(embedding AS array<double>) AS vec", "1L AS copies")
    eps = math.sqrt(0.14)
    axes = embedding_dedup.principal_dimensions(classes, embedding_dedup.LEADING)
    blocks = embedding_dedup.sequence_blocks(embedding_dedup._grid(classes, axes, eps, embedding_dedup.LEADING), 20)
    summary = blocks.selectExpr("range", "block", "dims", "lo", "hi", "label AS first", "label AS last").cache()
    number = summary.count()
    pairs = embedding_dedup.near_blocks(summary, 8, eps).count()
    assert pairs < 0.5 * number * (number + 1) / 2


def test_empty_table(spark):
    assert near_duplicate_vectors(frame(spark, [])).collect() == []
    assert facts(near_duplicate_vectors(frame(spark, [(1, None, 1)]))) == [(1, 0, 1)]
