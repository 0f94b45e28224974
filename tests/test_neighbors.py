from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corpuslab.operators import neighbors as nb


def brute(ids, vectors, k):
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    sim = np.round(unit @ unit.T, 6)
    out = {}
    for i, a in enumerate(ids):
        order = sorted((j for j in range(len(ids)) if j != i), key=lambda j: (-sim[i, j], ids[j]))
        out[a] = [ids[j] for j in order[:k]]
    return out


def frame(spark, ids, vectors):
    rows = [(int(i), [float(x) for x in v]) for i, v in zip(ids, vectors)]
    return spark.createDataFrame(rows, "id long, v array<double>")


def lists(pairs):
    out = {}
    for r in pairs.collect():
        out.setdefault(r["id"], {})[r["rank"]] = r["neighbor_id"]
    return {i: [m[x] for x in sorted(m)] for i, m in out.items()}


def test_ties_copies_and_small_tables(spark):
    v = np.array([[1, 0], [0, 1], [1, 0], [-1, 0], [0, -1.0]])
    ids = [10, 11, 12, 13, 14]
    assert lists(nb.knn(frame(spark, ids, v), "id", "v", 2)) == brute(ids, v, 2)
    two = nb.knn(frame(spark, [1, 2], v[:2]), "id", "v", 5)
    assert lists(two) == {1: [2], 2: [1]}
    assert nb.knn(frame(spark, [1], v[:1]), "id", "v", 5).count() == 0


@pytest.mark.parametrize("block_rows", [1000, 40, 7])
def test_blocks_equal_brute_force(spark, block_rows):
    rng = np.random.default_rng(0)
    centres = rng.normal(size=(6, 8)) * 4
    v = centres[rng.integers(0, 6, 150)] + rng.normal(size=(150, 8))
    ids = list(rng.permutation(150))
    assert lists(nb.knn(frame(spark, ids, v), "id", "v", 5, block_rows=block_rows)) == brute(ids, v, 5)


def test_a_third_of_the_rows_are_copies(spark):
    rng = np.random.default_rng(1)
    v = rng.normal(size=(90, 4))
    v[::3] = v[0]
    ids = list(range(500, 590))
    assert lists(nb.knn(frame(spark, ids, v), "id", "v", 3, block_rows=20)) == brute(ids, v, 3)


def test_lsh_gives_full_lists_and_good_recall(spark):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(10, 16)) * 3
    v = centres[rng.integers(0, 10, 300)] + rng.normal(size=(300, 16))
    ids = list(range(300))
    want = brute(ids, v, 5)
    got = lists(nb.knn(frame(spark, ids, v), "id", "v", 5, "lsh", tables=12, bits=4, block_rows=64))
    assert all(len(got[i]) == 5 for i in ids)
    assert np.mean([len(set(got[i]) & set(want[i])) / 5 for i in ids]) > 0.9


def test_lonely_buckets_fall_back_to_the_exact_join(spark):
    rng = np.random.default_rng(3)
    v = rng.normal(size=(40, 12))
    ids = list(range(40))
    got = lists(nb.knn(frame(spark, ids, v), "id", "v", 3, "lsh", tables=1, bits=30, block_rows=16))
    assert got == brute(ids, v, 3)


def test_zero_vector_is_an_error(spark):
    with pytest.raises(Exception, match="no usable vector"):
        nb.knn(frame(spark, [1, 2], np.array([[0.0, 0], [1, 0]])), "id", "v", 1).collect()


def test_consistency_tables(spark):
    v = np.array([[1, 0], [1, 0.1], [0, 1], [0.1, 1.0]])
    df = frame(spark, [1, 2, 3, 4], v)
    meta = spark.createDataFrame([(1, "a", "h1"), (2, "a", "h2"), (3, "b", "h3"), (4, "a", "h4")], "id long, label string, headline string")
    pairs = nb.neighbor_pairs(df, meta, "id", "v", ["label"], 1, extra=["headline"])
    res = {r["id"]: r for r in nb.neighbor_results(pairs, ["label"], wide=1).collect()}
    assert res[1]["same_label_ratio"] == 1.0 and res[3]["same_label_ratio"] == 0.0
    assert res[3]["neighbor_1_headline"] == "h4"
    summary = nb.neighbor_summary(nb.neighbor_results(pairs, ["label"]), ["label"]).first()
    assert summary["n"] == 4 and summary["perfect_share"] == 0.5


def test_alignment_rejects_gaps_and_repeats(spark):
    meta = spark.createDataFrame([(1,), (2,)], "id long")
    full = spark.createDataFrame([(1, "a"), (2, "b")], "id long, label string")
    part = spark.createDataFrame([(1, "a")], "id long, label string")
    twice = full.union(part)
    names = {"label": ("original", "other")}
    assert nb.align_labels(meta, full, full, "id", names).count() == 2
    with pytest.raises(Exception, match="no other for id 2"):
        nb.align_labels(meta, full, part, "id", names).collect()
    with pytest.raises(Exception, match="id occurs twice: 1"):
        nb.align_labels(meta, twice, full, "id", names).collect()


def test_tiles_copy_each_vector_at_most_sqrt_of_blocks_times(spark, monkeypatch):
    rng = np.random.default_rng(5)
    v = rng.normal(size=(600, 6))
    seen = []
    tile_rows = nb._tile_rows

    def counted(asked, vectors, pairs):
        rows = tile_rows(asked, vectors, pairs)
        seen.append((vectors.select("block").distinct().count(), rows.groupBy("gid", "role").count().agg({"count": "max"}).first()[0]))
        return rows

    monkeypatch.setattr(nb, "_tile_rows", counted)
    ids = list(range(600))
    assert lists(nb.knn(frame(spark, ids, v), "id", "v", 4, block_rows=15)) == brute(ids, v, 4)
    (blocks, copies), = seen
    assert blocks >= 40 and copies <= np.sqrt(blocks)


def test_tile_sizes():
    assert [nb._tile_sizes(b, 4096) for b in (1, 2, 30, 900, 10**6)] == [2, 3, 7, 31, 64]


def test_candidates_in_pieces_give_the_same_neighbours(spark, monkeypatch):
    random = np.random.default_rng(9)
    rows = [(k, [float(x) for x in random.integers(-2, 3, 3) + 0.5]) for k in range(400)]  # many ties
    df = spark.createDataFrame(rows, ["id", "v"])

    def found():
        return sorted(map(tuple, nb.knn(df, "id", "v", 5, block_rows=8).collect()), key=str)

    whole = found()
    monkeypatch.setattr(nb, "CANDIDATE_ROWS", 5)
    assert found() == whole and len(whole) == 2000


def test_best_candidates_beyond_the_first_and_ties(monkeypatch):
    monkeypatch.setattr(nb, "HEAD", 4)
    random = np.random.default_rng(8)
    vectors = np.round(random.standard_normal((60, 2)), 1) + 0.05  # many nearly equal directions
    table = pa.table({
        "gid": pa.array([*range(60)] * 2, pa.int64()), "vec": pa.array([*vectors.tolist()] * 2),
        "members": pa.array([[g] for g in range(60)] * 2, pa.list_(pa.int64())), "role": pa.array([0] * 60 + [1] * 60),
    })
    schema = pa.schema([("gid", pa.int64()), ("members", pa.list_(pa.int64())), ("score", pa.int64()), ("sim", pa.float64())])
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    scores = np.rint(unit @ unit.T * 1e6).astype(int)
    want = {g: sorted((-scores[g, c], c) for c in range(60) if c != g)[:5] for g in range(60)}
    got = {}
    for r in nb._best_in_block(5, schema)(table).to_pylist():
        got.setdefault(r["gid"], []).append((-r["score"], r["members"][0]))
    assert {g: sorted(v) for g, v in got.items()} == want


def test_rows_of_a_tile_ask_in_several_tasks(spark, monkeypatch):
    random = np.random.default_rng(9)
    rows = [(k, random.standard_normal(6).tolist()) for k in range(400)]
    df = spark.createDataFrame(rows, "id long, v array<double>")
    want = sorted(map(tuple, nb.knn(df, "id", "v", 4).select("id", "rank", "neighbor_id").collect()))
    monkeypatch.setattr(nb, "ASKED_ROWS", 30)
    monkeypatch.setattr(nb, "MAX_TILE_ROWS", 128)
    assert sorted(map(tuple, nb.knn(df, "id", "v", 4, block_rows=300).select("id", "rank", "neighbor_id").collect())) == want


def test_a_vector_travels_once_to_a_bucket_that_fits_one_task(spark):
    rng = np.random.default_rng(12)
    signed = spark.createDataFrame(
        [(i, rng.normal(size=4).tolist(), [i], [i % 2, 0]) for i in range(100)],
        "gid long, vec array<double>, members array<long>, buckets array<long>",
    )
    whole = nb._bucket_rows(signed, 4096).collect()
    assert len(whole) == 200 and {r["role"] for r in whole} == {2}
    cut = nb._bucket_rows(signed, 30)  # 50, 50 and 100 rows: 2, 2 and 4 chunks
    assert cut.count() == 100 * 3 + 100 * 7
    asks = cut.filter("role <> 1").groupBy("tab", "bucket", "gid").agg(F.collect_set("cc").alias("met"), F.count(F.lit(1)).alias("n"))
    assert {(len(r["met"]), r["n"]) for r in asks.collect()} == {(2, 2), (4, 4)}


@pytest.mark.parametrize("bucket_rows, candidate_rows", [(1 << 17, 1 << 15), (64, 1 << 15), (1 << 17, 37), (64, 23)])
def test_buckets_cut_into_chunks_and_parts_give_the_same_lists(spark, monkeypatch, bucket_rows, candidate_rows):
    rng = np.random.default_rng(13)
    v, ids = rng.normal(size=(300, 8)), list(range(300))
    monkeypatch.setattr(nb, "BUCKET_ROWS", bucket_rows)
    monkeypatch.setattr(nb, "CANDIDATE_ROWS", candidate_rows)
    df = frame(spark, ids, v)
    # One plane: both buckets hold about half of the rows, and the lists are the best of the own half.
    planes = np.random.default_rng(42).standard_normal((1, 1, 8))
    side = v @ planes[0, 0] > 0
    got = lists(nb.knn(df, "id", "v", 4, "lsh", tables=1, bits=1, block_rows=32))
    for half in (True, False):
        mine = [i for i in ids if side[i] == half]
        want = brute(mine, v[mine], 4)
        assert {i: got[i] for i in mine} == want
