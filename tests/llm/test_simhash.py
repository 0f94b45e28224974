from __future__ import annotations

import random
import re

import numpy as np
import xxhash

from corpuslab.llm import simhash
from corpuslab.llm.simhash import bucket_keys, fingerprint, golay_keys, golay_tables, simhash_groups

SCHEMA = "doc_id long, text string, fp string, component_id int"


def plain_fingerprint(text):
    words = re.findall("[^\x20\x09-\x0d]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(rows):
    prints = [plain_fingerprint(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 2:
                root[find(i)] = find(j)
    smallest = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            smallest[find(i)] = min(doc_id, smallest.get(find(i), doc_id))
    return sorted(((rows[i][0], f"{prints[i]:016x}", smallest.get(find(i))) for i in range(len(rows))), key=str)


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1) for i, t in rows], SCHEMA)


def facts(df):
    return sorted(((r.doc_id, r.fingerprint, r.component_id) for r in df.collect()), key=str)


def test_golay_keys_share_a_key_at_distance_one():
    tables = golay_tables()
    words = np.random.default_rng(0).integers(0, 1 << 23, 3000)
    keys = golay_keys(words, tables)
    assert ((keys >= 0).sum(1) <= 6).all()
    for bit in range(23):
        other = golay_keys(words ^ (1 << bit), tables)
        assert (other == keys[:, :1]).any(axis=1).all()


def test_buckets_hold_every_pair_at_two_bits():
    tables = golay_tables()
    rng = random.Random(1)
    base = np.array([rng.getrandbits(64) for _ in range(40)], np.uint64)
    for a in range(64):
        for b in range(a + 1):
            other = base ^ np.uint64(1 << a) ^ np.uint64((1 << b) if b != a else 0)
            index = set(zip(*(x.tolist() for x in bucket_keys(other.view(np.int64), False, tables))))
            rows, keys = bucket_keys(base.view(np.int64), True, tables)
            hit = {r for r, k in zip(rows.tolist(), keys.tolist()) if (r, k) in index}
            assert len(hit) == len(base)


def test_fingerprint_is_the_plain_one():
    texts = ["", " \t", "One", "one TWO", "Straße ÄÖ üb er", "a " * 70_000, "x\x0by\x0cz w", "é b c d"]
    assert [fingerprint(t) for t in texts] == [plain_fingerprint(t) for t in texts]
    assert fingerprint(None) == 0


def rows_with_neighbours():
    rng = random.Random(3)
    words = [f"w{k}" for k in range(300)]
    rows = [(None, "null id text here"), (None, ""), (5, None), (6, " \n"), (7, "tiny"), (7, "tiny"), (8, "TINY")]
    for k in range(60):
        text = [rng.choice(words) for _ in range(rng.choice([30, 400]))]
        rows.append((100 + 10 * k, " ".join(text)))
        for n in range(rng.randrange(4)):
            changed = list(text)
            changed[rng.randrange(len(text))] = "changed"
            rows.append((101 + 10 * k + n, " ".join(changed)))
    return rows


def test_against_brute_force(spark):
    rows = rows_with_neighbours()
    assert facts(simhash_groups(frame(spark, rows))) == brute(rows)


def test_full_buckets_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(simhash, "FULL_BUCKET", 1)
    rows = rows_with_neighbours()
    assert facts(simhash_groups(frame(spark, rows))) == brute(rows)


def test_empty_table(spark):
    assert simhash_groups(frame(spark, [])).collect() == []
