"""SimHash near-duplicates, found through fuzzy keys of the binary Golay code."""

from __future__ import annotations

import itertools
import random
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpuslab.llm.common import components, row_key, slices
from corpuslab.session import materialize

SEED = 42
SHINGLE = 3
MAX_BITS = 2
GENERATOR = 0b110001110101  # of the binary Golay code (23, 12, 7)
SEGMENTS = ((0, 22), (22, 21), (43, 21))  # first bit and width
FULL_BUCKET = 64  # larger buckets are linked through balls of radius one, not by pairs

# Near copies by similarity: texts that share this much of their shingles of so many words.
SIMILAR_SHINGLE = 5
SIMILARITY = 0.8
WIDE_WORDS = 16  # 64-bit words of a wide fingerprint, which are cut into Golay words of 23 bits
TABLES = 192  # pairs of Golay words that are keys
WORD_BITS = 20  # bits of 64 that differ at most between candidates; at a similarity of 0.8 about 8 do
PAIRED_BUCKET = 16  # members of larger buckets form families, which are compared whole in tiles
TILE_BYTES = 4 << 20  # shingles of the members of a family that form one tile
TILE_ROWS = 512  # rows of a tile that are multiplied together
TILE_COLUMNS = 4096  # shingles that are multiplied together


def fingerprint(text: str | None, size: int = SHINGLE, seed: int = SEED) -> int:
    """Unsigned 64-bit majority of the hashes of all word shingles; no word gives zero."""
    words = (text or "").encode("utf-8", "replace").lower().split()  # bytes: only A-Z and ASCII white space count
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    if len(words) > size:
        starts, ends = starts[: len(words) - size + 1], ends[size - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest = xxhash.xxh64_digest
    ones = np.zeros(64, np.int64)
    for at in range(0, len(starts), 1 << 16):  # bounds the memory of very long texts
        pairs = zip(starts[at : at + (1 << 16)].tolist(), ends[at : at + (1 << 16)].tolist())
        hashes = np.frombuffer(b"".join([digest(joined[s:e], seed) for s, e in pairs]), np.uint8).reshape(-1, 8)
        ones += np.unpackbits(hashes, axis=1).sum(0, dtype=np.int64)
    return int(np.packbits((2 * ones > len(starts)).astype(np.uint8)).view(">u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """doc_id and the fingerprint as a signed long ``fp`` of each row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            values = [fingerprint(t) for t in batch.column("text").to_pylist()]
            fp = np.array(values, dtype=np.uint64).view(np.int64)
            columns = [batch.column(n) for n in batch.schema.names if n != "text"]
            names = [n for n in batch.schema.names if n != "text"]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(fp)], names=[*names, "fp"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), *(carry or []))
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields if f.name != "text"}
    return rows.mapInArrow(run, ", ".join(f"{n} {k}" for n, k in kinds.items()) + ", fp long")


GolayTables = tuple[list[np.ndarray], np.ndarray, np.ndarray]


def golay_tables() -> GolayTables:
    """Syndromes of each byte, the error of each syndrome, and five codewords around each weight-3 error."""
    def remainder(word: int) -> int:
        for bit in range(22, 10, -1):
            if word >> bit & 1:
                word ^= GENERATOR << (bit - 11)
        return word

    syndrome = [np.array([remainder(b << 8 * k) if b << 8 * k < 1 << 23 else 0 for b in range(256)]) for k in range(3)]
    leader = np.zeros(2048, np.int64)
    places = range(23)
    for a in places:
        leader[remainder(1 << a)] = 1 << a
        for b in range(a):
            two = 1 << a | 1 << b
            leader[remainder(two)] = two
            for c in range(b):
                leader[remainder(two | 1 << c)] = two | 1 << c
    codewords = np.array([m << 11 | remainder(m << 11) for m in range(4096)], np.int64)
    seven = codewords[np.bitwise_count(codewords) == 7]
    near = np.full((2048, 5), -1, np.int64)
    for s, error in enumerate(leader.tolist()):
        if error.bit_count() == 3:
            near[s] = seven[(seven & error) == error]
    return syndrome, leader, near


def golay_keys(words: np.ndarray, tables: GolayTables) -> np.ndarray:
    """Six columns per 23-bit word: the index of the nearest codeword, then of all others within distance four.

    The code is perfect: one codeword lies within three bits.  A word three
    bits off has exactly five more at distance four; other words have none
    (-1).  If two words differ by one bit, the first key of either is among
    the keys of the other.
    """
    syndrome, leader, near = tables
    s = syndrome[0][words & 255] ^ syndrome[1][words >> 8 & 255] ^ syndrome[2][words >> 16]
    nearest = words ^ leader[s]
    more = near[s]
    return np.column_stack([nearest >> 11, np.where(more < 0, -1, (nearest[:, None] ^ more) >> 11)])


def bucket_keys(fp: np.ndarray, probe: bool, tables: GolayTables) -> tuple[np.ndarray, np.ndarray]:
    """Bucket keys of fingerprints, as (position in ``fp``, key).

    With two wrong bits in three segments, some segment is right and the one
    after it (cyclically) has one wrong bit at most.  A key therefore holds a
    segment as it is and a codeword index of the next one: the nearest index
    for a probe, all of them for the index side.
    """
    bits = fp.view(np.uint64)
    parts = [((bits >> np.uint64(at)) & np.uint64((1 << width) - 1)).astype(np.int64) for at, width in SEGMENTS]
    rows, keys = [], []
    for k in range(3):
        codes = golay_keys(parts[(k + 1) % 3], tables)
        codes = codes[:, :1] if probe else codes
        at, column = np.nonzero(codes >= 0)
        rows.append(at)
        keys.append(k << 34 | parts[k][at] << 12 | codes[at, column])
    return np.concatenate(rows), np.concatenate(keys)


def _keyed(prints: DataFrame, probe: bool) -> DataFrame:
    tables = golay_tables()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column("fp").to_numpy()
            rows, keys = bucket_keys(fp, probe, tables)
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(fp[rows])], names=["key", "fp"])

    return prints.select("fp").mapInArrow(run, "key long, fp long")


def near_links(prints: DataFrame) -> DataFrame:
    """Edges (a, b) that connect the distinct ``fp`` values at ``MAX_BITS`` or fewer differing bits.

    Buckets up to ``FULL_BUCKET`` fingerprints are joined and each pair is
    verified.  Members of larger buckets are linked through every point at
    distance one: two fingerprints differ by at most two bits exactly when
    they share such a point, so 65 rows each replace the pairs and no link is
    lost.
    """
    index, probe = _keyed(prints, False), _keyed(prints, True)
    full = materialize(index.groupBy("key").count().where(F.col("count") > FULL_BUCKET).select("key"), "simhash-full")
    pairs = (
        probe.join(full, "key", "left_anti").withColumnRenamed("fp", "a")
        .join(index.withColumnRenamed("fp", "b"), "key")
        .where((F.col("a") != F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= MAX_BITS))
        .select("a", "b")
    )
    crowded = index.join(full, "key", "left_semi").select("fp").distinct()
    flips = F.array(*[F.lit(0).cast("long"), *[F.expr(f"shiftleft(1L, {k})") for k in range(64)]])
    ball = crowded.select("fp", F.explode(flips).alias("flip")).select(
        "fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("point")
    )
    ball = materialize(ball, "simhash-balls")
    centre = ball.groupBy("point").agg(F.min("fp").alias("a"), F.count("*").alias("n")).where("n > 1").drop("n")
    centre = materialize(centre, "simhash-centres")
    stars = ball.join(centre, "point").where(F.col("a") != F.col("fp")).select("a", F.col("fp").alias("b"))
    return pairs.union(stars)


def simhash_components(rows: DataFrame) -> DataFrame:
    """Component of each distinct ``fp`` in ``rows`` (doc_id, fp): fp and component_id.

    component_id is the smallest identifier of the component; null identifiers
    are ignored, and a component without any has null.
    """
    prints = materialize(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-prints")
    groups = components(near_links(prints), "simhash").withColumnRenamed("node", "fp")
    rooted = prints.join(groups, "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    rooted = materialize(rooted, "simhash-roots")
    smallest = materialize(rooted.groupBy("root").agg(F.min("first").alias("component_id")), "simhash-smallest")
    return rooted.join(smallest, "root").select("fp", "component_id")


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id, kept.

    Null and empty texts have fingerprint zero and link like any other.  Rows
    that repeat an identifier get equal results.
    """
    rows = materialize(fingerprints(docs, id_col, text_col), "simhash-fingerprints")
    return rows.join(simhash_components(rows), "fp").select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
        F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"),
    )


def _survivors(docs: DataFrame, rooted: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The row of ``docs`` that comes first of each ``root``."""
    stays = rooted.groupBy("root").agg(F.min("first").alias("first")).select(F.col("first.row_key").alias("stay_key"))
    marked = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), row_key(id_col, text_col).alias("stay_key"))
    found = marked.join(stays.distinct(), "stay_key", "left_semi")
    first = Window.partitionBy("stay_key").orderBy("stay_key")
    return found.withColumn("_copy", F.row_number().over(first)).where("_copy = 1").select("row.*")


def shingle_set(words: list[bytes], size: int, seed: int = SEED) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles; fewer words than ``size`` make one shingle, none makes none."""
    if not words:
        return np.zeros(0, np.uint64)
    count = max(1, len(words) - size + 1)
    digest = xxhash.xxh64_intdigest
    return np.unique(np.fromiter((digest(b" ".join(words[k : k + size]), seed) for k in range(count)), np.uint64, count))


_MIX = np.random.default_rng(20240301).integers(1, 1 << 63, WIDE_WORDS, dtype=np.uint64)


def wide_fingerprint(hashes: np.ndarray) -> np.ndarray:
    """``WIDE_WORDS`` unsigned words: the majority of each bit over the hashes, mixed anew for each word."""
    ones = np.zeros(64 * WIDE_WORDS, np.int64)
    for at in range(0, len(hashes), 255):  # counts of 255 rows fit a byte
        z = hashes[at : at + 255, None] ^ _MIX
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        z ^= z >> np.uint64(31)
        ones += np.unpackbits(z.view(np.uint8), axis=1).sum(0, dtype=np.uint8)
    return np.packbits(2 * ones > len(hashes)).view(np.uint64)


def wide_keys(prints: np.ndarray, tables: GolayTables) -> np.ndarray:
    """``TABLES`` bucket keys for each row of wide fingerprints.

    A key holds the nearest codewords of two Golay words; the pairs of words are
    a fixed draw.  Similar texts differ in few bits everywhere, so some of the
    pairs decode alike.
    """
    bits = np.unpackbits(prints.view(np.uint8), axis=1)
    number = bits.shape[1] // 23
    words = bits[:, : number * 23].reshape(len(bits), number, 23).astype(np.int64) @ (1 << np.arange(23))
    codes = golay_keys(words.reshape(-1), tables)[:, 0].reshape(len(bits), number)
    pairs = np.array(random.Random(SEED).sample(list(itertools.combinations(range(number), 2)), TABLES))
    return np.arange(TABLES) << 24 | codes[:, pairs[:, 0]] << 12 | codes[:, pairs[:, 1]]


def _wide_prints(keys: DataFrame) -> DataFrame:
    """doc_id, row_key, node (hash of the words) and the wide fingerprint ``fp`` of each row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            nodes, prints = [], []
            for text in batch.column("text").to_pylist():
                words = (text or "").encode("utf-8", "replace").lower().split()
                nodes.append(xxhash.xxh3_64_intdigest(b" ".join(words), SEED))
                prints.append(wide_fingerprint(shingle_set(words, SHINGLE)).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("row_key"), pa.array(np.array(nodes, np.uint64).view(np.int64)),
                 pa.array(prints, pa.binary())],
                names=["doc_id", "row_key", "node", "fp"],
            )

    kind = keys.schema["doc_id"].dataType.simpleString()
    return keys.mapInArrow(run, f"doc_id {kind}, row_key long, node long, fp binary")


def _wide_buckets(prints: DataFrame) -> DataFrame:
    """key, node and the first 64 bits of the fingerprint, ``TABLES`` rows for each of ``prints`` (node, fp)."""
    tables = golay_tables()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 250):
                part = batch.slice(at, 250)
                fp = np.frombuffer(b"".join(part.column("fp").to_pylist()), np.uint64).reshape(-1, WIDE_WORDS)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(wide_keys(fp, tables).reshape(-1)), pa.array(np.repeat(part.column("node").to_numpy(), TABLES)),
                     pa.array(np.repeat(fp[:, 0].view(np.int64), TABLES))],
                    names=["key", "node", "word"],
                )

    return prints.select("node", "fp").mapInArrow(run, "key long, node long, word long")


def _near(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def _bucket_pairs(members: DataFrame) -> DataFrame:
    """Near pairs (a, b) across families within the buckets of ``members`` (key, node, word, n, family) of up to
    ``PAIRED_BUCKET`` nodes; those of one family meet there."""
    small = members.where(F.col("n") <= PAIRED_BUCKET).select("key", "node", "word", F.coalesce("family", "node").alias("family"))
    other = small.select("key", F.col("node").alias("b"), F.col("word").alias("b_word"), F.col("family").alias("b_family"))
    pairs = small.join(other, "key").where(
        (F.col("node") < F.col("b")) & (F.col("family") != F.col("b_family")) & (_near("word", "b_word") <= WORD_BITS)
    )
    return pairs.select(F.col("node").alias("a"), "b")


def _bucket_stars(members: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows (a, b, bits) of nodes near the leaders of larger buckets, and (a, b) that tie the nodes of a bucket together.

    A node's rank is the number of nodes it meets in all these buckets: a text
    with many near copies meets more of them than a copy does, so it leads the
    buckets they share.  Each member gives a row, whatever the size.
    """
    large = members.where(F.col("n") > PAIRED_BUCKET)
    ranks = materialize(large.groupBy("node").agg(F.sum("n").alias("rank")), "similar-ranks")
    best = F.max(F.struct("rank", "node", "word"))
    leaders = large.join(ranks, "node").groupBy("key").agg(best.alias("l")).select(
        "key", F.col("l.node").alias("a"), F.col("l.word").alias("a_word")
    )
    ties = large.join(materialize(leaders, "similar-leaders"), "key").where("node <> a").select(
        "a", F.col("node").alias("b"), _near("word", "a_word").alias("bits")
    )
    ties = materialize(ties.distinct(), "similar-ties")
    return ties.where(F.col("bits") <= WORD_BITS), ties.select("a", "b")


def similar_candidates(prints: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Pairs (a, b) of distinct nodes that share a bucket, (a, b, bits) of nodes with leaders, (node, family) of crowded ones.

    Nodes of a bucket of more than ``PAIRED_BUCKET`` nodes belong to one family,
    and so do families that share a node: all nodes of a crowded bucket meet in
    their family.  Pairs join two families and are near in one word of their fingerprints.
    """
    # Each fingerprint becomes TABLES rows, so small tasks bound the memory.
    tasks = 4 * max(int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions")), prints.rdd.getNumPartitions())
    buckets = _wide_buckets(prints.select("node", "fp").repartition(tasks, "node"))
    shared = materialize(buckets.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "similar-shared")
    members = materialize(buckets.join(shared, "key"), "similar-members")
    stars, ties = _bucket_stars(members)
    families = materialize(components(ties, "similar-families").withColumnRenamed("root", "family"), "similar-families")
    return _bucket_pairs(members.join(families, "node", "left")), stars, families


def _shingle_sets(keys: DataFrame, nodes: DataFrame, firsts: DataFrame, size: int) -> DataFrame:
    """node and its sorted distinct shingles as bytes, of the ``nodes`` (node)."""
    wanted = firsts.join(nodes, "node", "left_semi").select("node", F.col("first.row_key").alias("row_key"))
    texts = keys.select("row_key", "text").join(materialize(wanted, "similar-wanted"), "row_key")

    def shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            sets = [
                shingle_set((t or "").encode("utf-8", "replace").lower().split(), size).tobytes()
                for t in batch.column("text").to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(sets, pa.binary())], names=["node", "shingles"])

    sets = materialize(texts.select("node", "text").mapInArrow(shingles, "node long, shingles binary"), "similar-sets")
    return sets.dropDuplicates(["node"])  # rows equal in identifier and text


def _similar_links(keys: DataFrame, pairs: DataFrame, firsts: DataFrame, size: int, similarity: float) -> DataFrame:
    """The ``pairs`` whose texts share ``similarity`` of their shingles, compared whole."""
    ends = materialize(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "similar-nodes")
    sets = _shingle_sets(keys, ends, firsts, size)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            alike = []
            for x, y in zip(batch.column("left").to_pylist(), batch.column("right").to_pylist()):
                one, two = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(one, two, assume_unique=True))
                alike.append(both >= similarity * (len(one) + len(two) - both))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(alike, pa.bool_()))

    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("left"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("right"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "left", "right").mapInArrow(compare, "a long, b long")


def _shared(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Number of elements that each set of ``left`` shares with each of ``right``."""
    out = np.zeros((len(left), len(right)), np.float32)
    flat = [np.concatenate(side) for side in (left, right)]
    rows = [np.repeat(np.arange(len(side)), [len(x) for x in side]) for side in (left, right)]
    both = np.intersect1d(*flat)
    if not len(both):
        return out
    cells = []
    for row, values in zip(rows, flat):
        at = np.minimum(np.searchsorted(both, values), len(both) - 1)
        hit = both[at] == values
        cells.append((row[hit], at[hit]))
    for start in range(0, len(both), TILE_COLUMNS):
        parts = []
        for (row, at), side in zip(cells, (left, right)):
            mine = (at >= start) & (at < start + TILE_COLUMNS)
            part = np.zeros((len(side), min(TILE_COLUMNS, len(both) - start)), np.float32)
            part[row[mine], at[mine] - start] = 1
            parts.append(part)
        out += parts[0] @ parts[1].T
    return out


def tile_links(table: pa.Table, similarity: float) -> pa.Table:
    """Links (a, b) between parts among the rows of two tiles, or of one: a spanning forest of all there are.

    Rows are (node, part, tile, shingles); rows of one part are linked already.
    Pairs of sets are counted as products of matrices, a block of rows at a
    time; blocks whose lengths exclude a link or that lie in one part are skipped.
    """
    nodes, tiles = table.column("node").to_numpy(), table.column("tile").to_numpy()
    parts = np.unique(table.column("part").to_numpy(), return_inverse=True)[1]
    sets = [np.frombuffer(x, np.uint64) for x in table.column("shingles").to_pylist()]
    sizes = np.array([len(x) for x in sets])
    root = list(range(len(sets)))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    def cut(tile: int) -> list[np.ndarray]:
        mine = np.flatnonzero(tiles == tile)
        mine = mine[np.lexsort((parts[mine], sizes[mine]))]
        return [mine[k : k + TILE_ROWS] for k in range(0, len(mine), TILE_ROWS)]

    ends = np.unique(tiles)
    left, right = cut(ends[0]), cut(ends[-1])
    found = []
    for x, a in enumerate(left):
        for y, b in enumerate(right):
            if len(ends) == 1 and y < x:
                continue
            if sizes[a[-1]] < similarity * sizes[b[0]] or sizes[b[-1]] < similarity * sizes[a[0]]:
                continue
            if parts[a[0]] == parts[b[0]] and (parts[a] == parts[a[0]]).all() and (parts[b] == parts[a[0]]).all():
                continue
            both = _shared([sets[k] for k in a], [sets[k] for k in b]).astype(np.float64)
            alike = both >= similarity * (sizes[a][:, None] + sizes[b] - both)
            i, j = np.nonzero(alike & (parts[a][:, None] != parts[b]))
            _, first = np.unique(parts[a[i]] * len(sets) + parts[b[j]], return_index=True)
            for one, two in zip(a[i[first]].tolist(), b[j[first]].tolist()):
                p, q = find(parts[one]), find(parts[two])
                if p != q:
                    root[p] = q
                    found.append((one, two))
    chosen = np.array(found, np.int64).reshape(-1, 2)
    return pa.table({"a": nodes[chosen[:, 0]], "b": nodes[chosen[:, 1]]})


def _family_links(keys: DataFrame, members: DataFrame, firsts: DataFrame, size: int, similarity: float) -> DataFrame:
    """Links (a, b) that join the parts of each family, of ``members`` (node, family, part).

    All texts of a family are compared whole.  A family is dealt over tiles by a
    hash; a task compares two tiles and gives fewer links than it has rows, so
    rows grow with the members times the tiles and never with the pairs.
    """
    open_ones = members.groupBy("family").agg(F.min("part").alias("least"), F.max("part").alias("most")).where("least < most")
    members = materialize(members.join(open_ones.select("family"), "family", "left_semi"), "similar-open")
    sets = materialize(_shingle_sets(keys, members.select("node"), firsts, size).join(members, "node"), "similar-family-sets")
    weights = sets.groupBy("family").agg(F.ceil(F.sum(F.length("shingles")) / TILE_BYTES).cast("int").alias("tiles"))
    dealt = sets.join(materialize(weights, "similar-family-tiles"), "family").withColumn(
        "tiles", F.greatest("tiles", F.lit(1))
    ).withColumn("tile", F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int"))
    paired = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))).select(
        "family", F.least("tile", "other").alias("one"), F.greatest("tile", "other").alias("two"),
        "node", "part", "tile", "shingles",
    )

    def links(table: pa.Table) -> pa.Table:
        return tile_links(table, similarity)

    return paired.groupBy("family", "one", "two").applyInArrow(links, "a long, b long")


def similar_groups(keys: DataFrame, firsts: DataFrame, size: int, similarity: float) -> DataFrame:
    """node and root of every node that is linked to another.

    First every node of a crowded bucket is compared with the nearest of its
    leaders, one pair for each node.  Most of a large group is one component
    after that; families that are not yet one are compared whole, and of the
    pairs of small buckets those across families, since a link within a
    component changes nothing.
    """
    pairs, stars, families = (materialize(x, "similar-pairs") for x in similar_candidates(firsts))
    nearest = stars.groupBy("b").agg(F.min(F.struct("bits", "a")).alias("l")).select(F.col("l.a").alias("a"), "b")
    nodes = firsts.select("node", "first")
    linked = materialize(_similar_links(keys, materialize(nearest, "similar-nearest"), nodes, size, similarity), "similar-linked")
    found = components(linked, "similar-near").select("node", F.col("root").alias("part"))
    members = families.join(found, "node", "left").withColumn("part", F.coalesce("part", "node"))
    within = _family_links(keys, materialize(members, "similar-members"), nodes, size, similarity)
    more = _similar_links(keys, materialize(pairs.distinct(), "similar-rest"), nodes, size, similarity)
    return components(linked.union(within).union(more), "similar")


def keep_one_per_similar(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SIMILAR_SHINGLE, similarity: float = SIMILARITY
) -> DataFrame:
    """One row of ``docs`` per group of similar texts, with all its columns: the smallest identifier, of equal ones the
    smallest text hash.

    Two texts are linked when their sets of shingles of ``size`` words have a
    Jaccard similarity of ``similarity`` or more.  Candidates come from Golay
    buckets of wide SimHash fingerprints, which can miss a pair (the README has
    the measured recall); each is verified, so none is linked that is less
    similar.  Texts of the same words are one node; so null, empty and blank
    texts are one group.  Rows equal in identifier and text are one document.
    Null identifiers come last.  Whole texts are compared, however long.  An
    empty table gives an empty one.
    """
    keys = docs.select(
        F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), row_key(id_col, text_col).alias("row_key")
    )
    rows = materialize(_wide_prints(keys), "similar-prints")
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row_key")
    firsts = materialize(rows.groupBy("node").agg(F.min(order).alias("first"), F.first("fp").alias("fp")), "similar-firsts")
    groups = similar_groups(keys, firsts, size, similarity)
    rooted = firsts.select("node", "first").join(groups, "node", "left").select("first", F.coalesce("root", "node").alias("root"))
    return _survivors(docs, rooted, id_col, text_col)
