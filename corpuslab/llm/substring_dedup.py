"""Substring deduplication by content-defined chunks with a gear rolling hash."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpuslab.llm.common import row_key, slices
from corpuslab.session import materialize

WINDOW = 16  # bytes that decide about a cut: bits 0 to 15 of the gear hash depend on no more
MIN_CHUNK = 12
MAX_CHUNK = 512
MIN_RUN = 64  # bytes of adjacent repeated chunks that make a repeated passage

_GEAR = np.random.default_rng(20240229).integers(1, 1 << 32, 256, dtype=np.uint32)
_GEAR[0] = 0  # zero bytes separate texts in a batch
_WHITE = np.zeros(256, bool)
_WHITE[[9, 10, 11, 12, 13, 32]] = True


def _candidates(data: np.ndarray) -> np.ndarray:
    """Positions after which a chunk may end.

    3 of 16 white-space bytes are.  Where the window holds no white space, as in
    Chinese, Japanese or Thai, one of 32 bytes is, at the end of a character:
    that gives chunks of about the same size.  Near white space one of 512
    other character ends is.
    """
    gear = _GEAR[data]
    white = _WHITE[data]
    near = white.copy()
    for width in (1, 2, 4, 8):
        shifted = gear[:-width] << np.uint32(width)
        gear[width:] += shifted
        near[width:] |= near[:-width].copy()
    cut = white & ((gear >> np.uint32(12) & np.uint32(15)) < 3)
    inner = data & 0xC0 == 0x80
    size = np.ones(len(data), np.uint8)  # bytes of the character that ends here, if one does
    size[1:] += inner[1:]
    size[2:] += inner[2:] & inner[1:-1]
    size[3:] += inner[3:] & inner[2:-1] & inner[1:-2]
    ends = (gear >> np.uint32(7) & np.uint32(511)) < np.where(near, 1, 16 * size)
    ends[:-1] &= ~inner[1:]
    return np.flatnonzero(cut | ends) + 1


def chunk_ends(texts: list[bytes]) -> list[list[int]]:
    """Ends of the chunks of each text.  Chunks have ``MIN_CHUNK`` to ``MAX_CHUNK`` bytes (the last may be shorter)
    and begin and end between characters; an empty text has none.

    A cut depends on the 16 bytes before it, so an insertion changes the chunks
    around it only.
    """
    pad = bytes(WINDOW)
    data = np.frombuffer(pad.join([b"", *texts, b""]), np.uint8)
    cuts = _candidates(data)
    begin = np.cumsum([WINDOW] + [len(t) + WINDOW for t in texts])
    bounds = np.searchsorted(cuts, begin).tolist()
    found = []
    for k, text in enumerate(texts):
        ends, last = [], 0
        size = len(text)
        for cut in (cuts[bounds[k] : bounds[k + 1]] - begin[k]).tolist():
            if cut >= size:
                break
            if cut - last < MIN_CHUNK:
                continue
            while cut - last > MAX_CHUNK:
                last = _boundary(text, last + MAX_CHUNK)
                ends.append(last)
            if cut > last:
                ends.append(cut)
                last = cut
        while size - last > MAX_CHUNK:
            last = _boundary(text, last + MAX_CHUNK)
            ends.append(last)
        if size > last:
            ends.append(size)
        found.append(ends)
    return found


def _boundary(text: bytes, at: int) -> int:
    while at > 0 and text[at] & 0xC0 == 0x80:
        at -= 1
    return at


def _texts(batch: pa.RecordBatch) -> list[bytes]:
    return [t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]


def chunks(docs: DataFrame) -> DataFrame:
    """One row per chunk of ``docs`` (doc_id, row_key, text): doc_id, row_key, digest (64 bits of 96) and ``place``.

    ``place`` is the chunk's number in its text, shifted by 32 bits, with the
    other 32 bits of the digest below.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_128_digest
        for batch in slices(batches, "text"):
            texts = _texts(batch)
            ends = chunk_ends(texts)
            counts = np.fromiter(map(len, ends), np.int64, len(ends))
            parts = b"".join([digest(t[s:e]) for t, cut in zip(texts, ends) for s, e in zip([0, *cut], cut)])
            halves = np.frombuffer(parts, "<i8").reshape(-1, 2)
            numbers = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
            rows = pa.array(np.repeat(np.arange(len(ends)), counts))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(rows), batch.column("row_key").take(rows), pa.array(halves[:, 0]),
                 pa.array(numbers << 32 | halves[:, 1] & 0xFFFFFFFF)],
                names=["doc_id", "row_key", "digest", "place"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"doc_id {kind}, row_key long, digest long, place long")


def repeated_chunks(docs: DataFrame) -> DataFrame:
    """Numbers of the repeated chunks per text: doc_id, row_key, numbers (sorted).

    A chunk is repeated when the same bytes occur before: in a smaller
    identifier (nulls first), or earlier in the same text.  Digests that occur
    once are dropped by a count of narrow rows first; only the rest is compared
    by the whole 96 bits.  Counts and minima combine on the map side and are
    written, so that both sides of the joins are plain exchanges and Spark may
    split a common chunk's rows: a passage in a third of all texts stays spread.
    """
    every = chunks(docs)
    common = materialize(every.groupBy("digest").count().where("count > 1").select("digest"), "chunks-common")
    again = materialize(every.join(common, "digest", "left_semi"), "chunks-again")
    half = F.col("place").bitwiseAND(0xFFFFFFFF).alias("half")
    place = F.struct("doc_id", "row_key", F.shiftright("place", 32).alias("number"))
    rows = again.select("digest", half, place.alias("at"))
    first = materialize(rows.groupBy("digest", "half").agg(F.min("at").alias("first")), "chunks-first")
    repeats = rows.join(first, ["digest", "half"]).where(~F.col("at").eqNullSafe(F.col("first")))
    return repeats.groupBy("at.doc_id", "at.row_key").agg(F.array_sort(F.collect_set("at.number")).alias("numbers"))


def _spans(text: bytes, ends: list[int], numbers: list[int], min_run: int) -> list[tuple[int, int]]:
    spans: list[list[int]] = []
    for k in numbers:
        start, end = (ends[k - 1] if k else 0), ends[k]
        if spans and spans[-1][1] == start:
            spans[-1][1] = end
        else:
            spans.append([start, end])
    return [(s, e) for s, e in spans if e - s >= min_run]


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_run: int = MIN_RUN, carry: bool = False
) -> DataFrame:
    """One row per document without its repeated passages.

    Adjacent repeated chunks form a passage; passages of ``min_run`` bytes or
    more are cut out, the first occurrence stays.  Returns doc_id, text (null
    stays null, empty stays empty), chunks, removed_bytes, spans (start and end
    bytes in the original text), and ``row`` with all columns of ``docs`` when
    ``carry``.  Rows equal in identifier and text count as one text and get
    the same result; a text made of repeats only becomes empty.
    """
    kept = [F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text_col]).alias("row")] if carry else []
    rows = docs.select(
        F.col(id_col).alias("doc_id"), row_key(id_col, text_col).alias("row_key"), F.col(text_col).alias("text"), *kept
    )
    found = repeated_chunks(rows.select("doc_id", "row_key", "text")).withColumnRenamed("doc_id", "found_id")
    joined = rows.join(
        found.withColumnRenamed("row_key", "found_key"),
        (F.col("row_key") == F.col("found_key")) & F.col("doc_id").eqNullSafe(F.col("found_id")), "left",
    ).drop("found_id", "found_key", "row_key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            texts = _texts(batch)
            new, counts, removed, spans = [], [], [], []
            null = batch.column("text").is_null().to_pylist()
            for text, ends, numbers, missing in zip(texts, chunk_ends(texts), batch.column("numbers").to_pylist(), null):
                cuts = _spans(text, ends, numbers or [], min_run)
                pieces, last = [], 0
                for s, e in cuts:
                    pieces.append(text[last:s])
                    last = e
                pieces.append(text[last:])
                new.append(None if missing else b"".join(pieces))
                counts.append(len(ends))
                removed.append(sum(e - s for s, e in cuts))
                spans.append([{"start": s, "end": e} for s, e in cuts])
            columns = {n: batch.column(n) for n in batch.schema.names if n not in ("text", "numbers")}
            columns |= {
                "text": pa.array(new, pa.binary()).cast(pa.string()), "chunks": pa.array(counts, pa.int64()),
                "removed_bytes": pa.array(removed, pa.int64()),
                "spans": pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
            }
            yield pa.RecordBatch.from_pydict(columns)

    span = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
    schema = T.StructType(
        [f for f in joined.schema.fields if f.name not in ("text", "numbers")]
        + [T.StructField("text", T.StringType()), T.StructField("chunks", T.LongType()),
           T.StructField("removed_bytes", T.LongType()), T.StructField("spans", T.ArrayType(span))]
    )
    return joined.mapInArrow(run, schema)


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with repeated passages cut out of the texts, all other columns as they were."""
    done = remove_repeats(docs, id_col, text_col, carry=True)
    return done.select(*[F.col("text").alias(c) if c == text_col else F.col(f"row.`{c}`") for c in docs.columns])
