"""WARC archives with revisit records for repeated payloads."""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
from collections.abc import Iterator
from datetime import datetime, timezone

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuslab.llm.common import slices
from corpuslab.session import materialize, scratch_path

ARCHIVE_BYTES = 16 << 20  # payload bytes in one archive file; a longer record has a file of its own
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = b"\r\n\r\n"

_UNSAFE = re.compile(r"[^\x21-\x7e]")
_URN = re.compile(r"<urn:page:(-?\d+|none):[0-9a-f]+>")


def payload_digest(payload: bytes) -> str:
    """Base32 SHA-1, upper case."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page: int | None, unique: str) -> str:
    return f"<urn:page:{'none' if page is None else page}:{unique}>"


def page_of(urn: str | None) -> int | None:
    """The page of a record identifier; None for no identifier and for pages without one."""
    found = _URN.fullmatch(urn or "")
    return None if found is None or found[1] == "none" else int(found[1])


def write_record(kind: str, urn: str, url: str | None, payload: bytes, refers_to: str | None = None, size: int | None = None,
                 digest: str | None = None) -> bytes:
    """A response record, or a revisit record (``refers_to``) that has the HTTP header only.

    Both state the digest and, as HTTP Content-Length, the size of the whole payload.
    """
    size = len(payload) if size is None else size
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http if refers_to else http + payload
    target = "".join(
        c if not _UNSAFE.match(c) else "".join(f"%{b:02X}" for b in c.encode("utf-8", "replace")) for c in url or "urn:none"
    )
    lines = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {urn}", f"WARC-Target-URI: {target}",
        f"WARC-Date: {datetime.now(timezone.utc):%Y-%m-%dT%H:%M:%SZ}",
        f"WARC-Payload-Digest: sha1:{digest or payload_digest(payload)}",
    ]
    if refers_to:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {refers_to}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + END + block + END


def read_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (names in lower case, with ``http-length``) and payload of every record of an archive."""
    at = 0
    while at < len(data):
        stop = data.index(END, at)
        lines = data[at:stop].decode("utf-8").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no record at byte {at}")
        headers = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}
        start = stop + len(END)
        block = data[start : start + int(headers["content-length"])]
        at = start + len(block) + len(END)
        head, _, payload = block.partition(END)
        for line in head.decode("utf-8").split("\r\n"):
            name, _, value = line.partition(":")
            if name.lower() == "content-length":
                headers["http-length"] = value.strip()
        yield headers, payload


def _write_archives(records: DataFrame, path: str) -> None:
    """Write binary records (``record``) as gzipped WARC files of about ``ARCHIVE_BYTES`` of records each.

    Records are joined into the content of one file per row, and Spark's text
    writer commits the files: a task that runs again leaves no second copy.
    All records are UTF-8, and the writer's line end is the last line end of a
    record.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, size = [], 0

        def one() -> pa.RecordBatch:
            content = b"".join(waiting)
            waiting.clear()
            return pa.RecordBatch.from_arrays([pa.array([content[:-2].decode()])], names=["value"])

        for batch in batches:
            for record in batch.column("record"):
                record = record.as_py()
                if waiting and size + len(record) > ARCHIVE_BYTES:
                    yield one()
                    size = 0
                waiting.append(record)
                size += len(record)
        if waiting:
            yield one()

    records.select("record").mapInArrow(run, "value string").write.option("maxRecordsPerFile", 1).option(
        "lineSep", "\r\n"
    ).option("compression", "gzip").text(path)


def write_pages(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> None:
    """Write one response record per row; null html is an empty payload."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        for batch in slices(batches, "html"):
            made = []
            for page, url, html in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html"))):
                urn = record_id(page, f"{part << 40 | number:x}")
                made.append(write_record("response", urn, url, (html or "").encode("utf-8")))
                number += 1
            yield pa.RecordBatch.from_arrays([pa.array(made, pa.binary())], names=["record"])

    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html")
    )
    _write_archives(rows.mapInArrow(run, "record binary"), path)


def archive_files(spark: SparkSession, path: str) -> DataFrame:
    """path and content of every archive.  They are read whole, one at a time; their size is bounded when written."""
    return spark.read.format("binaryFile").load(path).select("path", "content")


def read_archives(spark: SparkSession, path: str, payloads: bool = False) -> DataFrame:
    """One row per record: file, number (in its file, from 0), urn, page_id, url, kind, digest, bytes, refers_to, sha256 (of
    the stored payload), and the payload on request."""
    fields = [
        ("file", pa.string()), ("number", pa.int32()), ("urn", pa.string()), ("page_id", pa.int64()), ("url", pa.string()),
        ("kind", pa.string()), ("digest", pa.string()), ("bytes", pa.int64()), ("refers_to", pa.string()),
        ("sha256", pa.string()), ("payload", pa.binary()),
    ]
    schema = pa.schema(fields if payloads else fields[:-1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, content in zip(batch.column("path"), batch.column("content")):
                rows, size = [], 0
                for number, (headers, payload) in enumerate(read_records(gzip.decompress(content.as_py()))):
                    row = {
                        "file": file.as_py(), "number": number,
                        "urn": headers["warc-record-id"], "page_id": page_of(headers["warc-record-id"]),
                        "url": headers["warc-target-uri"], "kind": headers["warc-type"],
                        "digest": headers["warc-payload-digest"].removeprefix("sha1:"),
                        "bytes": int(headers["http-length"]), "refers_to": headers.get("warc-refers-to"),
                        "sha256": hashlib.sha256(payload).hexdigest(),
                    }
                    if payloads:
                        row["payload"] = payload
                    rows.append(row)
                    size += len(payload) if payloads else 0
                    if size > 4 << 20 or len(rows) >= 5000:
                        yield pa.RecordBatch.from_pylist(rows, schema=schema)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)

    names = (
        "file string, number int, urn string, page_id long, url string, kind string, digest string, bytes long, "
        "refers_to string, sha256 string"
    )
    return archive_files(spark, path).mapInArrow(run, names + (", payload binary" if payloads else ""))


def resolve_revisits(headers: DataFrame, min_bytes: int = 0) -> DataFrame:
    """file, number and original (the urn of the response) of every record that repeats a payload.

    Of records with equal payloads (digest, SHA-256 and size) of ``min_bytes`` or
    more, the smallest page, then the smallest urn is the original; pages
    without identifier come last.  Only headers are shuffled, minima combine on
    the map side, and the join may split a hot payload's rows.
    """
    key = ["digest", "sha256", "bytes"]
    order = F.struct(F.col("page_id").isNull().alias("none"), "page_id", "urn")
    originals = headers.where(F.col("bytes") >= min_bytes).groupBy(*key).agg(
        F.min(order)["urn"].alias("original"), F.count("*").alias("copies")
    )
    originals = materialize(originals.where("copies > 1").drop("copies"), "warc-originals")
    return headers.join(originals, key).where(F.col("original") != F.col("urn")).select("file", "number", "original")


def deduplicate_archives(spark: SparkSession, source: str, target: str, min_bytes: int = 0) -> None:
    """Write ``source`` again to ``target`` with revisit records for repeated payloads, and fresh headers.

    Payloads stay in their archives: the decisions about an archive's records
    (no more of them than it has records) go to the task that rewrites it.
    Decisions are written first, so Spark knows their size and broadcasts them
    only while they are small; beyond, they meet the archives, still gzipped,
    by name.
    """
    headers = read_archives(spark, source).select("file", "number", "urn", "page_id", "digest", "sha256", "bytes")
    decided = resolve_revisits(materialize(headers, "warc-headers"), min_bytes)
    decided = decided.groupBy(F.col("file").alias("path")).agg(F.collect_list(F.struct("number", "original")).alias("revisits"))
    archives = archive_files(spark, source).join(materialize(decided, "warc-decisions"), "path", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content, revisits in zip(batch.column("content"), batch.column("revisits")):
                originals = {r["number"]: r["original"] for r in revisits.as_py() or []}
                made, size = [], 0
                for number, (headers, payload) in enumerate(read_records(gzip.decompress(content.as_py()))):
                    original = originals.get(number)
                    made.append(write_record(
                        "revisit" if original else "response", headers["warc-record-id"], headers["warc-target-uri"], payload,
                        original, int(headers["http-length"]), headers["warc-payload-digest"].removeprefix("sha1:"),
                    ))
                    size += len(made[-1])
                    if size > 4 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(made, pa.binary())], names=["record"])
                        made, size = [], 0
                yield pa.RecordBatch.from_arrays([pa.array(made, pa.binary())], names=["record"])

    _write_archives(archives.mapInArrow(run, "record binary"), target)


def archived_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                   min_bytes: int = 0) -> DataFrame:
    """Write, deduplicate and read back: page_id, payload_bytes, payload_digest, record_type, refers_to.

    Null html counts as empty.  Repeated rows are records of their own, of
    which one is the response.  An empty table gives an empty result.
    """
    spark = pages.sparkSession
    raw, deduplicated = scratch_path(spark, "warc-raw"), scratch_path(spark, "warc")
    write_pages(pages, raw, id_col, url_col, html_col)
    deduplicate_archives(spark, raw, deduplicated, min_bytes)
    page = F.regexp_extract("refers_to", r"^<urn:page:(-?\d+):", 1)
    return read_archives(spark, deduplicated).select(
        "page_id", F.col("bytes").alias("payload_bytes"), F.col("digest").alias("payload_digest"),
        F.col("kind").alias("record_type"), F.when(page != "", page.cast("long")).alias("refers_to"),
    )
