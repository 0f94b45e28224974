"""URL filters: a trie over reversed host labels and path segments."""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_RULE_BYTES = 64 << 20  # a broadcast trie above this is refused

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def url_host(url: str) -> Column:
    """Host of a url: after the first ``://``, A-Z lower-cased; empty without one."""
    host = F.regexp_extract(_rest(url), r"^[^/?#]*", 0)
    return F.translate(host, _UPPER, _UPPER.lower())


def url_path(url: str) -> Column:
    """Path of a url: from the host's end up to a query or fragment; empty without ``://``."""
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: str) -> Column:
    at = F.instr(F.col(url), "://")
    return F.when(at > 0, F.col(url).substr(at + 3, F.char_length(url))).otherwise(F.lit(""))


class UrlTrie:
    """Rules by reversed host labels, then by path segments.

    A rule is written ``host/path`` and allows or blocks its host and all
    subdomains, where the url's path starts with ``/path``.  A last segment
    without a slash fits every segment that starts with it.  The deepest host,
    then the longest path wins; of equal rules block wins.
    """

    def __init__(self, allow: list[str] = (), block: list[str] = (), root: dict | None = None) -> None:
        self.root: dict = {} if root is None else root
        for verdict, rules in (("allow", allow), ("block", block)):
            for rule in rules:
                self._add(rule, verdict)

    def _add(self, rule: str, verdict: str) -> None:
        host, _, path = rule.partition("/")
        node = self.root
        for label in reversed(host.lower().split(".")):
            node = node.setdefault("hosts", {}).setdefault(label, {})
        node = node.setdefault("paths", {})
        *whole, last = path.split("/")
        for segment in whole:
            node = node.setdefault("next", {}).setdefault(segment, {})
        # An empty last segment fits everything below; others are found by the lengths that occur.
        node.setdefault("starts", {})[last] = (rule, verdict)
        node["lengths"] = sorted({len(s) for s in node["starts"]}, reverse=True)

    def match(self, host: str, path: str) -> tuple[str, str] | None:
        """The winning (rule, verdict), or None."""
        if not path.startswith("/"):
            return None
        segments = path[1:].split("/")
        node, best = self.root, None
        for label in reversed(host.split(".")):
            node = node.get("hosts", {}).get(label)
            if node is None:
                break
            best = self._path(node.get("paths", {}), segments) or best
        return best

    @staticmethod
    def _path(node: dict, segments: list[str]) -> tuple[str, str] | None:
        best = None
        for k, segment in enumerate(segments):
            for length in node.get("lengths", ()):
                found = node["starts"].get(segment[:length]) if length <= len(segment) else None
                if found:
                    best = found
                    break
            node = node.get("next", {}).get(segment)
            if node is None or k == len(segments) - 1:
                break
        return best


def filter_urls(
    pages: DataFrame, allow: list[str], block: list[str], default: str = "allow", id_col: str = "page_id", url_col: str = "url"
) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict.

    ``rule`` is null and ``verdict`` is ``default`` where no rule fits.  A null
    url, or one without ``://``, has an empty host and path.  The trie is
    broadcast; rules above ``MAX_RULE_BYTES`` are refused.  Each page is judged by
    itself, so repeated rows and hot hosts need no shuffle.
    """
    trie = UrlTrie(allow, block).root
    size = len(pickle.dumps(trie))
    if size > MAX_RULE_BYTES:
        raise ValueError(f"rules take {size} bytes, more than {MAX_RULE_BYTES}; filter in several passes")
    sent = pages.sparkSession.sparkContext.broadcast(trie)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        match = UrlTrie(root=sent.value).match
        for batch in batches:
            found = [match(h, p) for h, p in zip(batch.column("host").to_pylist(), batch.column("path").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([f and f[0] for f in found], pa.string()),
                 pa.array([f[1] if f else default for f in found], pa.string())],
                names=[*batch.schema.names, "rule", "verdict"],
            )

    rows = pages.select(F.col(id_col).alias("page_id"), url_host(url_col).alias("host"), url_path(url_col).alias("path"))
    kind = rows.schema["page_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"page_id {kind}, host string, path string, rule string, verdict string")
