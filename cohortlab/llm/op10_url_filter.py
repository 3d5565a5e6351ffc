"""URL filters: a sorted digest array, memory-mapped and probed by binary search.

Rules (verdict, host, path) become one 64-bit xxhash key each, sorted, beside the
stored rule strings. A url is judged by looking up the keys of each of its host's
suffixes joined with each prefix of its path that is as long as some rule's path:
a vectorised binary search over the mapped array per batch, and a comparison of
the full stored string for every hit, so colliding keys never decide. The longest
rule wins; without a rule the array says allow (it holds no such string).

The arrays are cut into segments of at most ``SEGMENT_BYTES``; a task maps every
segment from a file that is unlinked at once, so larger rule sets cost page cache,
not heap. Null urls and urls without ``://`` have empty host and path. Other
columns are ignored, an empty table gives an empty result.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlab.llm.common import ascii_lower, table

SEGMENT_BYTES = 64 << 20
DEFAULT_VERDICT = "allow"
# The rules of the query's contract (verdict, host, path).
RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]


def digest(rule: str) -> int:
    return xxhash.xxh64_intdigest(rule.encode("utf-8", "surrogatepass"), 0)


def build_segments(rules: list[tuple[str, str, str]], segment_bytes: int = SEGMENT_BYTES, key=digest) -> list[dict]:
    """Sorted arrays: keys, ends of the stored strings, string bytes, verdicts."""
    entries = sorted((key(h + p), h, p, v) for v, h, p in rules)
    segments, part, used = [], [], 0
    for e in entries:
        if part and used + len(e[1] + e[2]) + 32 > segment_bytes:
            segments.append(part)
            part, used = [], 0
        part.append(e)
        used += len(e[1] + e[2]) + 32
    segments += [part] if part else []
    out = []
    for part in segments:
        text = [(h + p).encode("utf-8", "surrogatepass") for _, h, p, _ in part]
        out.append({
            "keys": np.array([k for k, *_ in part], np.uint64).tobytes(),
            "ends": np.cumsum([len(t) for t in text]).astype(np.int64).tobytes(),
            "host": np.array([len(h.encode("utf-8", "surrogatepass")) for _, h, _, _ in part], np.int32).tobytes(),
            "text": b"".join(text),
            "allow": np.array([v == "allow" for *_, v in part], np.bool_).tobytes(),
            "depths": sorted({len(p) for _, _, p, _ in part}),
        })
    return out


def mapped(data: bytes, dtype) -> np.ndarray:
    """A read-only map of a private file that no name refers to any more."""
    if not data:
        return np.empty(0, dtype)
    fd, path = tempfile.mkstemp(prefix="url-rules-")
    try:
        with os.fdopen(fd, "wb") as f:
            f.write(data)
        return np.memmap(path, dtype, "r")
    finally:
        os.unlink(path)


class DigestArray:
    def __init__(self, segment: dict, key=digest):
        self.key = key
        self.keys = mapped(segment["keys"], np.uint64)
        self.ends = mapped(segment["ends"], np.int64)
        self.host = mapped(segment["host"], np.int32)
        self.text = mapped(segment["text"], np.uint8)
        self.allow = mapped(segment["allow"], np.bool_)
        self.depths = segment["depths"]

    def probe(self, probes: list[tuple[str, str]]) -> Iterator[tuple[int, int]]:
        """(probe, rule) pairs whose strings are equal, host border included."""
        digests = np.fromiter((self.key(h + p) for h, p in probes), np.uint64, len(probes))
        left = np.searchsorted(self.keys, digests, "left")
        right = np.searchsorted(self.keys, digests, "right")
        for i in np.flatnonzero(right > left):
            host = probes[i][0].encode("utf-8", "surrogatepass")
            want = host + probes[i][1].encode("utf-8", "surrogatepass")
            for r in range(left[i], right[i]):
                begin = self.ends[r - 1] if r else 0
                if self.host[r] == len(host) and self.text[begin:self.ends[r]].tobytes() == want:
                    yield int(i), r


def judge(urls: list[tuple[str, str]], arrays: list[DigestArray], default: str) -> list[tuple[str | None, str]]:
    """The winning rule and verdict of every (host, path)."""
    best: list[tuple] = [(-1, -1, True, None, default)] * len(urls)
    for array in arrays:
        probes, owner = [], []
        for i, (host, path) in enumerate(urls):
            at = 0
            while True:
                for n in array.depths:
                    if n <= len(path):
                        probes.append((host[at:], path[:n]))
                        owner.append(i)
                at = host.find(".", at) + 1
                if not at:
                    break
        for p, r in array.probe(probes):
            host, path = probes[p]
            allow = bool(array.allow[r])
            found = (len(host) + len(path), len(path), allow, host + path, "allow" if allow else "block")
            if found[:3] > best[owner[p]][:3] or best[owner[p]][3] is None:
                best[owner[p]] = found
    return [(b[3], b[4]) for b in best]


def host_and_path(url: str = "url"):
    u = F.coalesce(F.col(url), F.lit(""))
    shape = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    return ascii_lower(F.regexp_extract(u, shape, 1)), F.regexp_extract(u, shape, 2)


def filter_urls(pages: DataFrame, rules: list[tuple[str, str, str]], id_col: str = "page_id", url_col: str = "url",
                default: str = DEFAULT_VERDICT, segment_bytes: int = SEGMENT_BYTES) -> DataFrame:
    spark = pages.sparkSession
    shared = [spark.sparkContext.broadcast(s) for s in build_segments(rules, segment_bytes)]
    host, path = host_and_path(url_col)
    parts = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrays = [DigestArray(b.value) for b in shared]
        for batch in batches:
            urls = list(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True))
            said = judge(urls, arrays, default)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([r for r, _ in said], pa.string()), pa.array([v for _, v in said], pa.string())],
                ["page_id", "host", "path", "rule", "verdict"])

    kind = dict(parts.dtypes)["page_id"]
    return parts.mapInArrow(run, f"page_id {kind}, host string, path string, rule string, verdict string")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(table(spark, sf_dir, "pages"), RULES)


SQL = r"""
WITH u AS (
  SELECT page_id,
         translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path
  FROM pages),
r AS (
  SELECT *, CASE
    WHEN (host = 'www.example.com' OR ends_with(host, '.www.example.com')) AND starts_with(path, '/en/') THEN 'www.example.com/en/'
    WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/en/') THEN 'example.com/en/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/es/') THEN 'net/es/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/fr/') THEN 'net/fr/'
    WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/') THEN 'com/'
  END AS rule FROM u)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('example.com/en/', 'net/es/', 'net/fr/') THEN 'block' ELSE 'allow' END AS verdict
FROM r
"""
