"""WARC archives of web pages with an externally merged capture index.

Writing: payloads are digested; of equal payloads of ``min_bytes`` or more, the one
with the largest page_id becomes a response record and the others revisit records
that name it. A record is one string (headers, blank line, block), and Spark's text
writer ends each with the two line ends that close a WARC record, so archives are
written by any file system Spark knows, gzip-compressed and bounded in records.

Reading: each archive is parsed by its Content-Length headers, payloads are digested
again and compared with the header, and its captures leave as one run sorted by URL
key and timestamp. Index: runs are cut at range borders of the key, and each range
is a k-way merge of run pieces through a loser tree; beyond a number of rows in memory
merged runs are stored in the shared folder, and merged again by the fan-in. Ranges in
order are the globally ordered capture histories.

Defined results: null html is an empty payload; a null url is empty; rows that repeat
a page_id with an equal payload are all responses under one record id; pages without a page_id revisit
like others and are responses if no copy has an id. Empty tables give empty results.
"""

from __future__ import annotations

import hashlib
import itertools
import pickle
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlab.llm.common import Scratch, ascii_lower, shared_dir, stage, stage_path, table

MIN_REVISIT_BYTES = 1000
ARCHIVE_BYTES = 64 << 20
FAN_IN = 256
BLOCK_ROWS = 512
HELD_ROWS = 32_768
EPOCH = 1_577_836_800
CRLF = "\r\n"
# The revisit profile of the WARC 1.1 standard.
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def url_key(url: Column) -> Column:
    """Host labels in reverse order, then the rest: neighbours of a site sort together."""
    u = F.coalesce(url, F.lit(""))
    shape = r"(?s)^(?:.*?://)?([^/?#]*)(.*)$"
    host = F.array_join(F.reverse(F.split(ascii_lower(F.regexp_extract(u, shape, 1)), r"\.")), ",")
    return F.concat(host, F.lit(")"), F.regexp_extract(u, shape, 2))


def one_line(col: Column) -> Column:
    for ch, code in (("%", "%25"), ("\r", "%0D"), ("\n", "%0A")):
        col = F.replace(col, F.lit(ch), F.lit(code))
    return col


def plan_records(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Pages with payload, digest, record type and the page a revisit refers to."""
    payload = F.coalesce(F.col("html"), F.lit(""))
    base = pages.select("page_id", "url", payload.alias("payload")).select(
        "*", F.sha1(F.col("payload").cast("binary")).alias("digest"), F.octet_length("payload").cast("long").alias("n_bytes"))
    firsts = stage(base.filter(F.col("n_bytes") >= min_bytes).groupBy("digest", "n_bytes")
                   .agg(F.max("page_id").alias("first"), F.count(F.lit(1)).alias("copies")).filter("copies > 1")
                   .drop("copies"), "warc-firsts")
    planned = base.join(firsts, ["digest", "n_bytes"], "left")
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return planned.withColumn("record_type", F.when(revisit, "revisit").otherwise("response")).withColumn(
        "refers_to", F.when(revisit, F.col("first"))).drop("first")


def record_id(page_id: Column) -> Column:
    """By page and payload, so that revisits can name it; pages without an id, which none names, get a random one."""
    h = F.md5(F.concat(F.lit("page/"), page_id.cast("string"), F.lit("/"), F.col("digest")))
    h = F.coalesce(h, F.md5(F.uuid()))
    return F.concat(F.lit("<urn:uuid:"), *[x for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
                                           for x in ([F.lit("-")] if a > 1 else []) + [F.substring(h, a, n)]], F.lit(">"))


def record(planned: DataFrame, fetched: Column) -> Column:
    response = F.col("record_type") == "response"
    head = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
                    F.col("n_bytes").cast("string"), F.lit(CRLF * 2))
    block = F.when(response, F.concat(head, F.col("payload"))).otherwise(head)

    def line(name: str, value: Column) -> Column:
        return F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))

    return F.concat(
        F.lit(f"WARC/1.1{CRLF}"), line("WARC-Type", F.col("record_type")), line("WARC-Record-ID", record_id(F.col("page_id"))),
        F.coalesce(line("WARC-Page-ID", F.col("page_id").cast("string")), F.lit("")),
        line("WARC-Target-URI", one_line(F.coalesce(F.col("url"), F.lit("")))),
        line("WARC-Date", F.date_format(fetched, "yyyy-MM-dd'T'HH:mm:ss'Z'")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        F.when(response, F.lit("")).otherwise(F.concat(
            line("WARC-Refers-To", record_id(F.col("refers_to"))), line("WARC-Refers-To-Page-ID", F.col("refers_to").cast("string")),
            line("WARC-Profile", F.lit(REVISIT_PROFILE)))),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", F.octet_length(block).cast("string")), F.lit(CRLF), block)


def write_archives(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES, archive_bytes: int = ARCHIVE_BYTES,
                   fetched: Column | None = None) -> str:
    """Write the archives into the shared folder and return their path."""
    spark = pages.sparkSession
    planned = plan_records(pages, min_bytes)
    if fetched is None:  # pages are numbered in the order of their capture; ids beyond a billion start again
        fetched = F.timestamp_seconds(F.lit(EPOCH) + F.coalesce(F.pmod(F.col("page_id"), F.lit(10 ** 9)), F.lit(0)))
    mean = pages.agg(F.avg(F.octet_length("html"))).first()[0] or 0
    path = stage_path(spark, "warc")
    (planned.select(record(planned, fetched).alias("value")).write
     .option("lineSep", CRLF * 2).option("compression", "gzip")
     .option("maxRecordsPerFile", max(1, int(archive_bytes / (mean + 600)))).text(path))
    return path


def parse_archive(data: bytes) -> Iterator[tuple[dict, bytes, int, int]]:
    """Headers (lower-case names), block, offset and length of every record."""
    if data[:2] == b"\x1f\x8b":
        whole = bytearray()
        while data:  # one or many gzip members
            z = zlib.decompressobj(31)
            whole += z.decompress(data)
            data = z.unused_data
        data = bytes(whole)
    at = 0
    while at < len(data):
        if data[at:at + 5] != b"WARC/":
            raise ValueError(f"no WARC record at byte {at}")
        end = data.index(b"\r\n\r\n", at)
        head = {}
        for row in data[at:end].decode("utf-8", "surrogatepass").split(CRLF)[1:]:
            name, _, value = row.partition(":")
            head[name.strip().lower()] = value.removeprefix(" ")
        size = int(head["content-length"])
        block = data[end + 4:end + 4 + size]
        if len(block) != size or data[end + 4 + size:end + 8 + size] != b"\r\n\r\n":
            raise ValueError(f"record at byte {at} is cut off")
        yield head, block, at, end + 8 + size - at
        at = end + 8 + size


RUN_SCHEMA = ("run string, url_uri string, captured_at string, page_id long, record_type string, payload_digest string, "
              "payload_bytes long, refers_to long, offset long, length long")


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """Captures of every archive, one sorted run an archive; digests are verified."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("path", "content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, data in zip(batch.column(0), batch.column(1), strict=True):
                rows = []
                for head, block, at, size in parse_archive(data.as_py()):
                    digest = head["warc-payload-digest"].removeprefix("sha1:")
                    body = block.partition(b"\r\n\r\n")[2]
                    response = head["warc-type"] == "response"
                    if response and hashlib.sha1(body).hexdigest() != digest:
                        raise ValueError(f"payload at byte {at} of {name} differs from its digest")
                    number = [int(x) if (x := head.get(k)) is not None else None for k in ("warc-page-id", "warc-refers-to-page-id")]
                    rows.append((name.as_py(), head["warc-target-uri"], head["warc-date"], number[0], head["warc-type"], digest,
                                 len(body) if response else None, number[1], at, size))
                for k in range(0, len(rows), 4096):
                    cols = list(zip(*rows[k:k + 4096], strict=True))
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, RUN_TYPES, strict=True)], RUN_NAMES)

    captures = files.mapInArrow(run, RUN_SCHEMA)
    plain = F.replace(F.replace(F.replace(F.col("url_uri"), F.lit("%0A"), F.lit("\n")), F.lit("%0D"), F.lit("\r")), F.lit("%25"), F.lit("%"))
    return captures.withColumn("url", plain).withColumn("urlkey", url_key(F.col("url"))).drop("url_uri")


RUN_NAMES = [x.split()[0] for x in RUN_SCHEMA.split(", ")]
RUN_TYPES = [pa.string() if x.split()[1] == "string" else pa.int64() for x in RUN_SCHEMA.split(", ")]


def loser_tree(runs: list[Iterable[tuple]]) -> Iterator[tuple]:
    """Merge sorted runs: inner nodes keep the loser of their match, so each row
    taken costs one match a level against the stored losers."""
    k = len(runs)
    its = [iter(r) for r in runs]
    head = [next(i, None) for i in its]

    def beats(a: int, b: int) -> bool:
        if head[a] is None or head[b] is None:
            return head[b] is None and (head[a] is not None or a < b)
        return (head[a], a) < (head[b], b)

    loser = [-1] * k
    champion = 0
    for r in range(k):  # play the runs in one by one
        winner, node = r, (r + k) // 2
        while node > 0:
            if loser[node] == -1:
                loser[node] = winner
                winner = -1
                break
            if beats(loser[node], winner):
                loser[node], winner = winner, loser[node]
            node //= 2
        if winner != -1:
            champion = winner
    while k and head[champion] is not None:
        yield head[champion]
        head[champion] = next(its[champion], None)
        winner, node = champion, (champion + k) // 2
        while node > 0:
            if beats(loser[node], winner):
                loser[node], winner = winner, loser[node]
            node //= 2
        champion = winner


def blocks_of(rows: Iterable[tuple]) -> Iterator[bytes]:
    """Rows as pickled blocks, each behind its size in eight bytes."""
    rows = iter(rows)
    while block := list(itertools.islice(rows, BLOCK_ROWS)):
        data = pickle.dumps(block, 5)
        yield len(data).to_bytes(8, "little") + data


def rows_back(scratch: Scratch, path: str) -> Iterator[tuple]:
    """The rows of a stored run; its file is open from the first row to the last only."""
    with scratch.fs.open_input_stream(path) as f:
        while size := f.read(8):
            yield from pickle.loads(f.read(int.from_bytes(size, "little")))
    scratch.fs.delete_file(path)


def merge_runs(pieces: Iterable[list[tuple]], scratch: Scratch, fan_in: int = FAN_IN, held_rows: int = HELD_ROWS) -> Iterator[tuple]:
    """Rows of the sorted ``pieces`` in order. Pieces are merged as they come: beyond
    ``held_rows`` rows those in memory become one stored run, and ``fan_in`` stored runs of a
    level one run of the next, so no more than ``fan_in`` files are ever open."""
    held, rows = [], 0
    levels: list[list[str]] = []

    def store(run: Iterable[tuple], level: int) -> None:
        if level == len(levels):
            levels.append([])
        levels[level].append(scratch.write(blocks_of(run)))
        if len(levels[level]) == fan_in:
            full, levels[level] = levels[level], []
            store(loser_tree([rows_back(scratch, p) for p in full]), level + 1)

    for piece in pieces:
        held.append(piece)
        rows += len(piece)
        if rows > held_rows:
            store(loser_tree(held), 0)
            held, rows = [], 0
    stored = [p for level in levels for p in level]  # the small ones first
    while len(stored) > fan_in:
        first, stored = stored[:fan_in], stored[fan_in:]
        stored.append(scratch.write(blocks_of(loser_tree([rows_back(scratch, p) for p in first]))))
    yield from loser_tree([*held, *[rows_back(scratch, p) for p in stored]])


def merged_index(runs: DataFrame, fan_in: int = FAN_IN, held_rows: int = HELD_ROWS) -> DataFrame:
    """Globally ordered captures: ``part`` and ``place`` order the whole index."""
    runs = stage(runs, "warc-runs")
    root = f"{shared_dir(runs.sparkSession).rstrip('/')}/stage/warc-merges"
    order = ["urlkey", "captured_at", "page_id", "run", "offset"]
    rest = [c for c in runs.columns if c not in order]
    kinds = dict(runs.dtypes)
    cut = (runs.select(*order, *rest).repartitionByRange(*order[:3])
           .sortWithinPartitions("run", *[F.col(c).asc_nulls_first() for c in order[:3]], "offset"))
    names = [*order, *rest]
    types = [pa.string() if kinds[c] == "string" else pa.int64() for c in names]

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for b in batches:
            cols = [c.to_pylist() for c in b.columns]
            for row in zip(*cols, strict=True):
                key = tuple((x is not None, x) if x is not None else (False,) for x in row[:5])
                yield key, row

    def pieces(rows: Iterator[tuple]) -> Iterator[list[tuple]]:
        piece = []
        for r in rows:
            if piece and (r[1][3] != piece[0][1][3] or len(piece) == BLOCK_ROWS):
                yield piece
                piece = []
            piece.append(r)
        if piece:
            yield piece

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, place, scratch = [], 0, Scratch(root)
        for _, row in merge_runs(pieces(rows_of(batches)), scratch, fan_in, held_rows):
            block.append((*row, place))
            place += 1
            if len(block) == 4096:
                yield batch_of(block)
                block = []
        scratch.close()
        if block:
            yield batch_of(block)

    def batch_of(block: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*block, strict=True), [*types, pa.int64()], strict=True)], [*names, "place"])

    out = cut.mapInArrow(run, ", ".join(f"{c} {kinds[c]}" for c in names) + ", place long")
    return stage(out.withColumn("part", F.spark_partition_id()), "warc-index")


def archive(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES, archive_bytes: int = ARCHIVE_BYTES,
            fetched: Column | None = None, fan_in: int = FAN_IN) -> DataFrame:
    """Write, read back, index; one row per page from the merged capture index, with
    the payload size of a revisit taken from the response it names."""
    path = write_archives(pages, min_bytes, archive_bytes, fetched)
    index = merged_index(read_runs(pages.sparkSession, path), fan_in)
    named = index.filter("record_type = 'response'").select(
        F.col("page_id").alias("refers_to"), "payload_digest", F.col("payload_bytes").alias("_bytes"))
    wanted = index.filter("record_type = 'revisit'").select("refers_to", "payload_digest").distinct()
    sizes = wanted.join(named, ["refers_to", "payload_digest"]).distinct()
    return index.join(sizes, ["refers_to", "payload_digest"], "left").withColumn(
        "payload_bytes", F.coalesce("payload_bytes", "_bytes")).drop("_bytes")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive(table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


SQL = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS d FROM pages),
w AS (SELECT *, max(page_id) OVER (PARTITION BY d, n) AS first FROM p)
SELECT page_id, n AS payload_bytes, d AS payload_digest,
       CASE WHEN n >= 1000 AND coalesce(page_id <> first, first IS NOT NULL) THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 1000 AND coalesce(page_id <> first, first IS NOT NULL) THEN first END AS refers_to
FROM w
"""
