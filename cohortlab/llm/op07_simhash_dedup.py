"""SimHash near-dedup: byte-position inverted index with count filtering.

A fingerprint is 64 bits, one vote of every shingle hash per bit. Two fingerprints
at 4 or fewer differing bits differ in at most 4 of 8 bytes, so they hold at least 4
equal bytes at equal positions: the guaranteed minimum. Posting lists of single
bytes would hold 1/256 of the corpus each and their tally grow with its square;
postings are therefore kept for every set of ``minimum`` positions, so a pair meets
in a list exactly if its tally reaches the minimum. Inside a list the tally of shared
bytes is counted for every pair, pairs that reach it are verified by their differing
bits, and only the edges of a spanning forest leave the task.

Lists arrive sorted and are compared in blocks of ``BLOCK`` fingerprints. A longer
list, as a large group of near copies makes it, leaves its blocks as rows; pairs of
blocks of a list are then compared as tasks of their own, so no list is ever held
whole and no pair is skipped. Components are closed over distinct fingerprints.

Defined results: null and blank texts have fingerprint zero and link like any other;
a null doc_id is kept with its component; equal rows share a component. An empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlab.llm.common import components, keep_rows, stage, table, text_or_empty

WORDS = 4
MAX_BITS = 4
SEED = 42
BLOCK = 4096
GATHER = 200_000


def fingerprint(data: bytes, words: int = WORDS, seed: int = SEED) -> int:
    """Signed 64-bit fingerprint of a UTF-8 text."""
    parts = data.lower().split()  # ASCII letters and ASCII white space, as bytes
    n = len(parts)
    if not n:
        return 0
    joined, digest = b" ".join(parts), xxhash.xxh64_digest
    if n <= words:
        hashes = digest(joined, seed)
    else:
        size = np.fromiter(map(len, parts), np.int64, n)
        end = np.cumsum(size + 1) - 1
        begin = (end - size)[:n - words + 1].tolist()
        hashes = b"".join([digest(joined[a:b], seed) for a, b in zip(begin, end[words - 1:].tolist(), strict=True)])
    rows = np.frombuffer(hashes, np.uint8).reshape(-1, 8)
    votes = np.zeros(64, np.int64)
    for k in range(0, len(rows), 65536):
        votes += np.unpackbits(rows[k:k + 65536], axis=1).sum(0, dtype=np.int32)
    return int.from_bytes(np.packbits(votes * 2 > len(rows)).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, words: int = WORDS, seed: int = SEED) -> DataFrame:
    """``doc_id, text_hash, fp`` for every row."""
    source = docs.select("doc_id", F.xxhash64(text_or_empty("text")).alias("text_hash"),
                         text_or_empty("text").cast("binary").alias("data"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = [fingerprint(x.as_py(), words, seed) for x in b.column(2)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fp, pa.int64())], ["doc_id", "text_hash", "fp"])

    return source.mapInArrow(run, f"doc_id {dict(source.dtypes)['doc_id']}, text_hash long, fp long")


def spanning(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges that join every node to the smallest one of its component."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    i, j = at[:len(a)], at[len(a):]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, label[i], low)
        np.minimum.at(new, label[j], low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    moved = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[moved], nodes[label[moved]]


def verified(a: np.ndarray, b: np.ndarray, minimum: int, max_bits: int) -> np.ndarray:
    """Which pairs tally ``minimum`` shared positional bytes and lie within the radius."""
    x = a ^ b
    keep = (x.view(np.uint8).reshape(-1, 8) == 0).sum(1) >= minimum
    keep &= np.bitwise_count(x) <= max_bits
    return keep


def pairs_of_runs(run: np.ndarray, fp: np.ndarray, minimum: int, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning edges of the links inside runs of equal posting keys."""
    left, right, held = [], [], 0
    at, step = np.flatnonzero(run[:-1] == run[1:]), 1
    while len(at):
        ok = at[verified(fp[at], fp[at + step], minimum, max_bits)]
        if len(ok):
            left.append(fp[ok])
            right.append(fp[ok + step])
            held += len(ok)
            if held > 2_000_000:
                a, b = spanning(np.concatenate(left), np.concatenate(right))
                left, right, held = [a], [b], len(a)
        step += 1
        at = at[at + step < len(run)]
        at = at[run[at] == run[at + step]]
    if not held:
        return np.empty(0, np.uint64), np.empty(0, np.uint64)
    return spanning(np.concatenate(left), np.concatenate(right))


EDGE_SCHEMA = "a long, b long, slot int, posting long, block int, members binary"
EDGE_NAMES = [x.split()[0] for x in EDGE_SCHEMA.split(", ")]
EDGE_TYPES = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.binary()]


def edge_batch(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    n = len(a)
    return pa.RecordBatch.from_arrays(
        [pa.array(a.view(np.int64)), pa.array(b.view(np.int64)), *(pa.nulls(n, t) for t in EDGE_TYPES[2:])], EDGE_NAMES)


def block_batch(slot: int, posting: int, block: int, members: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([x], t) for x, t in zip([None, None, slot, posting, block, members.tobytes()], EDGE_TYPES, strict=True)], EDGE_NAMES)


def compare_postings(minimum: int, max_bits: int, block: int):
    """Task over rows (slot, posting, fp) sorted by all three."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slot, posting, fp = np.empty(0, np.int32), np.empty(0, np.int64), np.empty(0, np.uint64)
        cut = 0  # blocks that the open run has already left

        def flush(slot, posting, fp, cut, last) -> Iterator:
            """Compare all complete runs (all, if last); the open run stays, cut to less than a block."""
            if not len(fp):
                return slot, posting, fp, cut
            new = np.flatnonzero((slot[1:] != slot[:-1]) | (posting[1:] != posting[:-1])) + 1
            begins = np.concatenate([[0], new])
            ends = np.concatenate([new, [len(fp)]])
            number = np.repeat(np.arange(len(begins)), ends - begins)
            done = len(fp) if last else int(begins[-1])
            long = np.flatnonzero((ends - begins > block) | ((np.arange(len(begins)) == 0) & (cut > 0)))
            small = np.ones(len(fp), bool)
            for r in long:
                small[begins[r]:ends[r]] = False
            small[done:] = False
            a, b = pairs_of_runs(number[small], fp[small], minimum, max_bits)
            if len(a):
                yield edge_batch(a, b)
            for r in long:
                open_run = ends[r] > done
                at, of = int(begins[r]), cut if r == 0 else 0
                while at < ends[r] and (not open_run or ends[r] - at > block):
                    part = fp[at:min(at + block, int(ends[r]))]
                    a, b = pairs_of_runs(np.zeros(len(part), np.int8), part, minimum, max_bits)
                    if len(a):
                        yield edge_batch(a, b)
                    yield block_batch(int(slot[at]), int(posting[at]), of, part)
                    at, of = at + len(part), of + 1
                if open_run:
                    return slot[at:], posting[at:], fp[at:], of
            return slot[done:], posting[done:], fp[done:], cut if len(begins) == 1 and not last else 0

        held, count = [], 0
        for batch in batches:
            held.append([batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(2).to_numpy().view(np.uint64)])
            count += batch.num_rows
            if count >= GATHER:
                slot, posting, fp = (np.concatenate([x, *(h[k] for h in held)]) for k, x in enumerate((slot, posting, fp)))
                slot, posting, fp, cut = yield from flush(slot, posting, fp, cut, False)
                held, count = [], 0
        slot, posting, fp = (np.concatenate([x, *(h[k] for h in held)]) for k, x in enumerate((slot, posting, fp)))
        yield from flush(slot, posting, fp, cut, True)

    return run


def compare_blocks(minimum: int, max_bits: int):
    """Task over pairs of blocks (members of one, members of the other)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for one, other in zip(batch.column(0), batch.column(1), strict=True):
                x, y = (np.frombuffer(m.as_py(), np.uint64) for m in (one, other))
                left, right = [], []
                for v in x:
                    ok = y[verified(np.full(len(y), v), y, minimum, max_bits)]
                    left.append(np.full(len(ok), v))
                    right.append(ok)
                a, b = np.concatenate(left), np.concatenate(right)
                if len(a):
                    yield edge_batch(*spanning(a, b))

    return run


def fingerprint_links(fps: DataFrame, max_bits: int = MAX_BITS, block: int = BLOCK) -> DataFrame:
    """Edges ``a, b`` whose closure is that of all pairs of ``fps(fp)`` within ``max_bits``."""
    if not 0 <= max_bits < 8:
        raise ValueError("the bytes of a 64-bit fingerprint guarantee a match for 0 to 7 differing bits")
    minimum = 8 - max_bits
    masks = [sum(0xFF << (8 * p) for p in held) for held in combinations(range(8), minimum)]
    masked = F.array(*[F.col("fp").bitwiseAND(F.lit(m - (1 << 64) if m >> 63 else m)) for m in masks])
    postings = fps.select(F.posexplode(masked).alias("slot", "posting"), "fp")
    sorted_lists = postings.repartition("slot", "posting").sortWithinPartitions("slot", "posting", "fp")
    found = stage(sorted_lists.mapInArrow(compare_postings(minimum, max_bits, block), EDGE_SCHEMA), "simhash-links")
    blocks = found.filter("slot is not null")
    one = blocks.select("slot", "posting", F.col("block").alias("i"), "members")
    other = blocks.select("slot", "posting", F.col("block").alias("j"), F.col("members").alias("others"))
    tiles = one.join(other, ["slot", "posting"]).filter("i < j").select("members", "others")
    far = tiles.mapInArrow(compare_blocks(minimum, max_bits), EDGE_SCHEMA)
    return found.filter("slot is null").select("a", "b").union(far.select("a", "b"))


def near_groups(docs: DataFrame, words: int = WORDS, max_bits: int = MAX_BITS, block: int = BLOCK) -> DataFrame:
    """``doc_id, text_hash, fp, root, component_id`` for every row; ``root`` is the component's
    smallest fingerprint, as ids may be null or stand on unlike texts."""
    rows = stage(fingerprints(docs, words), "simhash-rows")
    fps = stage(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-fps")
    roots = components(fingerprint_links(fps.select("fp"), max_bits, block))
    placed = fps.join(roots, fps["fp"] == roots["node"], "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    names = placed.groupBy("root").agg(F.min("first").alias("component_id"))
    named = stage(placed.join(names, "root").select("fp", "root", "component_id"), "simhash-components")
    return rows.join(named, "fp")


def keep_one(docs: DataFrame, words: int = WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """The rows of ``docs``, all columns: one row of each near-duplicate group."""
    groups = near_groups(docs, words, max_bits)
    named = groups.filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
    kept = named.groupBy("root").agg(F.min(F.struct("doc_id", "text_hash")).alias("k")).select("k.*")
    return keep_rows(docs, kept, once=True)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(table(spark, sf_dir, "documents")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
