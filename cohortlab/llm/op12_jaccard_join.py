"""N-gram Jaccard self-join by set-relation skipping.

Two sets of word shingles link at ``100 * shared >= percent * union``. Equal sets are one
set from the start. The rest goes in five steps.

1. Shingles that one set alone has can link nothing. All (shingle, set) pairs go, packed
   by ranges of shingles, to tasks that answer each set with its shared shingles and their
   numbers of sets. Shingles in about a thousandth of the texts and more are found first,
   from counts in chunks, and are answered where they stand, without the shuffle.
2. Ordered by rarity, a set that can link must meet its partner within its first
   ``size - least overlap + 1`` shingles; as the unshared ones come first, most sets leave
   here. The others keep their shared shingles: what two sets have in common is among them.
3. Hubs: in every index list and size class the set with the largest share of shared
   shingles answers for all: each set of the list is compared with it, by a join.
4. The index lists are cut into blocks by size and position. A pair of blocks is skipped
   if its sets are one class by now, if their sizes are too far apart, or if the positions
   leave too few shingles; what is left gives the pairs of unlike classes.
5. Answers by relation: a set knows its closest hub and the shingles by which it differs
   from it. Two sets of one hub are compared through these differences alone, from the
   hub's overlaps, or without them where the overlaps bound the answer; other pairs are
   compared whole.

Links within a class add nothing to the components and are not looked for.

Defined results: null, empty and blank texts have an empty set (0) and are components of
their own; fewer words than a shingle make one shingle; repeated rows each get a row; rows
with null ids link, and a component's id is the smallest id it has (null without any); an
empty table gives no rows; other columns are not read. Shingles and sets are told apart by
64-bit hashes, and counts are of these.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlab.llm.common import components, stage, table, text_or_empty

WORDS, PERCENT = 3, 90
BUCKET_PAIRS = 1 << 21  # (shingle, set) pairs that one task sorts at a time
COMMON_ONE_IN = 1000  # a shingle in this part of the texts or more is common
COMMON_COUNT = (1 << 32) - 1  # stands for a common shingle's number of sets
ANSWER_PAIRS = 1 << 19  # pairs that a task gathers over its buckets before it packs them by set
SET_BUCKETS = 1 << 40  # of common shingles, by set
CHUNK_BYTES = 1 << 24  # of texts that a task holds as sets at a time, one text at least
BLOCK = 256  # entries of an index list in a block
MIX = [np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)]
MEMBER_SCHEMA = "doc_id long, sid long, size long, shingle long, times long"
PACK_SCHEMA = "bucket long, n long, shingles binary, owners binary, sids binary, sizes binary"
SHARED_SCHEMA = "part long, sids binary, sizes binary, lengths binary, shingles binary, counts binary"
KEPT_SCHEMA = "sid long, size long, shared binary, prefix array<long>, first long"
ANSWER_SCHEMA = "a long, b long, hub_shared long, shared long, size long, link boolean, less binary, plus binary"
BLOCK_SCHEMA = ("shingle long, block long, sids binary, sizes binary, places binary, classes binary, "
                "size_low long, size_high long, place_low long, class_low long, class_high long")


def shingle_hashes(data: bytes, words: int) -> np.ndarray:
    """Sorted distinct shingle hashes of a text; ASCII case and white space as stated."""
    parts = data.lower().split()  # bytes: A-Z and [\x20\x09-\x0D] only
    if not parts:
        return np.empty(0, np.uint64)
    one = np.fromiter(map(xxhash.xxh3_64_intdigest, parts), np.uint64, len(parts))
    width = min(words, len(one))
    x = np.full(len(one) - width + 1, width, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(width):
            x = (x ^ one[k:k + len(x)]) * MIX[k % 3]
            x ^= x >> np.uint64(29)
    return np.unique(x)


def set_id(hashes: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(hashes.tobytes()) - (1 << 63)


def chunks(batches: Iterator[pa.RecordBatch], text: int) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with up to CHUNK_BYTES in the text column."""
    for b in batches:
        ends = np.cumsum(pc.binary_length(b.column(text)).to_numpy().astype(np.int64))
        at = 0
        while at < b.num_rows:
            begun = ends[at - 1] if at else 0
            end = max(at + 1, int(np.searchsorted(ends, begun + CHUNK_BYTES, "right")))
            yield b.slice(at, end - at)
            at = end


def member_rows(words: int, one_in: int):
    """Task over (doc_id, data): a row per document, and each chunk's common shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches, 1):
            sets = [shingle_hashes(d.as_py(), words) for d in b.column(1)]
            n = len(sets)
            sids = pa.array([set_id(s) if len(s) else None for s in sets], pa.int64())
            sizes = pa.array([len(s) for s in sets], pa.int64())
            none = pa.nulls(n, pa.int64())
            names = [c.split()[0] for c in MEMBER_SCHEMA.split(", ")]
            yield pa.RecordBatch.from_arrays([b.column(0), sids, sizes, none, none], names)
            if n:
                value, times = np.unique(np.concatenate(sets), return_counts=True)
                often = times >= max(2, n / (2 * one_in))
                value, times = value[often].view(np.int64), times[often]
                none = pa.nulls(len(value), pa.int64())
                yield pa.RecordBatch.from_arrays([none, none, none, pa.array(value), pa.array(times)], names)

    return run


def pack(words: int, buckets: int, common: np.ndarray):
    """Task over data: pairs packed by bucket; a set's common shingles stand alone, in a bucket
    below 0 that its id gives. Bytes of equal weight stand together, as the shingles of a
    bucket are in order and agree in the highest ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches, 0):
            sets = {}
            for d in b.column(0):
                s = shingle_hashes(d.as_py(), words)
                if len(s):
                    sets.setdefault(set_id(s), s)
            if not sets:
                continue
            sids = np.fromiter(sets, np.int64, len(sets))
            sizes = np.array([len(s) for s in sets.values()], np.int64)
            value, owner = np.concatenate(list(sets.values())), np.repeat(np.arange(len(sids), dtype=np.uint32), sizes)
            sets.clear()
            rows = []
            if len(common):
                hit = common[np.minimum(np.searchsorted(common, value), len(common) - 1)] == value
                held, of = value[hit], owner[hit]
                for k, at, end in zip(*runs(of), strict=True):
                    rows.append((-1 - int(sids[k]) % SET_BUCKETS, end - at, held[at:end].tobytes(), b"", sids[k:k + 1].tobytes(), sizes[k:k + 1].tobytes()))
                value, owner = value[~hit], owner[~hit]
            order = np.argsort(value, kind="stable")
            value, owner = value[order], owner[order]
            for k, at, end in zip(*runs(scaled(value, buckets)), strict=True):
                here, of = np.unique(owner[at:end], return_inverse=True)
                rows.append((k, end - at, value[at:end].view(np.uint8).reshape(-1, 8).T.tobytes(),
                             of.astype(np.uint32).view(np.uint8).reshape(-1, 4).T.tobytes(), sids[here].tobytes(), sizes[here].tobytes()))
            yield as_batch(rows, PACK_SCHEMA)

    return run


KINDS = {"long": pa.int64(), "binary": pa.binary(), "boolean": pa.bool_(), "array<long>": pa.list_(pa.int64())}


def as_batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = [c.split() for c in schema.split(", ")]
    columns = zip(*rows, strict=True) if rows else [[]] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, KINDS[k]) for c, (_, k) in zip(columns, fields, strict=True)], [n for n, _ in fields])


def runs(values: np.ndarray) -> tuple[list, list, list]:
    """Value, begin and end of each run of equal neighbours."""
    at = np.flatnonzero(np.append(True, values[1:] != values[:-1])) if len(values) else np.empty(0, np.int64)
    return values[at].tolist(), at.tolist(), np.append(at[1:], len(values)).tolist() if len(at) else []


def planes(data: bytes, n: int, kind: type) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(-1, n).T).view(kind).ravel()


def scaled(values: np.ndarray, parts: int) -> np.ndarray:
    """Part of each 64-bit value's range, in order of the values."""
    return ((values >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def shared_pairs(value: np.ndarray, owner: np.ndarray, sids: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, ...]:
    """The pairs, once, whose shingle another set has, with its number of sets. ``owner`` is a
    place in ``sids`` and ``sizes``; ids and sizes are spread over pairs at the end only."""
    own, at, of = np.unique(sids, return_index=True, return_inverse=True)
    owner, size = of.astype(np.uint32)[owner], sizes[at]
    del at, of
    order = np.argsort(value, kind="stable")
    value, owner = value[order], owner[order]
    del order
    same = value[1:] == value[:-1]
    more = np.append(same, False) | np.append(False, same)
    value, owner = value[more], owner[more]
    order = np.lexsort((owner, value))
    value, owner = value[order], owner[order]
    del order, same, more
    once = np.append(True, (value[1:] != value[:-1]) | (owner[1:] != owner[:-1]))[:len(value)]
    value, owner = value[once], owner[once]
    starts = np.flatnonzero(np.append(True, value[1:] != value[:-1])[:len(value)])
    lengths = np.diff(np.append(starts, len(value)))
    times = np.repeat(lengths, lengths)
    two = times > 1
    value, owner = value[two], owner[two]
    return value, own[owner], size[owner], np.minimum(times[two], COMMON_COUNT - 1)


def answer_buckets(parts: int, most: int):
    """Task over packed rows in order of bucket: each set's shingles that another set has,
    once, gathered over buckets and packed by parts of the sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        ready: list[tuple[np.ndarray, ...]] = []
        now, seen, n_ready = None, set(), 0

        def close() -> None:
            nonlocal n_ready
            if held:
                begun = np.cumsum([0, *(len(h[2]) for h in held[:-1])])
                owner = np.concatenate([of + np.uint32(k) for k, (_, of, *_) in zip(begun.tolist(), held, strict=True)])
                value, sids, sizes = (np.concatenate([h[k] for h in held]) for k in (0, 2, 3))
                held.clear()
                ready.append(shared_pairs(value, owner, sids, sizes))
                n_ready += len(ready[-1][0])

        def pack_up() -> pa.RecordBatch:
            nonlocal n_ready
            rows = []
            if ready:
                value, sid, size, times = (np.concatenate(c) for c in zip(*ready, strict=True))
                ready.clear()
                n_ready = 0
                order = np.argsort(sid, kind="stable")
                value, sid, size, times = value[order], sid[order], size[order], times[order]
                part = scaled(sid.view(np.uint64) ^ np.uint64(1 << 63), parts)
                for k, at, end in zip(*runs(part), strict=True):
                    own, first, last = runs(sid[at:end])
                    rows.append((k, np.array(own, np.int64).tobytes(), size[at:end][first].astype(np.uint32).tobytes(),
                                 np.subtract(last, first).astype(np.uint32).tobytes(), value[at:end].tobytes(), times[at:end].astype(np.uint32).tobytes()))
            return as_batch(rows, SHARED_SCHEMA)

        for b in batches:
            for row in zip(*b.columns, strict=True):
                bucket, n, shingles, owners, sids, sizes = (x.as_py() for x in row)
                if bucket != now:
                    close()
                    now = bucket
                    seen.clear()
                    if n_ready >= most:
                        yield pack_up()
                sids_, sizes_ = np.frombuffer(sids, np.int64), np.frombuffer(sizes, np.int64)
                if bucket >= 0:
                    held.append((planes(shingles, n, np.uint64), planes(owners, n, np.uint32), sids_, sizes_))
                elif sids not in seen:
                    seen.add(sids)
                    ready.append((np.frombuffer(shingles, np.uint64), np.repeat(sids_, n), np.repeat(sizes_, n), np.full(n, COMMON_COUNT)))
                    n_ready += n
        close()
        yield pack_up()

    return run


def least_overlap(size: int, percent: int) -> int:
    """Shingles that a set must share with any partner."""
    return -(-size * percent // 100)


def keep_able(percent: int):
    """Task over rows of ``SHARED_SCHEMA`` in order of part: the sets that can link, with the
    shared shingles in order and the part of the prefix that the index needs, from place
    ``first`` on."""

    def able(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        sids, sizes, lengths, value, times = (
            np.concatenate([np.frombuffer(r[k], t) for r in rows]) for k, t in enumerate((np.int64, np.uint32, np.uint32, np.uint64, np.uint32)))
        sid, size = np.repeat(sids, lengths), np.repeat(sizes, lengths)
        order = np.lexsort((value, times, sid))
        value, sid, size = value[order], sid[order], size[order].astype(np.int64)
        out = []
        for s, at, end in zip(*runs(sid), strict=True):
            n = int(size[at])
            unshared, length = n - (end - at), n - least_overlap(n, percent) + 1
            if unshared < length:
                prefix = value[at:min(end, at + length - unshared)].view(np.int64)
                out.append((s, n, np.sort(value[at:end]).tobytes(), prefix.tolist(), unshared))
            if len(out) >= 1024:
                yield as_batch(out, KEPT_SCHEMA)
                out = []
        yield as_batch(out, KEPT_SCHEMA)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        for b in batches:
            for part, *row in zip(*b.columns, strict=True):
                part, row = part.as_py(), [x.as_py() for x in row]
                if part != now and held:
                    yield from able(held)
                    held = []
                now = part
                held.append(row)
        if held:
            yield from able(held)

    return run


def members(docs: DataFrame, words: int = WORDS, one_in: int = COMMON_ONE_IN) -> DataFrame:
    """Rows of ``MEMBER_SCHEMA``, staged."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty("text").cast("binary").alias("data"))
    return stage(texts.mapInArrow(member_rows(words, one_in), MEMBER_SCHEMA), "jaccard-members")


def able_sets(docs: DataFrame, found: DataFrame, words: int, percent: int, bucket_pairs: int, one_in: int) -> DataFrame:
    """Steps 1 and 2: rows of ``KEPT_SCHEMA``."""
    n_docs, pairs = found.filter("shingle is null").agg(F.count(F.lit(1)), F.sum("size")).first()
    # A shingle in 1 / one_in of the texts has at least half its places in chunks that report
    # it. The list is bounded: at most 2 * one_in times the mean size of a set are so common.
    often = found.filter("shingle is not null").groupBy("shingle").agg(F.sum("times").alias("n")).filter(
        F.col("n") >= max(4.0, n_docs / (2 * one_in))).select("shingle").toPandas()
    common = np.sort(often["shingle"].to_numpy(np.int64).view(np.uint64))
    buckets = max(1, -(-(pairs or 0) // bucket_pairs))
    texts = docs.select(text_or_empty("text").cast("binary").alias("data"))
    packed = texts.mapInArrow(pack(words, buckets, common), PACK_SCHEMA)
    answer = answer_buckets(buckets, ANSWER_PAIRS)
    shared = packed.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(answer, SHARED_SCHEMA)
    dealt = shared.repartition("part").sortWithinPartitions("part")
    return stage(dealt.mapInArrow(keep_able(percent), KEPT_SCHEMA), "jaccard-able")


def links(shared: int, size: int, other: int, percent: int) -> bool:
    return 100 * shared >= percent * (size + other - shared)


def compare(percent: int):
    """Task over (a, b, size_a, size_b, shared_a, shared_b): the overlap of b with a and, if
    half their union is common, the shingles in which b differs from a."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for x, y, size_x, size_y, own, other in zip(*(c.to_pylist() for c in b.columns), strict=True):
                own, other = np.frombuffer(own, np.uint64), np.frombuffer(other, np.uint64)
                both = np.intersect1d(own, other, assume_unique=True)
                less = plus = None
                if links(len(both), size_x, size_y, 50):
                    less, plus = (np.setdiff1d(s, both, assume_unique=True).tobytes() for s in (own, other))
                rows.append((x, y, len(own), len(both), size_y, links(len(both), size_x, size_y, percent), less, plus))
            yield as_batch(rows, ANSWER_SCHEMA)

    return run


def compared(pairs: DataFrame, able: DataFrame, percent: int) -> DataFrame:
    """Rows of ``ANSWER_SCHEMA`` for ``pairs(a, b)``."""
    one = able.select(F.col("sid").alias("a"), F.col("size").alias("size_a"), F.col("shared").alias("shared_a"))
    other = able.select(F.col("sid").alias("b"), F.col("size").alias("size_b"), F.col("shared").alias("shared_b"))
    return pairs.join(other, "b").join(one, "a").select("a", "b", "size_a", "size_b", "shared_a", "shared_b").mapInArrow(
        compare(percent), ANSWER_SCHEMA)


def hub_pairs(entries: DataFrame, percent: int) -> DataFrame:
    """``a, b``: the hub of each list and size class, and every other set of it."""
    size_class = F.floor(F.log(F.col("size").cast("double")) / F.log(F.lit(100 / percent)))
    classed = entries.withColumn("of_size", size_class)
    hubs = classed.groupBy("shingle", "of_size").agg(F.max(F.struct("share", "sid")).alias("hub"), F.count(F.lit(1)).alias("n"))
    hubs = hubs.filter("n > 1").select("shingle", "of_size", F.col("hub.sid").alias("a"))
    return classed.join(hubs, ["shingle", "of_size"]).filter("sid != a").select("a", F.col("sid").alias("b")).distinct()


def cut_blocks(block: int):
    """Task over (shingle, size, place, sid, class) in this order: rows of ``BLOCK_SCHEMA``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = TaskContext.get().partitionId() << 40
        kept = [np.empty(0, np.int64)] * 5

        def rows(columns: list[np.ndarray], last: bool) -> tuple[list[tuple], list[np.ndarray]]:
            nonlocal made
            out, rest = [], [c[:0] for c in columns]
            for shingle, at, end in zip(*runs(columns[0]), strict=True):
                for a in range(at, end, block):
                    e = min(a + block, end)
                    if e == len(columns[0]) and not last:  # the next batch may go on with it
                        return out, [c[a:] for c in columns]
                    size, place, sid, of = (c[a:e] for c in columns[1:])
                    out.append((shingle, made, sid.tobytes(), size.tobytes(), place.tobytes(), of.tobytes(),
                                *(int(f(c)) for c, f in ((size, np.min), (size, np.max), (place, np.min), (of, np.min), (of, np.max)))))
                    made += 1
            return out, rest

        for b in batches:
            out, kept = rows([np.concatenate((k, c.to_numpy())) for k, c in zip(kept, b.columns, strict=True)], False)
            yield as_batch(out, BLOCK_SCHEMA)
        yield as_batch(rows(kept, True)[0], BLOCK_SCHEMA)

    return run


def meet_blocks(percent: int):
    """Task over pairs of blocks: the pairs of sets of unlike classes that sizes and places
    allow to link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns), strict=True):
                own, *one = (np.frombuffer(c, np.int64) for c in row[:4])
                other, *two = (np.frombuffer(c, np.int64) for c in row[4:])
                (size, place, of), (size2, place2, of2) = ([c[:, None] for c in one], two)
                least = -(-percent * (size + size2) // (100 + percent))
                fit = (of != of2) & (np.minimum(size - place, size2 - place2) >= least) & (
                    100 * np.minimum(size, size2) >= percent * np.maximum(size, size2))
                i, j = np.nonzero(fit)
                a, c = own[i], other[j]
                if len(a):
                    yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, c)), pa.array(np.maximum(a, c))], ["a", "b"])

    return run


def unlike_pairs(entries: DataFrame, percent: int, block: int) -> DataFrame:
    """Step 4: ``a, b`` of unlike classes, from ``entries(shingle, size, place, sid, class)``."""
    mixed = entries.groupBy("shingle").agg(F.min("class").alias("low"), F.max("class").alias("high")).filter("low != high")
    left = entries.join(mixed.select("shingle"), "shingle", "left_semi").select("shingle", "size", "place", "sid", "class")
    dealt = left.repartitionByRange("shingle", "size", "place", "sid").sortWithinPartitions("shingle", "size", "place", "sid")
    blocks = stage(dealt.mapInArrow(cut_blocks(block), BLOCK_SCHEMA), "jaccard-blocks")
    columns = [c.split()[0] for c in BLOCK_SCHEMA.split(", ")][1:]
    one, other = (blocks.select("shingle", *[F.col(c).alias(f"{c}_{k}") for c in columns]) for k in "xy")
    reach = F.least(*[F.col(f"size_high_{k}") - F.col(f"place_low_{k}") for k in "xy"])
    skip = ((F.col("class_low_x") == F.col("class_high_x")) & (F.col("class_low_y") == F.col("class_high_y"))
            & (F.col("class_low_x") == F.col("class_low_y")))
    met = one.join(other, "shingle").filter(
        (F.col("block_x") <= F.col("block_y")) & (100 * F.col("size_high_x") >= percent * F.col("size_low_y"))
        & (reach * (100 + percent) >= percent * (F.col("size_low_x") + F.col("size_low_y"))) & ~skip)
    parts = [f"{c}_{k}" for k in "xy" for c in ("sids", "sizes", "places", "classes")]
    return met.select(*parts).mapInArrow(meet_blocks(percent), "a long, b long").distinct()


def by_relation(percent: int):
    """Task over pairs and what they differ in from their common hub: do they link?"""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for x, y, n, size, other, *parts in zip(*(c.to_pylist() for c in b.columns), strict=True):
                less, plus, less2, plus2 = (np.frombuffer(p, np.uint64) for p in parts)
                low = n - len(less) - len(less2)
                high = low + min(len(less), len(less2)) + min(len(plus), len(plus2))
                if not links(low, size, other, percent):
                    if not links(high, size, other, percent):
                        continue
                    low += len(np.intersect1d(less, less2, assume_unique=True)) + len(np.intersect1d(plus, plus2, assume_unique=True))
                    if not links(low, size, other, percent):
                        continue
                rows.append((x, y))
            yield as_batch(rows, "a long, b long")

    return run


def unlike_links(pairs: DataFrame, answers: DataFrame, able: DataFrame, percent: int) -> DataFrame:
    """Step 5: the ``pairs(a, b)`` that link."""
    hubs = answers.select("a", F.col("hub_shared")).distinct()
    near = answers.filter("less is not null").select("a", "b", "hub_shared", "shared", "size", "less", "plus").union(
        hubs.join(able.select(F.col("sid").alias("a"), "size"), "a").select(
            "a", F.col("a").alias("b"), "hub_shared", F.col("hub_shared").alias("shared"), "size", F.lit(b""), F.lit(b"")))
    home = stage(near.groupBy("b").agg(F.max_by(F.struct("a", "hub_shared", "size", "less", "plus"), F.struct("shared", "a")).alias("home")), "jaccard-homes")
    at = [home.select(F.col("b").alias(k), F.col("home").alias(f"home_{k}")) for k in "ab"]
    placed = stage(pairs.join(at[0], "a", "left").join(at[1], "b", "left"), "jaccard-pairs")
    same = F.coalesce(F.col("home_a.a") == F.col("home_b.a"), F.lit(False))
    derived = placed.filter(same).select("a", "b", "home_a.hub_shared", F.col("home_a.size").alias("size_a"), F.col("home_b.size").alias("size_b"),
                                         *[F.col(f"home_{k}.{c}").alias(f"{c}_{k}") for k in "ab" for c in ("less", "plus")])
    whole = compared(placed.filter(~same).select("a", "b"), able, percent).filter("link").select("a", "b")
    return derived.mapInArrow(by_relation(percent), "a long, b long").union(whole)


def classes(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, bucket_pairs: int = BUCKET_PAIRS,
            one_in: int = COMMON_ONE_IN, block: int = BLOCK) -> DataFrame:
    """``doc_id, n_shingles, sid, component_id`` for every row of ``docs``."""
    if not (words >= 1 and 50 < percent <= 100):
        raise ValueError("shingles have a word at least, and the percentage is over 50 and at most 100")
    found = members(docs, words, one_in)
    able = able_sets(docs, found, words, percent, bucket_pairs, one_in)
    share = F.octet_length("shared") / 8 / F.col("size")
    entries = able.select("sid", "size", share.alias("share"), "first", F.posexplode("prefix").alias("nth", "shingle")).select(
        "shingle", "size", (F.col("first") + F.col("nth")).alias("place"), "sid", "share")
    answers = stage(compared(hub_pairs(entries, percent), able, percent), "jaccard-answers")
    known = answers.filter("link").select("a", "b")
    roots = stage(components(known), "jaccard-classes")
    classed = entries.join(roots, entries["sid"] == roots["node"], "left").withColumn("class", F.coalesce("root", "sid"))
    done = answers.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    pairs = unlike_pairs(classed, percent, block).join(done, ["a", "b"], "left_anti")
    more = stage(unlike_links(pairs, answers, able, percent), "jaccard-links")
    roots = stage(components(known.union(more)), "jaccard-roots")
    rows = found.filter("shingle is null").select("doc_id", F.col("size").alias("n_shingles"), "sid")
    ids = rows.filter("sid is not null").groupBy("sid").agg(F.min("doc_id").alias("first"))
    rooted = ids.join(roots, ids["sid"] == roots["node"], "left").select("sid", "first", F.coalesce("root", "sid").alias("root"))
    least = rooted.groupBy("root").agg(F.min("first").alias("least"))
    named = stage(rooted.join(least, "root").select("sid", "least"), "jaccard-named")
    return rows.join(named, "sid", "left").select(
        "doc_id", "n_shingles", "sid", F.when(F.col("sid").isNull(), F.col("doc_id")).otherwise(F.col("least")).alias("component_id"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classes(table(spark, sf_dir, "documents")).drop("sid")
