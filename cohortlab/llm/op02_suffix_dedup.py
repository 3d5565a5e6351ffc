"""Suffix-array dedup: repeated 100-byte strings found by external induced sorting.

Every ``LENGTH``-byte window is assigned to the gram of ``GRAM`` bytes of least hash in
it (the leftmost of equal ones). Windows in a row with the same gram are one piece of
text, so equal windows anywhere in the corpus lie in pieces of equal grams, and shards
of whole grams can be sorted apart from each other without losing a match.

A task first settles the pieces that repeat inside a chunk of its own rows: all but the
earliest are covered whole, and only the earliest is shuffled. Thus a passage that a
third of all rows hold leaves a task as a few pieces. A chunk's pieces are shuffled as
compressed blocks, one for each bucket of grams. Beyond the shuffle, copies of a
piece are settled in the same way. Of the others only those go on that share a block
around the gram with a different piece: for each of ``SIDES`` ranges of the place that a
gram may have in a window, the bytes that all such windows hold. A window in common
implies a common block.

These pieces, joined with separators, are the text of a shard. Its suffixes are sorted
by induction: substrings between leftmost S suffixes are sorted and named, the string of
names is sorted by recursion, L suffixes are induced from the S* suffixes and S suffixes
from those. Both phases take their next suffixes from a priority queue of tuples (first
character, order of the source, position, common prefix), in batches that end before the
first suffix that a push of the same batch might precede. A tuple's common prefix is one
plus the least one between its source and the source before it with the same character,
so it needs no look at the text. A queue of more than ``QUEUE_ITEMS`` tuples writes
sorted runs to the shared folder. A shard's text and the order of its L suffixes are held
in memory as arrays; the queues and the sort of the substrings go to disk when they hold
more than ``QUEUE_ITEMS``.
Neighbours in suffix order with a common prefix of at least ``LENGTH`` are one class:
its earliest window stays, the bytes of all others are removed.

Defined results: null is the empty text; texts shorter than a window keep all bytes; a
null doc_id comes last; rows that repeat a doc_id follow each other in scan order (so
``docs`` must be a table or a plan whose scan order is fixed). An empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import heapq
import pickle
from array import array
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlab.llm.common import Scratch, shared_dir, table, text_or_empty

LENGTH = 100
GRAM = 16
CHUNK_BYTES = 5 << 20
BUCKETS = 16  # for each shuffle partition
SHARD_BYTES = 1 << 20
QUEUE_ITEMS = 1 << 21
RUN_BLOCK = 4096
PIECE = 1 << 19
SIDES = 8


class Queue:
    """Priority queue of tuples, taken in batches: keys (character 28 bits, order of the
    source 36), values (position 56 bits, common prefix 8). Pushes are sorted runs; runs of
    like size are merged; with more than ``limit`` tuples in memory they go to one run on
    disk, of which a block is loaded at a time."""

    def __init__(self, scratch: Scratch, limit: int):
        self.scratch, self.limit = scratch, limit
        self.runs: list[tuple[np.ndarray, np.ndarray]] = []  # in memory, the largest first
        self.stored: list[list] = []  # [keys, values of the loaded block, further blocks]

    def push(self, keys: np.ndarray, values: np.ndarray) -> None:
        while self.runs and len(self.runs[-1][0]) <= 2 * len(keys):
            old = self.runs.pop()
            keys, values = np.concatenate([old[0], keys]), np.concatenate([old[1], values])
            by = np.argsort(keys, kind="stable")
            keys, values = keys[by], values[by]
        self.runs.append((keys, values))
        if sum(len(k) for k, _ in self.runs) > self.limit:
            keys, values = (np.concatenate(x) for x in zip(*self.runs, strict=True))
            by = np.argsort(keys, kind="stable")
            rows = np.stack([keys[by], values[by]], 1)
            path = self.scratch.write(rows[k:k + RUN_BLOCK].tobytes() for k in range(0, len(rows), RUN_BLOCK))
            self.runs = []
            self.load([None, None, self.scratch.read(path, 16 * RUN_BLOCK)])

    def load(self, run: list) -> None:
        block = next(run[2], None)
        if block is not None:
            rows = np.frombuffer(block, np.uint64).reshape(-1, 2)
            self.stored.append([rows[:, 0], rows[:, 1], run[2]])

    def head(self, count: int) -> tuple[np.ndarray, np.ndarray, bool]:
        """Up to ``count`` least tuples, and if there may be others."""
        parts, bound, more = [], None, False
        for k, v, *further in [*self.runs, *self.stored]:
            if further or len(k) > count:
                last = k[min(count, len(k)) - 1]
                bound, more = last if bound is None else min(bound, last), True
            parts.append((k[:count], v[:count]))
        if not parts:
            return np.empty(0, np.uint64), np.empty(0, np.uint64), False
        keys, values = (np.concatenate(x) for x in zip(*parts, strict=True))
        by = np.argsort(keys, kind="stable")
        if bound is not None:
            by = by[:np.searchsorted(keys[by], bound, "right")]
        return keys[by[:count]], values[by[:count]], more or len(by) > count

    def drop(self, key: np.uint64) -> None:
        """Remove the tuples up to ``key``."""
        left = []
        for k, v in self.runs:
            at = int(np.searchsorted(k, key, "right"))
            if at < len(k):
                left.append((k[at:], v[at:]))
        self.runs = sorted(left, key=lambda r: -len(r[0]))
        stored, self.stored = self.stored, []
        for run in stored:
            at = int(np.searchsorted(run[0], key, "right"))
            if at < len(run[0]):
                self.stored.append([run[0][at:], run[1][at:], run[2]])
            else:
                self.load(run)


class Sources:
    """Least common prefix between the last source of a character and the present one,
    for sources that come in batches. The stack of minima holds at most as many values
    as a common prefix has."""

    def __init__(self, cap: int, characters: int):
        self.cap, self.last = cap, np.full(characters, -1, np.int64)
        self.at, self.least = np.empty(0, np.int64), np.empty(0, np.int64)

    def batch(self, first: int, common: np.ndarray, index: np.ndarray, char: np.ndarray, by: np.ndarray) -> np.ndarray:
        """``common[k]`` is the prefix that source ``first + k`` shares with the one before;
        sources ``index`` push ``char``, which ``by`` sorts stably. The prefixes of the pushes."""
        n, out = len(common), np.zeros(len(index), np.int64)
        if len(index):
            table = [common]
            while 2 * (step := 1 << len(table) - 1) <= n:
                low = table[-1].copy()
                low[:n - step] = np.minimum(low[:n - step], table[-1][step:])
                table.append(low)
            table = np.stack(table)
            here, order = char[by], index[by]
            same = np.append(False, here[1:] == here[:-1])
            before = np.where(same, np.append(0, order[:-1]), -1)
            level = np.frexp(order - before)[1] - 1
            # without a source in the batch the minimum starts with the batch ...
            value = np.minimum(table[level, before + 1], table[level, order - (1 << level) + 1])
            # ... and goes on with the stack
            last = np.where(same, first, self.last[here])
            if len(self.at):
                k = np.searchsorted(self.at, last, "right")
                value = np.minimum(value, np.append(self.least, self.cap)[k])
            value = np.minimum(value + 1, self.cap)
            value[~same & (last < 0)] = 0
            out[by] = value
            end = np.append(~same[1:], True)
            self.last[here[end]] = first + order[end]
        low = np.minimum.accumulate(common[::-1])[::-1]
        stays = np.flatnonzero(common < np.append(low[1:], self.cap + 1))
        old = self.least < low[0]
        self.at = np.append(self.at[old], first + stays)
        self.least = np.append(self.least[old], common[stays])
        return out


def equal_run(codes: np.ndarray, a: int, b: int, cap: int) -> int:
    """Common prefix of an L and an S suffix with the same first character: the shorter
    of their runs of it."""
    char, n = codes[a], 0
    while n < cap and codes[a + n] == char and codes[b + n] == char:
        n += 1
    return n


def induced(codes: np.ndarray, stream: np.ndarray, shared: np.ndarray, cap: int, scratch: Scratch,
            limit: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """One phase of the induction over ``codes`` (turned round for the S phase). Suffixes of
    ``stream`` (in order, ``shared`` their common prefixes) and of the queue are scanned, in
    a bucket those of the queue first, and push the suffix to their left. A batch ends
    before the first suffix that a push of the batch might precede. Gives position, common
    prefix with the suffix before, and if it came from the queue."""
    queue, sources = Queue(scratch, limit), Sources(cap, int(codes.max()) + 1)
    taken, first, before, was_pushed, size = 0, 0, -1, False, 256
    while True:
        key, value, more = queue.head(size)
        q_char = (key >> np.uint64(36)).astype(np.int64)
        s_pos = stream[taken:taken + size]
        s_char = codes[s_pos]
        if taken + size < len(stream):
            q_stays = int(np.searchsorted(q_char, s_char[-1], "right"))
        else:
            q_stays = len(key)
        s_stays = int(np.searchsorted(s_char, q_char[-1], "left")) if more else len(s_pos)
        if not q_stays and not s_stays:
            if not len(key) and not len(s_pos):
                return
            raise RuntimeError("a batch is never empty")
        pos = np.concatenate([(value[:q_stays] >> np.uint64(8)).astype(np.int64), s_pos[:s_stays]])
        common = np.concatenate([(value[:q_stays] & np.uint64(255)).astype(np.int64), shared[taken:taken + s_stays]])
        char = np.concatenate([q_char[:q_stays], s_char[:s_stays]])
        pushed = np.arange(len(pos)) < q_stays
        by = np.argsort(2 * char + ~pushed, kind="stable")
        pos, common, char, pushed = pos[by], common[by], char[by], pushed[by]
        left = np.where(pos > 0, codes[pos - 1], -1)
        pushes = (left > char) | ((left == char) & pushed)
        least = np.minimum.accumulate(np.where(pushes, left, 1 << 40))
        unsafe = np.flatnonzero(char[1:] + ~pushed[1:] > least[:-1])
        n = int(unsafe[0]) + 1 if len(unsafe) else len(pos)
        size = min(1 << 16, 2 * size) if n == len(pos) else max(64, 2 * n)
        pos, common, pushed, char = pos[:n], common[:n].copy(), pushed[:n], char[:n]
        for k in np.flatnonzero(~pushed & np.append(was_pushed, pushed[:-1])).tolist():
            prior = int(pos[k - 1]) if k else before
            common[k] = equal_run(codes, prior, int(pos[k]), cap) if codes[prior] == char[k] else 0
        if pushed.any():
            queue.drop(key[int(pushed.sum()) - 1])
        index = np.flatnonzero(pushes[:n])
        to = left[index]
        by = np.argsort(to, kind="stable")
        prefix = sources.batch(first, common, index, to, by)
        if len(index):
            keys = to.astype(np.uint64) << np.uint64(36) | (first + index).astype(np.uint64)
            values = (pos[index] - 1).astype(np.uint64) << np.uint64(8) | prefix.astype(np.uint64)
            queue.push(keys[by], values[by])
        yield pos, common, pushed
        taken, first, before, was_pushed = taken + int((~pushed).sum()), first + n, int(pos[-1]), bool(pushed[-1])


def in_order(keys: Iterator[tuple[bytes, int]], scratch: Scratch, limit: int) -> Iterator[tuple[bytes, int]]:
    """External sort: sorted runs of ``limit`` keys on disk, merged."""
    runs, held = [], []

    def blocks(rows):
        for k in range(0, len(rows), RUN_BLOCK):
            part = pickle.dumps(rows[k:k + RUN_BLOCK])
            yield len(part).to_bytes(8, "big") + part

    def load(path):
        data = b""
        for block in scratch.read(path, 1 << 18):
            data += block
            while len(data) >= 8 and len(data) >= (size := 8 + int.from_bytes(data[:8], "big")):
                yield from pickle.loads(data[8:size])
                data = data[size:]

    for key in keys:
        held.append(key)
        if len(held) >= limit:
            held.sort()
            runs.append(load(scratch.write(blocks(held))))
            held = []
    held.sort()
    yield from heapq.merge(*runs, held) if runs else held


def substrings_on_disk(codes: np.ndarray, stars: np.ndarray, scratch: Scratch, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """S* substrings in order and their names. One that is the beginning of another one is
    the larger of both."""
    raw = codes.astype(">u4").tobytes()
    keys = ((raw[4 * a:4 * b] + b"\xff\xff\xff\xff", j)
            for j, (a, b) in enumerate(zip(stars.tolist(), [*(stars[1:] + 1).tolist(), len(codes)], strict=True)))
    named, order, name, before = array("I"), array("I"), -1, None
    for key, j in in_order(keys, scratch, limit):
        if key != before:
            name, before = name + 1, key
        named.append(name)
        order.append(j)
    return np.asarray(order, np.int64), np.asarray(named, np.int64)


def substrings_in_memory(codes: np.ndarray, stars: np.ndarray, *_) -> tuple[np.ndarray, np.ndarray]:
    """The same, for as many substrings as a queue may hold: groups of equal beginnings are
    refined by the next few characters until they are single or wholly read."""
    m, n = len(stars), len(codes)
    size = np.append(stars[1:] + 1, n) - stars
    end = int(codes.max()) + 1  # after the last character, above all of them
    bits = end.bit_length()
    group, rest, read, step = np.zeros(m, np.int64), np.arange(m), 0, 62 // bits
    while len(rest):
        word = np.zeros(len(rest), np.int64)
        for at in range(read, read + step):
            char = codes[np.minimum(stars[rest] + at, n - 1)]
            word = word << bits | np.where(at < size[rest], char, np.where(at == size[rest], end, 0))
        by = np.lexsort((word, group[rest]))
        rest, word = rest[by], word[by]
        old, place = group[rest], np.arange(len(rest))
        starts = np.append(True, old[1:] != old[:-1])
        splits = starts | np.append(True, word[1:] != word[:-1])
        first = np.maximum.accumulate(np.where(splits, place, 0))
        group[rest] = old + first - np.maximum.accumulate(np.where(starts, place, 0))
        read += step
        shared = ~splits | np.append(~splits[1:], False)
        rest = rest[shared & (size[rest] >= read)]
    order = np.argsort(group, kind="stable")
    group = group[order]
    return order, np.cumsum(np.append(0, group[1:] != group[:-1]))


def star_order(codes: np.ndarray, cap: int, scratch: Scratch, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Leftmost S suffixes in order and each one's common prefix with the one before."""
    n = len(codes)
    smaller = np.append(np.sign(codes[1:] - codes[:-1]), -1)  # 1: next character is larger
    decided = np.where(smaller != 0, np.arange(n), n)
    upto = np.minimum.accumulate(decided[::-1])[::-1]  # the next position that decides the type
    is_s = smaller[np.minimum(upto, n - 1)] > 0
    is_s[n - 1] = True
    stars = np.flatnonzero(is_s[1:] & ~is_s[:-1]) + 1
    del smaller, decided, upto, is_s
    m = len(stars)
    order, named = (substrings_in_memory if m <= limit else substrings_on_disk)(codes, stars, scratch, limit)
    shared = np.zeros(m, np.int64)
    if named[-1] + 1 < m:
        names = np.empty(m, np.int64)
        names[order] = named
        parts = list(suffix_batches(names, cap, scratch, limit))
        order = np.concatenate([p for p, _ in parts])[::-1]
        shared[1:] = np.concatenate([c for _, c in parts])[::-1][:-1]
    a, b = stars[np.append(order[0], order[:-1])], stars[order]
    common = np.minimum(cap, stars[np.append(order[0], order[:-1]) + shared] - a)
    open_ = np.arange(1, m)
    while len(open_):
        open_ = open_[common[open_] < cap]
        open_ = open_[codes[a[open_] + common[open_]] == codes[b[open_] + common[open_]]]
        common[open_] += 1
    common[0] = 0
    return b, common


def suffix_batches(codes: np.ndarray, cap: int, scratch: Scratch, limit: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All suffixes of ``codes``, which ends with a 0 that it has nowhere else, from the
    largest to the smallest: position and common prefix (at most ``cap``) with the
    suffix given before."""
    n = len(codes)
    if n > 1:
        larger, shared = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for pos, common, pushed in induced(codes, *star_order(codes, cap, scratch, limit), cap, scratch, limit):
            larger.append(pos[pushed])
            shared.append(common[pushed])
        larger, shared = np.concatenate(larger)[::-1], np.concatenate(shared)[::-1]
        for pos, common, _ in induced(codes.max() - codes, larger, np.append(0, shared[:-1]), cap, scratch, limit):
            yield pos, common
    yield np.array([n - 1]), np.array([0])


def suffixes(text: array, cap: int, scratch: Scratch, limit: int = QUEUE_ITEMS) -> Iterator[tuple[int, int]]:
    """``suffix_batches`` one by one."""
    for pos, common in suffix_batches(np.asarray(text, np.int64), cap, scratch, limit):
        yield from zip(pos.tolist(), common.tolist(), strict=True)


def gram_key(first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Hash of grams, from their first and last 8 bytes."""
    mix = first * np.uint64(0x9E3779B97F4A7C15) + last * np.uint64(0xC2B2AE3D27D4EB4F)
    mix = (mix ^ mix >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9)
    return mix ^ mix >> np.uint64(32)


def pieces(data: bytes, length: int, gram: int) -> Iterator[tuple[int, int, int, int]]:
    """``key, begin, end, gram position`` of the windows in a row that share a gram."""
    codes = np.frombuffer(data, np.uint8)
    span = length - gram + 1
    for base in range(0, len(codes) - length + 1, PIECE):
        part = codes[base:base + PIECE + length - 1].astype(np.uint64)
        word, width = part, 1
        while width < 8:
            word = word[:-width] | word[width:] << np.uint64(8 * width)
            width *= 2
        mix = gram_key(word[:len(word) - (gram - 8)], word[gram - 8:])
        low = mix >> np.uint64(20) << np.uint64(20) | np.arange(len(mix), dtype=np.uint64)
        width = 1
        while width < span:
            step = min(width, span - width)
            low = np.minimum(low[:-step], low[step:])
            width += step
        place = (low & np.uint64((1 << 20) - 1)).astype(np.int64)
        cut = np.flatnonzero(np.append(True, place[1:] != place[:-1]))
        at = place[cut]
        end = np.append(cut[1:], len(place)) - 1 + length
        yield from zip(mix[at].view(np.int64).tolist(), (cut + base).tolist(), (end + base).tolist(), (at + base).tolist(), strict=True)


PIECE_SCHEMA = "key long, doc_id long, rid long, begin int, gram int, body binary, done binary"
PIECE_TYPES = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]
PIECE_NAMES = [c.split()[0] for c in PIECE_SCHEMA.split(", ")]


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Union of half-open spans, touching ones joined."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def packed(spans: list[tuple[int, int]]) -> bytes:
    return np.array(merged(spans), "<i4").tobytes()


PACK_SCHEMA = "bucket int, rid long, size int, packed binary"
PACK_TYPES = [pa.int32(), pa.int64(), pa.int32(), pa.binary()]
PACK_NAMES = [c.split()[0] for c in PACK_SCHEMA.split(", ")]


def pack_rows(rows: list[tuple]) -> tuple[int, bytes]:
    """Pieces (doc_id, rid, begin, gram, body), column by column and compressed."""
    doc_id, rid, begin, at, body = zip(*rows, strict=True)
    data = b"".join([np.int32(len(rows)).tobytes(), np.array([d or 0 for d in doc_id], "<i8").tobytes(),
                     np.array(rid, "<i8").tobytes(), np.array(begin, "<i4").tobytes(), np.array(at, "<i4").tobytes(),
                     np.cumsum([0, *map(len, body)]).astype("<i4").tobytes(), bytes([d is None for d in doc_id]), *body])
    return len(data), pa.compress(data, codec="zstd", asbytes=True)


def unpack_rows(size: int, packed_rows: bytes, gram: int) -> pa.RecordBatch:
    data = pa.decompress(packed_rows, decompressed_size=size, codec="zstd", asbytes=True)
    n, at = int.from_bytes(data[:4], "little"), 4

    def column(kind: str, count: int) -> np.ndarray:
        nonlocal at
        out = np.frombuffer(data, kind, count, at)
        at += out.nbytes
        return out

    doc_id, rid = column("<i8", n), column("<i8", n)
    begin, at_gram, offsets = column("<i4", n), column("<i4", n), column("<i4", n + 1)
    unnamed = column("?", n)
    codes = np.frombuffer(data, np.uint8, offset=at)
    first = (offsets[:-1] + at_gram)[:, None] + np.arange(8)
    key = gram_key(codes[first].view("<u8")[:, 0], codes[first + gram - 8].view("<u8")[:, 0]).view(np.int64)
    body = pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data[at:])])
    return pa.RecordBatch.from_arrays([pa.array(key), pa.array(doc_id, mask=unnamed), pa.array(rid), pa.array(begin), pa.array(at_gram),
                                       body, pa.nulls(n, pa.binary())], PIECE_NAMES)


def cut_pieces(length: int, gram: int, chunk_bytes: int, buckets: int):
    """Task over (doc_id, rid, data): the earliest of equal pieces of a chunk, packed by
    bucket of their key, and per document the spans of all later ones."""

    def settle(docs: list[tuple]) -> Iterator[pa.RecordBatch]:
        seen, rows, out = set(), {}, []
        for _, doc_id, rid, data in sorted(docs, key=lambda d: (d[0], d[1] or 0, d[2])):
            done = []
            for key, a, b, g in pieces(data, length, gram):
                body = data[a:b]
                if body in seen:
                    done.append((a, b))
                else:
                    seen.add(body)
                    rows.setdefault(key % buckets, []).append((doc_id, rid, a, g - a, body))
            if done:
                out.append((rid % buckets, rid, None, packed(done)))
        seen.clear()
        out += [(bucket, None, *pack_rows(rows[bucket])) for bucket in rows]
        cols = list(zip(*out, strict=True)) if out else [[]] * len(PACK_TYPES)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, PACK_TYPES, strict=True)], PACK_NAMES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for b in batches:
            for doc_id, rid, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), (x.as_py() for x in b.column(2)), strict=True):
                if len(data) >= length:
                    held.append((doc_id is None, doc_id, rid, data))
                    size += len(data)
                if size >= chunk_bytes:
                    yield from settle(held)
                    held, size = [], 0
        yield from settle(held)

    return run


def unpack(gram: int):
    """Rows of ``PIECE_SCHEMA`` from those of ``PACK_SCHEMA``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for rid, size, data in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), (x.as_py() for x in b.column(3)), strict=True):
                if size is not None:
                    yield unpack_rows(size, data, gram)
                    continue
                row = (rid, None, rid, None, None, None, data)
                yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, PIECE_TYPES, strict=True)], PIECE_NAMES)

    return run


def removed_of_shard(shard: list[tuple], length: int, scratch: Scratch, limit: int) -> Iterator[tuple[int, int, int]]:
    """``rid, begin, end`` of repeated windows among pieces (doc rank, rid, begin, body):
    windows of a class are neighbours in suffix order, the earliest of them stays."""
    sizes = np.array([len(p[3]) + 1 for p in shard])
    begin = np.append(0, np.cumsum(sizes))
    owner = np.append(np.repeat(np.arange(len(shard), dtype=np.uint32), sizes), np.uint32(len(shard) - 1))
    codes = np.frombuffer(b"\0".join([p[3] for p in shard]) + b"\0\0", np.uint8).astype(np.int64) + 2
    codes[begin[1:] - 1] = 1
    codes[-1] = 0
    best = None  # earliest window of the open class
    held = np.empty((2, 0), np.int64)

    def windows(pos: np.ndarray, common: np.ndarray) -> Iterator[tuple[int, int, int]]:
        nonlocal best
        piece = owner[pos]
        off = pos - begin[piece]
        for c, k, o in zip(common.tolist(), piece.tolist(), off.tolist(), strict=True):
            doc, rid, start = shard[k][:3]
            this = (doc, rid, start + o)
            if c >= length:
                late, best = (this, best) if best < this else (best, this)
                yield late[1], late[2], late[2] + length
            else:
                best = this

    # a common prefix may run across separators: only suffixes that hold a whole window count
    for pos, common in suffix_batches(codes, length, scratch, limit):
        whole = begin[owner[pos] + 1] - 1 - pos >= length
        pos, common = pos[whole], common[whole]
        held = np.append(held, [pos, common], 1)
        if held.shape[1] < 2:
            continue
        whole = held[1] >= length
        near = whole[:-1] | whole[1:]
        yield from windows(*held[:, :-1][:, near])
        held = held[:, -1:]
    if held.shape[1] and held[1, 0] >= length:
        yield from windows(*held)


def sort_shards(root: str, length: int, gram: int, shard_bytes: int, limit: int):
    """Task over rows of ``PIECE_SCHEMA`` ordered by key: ``rid, spans`` that are removed."""
    cuts = [(length - gram) * t // SIDES for t in range(SIDES + 1)]

    def alike(group: list[tuple]) -> list[tuple]:
        """Pieces that may share a window with another one: a window that begins from low
        to high bytes before the gram holds all bytes that such windows have in common."""
        def blocks(p):
            return [(low, p[3][p[4] - low:p[4] + length - high]) for low, high in zip(cuts, cuts[1:], strict=False)
                    if p[4] >= low and len(p[3]) >= p[4] + length - high]
        of = [blocks(p) for p in group]
        times = Counter(x for each in of for x in each)
        return [p for p, each in zip(group, of, strict=True) if any(times[x] > 1 for x in each)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scratch = Scratch(root)
        shard, size, key, last = [], 0, None, None
        group: dict[bytes, tuple] = {}
        found: dict[int, list[tuple[int, int]]] = {}
        n_found = 0

        def leave() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays(
                [pa.array(list(found), pa.int64()), pa.array([packed(s) for s in found.values()], pa.binary())], ["rid", "spans"])
            found.clear()
            return out

        def sort_shard() -> None:
            for rid, a, b in removed_of_shard(shard, length, scratch, limit):
                spans = found.setdefault(rid, [])
                spans.append((a, b))
                if len(spans) > 10_000:
                    found[rid] = merged(spans)

        def close_group() -> None:
            nonlocal size
            if len(group) > 1:
                for p in alike(list(group.values())):
                    shard.append(p[:4])
                    size += len(p[3])
            group.clear()

        try:
            for b in batches:
                if not b.num_rows:
                    continue
                keys = b.column(0).to_numpy()
                again = keys[1:] == keys[:-1]
                # a gram that no other row has; the last row is kept, as the next batch may have it
                wanted = np.append(again, True) | np.append(keys[:1] == last, again)
                last = keys[-1]
                b = b.filter(pa.array(wanted | b.column(6).is_valid().to_numpy(zero_copy_only=False)))
                for k, doc_id, rid, begin, at, body, done in zip(*(c.to_pylist() for c in b.columns), strict=True):
                    if done is not None:
                        found.setdefault(rid, []).extend(map(tuple, np.frombuffer(done, "<i4").reshape(-1, 2).tolist()))
                        n_found += 1
                        continue
                    if k != key:
                        close_group()
                        key = k
                        if size >= shard_bytes:
                            sort_shard()
                            shard, size = [], 0
                    this = ((doc_id is None, doc_id or 0), rid, begin, body, at)
                    first = group.get(body)
                    if first is None:
                        group[body] = this
                        continue
                    if this[:3] < first[:3]:
                        group[body], this = this, first
                    found.setdefault(this[1], []).append((this[2], this[2] + len(body)))
                    n_found += 1
                if n_found > 200_000:
                    yield leave()
                    n_found = 0
            close_group()
            if shard:
                sort_shard()
            yield leave()
        finally:
            scratch.close()

    return run


def repeated_spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, chunk_bytes: int = CHUNK_BYTES,
                   shard_bytes: int = SHARD_BYTES, queue_items: int = QUEUE_ITEMS) -> DataFrame:
    """``rid, spans`` of ``docs(doc_id, rid, data)``: little-endian pairs begin, end."""
    if not (8 <= gram <= 16 and gram < length <= 255):
        raise ValueError("grams have 8 to 16 bytes, windows more than a gram and at most 255")
    root = f"{shared_dir(docs.sparkSession).rstrip('/')}/stage/suffix-queues"
    buckets = BUCKETS * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cut = docs.select("doc_id", "rid", "data").mapInArrow(cut_pieces(length, gram, chunk_bytes, buckets), PACK_SCHEMA)
    shards = cut.repartition("bucket").mapInArrow(unpack(gram), PIECE_SCHEMA).sortWithinPartitions("key")
    return shards.mapInArrow(sort_shards(root, length, gram, shard_bytes, queue_items), "rid long, spans binary")


def kept_texts(docs: DataFrame, **params) -> DataFrame:
    """``doc_id, data, spans, kept``: the removed spans and the bytes that remain."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("rid"),
                       text_or_empty("text").cast("binary").alias("data"))
    spans = repeated_spans(rows, **params).groupBy("rid").agg(F.collect_list("spans").alias("spans"))
    joined = rows.join(spans, "rid", "left").select("doc_id", "data", "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            kept, runs = [], []
            for data, parts in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                gone = merged([tuple(s) for p in parts or [] for s in np.frombuffer(p, "<i4").reshape(-1, 2).tolist()])
                edges = [0, *(x for s in gone for x in s), len(data)]
                kept.append(b"".join([data[x:y] for x, y in zip(edges[::2], edges[1::2], strict=True)]))
                runs.append(packed(gone))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(runs, pa.binary()), pa.array(kept, pa.binary())],
                                             ["doc_id", "data", "spans", "kept"])

    return joined.mapInArrow(run, "doc_id long, data binary, spans binary, kept binary")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = kept_texts(table(spark, sf_dir, "documents"))
    size, left = F.octet_length("data").cast("long"), F.octet_length("kept").cast("long")
    return texts.select("doc_id", size.alias("n_bytes"), (size - left).alias("n_removed"),
                        (F.octet_length("spans") / 8).cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
