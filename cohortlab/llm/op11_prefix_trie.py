"""Conversation prefix trie by vertical bitmaps.

Conversations are dealt out in shards by ranges of their ids. A shard has an index from
(position, turn) to the bitset of its conversations with that turn there. A depth-first
walk intersects a node's bitset with the postings of its members' next turns, which gives
the children, their sizes (popcounts) and the list of conversations that end at the node.
A shared prefix, however common, is thus walked once in every shard and its nodes are
added up by their prefix digests; no task gets all conversations of a prefix.

Children, leaves and saved tokens of a subtree come from the merged nodes. A node of one
conversation heads a single path, so only nodes of two and more conversations take part
in the sums, which double their reach each round: after k rounds a node has the sums of
its descendants less than 2^k below it.

Defined results: turns are ordered by turn number (nulls first), then role and digest;
null roles and texts are empty; rows without conv_id form no conversation and are left
out; repeated rows are turns of their own; an empty table has no node at all; columns
beside conv_id, turn, role and text are not read. Turns are told apart by the 128-bit
digest of role and text. A conversation's turn digests (not its texts) pass through one
task.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlab.llm.common import placed, stage, table, text_or_empty

BLOCK, HEAD_MOST = 20, 3  # conversations that share their first one's head; turns of a head
SHARD_CONVERSATIONS = 4096
SHARD_TURNS = 1 << 17
ENDS_A_ROW = 512
WORD = r"[^\x20\x09-\x0D]+"
NODE_SCHEMA = "node binary, parent binary, depth long, words long, first long, n long, ends string"


def turn_rows(conversations: DataFrame) -> DataFrame:
    """``conv_id, place, digest, words``: the turns of each conversation in order."""
    role, text = text_or_empty("role"), text_or_empty("text")
    digest = F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)))
    rows = conversations.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"),
        digest.alias("digest"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"))
    return placed(rows, "conv_id", ["turn", "role", "digest"], "trie-turns").select("conv_id", "place", "digest", "words")


def rebuilt(turns: DataFrame, block: int = BLOCK) -> DataFrame:
    """``turns`` with each conversation's head replaced by that of its block's first one;
    a row of place 0 stands for the conversation itself."""
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % (HEAD_MOST + 1)).cast("int")
    heads = (turns.filter(F.col("place") <= HEAD_MOST).groupBy(F.col("conv_id").alias("base"))
             .agg(F.array_sort(F.collect_list(F.struct("place", "digest", "words"))).alias("head")))
    ids = turns.filter("place = 1").select("conv_id", h.alias("h"), (F.col("conv_id") - F.col("conv_id") % block).alias("base"))
    convs = ids.join(heads, "base", "left").select(
        "conv_id", "h", F.slice(F.coalesce("head", F.array().cast("array<struct<place:bigint,digest:binary,words:bigint>>")), F.lit(1), F.col("h")).alias("head"))
    convs = stage(convs, "trie-conversations")
    own = turns.withColumn("h", h).filter("place > h").drop("h").join(convs.select("conv_id", F.col("h"), F.size("head").alias("led")), "conv_id")
    given = convs.select("conv_id", F.inline("head")).select("conv_id", F.col("place").cast("long").alias("place"), "digest", "words")
    return (own.select("conv_id", (F.col("place") - F.col("h") + F.col("led")).cast("long").alias("place"), "digest", "words")
            .union(given)
            .union(convs.select("conv_id", F.lit(0).cast("long"), F.lit(None).cast("binary"), F.lit(0).cast("long"))))


class Shard:
    """Conversations of one shard, in order of their ids."""

    def __init__(self):
        self.ids: list[int] = []
        self.paths: list[list[tuple[bytes, int]]] = []
        self.postings: dict[tuple[int, bytes], int] = defaultdict(int)
        self.ends: dict[int, int] = defaultdict(int)
        self.turns = 0

    def add(self, conv_id: int, path: list[tuple[bytes, int]]) -> None:
        bit = 1 << len(self.ids)
        self.ids.append(conv_id)
        self.paths.append(path)
        self.turns += len(path)
        self.ends[len(path)] |= bit
        for depth, (digest, _) in enumerate(path):
            self.postings[depth, digest] |= bit

    def members(self, bits: int) -> list[int]:
        out = []
        while bits:
            low = bits & -bits
            out.append(self.ids[low.bit_length() - 1])
            bits ^= low
        return out

    def nodes(self) -> Iterator[tuple]:
        """Rows of ``NODE_SCHEMA``: one for each node, then its ends in rows of their own."""
        stack = [(0, (1 << len(self.ids)) - 1, b"", None, 0)]
        while stack:
            depth, bits, node, parent, words = stack.pop()
            first = self.ids[(bits & -bits).bit_length() - 1]
            yield node, parent, depth, words, first, bits.bit_count(), None
            done = self.members(bits & self.ends.get(depth, 0))
            for k in range(0, len(done), ENDS_A_ROW):
                part = done[k:k + ENDS_A_ROW]
                yield node, None, None, None, part[0], None, ",".join(map(str, part))
            rest = bits & ~self.ends.get(depth, 0)
            while rest:
                # the next child is that of the first member that no child has yet
                digest, n_words = self.paths[(rest & -rest).bit_length() - 1][depth]
                child = rest & self.postings[depth, digest]
                rest ^= child
                stack.append((depth + 1, child, hashlib.md5(node + digest).digest(), node, n_words))


def batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
    names = ["node", "parent", "depth", "words", "first", "n", "ends"]
    columns = zip(*rows, strict=True) if rows else [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def walk_shards(most: int, most_turns: int):
    """Task over (conv_id, place, digest, words) in order: the nodes of its shards."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, conv, path, rows = Shard(), None, [], []

        def close() -> Iterator[pa.RecordBatch]:
            for row in shard.nodes() if shard.ids else ():
                rows.append(row)
                if len(rows) >= 4096:
                    yield batch(rows)
                    rows.clear()

        for b in batches:
            for conv_id, digest, words in zip(b.column(0).to_pylist(), b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True):
                if digest is not None:
                    path.append((digest, words))
                    continue
                if conv is not None:
                    shard.add(conv, path)
                    if len(shard.ids) >= most or shard.turns >= most_turns:
                        yield from close()
                        shard = Shard()
                conv, path = conv_id, []
        if conv is not None:
            shard.add(conv, path)
        yield from close()
        yield batch(rows)

    return run


def hash_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task over (node, ends) in order of node and ids: the digest of each node's list,
    fed piece by piece."""
    node, digest = None, None
    for b in batches:
        nodes, sums = [], []
        for one, part in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            if one != node or digest is None:
                if digest is not None:
                    nodes.append(node)
                    sums.append(digest.hexdigest())
                node, digest = one, hashlib.sha256(part.encode())
            else:
                digest.update(b"," + part.encode())
        yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.binary()), pa.array(sums, pa.string())], ["node", "ends_sha256"])
    if digest is not None:
        yield pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([digest.hexdigest()])], ["node", "ends_sha256"])


def subtree_sums(shared: DataFrame, rounds: int) -> DataFrame:
    """``node, leaves, saved`` of ``shared(node, parent, leaves, saved)`` summed over each
    node's descendants (itself included) in the table."""
    at = shared.select("node", F.col("parent").alias("above"), "leaves", "saved")
    for _ in range(rounds):
        at = stage(at, "trie-sums")
        given = (at.filter("above is not null").groupBy(F.col("above").alias("to"))
                 .agg(F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved")))
        # only the root has no node above it, so what lies under the root stops there
        jump = at.select(F.col("node").alias("via"), F.col("above").alias("next")).filter("next is not null")
        at = (at.join(given, at["node"] == given["to"], "left").join(jump, F.col("above") == F.col("via"), "left")
              .select("node", F.col("next").alias("above"),
                      (F.col("leaves") + F.coalesce("more_leaves", F.lit(0))).alias("leaves"),
                      (F.col("saved") + F.coalesce("more_saved", F.lit(0))).alias("saved")))
    return at.select("node", "leaves", "saved")


def trie(turns: DataFrame, most: int = SHARD_CONVERSATIONS, most_turns: int = SHARD_TURNS) -> DataFrame:
    """One row per node of the prefix trie of ``turns(conv_id, place, digest, words)``."""
    dealt = turns.repartitionByRange("conv_id").sortWithinPartitions("conv_id", "place")
    found = stage(dealt.mapInArrow(walk_shards(most, most_turns), NODE_SCHEMA), "trie-shards")
    merged = stage(found.filter("ends is null").groupBy("node", "parent", "depth", "words")
                   .agg(F.min("first").alias("conv_id"), F.sum("n").alias("n_convs")), "trie-nodes")
    ends = (found.filter("ends is not null").select("node", "ends", "first").repartition("node").sortWithinPartitions("node", "first")
            .select("node", "ends").mapInArrow(hash_ends, "node binary, ends_sha256 string"))
    kids = merged.filter("parent is not null").groupBy(F.col("parent").alias("of")).agg(
        F.count(F.lit(1)).alias("n_children"), F.sum((F.col("n_convs") == 1).cast("long")).alias("lone"))
    shared = merged.filter("n_convs > 1")
    shared = stage(shared.join(kids, shared["node"] == kids["of"], "left").select(
        "node", "parent", "depth", (F.coalesce("lone", F.lit(0)) + F.col("n_children").isNull().cast("long")).alias("leaves"),
        ((F.col("n_convs") - 1) * F.col("words")).alias("saved")), "trie-shared")
    deepest = shared.agg(F.max("depth")).first()[0] or 0
    sums = subtree_sums(shared, deepest.bit_length())
    names = merged.select(F.col("node").alias("up"), F.col("conv_id").alias("parent_conv_id"))
    return (merged.join(kids, merged["node"] == kids["of"], "left").join(sums, "node", "left").join(ends, "node", "left")
            .join(names, F.col("parent") == F.col("up"), "left")
            .select("conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"),
                    F.coalesce("leaves", F.lit(1)).cast("long").alias("n_leaves"),
                    F.coalesce("saved", F.lit(0)).cast("long").alias("saved_tokens"),
                    F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
                    F.lower(F.hex("node")).alias("node")))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = trie(rebuilt(turn_rows(table(spark, sf_dir, "conversations"))))
    return nodes.drop("node")
