"""Sharding by Karmarkar-Karp differencing: equal bytes over a fixed number of shards.

Rows with equal texts are one indivisible group. Groups larger than a ``1/bundles``
share of all bytes are items of their own (at most ``bundles`` of them); the others
are bundled by hash into at most ``bundles`` items. Differencing then sees at most
``2 * bundles`` items at any corpus size: each item is a partial partition, and the
two partial partitions of largest spread are combined again and again, the largest
shard of one with the smallest of the other. Documents find their shard by looking
up their bundle, so they never pass through the task that does the differencing.

Defined results: a null text is empty (size 1); repeated rows each get a slot; a
null doc_id gets one too. An empty table gives an empty result. A group of more
bytes than an even share stays whole and makes its shard the largest.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortlab.llm.common import stage, table, text_or_empty

SHARDS = 16
BUNDLES = 16384
SLOT_CELLS = 1024


def difference(sizes: list[int], shards: int) -> list[int]:
    """Karmarkar-Karp over ``shards`` parts: the part of every item."""
    n = len(sizes)
    if not n or shards == 1:
        return [0] * n
    last = shards - 1
    heap = [(-s, i, (0,) * last + (s,)) for i, s in enumerate(sizes)]
    heapq.heapify(heap)
    merged: list[tuple[int, int, list[int]]] = []
    while len(heap) > 1:
        _, i, a = heapq.heappop(heap)
        _, j, b = heapq.heappop(heap)
        sums = [a[t] + b[last - t] for t in range(shards)]
        order = sorted(range(shards), key=sums.__getitem__)
        low = sums[order[0]]
        heapq.heappush(heap, (low - sums[order[-1]], n + len(merged), tuple(sums[t] - low for t in order)))
        merged.append((i, j, order))
    part = [0] * n
    todo = [(heap[0][1], list(range(shards)))]
    while todo:
        node, label = todo.pop()
        if node < n:
            part[node] = label[last]
            continue
        i, j, order = merged[node - n]
        left, right = [0] * shards, [0] * shards
        for t, o in enumerate(order):
            left[o], right[last - o] = label[t], label[t]
        todo += [(i, left), (j, right)]
    return part


def shard_of_items(items: DataFrame, shards: int) -> DataFrame:
    """``items(item, size)`` with ``shard``; items are bounded in number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted(((s, k) for b in batches for k, s in zip(*(c.to_pylist() for c in b.columns), strict=True)),
                      key=lambda r: (-r[0], r[1]))
        if rows:
            part = difference([s for s, _ in rows], shards)
            yield pa.RecordBatch.from_arrays([pa.array([k for _, k in rows], pa.binary()), pa.array(part, pa.int32())], ["item", "shard"])

    return items.select("item", "size").repartition(1).mapInArrow(run, "item binary, shard int")


def assign(docs: DataFrame, shards: int = SHARDS, bundles: int = BUNDLES) -> DataFrame:
    """``doc_id, size, text_crc32, shard`` for every row."""
    text = text_or_empty("text")
    rows = stage(docs.select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        F.unhex(F.sha2(text, 256)).alias("gid")), "shard-rows")
    whole = rows.agg(F.sum("size")).first()[0] or 0
    bundle = F.pmod(F.xxhash64("gid"), F.lit(bundles)).cast("string").cast("binary")
    groups = rows.groupBy("gid").agg(F.sum("size").alias("size"))
    items = (groups.withColumn("item", F.when(F.col("size") * bundles > whole, F.col("gid")).otherwise(bundle))
             .groupBy("item").agg(F.sum("size").alias("size")))
    placed = stage(shard_of_items(items, shards), "shard-items")
    # both lookups have at most `bundles` rows
    alone = F.broadcast(placed.filter(F.length("item") == 32).select(F.col("item").alias("gid"), F.col("shard").alias("_alone")))
    bundled = F.broadcast(placed.filter(F.length("item") < 32).select(F.col("item").alias("_item"), F.col("shard").alias("_bundled")))
    return (rows.join(alone, "gid", "left").withColumn("_item", bundle).join(bundled, "_item", "left")
            .select("doc_id", "size", "text_crc32", F.coalesce("_alone", "_bundled").alias("shard")))


def with_slots(placed: DataFrame, cells: int = SLOT_CELLS) -> DataFrame:
    """Number each shard's rows from 0 without a gap: rows are counted per cell of a
    shard, cells get their offsets from the running count, rows their rank in the cell."""
    placed = stage(placed.withColumn("_cell", F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(cells)).cast("int")), "shard-placed")
    before = Window.partitionBy("shard").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    counts = placed.groupBy("shard", "_cell").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select("shard", "_cell", F.coalesce(F.sum("_n").over(before), F.lit(0).cast("long")).alias("_before"))
    rank = Window.partitionBy("shard", "_cell").orderBy("doc_id", "text_crc32", "size")
    return (placed.withColumn("_rank", F.row_number().over(rank))
            .join(F.broadcast(offsets), ["shard", "_cell"])  # shards * cells rows at most
            .withColumn("slot", F.col("_before") + F.col("_rank") - 1).drop("_before", "_rank", "_cell"))


def shard(docs: DataFrame, shards: int = SHARDS, bundles: int = BUNDLES, cells: int = SLOT_CELLS) -> DataFrame:
    return with_slots(assign(docs, shards, bundles), cells).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(table(spark, sf_dir, "documents"))
