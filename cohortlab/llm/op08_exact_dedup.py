"""Exact dedup: an extendible-hash index on shared files, DataFrame operations only.

Every text is normalised (white space deleted) and keyed by a 64-bit hash. The
directory of the index addresses buckets by leading key bits: an overfull bucket
splits on its next bit, and the directory doubles when the split bucket already
used all of its bits. Keys that occur once are settled by the directory. For the
others, tasks that own ranges of (bucket, key) chain the texts that share a key:
texts are compared byte for byte by grouping on the text itself, which Spark
combines before the shuffle, so a text that a third of all rows hold leaves each
task as one row. The chained index is written to the shared folder.

Defined results: a null text is the empty text; a null doc_id ranks last; rows
that repeat a doc_id are ranked by their place in the scan, so one of them stays.
An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortlab.llm.common import spare_names, stage, table, text_or_empty, without_white_space

BUCKET_KEYS = 4096
MAX_DEPTH = 16


def keyed(docs: DataFrame, key_bits: int) -> DataFrame:
    norm = without_white_space(text_or_empty("text"))
    out = docs.select("doc_id", F.length(text_or_empty("text")).alias("n_cp"), norm.alias("norm"))
    key = F.xxhash64("norm")
    return out.withColumn("key", key if key_bits >= 64 else F.shiftrightunsigned(key, 64 - key_bits))


def directory(keys: DataFrame, capacity: int, max_depth: int, key_bits: int = 64) -> DataFrame:
    """Directory entries ``(slot, depth, bucket)``: slot is the leading ``max_depth``
    bits of a key, depth the local depth of its bucket. At most 2^max_depth rows,
    whatever the size of the corpus. A bucket that is overfull at the last depth
    stays overfull; its keys are processed all the same."""
    bits = min(max_depth, key_bits)
    slot = F.shiftrightunsigned(F.col("key"), key_bits - bits) if bits else F.lit(0).cast("long")
    fill = stage(keys.groupBy(slot.alias("slot")).agg(F.count(F.lit(1)).alias("n")), "fill")
    at = fill.select("slot", "n", F.explode(F.sequence(F.lit(0), F.lit(bits))).alias("depth"))
    at = at.withColumn("prefix", F.expr(f"shiftright(slot, {bits} - depth)"))
    level = at.groupBy("depth", "prefix").agg(F.sum("n").alias("n"))
    # doubling: a prefix is a bucket if it fits while the prefix one bit shorter did not
    parent = level.select((F.col("depth") + 1).alias("depth"), F.col("prefix").alias("up"),
                          (F.col("n") > capacity).alias("split"))
    bucket = (level.withColumn("up", F.shiftright("prefix", 1)).join(parent, ["depth", "up"], "left")
              .filter((F.coalesce("split", F.lit(False)) | (F.col("depth") == 0))
                      & ((F.col("n") <= capacity) | (F.col("depth") == bits)))
              .select("depth", "prefix"))  # 2^bits rows at most
    return at.join(F.broadcast(bucket), ["depth", "prefix"]).select(
        "slot", "depth", F.expr(f"shiftleft(prefix, {bits} - depth)").alias("bucket"))


def exact_dedup(docs: DataFrame, capacity: int = BUCKET_KEYS, max_depth: int = MAX_DEPTH,
                key_bits: int = 64) -> dict[str, DataFrame]:
    """``rows``: one per document with its key and digest; ``index``: the chained
    entries of repeated texts; ``result``: one row per document as the query returns."""
    bits = min(max_depth, key_bits)
    rows = stage(keyed(docs, key_bits).select(
        "doc_id", "n_cp", "key", F.unhex(F.sha2("norm", 256)).alias("sha"),
        F.monotonically_increasing_id().alias("rid")), "exact-rows")
    keys = stage(rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")), "exact-keys")
    slots = directory(keys, capacity, max_depth, key_bits)
    slot = F.shiftrightunsigned(F.col("key"), key_bits - bits) if bits else F.lit(0).cast("long")
    repeated = stage(keys.filter("n > 1").withColumn("slot", slot).join(slots, "slot")
                     .select("key", "bucket", "depth"), "exact-repeated")
    # owner tasks: equal bytes become one link of their key's chain
    links = (keyed(docs, key_bits).select("key", "norm").join(repeated, "key")
             .groupBy("bucket", "depth", "key", "norm").agg(F.count(F.lit(1)).alias("copies"))
             .select("bucket", "depth", "key", F.unhex(F.sha2("norm", 256)).alias("sha"), "copies"))
    chain = Window.partitionBy("bucket", "key").orderBy("sha")
    index = stage(links.withColumn("link", F.row_number().over(chain))
                  .repartitionByRange("bucket", "key").sortWithinPartitions("bucket", "key", "link"), "exact-index")
    first = (rows.groupBy("key", "sha").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(
        (-F.col("n_cp")).alias("longest"), F.col("doc_id").isNull().alias("unnamed"), "doc_id", "rid")).alias("first"))
        .filter("n > 1"))
    groups = index.filter("copies > 1").join(first, ["key", "sha"]).select(
        "key", "sha", F.col("copies").alias("group_size"), F.col("first.doc_id").alias("keep_id"),
        F.col("first.rid").alias("keep_rid"))
    groups = stage(groups, "exact-groups")
    joined = rows.join(groups, ["key", "sha"], "left")
    single = F.col("group_size").isNull()
    result = joined.select(
        "doc_id", F.when(single, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        (single | (F.col("rid") == F.col("keep_rid"))).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"), "n_cp")
    return {"rows": rows, "index": index, "result": result}


def keep_first(docs: DataFrame, **params) -> DataFrame:
    """The rows of ``docs`` (all columns) that stay; of wholly repeated rows, one."""
    keep_id, keep_sha, keep_cp, own_sha, own_cp = spare_names(docs, "_keep_id", "_keep_sha", "_keep_cp", "_own_sha", "_own_cp")
    kept = exact_dedup(docs, **params)["result"].filter("kept").select(
        F.col("doc_id").alias(keep_id), F.unhex("text_sha256").alias(keep_sha), F.col("n_cp").alias(keep_cp))
    marked = docs.withColumns({own_sha: F.unhex(F.sha2(without_white_space(text_or_empty("text")), 256)),
                               own_cp: F.length(text_or_empty("text"))})
    on = F.col("doc_id").eqNullSafe(F.col(keep_id)) & (F.col(own_sha) == F.col(keep_sha)) & (F.col(own_cp) == F.col(keep_cp))
    # repeated rows are combined before they are shuffled
    return marked.join(kept.distinct(), on, "left_semi").dropDuplicates([own_sha, own_cp, "doc_id"]).drop(own_sha, own_cp)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))["result"].drop("n_cp")


SQL = r"""
WITH n AS (
  SELECT doc_id, length(coalesce(text, '')) AS n_cp,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS t
  FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id,
       count(*) OVER (PARTITION BY t) AS group_size,
       row_number() OVER w = 1 AS kept, sha256(t) AS text_sha256
FROM n WINDOW w AS (PARTITION BY t ORDER BY n_cp DESC, doc_id NULLS LAST)
"""
