"""Shared helpers of the training-data operators.

Intermediate tables are written as Parquet under the folder that the cluster
names in ``spark.checkpoint.dir``, so a lost executor costs a reread and never a
recomputation of earlier steps.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator

from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The ASCII white space of the contracts, [\x20\x09-\x0D].
WHITE_SPACE = [" ", "\t", "\n", "\x0b", "\x0c", "\r"]
WORD_SPLIT = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_staged: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; a local one is made only for a local session."""
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        root = tempfile.mkdtemp(prefix="cohortlab-llm-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", root)
    return root


def stage_path(spark: SparkSession, name: str) -> str:
    path = f"{shared_dir(spark).rstrip('/')}/stage/{name}-{uuid.uuid4().hex}"
    _staged.append(path)
    return path


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` into the shared folder and read it back: cuts the lineage."""
    spark = df.sparkSession
    path = stage_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession, keep: DataFrame | None = None) -> int:
    """Delete the staged tables, but those that ``keep`` still reads. Call it when
    the results built from them are written."""
    in_use = [f for f in (keep.inputFiles() if keep is not None else [])]
    jvm = spark.sparkContext._jvm
    gone = 0
    for path in list(_staged):
        mark = path.rsplit("/", 1)[-1]
        if any(f"/{mark}/" in f for f in in_use):
            continue
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
        _staged.remove(path)
        gone += 1
    return gone


class Scratch:
    """Files of one task under the shared folder, named by the Hadoop or local path ``root``."""

    def __init__(self, root: str):
        self.fs, path = fs.FileSystem.from_uri(root) if ":" in root.split("/")[0] else (fs.LocalFileSystem(), root)
        self.dir = f"{path.rstrip('/')}/{uuid.uuid4().hex}"
        self.made = False

    def write(self, blocks: Iterator[bytes]) -> str:
        if not self.made:
            self.fs.create_dir(self.dir, recursive=True)
            self.made = True
        path = f"{self.dir}/{uuid.uuid4().hex}"
        with self.fs.open_output_stream(path) as out:
            for b in blocks:
                out.write(b)
        return path

    def read(self, path: str, size: int) -> Iterator[bytes]:
        with self.fs.open_input_stream(path) as src:
            while block := src.read(size):
                yield block
        self.fs.delete_file(path)

    def close(self) -> None:
        if self.made:
            self.fs.delete_dir(self.dir)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(col: str | Column = "text") -> Column:
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def ascii_lower(col: Column) -> Column:
    return F.translate(col, UPPER, LOWER)


def without_white_space(col: Column) -> Column:
    for ch in WHITE_SPACE:
        col = F.replace(col, F.lit(ch), F.lit(""))
    return col


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of ``edges(a, b)`` (longs) as ``(node, root)``, root the
    smallest node: alternating large-star and small-star steps, each a grouped
    minimum (combined before the shuffle) and a join, staged every round. Nodes
    without an edge are not returned."""
    edges = stage(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                  .filter("u != v").distinct(), "edges")
    last = None
    for _ in range(max_rounds):
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        # every larger neighbour of u moves to u's smallest neighbour
        large = (edges.select(F.col("v").alias("u"), F.col("u").alias("v")).join(low, "u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v").distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        # u and its smaller neighbours move to the smallest of them
        small = (large.join(low, "u").select(F.explode(F.array(
            F.struct(F.col("u"), F.col("m").alias("v")),
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.*")
            .filter("u != v").distinct())
        edges = stage(small, "edges")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(now) == last:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
                edges.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
        last = tuple(now)
    raise RuntimeError("components did not settle")


def spare_names(df: DataFrame, *names: str) -> list[str]:
    """``names``, made longer until no column of ``df`` has them in any case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return out


def keep_rows(docs: DataFrame, kept: DataFrame, once: bool = False, how: str = "left_semi") -> DataFrame:
    """Rows of ``docs``, all columns, whose (doc_id, hash of the text) is in
    ``kept(doc_id, text_hash)`` (not in it for ``left_anti``); with ``once``, one of
    the rows that repeat both, which are combined before they are shuffled."""
    row_hash, kept_id, kept_hash = spare_names(docs, "_row_hash", "_kept_id", "_kept_hash")
    ids = kept.select(F.col("doc_id").alias(kept_id), F.col("text_hash").alias(kept_hash)).distinct()
    marked = docs.withColumn(row_hash, F.xxhash64(text_or_empty("text")))
    out = marked.join(ids, marked["doc_id"].eqNullSafe(ids[kept_id]) & (marked[row_hash] == ids[kept_hash]), how)
    if once:
        out = out.dropDuplicates([row_hash, "doc_id"])
    return out.drop(row_hash)


def empty_frame(spark: SparkSession, schema: str | T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def placed(df: DataFrame, key: str, order: list[str], name: str) -> DataFrame:
    """``df`` with ``place``, 1 for a key's first row by ``order`` (nulls first), staged. A
    key may hold any share of the rows: they are dealt out in ranges of key and order, and
    places counted in a range move on by the key's rows in the ranges before it. Only keys
    that span ranges need that, so the table sent out has a row for each range at most."""
    dealt = stage(df.repartitionByRange(key, *order).withColumn("in_range", F.spark_partition_id()), name)
    counts = dealt.groupBy(key, "in_range").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy(key).orderBy("in_range").rowsBetween(Window.unboundedPreceding, -1)
    moved = (counts.withColumn("earlier", F.sum("n").over(earlier)).filter("earlier > 0")
             .select(F.col(key).alias("moved_key"), F.col("in_range").alias("moved_range"), "earlier"))
    nth = F.row_number().over(Window.partitionBy(key, "in_range").orderBy(*order))
    return (dealt.withColumn("nth", nth)
            .join(F.broadcast(moved), (F.col(key) == F.col("moved_key")) & (F.col("in_range") == F.col("moved_range")), "left")
            .withColumn("place", F.col("nth") + F.coalesce("earlier", F.lit(0)))
            .drop("in_range", "nth", "moved_key", "moved_range", "earlier"))
