"""Session settings and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_staged: dict[str, str] = {}  # of this session's staged tables: id in the path -> path


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "cohortlab", extra: dict | None = None) -> SparkSession:
    """Create or return a session with the settings the library expects.

    On a cluster pass ``master=None`` and let spark-submit decide; AQE sizes the
    shuffle partitions at run time from ``spark.sql.shuffle.partitions`` as an
    upper bound, and splits skewed join partitions.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's ``spark.checkpoint.dir``; only make a local one if unset.

    A local folder is only right for a single-machine session (tests, bench).
    """
    sc = spark.sparkContext
    current = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    local = tempfile.mkdtemp(prefix="cohortlab-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark.conf.set("spark.checkpoint.dir", local)
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir()


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back.

    Survives executor loss like a checkpoint, and later plans keep column
    pruning, pushed filters and the true size of the table.
    """
    spark = df.sparkSession
    mark = uuid.uuid4().hex
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/staged/{name}-{mark}"
    df.write.parquet(path)
    _staged[mark] = path
    return spark.read.schema(df.schema).parquet(path)


def discard(tables: list[DataFrame] | None = None) -> int:
    """Delete staged tables that nothing reads any more (None: all of the session)."""
    spark = SparkSession.getActiveSession()
    marks = list(_staged) if tables is None else [m for m in _staged for t in tables if any(m in f for f in t.inputFiles())]
    for mark in marks:
        target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_staged.pop(mark))
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
    return len(marks)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Stage ``df`` in the shared folder: later passes scan it instead of redoing its plan."""
    return staged(df, "table")
