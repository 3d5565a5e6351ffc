"""Drift checks on arriving cohort batches with Structured Streaming.

New cohort files land in a folder; each micro-batch is compared with a stored
baseline (D8-D12) inside ``foreachBatch``, and the per-feature results, the
summary and the alerts are appended to Parquet tables partitioned by batch id.
Each batch overwrites only its own partition, so a retried batch after a
failure replaces its output instead of duplicating it; the stream checkpoint
goes to the shared checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cohortlab.operators import drift as D
from cohortlab.schema import COHORT_SCHEMA
from cohortlab.session import ensure_checkpoint_dir
from cohortlab.sources.parquet import normalize_missing


def _write(df: DataFrame, path: str, batch_id: int) -> None:
    (df.withColumn("batch_id", F.lit(batch_id).cast("long"))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("batch_id").parquet(path))


def score_batch(baseline: D.Baseline, batch: DataFrame, out_dir: str, batch_id: int,
                feature_cols=None, target_col: str | None = None, edges: str = "baseline") -> None:
    """Run drift detection for one batch and write its three result tables."""
    if batch.isEmpty():
        return
    res = D.detect_drift(baseline, normalize_missing(batch), feature_cols, target_col, edges=edges)
    feats = res.features.withColumns({
        "new_categories": F.array_join("new_categories", ","),
        "missing_categories": F.array_join("missing_categories", ",")})
    _write(feats, f"{out_dir}/features", batch_id)
    _write(res.summary, f"{out_dir}/summary", batch_id)
    _write(D.alerts(res).withColumn("features", F.array_join("features", ",")), f"{out_dir}/alerts", batch_id)
    res.features.unpersist()
    res.target.unpersist()


def start_drift_monitor(spark: SparkSession, baseline_path: str, source_dir: str, out_dir: str,
                        feature_cols=None, target_col: str | None = None, schema=COHORT_SCHEMA,
                        checkpoint: str | None = None, available_now: bool = False,
                        interval: str = "1 minute", max_files_per_trigger: int | None = None,
                        transform=None) -> StreamingQuery:
    """Start the monitor; ``transform`` may clean / derive features per batch
    (the same library functions as the batch run)."""
    baseline = D.load_baseline(spark, baseline_path)
    ckpt = checkpoint or f"{ensure_checkpoint_dir(spark)}/drift-monitor"
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.parquet(source_dir)

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        data = transform(batch) if transform else batch
        score_batch(baseline, data, out_dir, batch_id, feature_cols, target_col)

    writer = stream.writeStream.foreachBatch(on_batch).option("checkpointLocation", ckpt)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)
    return writer.start()
