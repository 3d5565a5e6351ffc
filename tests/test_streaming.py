"""Drift monitor over arriving batches (Structured Streaming, foreachBatch)."""

from pyspark.sql import functions as F

from cohortlab.operators import drift as D
from cohortlab.plans.queries import cleaned, DRIFT_CATEGORICAL, DRIFT_NUMERIC
from cohortlab.streaming.drift_monitor import start_drift_monitor
from conftest import SF_SMALL


def test_stream_scores_each_batch(spark, tmp_path):
    df = cleaned(spark, SF_SMALL).frame
    base = df.filter(F.col("day") < F.lit("1998-04-17").cast("date"))
    cur = df.filter(F.col("day") >= F.lit("1998-04-17").cast("date"))
    bl = D.fit_baseline(base, DRIFT_NUMERIC + DRIFT_CATEGORICAL, "revenue_d90")
    D.save_baseline(bl, str(tmp_path / "baseline"))
    src = tmp_path / "incoming"
    # two arriving files: the current period as is, and with a cost shift
    cur.write.mode("append").parquet(str(src))
    cur.withColumn("network_cost", F.col("network_cost") * 3).write.mode("append").parquet(str(src))
    schema = spark.read.parquet(str(src)).schema
    q = start_drift_monitor(spark, str(tmp_path / "baseline"), str(src), str(tmp_path / "out"),
                            DRIFT_NUMERIC + DRIFT_CATEGORICAL, "revenue_d90", schema=schema,
                            checkpoint=str(tmp_path / "ckpt"), available_now=True, max_files_per_trigger=1)
    q.awaitTermination(300)
    summ = spark.read.parquet(str(tmp_path / "out" / "summary"))
    assert summ.count() == 2
    feats = spark.read.parquet(str(tmp_path / "out" / "features"))
    psi = {r["batch_id"]: r["psi"] for r in feats.filter(F.col("column") == "network_cost").collect()}
    assert len(psi) == 2 and max(psi.values()) > 0.25
    assert spark.read.parquet(str(tmp_path / "out" / "alerts")).count() >= 1
