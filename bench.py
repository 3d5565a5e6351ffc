"""Benchmark: wall time per stage on the order-derived cohort table.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_REPEATS (timed runs per stage, default 2; the median is reported after
one warm-up run), BENCH_TREES (GBT trees, default 20).

Setup (not timed) derives the cohort table from the given tables and writes
it as Parquet in a fresh scratch folder, so every stage starts from a
Parquet scan as it would in production. Lazy stages are forced with the
``noop`` sink. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from cohortlab.operators import clean as C  # noqa: E402
from cohortlab.operators import drift as D  # noqa: E402
from cohortlab.operators import features as FE  # noqa: E402
from cohortlab.operators import model as M  # noqa: E402
from cohortlab.operators import quality as Q  # noqa: E402
from cohortlab.session import build_session  # noqa: E402
from cohortlab.sources.adapter import cohorts_from_orders  # noqa: E402
from cohortlab.sources.parquet import load_cohorts  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
REPEATS = int(os.environ.get("BENCH_REPEATS", "2"))
TREES = int(os.environ.get("BENCH_TREES", "20"))
SPLIT_DAY = "1998-04-17"
DRIFT_COLS = ["installs", "network_cost", "revenue_d7", "revenue_d30", "sessions_d1",
              "retained_users_d7", "channel", "os_name", "country_code", "game_genre"]


def force(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = build_session(f"local[{CPUS}]", shuffle_partitions=max(8, CPUS * 2),
                          extra={"spark.driver.memory": "16g"})
    scratch = tempfile.mkdtemp(prefix="cohortlab-bench-")
    src = f"{scratch}/cohorts.parquet"
    cohorts_from_orders(spark, SF_DIR).write.mode("overwrite").parquet(src)
    raw = load_cohorts(spark, src)
    n_rows = raw.count()
    # stage inputs, materialised once so each stage is timed on its own
    clean_path, feat_path = f"{scratch}/cleaned.parquet", f"{scratch}/features.parquet"
    C.clean(raw).frame.write.mode("overwrite").parquet(clean_path)
    fe0 = FE.build_features(spark.read.parquet(clean_path))
    fe0.frame.write.mode("overwrite").parquet(feat_path)
    features = fe0.features

    def ingest():
        rep = Q.profile(load_cohorts(spark, src).drop("k"))
        Q.issues(rep)

    def clean():
        cl = C.clean(load_cohorts(spark, src))
        force(cl.frame)
        cl.fix_report().collect()

    def feats():
        force(FE.build_features(spark.read.parquet(clean_path)).frame)

    def drift():
        df = spark.read.parquet(clean_path)
        base = df.filter(F.col("day") < F.lit(SPLIT_DAY).cast("date"))
        cur = df.filter(F.col("day") >= F.lit(SPLIT_DAY).cast("date")).withColumn(
            "network_cost", F.col("network_cost") * 1.5)
        bl = D.fit_baseline(base, DRIFT_COLS, "revenue_d90")
        res = D.detect_drift(bl, cur, DRIFT_COLS, "revenue_d90")
        D.alerts(res).collect()
        D.ks_two_sample(base, cur, DRIFT_COLS[:6]).collect()

    def model():
        df = M.prepare_target(spark.read.parquet(feat_path), "revenue_d90")
        df = M.assign_fold(M.assign_split(df, "k"), "k").cache()
        cfg = M.GBTConfig(n_estimators=TREES, max_depth=6, early_stopping_rounds=10)
        fit = M.fit_gbt(df.filter(F.col("split") == "train"), M.leakage_filter(features), "revenue_d90",
                        cfg, val=df.filter(F.col("split") == "val"))
        M.evaluate(fit.predict(df, "revenue_d90"), "revenue_d90", by=["split"]).collect()
        df.unpersist()

    stages = {"ingest_quality": ingest, "clean": clean, "features": feats, "drift": drift,
              "model_gbt": model}
    times = {}
    for name, fn in stages.items():
        fn()  # warm-up
        runs = []
        for _ in range(REPEATS):
            t0 = time.perf_counter()
            fn()
            runs.append(time.perf_counter() - t0)
        times[name] = round(statistics.median(runs), 3)
    sf = SF_DIR.rstrip("/").rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "cohort_stage_wall_time_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
                      "rows": n_rows, "cpus": CPUS, "gbt_trees": TREES}))
    spark.stop()


if __name__ == "__main__":
    main()
