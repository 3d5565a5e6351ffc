"""Whole run (P1-P3, S2-S5) and the driver contract, against DuckDB."""

import json
import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from cohortlab.operators import model as M
from cohortlab.plans.flow import CohortRun, RunConfig
from cohortlab.plans.queries import raw, registry
from conftest import SF_SMALL
from oracle.queries_sql import oracle_queries

ROWS_ONLY = {"gbt_predict", "gbt_cv", "gbt_importance", "metric_report", "run_summary"}


def test_run_all_exports(spark, tmp_path):
    cfg = RunConfig(gbt=M.GBTConfig(n_estimators=5, max_depth=3, early_stopping_rounds=2), run_cv=False)
    run = CohortRun(spark, str(tmp_path), cfg)
    s = run.run_all(raw(spark, SF_SMALL))
    assert s["raw_records"] == 1522 and s["n_features"] == 59 and s["model_trained"]
    ex = s["export"]
    assert ex["train_records"] + ex["test_records"] == ex["total_predictions"] == 1522
    assert os.path.exists(tmp_path / "models" / "latest" / "model")
    meta = spark.read.text(str(tmp_path / "models" / "latest" / "model_metadata.json")).first()[0]
    assert json.loads(meta)["target_column"] == "revenue_d90"
    pred = spark.read.parquet(ex["export_paths"]["predictions"])
    assert set(pred.columns) >= {"prediction", "revenue_d90", "channel", "day"}


def test_stage_needs_input(spark):
    with pytest.raises(RuntimeError):
        CohortRun(spark).preprocess()


def test_gate_stops_run(spark):
    with pytest.raises(ValueError):
        CohortRun(spark, cfg=RunConfig(min_records=10 ** 9)).ingest(raw(spark, SF_SMALL))


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "avg_roas_d7" in df.columns


def test_registry_has_oracles():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert set(registry()) - set(oracle_queries()) == ROWS_ONLY


def _rows(pdf):
    cols = sorted(pdf.columns)
    fix = lambda v: None if (v is None or (isinstance(v, float) and math.isnan(v))) else v
    return sorted((tuple(fix(r[c]) for c in cols) for r in pdf.to_dict("records")), key=repr)


@pytest.mark.parametrize("name", ["channel_roas", "fix_report", "cap_report", "enc_common",
                                  "eval_metrics", "drift_summary"])
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in ("orders", "customer", "lineitem"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_SMALL}/{t}.parquet'")
    sp = E.queries()[name](spark, SF_SMALL).toPandas()
    dd = con.execute(E.oracle_sql()[name]).df()
    assert sorted(sp.columns) == sorted(dd.columns)
    assert _rows(sp) == _rows(dd)
