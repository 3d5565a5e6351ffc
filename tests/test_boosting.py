"""Fits in shared passes: the trees of Spark ML, few jobs, odd rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortlab.operators import boosting as B
from cohortlab.operators import model as M

FEATS = ["a", "b", "c", "d"]


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(7)
    n = 2_400
    a, b, d = rng.normal(0, 1, n), rng.gamma(1, 40, n), rng.normal(3, 1, n)
    y = 200 + 90 * a + b * d + rng.normal(0, 5, n)
    found = [(i, float(p), float(q), 1.0, float(r), float(t)) for i, (p, q, r, t) in enumerate(zip(a, b, d, y))]
    df = spark.createDataFrame(found, "k long, a double, b double, c double, d double, t double")
    return M.assign_fold(M.assign_split(df, "k"), "k").repartition(3).cache()


def test_trees_are_those_of_spark_ml(rows):
    cfg = M.GBTConfig(n_estimators=8, max_depth=3)
    train, val = rows.filter("split = 'train'"), rows.filter("split = 'val'")
    fit = M.fit_gbt(train, FEATS, "t", cfg, val=val)
    theirs = cfg.estimator().fit(M.assemble(train, FEATS, "t").select("features", "label").coalesce(1).cache())
    mine = fit.model
    assert [t.numNodes for t in mine.trees] == [t.numNodes for t in theirs.trees][:fit.n_trees]
    assert fit.val_errors == pytest.approx(theirs.evaluateEachIteration(M.assemble(val, FEATS, "t").select("features", "label"), "squared"), rel=1e-9)
    assert fit.n_trees == 8
    assert mine.featureImportances.toArray() == pytest.approx(theirs.featureImportances.toArray(), rel=1e-9)
    for t, u in zip(mine.trees, theirs.trees):
        for p, q in ((t._java_obj.rootNode(), u._java_obj.rootNode()), (t._java_obj.rootNode().leftChild(), u._java_obj.rootNode().leftChild())):
            assert [p.impurity(), p.prediction(), p.gain()] == pytest.approx([q.impurity(), q.prediction(), q.gain()], rel=1e-9)
            assert p.split().threshold() == q.split().threshold()
    got, want = ([r.prediction for r in m.predict(rows, "t").orderBy("k").collect()] for m in (fit, M.Fitted(theirs, FEATS, 8)))
    assert got == pytest.approx(want, rel=1e-9)


def test_folds_share_their_jobs(spark, rows):
    cfg = M.GBTConfig(n_estimators=4, max_depth=3)
    spark.sparkContext.setJobGroup("folds", "")
    per_fold, _ = M.cross_validate(rows, FEATS, "t", cfg, parallelism=5)
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("folds"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs < 4 * 3 + 15  # a job a level for all five fits, before two a level for each
    want = []
    for f in range(5):
        theirs = cfg.estimator().fit(M.assemble(rows.filter(F.col("fold") != f), FEATS, "t").select("features", "label").coalesce(1).cache())
        want.append(M.evaluate(M.Fitted(theirs, FEATS, 4).predict(rows.filter(F.col("fold") == f), "t")).first()["rmse"])
    assert [r.rmse for r in per_fold.orderBy("fold").collect()] == pytest.approx(want, rel=1e-9)
    one_by_one, _ = M.cross_validate(rows, FEATS, "t", cfg, parallelism=2)
    assert [r.rmse for r in one_by_one.orderBy("fold").collect()] == pytest.approx(want, rel=1e-9)


def test_small_results_take_more_passes(rows, monkeypatch):
    cfg = M.GBTConfig(n_estimators=3, max_depth=4, rows_per_task=500)
    whole = M.fit_gbt(rows, FEATS, "t", cfg)
    monkeypatch.setattr(B, "RESULT_BYTES", 1)  # a node at a time
    nodewise = M.fit_gbt(rows, FEATS, "t", cfg)
    assert [t.toDebugString.split("\n", 1)[1] for t in whole.model.trees] == [t.toDebugString.split("\n", 1)[1] for t in nodewise.model.trees]


def test_predictions_are_made_again_where_they_are_lost():
    rng = np.random.default_rng(1)
    block = rng.integers(0, 9, (2, 40)).astype(np.uint8), rng.normal(size=40), np.zeros(40, np.int32)
    trees = B.made(2, rng.integers(0, 2, (5, 1, 4)), rng.integers(0, 9, (5, 1, 4)), rng.normal(size=(5, 1, 4)), 0.1)
    first = B.made(2, trees.feature[:3], trees.cut[:3], trees.value[:3], 0.1)
    B.predictions("one", (0, 0), block, first)
    kept = B.predictions("one", (0, 0), block, trees)
    assert (kept == B.predictions("two", (0, 0), block, trees)).all()
    assert (B.predictions("two", (0, 0), block, first) == B.predictions("three", (0, 0), block, first)).all()


@pytest.mark.parametrize("values, bins, want", [
    ([3.0, 1.0, 1.0, 2.0], 8, [1.5, 2.5]), ([5.0, 5.0], 8, []), ([], 8, []), ([1.0, float("nan"), 2.0], 8, [1.5]),
    ([0.0, 0.0, 0.0, 1.0, 2.0, 3.0], 2, [0.5]), (list(range(100)), 4, [24.5, 49.5, 74.5])])
def test_thresholds(values, bins, want):
    assert B.thresholds(np.array(values, float), bins).tolist() == want


def test_odd_tables(spark):
    cfg = M.GBTConfig(n_estimators=3, max_depth=3)
    flat = spark.range(10).select(F.lit(1.0).alias("x"), F.lit(5.0).alias("t"))
    fit = M.fit_gbt(flat, ["x"], "t", cfg)
    assert {r.prediction for r in fit.predict(flat, "t").collect()} == {5.0}
    assert {r.prediction for r in M.fit_gbt(flat.limit(1), ["x"], "t", cfg).predict(flat, "t").collect()} == {5.0}
    with pytest.raises(ValueError):
        M.fit_gbt(flat.limit(0), ["x"], "t", cfg)
    for c in ("x", "t"):
        with pytest.raises(Exception, match="must not be NULL"):
            M.fit_gbt(flat.withColumn(c, F.lit(None).cast("double")), ["x"], "t", cfg)
