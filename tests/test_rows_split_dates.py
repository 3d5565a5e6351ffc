"""Row identity, exact split sizes, kept trees, date formats, drift edge cases."""

import datetime
import math

import pytest
from pyspark.sql import functions as F

from cohortlab.functions import exprs as X
from cohortlab.operators import clean as C
from cohortlab.operators import drift as D
from cohortlab.operators import model as M
from cohortlab.sources import parquet as P
from cohortlab.sources.identity import with_row_key
from conftest import cohort_frame, cohort_row


def test_row_keys_tell_copies_apart_whatever_the_partitions(spark):
    rows = [(None if k % 7 == 0 else k % 5, "a" if k % 3 else None) for k in range(60)] + [(99, "once")]
    df = spark.createDataFrame(rows, "a int, b string")
    seen = []
    for parts in (1, 4, 9):
        keyed = with_row_key(df.repartition(parts).select("b", "a"))
        got = keyed.collect()
        assert len({r.row_key for r in got}) == len(rows) == len(got)
        seen.append(sorted(r.row_key for r in got))
    assert seen[0] == seen[1] == seen[2]
    assert with_row_key(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        with_row_key(df.withColumn("row_key", F.lit(1)))


@pytest.mark.parametrize("n", [1, 2, 5, 35, 1001])
def test_exact_split_sizes(spark, n):
    df = spark.range(n).withColumn("hash_of_key", F.lit("mine"))
    got = {r["split"]: r["count"] for r in M.assign_split_exact(df.repartition(3), "id").groupBy("split").count().collect()}
    test = math.ceil(0.2 * n)
    val = math.ceil(0.2 * (n - test))
    assert (got.get("test", 0), got.get("val", 0), got.get("train", 0)) == (test, val, n - test - val)
    bits = {r.id: r.h for r in df.select("id", X.hash_bits("id", "42").alias("h")).collect()}
    chosen = {r.id for r in M.assign_split_exact(df, "id").filter("split = 'test'").collect()}
    assert chosen == set(sorted(bits, key=lambda k: (bits[k], k))[:test])


def test_first_trees_equal_a_refit(spark):
    df = spark.range(300).select((F.col("id") % 17).cast("double").alias("x"), (F.col("id") % 5).cast("double").alias("z"),
                                 F.pmod(F.col("id") * 37, F.lit(101)).cast("double").alias("label"))
    cfg = M.GBTConfig(n_estimators=6, max_depth=3)
    whole = M.fit_gbt(df, ["x", "z"], "label", cfg)
    again = M.fit_gbt(df, ["x", "z"], "label", M.GBTConfig(n_estimators=3, max_depth=3))
    cut = M.first_trees(whole.model, 3)
    assert cut.getNumTrees == 3 and list(cut.treeWeights) == list(again.model.treeWeights)
    mine = M.Fitted(model=cut, features=["x", "z"], n_trees=3)
    a, b = ([r.prediction for r in m.predict(df, "label").orderBy("x", "z", "label").collect()] for m in (mine, again))
    assert a == b
    assert mine.importance(spark).collect() == again.importance(spark).collect()


def test_early_stop_keeps_the_best_trees(spark, tmp_path):
    df = spark.range(400).select((F.col("id") % 19).cast("double").alias("x"), F.rand(3).alias("label"))
    fit = M.fit_gbt(df.filter("x < 12"), ["x"], "label", M.GBTConfig(n_estimators=8, max_depth=4, early_stopping_rounds=2),
                    val=df.filter("x >= 12"))
    assert fit.n_trees == fit.model.getNumTrees == M.best_iteration(fit.val_errors, 2)
    fit.model.write().overwrite().save(str(tmp_path / "m"))
    assert type(fit.model).load(str(tmp_path / "m")).getNumTrees == fit.n_trees


@pytest.mark.parametrize("fmt, texts", [
    ("dd.MM.yyyy", ["31.01.2024", "01.02.2024", "2024-02-01", None]),
    ("yyyy-MM-dd HH:mm:ss", ["2024-01-31 10:00:00", "2024-02-01 00:00:00", "bad", None]),
    ("yyyyMMdd", ["20240131", "20240201", "", "31.01.2024 x"])])
def test_day_format_is_inferred(spark, fmt, texts):
    df = spark.createDataFrame([(t,) for t in texts], "day string")
    assert X.infer_day_format(df) == fmt
    got = [r.d for r in df.select(X.parse_day_inferred(df).alias("d")).collect()]
    assert got == [datetime.date(2024, 1, 31), datetime.date(2024, 2, 1), None, None]


def test_days_without_a_format(spark):
    df = spark.createDataFrame([("x",), (None,)], "day string")
    assert X.infer_day_format(df) is None
    assert [r[0] for r in df.select(X.parse_day_inferred(df)).collect()] == [None, None]
    both = spark.createDataFrame([("01/02/2024",), ("03/04/2024",)], "day string")
    assert X.infer_day_format(both) == "MM/dd/yyyy"


def test_dates_and_timestamps_pass_through(spark):
    df = cohort_frame(spark, [cohort_row(), cohort_row(day="2024-03-05")])
    for kind in ("date", "timestamp"):
        typed = P.conform(df.withColumn("day", F.col("day").cast(kind)))
        assert dict(typed.dtypes)["day"] == kind
        assert [str(r.day) for r in C.standardize(typed).select("day").collect()] == ["2024-01-01", "2024-03-05"]


def test_missing_targets_can_stay_missing(spark):
    df = cohort_frame(spark, [cohort_row(), cohort_row(revenue_d90=None, revenue_d60=None)])
    kept, _ = C.fill_missing(df, fill_target=False)
    assert M.prepare_target(kept, "revenue_d90").count() == 1
    filled, fills = C.fill_missing(df)
    assert M.prepare_target(filled, "revenue_d90").count() == 2 and fills["revenue_d90"] == 1


def test_ks_of_an_empty_side(spark):
    a = spark.createDataFrame([(1.0, 1.0), (2.0, 1.0)], "x double, y double")
    b = spark.createDataFrame([(None, 1.0), (None, 2.0)], "x double, y double")
    got = {r["column"]: (r.statistic, r.p_value, r.n_a, r.n_b) for r in D.ks_two_sample(a, b, ["x", "y"]).collect()}
    assert got["x"] == (0.0, 1.0, 2, 0) and got["y"][0] == 0.5 and got["y"][2:] == (2, 2)


def test_categories_without_a_baseline_are_not_checked(spark):
    base = spark.createDataFrame([("a", None, 1.0)] * 4, "c string, d string, t double")
    now = spark.createDataFrame([("a", "new", 1.0)] * 4, "c string, d string, t double")
    b = D.fit_baseline(base, ["c", "d"], "t")
    assert [r["column"] for r in D.categorical_drift(b, now, ["c", "d"]).collect()] == ["c"]


def test_fractions_of_whole_number_columns_stay(spark):
    df = cohort_frame(spark, [cohort_row()]).withColumn("installs", F.lit(10.9))
    assert P.conform(df).first()["installs"] == 10.9
    text = P.conform(df.withColumn("installs", F.lit("12")))
    assert dict(text.dtypes)["installs"] == "bigint" and text.first()["installs"] == 12
    assert P.conform(df.withColumn("installs", F.lit("twelve"))).first()["installs"] is None


def test_rows_without_a_key_have_a_fold(spark):
    df = spark.createDataFrame([(None,), (None,), (3,)], "k long")
    assert all(r.fold is not None for r in M.assign_fold(df, "k").collect())
