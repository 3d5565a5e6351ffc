"""Steps whose cost must not grow with more than the input."""

import pytest
from pyspark.sql import functions as F

from cohortlab.functions import exprs as X
from cohortlab.functions import quantiles as QU
from cohortlab.operators import clean as C
from cohortlab.operators import drift as D
from cohortlab.operators import model as M
from cohortlab.plans import queries as P
from cohortlab.plans.flow import CohortRun, RunConfig
from conftest import cohort_frame, cohort_row


def plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_whole_quantiles_join_no_values(spark, monkeypatch):
    def joined(*_):
        raise AssertionError("values are joined")

    monkeypatch.setattr(QU, "_within", joined)
    df = spark.createDataFrame([(1.0, None, 5), (2.0, None, None), (float("nan"), None, 5), (4.0, None, 7)], "a double, b double, c long")
    got = {(r["column"], r["prob"]): r["value"] for r in QU.quantile_table(df, ["a", "b", "c"], [0.5, 1.0]).collect()}
    assert got == {("a", 0.5): 2.0, ("a", 1.0): 4.0, ("c", 0.5): 5.0, ("c", 1.0): 7.0}
    assert QU.quantile_values(df, ["b"], [0.5]) == {}


def test_day_format_parses_distinct_values(spark, monkeypatch):
    plans = []
    df = spark.createDataFrame([("2024-01-02",)] * 3 + [("03.01.2024",), ("04.01.2024",), ("bad",), (None,)], "day string")
    first = type(df).first
    monkeypatch.setattr(type(df), "first", lambda d: (plans.append(plan(d)), first(d))[1])
    assert X.infer_day_format(df) == "yyyy-MM-dd"
    assert X.infer_day_format(df.filter("day is null or day = 'bad'")) is None
    # the parses stand above the grouping of equal values
    lines = plans[0].splitlines()
    assert "gettimestamp" in lines[0] and any("Aggregate [" in x for x in lines[1:])
    assert not any("gettimestamp" in x for x in lines[1:])


def test_row_keys_are_made_once(spark):
    df = cohort_frame(spark, [cohort_row(installs=i % 7) for i in range(40)])
    run = CohortRun(spark, None, RunConfig(min_records=1, max_duplicate_rate=1.0))
    out = run.ingest(df)
    assert "Join" not in plan(out) and "Union" not in plan(out)
    assert out.select(run.key).distinct().count() == 40


@pytest.mark.parametrize("rows,cores,fits,want", [(97_000, 12, 1, 12), (97_000, 12, 5, 3), (3_000, 12, 1, 1), (0, 12, 1, 1),
                                                  (5_800_000, 12, 1, 12), (60_000_000, 12, 5, 60)])
def test_fit_has_as_many_tasks_as_cores(rows, cores, fits, want):
    assert M.GBTConfig().tasks(rows, cores, fits) == want


def test_fit_rows_are_dealt_evenly(spark):
    df = spark.range(200).select(F.col("id").cast("double").alias("x"), (F.col("id") * 2.0).alias("y")).coalesce(1)
    fit = M.fit_gbt(df, ["x"], "y", M.GBTConfig(n_estimators=2, max_depth=2, rows_per_task=100))
    assert fit.n_trees == 2 and fit.predict(df, "y").count() == 200


def test_category_values_are_counted_once(spark):
    df = spark.createDataFrame([("x",), ("x",), ("y",), (None,)], "a string")
    shares = D.category_shares(df, ["a"])
    assert "Generate" not in plan(shares)
    assert {(r["value"], r["count"], r["rank"]) for r in shares.collect()} == {("x", 2, 1), ("y", 1, 2)}


def test_drift_writes_what_it_reads(spark, monkeypatch):
    rows = cohort_frame(spark, [cohort_row(installs=100 + i, channel="Face-Book _9K") for i in range(4)]).withColumn("k", F.col("installs"))
    monkeypatch.setattr(P, "raw", lambda *_: rows)
    base, current = P.drift_frames(spark, None)
    assert "revenue_d60" not in base.columns and base.unionByName(current).count() == 4
    assert {r["channel"] for r in rows.select(X.norm_channel("channel").alias("channel")).collect()} == {"facebook_9k"}
    assert "revenue_d60" in P.cleaned(spark, None).frame.columns


def test_caps_are_fitted_on_written_rows(spark, monkeypatch):
    seen, fit = [], C.fit_caps
    monkeypatch.setattr(C, "fit_caps", lambda df, *args: (seen.append(plan(df)), fit(df, *args))[1])
    rows = cohort_frame(spark, [cohort_row(installs=100 + i, revenue_d1=float(i), channel="Face-Book", network_cost=None if i == 3 else 5.0)
                                for i in range(8)])
    whole = C.clean(rows, write=True)
    some = C.clean(rows, columns=["day", "installs", "revenue_d1"], write=True)
    for text in (*seen, plan(whole.frame), plan(some.frame)):
        assert "regexp_replace" not in text and "Join" not in text and "gettimestamp" not in text
    assert whole.caps == some.caps and some.frame.columns == ["day", "installs", "revenue_d1"]
    assert whole.frame.columns == rows.columns and whole.fills == {"network_cost": 1}
    want = sorted(tuple(r) for r in whole.frame.select(*some.frame.columns).collect())
    assert sorted(tuple(r) for r in some.frame.collect()) == want


def test_whole_quantiles_count_by_one_number(spark, monkeypatch):
    plans, staged = [], QU.staged
    monkeypatch.setattr(QU, "staged", lambda df, name: (plans.append(plan(df)), staged(df, name))[1])
    df = spark.createDataFrame([(float(i), -float(i * i)) for i in range(101)], "a double, b double")
    for bins in (2, 7, QU.BINS):
        got = {(r["column"], r["prob"]): r["value"] for r in QU.quantile_table(df, ["a", "b"], [0.25, 0.99], bins=bins).collect()}
        assert got == {("a", 0.25): 25.0, ("a", 0.99): 99.0, ("b", 0.25): -5625.0, ("b", 0.99): -1.0}
    assert all("Aggregate [key" in p for p in plans)


def test_ks_values_carry_no_names(spark):
    a = spark.createDataFrame([(1.0, None), (2.0, float("nan")), (3.0, 4.0)], "long_name double, other_name double")
    b = spark.createDataFrame([(2.5, 4.0), (3.5, None)], "long_name double, other_name double")
    found = D.ks_two_sample(a, b, ["other_name", "long_name"])
    got = {r["column"]: (round(r["statistic"], 6), r["n_a"], r["n_b"]) for r in found.collect()}
    assert got == {"long_name": (0.666667, 3, 2), "other_name": (0.0, 1, 1)}
    assert "posexplode(" in found._jdf.queryExecution().analyzed().toString()


def test_title_case_of_one_run(spark):
    texts = ["puzzle", "STRATEGY ", "abc\n", "role-playing", "match-3 casual", " lead", "ßa", "éCOLE x", "", "  ", None]
    want = ["Puzzle", "Strategy", "Abc", "Role-Playing", "Match-3 Casual", "Lead", "SSa", "École X", "", "", None]
    df = spark.createDataFrame(list(zip(range(len(texts)), texts)), "i int, t string")
    assert [r["x"] for r in df.select("i", X.title_case("t").alias("x")).orderBy("i").collect()] == want


def test_filled_values_are_counted_few_columns_at_a_time(spark):
    df = spark.createDataFrame([(1, 0, None, 2.5), (0, 0, 3, 0.0)], "a long, b long, c long, d double")
    got = P._filled_values(df, ["a", "b", "c", "d"], together=3)
    assert plan(got).count("count_if") + plan(got).count("count(") == 4 and plan(got).count("Aggregate") == 2
    assert {r["column"]: r["filled"] for r in got.collect()} == {"a": 1, "b": 0, "c": 1, "d": 1}
