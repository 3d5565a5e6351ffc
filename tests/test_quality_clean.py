"""Ingestion, quality profile and gates (S1, Q1-Q10); cleaning (C, T, R, O)."""

import pytest
from pyspark.sql import functions as F

from cohortlab import schema as S
from cohortlab.operators import clean as C
from cohortlab.operators import quality as Q
from cohortlab.sources import parquet as P
from conftest import cohort_frame, cohort_row


def dirty(spark):
    """The reference's three-row dirty frame, completed to all 27 columns."""
    return cohort_frame(spark, [
        cohort_row(campaign_id="camp_1", network_cost=100.0, channel="Facebook", country_code="US",
                   installs=100, retained_users_d1=50, revenue_d1=100.0, revenue_d7=200.0,
                   revenue_d30=500.0, revenue_d90=1000.0, os_name="iPhone", game_genre="role-playing"),
        cohort_row(campaign_id=None, network_cost=None, channel="fb", country_code="usa",
                   installs=-10, retained_users_d1=150, revenue_d1=200.0, revenue_d7=150.0,
                   revenue_d30=600.0, revenue_d90=1200.0, os_name="android tv", day="bad-date"),
        cohort_row(campaign_id="camp_3", network_cost=200.0, channel="GOOGLE", country_code="GB",
                   installs=200, retained_users_d1=80, revenue_d1=300.0, revenue_d7=400.0,
                   revenue_d30=700.0, revenue_d90=1400.0, game_genre="STRATEGY "),
    ])


# -- S1 / Q1 -----------------------------------------------------------------

def test_load_missing_path_raises(spark):
    with pytest.raises(FileNotFoundError):
        P.load_cohorts(spark, "/nonexistent/cohorts.parquet")


def test_load_empty_raises(spark, tmp_path):
    cohort_frame(spark, []).write.parquet(str(tmp_path / "empty"))
    with pytest.raises(ValueError):
        P.load_cohorts(spark, str(tmp_path / "empty"))


def test_load_roundtrip_and_nan_to_null(spark, tmp_path):
    df = cohort_frame(spark, [cohort_row(network_cost=float("nan")), cohort_row()])
    df.write.parquet(str(tmp_path / "c"))
    got = P.load_cohorts(spark, str(tmp_path / "c"))
    assert got.count() == 2
    assert got.filter(F.col("network_cost").isNull()).count() == 1


def test_validate_schema(spark):
    df = cohort_frame(spark, [cohort_row()])
    P.validate_schema(df)
    with pytest.raises(ValueError):
        P.validate_schema(df.drop("installs"))


# -- Q2-Q9 -----------------------------------------------------------------------

def test_profile_counts(spark):
    rows = [cohort_row(), cohort_row(), cohort_row(campaign_id=None, installs=-5, day="x"),
            cohort_row(campaign_id=None, installs=-5, day="x"), cohort_row(day="2024-03-01")]
    rep = Q.profile(cohort_frame(spark, rows))
    assert rep.total_records == 5 and rep.total_columns == 27
    assert rep.duplicate_count == 2          # NULLs compare equal
    assert rep.missing == {"campaign_id": pytest.approx(0.4)}
    assert rep.date_range == {"min": "2024-01-01", "max": "2024-03-01", "span_days": 60}
    assert rep.categorical["channel"] == 1
    assert rep.numerical["installs"]["negative_count"] == 2
    assert rep.numerical["installs"]["median"] == 100.0


def test_quality_gate(spark):
    rep = Q.profile(cohort_frame(spark, [cohort_row(), cohort_row(campaign_id=None)]))
    Q.validate_quality(rep, min_records=2, max_duplicate_rate=0.0, max_missing_rate=0.5)
    with pytest.raises(ValueError) as err:
        Q.validate_quality(rep, min_records=10, max_duplicate_rate=0.0, max_missing_rate=0.1)
    assert "min_records" in str(err.value) and "missing_rate" in str(err.value)
    assert [i[1] for i in Q.soft_issues(rep, min_records=10)] == ["min_records"]


def test_all_missing_and_constant_columns(spark):
    df = spark.createDataFrame([(None, 100), (None, 100), (None, 100)], "col1 double, installs long")
    rep = Q.profile(df)
    assert rep.missing == {"col1": 1.0}
    assert rep.numerical["installs"]["min"] == rep.numerical["installs"]["max"] == 100.0


# -- C ------------------------------------------------------------------------

def test_fill_missing(spark):
    out, fills = C.fill_missing(dirty(spark))
    rows = out.collect()
    assert rows[1]["campaign_id"] == "unknown"
    # 'fb' has no known cost -> global median of costs after the group fill
    assert rows[1]["network_cost"] == 150.0
    assert fills == {"campaign_id": 1, "network_cost": 1}


def test_group_median_fill_uses_raw_channel(spark):
    rows = [cohort_row(channel="a", network_cost=10.0), cohort_row(channel="a", network_cost=30.0),
            cohort_row(channel="a", network_cost=None), cohort_row(channel="b", network_cost=1000.0),
            cohort_row(channel=None, network_cost=None)]
    out, _ = C.fill_missing(cohort_frame(spark, rows))
    got = [r["network_cost"] for r in out.collect()]
    # group 'a' median 20; the NULL channel row takes the median after that fill
    assert got == [10.0, 30.0, 20.0, 1000.0, 25.0]


# -- T ------------------------------------------------------------------------

def test_standardize(spark):
    out = C.standardize(dirty(spark)).collect()
    assert [r["channel"] for r in out] == ["facebook", "facebook", "google"]
    assert [r["country_code"] for r in out] == ["US", "US", "GB"]
    assert [r["os_name"] for r in out] == ["iOS", "Android", "iOS"]
    assert [r["game_genre"] for r in out] == ["Role-Playing", "RPG".title(), "Strategy"]
    assert out[1]["day"] is None and str(out[0]["day"]) == "2024-01-01"


# -- R ------------------------------------------------------------------------

def test_repair(spark):
    flagged = C.repair(C.standardize(C.fill_missing(dirty(spark))[0]))
    out = C.drop_fix_flags(flagged).collect()
    for r in out:
        assert r["installs"] >= 0
        rets = [r[c] for c in S.RETENTION_COLS]
        assert all(x <= r["installs"] for x in rets)
        assert rets == sorted(rets, reverse=True)
        revs = [r[c] for c in S.REVENUE_COLS]
        assert revs == sorted(revs)
        assert r["payers_d7"] <= r["retained_users_d7"] and r["payers_d30"] <= r["retained_users_d30"]
    fixes = {r["fix"]: r["rows"] for r in C.fix_report(flagged).collect()}
    assert fixes["installs_negative"] == 1
    assert fixes["retained_users_d1_exceeds_installs"] == 1
    assert fixes["revenue_d7_less_than_revenue_d3"] == 1
    assert fixes["revenue_component_mismatch"] == 3
    assert fixes["payers_d7_exceeds_retention"] == 1
    assert all(v > 0 for v in fixes.values())


def test_cascade_needs_adjacent_columns(spark):
    # without d3 the d1 -> d7 pair is never compared (reference behaviour)
    df = cohort_frame(spark, [cohort_row(revenue_d1=100.0, revenue_d7=50.0)]).drop("revenue_d3")
    out = C.drop_fix_flags(C.repair(df)).first()
    assert out["revenue_d7"] == 50.0


def test_repair_is_idempotent(spark):
    once = C.drop_fix_flags(C.repair(C.standardize(C.fill_missing(dirty(spark))[0])))
    twice = C.repair(once)
    # a component mismatch is counted even when max() leaves the value as it is
    assert {r["fix"] for r in C.fix_report(twice).collect()} <= {"revenue_component_mismatch"}
    assert sorted(map(repr, C.drop_fix_flags(twice).collect())) == sorted(map(repr, once.collect()))


# -- O ------------------------------------------------------------------------

def test_cap_outliers(spark):
    df = spark.createDataFrame([(100.0, 100.0), (200.0, 200.0), (300.0, 300.0), (10000.0, 50000.0)],
                               "network_cost double, revenue_d30 double")
    caps = C.fit_caps(df)
    assert caps["network_cost"] == pytest.approx(300 + 0.97 * 9700)
    out = C.apply_caps(df, caps).collect()
    assert out[-1]["network_cost"] < 10000 and out[-1]["revenue_d30"] < 50000
    rep = {r["column"]: r["count"] for r in C.cap_report(df, caps).collect()}
    assert rep == {"network_cost": 1, "revenue_d30": 1}


def test_extreme_outlier_p95(spark):
    df = spark.createDataFrame([(100.0,), (200.0,), (300.0,), (1000000.0,)], "network_cost double")
    caps = C.fit_caps(df, percentile=0.95)
    assert C.apply_caps(df, caps).agg(F.max("network_cost")).first()[0] < 1000000


def test_clean_summary_and_impact(spark):
    raw = dirty(spark)
    cl = C.clean(raw)
    nulls = {r["column"]: r["null_count"] for r in C.null_count_frame(cl.frame).collect()}
    assert nulls["day"] == 1 and nulls["campaign_id"] == 0 and nulls["network_cost"] == 0
    imp = {(r["column"], r["stat"]): r for r in Q.impact_frame(raw, cl.frame).collect()}
    assert imp[("channel", "n_distinct")]["before"] == 3 and imp[("channel", "n_distinct")]["after"] == 2
    assert imp[("installs", "min")]["changed"]


def test_duplicate_count_methods_agree(spark):
    rows = [cohort_row(installs=i % 7, campaign_id=None if i % 5 == 0 else "c") for i in range(200)]
    df = cohort_frame(spark, rows)
    full = df.count() - df.distinct().count()
    assert full == 200 - len({(i % 7, i % 5 == 0) for i in range(200)})
    assert Q.duplicate_count(df) == full
    assert Q.duplicate_count(cohort_frame(spark, [cohort_row(installs=i) for i in range(50)])) == 0
    signed = cohort_frame(spark, [cohort_row(network_cost=0.0), cohort_row(network_cost=-0.0)])
    assert Q.duplicate_count(signed) == 1


def test_conform_casts_declared_types(spark):
    df = cohort_frame(spark, [cohort_row()]).withColumn("installs", F.lit("12x")).withColumn(
        "network_cost", F.lit("3.5"))
    out = P.conform(df).first()
    assert out["installs"] is None and out["network_cost"] == 3.5
