"""Scalar expressions and the exact quantile operator."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortlab.functions import exprs as X
from cohortlab.functions.quantiles import quantile_table, quantile_values, weighted_quantile


def _col(spark, values, fn, dtype="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {dtype}")
    return [r[0] for r in df.select(fn(F.col("x"))).collect()]


def test_norm_channel(spark):
    got = _col(spark, ["Facebook", "fb", "meta ", "Google-Ads", "google_ads", "GOOGLE",
                       "Unity Ads", "unityads", "ironSource", "tiktok", None], X.norm_channel)
    assert got == ["facebook", "facebook", "facebook", "google", "google", "google",
                   "unity", "unity", "ironsource", "tiktok", None]


def test_norm_country(spark):
    got = _col(spark, ["US", "us ", "USA", "UK", "United Kingdom", "\tgb", "X1", None, "DEU"],
               X.norm_country)
    assert got == ["US", "US", "US", "GB", "GB", "GB", "XX", "XX", "XX"]


def test_norm_os(spark):
    got = _col(spark, ["iOS", "ios 17", "iPhone", "iPad OS", "Android", "ANDROID",
                       "android tv", "Web", "kaios", "iphone android", None], X.norm_os)
    assert got == ["iOS", "iOS", "iOS", "iOS", "Android", "Android", "Android", "web", "iOS",
                   "iOS", None]


@pytest.mark.parametrize("text", ["role-playing", "kid's game", "match-3 casual", "STRATEGY ",
                                  "rpg", "  multi  word  genre ", "x", ""])
def test_title_case_matches_python(spark, text):
    assert _col(spark, [text], X.title_case) == [text.title().strip()]


def test_parse_day(spark):
    df = spark.createDataFrame([("2024-01-05",), ("bad-date",), (None,)], "d string")
    got = [r[0] for r in df.select(X.parse_day("d")).collect()]
    assert str(got[0]) == "2024-01-05" and got[1] is None and got[2] is None


def test_clips_keep_null(spark):
    df = spark.createDataFrame([(None,), (-2.0,), (5.0,)], "x double")
    got = [r[0] for r in df.select(X.clip("x", 0, 3)).collect()]
    assert got == [None, 0.0, 3.0]


def test_ratio_floors_denominator(spark):
    df = spark.createDataFrame([(10.0, 0.0), (10.0, 4.0)], "a double, b double")
    got = [r[0] for r in df.select(X.ratio("a", "b", 1)).collect()]
    assert got == [10.0, 2.5]


@pytest.mark.parametrize("n,dups,seed", [(1, False, 0), (2, False, 1), (57, False, 2),
                                        (1000, True, 3), (5000, False, 4)])
def test_exact_quantiles_match_numpy(spark, n, dups, seed):
    rng = np.random.default_rng(seed)
    x = rng.integers(0, 20, n).astype(float) if dups else rng.normal(0, 1, n)
    y = rng.lognormal(0, 2, n)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, y)], "x double, y double")
    probs = [0.0, 0.01, 0.25, 0.5, 0.9, 0.99, 1.0]
    # few bins leave many values for the last step; results must still be exact
    for bins in (4096, 2):
        q = {(r["column"], r["prob"]): r["value"] for r in quantile_table(df, ["x", "y"], probs, bins=bins).collect()}
        for p in probs:
            assert q[("x", p)] == pytest.approx(np.quantile(x, p), rel=1e-12, abs=1e-12)
            assert q[("y", p)] == pytest.approx(np.quantile(y, p), rel=1e-12, abs=1e-12)


def test_exact_quantiles_of_hard_values(spark):
    # far outliers, one value that most rows have, equal logarithms, NaN and NULL
    x = [-1e300, -0.0, 0.0, 1e-300, 5.0, 5.000000000000001, 1e15, 1e15 + 0.125, 1e300] + [7.25] * 40
    df = spark.createDataFrame([(v,) for v in x] + [(float("nan"),), (None,)], "x double")
    probs = [i / 97 for i in range(98)]
    for bins, levels in ((1 << 14, 1), (16, 2), (3, 1)):
        q = {r["prob"]: r["value"] for r in quantile_table(df, ["x"], probs, bins=bins, levels=levels).collect()}
        for p in probs:
            v, pos = sorted(x), p * (len(x) - 1)
            low, high = v[math.floor(pos)], v[math.ceil(pos)]
            assert q[p] == (low if low == high else low + (pos - math.floor(pos)) * (high - low))


def test_grouped_quantiles_skip_null_groups(spark):
    rows = [("a", float(v)) for v in range(10)] + [("b", 7.0)] + [(None, 100.0), ("c", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r["g"]: r["value"] for r in quantile_table(df, ["v"], [0.5], by=["g"]).collect()}
    assert got == {"a": 4.5, "b": 7.0}


def test_quantile_methods_agree_on_small_data(spark):
    df = spark.range(101).select(F.col("id").cast("double").alias("v"))
    exact = quantile_values(df, ["v"], [0.5, 0.95])
    spark_exact = quantile_values(df, ["v"], [0.5, 0.95], method="spark")
    assert exact == spark_exact == {("v", 0.5): 50.0, ("v", 0.95): 95.0}


def test_weighted_quantile_equals_row_quantile(spark):
    counts = [("a", 5), ("b", 1), ("c", 3), ("d", 3)]
    df = spark.createDataFrame(counts, "v string, f long")
    rows = np.concatenate([[f] * f for _, f in counts]).astype(float)
    assert weighted_quantile(df, "f", "f", 0.8) == pytest.approx(np.quantile(rows, 0.8))


def test_hash_bits_is_deterministic_and_in_range(spark):
    df = spark.range(1000)
    a = df.select(X.hash_bits("id", "42").alias("h")).collect()
    b = df.repartition(7).select("id", X.hash_bits("id", "42").alias("h")).orderBy("id").collect()
    assert [r.h for r in a] == [r.h for r in b]
    assert all(0 <= r.h < 2 ** 32 for r in a)


def test_approx_quantiles_within_rank_error(spark):
    rng = np.random.default_rng(7)
    x = rng.normal(0, 1, 20000)
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    q = quantile_values(df, ["x"], [0.1, 0.5, 0.9], method="approx", accuracy=1000)
    xs = np.sort(x)
    for p in (0.1, 0.5, 0.9):
        rank = np.searchsorted(xs, q[("x", p)]) / len(xs)
        assert abs(rank - p) <= 2.0 / 1000
