"""Features (F1-F22, E1-E10) and modelling (M1-M11)."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cohortlab.operators import features as FE
from cohortlab.operators import model as M
from conftest import cohort_frame, cohort_row


def test_row_features_hand_computed(spark):
    df = cohort_frame(spark, [cohort_row()])
    created = []
    r = FE.row_features(df, created).first()
    assert r["retention_rate_d7"] == 0.3
    assert r["retention_decay_d1_d7"] == pytest.approx(0.2)
    assert r["retention_stability"] == pytest.approx(0.1 / 0.5)
    assert r["arpi_d30"] == 1.6 and r["arpu_d7"] == pytest.approx(40 / 30)
    assert r["revenue_growth_d1_d7"] == 4.0 and r["revenue_growth_d1_d30"] == 16.0
    assert r["revenue_acceleration"] == 1.0
    assert r["early_monetization_ratio"] == 0.25
    assert r["payer_conversion_d30"] == 0.05 and r["arppu_d30"] == 32.0
    assert r["iap_revenue_share"] == 0.625 and r["is_hybrid_monetization"] == 1
    assert r["is_iap_dominant"] == 0 and r["is_ad_dominant"] == 0
    assert r["sessions_per_retained_d1"] == 2.4 and r["session_growth_d1_d7"] == 2.5
    assert r["revenue_per_session_d7"] == pytest.approx(40 / 300)
    assert r["cpi"] == 2.0 and r["roas_d30"] == 0.8 and r["is_profitable_d30"] == 0
    assert r["cost_per_retained_d30"] == 20.0
    assert len(created) == 8 + 12 + 9 + 7 + 8


def test_floors_and_caps(spark):
    df = cohort_frame(spark, [cohort_row(installs=0, revenue_d1=0.0, revenue_d7=5.0, network_cost=0.0,
                                         retained_users_d1=0, sessions_d1=0.0)])
    r = FE.row_features(df).first()
    assert r["arpi_d7"] == 5.0                      # installs floored at 1
    assert r["revenue_growth_d1_d7"] == 50.0        # 5 / 0.01 capped at 50
    assert r["retention_stability"] == 10 / 0.001   # rate_d1 floored at 0.001
    assert r["session_growth_d1_d7"] == 20.0        # capped at 20
    assert r["roas_d7"] == 500.0                    # cost floored at 0.01


def test_encodings_match_pandas(spark):
    rng = np.random.default_rng(42)
    n = 100
    rows = [cohort_row(game_genre=str(g), os_name=str(o), country_code=c, channel=ch)
            for g, o, c, ch in zip(rng.choice(["RPG", "Strategy", "Casual"], n, p=[.6, .3, .1]),
                                   rng.choice(["iOS", "Android"], n),
                                   rng.choice(["US", "GB", "DE", None], n),
                                   rng.choice(["facebook", "google", "unity"], n))]
    df = cohort_frame(spark, rows)
    fe = FE.build_features(df)
    out = fe.frame.toPandas()
    pdf = pd.DataFrame(rows)
    for c in ["game_genre", "os_name", "country_code", "channel"]:
        freq = pdf[c].map(pdf[c].value_counts().to_dict())
        thr = freq.quantile(0.8)
        assert (out[f"{c}_frequency"].values == freq.fillna(0).values).all()
        assert (out[f"{c}_is_common"].values == (freq > thr).astype(int).values).all()
    assert (out["is_ios"] == (pdf["os_name"] == "iOS").astype(int)).all()
    assert (out["is_tier1_country"] == pdf["country_code"].isin(["US", "GB", "DE"]).astype(int)).all()
    assert len(fe.features) == 59 and fe.features == sorted(fe.features)
    assert out[fe.features].isnull().sum().sum() == 0
    assert out["early_performance_score"].between(0, 1).all()


def test_feature_stats_groups_overlap():
    feats = ["retention_rate_d1", "is_ios", "arpi_d7", "payer_conversion_d7", "roas_d7", "revenue_growth_d1_d7"]
    stats = dict(FE.feature_stats(feats, feats, 27))
    assert stats["group_revenue"] == 2 and stats["group_categorical"] == 1
    assert stats["final_feature_count"] == 6


def test_leakage_filter():
    assert M.leakage_filter(["arpi_d30", "revenue_d60", "x_D90", "roas_d7"]) == ["arpi_d30", "roas_d7"]


def test_prepare_target(spark):
    df = spark.createDataFrame([(1, 5.0), (2, None), (3, -4.0)], "k long, revenue_d90 double")
    got = [r["revenue_d90"] for r in M.prepare_target(df, "revenue_d90").orderBy("k").collect()]
    assert got == [5.0, 0.0]
    with pytest.raises(ValueError):
        M.prepare_target(df, "revenue_d30")


def test_split_and_folds_are_partition_invariant(spark):
    df = spark.range(20000).withColumnRenamed("id", "k")
    a = M.assign_fold(M.assign_split(df, "k"), "k")
    b = M.assign_fold(M.assign_split(df.repartition(13), "k"), "k")
    key = lambda d: sorted((r.k, r.split, r.fold) for r in d.collect())
    assert key(a) == key(b)
    shares = {r["split"]: r["count"] / 20000 for r in a.groupBy("split").count().collect()}
    assert shares["test"] == pytest.approx(0.2, abs=0.02)
    assert shares["val"] == pytest.approx(0.16, abs=0.02)
    folds = [r["count"] for r in a.groupBy("fold").count().collect()]
    assert len(folds) == 5 and min(folds) > 3600


def test_label_encoder_unseen_gets_n_classes(spark):
    train = spark.createDataFrame([("b",), ("a",), (None,)], "c string")
    enc = M.fit_label_encoder(train, ["c"])
    test = spark.createDataFrame([("a",), ("b",), (None,), ("zzz",)], "c string")
    got = [r["c"] for r in M.apply_label_encoder(enc, test, ["c"]).collect()]
    assert got == [0, 1, 2, 3]   # a, b, unknown, unseen -> number of classes


def test_evaluate_hand_computed(spark):
    df = spark.createDataFrame([(10.0, 8.0), (0.5, 1.5), (20.0, 20.0)], "label double, prediction double")
    r = M.evaluate(df).first()
    y, p = np.array([10, 0.5, 20]), np.array([8, 1.5, 20])
    assert r["mae"] == pytest.approx(np.mean(np.abs(y - p)))
    assert r["rmse"] == pytest.approx(np.sqrt(np.mean((y - p) ** 2)))
    assert r["r2"] == pytest.approx(1 - np.sum((y - p) ** 2) / np.sum((y - y.mean()) ** 2))
    assert r["mape"] == pytest.approx(np.mean(np.abs(y - p) / np.clip(y, 1, None)) * 100)
    assert r["total_error_pct"] == pytest.approx(abs(p.sum() - y.sum()) / y.sum() * 100)


def test_best_iteration_patience():
    errs = [10, 8, 7] + [7.5] * 10 + [6.0]
    assert M.best_iteration(errs, 10) == 3    # stops after 10 rounds without gain
    assert M.best_iteration(errs, 11) == 14   # one more round of patience finds 6.0


def test_gbt_fit_predict_cv_importance(spark):
    rng = np.random.default_rng(42)
    n = 500
    f = rng.normal(0, 1, (n, 3))
    y = 100 * f[:, 0] + 50 * f[:, 1] + rng.normal(0, 10, n) + 1000
    df = spark.createDataFrame([(i, float(a), float(b), float(c), float(t))
                                for i, ((a, b, c), t) in enumerate(zip(f, y))],
                               "k long, feature_1 double, feature_2 double, feature_3 double, revenue_d90 double")
    df = M.assign_fold(M.assign_split(df, "k"), "k").cache()
    cfg = M.GBTConfig(n_estimators=15, max_depth=3, early_stopping_rounds=3)
    feats = ["feature_1", "feature_2", "feature_3"]
    fit = M.fit_gbt(df.filter(F.col("split") == "train"), feats, "revenue_d90", cfg,
                    val=df.filter(F.col("split") == "val"))
    assert 1 <= fit.n_trees <= 15 and len(fit.val_errors) == 15
    pred = fit.predict(df.filter(F.col("split") == "test"), "revenue_d90")
    assert pred.count() == df.filter(F.col("split") == "test").count()
    assert M.evaluate(pred, "revenue_d90").first()["r2"] > 0.5
    imp = M.importance_top(fit.importance(spark), 10).collect()
    assert imp[0]["feature"] == "feature_1"
    assert sum(r["importance"] for r in imp) == pytest.approx(1.0)
    per_fold, summ = M.cross_validate(df, feats, "revenue_d90", M.GBTConfig(n_estimators=5, max_depth=3))
    s = summ.first()
    assert per_fold.count() == 5 and s["rmse_mean"] > 0 and -1 <= s["r2_mean"] <= 1
