"""Registered queries: one per inventory item, each ``(spark, sf_dir) -> DataFrame``.

Every query reads the given tables through the order-derived cohort table
(``sources.adapter``), so its work grows with them. Floating outputs are
rounded to 4 decimals because two engines add floats in different orders.
The SQL twins live in ``oracle/queries_sql.py`` with the same names and columns.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlab import schema as S
from cohortlab.functions import exprs as X
from cohortlab.operators import clean as C
from cohortlab.operators import drift as D
from cohortlab.operators import features as FE
from cohortlab.operators import model as M
from cohortlab.operators import quality as Q
from cohortlab.session import cut_lineage, ensure_checkpoint_dir, staged
from cohortlab.sources.adapter import cohorts_from_orders

DRIFT_SPLIT_DAY = "1998-04-17"
DRIFT_NUMERIC = ["installs", "network_cost", "revenue_d7", "revenue_d30", "sessions_d1", "retained_users_d7"]
DRIFT_CATEGORICAL = ["channel", "os_name", "country_code", "game_genre"]
# Test thresholds chosen so that every gate check fires on the derived table.
STRICT_GATE = {"min_records": 20000, "max_duplicate_rate": 0.01, "max_missing_rate": 0.012}


def round4(c) -> "F.Column":
    """Round half away from zero on ``x * 10^4`` (the binary product), then scale
    back: the same doubles in every engine, unlike decimal-string rounding."""
    return F.round(F.col(c) * 10000.0) / 10000.0


def rounded(df: DataFrame) -> DataFrame:
    fix = {f.name: round4(f.name) for f in df.schema.fields
           if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    return df.withColumns(fix) if fix else df


# -- shared stages --------------------------------------------------------------

def raw(spark: SparkSession, sf: str, key: bool = True) -> DataFrame:
    """Derived cohort table, written once into the checkpoint folder so the
    later passes of a query scan it instead of redoing the joins."""
    return cut_lineage(cohorts_from_orders(spark, sf, with_key=key))


def filled(spark, sf):
    return C.fill_missing(raw(spark, sf))


def flagged(spark, sf) -> DataFrame:
    return C.repair(C.standardize(filled(spark, sf)[0]))


def cleaned(spark, sf, columns=None) -> C.Cleaned:
    """Cleaned cohorts: features, drift and modelling read them several times.
    ``columns`` names those that the caller reads; the others are not written,
    but for the columns that have caps."""
    return C.clean(raw(spark, sf), columns=columns, write=True)


def featured(spark, sf) -> FE.Featured:
    return FE.build_features(cleaned(spark, sf).frame)


def _long_table(df: DataFrame, cols, fields: dict) -> DataFrame:
    """Unpivot ``cols`` into rows (column, <fields>) from a one-row aggregate."""
    items = F.array(*[F.struct(F.lit(c).alias("column"),
                               *[F.col(f"{c}|{k}").alias(k) for k in fields]) for c in cols])
    return df.select(F.explode(items).alias("_x")).select("_x.*")


# -- Q: quality -------------------------------------------------------------------

def _profile(spark, sf):
    return Q.profile(raw(spark, sf, key=False))


def quality_counts(spark, sf):
    return Q.counts_frame(spark, _profile(spark, sf))


def quality_duplicates(spark, sf):
    return rounded(Q.duplicates_frame(spark, _profile(spark, sf)))


def quality_missing(spark, sf):
    return rounded(Q.missing_frame(spark, _profile(spark, sf)))


def quality_dates(spark, sf):
    return Q.dates_frame(spark, _profile(spark, sf))


def quality_distinct(spark, sf):
    return Q.distinct_frame(spark, _profile(spark, sf))


def quality_numeric(spark, sf):
    return rounded(Q.numeric_frame(spark, _profile(spark, sf)))


def quality_issues(spark, sf):
    return rounded(Q.issues_frame(spark, _profile(spark, sf), **STRICT_GATE))


def quality_warnings(spark, sf):
    found = Q.soft_issues(_profile(spark, sf), STRICT_GATE["min_records"], STRICT_GATE["max_duplicate_rate"])
    return rounded(spark.createDataFrame(found, Q.ISSUE_SCHEMA))


def impact_report(spark, sf):
    r = raw(spark, sf, key=False)
    return rounded(Q.impact_frame(r, C.clean(r, write=True).frame))


# -- C: missing values -------------------------------------------------------------

def fill_constant(spark, sf):
    out, _ = filled(spark, sf)
    return out.groupBy("campaign_id").agg(F.count(F.lit(1)).alias("rows"))


def fill_group_median(spark, sf):
    return rounded(C.channel_medians(raw(spark, sf)).withColumnRenamed("_channel_median", "channel_median"))


def fill_network_cost(spark, sf):
    r = raw(spark, sf)
    out, _ = C.fill_missing(r)
    gaps = r.filter(F.col("network_cost").isNull()).select("k").distinct()
    return rounded(out.join(gaps, "k", "left_semi").select("k", "channel", "network_cost"))


def fill_zero(spark, sf):
    out, _ = filled(spark, sf)
    cols = [c for c in Q.numeric_columns(out) if c != "k"]
    agg = out.agg(*[x for c in cols for x in (
        F.count_if(F.col(c).isNull()).alias(f"{c}|nulls_after"),
        F.sum(F.col(c).cast("double")).alias(f"{c}|sum_after"))])
    return rounded(_long_table(agg, cols, {"nulls_after": 0, "sum_after": 0}))


def fill_counts(spark, sf):
    _, fills = C.fill_missing(raw(spark, sf, key=False))
    return spark.createDataFrame(list(fills.items()), "column string, filled long")


# -- T: standardisation --------------------------------------------------------------

def _mapping(spark, sf, column: str) -> DataFrame:
    out, _ = filled(spark, sf)
    std = C.standardize(out.withColumn("_raw", F.col(column)))
    return std.groupBy(F.col("_raw").alias(f"raw_{column}"), F.col(column)).agg(
        F.count(F.lit(1)).alias("rows"))


def norm_channel(spark, sf):
    return _mapping(spark, sf, "channel")


def norm_country(spark, sf):
    return _mapping(spark, sf, "country_code")


def norm_os(spark, sf):
    return _mapping(spark, sf, "os_name")


def norm_genre(spark, sf):
    return _mapping(spark, sf, "game_genre")


def parse_day(spark, sf):
    out = C.standardize(filled(spark, sf)[0])
    return out.agg(F.count("day").alias("parsed"), F.count_if(F.col("day").isNull()).alias("invalid"),
                   F.date_format(F.min("day"), "yyyy-MM-dd").alias("min_day"),
                   F.date_format(F.max("day"), "yyyy-MM-dd").alias("max_day"))


def parse_day_inferred(spark, sf):
    """T-8 on days in another format, as dates and as timestamps."""
    df = raw(spark, sf).select("k", "day", F.col("day").alias("iso"))
    good = F.to_date(F.try_to_timestamp("day", F.lit("yyyy-MM-dd")))
    df = staged(df.select("k", F.coalesce(F.date_format(good, "dd.MM.yyyy"), "day").alias("dotted"),
                          F.date_format(good, "yyyy-MM-dd HH:mm:ss").alias("with_time"), good.alias("as_date"),
                          F.to_timestamp(good).alias("as_timestamp")), "days")
    days = df.select("k", *[X.parse_day_inferred(df, c).alias(c) for c in ("dotted", "with_time", "as_date", "as_timestamp")])
    parts = [days.agg(F.lit(c).alias("form"), F.count(c).alias("parsed"), F.count_if(F.col(c).isNull()).alias("invalid"),
                      F.date_format(F.min(c), "yyyy-MM-dd").alias("min_day"), F.date_format(F.max(c), "yyyy-MM-dd").alias("max_day"))
             for c in days.columns[1:]]
    return reduce(DataFrame.unionByName, parts)


def norm_distinct(spark, sf):
    return C.distinct_after(C.standardize(filled(spark, sf)[0]))


def invalid_countries(spark, sf):
    return spark.createDataFrame([(C.invalid_country_count(filled(spark, sf)[0]),)], "invalid long")


# -- R / O: repair and capping ---------------------------------------------------------

def _changed(spark, sf, cols) -> DataFrame:
    before = C.standardize(filled(spark, sf)[0])
    before = before.withColumns({f"_b_{c}": F.col(c) for c in cols})
    j = C.drop_fix_flags(C.repair(before))
    agg = j.agg(*[x for c in cols for x in (
        F.sum(F.col(c).cast("double")).alias(f"{c}|sum_after"),
        F.count_if(F.col(c) != F.col(f"_b_{c}")).alias(f"{c}|rows_changed"))])
    return rounded(_long_table(agg, cols, {"sum_after": 0, "rows_changed": 0}))


def fix_nonneg(spark, sf):
    cols = list(S.NON_NEGATIVE_COLS)
    before = C.standardize(filled(spark, sf)[0]).withColumns({f"_b_{c}": F.col(c) for c in cols})
    after = C.drop_fix_flags(C.repair(before))
    agg = after.agg(*[x for c in cols for x in (
        F.count_if(F.col(f"_b_{c}") < 0).alias(f"{c}|negatives_before"),
        F.count_if(F.col(c) < 0).alias(f"{c}|negatives_after"))])
    return _long_table(agg, cols, {"negatives_before": 0, "negatives_after": 0})


def fix_retention(spark, sf):
    return _changed(spark, sf, list(S.RETENTION_COLS))


def fix_revenue(spark, sf):
    return _changed(spark, sf, list(S.REVENUE_COLS))


def fix_components(spark, sf):
    f = flagged(spark, sf)
    return rounded(f.agg(F.sum(C.FIX_PREFIX + "revenue_component_mismatch").alias("rows_mismatch"),
                         F.sum("revenue_d30").alias("revenue_d30_sum")))


def fix_payers(spark, sf):
    return _changed(spark, sf, ["payers_d7", "payers_d30"])


def fix_report(spark, sf):
    return C.fix_report(flagged(spark, sf))


def cap_outliers(spark, sf):
    cl = cleaned(spark, sf)
    cols = list(cl.caps)
    agg = cl.frame.agg(*[x for c in cols for x in (
        F.max(F.col(c)).alias(f"{c}|max_after"), F.sum(F.col(c)).alias(f"{c}|sum_after"))])
    caps = spark.createDataFrame([(c, float(v)) for c, v in cl.caps.items()], "column string, cap_value double")
    return rounded(_long_table(agg, cols, {"max_after": 0, "sum_after": 0}).join(caps, "column"))


def cap_report(spark, sf):
    return rounded(cleaned(spark, sf).cap_report())


def clean_summary(spark, sf):
    r = raw(spark, sf, key=False)
    return C.null_count_frame(C.clean(r, write=True).frame)


# -- F / E: features -----------------------------------------------------------------

FEATURE_BLOCKS = {
    "feat_retention": ["retention_rate_d1", "retention_rate_d3", "retention_rate_d7", "retention_rate_d14",
                       "retention_rate_d30", "retention_decay_d1_d7", "retention_decay_d7_d30",
                       "retention_stability"],
    "feat_revenue": ["arpi_d1", "arpi_d7", "arpi_d14", "arpi_d30", "arpu_d1", "arpu_d7", "arpu_d30",
                     "revenue_growth_d1_d7", "revenue_growth_d7_d30", "revenue_growth_d1_d30",
                     "revenue_acceleration", "early_monetization_ratio"],
    "feat_monetization": ["payer_conversion_d7", "arppu_d7", "payer_conversion_d30", "arppu_d30",
                          "iap_revenue_share", "ad_revenue_share", "is_iap_dominant", "is_ad_dominant",
                          "is_hybrid_monetization"],
    "feat_engagement": ["sessions_per_install_d1", "sessions_per_retained_d1", "sessions_per_install_d7",
                        "sessions_per_retained_d7", "session_growth_d1_d7", "revenue_per_session_d1",
                        "revenue_per_session_d7"],
    "feat_efficiency": ["cpi", "roas_d1", "roas_d7", "roas_d14", "roas_d30", "cost_per_retained_d7",
                        "cost_per_retained_d30", "is_profitable_d30"],
}


def _feature_block(name: str):
    def q(spark, sf):
        df = FE.row_features(cleaned(spark, sf).frame)
        return rounded(df.select("k", *FEATURE_BLOCKS[name]))
    q.__name__ = name
    return q


def enc_frequency(spark, sf):
    return FE.frequency_tables(cleaned(spark, sf).frame)


def enc_common(spark, sf):
    fe = featured(spark, sf)
    cols = list(S.CATEGORICAL_COLS)
    agg = fe.frame.agg(*[F.sum(f"{c}_is_common").alias(f"{c}|common_rows") for c in cols])
    thr = spark.createDataFrame([(c, float(v) if v is not None else None)
                                 for c, v in fe.encodings.common_threshold.items()],
                                "column string, threshold double")
    return rounded(_long_table(agg, cols, {"common_rows": 0}).join(thr, "column"))


def enc_flags(spark, sf):
    fe = featured(spark, sf)
    return fe.frame.agg(F.sum("is_ios").alias("is_ios"), F.sum("is_android").alias("is_android"),
                        F.sum("is_tier1_country").alias("is_tier1_country"),
                        F.count(F.lit(1)).alias("rows"))


def score_early(spark, sf):
    return rounded(featured(spark, sf).frame.select("k", "early_performance_score"))


def score_quality(spark, sf):
    return rounded(featured(spark, sf).frame.select("k", "cohort_quality_score"))


def feature_clean(spark, sf):
    fe = featured(spark, sf)
    cols = fe.features
    agg = fe.frame.agg(*[x for c in cols for x in (
        F.count_if(F.col(c).isNull()).alias(f"{c}|nulls"),
        F.sum(F.col(c).cast("double")).alias(f"{c}|total"))])
    return rounded(_long_table(agg, cols, {"nulls": 0, "total": 0}).withColumnRenamed("column", "feature"))


# -- M: modelling (naive prediction for the oracle-checked parts) ------------------------

def _split_frame(spark, sf) -> DataFrame:
    df = M.prepare_target(cleaned(spark, sf).frame, "revenue_d90")
    df = M.assign_fold(M.assign_split(df, "k"), "k")
    return df.withColumn("prediction", F.col("revenue_d30") * 2.0)


def split_assign(spark, sf):
    return rounded(_split_frame(spark, sf).groupBy("split").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("revenue_d90").alias("target_sum")))


def fold_assign(spark, sf):
    return _split_frame(spark, sf).groupBy("fold").agg(F.count(F.lit(1)).alias("rows")).withColumn(
        "fold", F.col("fold").cast("long"))


def label_encode(spark, sf):
    df = cleaned(spark, sf).frame.select("channel")
    enc = M.fit_label_encoder(df, ["channel"])
    out = M.apply_label_encoder(enc, df.withColumn("raw_channel", F.col("channel")), ["channel"])
    return out.groupBy("raw_channel", F.col("channel").alias("code")).agg(F.count(F.lit(1)).alias("rows"))


def eval_metrics(spark, sf):
    return rounded(M.evaluate(_split_frame(spark, sf), "revenue_d90", "prediction", by=["split"]))


def cv_metrics(spark, sf):
    per = M.evaluate(_split_frame(spark, sf), "revenue_d90", "prediction", by=["fold"])
    return rounded(per.select(F.col("fold").cast("long").alias("fold"), "n", "rmse", "r2", "mae"))


def cv_summary(spark, sf):
    per = M.evaluate(_split_frame(spark, sf), "revenue_d90", "prediction", by=["fold"])
    return rounded(M.cv_summary(per))


def export_frame(spark, sf):
    out = M.export_frame(None, _split_frame(spark, sf), "revenue_d90")
    return rounded(out.select("k", "split", "prediction", "prediction_error"))


def predictions_union(spark, sf):
    out = _split_frame(spark, sf)
    keep = ["prediction", "revenue_d90", "game_id", "game_genre", "os_name", "country_code", "channel"]
    day = F.date_format("day", "yyyy-MM-dd").alias("day")
    train = out.filter(F.col("split") != "test").select(*keep, day)
    test = out.filter(F.col("split") == "test").select(*keep, day)
    return rounded(train.unionByName(test))


def split_exact(spark, sf):
    df = M.prepare_target(cleaned(spark, sf).frame, "revenue_d90")
    return M.assign_split_exact(df, "k").select("k", "split")


def metric_report_naive(spark, sf):
    """The metric report of the naive prediction; its data section has the 59 features."""
    df = staged(_split_frame(spark, sf), "naive")
    per_fold = M.evaluate(df, "revenue_d90", "prediction", by=["fold"])
    return rounded(M.metric_report(df, per_fold, 59, label="revenue_d90"))


def run_counts(spark, sf):
    """The run on the plain 27 columns as far as its split: rows, features and split sizes."""
    from cohortlab.plans.flow import CohortRun, RunConfig
    run = CohortRun(spark, None, RunConfig(impact_report=False))
    run.ingest(raw(spark, sf, key=False))
    run.preprocess()
    frame = run.engineer()
    data = run.split(M.prepare_target(frame, run.target))
    n = len(M.leakage_filter(run.state.featured.features))
    return data.agg(F.count(F.lit(1)).alias("rows"), F.countDistinct(run.key).alias("row_keys"), F.lit(n).cast("long").alias("n_features"),
                    *[F.count_if(F.col("split") == s).alias(f"{s}_rows") for s in ("train", "val", "test")])


def _filled_values(df: DataFrame, cols, together: int = 8) -> DataFrame:
    """(column, filled): values that are neither NULL nor zero. An aggregate takes ``together``
    columns: the code generated for all features in one is too long for the JVM to compile."""
    def part(some) -> DataFrame:
        counts = df.agg(*[F.count_if(F.col(c) != 0).alias(f"{c}|filled") for c in some])
        return _long_table(counts, some, {"filled": "long"})

    cols = list(cols)
    return reduce(DataFrame.union, [part(cols[k:k + together]) for k in range(0, len(cols), together) or [0]])


def feature_stats(spark, sf):
    """E10 with the number of filled values behind every group's features."""
    fe = featured(spark, sf)
    filled = _filled_values(fe.frame, fe.features)
    groups = F.array(*[F.when(F.col("column").rlike("|".join(keys)), F.lit(f"group_{g}")) for g, keys in S.FEATURE_GROUPS.items()])
    by_group = (filled.withColumn("name", F.explode(F.filter(groups, lambda g: g.isNotNull())))
                .groupBy("name").agg(F.sum("filled").alias("filled")))
    all_rows = filled.agg(F.sum("filled").alias("filled")).withColumn("name", F.lit("final_feature_count"))
    stats = spark.createDataFrame(fe.stats(), "name string, value long")  # a row for each group of names
    return stats.join(by_group.unionByName(all_rows), "name", "left")


def leakage_filter(spark, sf):
    """M1 over the features and the table's own numbers: which columns a model may see."""
    fe = featured(spark, sf)
    numbers = [f.name for f in fe.frame.schema.fields
               if isinstance(f.dataType, T.NumericType) and f.name in S.REQUIRED_COLUMNS]
    cols = list(dict.fromkeys([*numbers, *fe.features]))
    kept = M.leakage_filter(cols)
    filled = _filled_values(fe.frame, cols).withColumnRenamed("column", "feature")
    return filled.withColumn("kept", F.col("feature").isin(kept))


def _gbt_data(spark, sf):
    fe = featured(spark, sf)
    feats = M.leakage_filter(fe.features)
    df = M.prepare_target(fe.frame, "revenue_d90")
    df = M.assign_fold(M.assign_split(df, "k"), "k")
    return cut_lineage(df.select(*dict.fromkeys([*feats, "revenue_d90", "split", "fold"]))), feats


_shared: dict[tuple, object] = {}


def _once(spark, sf, name: str, make):
    """What several queries of one session read: the fitted model and the folds' metrics."""
    key = (spark.sparkContext.applicationId, sf, name)
    if key not in _shared:
        _shared[key] = make()
    return _shared[key]


def _model_rows(spark, sf):
    return _once(spark, sf, "rows", lambda: _gbt_data(spark, sf))


def _fitted(spark, sf) -> M.Fitted:
    df, feats = _model_rows(spark, sf)
    return _once(spark, sf, "fit", lambda: M.fit_gbt(
        df.filter(F.col("split") == "train"), feats, "revenue_d90", val=df.filter(F.col("split") == "val")))


def _folds(spark, sf) -> DataFrame:
    df, feats = _model_rows(spark, sf)
    return _once(spark, sf, "folds", lambda: staged(M.cross_validate(df, feats, "revenue_d90", parallelism=S.CV_FOLDS)[0], "folds"))


def gbt_predict(spark, sf):
    pred = _fitted(spark, sf).predict(_model_rows(spark, sf)[0], "revenue_d90")
    return M.evaluate(pred, "revenue_d90", "prediction", by=["split"])


def gbt_cv(spark, sf):
    return M.cv_summary(_folds(spark, sf))


def gbt_importance(spark, sf):
    return M.importance_top(_fitted(spark, sf).importance(spark), 10)


def metric_report(spark, sf):
    df, feats = _model_rows(spark, sf)
    scored = staged(_fitted(spark, sf).predict(df, "revenue_d90").select("split", "label", "prediction"), "scored")
    return M.metric_report(scored, _folds(spark, sf), len(feats))


# -- D: drift ------------------------------------------------------------------------

def drift_frames(spark, sf) -> tuple[DataFrame, DataFrame]:
    """Baseline = parsed day before the split day; current = the rest with a
    50% cost increase and a new channel on every 17th key."""
    df = cleaned(spark, sf, ["k", "day", *DRIFT_NUMERIC, "revenue_d90", *DRIFT_CATEGORICAL]).frame
    base = df.filter(F.col("day") < F.lit(DRIFT_SPLIT_DAY).cast("date"))
    cur = df.filter(F.col("day") >= F.lit(DRIFT_SPLIT_DAY).cast("date")).withColumns({
        "network_cost": F.col("network_cost") * 1.5,
        "channel": F.when(F.col("k") % 17 == 0, F.lit("newnet")).otherwise(F.col("channel")),
    })
    return base, cur


def _baseline(spark, sf):
    base, cur = drift_frames(spark, sf)
    return D.fit_baseline(base, DRIFT_NUMERIC + DRIFT_CATEGORICAL, "revenue_d90"), cur


def base_numeric(spark, sf):
    b, _ = _baseline(spark, sf)
    return rounded(b.numeric)


def base_categorical(spark, sf):
    b, _ = _baseline(spark, sf)
    return rounded(b.categorical.withColumn("rank", F.col("rank").cast("long")))


def hist_quantile(spark, sf):
    b, _ = _baseline(spark, sf)
    return rounded(b.hist.withColumn("bin", F.col("bin").cast("long")))


def hist_uniform(spark, sf):
    base, _ = drift_frames(spark, sf)
    h = D.uniform_histogram(base, DRIFT_NUMERIC + ["revenue_d90"])
    return rounded(h.withColumn("bin", F.col("bin").cast("long")))


def psi_numeric(spark, sf):
    b, cur = _baseline(spark, sf)
    cols = DRIFT_NUMERIC + ["revenue_d90"]
    on_base = D.psi(b.hist, D.histogram(cur, cols, b.edges, outer_open=True)).withColumnRenamed("psi", "psi_baseline_edges")
    own = D.psi(b.hist, D.histogram(cur, cols, D.quantile_edges(cur, cols))).withColumnRenamed("psi", "psi_own_edges")
    return rounded(on_base.join(own, "column", "full"))


def psi_categorical(spark, sf):
    b, cur = _baseline(spark, sf)
    return rounded(D.psi(b.categorical.select("column", "value", "share"),
                         D.category_shares(cur, DRIFT_CATEGORICAL).select("column", "value", "share"),
                         key="value"))


def ks_two_sample(spark, sf):
    base, cur = drift_frames(spark, sf)
    return rounded(D.ks_two_sample(base, cur, DRIFT_NUMERIC + ["revenue_d90"]))


def _arrays_as_text(df: DataFrame) -> DataFrame:
    fix = {f.name: F.array_join(F.array_sort(f.name), ",") for f in df.schema.fields
           if isinstance(f.dataType, T.ArrayType)}
    return df.withColumns(fix) if fix else df


def drift_numeric(spark, sf):
    b, cur = _baseline(spark, sf)
    return rounded(D.numeric_drift(b, cur, DRIFT_NUMERIC))


def drift_categorical(spark, sf):
    b, cur = _baseline(spark, sf)
    return rounded(_arrays_as_text(D.categorical_drift(b, cur, DRIFT_CATEGORICAL)))


def drift_category_changes(spark, sf):
    b, cur = _baseline(spark, sf)
    return D.category_changes(b, cur, DRIFT_CATEGORICAL)


def drift_target(spark, sf):
    b, cur = _baseline(spark, sf)
    return rounded(D.target_drift(b, cur))


def _detect(spark, sf):
    b, cur = _baseline(spark, sf)
    return D.detect_drift(b, cur, DRIFT_NUMERIC + DRIFT_CATEGORICAL, "revenue_d90")


def drift_summary(spark, sf):
    return rounded(_detect(spark, sf).summary)


def drift_alerts(spark, sf):
    a = D.alerts(_detect(spark, sf))
    return a.withColumn("features", F.array_join("features", ","))


# -- P: whole run -------------------------------------------------------------------

def run_summary(spark, sf):
    from cohortlab.plans.flow import CohortRun, RunConfig
    out = f"{ensure_checkpoint_dir(spark).rstrip('/')}/runs/{uuid.uuid4().hex}"
    run = CohortRun(spark, out, RunConfig(cv_parallelism=S.CV_FOLDS))
    s = run.run_all(raw(spark, sf, key=False))
    return spark.createDataFrame([(s["raw_records"], s["n_features"], float(s["model_r2"]),
                                   float(s["model_rmse"]), s["model_trained"], s["monitoring_setup"])],
                                 "raw_records long, n_features long, model_r2 double, model_rmse double, "
                                 "model_trained boolean, monitoring_setup boolean")


def channel_roas(spark, sf):
    """Flagship: cleaned + featured cohorts, per standardised channel."""
    fe = featured(spark, sf).frame
    return rounded(fe.groupBy("channel").agg(
        F.count(F.lit(1)).alias("cohorts"), F.sum("installs").alias("installs"),
        F.sum("network_cost").alias("cost"), F.sum("revenue_d30").alias("revenue_d30"),
        F.avg("roas_d7").alias("avg_roas_d7"), F.avg("roas_d30").alias("avg_roas_d30"),
        F.avg("cohort_quality_score").alias("avg_quality_score")))


def registry() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    q = {
        "channel_roas": channel_roas,
        "quality_counts": quality_counts, "quality_duplicates": quality_duplicates,
        "quality_missing": quality_missing, "quality_dates": quality_dates,
        "quality_distinct": quality_distinct, "quality_numeric": quality_numeric,
        "quality_issues": quality_issues, "quality_warnings": quality_warnings, "impact_report": impact_report,
        "fill_constant": fill_constant, "fill_group_median": fill_group_median,
        "fill_network_cost": fill_network_cost, "fill_zero": fill_zero, "fill_counts": fill_counts,
        "norm_channel": norm_channel, "norm_country": norm_country, "norm_os": norm_os,
        "norm_genre": norm_genre, "parse_day": parse_day, "norm_distinct": norm_distinct,
        "invalid_countries": invalid_countries,
        "fix_nonneg": fix_nonneg, "fix_retention": fix_retention, "fix_revenue": fix_revenue,
        "fix_components": fix_components, "fix_payers": fix_payers, "fix_report": fix_report,
        "cap_outliers": cap_outliers, "cap_report": cap_report, "clean_summary": clean_summary,
    }
    for name in FEATURE_BLOCKS:
        q[name] = _feature_block(name)
    q.update({
        "enc_frequency": enc_frequency, "enc_common": enc_common, "enc_flags": enc_flags,
        "score_early": score_early, "score_quality": score_quality, "feature_clean": feature_clean,
        "feature_stats": feature_stats, "leakage_filter": leakage_filter,
        "split_exact": split_exact, "metric_report_naive": metric_report_naive, "run_counts": run_counts,
        "parse_day_inferred": parse_day_inferred, "split_assign": split_assign, "fold_assign": fold_assign, "label_encode": label_encode,
        "eval_metrics": eval_metrics, "cv_metrics": cv_metrics, "cv_summary": cv_summary,
        "export_frame": export_frame, "predictions_union": predictions_union,
        "base_numeric": base_numeric, "base_categorical": base_categorical,
        "hist_quantile": hist_quantile, "hist_uniform": hist_uniform, "psi_numeric": psi_numeric,
        "psi_categorical": psi_categorical, "ks_two_sample": ks_two_sample,
        "drift_numeric": drift_numeric, "drift_categorical": drift_categorical,
        "drift_category_changes": drift_category_changes,
        "drift_target": drift_target, "drift_summary": drift_summary, "drift_alerts": drift_alerts,
        "gbt_predict": gbt_predict, "gbt_cv": gbt_cv, "gbt_importance": gbt_importance,
        "metric_report": metric_report, "run_summary": run_summary,
    })
    return q
