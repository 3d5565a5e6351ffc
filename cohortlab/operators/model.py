"""Modelling (M1-M11): target prep, hash split and folds, Spark ML GBT, metrics, CV.

The split is a pure function of a natural key (md5 of ``seed|key``), so it
does not depend on partitioning or row order and every later stage can reuse
the stored ``split`` / ``fold`` columns instead of recomputing them.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field
from functools import reduce

from pyspark import SparkContext
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortlab import schema as S
from cohortlab.functions.exprs import clip_lo, hash_bits
from cohortlab.operators import boosting as B
from cohortlab.session import staged

TWO32 = float(2 ** 32)


# -- M1 / M2 ------------------------------------------------------------------

def leakage_filter(features, keywords=S.LEAKAGE_KEYWORDS) -> list[str]:
    return [f for f in features if not any(k in f.lower() for k in keywords)]


def prepare_target(df: DataFrame, target: str) -> DataFrame:
    if target not in df.columns:
        raise ValueError(f"Target column {target} not found")
    return df.filter(F.col(target).isNotNull()).withColumn(target, clip_lo(target, 0))


# -- M3: label encoding ---------------------------------------------------------

def fit_label_encoder(df: DataFrame, cols) -> PipelineModel:
    """Codes in sorted value order, NULL -> 'unknown', unseen -> number of classes."""
    stages = [StringIndexer(inputCol=c, outputCol=f"{c}__idx", stringOrderType="alphabetAsc",
                            handleInvalid="keep") for c in cols]
    return Pipeline(stages=stages).fit(df.fillna("unknown", subset=list(cols)))


def apply_label_encoder(model: PipelineModel, df: DataFrame, cols) -> DataFrame:
    out = model.transform(df.fillna("unknown", subset=list(cols)))
    return out.withColumns({c: F.col(f"{c}__idx").cast("long") for c in cols}).drop(
        *[f"{c}__idx" for c in cols])


# -- M4: split and folds -----------------------------------------------------

def assign_split(df: DataFrame, key: str, test_size: float = S.TEST_SIZE,
                 val_size: float = S.VAL_SIZE, seed: int = S.RANDOM_STATE) -> DataFrame:
    """``split`` in {train, val, test}: test if the key hash falls under
    ``test_size``; of the rest, val under ``val_size`` of a second hash."""
    h = hash_bits(key, f"{seed}")
    hv = hash_bits(key, f"{seed}|val")
    split = (F.when(h < F.lit(test_size * TWO32), "test")
             .when(hv < F.lit(val_size * TWO32), "val").otherwise("train"))
    return df.withColumn("split", split)


def mark_smallest(df: DataFrame, key: str, salt: str, share: float, name: str) -> DataFrame:
    """Boolean column ``name``: the ``ceil(share n)`` rows with the smallest ``(hash, key)``.

    The rank is found by two histograms of the hash's 16-bit halves (65,536 rows
    at most, combined before the shuffle); only rows that share the hash at the
    boundary are ordered. Rows with equal keys should be equal rows.
    """
    spare = "hash_of_key"
    while spare in df.columns:
        spare += "_"
    hashed = df.withColumn(spare, hash_bits(key, salt))

    def boundary(rows: DataFrame, part, rank: int | None) -> tuple[int, int]:
        counts = rows.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"))
        w = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        ends = counts.withColumn("end", F.sum("n").over(w))
        if rank is None:
            total = counts.agg(F.sum("n")).first()[0] or 0
            rank = math.ceil(share * total)
        row = ends.filter(F.col("end") >= rank).orderBy("part").first()
        return (row["part"], rank - (row["end"] - row["n"])) if row and rank else (-1, 0)

    high, rest = boundary(hashed, F.shiftright(F.col(spare), 16), None)
    low, rest = boundary(hashed.filter(F.shiftright(F.col(spare), 16) == high), F.col(spare).bitwiseAND(0xFFFF), rest)
    edge = (high << 16) + low if high >= 0 else -1
    sure = hashed.filter(F.col(spare) != edge).withColumn(name, F.col(spare) < edge)
    nth = F.row_number().over(Window.orderBy(key))
    near = hashed.filter(F.col(spare) == edge).withColumn(name, nth <= rest)
    return sure.unionByName(near).drop(spare)


def assign_split_exact(df: DataFrame, key: str, test_size: float = S.TEST_SIZE,
                       val_size: float = S.VAL_SIZE, seed: int = S.RANDOM_STATE) -> DataFrame:
    """``split`` with exactly ``ceil(test_size n)`` test rows and ``ceil(val_size m)``
    of the other ``m`` rows for validation, whatever the partitioning."""
    marked = mark_smallest(df, key, f"{seed}", test_size, "is_test")
    rest = mark_smallest(marked.filter(~F.col("is_test")), key, f"{seed}|val", val_size, "is_val")
    test = marked.filter("is_test").withColumn("is_val", F.lit(False))
    split = F.when(F.col("is_test"), "test").when(F.col("is_val"), "val").otherwise("train")
    return test.unionByName(rest).withColumn("split", split).drop("is_test", "is_val")


def assign_fold(df: DataFrame, key: str, k: int = S.CV_FOLDS, seed: int = S.RANDOM_STATE) -> DataFrame:
    """``fold`` from 0 to ``k - 1``; rows without a key are in fold 0."""
    fold = F.pmod(hash_bits(key, f"{seed}|fold"), F.lit(k)).cast("int")
    return df.withColumn("fold", F.coalesce(fold, F.lit(0)))


# -- M7: evaluation -------------------------------------------------------------

def evaluate(df: DataFrame, label: str = "label", prediction: str = "prediction",
             by=()) -> DataFrame:
    """One row per group: mae, rmse, r2, mape, total_actual, total_predicted,
    total_error_pct. R2 = 1 - SSE / (n var_pop(y)); one aggregate."""
    y, p = F.col(label).cast("double"), F.col(prediction).cast("double")
    err = y - p
    agg = df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(F.abs(err)).alias("mae"),
        F.sqrt(F.avg(err * err)).alias("rmse"),
        F.sum(err * err).alias("_sse"),
        (F.var_pop(y) * F.count(F.lit(1))).alias("_sst"),
        (F.avg(F.abs(err) / clip_lo(y, 1.0)) * 100).alias("mape"),
        F.sum(y).alias("total_actual"),
        F.sum(p).alias("total_predicted"))
    return agg.select(
        *by, "n", "mae", "rmse",
        (F.lit(1.0) - F.try_divide(F.col("_sse"), F.col("_sst"))).alias("r2"),
        "mape", "total_actual", "total_predicted",
        (F.try_divide(F.abs(F.col("total_predicted") - F.col("total_actual")), F.col("total_actual")) * 100)
        .alias("total_error_pct"))


METRICS = ["mae", "rmse", "r2", "mape", "total_actual", "total_predicted", "total_error_pct"]
CV_METRICS = ["rmse_mean", "rmse_std", "r2_mean", "r2_std"]


def metric_report(scored: DataFrame, per_fold: DataFrame | None, n_features: int, label: str = "label") -> DataFrame:
    """M10: (section, metric, value) with train, test, cv and data sections.

    ``scored`` has ``split``, ``label`` and ``prediction``; ``per_fold`` the metrics of
    the out-of-fold predictions. One aggregate over each."""
    def rows(df: DataFrame, names: list[str]) -> DataFrame:
        items = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in names])
        return df.select("section", F.explode(items).alias("_m")).select("section", "_m.metric", "_m.value")

    by_split = evaluate(scored, label, "prediction", by=["split"])
    counts = by_split.groupBy().agg(
        F.sum("n").alias("total_samples"),
        *[F.coalesce(F.sum(F.when(F.col("split") == s, F.col("n"))), F.lit(0)).alias(f"{s}_samples") for s in ("train", "val", "test")],
        F.lit(n_features).alias("n_features"))
    parts = [rows(by_split.filter(F.col("split").isin("train", "test")).withColumnRenamed("split", "section"), METRICS),
             rows(counts.withColumn("section", F.lit("data")),
                  ["total_samples", "train_samples", "val_samples", "test_samples", "n_features"])]
    if per_fold is not None:
        parts.append(rows(cv_summary(per_fold).withColumn("section", F.lit("cv")), CV_METRICS))
    return reduce(DataFrame.unionByName, parts)


def cv_summary(per_fold: DataFrame) -> DataFrame:
    """M8 summary: mean and population std over folds of RMSE and R2."""
    return per_fold.agg(F.avg("rmse").alias("rmse_mean"), F.stddev_pop("rmse").alias("rmse_std"),
                        F.avg("r2").alias("r2_mean"), F.stddev_pop("r2").alias("r2_std"))


# -- M5 / M6 / M8 / M9: gradient-boosted trees -----------------------------------

@dataclass
class GBTConfig:
    n_estimators: int = S.GBT_PARAMS["n_estimators"]
    max_depth: int = S.GBT_PARAMS["max_depth"]
    learning_rate: float = S.GBT_PARAMS["learning_rate"]
    seed: int = S.RANDOM_STATE
    max_bins: int = 256
    early_stopping_rounds: int = S.EARLY_STOP_ROUNDS
    # parameters of ``estimator``, with which the fitted model is labelled; ``boosting`` has
    # no lineage to cut and keeps no node ids
    checkpoint_interval: int = 10
    cache_node_ids: bool = False
    rows_per_task: int = 5_000           # at least; see ``tasks``

    def tasks(self, rows: int, cores: int, fits: int = 1) -> int:
        """Partitions of a fit's rows. Every task of a pass sends its sums for all nodes,
        features and bins, however few rows it has, so more tasks than the cores that a
        fit has only add sums to merge. Partitions are split at a million rows, for memory."""
        filled = -(-rows // self.rows_per_task)
        return max(1, min(filled, -(-cores // fits)), -(-rows // 1_000_000))

    def estimator(self, n_trees: int | None = None) -> GBTRegressor:
        return GBTRegressor(featuresCol="features", labelCol="label", predictionCol="prediction",
                            maxIter=n_trees or self.n_estimators, maxDepth=self.max_depth,
                            stepSize=self.learning_rate, seed=self.seed, maxBins=self.max_bins,
                            subsamplingRate=1.0, featureSubsetStrategy="all",
                            checkpointInterval=self.checkpoint_interval, cacheNodeIds=self.cache_node_ids)


def assemble(df: DataFrame, features, target: str) -> DataFrame:
    va = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="keep")
    return va.transform(df).withColumn("label", F.col(target).cast("double"))


def best_iteration(errors: list[float], patience: int) -> int:
    """Number of trees kept by early stopping with ``patience`` rounds."""
    best, best_i = float("inf"), -1
    for i, e in enumerate(errors):
        if e < best:
            best, best_i = e, i
        elif i - best_i >= patience:
            break
    return best_i + 1


@dataclass
class Fitted:
    model: GBTRegressionModel
    features: list
    n_trees: int
    val_errors: list = field(default_factory=list)

    def predict(self, df: DataFrame, target: str | None = None) -> DataFrame:
        t = target if target and target in df.columns else None
        data = assemble(df, self.features, t) if t else VectorAssembler(
            inputCols=self.features, outputCol="features", handleInvalid="keep").transform(df)
        return self.model.transform(data).drop("features")

    def importance(self, spark) -> DataFrame:
        imp = self.model.featureImportances.toArray().tolist()
        return spark.createDataFrame(list(zip(self.features, [float(x) for x in imp])),
                                     "feature string, importance double")


def first_trees(model: GBTRegressionModel, n: int) -> GBTRegressionModel:
    """The ensemble of the first ``n`` trees of ``model`` with their weights."""
    old = model._java_obj
    sc = SparkContext._active_spark_context
    trees, weights = old.trees(), list(old.treeWeights())
    kept = sc._gateway.new_array(sc._jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, n)
    scales = sc._gateway.new_array(sc._gateway.jvm.double, n)
    for i in range(n):
        kept[i], scales[i] = trees[i], weights[i]
    cut = sc._jvm.org.apache.spark.ml.regression.GBTRegressionModel(f"{model.uid}_{n}", kept, scales, old.numFeatures())
    out = GBTRegressionModel(cut)
    return out.setFeaturesCol(model.getFeaturesCol()).setPredictionCol(model.getPredictionCol())


def boosted(df: DataFrame, features, target: str, held: F.Column, fits: list[int], cfg: GBTConfig, tell: bool = True):
    """Grow the trees of all ``fits`` in shared passes; fit ``f`` leaves out the rows with ``held = f``
    and, with ``tell``, scores them after every tree."""
    label = F.col(target).cast("double")
    bins, rows = B.fitted_bins(df, features, held, fits, cfg.max_bins, cfg.seed)
    # every level of a tree is a pass
    tasks = cfg.tasks(rows, df.sparkSession.sparkContext.defaultParallelism)
    data = B.binned(df, features, label, held, bins, tasks)
    grown, trees, errors = B.grow(data, fits, bins, cfg.n_estimators, cfg.max_depth, cfg.learning_rate, tell)
    return data, bins, grown, trees, errors


def fit_gbt(train: DataFrame, features, target: str, cfg: GBTConfig | None = None,
            val: DataFrame | None = None) -> Fitted:
    """Fit once; with ``val`` keep the trees that early stopping would keep. Boosting
    adds trees one by one, so they are the first ones of the fitted ensemble."""
    cfg = cfg or GBTConfig()
    cols = list(dict.fromkeys([*features, target]))
    rows = train.select(*cols, F.lit(0).alias("held out"))
    if val is not None:
        rows = rows.unionByName(val.select(*cols, F.lit(1).alias("held out")))
    data, bins, grown, _, errors = boosted(rows, features, target, F.col("held out"), [1], cfg)
    data.unpersist()
    model = B.spark_model(cfg.estimator(), [t[0] for t in grown], bins.own[0])
    n, errs = cfg.n_estimators, []
    if val is not None:
        errs = [float(e) for e in errors[:, 0]]
        n = best_iteration(errs, cfg.early_stopping_rounds)
        if n < len(errs):
            model = first_trees(model, n)
    return Fitted(model=model, features=list(features), n_trees=n, val_errors=errs)


def cross_validate(df: DataFrame, features, target: str, cfg: GBTConfig | None = None,
                   k: int = S.CV_FOLDS, parallelism: int = 1) -> tuple[DataFrame, DataFrame]:
    """M8: k fits without early stopping on the stored ``fold`` column, ``parallelism`` of them
    in the same passes; returns per-fold metrics and the mean / population-std summary."""
    cfg, df = cfg or GBTConfig(), df.filter(F.col("fold").isNotNull())
    together, preds = max(1, parallelism), []
    for first in range(0, k, together):
        fits = list(range(first, min(k, first + together)))
        data, _, _, trees, _ = boosted(df, features, target, F.col("fold"), fits, cfg, tell=False)
        found = df.sparkSession.createDataFrame(B.held_out(data, fits, trees), "fold int, label double, prediction double", verifySchema=False)
        preds.append(staged(found, "out-of-fold"))
        data.unpersist()
    per_fold = evaluate(reduce(DataFrame.unionByName, preds), "label", "prediction", by=["fold"])
    return per_fold, cv_summary(per_fold)


def importance_top(imp: DataFrame, n: int = 10) -> DataFrame:
    """M9: normalised importances, largest first (ties by name), top n."""
    t = F.sum("importance").over(Window.partitionBy())  # one row per feature: small
    out = imp.select("feature", F.when(t > 0, F.col("importance") / t)
                     .otherwise(F.col("importance")).alias("importance"))
    return out.orderBy(F.desc("importance"), F.asc("feature")).limit(n)


def export_frame(df: DataFrame, predicted: DataFrame | None, target: str) -> DataFrame:
    """M11: rows with ``prediction`` and ``prediction_error = actual - prediction``."""
    out = predicted if predicted is not None else df
    return out.withColumn("prediction_error", F.col(target) - F.col("prediction"))
