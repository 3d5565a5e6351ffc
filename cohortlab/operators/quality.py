"""Quality profile and gates (Q2-Q10).

The profile is one wide aggregate (counts, NULL counts, date range, distinct
counts, numeric summaries) plus a duplicate pass and one exact-quantile call
for the medians. Results are tiny report frames.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlab import schema as S
from cohortlab.functions.exprs import parse_day_inferred
from cohortlab.functions.quantiles import quantile_values
from cohortlab.session import discard, staged

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
                 T.DoubleType, T.DecimalType)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC_TYPES)]


def _full_row_duplicates(df: DataFrame) -> int:
    row = (df.groupBy(*df.columns).count()
           .agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).alias("dups")).first())
    return int(row["dups"])


def duplicate_count(df: DataFrame) -> int:
    """Rows that repeat an earlier row (all columns, NULLs equal); exact.

    First only a 64-bit hash of each row is shuffled (combined before the
    shuffle, so a group of copies, however large, is one row per task) and the
    hashes seen more than once are staged. Copies share a hash, so the full-row
    count over the rows with such a hash (collisions included, combined before
    the shuffle too) is the answer at any duplicate rate.
    """
    cols = df.columns
    if not cols:
        return 0
    # -0.0 + 0.0 = 0.0: grouping treats -0.0 and 0.0 as equal, hashing would not
    floats = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    name = "row_hash"
    while name in cols:
        name += "_"
    h = F.xxhash64(*[F.col(c) + F.lit(0.0) if c in floats else F.col(c) for c in cols]).alias(name)
    repeated = staged(df.select(h).groupBy(name).count().filter(F.col("count") > 1).select(name), "repeated-hashes")
    out = _full_row_duplicates(df.select(*cols, h).join(repeated, name, "left_semi").drop(name))
    discard([repeated])
    return out


@dataclass
class QualityReport:
    total_records: int
    total_columns: int
    duplicate_count: int
    missing: dict          # column -> rate (> 0 only)
    date_range: dict | None
    categorical: dict      # column -> distinct non-null values
    numerical: dict        # column -> {mean, median, min, max, negative_count}

    @property
    def duplicate_rate(self) -> float:
        return self.duplicate_count / self.total_records if self.total_records else 0.0


def profile(df: DataFrame, categorical=S.CATEGORICAL_COLS, key_metrics=S.KEY_METRICS,
            quantile_method: str = "exact", approx_distinct: bool = False) -> QualityReport:
    cols = df.columns
    cats = [c for c in categorical if c in cols]
    nums = [c for c in key_metrics if c in cols]
    aggs = [F.count(F.lit(1)).alias("_rows")]
    aggs += [F.count_if(F.col(c).isNull()).alias(f"_null_{i}") for i, c in enumerate(cols)]
    if "day" in cols:
        d = parse_day_inferred(df, "day")
        aggs += [F.min(d).alias("_dmin"), F.max(d).alias("_dmax")]
    for i, c in enumerate(cats):
        aggs.append((F.approx_count_distinct(c) if approx_distinct else F.countDistinct(c))
                    .alias(f"_nd_{i}"))
    for i, c in enumerate(nums):
        aggs += [F.avg(c).alias(f"_mean_{i}"), F.min(c).alias(f"_min_{i}"),
                 F.max(c).alias(f"_max_{i}"), F.count(c).alias(f"_cnt_{i}"),
                 F.count_if(F.col(c) < 0).alias(f"_neg_{i}")]
    r = df.agg(*aggs).first()
    n = int(r["_rows"])
    missing = {c: r[f"_null_{i}"] / n for i, c in enumerate(cols) if n and r[f"_null_{i}"] > 0}
    date_range = None
    if "day" in cols and r["_dmin"] is not None:
        date_range = {"min": r["_dmin"].isoformat(), "max": r["_dmax"].isoformat(),
                      "span_days": (r["_dmax"] - r["_dmin"]).days}
    medians = quantile_values(df, nums, [0.5], method=quantile_method) if nums else {}
    numerical = {}
    for i, c in enumerate(nums):
        if r[f"_cnt_{i}"]:
            numerical[c] = {"mean": r[f"_mean_{i}"], "median": medians.get((c, 0.5)),
                            "min": float(r[f"_min_{i}"]), "max": float(r[f"_max_{i}"]),
                            "negative_count": int(r[f"_neg_{i}"])}
    return QualityReport(
        total_records=n, total_columns=len(cols), duplicate_count=duplicate_count(df),
        missing=missing, date_range=date_range,
        categorical={c: int(r[f"_nd_{i}"]) for i, c in enumerate(cats)},
        numerical=numerical)


# -- report frames ----------------------------------------------------------

def counts_frame(spark: SparkSession, rep: QualityReport) -> DataFrame:
    return spark.createDataFrame([Row(total_records=rep.total_records,
                                      total_columns=rep.total_columns)],
                                 "total_records long, total_columns long")


def duplicates_frame(spark: SparkSession, rep: QualityReport) -> DataFrame:
    return spark.createDataFrame([(rep.duplicate_count, rep.duplicate_rate)],
                                 "duplicate_count long, duplicate_rate double")


def missing_frame(spark: SparkSession, rep: QualityReport) -> DataFrame:
    return spark.createDataFrame(list(rep.missing.items()), "column string, missing_rate double")


def dates_frame(spark: SparkSession, rep: QualityReport) -> DataFrame:
    rows = [] if rep.date_range is None else [
        (rep.date_range["min"], rep.date_range["max"], rep.date_range["span_days"])]
    return spark.createDataFrame(rows, "min_date string, max_date string, span_days long")


def distinct_frame(spark: SparkSession, rep: QualityReport) -> DataFrame:
    return spark.createDataFrame(list(rep.categorical.items()), "column string, n_distinct long")


def numeric_frame(spark: SparkSession, rep: QualityReport) -> DataFrame:
    rows = [(c, s["mean"], s["median"], s["min"], s["max"], s["negative_count"])
            for c, s in rep.numerical.items()]
    return spark.createDataFrame(
        rows, "column string, mean double, median double, min double, max double, "
              "negative_count long")


def issues(rep: QualityReport, min_records: int = S.MIN_RECORDS,
           max_duplicate_rate: float = S.MAX_DUPLICATE_RATE,
           max_missing_rate: float = S.MAX_MISSING_RATE, severity: str = "error") -> list[tuple]:
    """(severity, check, column, value, limit) for every failed strict comparison."""
    out = []
    if rep.total_records < min_records:
        out.append((severity, "min_records", None, float(rep.total_records), float(min_records)))
    if rep.duplicate_rate > max_duplicate_rate:
        out.append((severity, "duplicate_rate", None, rep.duplicate_rate, max_duplicate_rate))
    for c, rate in rep.missing.items():
        if rate > max_missing_rate:
            out.append((severity, "missing_rate", c, rate, max_missing_rate))
    return out


ISSUE_SCHEMA = "severity string, check string, column string, value double, limit double"


def issues_frame(spark: SparkSession, rep: QualityReport, **limits) -> DataFrame:
    return spark.createDataFrame(issues(rep, **limits), ISSUE_SCHEMA)


def validate_quality(rep: QualityReport, **limits) -> None:
    """Quality gate (Q8): raise one ValueError listing every failed check."""
    found = issues(rep, **limits)
    if found:
        text = "; ".join(f"{chk}{'(' + c + ')' if c else ''} {v:.4g} vs {lim:.4g}"
                         for _, chk, c, v, lim in found)
        raise ValueError(f"Data quality validation failed: {text}")


def soft_issues(rep: QualityReport, min_records: int = S.MIN_RECORDS,
                max_duplicate_rate: float = S.MAX_DUPLICATE_RATE) -> list[tuple]:
    """Second, warning-only gate (Q9): record count and duplicate rate."""
    return issues(rep, min_records=min_records, max_duplicate_rate=max_duplicate_rate,
                  max_missing_rate=float("inf"), severity="warn")


def impact_frame(raw: DataFrame, processed: DataFrame, categorical=S.CATEGORICAL_COLS,
                 key_metrics=S.KEY_METRICS, mean_change: float = S.IMPACT_MEAN_CHANGE) -> DataFrame:
    """Before/after report (Q10): one aggregate per side, joined by (column, stat)."""
    spark = raw.sparkSession

    def side(df: DataFrame, parsed_day: bool) -> dict:
        aggs = []
        if "day" in df.columns:
            d = F.col("day").cast("date") if parsed_day else parse_day_inferred(df, "day")
            aggs.append(F.datediff(F.max(d), F.min(d)).alias("day|span_days"))
        aggs += [F.countDistinct(c).alias(f"{c}|n_distinct") for c in categorical if c in df.columns]
        for c in key_metrics:
            if c in df.columns:
                aggs += [F.avg(c).alias(f"{c}|mean"), F.min(c).cast("double").alias(f"{c}|min"),
                         F.max(c).cast("double").alias(f"{c}|max")]
        return df.agg(*aggs).first().asDict()

    before = side(raw, parsed_day=False)
    after = side(processed, parsed_day=True)
    rows = []
    for key, a in after.items():
        column, stat = key.split("|")
        b = before.get(key)
        a = None if a is None else float(a)
        b = None if b is None else float(b)
        if stat == "mean":
            changed = b is not None and a is not None and b != 0 and abs(a - b) / abs(b) > mean_change
        else:
            changed = a != b
        rows.append((column, stat, b, a, bool(changed)))
    return spark.createDataFrame(
        rows, "column string, stat string, before double, after double, changed boolean")
