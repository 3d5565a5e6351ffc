"""Cleaning: imputation (C1-C5), standardisation (T-1..T-9), repair (R1-R7), capping (O1-O3).

Statistics (group medians, global median, caps) are fitted by aggregate jobs
and applied as literals or a size-checked broadcast join, the way a Spark ML
estimator fits and a model transforms. Everything row-wise is one projection
per dependency layer, so the cleaned frame is a narrow plan over the scan.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlab import schema as S
from cohortlab.functions import exprs as X
from cohortlab.functions.quantiles import quantile_table, quantile_values
from cohortlab.operators.joins import join_lookup
from cohortlab.operators.quality import numeric_columns
from cohortlab.session import staged

FIX_PREFIX = "_fix__"


# -- C: missing values --------------------------------------------------------

def null_counts(df: DataFrame, cols) -> dict:
    cols = list(cols)
    if not cols:
        return {}
    r = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"_{i}") for i, c in enumerate(cols)]).first()
    return {c: int(r[f"_{i}"]) for i, c in enumerate(cols)}


def channel_medians(df: DataFrame, quantile_method: str = "exact") -> DataFrame:
    """(channel, median network_cost) over rows with a channel; NULL channel has no group."""
    med = quantile_table(df.select("channel", "network_cost"), ["network_cost"], [0.5],
                         by=["channel"], method=quantile_method)
    return med.select("channel", F.col("value").alias("_channel_median"))


def fill_missing(df: DataFrame, quantile_method: str = "exact", fill_target: bool = True,
                 target: str = S.target_column(S.TARGET_DAY)) -> tuple[DataFrame, dict]:
    """C1-C4. Returns the filled frame and per-column fill counts (C5, > 0 only).

    ``fill_target=False`` leaves missing targets NULL, so that M2 drops those rows
    instead of learning from zeros."""
    cols = df.columns
    nums = [c for c in numeric_columns(df) if fill_target or c != target]
    watch = (["campaign_id"] if "campaign_id" in cols else []) + nums
    nulls = null_counts(df, watch)
    fills: dict[str, int] = {}
    out = df
    if nulls.get("campaign_id"):
        out = out.withColumn("campaign_id", F.coalesce("campaign_id", F.lit(S.UNKNOWN_CAMPAIGN)))
        fills["campaign_id"] = nulls["campaign_id"]
    if nulls.get("network_cost"):
        if "channel" in cols:
            out = join_lookup(out, channel_medians(out, quantile_method), "channel", name="channel-medians")
            out = out.withColumn("network_cost", F.coalesce("network_cost", "_channel_median")).select(*cols)
        # global median of the column after the group fill (filled values count)
        glob = quantile_values(out, ["network_cost"], [0.5], method=quantile_method)
        if (q := glob.get(("network_cost", 0.5))) is not None:
            out = out.withColumn("network_cost", F.coalesce("network_cost", F.lit(q)))
        fills["network_cost"] = nulls["network_cost"]
    zero = [c for c in nums if nulls.get(c) and c not in fills]
    for c in zero:
        fills[c] = nulls[c]
    if zero or nulls.get("network_cost"):
        out = out.fillna(0, subset=nums)
    return out, fills


# -- T: text, category and date standardisation ------------------------------

def standardize(df: DataFrame) -> DataFrame:
    """T-1..T-8 as one projection; columns that are absent are left out."""
    rules = {
        "channel": X.norm_channel,
        "country_code": X.norm_country,
        "os_name": X.norm_os,
        "game_genre": X.title_case,
        "day": lambda c: X.parse_day_inferred(df, c),
    }
    return df.withColumns({c: fn(c) for c, fn in rules.items() if c in df.columns})


def invalid_country_count(raw: DataFrame) -> int:
    """Rows whose country (after upper/strip/synonyms) is not two letters, NULL included."""
    mapped = X.replace_values(X.strip_ws(F.upper("country_code")), S.COUNTRY_MAP)
    return int(raw.agg(F.count_if(~F.coalesce(mapped.rlike("^[A-Z]{2}$"), F.lit(False)))
                       .alias("n")).first()["n"])


def distinct_after(df: DataFrame) -> DataFrame:
    """T-9: distinct non-null values per standardised categorical (one aggregate)."""
    names = {"channels": "channel", "countries": "country_code",
             "genres": "game_genre", "os": "os_name"}
    present = {k: v for k, v in names.items() if v in df.columns}
    agg = df.agg(*[F.countDistinct(v).alias(k) for k, v in present.items()])
    pairs = F.array(*[F.struct(F.lit(k).alias("field"), F.col(k).alias("n_distinct"))
                      for k in present])
    return agg.select(F.explode(pairs).alias("_p")).select("_p.field", "_p.n_distinct")


# -- R: consistency repair ----------------------------------------------------

def _fix(name: str) -> str:
    return FIX_PREFIX + name


def repair(df: DataFrame) -> DataFrame:
    """R1-R6 with one 0/1 flag column per fix kind, counted before the change.

    Pairwise cascades look at adjacent *listed* columns that are both present;
    a missing middle column breaks the chain. Each cascade step is one layer of
    ``withColumns`` so the plan stays a short stack of projections.
    """
    cols = set(df.columns)
    out = df
    # R1 floor at zero
    layer = {}
    for c in S.NON_NEGATIVE_COLS:
        if c in cols:
            layer[_fix(f"{c}_negative")] = X.flag(F.col(c) < 0)
            layer[c] = X.clip_lo(c, 0)
    out = out.withColumns(layer)

    ret_pairs = [(a, b) for a, b in zip(S.RETENTION_COLS, S.RETENTION_COLS[1:]) if a in cols and b in cols]
    rev_pairs = [(a, b) for a, b in zip(S.REVENUE_COLS, S.REVENUE_COLS[1:]) if a in cols and b in cols]
    # R2 (down) and R4 (up) cascades share layers; step j fixes the j-th pair.
    for j in range(max(len(ret_pairs), len(rev_pairs))):
        layer = {}
        if j < len(ret_pairs):
            cur, nxt = ret_pairs[j]
            cond = F.col(nxt) > F.col(cur)
            layer[_fix(f"{nxt}_exceeds_{cur}")] = X.flag(cond)
            layer[nxt] = F.when(cond, F.col(cur)).otherwise(F.col(nxt))
        if j < len(rev_pairs):
            cur, nxt = rev_pairs[j]
            cond = F.col(nxt) < F.col(cur)
            layer[_fix(f"{nxt}_less_than_{cur}")] = X.flag(cond)
            layer[nxt] = F.when(cond, F.col(cur)).otherwise(F.col(nxt))
        out = out.withColumns(layer)

    # R3 retention <= installs (uses installs after R1)
    if "installs" in cols:
        layer = {}
        for c in S.RETENTION_COLS:
            if c in cols:
                cond = F.col(c) > F.col("installs")
                layer[_fix(f"{c}_exceeds_installs")] = X.flag(cond)
                layer[c] = F.when(cond, F.col("installs")).otherwise(F.col(c))
        out = out.withColumns(layer)

    # R5 components: iap + ad should equal revenue_d30 within 0.01
    if {"iap_revenue_d30", "ad_revenue_d30", "revenue_d30"} <= cols:
        total = F.col("iap_revenue_d30") + F.col("ad_revenue_d30")
        cond = F.abs(total - F.col("revenue_d30")) > 0.01
        out = out.withColumns({
            _fix("revenue_component_mismatch"): X.flag(cond),
            "revenue_d30": F.when(cond, F.greatest(F.col("revenue_d30"), total))
                            .otherwise(F.col("revenue_d30")),
        })

    # R6 payers <= retained users
    layer = {}
    for d in (7, 30):
        p, r = f"payers_d{d}", f"retained_users_d{d}"
        if p in cols and r in cols:
            cond = F.col(p) > F.col(r)
            layer[_fix(f"payers_d{d}_exceeds_retention")] = X.flag(cond)
            layer[p] = F.when(cond, F.col(r)).otherwise(F.col(p))
    if layer:
        out = out.withColumns(layer)
    return out


def fix_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c.startswith(FIX_PREFIX)]


def drop_fix_flags(df: DataFrame) -> DataFrame:
    return df.drop(*fix_columns(df))


def fix_report(flagged: DataFrame) -> DataFrame:
    """R7: (fix, rows) for every fix kind that changed at least one row; one aggregate."""
    flags = fix_columns(flagged)
    if not flags:
        return flagged.sparkSession.createDataFrame([], "fix string, rows long")
    sums = flagged.agg(*[F.sum(c).alias(c) for c in flags])
    pairs = F.array(*[F.struct(F.lit(c[len(FIX_PREFIX):]).alias("fix"), F.col(c).alias("rows"))
                      for c in flags])
    return (sums.select(F.explode(pairs).alias("_p")).select("_p.fix", "_p.rows")
            .filter(F.col("rows") > 0))


# -- O: outlier capping -------------------------------------------------------

def fit_caps(df: DataFrame, percentile: float = S.CAP_PERCENTILE,
             quantile_method: str = "exact", columns=S.CAP_COLS) -> dict:
    """Cap value per column: linear-interpolated quantile over non-null values."""
    present = [c for c in columns if c in df.columns]
    q = quantile_values(df, present, [percentile], method=quantile_method) if present else {}
    return {c: q[(c, float(percentile))] for c in present if (c, float(percentile)) in q}


def apply_caps(df: DataFrame, caps: dict) -> DataFrame:
    return df.withColumns({c: X.clip_hi(c, v) for c, v in caps.items()}) if caps else df


def cap_report(before: DataFrame, caps: dict) -> DataFrame:
    """O2: (column, count, cap_value) for columns where some value was above the cap."""
    spark = before.sparkSession
    if not caps:
        return spark.createDataFrame([], "column string, count long, cap_value double")
    sums = before.agg(*[F.count_if(F.col(c) > F.lit(v)).alias(c) for c, v in caps.items()])
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("count"),
                               F.lit(float(v)).alias("cap_value")) for c, v in caps.items()])
    return (sums.select(F.explode(pairs).alias("_p")).select("_p.column", "_p.count", "_p.cap_value")
            .filter(F.col("count") > 0))


def null_count_frame(df: DataFrame, initial_rows: int | None = None,
                     initial_columns: int | None = None) -> DataFrame:
    """O3: null count per column with the frame shape, one aggregate."""
    cols = df.columns
    agg = df.agg(F.count(F.lit(1)).alias("_rows"),
                 *[F.count_if(F.col(c).isNull()).alias(f"_n{i}") for i, c in enumerate(cols)])
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"_n{i}").alias("null_count"))
                      for i, c in enumerate(cols)])
    return agg.select(F.col("_rows").alias("rows"), F.lit(len(cols)).cast("long").alias("n_columns"),
                      F.explode(pairs).alias("_p")).select("_p.column", "_p.null_count", "rows",
                                                            "n_columns")


# -- whole cleaning stage -----------------------------------------------------

@dataclass
class Cleaned:
    frame: DataFrame                 # cleaned cohorts, 27 columns (+ extras)
    flagged: DataFrame               # repaired frame with the fix flag columns
    fills: dict = field(default_factory=dict)
    caps: dict = field(default_factory=dict)

    def fix_report(self) -> DataFrame:
        return fix_report(self.flagged)

    def cap_report(self) -> DataFrame:
        return cap_report(drop_fix_flags(self.flagged), self.caps)


def clean(df: DataFrame, cap_percentile: float = S.CAP_PERCENTILE, quantile_method: str = "exact",
          fill_target: bool = True, columns=None, write: bool = False) -> Cleaned:
    """C -> T -> R -> O in the reference's order. ``columns`` names those of the frame that
    the caller reads. With ``write`` the repaired rows are written once: the passes that fit
    the caps read the capped columns, and the frame is a scan with the caps."""
    filled, fills = fill_missing(df, quantile_method, fill_target)
    flagged = repair(standardize(filled))
    repaired = drop_fix_flags(flagged)
    wanted = list(columns or repaired.columns)
    repaired = repaired.select(*wanted, *[c for c in S.CAP_COLS if c in repaired.columns and c not in wanted])
    if write:
        repaired = staged(repaired, "repaired")
    caps = fit_caps(repaired, cap_percentile, quantile_method)
    return Cleaned(frame=apply_caps(repaired, caps).select(*wanted), flagged=flagged, fills=fills, caps=caps)
