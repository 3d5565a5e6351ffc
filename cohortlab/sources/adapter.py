"""Order-derived cohort table built from the TPC-H-like test tables.

Test scaffolding, not a library operator: the given tables hold no cohorts,
so one cohort row is derived per order, deterministically, with planned dirt
(bad dates, NULLs, synonyms, negative installs, broken cascades, component
mismatches, repeated rows). All amounts are integer cents until the final
division by 100. Work grows with ``orders`` / ``customer`` / ``lineitem``.

Plan: lineitem is pre-aggregated by order key (map-side partial agg), joined to
orders on the same key, and customers are joined on custkey; AQE turns the
customer join into a broadcast when the table is small at run time. Repeated
rows come from ``explode`` of a 1- or 2-element sequence, so orders are read once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Raw spellings planted into the derived table.
GENRE_BY_SEGMENT = {
    "FURNITURE": "puzzle",
    "MACHINERY": "role-playing",
    "BUILDING": "STRATEGY ",
    "AUTOMOBILE": "racing",
}
GENRE_OTHER = "match-3 casual"
OS_BY_K8 = ("iOS", "ios 17", "iPhone", "iPad OS", "Android", "ANDROID", "android tv", "Web")
COUNTRY_BY_N12 = ("US", "us ", "USA", "GB", "UK", "United Kingdom", "DE", "FR", "JP", "BR", "X1", "IN")
CHANNEL_BY_K10 = ("Facebook", "fb", "meta ", "Google-Ads", "google_ads", "GOOGLE",
                  "Unity Ads", "unityads", "ironSource", "tiktok")


def _pick(index: Column, values: tuple[str, ...]) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def _div(a: Column, b: int) -> Column:
    """Integer division of non-negative longs (exact: values stay far below 2^53)."""
    return F.floor(a.cast("long") / F.lit(b)).cast("long")


def cohorts_from_orders(spark: SparkSession, sf_dir: str, with_key: bool = True) -> DataFrame:
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet").select(
        "c_custkey", "c_nationkey", "c_mktsegment")
    lines = (spark.read.parquet(f"{sf_dir}/lineitem.parquet")
             .groupBy("l_orderkey")
             .agg(F.sum("l_quantity").alias("_qty"),
                  F.sum(F.round(F.col("l_extendedprice") * 100).cast("long")).alias("_ext")))
    b = (orders.join(customer, orders.o_custkey == customer.c_custkey)
         .join(lines, orders.o_orderkey == lines.l_orderkey, "left"))

    k = F.col("o_orderkey").cast("long")
    c = F.col("o_custkey").cast("long")
    n = F.col("c_nationkey").cast("long")
    cents = F.round(F.col("o_totalprice") * 100).cast("long")
    b = b.select(
        k.alias("k"), c.alias("c"), n.alias("n"), F.col("c_mktsegment").alias("seg"),
        F.col("o_orderdate").alias("od"), cents.alias("cents"),
        F.coalesce(F.col("_qty"), F.lit(0.0)).cast("long").alias("qty"),
        (F.coalesce(F.col("_ext"), cents) % 2000000).alias("rv"),
    ).withColumn("i", 1 + F.col("cents") % 1500)

    K, I, RV = F.col("k"), F.col("i"), F.col("rv")

    def pct(base: Column, lo: int, mod: int) -> Column:
        return _div(base * (lo + K % mod), 100)

    genre = None
    for seg, g in GENRE_BY_SEGMENT.items():
        genre = (F.when(F.col("seg") == seg, F.lit(g)) if genre is None
                 else genre.when(F.col("seg") == seg, F.lit(g)))
    genre = genre.otherwise(F.lit(GENRE_OTHER))

    r3 = pct(I, 18, 14)
    rev3 = pct(RV, 8, 5)
    rev30 = pct(RV, 45, 12)
    ret7 = F.when(K % 41 == 0, r3 + 5).otherwise(pct(I, 10, 11))
    ret30 = pct(I, 3, 5)
    iap = _div(rev30 * (K % 101), 100)
    cols = {
        "k": K,
        "day": F.when(K % 499 == 0, F.lit("bad-date")).otherwise(F.date_format("od", "yyyy-MM-dd")),
        "game_id": F.concat(F.lit("game_"), (F.col("c") % 20).cast("string")),
        "game_genre": genre,
        "os_name": _pick(K % 8, OS_BY_K8),
        "country_code": F.when(K % 89 == 0, F.lit(None).cast("string")).otherwise(
            _pick(F.col("n") % 12, COUNTRY_BY_N12)),
        "channel": F.when(K % 211 == 0, F.lit(None).cast("string")).otherwise(
            _pick(K % 10, CHANNEL_BY_K10)),
        "campaign_id": F.when(K % 65 == 0, F.lit(None).cast("string")).otherwise(
            F.concat(F.lit("camp_"), (F.col("c") % 50).cast("string"))),
        "installs": F.when(K % 97 == 0, -1 - K % 40).otherwise(I).cast("long"),
        "network_cost": F.when(K % 65 == 1, F.lit(None).cast("double")).otherwise(
            (F.col("cents") % 570000) / F.lit(100.0)),
        "retained_users_d1": F.when(K % 43 == 0, I + 10).otherwise(pct(I, 30, 25)).cast("long"),
        "retained_users_d3": r3.cast("long"),
        "retained_users_d7": ret7.cast("long"),
        "retained_users_d14": pct(I, 6, 7).cast("long"),
        "retained_users_d30": ret30.cast("long"),
        "revenue_d1": pct(RV, 4, 4) / F.lit(100.0),
        "revenue_d3": rev3 / F.lit(100.0),
        "revenue_d7": F.when(K % 37 == 0, _div(rev3, 2)).otherwise(pct(RV, 14, 7)) / F.lit(100.0),
        "revenue_d14": pct(RV, 24, 9) / F.lit(100.0),
        "revenue_d30": rev30 / F.lit(100.0),
        "revenue_d60": pct(RV, 70, 15) / F.lit(100.0),
        "revenue_d90": RV / F.lit(100.0),
        "iap_revenue_d30": iap / F.lit(100.0),
        "ad_revenue_d30": (rev30 - iap + F.when(K % 53 == 0, 500).otherwise(0)) / F.lit(100.0),
        "sessions_d1": I * (12 + K % 9) / F.lit(10.0),
        "sessions_d7": F.when(K % 71 == 0, F.lit(None).cast("double")).otherwise(
            I * (30 + F.col("qty") % 40) / F.lit(10.0)),
        "payers_d7": F.when(K % 59 == 0, ret7 + 3).otherwise(_div(ret7 * (K % 30), 100)).cast("long"),
        "payers_d30": _div(ret30 * (5 + K % 40), 100).cast("long"),
    }
    if not with_key:
        cols.pop("k")
    out = b.select(*[v.alias(name) for name, v in cols.items()],
                   F.when(K % 70 == 3, 2).otherwise(1).alias("_copies"))
    out = out.withColumn("_rep", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
    return out.drop("_copies", "_rep")
