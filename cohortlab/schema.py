"""Column names, column groups and default thresholds of the cohort table.

One row of the cohort table is one acquisition cohort: a day x game x OS x
country x channel x campaign, with cumulative metrics by day offset
(``revenue_dN`` is revenue up to day N, ``retained_users_dN`` the users still
active on day N).
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# The names, groups, maps and thresholds below must equal the
# reference behaviour for results to match. Keep them as written.
# ---------------------------------------------------------------------------

REQUIRED_COLUMNS: dict[str, T.DataType] = {
    "day": T.StringType(),
    "game_id": T.StringType(),
    "game_genre": T.StringType(),
    "os_name": T.StringType(),
    "country_code": T.StringType(),
    "channel": T.StringType(),
    "campaign_id": T.StringType(),
    "installs": T.LongType(),
    "network_cost": T.DoubleType(),
    "retained_users_d1": T.LongType(),
    "retained_users_d3": T.LongType(),
    "retained_users_d7": T.LongType(),
    "retained_users_d14": T.LongType(),
    "retained_users_d30": T.LongType(),
    "revenue_d1": T.DoubleType(),
    "revenue_d3": T.DoubleType(),
    "revenue_d7": T.DoubleType(),
    "revenue_d14": T.DoubleType(),
    "revenue_d30": T.DoubleType(),
    "revenue_d60": T.DoubleType(),
    "revenue_d90": T.DoubleType(),
    "iap_revenue_d30": T.DoubleType(),
    "ad_revenue_d30": T.DoubleType(),
    "sessions_d1": T.DoubleType(),
    "sessions_d7": T.DoubleType(),
    "payers_d7": T.LongType(),
    "payers_d30": T.LongType(),
}

COHORT_SCHEMA = T.StructType(
    [T.StructField(name, dtype, True) for name, dtype in REQUIRED_COLUMNS.items()]
)

CATEGORICAL_COLS = ("game_genre", "os_name", "country_code", "channel")
KEY_METRICS = ("installs", "network_cost", "revenue_d30", "revenue_d90")

NON_NEGATIVE_COLS = (
    "installs", "network_cost", "retained_users_d1", "retained_users_d3",
    "retained_users_d7", "retained_users_d14", "retained_users_d30",
    "revenue_d1", "revenue_d3", "revenue_d7", "revenue_d14", "revenue_d30",
    "revenue_d60", "revenue_d90", "iap_revenue_d30", "ad_revenue_d30",
    "sessions_d1", "sessions_d7", "payers_d7", "payers_d30",
)

RETENTION_COLS = (
    "retained_users_d1", "retained_users_d3", "retained_users_d7",
    "retained_users_d14", "retained_users_d30",
)
REVENUE_COLS = (
    "revenue_d1", "revenue_d3", "revenue_d7", "revenue_d14",
    "revenue_d30", "revenue_d60", "revenue_d90",
)
CAP_COLS = (
    "network_cost", "revenue_d1", "revenue_d3", "revenue_d7",
    "revenue_d14", "revenue_d30", "revenue_d60", "revenue_d90",
    "iap_revenue_d30", "ad_revenue_d30", "sessions_d1", "sessions_d7",
)

RETENTION_DAYS = (1, 3, 7, 14, 30)
REVENUE_DAYS = (1, 3, 7, 14, 30, 60, 90)
PAYER_DAYS = (7, 30)
SESSION_DAYS = (1, 7)

CHANNEL_MAP = {
    "fb": "facebook",
    "meta": "facebook",
    "googleads": "google",
    "google_ads": "google",
    "unityads": "unity",
    "unity_ads": "unity",
    "ironsource": "ironsource",
}
COUNTRY_MAP = {
    "USA": "US",
    "UK": "GB",
    "UNITED KINGDOM": "GB",
}
TIER1_COUNTRIES = ("US", "GB", "CA", "AU", "DE", "FR", "JP")
UNKNOWN_CAMPAIGN = "unknown"
INVALID_COUNTRY = "XX"

# Quality gate defaults (ingestion) and the softer pipeline-level warning.
MAX_MISSING_RATE = 0.05
MIN_RECORDS = 1000
MAX_DUPLICATE_RATE = 0.02
CAP_PERCENTILE = 0.99
IMPACT_MEAN_CHANGE = 0.01

# Modelling defaults.
TARGET_DAY = 90
TEST_SIZE = 0.2
VAL_SIZE = 0.2
CV_FOLDS = 5
RANDOM_STATE = 42
LEAKAGE_KEYWORDS = ("d60", "d90", "d45", "d120", "d180")
EARLY_STOP_ROUNDS = 10
GBT_PARAMS = {"n_estimators": 100, "max_depth": 6, "learning_rate": 0.1}
METADATA_COLS = ("day", "game_id", "game_genre", "os_name", "country_code", "channel")

# Drift defaults.
N_BINS = 10
PSI_THRESHOLDS = {"low": 0.1, "medium": 0.2, "high": 0.25}
KS_THRESHOLDS = {"low": 0.05, "medium": 0.1, "high": 0.2}
PSI_FLOOR = 1e-10
TOP_CATEGORIES = 10

# Feature-group name filters used by the feature statistics report.
FEATURE_GROUPS = {
    "retention": ("retention",),
    "revenue": ("revenue", "arpi", "arpu"),
    "monetization": ("payer", "monetization"),
    "engagement": ("session",),
    "efficiency": ("roas", "cost", "cpi"),
    "categorical": ("frequency", "is_"),
    "composite": ("score",),
}


def target_column(target_day: int = TARGET_DAY) -> str:
    return f"revenue_d{target_day}"
