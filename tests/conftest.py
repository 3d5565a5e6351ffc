import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from cohortlab.session import build_session

    s = build_session("local[*]", shuffle_partitions=8)
    yield s
    s.stop()


def cohort_row(**over):
    """One clean cohort row with every required column; override per test."""
    row = {
        "day": "2024-01-01", "game_id": "game_1", "game_genre": "RPG", "os_name": "iOS",
        "country_code": "US", "channel": "facebook", "campaign_id": "camp_1",
        "installs": 100, "network_cost": 200.0,
        "retained_users_d1": 50, "retained_users_d3": 40, "retained_users_d7": 30,
        "retained_users_d14": 20, "retained_users_d30": 10,
        "revenue_d1": 10.0, "revenue_d3": 20.0, "revenue_d7": 40.0, "revenue_d14": 80.0,
        "revenue_d30": 160.0, "revenue_d60": 200.0, "revenue_d90": 300.0,
        "iap_revenue_d30": 100.0, "ad_revenue_d30": 60.0,
        "sessions_d1": 120.0, "sessions_d7": 300.0, "payers_d7": 3, "payers_d30": 5,
    }
    row.update(over)
    return row


def cohort_frame(spark, rows):
    from cohortlab.schema import COHORT_SCHEMA

    names = [f.name for f in COHORT_SCHEMA.fields]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], COHORT_SCHEMA)
