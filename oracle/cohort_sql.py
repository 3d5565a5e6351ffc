"""

Each query is one ``WITH`` statement over the pre-registered views
(``orders``, ``customer``, ``lineitem``). CTE names:

raw        order-derived cohort table (adapter spec, FIXTURES.md section 3)
filled     C1-C4 missing-value handling
std        T-1..T-8 text / date standardisation
rep        R1-R6 consistency repair, with one 0/1 flag per fix
capped     O1 quantile capping
feat       F1-F22 row features
enc        E1-E6 encodings and composite scores
"""

from __future__ import annotations

RAW = r"""
li AS (
  SELECT l_orderkey, CAST(COALESCE(SUM(l_quantity), 0) AS BIGINT) AS qty,
         SUM(CAST(round(l_extendedprice * 100) AS BIGINT)) AS ext
  FROM lineitem GROUP BY l_orderkey),
b0 AS (
  SELECT CAST(o.o_orderkey AS BIGINT) AS k, CAST(o.o_custkey AS BIGINT) AS c,
         CAST(cu.c_nationkey AS BIGINT) AS n, cu.c_mktsegment AS seg, o.o_orderdate AS od,
         CAST(round(o.o_totalprice * 100) AS BIGINT) AS cents,
         COALESCE(li.qty, 0) AS qty, li.ext AS ext
  FROM orders o JOIN customer cu ON o.o_custkey = cu.c_custkey
  LEFT JOIN li ON li.l_orderkey = o.o_orderkey),
b1 AS (SELECT *, 1 + cents % 1500 AS i, COALESCE(ext, cents) % 2000000 AS rv FROM b0),
b2 AS (
  SELECT *, i * (18 + k % 14) // 100 AS r3, rv * (8 + k % 5) // 100 AS rev3,
         rv * (45 + k % 12) // 100 AS rev30, i * (3 + k % 5) // 100 AS ret30
  FROM b1),
b3 AS (
  SELECT *, CASE WHEN k % 41 = 0 THEN r3 + 5 ELSE i * (10 + k % 11) // 100 END AS ret7,
         rev30 * (k % 101) // 100 AS iap
  FROM b2),
raw0 AS (
  SELECT k,
    CASE WHEN k % 499 = 0 THEN 'bad-date' ELSE strftime(od, '%Y-%m-%d') END AS day,
    'game_' || CAST(c % 20 AS VARCHAR) AS game_id,
    CASE seg WHEN 'FURNITURE' THEN 'puzzle' WHEN 'MACHINERY' THEN 'role-playing'
             WHEN 'BUILDING' THEN 'STRATEGY ' WHEN 'AUTOMOBILE' THEN 'racing'
             ELSE 'match-3 casual' END AS game_genre,
    (['iOS', 'ios 17', 'iPhone', 'iPad OS', 'Android', 'ANDROID', 'android tv', 'Web'])[k % 8 + 1] AS os_name,
    CASE WHEN k % 89 = 0 THEN NULL ELSE
      (['US', 'us ', 'USA', 'GB', 'UK', 'United Kingdom', 'DE', 'FR', 'JP', 'BR', 'X1', 'IN'])[n % 12 + 1] END AS country_code,
    CASE WHEN k % 211 = 0 THEN NULL ELSE
      (['Facebook', 'fb', 'meta ', 'Google-Ads', 'google_ads', 'GOOGLE', 'Unity Ads', 'unityads', 'ironSource', 'tiktok'])[k % 10 + 1] END AS channel,
    CASE WHEN k % 65 = 0 THEN NULL ELSE 'camp_' || CAST(c % 50 AS VARCHAR) END AS campaign_id,
    CAST(CASE WHEN k % 97 = 0 THEN -1 - k % 40 ELSE i END AS BIGINT) AS installs,
    CASE WHEN k % 65 = 1 THEN NULL ELSE CAST(cents % 570000 AS DOUBLE) / 100 END AS network_cost,
    CAST(CASE WHEN k % 43 = 0 THEN i + 10 ELSE i * (30 + k % 25) // 100 END AS BIGINT) AS retained_users_d1,
    CAST(r3 AS BIGINT) AS retained_users_d3,
    CAST(ret7 AS BIGINT) AS retained_users_d7,
    CAST(i * (6 + k % 7) // 100 AS BIGINT) AS retained_users_d14,
    CAST(ret30 AS BIGINT) AS retained_users_d30,
    CAST(rv * (4 + k % 4) // 100 AS DOUBLE) / 100 AS revenue_d1,
    CAST(rev3 AS DOUBLE) / 100 AS revenue_d3,
    CAST(CASE WHEN k % 37 = 0 THEN rev3 // 2 ELSE rv * (14 + k % 7) // 100 END AS DOUBLE) / 100 AS revenue_d7,
    CAST(rv * (24 + k % 9) // 100 AS DOUBLE) / 100 AS revenue_d14,
    CAST(rev30 AS DOUBLE) / 100 AS revenue_d30,
    CAST(rv * (70 + k % 15) // 100 AS DOUBLE) / 100 AS revenue_d60,
    CAST(rv AS DOUBLE) / 100 AS revenue_d90,
    CAST(iap AS DOUBLE) / 100 AS iap_revenue_d30,
    CAST(rev30 - iap + CASE WHEN k % 53 = 0 THEN 500 ELSE 0 END AS DOUBLE) / 100 AS ad_revenue_d30,
    CAST(i * (12 + k % 9) AS DOUBLE) / 10 AS sessions_d1,
    CASE WHEN k % 71 = 0 THEN NULL ELSE CAST(i * (30 + qty % 40) AS DOUBLE) / 10 END AS sessions_d7,
    CAST(CASE WHEN k % 59 = 0 THEN ret7 + 3 ELSE ret7 * (k % 30) // 100 END AS BIGINT) AS payers_d7,
    CAST(ret30 * (5 + k % 40) // 100 AS BIGINT) AS payers_d30
  FROM b3),
raw AS (
  SELECT raw0.* FROM raw0 JOIN (SELECT 1 AS rep UNION ALL SELECT 2) r
    ON r.rep = 1 OR raw0.k % 70 = 3)"""


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes)
