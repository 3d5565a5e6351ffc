"""DuckDB SQL twins of the registered queries (same names, same output columns).

CTE chains are assembled from small SQL snippets; float outputs are rounded to
4 decimals like the Spark side.
"""

from __future__ import annotations

from oracle.cohort_sql import RAW

# Fixed values (same as the library constants; repeated here so the oracle
# stands on its own).
COLS = ["k", "day", "game_id", "game_genre", "os_name", "country_code", "channel", "campaign_id",
        "installs", "network_cost", "retained_users_d1", "retained_users_d3", "retained_users_d7",
        "retained_users_d14", "retained_users_d30", "revenue_d1", "revenue_d3", "revenue_d7",
        "revenue_d14", "revenue_d30", "revenue_d60", "revenue_d90", "iap_revenue_d30",
        "ad_revenue_d30", "sessions_d1", "sessions_d7", "payers_d7", "payers_d30"]
NUMERIC = COLS[8:]
INT_COLS = {"k", "installs", "retained_users_d1", "retained_users_d3", "retained_users_d7",
            "retained_users_d14", "retained_users_d30", "payers_d7", "payers_d30"}
CATS = ["game_genre", "os_name", "country_code", "channel"]
KEY_METRICS = ["installs", "network_cost", "revenue_d30", "revenue_d90"]
NON_NEG = ["installs", "network_cost", "retained_users_d1", "retained_users_d3", "retained_users_d7",
           "retained_users_d14", "retained_users_d30", "revenue_d1", "revenue_d3", "revenue_d7",
           "revenue_d14", "revenue_d30", "revenue_d60", "revenue_d90", "iap_revenue_d30",
           "ad_revenue_d30", "sessions_d1", "sessions_d7", "payers_d7", "payers_d30"]
RET = ["retained_users_d1", "retained_users_d3", "retained_users_d7", "retained_users_d14", "retained_users_d30"]
REV = ["revenue_d1", "revenue_d3", "revenue_d7", "revenue_d14", "revenue_d30", "revenue_d60", "revenue_d90"]
CAPS = ["network_cost", "revenue_d1", "revenue_d3", "revenue_d7", "revenue_d14", "revenue_d30",
        "revenue_d60", "revenue_d90", "iap_revenue_d30", "ad_revenue_d30", "sessions_d1", "sessions_d7"]
CHANNEL_MAP = [("fb", "facebook"), ("meta", "facebook"), ("googleads", "google"), ("google_ads", "google"),
               ("unityads", "unity"), ("unity_ads", "unity"), ("ironsource", "ironsource")]
COUNTRY_MAP = [("USA", "US"), ("UK", "GB"), ("UNITED KINGDOM", "GB")]
TIER1 = ["US", "GB", "CA", "AU", "DE", "FR", "JP"]
GROUPS = [("retention", "retention"), ("revenue", "revenue|arpi|arpu"), ("monetization", "payer|monetization"),
          ("engagement", "session"), ("efficiency", "roas|cost|cpi"), ("categorical", "frequency|is_"), ("composite", "score")]
SPLIT_DAY = "1998-04-17"
DRIFT_NUM = ["installs", "network_cost", "revenue_d7", "revenue_d30", "sessions_d1", "retained_users_d7"]
DRIFT_CAT = ["channel", "os_name", "country_code", "game_genre"]
DRIFT_NUM_T = DRIFT_NUM + ["revenue_d90"]


def lit(x) -> str:
    return f"CAST({x!r} AS DOUBLE)" if isinstance(x, float) else str(x)


def lo(e: str, k) -> str:
    return f"(CASE WHEN {e} < {lit(k)} THEN {lit(k)} ELSE {e} END)"


def hi(e: str, k) -> str:
    return f"(CASE WHEN {e} > {lit(k)} THEN {lit(k)} ELSE {e} END)"


def ratio(num: str, den: str, floor) -> str:
    return f"(CAST({num} AS DOUBLE) / {lo(den, floor)})"


def flag(cond: str) -> str:
    return f"CAST(CASE WHEN {cond} THEN 1 ELSE 0 END AS BIGINT)"


def r4(e: str) -> str:
    return f"round({e}, 4)"


def strip(e: str) -> str:
    return f"regexp_replace({e}, '^\\s+|\\s+$', '', 'g')"


def sql_channel(c: str) -> str:
    base = f"regexp_replace(lower({c}), '[^a-z0-9_]', '', 'g')"
    whens = " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in CHANNEL_MAP)
    return f"(CASE {base} {whens} ELSE {base} END)"


def sql_country(c: str) -> str:
    base = strip(f"upper({c})")
    whens = " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in COUNTRY_MAP)
    mapped = f"(CASE {base} {whens} ELSE {base} END)"
    return f"(CASE WHEN regexp_full_match({mapped}, '[A-Z]{{2}}') THEN {mapped} ELSE 'XX' END)"


def sql_country_valid(c: str) -> str:
    base = strip(f"upper({c})")
    whens = " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in COUNTRY_MAP)
    return f"COALESCE(regexp_full_match((CASE {base} {whens} ELSE {base} END), '[A-Z]{{2}}'), false)"


def sql_os(c: str) -> str:
    low = f"lower({c})"
    return (f"(CASE WHEN regexp_matches({low}, 'ios|iphone|ipad') THEN 'iOS' "
            f"WHEN contains({low}, 'android') THEN 'Android' ELSE {low} END)")


CASED = r"\p{Lu}\p{Ll}\p{Lt}"


def sql_title(c: str) -> str:
    runs = f"regexp_extract_all({c}, '[{CASED}]+|[^{CASED}]+')"
    fix = (f"list_transform({runs}, lambda x: CASE WHEN regexp_matches(x, '^[{CASED}]') "
           f"THEN upper(x[1]) || lower(x[2:]) ELSE x END)")
    return strip(f"array_to_string({fix}, '')")


def sql_day(c: str) -> str:
    return f"CAST(try_strptime({c}, '%Y-%m-%d') AS DATE)"


def sorted_list(col: str) -> str:
    """Aggregate: the non-null values of ``col`` as an ascending list."""
    return f"list_sort(list(CAST({col} AS DOUBLE)) FILTER (WHERE {col} IS NOT NULL))"


def qpick(lst: str, q) -> str:
    """Linear-interpolated quantile of a sorted list: ranks floor / ceil of
    (n - 1) q, value lo + (hi - lo) * frac (the library's definition)."""
    pos = f"((len({lst}) - 1) * CAST({float(q)!r} AS DOUBLE))"
    lo = f"{lst}[CAST(floor({pos}) AS BIGINT) + 1]"
    hi = f"{lst}[CAST(ceil({pos}) AS BIGINT) + 1]"
    return f"(CASE WHEN len({lst}) = 0 THEN NULL ELSE {lo} + ({hi} - {lo}) * ({pos} - floor({pos})) END)"


def hash_bits(key: str, salt: str) -> str:
    return f"CAST(('0x' || substr(md5('{salt}|' || CAST({key} AS VARCHAR)), 1, 8)) AS BIGINT)"


class Chain:
    """CTE chain with an explicit column list (DuckDB has no positional replace)."""

    def __init__(self, src: str, cols):
        self.src, self.cols, self.ctes = src, list(cols), []

    def step(self, name: str, over: dict | None = None, new: dict | None = None, tail: str = "") -> "Chain":
        over, new = over or {}, new or {}
        items = [f"{over[c]} AS {c}" if c in over else c for c in self.cols]
        items += [f"{e} AS {n}" for n, e in new.items()]
        self.ctes.append(f"{name} AS (SELECT {', '.join(items)} FROM {self.src} {tail})")
        self.cols += [n for n in new if n not in self.cols]
        self.src = name
        return self


def filled_ctes() -> list[str]:
    ctes = [
        f"chan_l AS (SELECT channel, {sorted_list('network_cost')} AS l FROM raw "
        "WHERE channel IS NOT NULL AND network_cost IS NOT NULL GROUP BY channel)",
        f"chan_med AS (SELECT channel, {qpick('l', 0.5)} AS med FROM chan_l)",
    ]
    over = {c: f"raw.{c}" for c in COLS}
    over["campaign_id"] = "COALESCE(raw.campaign_id, 'unknown')"
    over["network_cost"] = "COALESCE(raw.network_cost, chan_med.med)"
    ctes.append("f1 AS (SELECT " + ", ".join(f"{over[c]} AS {c}" for c in COLS) +
                " FROM raw LEFT JOIN chan_med ON raw.channel = chan_med.channel)")
    ctes.append(f"gmed AS (SELECT {qpick('l', 0.5)} AS g FROM (SELECT {sorted_list('network_cost')} AS l FROM f1))")
    over = {c: f"COALESCE({c}, 0)" for c in NUMERIC}
    over["k"] = "COALESCE(k, 0)"
    over["network_cost"] = "COALESCE(network_cost, (SELECT g FROM gmed), 0)"
    ctes.append("filled AS (SELECT " + ", ".join(f"{over.get(c, c)} AS {c}" for c in COLS) + " FROM f1)")
    return ctes


def std_cte(src: str = "filled", name: str = "std", extra=()) -> str:
    over = {"channel": sql_channel("channel"), "country_code": sql_country("country_code"),
            "os_name": sql_os("os_name"), "game_genre": sql_title("game_genre"), "day": sql_day("day")}
    items = [f"{over[c]} AS {c}" if c in over else c for c in COLS] + list(extra)
    return f"{name} AS (SELECT {', '.join(items)} FROM {src})"


def rep_chain(src: str = "std", extra=()) -> Chain:
    ch = Chain(src, COLS + list(extra))
    ch.step("r1", over={c: lo(c, 0) for c in NON_NEG},
            new={f"fx_{c}_negative": flag(f"{c} < 0") for c in NON_NEG})
    ret_pairs = list(zip(RET, RET[1:]))
    rev_pairs = list(zip(REV, REV[1:]))
    for j in range(max(len(ret_pairs), len(rev_pairs))):
        over, new = {}, {}
        if j < len(ret_pairs):
            a, b = ret_pairs[j]
            new[f"fx_{b}_exceeds_{a}"] = flag(f"{b} > {a}")
            over[b] = f"CASE WHEN {b} > {a} THEN {a} ELSE {b} END"
        if j < len(rev_pairs):
            a, b = rev_pairs[j]
            new[f"fx_{b}_less_than_{a}"] = flag(f"{b} < {a}")
            over[b] = f"CASE WHEN {b} < {a} THEN {a} ELSE {b} END"
        ch.step(f"rc{j}", over=over, new=new)
    ch.step("r3", over={c: f"CASE WHEN {c} > installs THEN installs ELSE {c} END" for c in RET},
            new={f"fx_{c}_exceeds_installs": flag(f"{c} > installs") for c in RET})
    tot = "(iap_revenue_d30 + ad_revenue_d30)"
    mis = f"abs({tot} - revenue_d30) > 0.01"
    ch.step("r5", over={"revenue_d30": f"CASE WHEN {mis} THEN greatest(revenue_d30, {tot}) ELSE revenue_d30 END"},
            new={"fx_revenue_component_mismatch": flag(mis)})
    ch.step("rep", over={f"payers_d{d}": f"CASE WHEN payers_d{d} > retained_users_d{d} THEN retained_users_d{d} "
                                          f"ELSE payers_d{d} END" for d in (7, 30)},
            new={f"fx_payers_d{d}_exceeds_retention": flag(f"payers_d{d} > retained_users_d{d}") for d in (7, 30)})
    return ch


def capped_ctes() -> list[str]:
    lists = ", ".join(f"{sorted_list(c)} AS l_{c}" for c in CAPS)
    caps = ", ".join(f"{qpick(f'l_{c}', 0.99)} AS cap_{c}" for c in CAPS)
    over = {c: f"CASE WHEN {c} > (SELECT cap_{c} FROM caps) THEN (SELECT cap_{c} FROM caps) ELSE {c} END"
            for c in CAPS}
    return [f"caps AS (SELECT {caps} FROM (SELECT {lists} FROM rep))",
            "capped AS (SELECT " + ", ".join(f"{over.get(c, c)} AS {c}" for c in COLS) + " FROM rep)"]


def clean_ctes() -> list[str]:
    return [RAW] + filled_ctes() + [std_cte()] + rep_chain().ctes + capped_ctes()


def feat_ctes() -> list[str]:
    ch = Chain("capped", COLS)
    l1 = {}
    for d in (1, 3, 7, 14, 30):
        l1[f"retention_rate_d{d}"] = ratio(f"retained_users_d{d}", "installs", 1)
    for d in (1, 7, 14, 30):
        l1[f"arpi_d{d}"] = ratio(f"revenue_d{d}", "installs", 1)
    for d in (1, 7, 30):
        l1[f"arpu_d{d}"] = ratio(f"revenue_d{d}", f"retained_users_d{d}", 1)
    for a, b in ((1, 7), (7, 30), (1, 30)):
        l1[f"revenue_growth_d{a}_d{b}"] = hi(ratio(f"revenue_d{b}", f"revenue_d{a}", 0.01), 50)
    l1["early_monetization_ratio"] = ratio("revenue_d7", "revenue_d30", 0.01)
    for d in (7, 30):
        l1[f"payer_conversion_d{d}"] = ratio(f"payers_d{d}", "installs", 1)
        l1[f"arppu_d{d}"] = ratio(f"revenue_d{d}", f"payers_d{d}", 1)
    tot = lo("(iap_revenue_d30 + ad_revenue_d30)", 0.01)
    l1["iap_revenue_share"] = f"(iap_revenue_d30 / {tot})"
    l1["ad_revenue_share"] = f"(ad_revenue_d30 / {tot})"
    for d in (1, 7):
        l1[f"sessions_per_install_d{d}"] = ratio(f"sessions_d{d}", "installs", 1)
        l1[f"sessions_per_retained_d{d}"] = ratio(f"sessions_d{d}", f"retained_users_d{d}", 1)
        l1[f"revenue_per_session_d{d}"] = ratio(f"revenue_d{d}", f"sessions_d{d}", 1)
    l1["session_growth_d1_d7"] = hi(ratio("sessions_d7", "sessions_d1", 0.01), 20)
    l1["cpi"] = ratio("network_cost", "installs", 1)
    for d in (1, 7, 14, 30):
        l1[f"roas_d{d}"] = ratio(f"revenue_d{d}", "network_cost", 0.01)
    for d in (7, 30):
        l1[f"cost_per_retained_d{d}"] = ratio("network_cost", f"retained_users_d{d}", 1)
    ch.step("feat1", new=l1)
    l2 = {
        "retention_decay_d1_d7": lo("(retention_rate_d1 - retention_rate_d7)", 0),
        "retention_decay_d7_d30": lo("(retention_rate_d7 - retention_rate_d30)", 0),
        "retention_stability": ratio("retention_rate_d30", "retention_rate_d1", 0.001),
        "revenue_acceleration": hi(lo(ratio("revenue_growth_d7_d30", "revenue_growth_d1_d7", 0.1), 0.1), 10),
        "is_iap_dominant": flag("iap_revenue_share > 0.7"),
        "is_ad_dominant": flag("ad_revenue_share > 0.7"),
        "is_hybrid_monetization": flag("iap_revenue_share > 0.3 AND ad_revenue_share > 0.3"),
        "is_profitable_d30": flag("roas_d30 > 1.0"),
    }
    ch.step("feat", new=l2)
    return ch.ctes, ch.cols


def enc_ctes():
    ctes, cols = feat_ctes()
    for c in CATS:
        ctes.append(f"fq_{c} AS (SELECT {c} AS v, count(*) AS f FROM feat WHERE {c} IS NOT NULL GROUP BY {c})")
    joins = " ".join(f"LEFT JOIN fq_{c} ON feat.{c} = fq_{c}.v" for c in CATS)
    ctes.append("encf AS (SELECT feat.*, " + ", ".join(f"fq_{c}.f AS {c}_frequency" for c in CATS) +
                f" FROM feat {joins})")
    lists = ", ".join(f"{sorted_list(f'{c}_frequency')} AS l_{c}" for c in CATS)
    ctes.append("thr AS (SELECT " + ", ".join(f"{qpick(f'l_{c}', 0.8)} AS t_{c}" for c in CATS) +
                f", {qpick('l_arpi', 0.95)} AS q_arpi, {qpick('l_spr', 0.95)} AS q_spr FROM (SELECT {lists}, "
                f"{sorted_list('arpi_d7')} AS l_arpi, {sorted_list('sessions_per_retained_d7')} AS l_spr FROM encf))")
    qa, qs = "(SELECT q_arpi FROM thr)", "(SELECT q_spr FROM thr)"
    arpi_n = (f"(CASE WHEN {qa} > 0 THEN " + hi(lo(f"(arpi_d7 / {qa})", 0), 1) + " ELSE arpi_d7 END)")
    spr_n = (f"(CASE WHEN {qs} > 0 THEN " + hi(lo(f"(sessions_per_retained_d7 / {qs})", 0), 1) +
             " ELSE sessions_per_retained_d7 END)")
    roas_n = hi(lo("(roas_d7 / 2.0)", 0), 1)
    new = {f"{c}_is_common": flag(f"{c}_frequency > (SELECT t_{c} FROM thr)") for c in CATS}
    new["is_ios"] = flag("os_name = 'iOS'")
    new["is_android"] = flag("os_name = 'Android'")
    new["is_tier1_country"] = flag("country_code IN (" + ", ".join(f"'{t}'" for t in TIER1) + ")")
    new["early_performance_score"] = (f"(retention_rate_d7 * {lit(0.3)} + {arpi_n} * {lit(0.4)} + "
                                      f"{roas_n} * {lit(0.3)})")
    new["cohort_quality_score"] = (f"(retention_rate_d30 * {lit(0.4)} + payer_conversion_d30 * {lit(0.3)} + "
                                   f"{spr_n} * {lit(0.3)})")
    ctes.append("enc0 AS (SELECT encf.*, " + ", ".join(f"{e} AS {n}" for n, e in new.items()) +
                " FROM encf)")
    feats = sorted(set(cols[len(COLS):]) | {f"{c}_frequency" for c in CATS} | set(new) |
                   {"installs", "network_cost"})
    allc = cols + [f"{c}_frequency" for c in CATS] + list(new)
    over = {f: f"COALESCE({f}, 0)" for f in feats}
    ctes.append("enc AS (SELECT " + ", ".join(f"{over.get(c, c)} AS {c}" for c in allc) + " FROM enc0)")
    return ctes, feats


def sql(*ctes_and_final) -> str:
    *ctes, final = ctes_and_final
    flat = []
    for c in ctes:
        flat.extend(c if isinstance(c, list) else [c])
    return "WITH " + ",\n".join(x.strip() for x in flat) + "\n" + final


def union_all(parts) -> str:
    return "\nUNION ALL\n".join(parts)


# -- queries ---------------------------------------------------------------------

def _q_quality() -> dict:
    cols27 = COLS[1:]
    q = {}
    q["quality_counts"] = sql(RAW, f"SELECT count(*) AS total_records, CAST({len(cols27)} AS BIGINT) AS total_columns FROM raw")
    dup = f"dups AS (SELECT count(*) AS c FROM raw GROUP BY {', '.join(cols27)})"
    q["quality_duplicates"] = sql(RAW, dup, "SELECT CAST(sum(c - 1) AS BIGINT) AS duplicate_count, "
                                            "round(sum(c - 1) / sum(c), 4) AS duplicate_rate FROM dups")
    miss = union_all(f"SELECT '{c}' AS \"column\", round(count_if({c} IS NULL) / count(*), 4) AS missing_rate, "
                     f"count_if({c} IS NULL) AS n FROM raw" for c in cols27)
    q["quality_missing"] = sql(RAW, f"m AS ({miss})", 'SELECT "column", missing_rate FROM m WHERE n > 0')
    d = sql_day("day")
    q["quality_dates"] = sql(RAW, f"SELECT strftime(min({d}), '%Y-%m-%d') AS min_date, strftime(max({d}), '%Y-%m-%d') AS max_date, "
                                  f"CAST(date_diff('day', min({d}), max({d})) AS BIGINT) AS span_days FROM raw")
    q["quality_distinct"] = sql(RAW, union_all(
        f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS n_distinct FROM raw" for c in CATS))
    q["quality_numeric"] = sql(RAW, union_all(
        f"SELECT '{c}' AS \"column\", round(avg({c}), 4) AS mean, "
        f"round((SELECT {qpick('l', 0.5)} FROM (SELECT {sorted_list(c)} AS l FROM raw)), 4) AS median, "
        f"round(CAST(min({c}) AS DOUBLE), 4) AS \"min\", round(CAST(max({c}) AS DOUBLE), 4) AS \"max\", "
        f"count_if({c} < 0) AS negative_count FROM raw" for c in KEY_METRICS))
    # strict test thresholds: min_records 20000, max_duplicate_rate 0.01, max_missing_rate 0.012
    parts = [
        "SELECT 'error' AS severity, 'min_records' AS \"check\", CAST(NULL AS VARCHAR) AS \"column\", "
        "CAST(count(*) AS DOUBLE) AS value, CAST(20000 AS DOUBLE) AS \"limit\" FROM raw HAVING count(*) < 20000",
        "SELECT 'error', 'duplicate_rate', NULL, round(sum(c - 1) / sum(c), 4), 0.01::DOUBLE FROM dups "
        "HAVING sum(c - 1) / sum(c) > 0.01",
    ]
    q["quality_warnings"] = sql(RAW, dup, union_all(p.replace("'error'", "'warn'") for p in parts))
    parts += [f"SELECT 'error', 'missing_rate', '{c}', round(count_if({c} IS NULL) / count(*), 4), 0.012::DOUBLE "
              f"FROM raw HAVING count_if({c} IS NULL) / count(*) > 0.012" for c in cols27]
    q["quality_issues"] = sql(RAW, dup, union_all(parts))
    # impact: raw vs cleaned
    rows = [f"SELECT 'day' AS \"column\", 'span_days' AS stat, "
            f"CAST((SELECT date_diff('day', min({d}), max({d})) FROM raw) AS DOUBLE) AS before, "
            f"CAST((SELECT date_diff('day', min(day), max(day)) FROM capped) AS DOUBLE) AS after"]
    rows += [f"SELECT '{c}', 'n_distinct', CAST((SELECT count(DISTINCT {c}) FROM raw) AS DOUBLE), "
             f"CAST((SELECT count(DISTINCT {c}) FROM capped) AS DOUBLE)" for c in CATS]
    for c in KEY_METRICS:
        for stat, fn in (("mean", "avg"), ("min", "min"), ("max", "max")):
            rows.append(f"SELECT '{c}', '{stat}', CAST((SELECT {fn}({c}) FROM raw) AS DOUBLE), "
                        f"CAST((SELECT {fn}({c}) FROM capped) AS DOUBLE)")
    imp = f"imp AS ({union_all(rows)})"
    q["impact_report"] = sql(clean_ctes(), imp,
                             'SELECT "column", stat, round(before, 4) AS before, round(after, 4) AS after, '
                             "CASE WHEN stat = 'mean' THEN before IS NOT NULL AND after IS NOT NULL AND before <> 0 "
                             "AND abs(after - before) / abs(before) > 0.01 ELSE after IS DISTINCT FROM before END AS changed FROM imp")
    return q


def _q_clean() -> dict:
    q = {}
    fc = [RAW] + filled_ctes()
    q["fill_constant"] = sql(fc, "SELECT campaign_id, count(*) AS rows FROM filled GROUP BY campaign_id")
    q["fill_group_median"] = sql(fc, "SELECT channel, round(med, 4) AS channel_median FROM chan_med")
    q["fill_network_cost"] = sql(fc, "SELECT k, channel, round(network_cost, 4) AS network_cost FROM filled "
                                     "WHERE k IN (SELECT k FROM raw WHERE network_cost IS NULL)")
    q["fill_zero"] = sql(fc, union_all(
        f"SELECT '{c}' AS \"column\", count_if({c} IS NULL) AS nulls_after, round(sum(CAST({c} AS DOUBLE)), 4) AS sum_after "
        f"FROM filled" for c in NUMERIC))
    parts = ["SELECT 'campaign_id' AS \"column\", count_if(campaign_id IS NULL) AS filled, 0 AS o FROM raw"]
    parts += [f"SELECT '{c}', count_if({c} IS NULL), {i + 1} FROM raw" for i, c in enumerate(NUMERIC)]
    q["fill_counts"] = sql(RAW, f"fc AS ({union_all(parts)})", 'SELECT "column", filled FROM fc WHERE filled > 0')
    for name, col, fn in (("norm_channel", "channel", sql_channel), ("norm_country", "country_code", sql_country),
                          ("norm_os", "os_name", sql_os), ("norm_genre", "game_genre", sql_title)):
        q[name] = sql(fc, f"SELECT {col} AS raw_{col}, {fn(col)} AS {col}, count(*) AS rows FROM filled GROUP BY ALL")
    sc = fc + [std_cte()]
    q["parse_day"] = sql(sc, "SELECT count(day) AS parsed, count_if(day IS NULL) AS invalid, "
                             "strftime(min(day), '%Y-%m-%d') AS min_day, strftime(max(day), '%Y-%m-%d') AS max_day FROM std")
    forms = {"dotted": "day", "with_time": "day", "as_date": "day", "as_timestamp": "day"}
    q["parse_day_inferred"] = sql(sc, union_all(
        f"SELECT '{f}' AS form, count({c}) AS parsed, count_if({c} IS NULL) AS invalid, "
        f"strftime(min({c}), '%Y-%m-%d') AS min_day, strftime(max({c}), '%Y-%m-%d') AS max_day FROM std" for f, c in forms.items()))
    q["norm_distinct"] = sql(sc, union_all(
        f"SELECT '{f}' AS field, count(DISTINCT {c}) AS n_distinct FROM std"
        for f, c in (("channels", "channel"), ("countries", "country_code"), ("genres", "game_genre"), ("os", "os_name"))))
    q["invalid_countries"] = sql(fc, f"SELECT count_if(NOT {sql_country_valid('country_code')}) AS invalid FROM filled")
    rc = sc + rep_chain().ctes
    q["fix_nonneg"] = sql(rc, union_all(
        f"SELECT '{c}' AS \"column\", (SELECT count_if({c} < 0) FROM std) AS negatives_before, "
        f"(SELECT count_if({c} < 0) FROM rep) AS negatives_after" for c in NON_NEG))

    def changed(cols):
        extra = [f"{c} AS b_{c}" for c in cols]
        chain = rep_chain("stdb", extra=[f"b_{c}" for c in cols])
        ctes = fc + [std_cte()] + [f"stdb AS (SELECT *, {', '.join(extra)} FROM std)"] + chain.ctes
        return sql(ctes, union_all(
            f"SELECT '{c}' AS \"column\", round(sum(CAST({c} AS DOUBLE)), 4) AS sum_after, "
            f"count_if({c} <> b_{c}) AS rows_changed FROM rep" for c in cols))

    q["fix_retention"] = changed(RET)
    q["fix_revenue"] = changed(REV)
    q["fix_payers"] = changed(["payers_d7", "payers_d30"])
    q["fix_components"] = sql(rc, "SELECT CAST(sum(fx_revenue_component_mismatch) AS BIGINT) AS rows_mismatch, "
                                  "round(sum(revenue_d30), 4) AS revenue_d30_sum FROM rep")
    fixes = [c for c in rep_chain().cols if c.startswith("fx_")]
    q["fix_report"] = sql(rc, f"fr AS ({union_all(f'SELECT {chr(39)}{c[3:]}{chr(39)} AS fix, CAST(sum({c}) AS BIGINT) AS rows FROM rep' for c in fixes)})",
                          "SELECT fix, rows FROM fr WHERE rows > 0")
    cc = clean_ctes()
    q["cap_outliers"] = sql(cc, union_all(
        f"SELECT '{c}' AS \"column\", round(max({c}), 4) AS max_after, round(sum({c}), 4) AS sum_after, "
        f"round((SELECT cap_{c} FROM caps), 4) AS cap_value FROM capped" for c in CAPS))
    q["cap_report"] = sql(cc, f"cr AS ({union_all(f'SELECT {chr(39)}{c}{chr(39)} AS {chr(34)}column{chr(34)}, count_if({c} > (SELECT cap_{c} FROM caps)) AS count, round((SELECT cap_{c} FROM caps), 4) AS cap_value FROM rep' for c in CAPS)})",
                          'SELECT "column", count, cap_value FROM cr WHERE count > 0')
    q["clean_summary"] = sql(cc, union_all(
        f"SELECT '{c}' AS \"column\", count_if({c} IS NULL) AS null_count, count(*) AS rows, "
        f"CAST({len(COLS) - 1} AS BIGINT) AS n_columns FROM capped" for c in COLS[1:]))
    return q


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
INT_FEATURES = {"is_iap_dominant", "is_ad_dominant", "is_hybrid_monetization", "is_profitable_d30"}


def _q_features() -> dict:
    q = {}
    fctes, _ = feat_ctes()
    base = clean_ctes() + fctes
    for name, cols in FEATURE_BLOCKS.items():
        sel = ", ".join(c if c in INT_FEATURES else f"round({c}, 4) AS {c}" for c in cols)
        q[name] = sql(base, f"SELECT k, {sel} FROM feat")
    q["enc_frequency"] = sql(clean_ctes(), union_all(
        f"SELECT '{c}' AS \"column\", {c} AS value, count(*) AS frequency FROM capped WHERE {c} IS NOT NULL GROUP BY {c}"
        for c in CATS))
    ectes, feats = enc_ctes()
    full = clean_ctes() + ectes
    q["enc_common"] = sql(full, union_all(
        f"SELECT '{c}' AS \"column\", CAST(sum({c}_is_common) AS BIGINT) AS common_rows, "
        f"round((SELECT t_{c} FROM thr), 4) AS threshold FROM enc" for c in CATS))
    q["enc_flags"] = sql(full, "SELECT CAST(sum(is_ios) AS BIGINT) AS is_ios, CAST(sum(is_android) AS BIGINT) AS is_android, "
                               "CAST(sum(is_tier1_country) AS BIGINT) AS is_tier1_country, count(*) AS rows FROM enc")
    q["score_early"] = sql(full, "SELECT k, round(early_performance_score, 4) AS early_performance_score FROM enc")
    q["score_quality"] = sql(full, "SELECT k, round(cohort_quality_score, 4) AS cohort_quality_score FROM enc")
    q["feature_clean"] = sql(full, union_all(
        f"SELECT '{f}' AS feature, count_if({f} IS NULL) AS nulls, round(sum(CAST({f} AS DOUBLE)), 4) AS total FROM enc"
        for f in feats))
    cols = list(dict.fromkeys([*NUMERIC, *feats]))
    counted = "SELECT " + ", ".join(f'count_if({c} <> 0) AS "{c}"' for c in cols) + " FROM enc"
    filled = [f"value_counts AS ({counted})", "value_rows AS (UNPIVOT value_counts ON COLUMNS(*) INTO NAME feature VALUE filled)"]
    q["leakage_filter"] = sql(full, *filled, "SELECT feature, CAST(filled AS BIGINT) AS filled, "
                              "NOT regexp_matches(feature, 'd60|d90|d45|d120|d180') AS kept FROM value_rows")
    of_model = "feature IN (" + ", ".join(f"'{f}'" for f in feats) + ")"
    q["feature_stats"] = sql(full, *filled, union_all(
        [f"SELECT 'initial_columns' AS name, CAST({len(COLS)} AS BIGINT) AS value, CAST(NULL AS BIGINT) AS filled",
         "SELECT 'features_created' AS name, CAST(57 AS BIGINT) AS value, CAST(NULL AS BIGINT) AS filled",
         f"SELECT 'final_feature_count' AS name, count(*) AS value, CAST(sum(filled) AS BIGINT) AS filled FROM value_rows WHERE {of_model}"]
        + [f"SELECT 'group_{g}' AS name, count(*) AS value, CAST(sum(filled) AS BIGINT) AS filled FROM value_rows "
           f"WHERE {of_model} AND regexp_matches(feature, '{keys}')" for g, keys in GROUPS]))
    return q


def split_ctes() -> list[str]:
    h = hash_bits("k", "42")
    hv = hash_bits("k", "42|val")
    hf = hash_bits("k", "42|fold")
    over = {"revenue_d90": lo("revenue_d90", 0)}
    items = ", ".join(f"{over.get(c, c)} AS {c}" for c in COLS)
    return clean_ctes() + [
        f"tgt AS (SELECT {items} FROM capped WHERE revenue_d90 IS NOT NULL)",
        f"sp AS (SELECT *, CASE WHEN {h} < 0.2 * 4294967296.0 THEN 'test' WHEN {hv} < 0.2 * 4294967296.0 "
        f"THEN 'val' ELSE 'train' END AS split, CAST({hf} % 5 AS BIGINT) AS fold, "
        f"revenue_d30 * 2.0 AS prediction FROM tgt)"]


def metrics_sql(by: str, src: str = "sp", rnd: bool = True) -> str:
    y, p = "revenue_d90", "prediction"
    r = r4 if rnd else (lambda e: e)
    return (f"SELECT {by}, count(*) AS n, {r(f'avg(abs({y} - {p}))')} AS mae, "
            f"{r(f'sqrt(avg(({y} - {p}) * ({y} - {p})))')} AS rmse, "
            f"{r(f'1 - sum(({y} - {p}) * ({y} - {p})) / (var_pop({y}) * count(*))')} AS r2, "
            f"{r(f'avg(abs({y} - {p}) / {lo(y, 1.0)}) * 100')} AS mape, "
            f"{r(f'sum({y})')} AS total_actual, {r(f'sum({p})')} AS total_predicted, "
            f"{r(f'abs(sum({p}) - sum({y})) / sum({y}) * 100')} AS total_error_pct FROM {src} GROUP BY {by}")


def _q_model() -> dict:
    q = {}
    sp = split_ctes()
    q["split_assign"] = sql(sp, "SELECT split, count(*) AS rows, round(sum(revenue_d90), 4) AS target_sum FROM sp GROUP BY split")
    q["fold_assign"] = sql(sp, "SELECT fold, count(*) AS rows FROM sp GROUP BY fold")
    ranked = ("rk AS (SELECT k, row_number() OVER (ORDER BY {h}, k) AS nth, count(*) OVER () AS n FROM tgt)",
              "vk AS (SELECT k, row_number() OVER (ORDER BY {hv}, k) AS nth, count(*) OVER () AS n FROM rk WHERE nth > ceil(CAST(0.2 AS DOUBLE) * n))")
    ranked = [r.format(h=hash_bits("k", "42"), hv=hash_bits("k", "42|val")) for r in ranked]
    q["split_exact"] = sql(sp[:-1], *ranked,
                           "SELECT k, 'test' AS split FROM rk WHERE nth <= ceil(CAST(0.2 AS DOUBLE) * n) UNION ALL "
                           "SELECT k, CASE WHEN nth <= ceil(CAST(0.2 AS DOUBLE) * n) THEN 'val' ELSE 'train' END AS split FROM vk")
    q["run_counts"] = sql(sp[:-1], "c AS (SELECT count(*) AS n, CAST(ceil(CAST(0.2 AS DOUBLE) * count(*)) AS BIGINT) AS t FROM tgt)",
                          "d AS (SELECT n, t, CAST(ceil(CAST(0.2 AS DOUBLE) * (n - t)) AS BIGINT) AS v FROM c)",
                          "SELECT n AS rows, n AS row_keys, CAST(59 AS BIGINT) AS n_features, n - t - v AS train_rows, v AS val_rows, t AS test_rows FROM d")
    names = ("mae", "rmse", "r2", "mape", "total_actual", "total_predicted", "total_error_pct")
    cv = ("rmse_mean", "rmse_std", "r2_mean", "r2_std")
    q["metric_report_naive"] = sql(
        sp, f"bs AS ({metrics_sql('split')})", f"pf AS ({metrics_sql('fold', rnd=False)})",
        "cv AS (SELECT round(avg(rmse), 4) AS rmse_mean, round(stddev_pop(rmse), 4) AS rmse_std, "
        "round(avg(r2), 4) AS r2_mean, round(stddev_pop(r2), 4) AS r2_std FROM pf)",
        union_all([f"SELECT split AS section, '{m}' AS metric, CAST({m} AS DOUBLE) AS value FROM bs WHERE split IN ('train', 'test')" for m in names]
                  + [f"SELECT 'cv' AS section, '{m}' AS metric, {m} AS value FROM cv" for m in cv]
                  + ["SELECT 'data' AS section, 'total_samples' AS metric, CAST(count(*) AS DOUBLE) AS value FROM sp",
                     "SELECT 'data' AS section, 'n_features' AS metric, CAST(59 AS DOUBLE) AS value"]
                  + [f"SELECT 'data' AS section, '{x}_samples' AS metric, CAST(count(*) AS DOUBLE) AS value FROM sp WHERE split = '{x}'"
                     for x in ("train", "val", "test")]))
    q["label_encode"] = sql(clean_ctes(),
                            "lv AS (SELECT COALESCE(channel, 'unknown') AS v, channel AS raw_channel FROM capped)",
                            "codes AS (SELECT v, CAST(row_number() OVER (ORDER BY v) - 1 AS BIGINT) AS code FROM (SELECT DISTINCT v FROM lv))",
                            "SELECT raw_channel, code, count(*) AS rows FROM lv JOIN codes USING (v) GROUP BY raw_channel, code")
    q["eval_metrics"] = sql(sp, metrics_sql("split"))
    q["cv_metrics"] = sql(sp, f"pf AS ({metrics_sql('fold')})", "SELECT fold, n, rmse, r2, mae FROM pf")
    q["cv_summary"] = sql(sp, f"pf AS ({metrics_sql('fold', rnd=False)})",
                          "SELECT round(avg(rmse), 4) AS rmse_mean, round(stddev_pop(rmse), 4) AS rmse_std, "
                          "round(avg(r2), 4) AS r2_mean, round(stddev_pop(r2), 4) AS r2_std FROM pf")
    q["export_frame"] = sql(sp, "SELECT k, split, round(prediction, 4) AS prediction, "
                                "round(revenue_d90 - prediction, 4) AS prediction_error FROM sp")
    keep = "round(prediction, 4) AS prediction, round(revenue_d90, 4) AS revenue_d90, game_id, game_genre, os_name, country_code, channel, strftime(day, '%Y-%m-%d') AS day"
    q["predictions_union"] = sql(sp, f"SELECT {keep} FROM sp WHERE split <> 'test' UNION ALL SELECT {keep} FROM sp WHERE split = 'test'")
    return q


def drift_ctes() -> list[str]:
    over = {"network_cost": "network_cost * 1.5", "channel": "CASE WHEN k % 17 = 0 THEN 'newnet' ELSE channel END"}
    cur = ", ".join(f"{over.get(c, c)} AS {c}" for c in COLS)
    ctes = clean_ctes() + [
        f"dbase AS (SELECT * FROM capped WHERE day < DATE '{SPLIT_DAY}')",
        f"dcur AS (SELECT {cur} FROM capped WHERE day >= DATE '{SPLIT_DAY}')",
    ]
    for side, src in (("bl", "dbase"), ("cl", "dcur")):
        ctes.append(f"{side} AS (" + union_all(
            f"SELECT '{c}' AS \"column\", CAST({c} AS DOUBLE) AS v FROM {src} WHERE {c} IS NOT NULL" for c in DRIFT_NUM_T) + ")")
    for side, src in (("bc", "dbase"), ("cc", "dcur")):
        ctes.append(f"{side} AS (" + union_all(
            f"SELECT '{c}' AS \"column\", CAST({c} AS VARCHAR) AS v FROM {src} WHERE {c} IS NOT NULL" for c in DRIFT_CAT) + ")")
    for side, src in (("b", "bl"), ("c", "cl")):
        picks = ", ".join(qpick("l", (i * 0.1 if i < 10 else 1.0)) for i in range(11))
        ctes.append(f"{side}_edges AS (SELECT \"column\", list_sort(list_distinct([{picks}])) AS edges "
                    f"FROM (SELECT \"column\", {sorted_list('v')} AS l FROM {src} GROUP BY \"column\"))")
        ctes.append(f"{side}_tot AS (SELECT \"column\", count(*) AS total FROM {src} GROUP BY \"column\")")
    # histograms: own edges (closed range) and current on baseline edges (outer bins open)
    for name, vals, edges, open_ in (("h_b", "bl", "b_edges", False), ("h_c_own", "cl", "c_edges", False),
                                     ("h_c_base", "cl", "b_edges", True)):
        tot = "b_tot" if vals == "bl" else "c_tot"
        raw_bin = "least(len(list_filter(e.edges, lambda x: x <= t.v)) - 1, len(e.edges) - 2)"
        binexpr = f"greatest({raw_bin}, 0)" if open_ else \
            f"CASE WHEN t.v >= e.edges[1] AND t.v <= e.edges[-1] THEN {raw_bin} END"
        ctes.append(f"{name}_cnt AS (SELECT \"column\", bin, count(*) AS cnt FROM (SELECT t.\"column\", {binexpr} AS bin "
                    f"FROM {vals} t JOIN {edges} e ON t.\"column\" = e.\"column\" WHERE len(e.edges) >= 2) WHERE bin IS NOT NULL GROUP BY ALL)")
        ctes.append(f"{name} AS (SELECT g.\"column\", g.bin, COALESCE(c.cnt, 0) / g.total AS share FROM "
                    f"(SELECT e.\"column\", t.total, unnest(range(0, len(e.edges) - 1)) AS bin FROM {edges} e "
                    f"JOIN {tot} t ON e.\"column\" = t.\"column\" WHERE len(e.edges) >= 2) g "
                    f"LEFT JOIN {name}_cnt c ON g.\"column\" = c.\"column\" AND g.bin = c.bin)")
    for side, src in (("cs_b", "bc"), ("cs_c", "cc")):
        ctes.append(f"{side} AS (SELECT \"column\", v AS value, count(*) AS count, "
                    f"count(*) / sum(count(*)) OVER (PARTITION BY \"column\") AS share, "
                    f"CASE WHEN row_number() OVER (PARTITION BY \"column\" ORDER BY count(*) DESC, v ASC) <= 10 THEN "
                    f"CAST(row_number() OVER (PARTITION BY \"column\" ORDER BY count(*) DESC, v ASC) AS BIGINT) END AS rank "
                    f"FROM {src} GROUP BY \"column\", v)")
    return ctes


def psi_cte(name: str, exp: str, act: str, key: str = "bin") -> str:
    return (f"{name} AS (SELECT \"column\", sum((a - e) * ln(a / e)) AS psi FROM ("
            f"SELECT \"column\", e / sum(e) OVER (PARTITION BY \"column\") AS e, a / sum(a) OVER (PARTITION BY \"column\") AS a FROM ("
            f"SELECT x.\"column\", greatest(x.share, 1e-10) AS e, greatest(y.share, 1e-10) AS a FROM {exp} x JOIN {act} y "
            f"ON x.\"column\" = y.\"column\" AND x.{key} = y.{key})) GROUP BY \"column\")")


def num_stats(src: str, quart: bool) -> str:
    q = (f", round({qpick('l', 0.25)}, 4) AS q25, round({qpick('l', 0.75)}, 4) AS q75" if quart else "")
    return (f"SELECT \"column\", n, mean, std, \"min\", \"max\"{q} FROM (SELECT \"column\", count(v) AS n, "
            f"round(avg(v), 4) AS mean, round(stddev_samp(v), 4) AS std, round(min(v), 4) AS \"min\", "
            f"round(max(v), 4) AS \"max\", {sorted_list('v')} AS l FROM {src} GROUP BY \"column\")")


def ks_p(d: str, n1: str, n2: str) -> str:
    z = f"({d} * sqrt({n1} * {n2} / ({n1} + {n2})))"
    small = (f"(1 - sqrt(2 * pi()) / {z} * (SELECT sum(exp(-((2 * j - 1) * (2 * j - 1)) * pi() * pi() / (8 * {z} * {z}))) "
             f"FROM range(1, 21) r(j)))")
    large = f"(2 * (SELECT sum(pow(-1.0, j - 1) * exp(-2.0 * j * j * {z} * {z})) FROM range(1, 101) r(j)))"
    return (f"CASE WHEN {z} <= 0 THEN 1.0 ELSE least(1.0, greatest(0.0, "
            f"CASE WHEN {z} < 1.18 THEN {small} ELSE {large} END)) END")


def _q_drift() -> dict:
    q = {}
    dc = drift_ctes()
    q["base_numeric"] = sql(dc, num_stats("bl", True))
    q["base_categorical"] = sql(dc, "SELECT \"column\", value, count, round(share, 4) AS share, rank FROM cs_b")
    q["hist_quantile"] = sql(dc, "SELECT \"column\", bin, round(share, 4) AS share FROM h_b")
    uni = ("u_rng AS (SELECT \"column\", count(*) AS total, CASE WHEN min(v) = max(v) THEN min(v) - 0.5 ELSE min(v) END AS lo, "
           "CASE WHEN min(v) = max(v) THEN max(v) + 0.5 ELSE max(v) END AS hi FROM bl GROUP BY \"column\")")
    ucnt = ("u_cnt AS (SELECT t.\"column\", CAST(least(floor((t.v - r.lo) * 10 / (r.hi - r.lo)), 9) AS BIGINT) AS bin, count(*) AS cnt "
            "FROM bl t JOIN u_rng r ON t.\"column\" = r.\"column\" GROUP BY ALL)")
    q["hist_uniform"] = sql(dc, uni, ucnt,
                            "SELECT g.\"column\", g.bin, round(COALESCE(c.cnt, 0) / g.total, 4) AS share FROM "
                            "(SELECT \"column\", total, unnest(range(0, 10)) AS bin FROM u_rng) g "
                            "LEFT JOIN u_cnt c ON g.\"column\" = c.\"column\" AND g.bin = c.bin")
    p_base = psi_cte("p_base", "h_b", "h_c_base")
    p_own = psi_cte("p_own", "h_b", "h_c_own")
    q["psi_numeric"] = sql(dc, p_base, p_own,
                           "SELECT COALESCE(a.\"column\", b.\"column\") AS \"column\", round(a.psi, 4) AS psi_baseline_edges, "
                           "round(b.psi, 4) AS psi_own_edges FROM p_base a FULL JOIN p_own b ON a.\"column\" = b.\"column\"")
    p_cat = psi_cte("p_cat", "cs_b", "cs_c", key="value")
    q["psi_categorical"] = sql(dc, p_cat, "SELECT \"column\", round(psi, 4) AS psi FROM p_cat")
    kc = ("kc AS (SELECT \"column\", v, count_if(side = 0) AS ca, count_if(side = 1) AS cb FROM "
          "(SELECT \"column\", v, 0 AS side FROM bl UNION ALL SELECT \"column\", v, 1 AS side FROM cl) GROUP BY \"column\", v)")
    kr = ("kr AS (SELECT \"column\", sum(ca) OVER w AS cum_a, sum(cb) OVER w AS cum_b, "
          "sum(ca) OVER (PARTITION BY \"column\") AS n_a, sum(cb) OVER (PARTITION BY \"column\") AS n_b FROM kc "
          "WINDOW w AS (PARTITION BY \"column\" ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))")
    ks = ("ks AS (SELECT \"column\", max(abs(cum_a / n_a - cum_b / n_b)) AS statistic, CAST(max(n_a) AS BIGINT) AS n_a, "
          "CAST(max(n_b) AS BIGINT) AS n_b FROM kr GROUP BY \"column\")")
    q["ks_two_sample"] = sql(dc, kc, kr, ks,
                             f"SELECT \"column\", round(statistic, 4) AS statistic, "
                             f"round({ks_p('statistic', 'CAST(n_a AS DOUBLE)', 'CAST(n_b AS DOUBLE)')}, 4) AS p_value, n_a, n_b FROM ks")
    sev = ("CASE WHEN psi > 0.25 THEN 'high' WHEN psi > 0.2 THEN 'medium' WHEN psi > 0.1 THEN 'low' ELSE 'none' END")
    nd = ("nd AS (SELECT c.\"column\", COALESCE(p.psi, 0.0) AS psi, c.mean - b.mean AS mean_shift, "
          "CASE WHEN b.std > 0 THEN c.std / b.std ELSE 1.0 END AS std_ratio FROM "
          "(SELECT \"column\", avg(v) AS mean, stddev_samp(v) AS std FROM cl GROUP BY \"column\") c "
          "JOIN (SELECT \"column\", avg(v) AS mean, stddev_samp(v) AS std FROM bl GROUP BY \"column\") b ON c.\"column\" = b.\"column\" "
          "LEFT JOIN p_base p ON c.\"column\" = p.\"column\")")
    num_filter = "\"column\" IN (" + ", ".join(f"'{c}'" for c in DRIFT_NUM) + ")"
    q["drift_numeric"] = sql(dc, p_base, nd,
                             f"SELECT \"column\", round(psi, 4) AS psi, {sev} AS severity, ({sev}) <> 'none' AS drift_detected, "
                             f"round(mean_shift, 4) AS mean_shift, round(std_ratio, 4) AS std_ratio FROM nd WHERE {num_filter}")
    cd = ("cd AS (SELECT c.\"column\", p.psi, "
          "COALESCE((SELECT string_agg(v, ',' ORDER BY v) FROM (SELECT DISTINCT value AS v FROM cs_c x WHERE x.\"column\" = c.\"column\" "
          "EXCEPT SELECT value FROM cs_b y WHERE y.\"column\" = c.\"column\" AND y.rank <= 10)), '') AS new_categories, "
          "COALESCE((SELECT string_agg(v, ',' ORDER BY v) FROM (SELECT value AS v FROM cs_b y WHERE y.\"column\" = c.\"column\" AND y.rank <= 10 "
          "EXCEPT SELECT value FROM cs_c x WHERE x.\"column\" = c.\"column\")), '') AS missing_categories "
          "FROM (SELECT DISTINCT \"column\" FROM cs_c) c LEFT JOIN p_cat p ON c.\"column\" = p.\"column\")")
    n_new = "(CASE WHEN new_categories = '' THEN 0 ELSE len(string_split(new_categories, ',')) END)"
    csev = (f"CASE WHEN psi IS NULL THEN 'none' WHEN psi > 0.2 OR {n_new} > 3 THEN 'high' "
            f"WHEN psi > 0.1 OR {n_new} > 0 THEN 'medium' ELSE 'none' END")
    q["drift_categorical"] = sql(dc, p_cat, cd,
                                 f"SELECT \"column\", round(psi, 4) AS psi, {csev} AS severity, ({csev}) <> 'none' AS drift_detected, "
                                 f"new_categories, missing_categories FROM cd")
    top = "(SELECT * FROM cs_b WHERE rank <= 10)"
    q["drift_category_changes"] = sql(dc, (
        f"SELECT \"column\", value, 'new' AS kind, count FROM cs_c c WHERE \"column\" IN (SELECT \"column\" FROM cs_b) AND NOT EXISTS "
        f"(SELECT 1 FROM {top} b WHERE b.\"column\" = c.\"column\" AND b.value = c.value) UNION ALL "
        f"SELECT \"column\", value, 'missing', count FROM {top} b WHERE \"column\" IN (SELECT \"column\" FROM cs_c) AND NOT EXISTS "
        f"(SELECT 1 FROM cs_c c WHERE b.\"column\" = c.\"column\" AND b.value = c.value)"))
    q["drift_target"] = sql(dc, p_base, nd, "SELECT round(psi, 4) AS psi, round(mean_shift, 4) AS mean_shift, "
                                            "psi > 0.2 AS drift_detected FROM nd WHERE \"column\" = 'revenue_d90'")
    feats = (f"feats AS (SELECT \"column\", psi, {sev} AS severity FROM nd WHERE {num_filter} "
             f"UNION ALL SELECT \"column\", psi, {csev} AS severity FROM cd)")
    summ = ("summ AS (SELECT count(*) AS n_features_checked, count_if(severity <> 'none') AS n_drifted_features, "
            "count_if(severity <> 'none') / greatest(count(*), 1) AS drift_rate, "
            "COALESCE(max(CASE WHEN severity <> 'none' THEN COALESCE(psi, 0.0) END), 0.0) AS max_psi FROM feats)")
    tgt = "tgt_d AS (SELECT psi > 0.2 AS t, psi FROM nd WHERE \"column\" = 'revenue_d90')"
    q["drift_summary"] = sql(dc, p_base, nd, p_cat, cd, feats, summ, tgt,
                             "SELECT n_features_checked, n_drifted_features, round(drift_rate, 4) AS drift_rate, "
                             "round(max_psi, 4) AS max_psi, (drift_rate > 0.2 OR max_psi > 0.25 OR "
                             "COALESCE((SELECT bool_or(t) FROM tgt_d), false)) AS drift_detected FROM summ")
    order = ", ".join(f"('{c}', {i})" for i, c in enumerate(DRIFT_NUM + DRIFT_CAT))
    alerts = (
        f"ord AS (SELECT * FROM (VALUES {order}) o(\"column\", pos)), "
        "hi_f AS (SELECT f.\"column\", o.pos FROM feats f JOIN ord o ON f.\"column\" = o.\"column\" WHERE f.severity = 'high'), "
        "al AS ("
        "SELECT 1 AS o, 'HIGH' AS severity, 'High drift detected in ' || CAST(count(*) AS VARCHAR) || ' features' AS message, "
        "(SELECT string_agg(\"column\", ',' ORDER BY pos) FROM (SELECT \"column\", pos FROM hi_f ORDER BY pos LIMIT 5)) AS features, "
        "'Consider model retraining' AS action FROM hi_f HAVING count(*) > 0 "
        "UNION ALL SELECT 2, CASE WHEN drift_rate > 0.3 THEN 'HIGH' ELSE 'MEDIUM' END, "
        "printf('%.0f', drift_rate * 100) || '% of features show drift', NULL, "
        "CASE WHEN drift_rate > 0.3 THEN 'Immediate model review recommended' ELSE 'Monitor closely and prepare for retraining' END "
        "FROM summ WHERE drift_rate > 0.15 "
        "UNION ALL SELECT 3, 'HIGH', 'Target variable drift detected (PSI: ' || printf('%.3f', psi) || ')', NULL, "
        "'Investigate business changes and retrain model' FROM tgt_d WHERE t)")
    q["drift_alerts"] = sql(dc, p_base, nd, p_cat, cd, feats, summ, tgt, alerts,
                            "SELECT severity, message, features, action FROM al")
    return q


def _q_flagship() -> dict:
    ectes, _ = enc_ctes()
    return {"channel_roas": sql(clean_ctes() + ectes,
                                "SELECT channel, count(*) AS cohorts, CAST(sum(installs) AS BIGINT) AS installs, "
                                "round(sum(network_cost), 4) AS cost, round(sum(revenue_d30), 4) AS revenue_d30, "
                                "round(avg(roas_d7), 4) AS avg_roas_d7, round(avg(roas_d30), 4) AS avg_roas_d30, "
                                "round(avg(cohort_quality_score), 4) AS avg_quality_score FROM enc GROUP BY channel")}


def _round4(text: str) -> str:
    """Rewrite every ``round(<expr>, 4)`` as ``round((<expr>) * 10000.0) / 10000.0``
    (rounding of the binary product, as on the Spark side)."""
    out, i = [], 0
    while True:
        j = text.find("round(", i)
        if j < 0:
            out.append(text[i:])
            return "".join(out)
        depth, k = 0, j + len("round")
        while True:
            ch = text[k]
            depth += ch == "("
            depth -= ch == ")"
            if depth == 0:
                break
            k += 1
        inner = text[j + len("round("):k]
        if inner.rstrip().endswith(", 4"):
            expr = _round4(inner.rstrip()[:-3])
            out.append(text[i:j] + f"(round(({expr}) * 10000.0) / 10000.0)")
        else:
            out.append(text[i:j] + "round(" + _round4(inner) + ")")
        i = k + 1


def _bigint_counts(text: str) -> str:
    """``count_if`` returns HUGEINT in DuckDB; cast each to BIGINT like Spark's."""
    out, i = [], 0
    while True:
        j = text.find("count_if(", i)
        if j < 0:
            out.append(text[i:])
            return "".join(out)
        depth, k = 0, j + len("count_if")
        while True:
            depth += text[k] == "("
            depth -= text[k] == ")"
            if depth == 0:
                break
            k += 1
        inner = _bigint_counts(text[j + len("count_if("):k])
        out.append(text[i:j] + f"CAST(count_if({inner}) AS BIGINT)")
        i = k + 1


def oracle_queries() -> dict[str, str]:
    out = _q_flagship()
    for part in (_q_quality, _q_clean, _q_features, _q_model, _q_drift):
        out.update(part())
    return {name: _bigint_counts(_round4(text)) for name, text in out.items()}
