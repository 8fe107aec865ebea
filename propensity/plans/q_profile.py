"""Profiling and cleaning queries (A1-A12, A21, P1-P7, F1-F3, F10, F11,
F14, U3)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import clean, profile
from ..sources.leads import leads
from ..sources.readers import read_table
from .catalog import ISO_SQL, query, rnd
from .sql import LEADS, with_

LEAD_COLS = [("lead_id", "bigint", "numerical"), ("lead_origin", "string", "categorical"),
             ("lead_source", "string", "categorical"), ("city", "string", "categorical"),
             ("last_activity", "string", "categorical"),
             ("total_visits", "double", "numerical"),
             ("time_on_website", "double", "numerical"),
             ("page_views_per_visit", "double", "numerical"),
             ("converted", "int", "numerical")]
CATS = [c for c, _, k in LEAD_COLS if k == "categorical"]
NUMS = ["total_visits", "time_on_website", "page_views_per_visit", "converted"]
FEATURE_NUMS = ["total_visits", "time_on_website", "page_views_per_visit"]
LINE_MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


# ---------------------------------------------------------------- A1 A2
@query("column_stats", with_(LEADS) + "\n" + _union([
    f"SELECT '{c}' AS column_name, COUNT(DISTINCT {c}) AS n_distinct, "
    + ("ROUND(VAR_SAMP(lead_id) / 1000000, 0) * 1000000" if c == "lead_id"
       else f"ROUND(VAR_SAMP({c}), 6)" if k == "numerical" else "CAST(NULL AS DOUBLE)") + " AS var_samp FROM leads"
    for c, _, k in LEAD_COLS]))
def q_column_stats(spark, sf):
    d = leads(spark, sf)
    # the key's variance is large: compared in millions, in Spark and in the oracle
    s = profile.column_stats(d)
    return rnd(s.withColumn("var_samp", F.when(F.col("column_name") == "lead_id", F.round(F.col("var_samp") / 1000000, 0) * 1000000)
                            .otherwise(F.col("var_samp"))))


# ---------------------------------------------------------------- P4-P7
_WIDE = LEADS + """,
wide AS (
  SELECT *, 'web' AS channel,
         CASE WHEN last_activity = 'F' THEN NULL ELSE 5.0 END AS batch_flag,
         CASE WHEN lead_origin = '1-URGENT' THEN total_visits END AS urgent_visits,
         CAST(NULL AS DOUBLE) AS empty_col
  FROM leads)"""
_WIDE_COLS = [c for c, _, _ in LEAD_COLS] + ["channel", "batch_flag", "urgent_visits",
                                             "empty_col"]
_WIDE_NUM = {c for c, _, k in LEAD_COLS if k == "numerical"} | {
    "batch_flag", "urgent_visits", "empty_col"}


def leads_wide(spark, sf):
    d = leads(spark, sf)
    return d.select(
        "*", F.lit("web").alias("channel"),
        F.when(F.col("last_activity") == "F", None).otherwise(F.lit(5.0)).alias("batch_flag"),
        F.when(F.col("lead_origin") == "1-URGENT", F.col("total_visits")).alias("urgent_visits"),
        F.lit(None).cast("double").alias("empty_col"))


def _drop_sql() -> str:
    stats = _union([
        f"SELECT '{c}' AS column_name, COUNT(DISTINCT {c}) AS d, "
        f"COUNT(*) FILTER (WHERE {c} IS NULL) AS m, COUNT(*) AS n, "
        + (f"VAR_SAMP({c})" if c in _WIDE_NUM else "CAST(NULL AS DOUBLE)") + " AS v FROM wide"
        for c in _WIDE_COLS])
    return with_(_WIDE, f"\nst AS ({stats})") + """
SELECT column_name, 'constant' AS reason FROM st WHERE d = 1
UNION ALL SELECT column_name, 'zero_variance' FROM st WHERE v = 0
UNION ALL SELECT column_name, 'key_like' FROM st WHERE d = n AND n > 0
UNION ALL SELECT column_name, 'mostly_missing' FROM st WHERE m * 100.0 > n * 50.0"""


@query("columns_to_drop", _drop_sql())
def q_columns_to_drop(spark, sf):
    return clean.columns_to_drop(leads_wide(spark, sf))


@query("drop_flagged_columns", with_(_WIDE) + """
SELECT lead_origin, lead_source, city, last_activity, total_visits, time_on_website,
       page_views_per_visit, converted FROM wide""")
def q_drop_flagged(spark, sf):
    """P4-P7 applied: the key, constants and the mostly-missing columns go."""
    return clean.drop_flagged(leads_wide(spark, sf))


# ---------------------------------------------------------------- P3 A7
@query("select_by_type", with_(LEADS) + "\n" + _union([
    f"SELECT '{c}' AS column_name, {i} AS position, '{t}' AS data_type, '{k}' AS kind, "
    f"COUNT({c}) AS non_null, COUNT(*) AS n_rows FROM leads"
    for i, (c, t, k) in enumerate(LEAD_COLS)]))
def q_select_by_type(spark, sf):
    return clean.column_info(leads(spark, sf))


@query("categorical_columns", with_(LEADS) + f"""
SELECT {', '.join(CATS)} FROM leads""")
def q_categorical_columns(spark, sf):
    return clean.select_by_type(leads(spark, sf), "categorical")


# ---------------------------------------------------------------- A3
@query("missing_report", with_(LEADS) + "\n" + _union([
    f"SELECT '{c}' AS column_name, COUNT(*) FILTER (WHERE {c} IS NULL) AS n_missing, "
    f"ROUND(COUNT(*) FILTER (WHERE {c} IS NULL) * 100.0 / COUNT(*), 6) AS pct_missing "
    "FROM leads" for c, _, _ in LEAD_COLS]))
def q_missing_report(spark, sf):
    return rnd(profile.missing_report(leads(spark, sf)))


# ---------------------------------------------------------------- A4 A5 A21
_VC = LEADS + ",\nlv AS (" + _union(
    [f"SELECT '{c}' AS column_name, {c} AS value FROM leads" for c in CATS]) + """),
vc AS (SELECT column_name, value, COUNT(*) AS n FROM lv GROUP BY column_name, value),
vcs AS (SELECT *, CAST(n AS DOUBLE) / SUM(n) OVER (PARTITION BY column_name) AS share
        FROM vc)"""


@query("value_counts_all", "WITH " + _VC + """
SELECT column_name, value, n, ROUND(share, 6) AS share FROM vcs""")
def q_value_counts_all(spark, sf):
    return rnd(profile.value_counts(leads(spark, sf), CATS))


@query("value_counts_top7", "WITH " + _VC + """
SELECT * FROM (
  SELECT column_name, value, n, ROUND(share, 6) AS share,
         ROW_NUMBER() OVER (PARTITION BY column_name ORDER BY n DESC, value NULLS FIRST) AS rank
  FROM vcs) WHERE rank <= 7""")
def q_value_counts_top7(spark, sf):
    t = profile.top_values(leads(spark, sf), CATS, k=7)
    return rnd(t.withColumn("rank", F.col("rank").cast("long")))


@query("distinct_values", "WITH " + LEADS + ",\nlv AS (" + _union(
    [f"SELECT '{c}' AS column_name, {c} AS value FROM leads" for c in CATS])
    + ")\nSELECT DISTINCT column_name, value FROM lv")
def q_distinct_values(spark, sf):
    return profile.distinct_values(leads(spark, sf), CATS)


# ---------------------------------------------------------------- A6 A10
@query("describe_numeric", _union([
    f"SELECT '{c}' AS column_name, COUNT({c}) AS count, ROUND(AVG({c}), 6) AS mean, "
    f"ROUND(STDDEV_SAMP({c}), 6) AS std, ROUND(MIN({c}), 6) AS min, "
    f"ROUND(QUANTILE_CONT({c}, 0.25), 6) AS q25, ROUND(QUANTILE_CONT({c}, 0.5), 6) AS q50, "
    f"ROUND(QUANTILE_CONT({c}, 0.75), 6) AS q75, ROUND(MAX({c}), 6) AS max FROM lineitem"
    for c in LINE_MEASURES]))
def q_describe_numeric(spark, sf):
    return rnd(profile.describe(read_table(spark, sf, "lineitem"), LINE_MEASURES))


def _box_sql() -> str:
    q = _union([
        f"SELECT '{c}' AS column_name, QUANTILE_CONT({c}, 0.25) AS q1, "
        f"QUANTILE_CONT({c}, 0.5) AS median, QUANTILE_CONT({c}, 0.75) AS q3 FROM lineitem"
        for c in LINE_MEASURES])
    lv = _union([f"SELECT '{c}' AS column_name, {c} AS value FROM lineitem WHERE {c} IS NOT NULL"
                 for c in LINE_MEASURES])
    return f"""WITH q AS ({q}),
f AS (SELECT *, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lf, q3 + 1.5 * (q3 - q1) AS uf FROM q),
lv AS ({lv})
SELECT f.column_name, ROUND(q1, 6) AS q1, ROUND(median, 6) AS median, ROUND(q3, 6) AS q3,
       ROUND(iqr, 6) AS iqr, ROUND(lf, 6) AS lower_fence, ROUND(uf, 6) AS upper_fence,
       ROUND(MIN(value) FILTER (WHERE value >= lf AND value <= uf), 6) AS whisker_low,
       ROUND(MAX(value) FILTER (WHERE value >= lf AND value <= uf), 6) AS whisker_high,
       COUNT(*) FILTER (WHERE value < lf OR value > uf) AS n_outliers
FROM f JOIN lv USING (column_name)
GROUP BY f.column_name, q1, median, q3, iqr, lf, uf"""


@query("box_summary", _box_sql())
def q_box_summary(spark, sf):
    return rnd(profile.box_summary(read_table(spark, sf, "lineitem"), LINE_MEASURES))


# ---------------------------------------------------------------- A8
@query("two_way_counts", """
SELECT l_returnflag, COUNT(*) FILTER (WHERE l_linestatus = 'F') AS "F",
       COUNT(*) FILTER (WHERE l_linestatus = 'O') AS "O"
FROM lineitem GROUP BY l_returnflag""")
def q_two_way_counts(spark, sf):
    li = read_table(spark, sf, "lineitem")
    return profile.two_way_counts(li, "l_returnflag", "l_linestatus", ["F", "O"])


# ---------------------------------------------------------------- A9
def _spearman_sql() -> str:
    parts = []
    for i, a in enumerate(NUMS):
        for b in NUMS[i + 1:]:
            sub = (f"SELECT {a} AS x, {b} AS y FROM leads "
                   f"WHERE {a} IS NOT NULL AND {b} IS NOT NULL")
            rk = (f"SELECT RANK() OVER (ORDER BY x) + (COUNT(*) OVER (PARTITION BY x) - 1) / 2.0 AS rx, "
                  f"RANK() OVER (ORDER BY y) + (COUNT(*) OVER (PARTITION BY y) - 1) / 2.0 AS ry "
                  f"FROM ({sub})")
            parts.append(f"SELECT '{a}' AS column_a, '{b}' AS column_b, ROUND(CORR(rx, ry), 6) AS rho FROM ({rk})")
            parts.append(f"SELECT '{b}', '{a}', ROUND(CORR(rx, ry), 6) FROM ({rk})")
    for c in NUMS:
        parts.append(f"SELECT '{c}', '{c}', CASE WHEN COUNT(DISTINCT {c}) > 1 THEN 1.0 END FROM leads")
    return with_(LEADS) + "\n" + _union(parts)


@query("spearman_matrix", _spearman_sql())
def q_spearman_matrix(spark, sf):
    return rnd(profile.spearman_matrix(leads(spark, sf), NUMS))


# ---------------------------------------------------------------- A12
def _profile_sql() -> str:
    parts = []
    for c, t, k in LEAD_COLS:
        num = k == "numerical"
        x = f"CAST({c} AS DOUBLE)"
        parts.append(
            f"SELECT '{c}' AS column_name, '{t}' AS data_type, COUNT(*) AS n_rows, "
            f"COUNT(*) FILTER (WHERE {c} IS NULL) AS n_missing, "
            f"ROUND(COUNT(*) FILTER (WHERE {c} IS NULL) * 100.0 / COUNT(*), 6) AS pct_missing, "
            f"COUNT(DISTINCT {c}) AS n_distinct, "
            + (f"CAST(COUNT(*) FILTER (WHERE {x} = 0) AS DOUBLE)" if num else "CAST(NULL AS DOUBLE)") + " AS n_zeros, "
            + (f"ROUND(AVG({x}), 6)" if num else "CAST(NULL AS DOUBLE)") + " AS mean, "
            + (f"ROUND(STDDEV_SAMP({x}), 6)" if num else "CAST(NULL AS DOUBLE)") + " AS std, "
            + (f"MIN({x})" if num else "CAST(NULL AS DOUBLE)") + " AS min, "
            + (f"MAX({x})" if num else "CAST(NULL AS DOUBLE)") + " AS max FROM leads")
    return with_(LEADS) + "\n" + _union(parts)


@query("profile_table", _profile_sql())
def q_profile_table(spark, sf):
    return rnd(profile.profile_table(leads(spark, sf)))


@query("histogram", with_(LEADS) + ",\nlv AS (" + _union(
    [f"SELECT '{c}' AS column_name, {c} AS value FROM leads WHERE {c} IS NOT NULL"
     for c in FEATURE_NUMS]) + """),
mm AS (SELECT column_name, MIN(value) AS lo, MAX(value) AS hi FROM lv GROUP BY column_name)
SELECT column_name,
       CASE WHEN hi = lo THEN 0
            ELSE LEAST(CAST(FLOOR((value - lo) / (hi - lo) * 10) AS INTEGER), 9) END AS bin,
       COUNT(*) AS n, ROUND(MIN(lo), 6) AS col_min, ROUND(MIN(hi), 6) AS col_max
FROM lv JOIN mm USING (column_name) GROUP BY ALL""")
def q_histogram(spark, sf):
    return rnd(profile.histogram(leads(spark, sf), FEATURE_NUMS, bins=10))


# ---------------------------------------------------------------- F10 F11
@query("token_columns", """
SELECT 'o_orderstatus' AS column_name, CAST(MAX(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS INTEGER) AS has_token FROM orders
UNION ALL
SELECT 'o_orderpriority', CAST(MAX(CASE WHEN o_orderpriority = 'F' THEN 1 ELSE 0 END) AS INTEGER) FROM orders""")
def q_token_columns(spark, sf):
    return clean.token_columns(read_table(spark, sf, "orders"), "F")


@query("any_null", with_(LEADS) + "\n" + _union([
    f"SELECT '{c}' AS column_name, CAST(MAX(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS INTEGER) AS any_null FROM leads"
    for c, _, _ in LEAD_COLS]))
def q_any_null(spark, sf):
    return clean.any_null(leads(spark, sf))


# ---------------------------------------------------------------- F14 A11 U3
_LI_KEY = ["l_orderkey", "l_linenumber"]
_LI_REST = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
            "l_returnflag", "l_linestatus", "l_shipdate"]
_LI_RN = ("SELECT *, ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY "
          + ", ".join(f"{c} NULLS FIRST" for c in _LI_REST) + ") AS rn FROM lineitem")
_LI_OUT = ("SELECT * EXCLUDE (rn, l_shipdate), "
           f"strftime(l_shipdate, '{ISO_SQL}') AS l_shipdate FROM ({_LI_RN})")


@query("duplicates_report", f"{_LI_OUT} WHERE rn > 1")
def q_duplicates_report(spark, sf):
    return rnd(clean.duplicate_rows(read_table(spark, sf, "lineitem"), _LI_KEY))


@query("duplicate_count", """
SELECT COUNT(*) AS n_rows, COUNT(DISTINCT (l_orderkey, l_linenumber)) AS n_distinct,
       COUNT(*) - COUNT(DISTINCT (l_orderkey, l_linenumber)) AS n_duplicates FROM lineitem""")
def q_duplicate_count(spark, sf):
    return clean.duplicate_count(read_table(spark, sf, "lineitem"), _LI_KEY)


@query("dedupe_first", f"{_LI_OUT} WHERE rn = 1")
def q_dedupe_first(spark, sf):
    return rnd(clean.dedupe_first(read_table(spark, sf, "lineitem"), _LI_KEY))


# ---------------------------------------------------------------- F1 F2 F3
_RAW = LEADS + """,
raw AS (
  SELECT lead_id,
         CASE WHEN lead_origin = '2-HIGH' AND last_activity = 'F' THEN CAST('inf' AS DOUBLE)
              WHEN lead_origin = '3-MEDIUM' AND last_activity = 'F' THEN CAST('-inf' AS DOUBLE)
              ELSE total_visits END AS total_visits,
         CASE WHEN lead_source = 'BUILDING' AND last_activity = 'O' THEN CAST('nan' AS DOUBLE)
              ELSE page_views_per_visit END AS page_views_per_visit,
         CASE WHEN city = 'NATION_3' THEN 'x' ELSE CAST(CAST(time_on_website AS BIGINT) AS VARCHAR) END
           AS time_text
  FROM leads)"""


def raw_leads(spark, sf):
    """Leads with injected infinities, NaN and unparsable text numbers."""
    d = leads(spark, sf)
    inf = float("inf")
    return d.select(
        "lead_id",
        F.when((F.col("lead_origin") == "2-HIGH") & (F.col("last_activity") == "F"), F.lit(inf))
         .when((F.col("lead_origin") == "3-MEDIUM") & (F.col("last_activity") == "F"), F.lit(-inf))
         .otherwise(F.col("total_visits")).alias("total_visits"),
        F.when((F.col("lead_source") == "BUILDING") & (F.col("last_activity") == "O"),
               F.lit(float("nan"))).otherwise(F.col("page_views_per_visit")).alias("page_views_per_visit"),
        F.when(F.col("city") == "NATION_3", F.lit("x"))
         .otherwise(F.col("time_on_website").cast("long").cast("string")).alias("time_text"))


@query("clean_rows", with_(_RAW) + """
SELECT * FROM (
  SELECT lead_id,
         CASE WHEN isinf(total_visits) OR isnan(total_visits) THEN NULL ELSE total_visits END AS total_visits,
         CASE WHEN isinf(page_views_per_visit) OR isnan(page_views_per_visit) THEN NULL
              ELSE page_views_per_visit END AS page_views_per_visit,
         TRY_CAST(time_text AS DOUBLE) AS time_on_website
  FROM raw)
WHERE lead_id IS NOT NULL AND total_visits IS NOT NULL AND page_views_per_visit IS NOT NULL
  AND time_on_website IS NOT NULL""")
def q_clean_rows(spark, sf):
    r = raw_leads(spark, sf)
    r = clean.clean_infinities(r)
    r = clean.coerce_numeric(r, ["time_text"]).withColumnRenamed("time_text", "time_on_website")
    return rnd(clean.drop_incomplete(r))


# ---------------------------------------------------------------- P1 P2 P8 X8
@query("drop_and_rename", """
SELECT c_custkey AS cust_key, c_nationkey, c_acctbal, c_mktsegment AS segment FROM customer""")
def q_drop_and_rename(spark, sf):
    c = read_table(spark, sf, "customer")
    c = clean.drop_columns(c, ["c_name", "c_comment"])      # c_comment is absent
    return clean.rename_columns(c, {"c_custkey": "Cust_Key", "c_mktsegment": "Segment"})

