"""Validation, recoding, imputation and encoding queries (F4-F9, J3, U2,
X1-X7, E1-E8, M7, J4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalar as X
from ..operators import chained, encode, impute, split, validate
from ..sources.leads import leads
from .catalog import query, rnd
from .sql import LEADS, SPLIT, with_

PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
# one market segment left out on purpose so that the enum rule fails
SEGMENTS_ALLOWED = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD"]

LEAD_RULES = {
    "lead_id": {"type": "integer"},
    "lead_origin": {"type": "string", "enum": PRIORITIES},
    "lead_source": {"type": "string", "enum": SEGMENTS_ALLOWED},
    "last_activity": {"type": "integer"},
    "total_visits": {"type": "float", "minimum": 0, "maximum": 300},
    "time_on_website": {"type": "float", "minimum": 0, "maximum": 3000},
    "page_views_per_visit": {"type": "float", "minimum": 0, "maximum": 70},
    "converted": {"type": "integer", "minimum": 0, "maximum": 1},
}


def _in(vals):
    return "(" + ", ".join(f"'{v}'" for v in vals) + ")"


def _enum_sql(c, vals):
    bad = f"({c} IS NULL OR {c} NOT IN {_in(vals)})"
    return (f"SELECT '{c}' AS column_name, CASE WHEN COUNT(*) FILTER (WHERE {bad}) > 0 THEN "
            f"'Invalid categorical values: {{' || array_to_string(list_concat("
            f"list_transform(list_sort(list(DISTINCT {c}) FILTER (WHERE {c} NOT IN {_in(vals)})),"
            f" lambda v: '''' || v || ''''), CASE WHEN COUNT(*) FILTER (WHERE {c} IS NULL) > 0 "
            f"THEN ['None'] ELSE [] END), ', ') || '}}' ELSE 'Valid' END AS status FROM leads")


def _range_sql(c, lo, hi):
    return (f"SELECT '{c}', CASE WHEN COUNT(*) FILTER (WHERE NOT COALESCE({c} >= {lo} AND "
            f"{c} <= {hi}, FALSE)) > 0 THEN 'Out of range: [{lo}, {hi}]' ELSE 'Valid' END FROM leads")


_VALIDATION_SQL = with_(LEADS) + "\n" + "\nUNION ALL\n".join([
    "SELECT 'lead_id' AS column_name, 'Valid' AS status",
    _enum_sql("lead_origin", PRIORITIES),
    _enum_sql("lead_source", SEGMENTS_ALLOWED),
    "SELECT 'city', 'Column missing in schema'",
    "SELECT 'last_activity', 'Incorrect dtype: expected integer, got string'",
    _range_sql("total_visits", 0, 300),
    _range_sql("time_on_website", 0, 3000),
    _range_sql("page_views_per_visit", 0, 70),
    _range_sql("converted", 0, 1)])


@query("validation_status", _VALIDATION_SQL)
def q_validation_status(spark, sf):
    return validate.validation_status(leads(spark, sf), LEAD_RULES)


@query("invalid_values", with_(LEADS) + f"""
SELECT 'lead_source' AS column_name, lead_source AS value, COUNT(*) AS n FROM leads
WHERE lead_source IS NULL OR lead_source NOT IN {_in(SEGMENTS_ALLOWED)} GROUP BY lead_source
UNION ALL
SELECT 'lead_origin', lead_origin, COUNT(*) FROM leads
WHERE lead_origin IS NULL OR lead_origin NOT IN {_in(PRIORITIES)} GROUP BY lead_origin""")
def q_invalid_values(spark, sf):
    return validate.invalid_values(leads(spark, sf), LEAD_RULES)


@query("validated_rows", with_(LEADS) + """
SELECT lead_id, lead_origin, converted FROM leads WHERE lead_origin IN """ + _in(PRIORITIES))
def q_validated_rows(spark, sf):
    """F9 gate: the sub-table that passes every rule is written; its
    read-back is the result."""
    from ..session import scratch_path
    d = leads(spark, sf).select("lead_id", "lead_origin", "converted")
    rules = {k: LEAD_RULES[k] for k in ("lead_id", "lead_origin", "converted")}
    ok_rows = d.where(F.col("lead_origin").isin(PRIORITIES))
    st = validate.validation_status(ok_rows, rules)
    path = scratch_path(spark, "validated")
    if not validate.write_if_valid(ok_rows, st, path):
        raise RuntimeError("validated rows did not pass the rules")
    return spark.read.parquet(path)


@query("validation_gate", with_(LEADS) + """
SELECT 'present' AS rules, TRUE AS passed, COUNT(*) AS written FROM leads
UNION ALL
SELECT 'priorities', COUNT(*) FILTER (WHERE lead_origin IS NULL OR lead_origin NOT IN """ + _in(PRIORITIES) + """) = 0,
       CASE WHEN COUNT(*) FILTER (WHERE lead_origin IS NULL OR lead_origin NOT IN """ + _in(PRIORITIES) + """) = 0
            THEN COUNT(*) ELSE 0 END FROM leads""")
def q_validation_gate(spark, sf):
    """F9 gate on all leads, under rules they keep and under rules they break: rows
    written by each (none where the gate withholds the table)."""
    from ..session import scratch_path
    d = leads(spark, sf).select("lead_id", "lead_origin", "converted")
    results = []
    for name, cols in (("present", ("lead_id", "converted")), ("priorities", ("lead_id", "lead_origin", "converted"))):
        path = scratch_path(spark, "gate")
        passed = validate.write_if_valid(d, validate.validation_status(d.select(*cols), {c: LEAD_RULES[c] for c in cols}), path)
        written = spark.read.parquet(path).select(F.count(F.lit(1)).alias("written")) if passed else spark.range(1).select(F.lit(0).cast("long").alias("written"))
        results.append(written.select(F.lit(name).alias("rules"), F.lit(passed).alias("passed"), "written"))
    return results[0].unionByName(results[1])


# ---------------------------------------------------------------- X1-X7
@query("recode_categories", with_(LEADS) + """
SELECT lead_id,
       CASE WHEN instr(lead_origin, '-') > 0 THEN split_part(lead_origin, '-', 2) END AS origin_level,
       COALESCE(CASE WHEN instr(lead_origin, '-') > 0 THEN split_part(lead_origin, '-', 2) END, '')
         AS origin_text,
       CASE WHEN lead_source = 'AUTOMOBILE' THEN 'AUTO' WHEN lead_source = 'MACHINERY' THEN NULL
            ELSE lead_source END AS source_recoded,
       CASE WHEN city IN ('NATION_0', 'NATION_1', 'NATION_2') THEN 'Others' ELSE city END AS city_clubbed,
       NULLIF(last_activity, 'P') AS activity_null,
       COALESCE(NULLIF(last_activity, 'P'), 'Others') AS activity_filled,
       CAST(CASE WHEN last_activity = 'F' THEN 0 WHEN last_activity = 'O' THEN 1 END AS DOUBLE)
         AS status_flag
FROM leads""")
def q_recode_categories(spark, sf):
    d = leads(spark, sf)
    yn = F.when(F.col("last_activity") == "F", "Yes").when(
        F.col("last_activity") == "O", "No").otherwise("Maybe")
    return d.select(
        "lead_id",
        X.part_after("lead_origin", "-").alias("origin_level"),
        X.empty_if_null(X.part_after("lead_origin", "-")).alias("origin_text"),
        X.recode("lead_source", {"AUTOMOBILE": "AUTO", "MACHINERY": None}).alias("source_recoded"),
        X.club("city", ["NATION_0", "NATION_1", "NATION_2"], "Others").alias("city_clubbed"),
        X.null_if("last_activity", "P").alias("activity_null"),
        X.fill_null(X.null_if("last_activity", "P"), "Others").alias("activity_filled"),
        # nullable integer reported as double (same in the oracle)
        X.yes_no(yn).cast("double").alias("status_flag"))


# ---------------------------------------------------------------- E1 E2 X6 M7
_BASE = SPLIT + """,
base AS (SELECT lead_id, split, converted, lead_origin, lead_source, total_visits,
                time_on_website, page_views_per_visit,
                CASE WHEN lead_origin = '5-LOW' THEN NULL ELSE city END AS city
         FROM splits)"""
NUMF = ["total_visits", "time_on_website", "page_views_per_visit"]


def base_table(spark, sf):
    """Leads with the split column and NULL cities injected (lead_origin 5)."""
    d = leads(spark, sf)
    s = split.stratified_split(d, "converted", "lead_id")
    return s.select("lead_id", "split", "converted", "lead_origin", "lead_source", *NUMF,
                    F.when(F.col("lead_origin") == "5-LOW", None).otherwise(
                        F.col("city")).alias("city"))


@query("impute_mean_mode", with_(_BASE) + """,
tr AS (SELECT AVG(total_visits) AS mv, AVG(time_on_website) AS mt,
              AVG(page_views_per_visit) AS mp FROM base WHERE split = 'train'),
md AS (SELECT city AS mode_city FROM base WHERE split = 'train' AND city IS NOT NULL
       GROUP BY city ORDER BY COUNT(*) DESC, city LIMIT 1)
SELECT lead_id, split, ROUND(COALESCE(total_visits, mv), 6) AS total_visits,
       ROUND(COALESCE(time_on_website, mt), 6) AS time_on_website,
       ROUND(COALESCE(page_views_per_visit, mp), 6) AS page_views_per_visit,
       COALESCE(city, mode_city) AS city
FROM base, tr, md""")
def q_impute_mean_mode(spark, sf):
    b = base_table(spark, sf).select("lead_id", "split", *NUMF, "city")
    out = impute.impute_mean_mode(b, b.where(F.col("split") == "train"), NUMF, ["city"])
    return rnd(out)


@query("impute_constant", with_(_BASE) + """
SELECT lead_id, COALESCE(city, 'Others') AS city, COALESCE(total_visits, 0.0) AS total_visits
FROM base""")
def q_impute_constant(spark, sf):
    b = base_table(spark, sf).select("lead_id", "city", "total_visits")
    return rnd(impute.impute_constant(b, {"city": "Others", "total_visits": 0.0}))


@query("impute_probabilistic", with_(_BASE) + """,
cnt AS (SELECT city AS level, COUNT(*) AS n FROM base
        WHERE split = 'train' AND city IS NOT NULL GROUP BY city),
bins AS (SELECT level, CAST(SUM(n) OVER (ORDER BY level) - n AS DOUBLE) / SUM(n) OVER () AS lo,
                CAST(SUM(n) OVER (ORDER BY level) AS DOUBLE) / SUM(n) OVER () AS hi FROM cnt),
u AS (SELECT lead_id,
             CAST(('0x' || substr(md5(CAST(lead_id AS VARCHAR) || '|city|42'), 1, 8))::BIGINT AS DOUBLE)
               / CAST(4294967296 AS DOUBLE) AS u
      FROM base WHERE city IS NULL)
SELECT lead_id, city FROM base WHERE city IS NOT NULL
UNION ALL
SELECT u.lead_id, bins.level FROM u JOIN bins ON u.u >= bins.lo AND u.u < bins.hi""")
def q_impute_probabilistic(spark, sf):
    b = base_table(spark, sf).select("lead_id", "split", "city")
    out = impute.impute_probabilistic(b, b.where(F.col("split") == "train"), "city", "lead_id")
    return out.select("lead_id", "city")


@query("impute_iterative")
def q_impute_iterative(spark, sf):
    """Bayesian ridge in rounds, all solved from one pass (no SQL oracle; tests hold it against rows)."""
    b = leads(spark, sf).select("lead_id", *NUMF)
    return rnd(chained.impute_chained(b, NUMF))


@query("impute_two_columns", with_(LEADS) + """,
h AS (SELECT lead_id, total_visits, CASE WHEN lead_id % 6 <> 0 THEN time_on_website END AS time_on_website FROM leads WHERE total_visits IS NOT NULL),
r AS (SELECT regr_slope(time_on_website, total_visits) AS b, regr_intercept(time_on_website, total_visits) AS a FROM h)
SELECT lead_id, total_visits, ROUND(COALESCE(time_on_website, a + b * total_visits), 6) AS time_on_website FROM h, r""")
def q_impute_two_columns(spark, sf):
    """E8 with least squares and one incomplete column (stand-in input: a sixth of the times taken out)."""
    b = leads(spark, sf).where("total_visits IS NOT NULL").select(
        "lead_id", "total_visits", F.when(F.col("lead_id") % 6 != 0, F.col("time_on_website")).alias("time_on_website"))
    return rnd(chained.impute_chained(b, ["total_visits", "time_on_website"], chained.ordinary))


# ---------------------------------------------------------------- E3 E4
_SCALE = with_(_BASE) + """,
st AS (SELECT AVG(total_visits) AS m1, STDDEV_POP(total_visits) AS s1,
              AVG(time_on_website) AS m2, STDDEV_POP(time_on_website) AS s2,
              AVG(page_views_per_visit) AS m3, STDDEV_POP(page_views_per_visit) AS s3
       FROM base WHERE split = 'train')"""


@query("standardize", _SCALE + """
SELECT lead_id, ROUND((total_visits - m1) / s1, 6) AS total_visits,
       ROUND((time_on_website - m2) / s2, 6) AS time_on_website,
       ROUND((page_views_per_visit - m3) / s3, 6) AS page_views_per_visit
FROM base, st""")
def q_standardize(spark, sf):
    b = base_table(spark, sf)
    stats = encode.fit_population_scaler(b.where(F.col("split") == "train"), NUMF)
    return rnd(encode.standardize(b.select("lead_id", *NUMF), stats))


@query("inverse_standardize", with_(_BASE) + """
SELECT lead_id, ROUND(total_visits, 6) AS total_visits,
       ROUND(time_on_website, 6) AS time_on_website,
       ROUND(page_views_per_visit, 6) AS page_views_per_visit FROM base""")
def q_inverse_standardize(spark, sf):
    b = base_table(spark, sf)
    stats = encode.fit_population_scaler(b.where(F.col("split") == "train"), NUMF)
    z = encode.standardize(b.select("lead_id", *NUMF), stats)
    return rnd(encode.inverse_standardize(z, stats))


# ---------------------------------------------------------------- E5 E6 E7
@query("one_hot_drop_first", with_(LEADS) + "\nSELECT lead_id, " + ", ".join(
    f"CAST(COALESCE(lead_origin = '{v}', FALSE) AS INTEGER) AS \"lead_origin_{v}\""
    for v in PRIORITIES[1:]) + " FROM leads")
def q_one_hot_drop_first(spark, sf):
    d = leads(spark, sf).select("lead_id", "lead_origin")
    return encode.one_hot(d, "lead_origin", encode.levels(d, "lead_origin"), drop_first=True)


_ALL_SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


@query("one_hot_all", with_(_BASE) + "\nSELECT lead_id, " + ", ".join(
    f"CASE WHEN lead_source = '{v}' AND '{v}' IN (SELECT lead_source FROM base WHERE split = 'train') "
    f"THEN 1.0 ELSE 0.0 END AS \"lead_source_{v}\"" for v in _ALL_SEGMENTS) + " FROM base")
def q_one_hot_all(spark, sf):
    b = base_table(spark, sf).select("lead_id", "split", "lead_source")
    out = encode.one_hot_all(b.where(F.col("split") == "train"), b, "lead_source")
    return out.drop("split")


@query("ordinal_encode", with_(_BASE) + """,
lv AS (SELECT city AS level, CAST(ROW_NUMBER() OVER (ORDER BY city) - 1 AS INTEGER) AS code
       FROM (SELECT DISTINCT city FROM base WHERE split = 'train' AND city IS NOT NULL))
SELECT lead_id, city,
       CAST(CASE WHEN city IS NULL THEN NULL ELSE COALESCE(code, -1) END AS DOUBLE) AS city_code,
       level AS city_decoded
FROM base LEFT JOIN lv ON base.city = lv.level""")
def q_ordinal_encode(spark, sf):
    b = base_table(spark, sf).select("lead_id", "split", "city")
    t = encode.level_table(b.where(F.col("split") == "train"), "city")
    e = encode.ordinal_encode(b.select("lead_id", "city"), "city", t, "city_code")
    d = encode.ordinal_decode(e, "city_code", t, "city_decoded")
    return d.withColumn("city_code", F.col("city_code").cast("double"))
