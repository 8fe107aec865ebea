"""Registered queries of nearest-neighbour imputation."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import knn
from ..operators.split import unit_hash
from ..sources.leads import leads
from .catalog import query, rnd
from .sql import LEADS, with_

COLS = ["lead_origin", "lead_source", "city", "last_activity", "visits", "time_band", "pages_band", "outcome"]
MISSING = 0.04


def incomplete_leads(spark, sf):
    """Leads with eight categorical columns of which some cells are empty (stand-in input: the driver's tables have
    next to no empty categories)."""
    d = leads(spark, sf)
    d = d.select("lead_id", "lead_origin", "lead_source", "city", "last_activity",
                 F.lpad(F.col("total_visits").cast("int").cast("string"), 2, "0").alias("visits"),
                 F.lpad(F.floor(F.col("time_on_website") / 50).cast("string"), 2, "0").alias("time_band"),
                 F.lpad(F.floor(F.col("page_views_per_visit") / 5).cast("string"), 2, "0").alias("pages_band"),
                 F.when(F.col("converted") == 1, "yes").otherwise("no").alias("outcome"))
    return d.select("lead_id", *[F.when(unit_hash(F.col("lead_id"), F.lit(c), F.lit("knn")) >= MISSING, F.col(c)).alias(c) for c in COLS])


def _hole(c: str, expr: str) -> str:
    u = f"CAST(('0x' || substr(md5(CAST(lead_id AS VARCHAR) || '|{c}|knn'), 1, 8))::BIGINT AS DOUBLE) / CAST(4294967296 AS DOUBLE)"
    return f"CASE WHEN {u} >= {MISSING} THEN {expr} END AS {c}"


_EXPR = {c: c for c in COLS} | {
    "visits": "lpad(CAST(CAST(total_visits AS INT) AS VARCHAR), 2, '0')",
    "time_band": "lpad(CAST(CAST(floor(time_on_website / 50) AS BIGINT) AS VARCHAR), 2, '0')",
    "pages_band": "lpad(CAST(CAST(floor(page_views_per_visit / 5) AS BIGINT) AS VARCHAR), 2, '0')",
    "outcome": "CASE WHEN converted = 1 THEN 'yes' ELSE 'no' END"}

_INPUT = LEADS + ", holes AS (SELECT lead_id, " + ", ".join(_hole(c, _EXPR[c]) for c in COLS) + " FROM leads)"
_LEVELS = ", levels AS (" + " UNION ALL ".join(
    f"SELECT {i} AS t, {c} AS level, CAST(row_number() OVER (ORDER BY {c}) - 1 AS BIGINT) AS code FROM (SELECT DISTINCT {c} FROM holes WHERE {c} IS NOT NULL)"
    for i, c in enumerate(COLS)) + ")"
_CODED = ", coded AS MATERIALIZED (SELECT " + ", ".join(f"v{i}.code AS c{i}" for i in range(8)) + ", count(*) AS cnt FROM holes " + " ".join(
    f"LEFT JOIN levels v{i} ON v{i}.t = {i} AND v{i}.level = holes.{c}" for i, c in enumerate(COLS)) + " GROUP BY ALL)"
_NUMBERED = ", pat AS MATERIALIZED (SELECT row_number() OVER () AS pid, * FROM coded)"
_SUM = " + ".join(f"CASE WHEN r.c{i} IS NULL OR d.c{i} IS NULL THEN 0 ELSE (r.c{i} - d.c{i}) * (r.c{i} - d.c{i}) END" for i in range(8))
_COMMON = " + ".join(f"CASE WHEN r.c{i} IS NULL OR d.c{i} IS NULL THEN 0 ELSE 1 END" for i in range(8))
_NEAR = ", near AS MATERIALIZED (" + " UNION ALL ".join(
    f"SELECT pid, {t} AS t, dist, code, sum(cnt) AS cnt FROM (SELECT r.pid, d.c{t} AS code, d.cnt, {_COMMON} AS m, CASE WHEN {_COMMON} > 0 THEN ({_SUM}) * (840 // ({_COMMON})) END AS dist "
    f"FROM pat r, pat d WHERE r.c{t} IS NULL AND d.c{t} IS NOT NULL) WHERE m > 0 GROUP BY pid, dist, code" for t in range(8)) + """),
used AS MATERIALIZED (SELECT pid, t, dist, code, least(cnt, 5 - (upto - cnt)) AS used FROM (
        SELECT *, sum(cnt) OVER (PARTITION BY pid, t ORDER BY dist, code) AS upto FROM near) WHERE upto - cnt < 5)"""
_FILL = """,
mean AS (SELECT pid, t, CASE WHEN min(dist) = 0 THEN sum(used * code) FILTER (dist = 0) * CAST(1 AS DOUBLE) / sum(used) FILTER (dist = 0)
                             ELSE sum(used * code / sqrt(CAST(dist AS DOUBLE))) / sum(used / sqrt(CAST(dist AS DOUBLE))) END AS mean FROM used GROUP BY pid, t),
fill AS (SELECT pid, mean.t, level FROM mean JOIN levels ON levels.t = mean.t AND code = CAST(floor(round(mean, 9)) AS BIGINT))"""


@query("knn_neighbours", with_(_INPUT + _LEVELS + _CODED + _NUMBERED + _NEAR) + """
SELECT """ + ", ".join(f"v{i}.level AS {c}" for i, c in enumerate(COLS)) + """, v.column_name, CAST(round(sqrt(8 * CAST(dist AS DOUBLE) / 840), 6) AS DOUBLE) AS distance,
       n.level AS neighbour, CAST(used AS BIGINT) AS used
FROM used JOIN pat USING (pid) JOIN (VALUES """ + ", ".join(f"({i}, '{c}')" for i, c in enumerate(COLS)) + """) v(t, column_name) ON v.t = used.t
JOIN levels n ON n.t = used.t AND n.code = used.code """ + " ".join(f"LEFT JOIN levels v{i} ON v{i}.t = {i} AND v{i}.code = pat.c{i}" for i in range(8)))
def q_knn_neighbours(spark, sf):
    """The five nearest rows of every incomplete pattern, for each column that it lacks."""
    p = knn.code_patterns(incomplete_leads(spark, sf), COLS)
    got = knn.nearest_patterns(p)
    name = F.get(F.array(*map(F.lit, COLS)), F.col("target"))
    level = p.levels.select(F.col("t").alias("target"), "code", F.col("level").alias("neighbour"))
    return rnd(got.join(level, ["target", "code"])
               .join(p.table.select(F.col("pid").alias("p_pid"), *COLS), F.col("pid") == F.col("p_pid"))
               .select(*COLS, name.alias("column_name"), F.sqrt(8 * F.col("dist") / p.lcm).alias("distance"), "neighbour", "used"))


@query("impute_knn", with_(_INPUT + _LEVELS + _CODED + _NUMBERED + _NEAR + _FILL) + """
SELECT lead_id, """ + ", ".join(f"coalesce(holes.{c}, f{i}.level) AS {c}" for i, c in enumerate(COLS)) + """
FROM holes """ + " ".join(f"LEFT JOIN levels v{i} ON v{i}.t = {i} AND v{i}.level = holes.{c}" for i, c in enumerate(COLS)) + """
JOIN pat ON """ + " AND ".join(f"pat.c{i} IS NOT DISTINCT FROM v{i}.code" for i in range(8)) + " " + " ".join(
    f"LEFT JOIN fill f{i} ON f{i}.pid = pat.pid AND f{i}.t = {i}" for i in range(8)))
def q_impute_knn(spark, sf):
    """Eight categorical columns filled from the five nearest rows."""
    return knn.impute_knn(incomplete_leads(spark, sf), COLS)
