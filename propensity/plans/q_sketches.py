"""Registered queries of the mergeable profile (A1 A2 A6 A10 A12) and the publishing gate."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import publish, sketches
from ..session import scratch_path
from ..sources.leads import leads
from .catalog import query, rnd
from .sql import LEADS, with_

NUM = ["total_visits", "time_on_website", "page_views_per_visit"]
TXT = ["lead_origin", "city"]
BATCHES = 5


def _one(c: str, numeric: bool) -> str:
    if not numeric:
        return (f"SELECT '{c}' AS column_name, count(*) AS n_rows, count(*) - count({c}) AS n_missing, CAST(0 AS BIGINT) AS n_zeros, CAST(NULL AS DOUBLE) AS mean, "
                f"CAST(NULL AS DOUBLE) AS std, CAST(NULL AS DOUBLE) AS min, CAST(NULL AS DOUBLE) AS max, true AS distinct_fits, true AS quantiles_fit FROM leads")
    return (f"SELECT '{c}', count(*), count(*) - count({c}), CAST(count(*) FILTER ({c} = 0) AS BIGINT), ROUND(avg({c}), 6), ROUND(stddev_samp({c}), 6), "
            f"min({c}), max({c}), true, true FROM leads")


@query("merged_profile", with_(LEADS) + " " + " UNION ALL ".join([_one(TXT[0], False)] + [_one(c, False) for c in TXT[1:]] + [_one(c, True) for c in NUM]))
def q_merged_profile(spark, sf):
    """A1 A2 A6 A10 A12 from five batches' sketches; the estimates are held against exact counts and ranks."""
    d = leads(spark, sf).select("lead_id", *TXT, *NUM)
    path = scratch_path(spark, "sketches")
    for b in range(BATCHES):
        sketches.append_batch(spark, path, d.where(F.col("lead_id") % BATCHES == b), f"b{b}", TXT + NUM)
    p = sketches.merged_profile(sketches.read_sketches(spark, path))
    est = {r["column_name"]: r for r in p.select("column_name", "n_distinct", "q25", "q50", "q75").collect()}     # one row per column
    exact = []
    for c in TXT + NUM:
        fits = F.abs(F.count_distinct(c) - est[c]["n_distinct"]) <= sketches.DISTINCT_ERROR * F.count_distinct(c) + 1
        ranks = F.lit(None).cast("boolean")
        if c in NUM:
            share = [(F.count_if(F.col(c) < est[c][n]) / F.count(c), F.count_if(F.col(c) <= est[c][n]) / F.count(c), q) for n, q in (("q25", .25), ("q50", .5), ("q75", .75))]
            ranks = F.every(F.lit(True))
            for below, upto, q in share:
                ranks = ranks & (below <= q + sketches.RANK_ERROR) & (upto >= q - sketches.RANK_ERROR)
        exact.append(F.struct(F.lit(c).alias("c"), fits.alias("distinct_fits"), ranks.alias("quantiles_fit")))
    held = d.agg(F.array(*exact).alias("a")).select(F.inline("a"))
    return rnd(p.join(held, F.col("column_name") == F.col("c")).select(
        "column_name", "n_rows", "n_missing", F.coalesce("n_zeros", F.lit(0)).alias("n_zeros"), "mean", "std", "min", "max", "distinct_fits",
        F.coalesce("quantiles_fit", F.lit(True)).alias("quantiles_fit")))


@query("publish_gate", with_(LEADS) + """,
bad AS (SELECT count(*) FILTER (lead_origin IS NULL OR lead_origin NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED')) AS b FROM leads)
SELECT 'first' AS step, b = 0 AS passed, CASE WHEN b = 0 THEN (SELECT count(*) FROM leads) ELSE 0 END AS visible FROM bad
UNION ALL SELECT 'second', true, count(*) FROM leads
UNION ALL SELECT 'third', (SELECT b = 0 FROM bad), count(*) FROM leads""")
def q_publish_gate(spark, sf):
    """A version that breaks a rule, one that keeps it, the broken one again; rows visible after each."""
    d = leads(spark, sf).select("lead_id", "lead_origin", "converted")
    narrow = {"lead_id": {"type": "integer"}, "lead_origin": {"type": "string", "enum": ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED"]},
              "converted": {"type": "integer", "minimum": 0, "maximum": 1}}
    wide = {**narrow, "lead_origin": {"type": "string", "enum": narrow["lead_origin"]["enum"] + ["5-LOW"]}}
    root, out = scratch_path(spark, "published"), None
    for step, rules in (("first", narrow), ("second", wide), ("third", narrow)):
        done = publish.publish(d, rules, root, step)
        now = publish.read_published(spark, root)
        now = spark.range(0) if now is None else now
        row = now.agg(F.lit(step).alias("step"), F.lit(done.passed).alias("passed"), F.count(F.lit(1)).alias("visible"))
        out = row if out is None else out.unionByName(row)
    return out
