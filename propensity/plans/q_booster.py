"""Registered queries of the histogram booster."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.scalar import lead_score
from ..operators import booster, encode, split
from ..operators.model import SWEEP_GRID
from ..session import scratch_path
from ..sources.leads import leads
from .catalog import query, rnd
from .sql import LEADS, SPLIT, with_

NUM = ["total_visits", "time_on_website", "page_views_per_visit"]
CAT = ["lead_origin", "lead_source", "city", "last_activity"]
#: Trees and depth of the registered fits: fewer than the reference's 100 x 6, as each level is a job of its own.
FIT = {"n_estimators": 20, "max_depth": 4}


def coded_leads(spark, sf):
    """Leads with split and 0/1 columns of the categorical levels seen on train; feature names."""
    tagged = scratch_path(spark, "tagged")          # the joins and ranks run once, not for every pass over the rows
    split.split_and_folds(leads(spark, sf), "converted", "lead_id", k=5).write.parquet(tagged)
    t = spark.read.parquet(tagged)
    names = list(NUM)
    train = t.where("split = 'train'")
    for c in CAT:
        lvls = encode.levels(train, c)
        t = encode.one_hot(t, c, lvls, keep_source=True)
        names += [f"{c}_{v}" for v in lvls]
    return t.select("lead_id", "converted", "split", *[F.col(f"`{n}`").alias(f"f{i}") for i, n in enumerate(names)]), [f"f{i}" for i in range(len(names))]


def _gain(g, h):
    return f"power(greatest(abs({g}) - 0.5, 0), 2) / ({h} + 2)"


@query("booster_root_gains", with_(LEADS) + """,
v AS (SELECT converted, unnest(['visits', 'urgent', 'fulfilled']) AS feature,
             unnest([total_visits, CAST(lead_origin = '1-URGENT' AS DOUBLE), CAST(last_activity = 'F' AS DOUBLE)]) AS x FROM leads),
r AS (SELECT feature, x, dense_rank() OVER (PARTITION BY feature ORDER BY x) AS bin FROM (SELECT DISTINCT feature, x FROM v WHERE x IS NOT NULL)),
b AS (SELECT v.feature, coalesce(bin, 0) AS bin, sum(0.5 - converted) AS g, sum(CAST(0.25 AS DOUBLE)) AS h
      FROM v LEFT JOIN r ON v.feature = r.feature AND v.x = r.x GROUP BY ALL),
t AS (SELECT feature, sum(g) AS ga, sum(h) AS ha, coalesce(sum(g) FILTER (bin = 0), 0) AS gm, coalesce(sum(h) FILTER (bin = 0), 0) AS hm, max(bin) AS top FROM b GROUP BY feature),
c AS (SELECT b.feature, b.bin, top, ga, ha, gm, hm, coalesce(sum(g) FILTER (bin > 0) OVER w, 0) AS g0, coalesce(sum(h) FILTER (bin > 0) OVER w, 0) AS h0
      FROM b JOIN t USING (feature) WINDOW w AS (PARTITION BY b.feature ORDER BY bin)),
s AS (SELECT feature, bin, missing_left, top, CAST(ga AS DOUBLE) AS ga, ha, CAST(g0 + CASE WHEN missing_left THEN gm ELSE 0 END AS DOUBLE) AS gl,
             h0 + CASE WHEN missing_left THEN hm ELSE 0 END AS hl FROM c, (VALUES (true), (false)) m(missing_left))
SELECT feature, CAST(bin AS INTEGER) AS bin, missing_left, gl, hl, CASE WHEN bin > 0 AND bin < top AND hl >= 3 AND ha - hl >= 3 THEN
  round((""" + _gain("gl", "hl") + " + " + _gain("ga - gl", "ha - hl") + " - " + _gain("ga", "ha") + """) * 0.5 - 0.1, 6) END AS gain FROM s""")
def q_booster_root_gains(spark, sf):
    """Gain of every first split under L1, L2, split and child-weight penalties."""
    d = leads(spark, sf).select("lead_id", "converted", F.col("total_visits").alias("visits"), (F.col("lead_origin") == "1-URGENT").cast("double").alias("urgent"),
                                (F.col("last_activity") == "F").cast("double").alias("fulfilled"))
    names = ["visits", "urgent", "fulfilled"]
    params = {**booster.DEFAULTS, "subsample": 1.0, "reg_alpha": 0.5, "reg_lambda": 2.0, "gamma": 0.1, "min_child_weight": 3.0}
    model = booster.Booster(names, booster.bin_bounds(d, names), params)
    return rnd(booster.root_gains(d, model, "converted", "lead_id").drop("G", "H"))


@query("train_booster", with_(SPLIT) + """
SELECT lead_id, converted, true AS in_range, true AS score_fits, true AS label_fits FROM splits WHERE split = 'test'""")
def q_train_booster(spark, sf):
    """Second-order boosted trees fitted on train and scored on test; the oracle checks the rows, the range of
    the probability, its 0-100 score and its label (tests hold the trees against a numpy version)."""
    t, names = coded_leads(spark, sf)
    m = booster.fit_booster(t.where("split = 'train'"), names, "converted", "lead_id", FIT)
    p = booster.predict_booster(m, t.where("split = 'test'"), ["lead_id", "converted"])
    p = p.withColumn("score", lead_score(F.col("probability"))).withColumn("label", (F.col("probability") >= 0.3).cast("int"))
    return p.select("lead_id", "converted", F.col("probability").between(0, 1).alias("in_range"),
                    (F.abs(F.col("score") - 100 * F.col("probability")) <= 0.5).alias("score_fits"),
                    ((F.col("label") == 1) == (F.col("probability") >= 0.3)).alias("label_fits"))


@query("booster_sweep")
def q_booster_sweep(spark, sf):
    """Two draws over all seven axes of the grid (10 trees each)."""
    t, names = coded_leads(spark, sf)
    grid = {**SWEEP_GRID, "n_estimators": [10], "max_depth": [3, 5]}
    return rnd(booster.booster_sweep(t.where("split = 'train'"), t.where("split = 'val'"), names, "converted", "lead_id", grid, draws=2))
