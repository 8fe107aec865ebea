"""Metric, sweep, curve, scoring and split queries over the scored leads."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import curves, metrics, score, split
from ..sources.leads import leads, scored_leads
from .catalog import query, rnd
from .sql import SCORED, SPLIT, with_

CUTOFF = 0.3          # validation cut-off (inclusive >=)


def _ratio(num: str, den: str) -> str:
    return f"ROUND(COALESCE(CAST({num} AS DOUBLE) / NULLIF({den}, 0), 0), 6)"


def _nratio(num: str, den: str) -> str:
    return f"ROUND(CAST({num} AS DOUBLE) / NULLIF({den}, 0), 6)"


_CONF = f"""conf AS (
  SELECT COUNT(*) FILTER (WHERE label = 0 AND score < {CUTOFF}) AS tn,
         COUNT(*) FILTER (WHERE label = 0 AND score >= {CUTOFF}) AS fp,
         COUNT(*) FILTER (WHERE label = 1 AND score < {CUTOFF}) AS fn,
         COUNT(*) FILTER (WHERE label = 1 AND score >= {CUTOFF}) AS tp
  FROM scored)"""


@query("confusion", with_(SCORED, _CONF) + " SELECT tn, fp, fn, tp FROM conf")
def q_confusion(spark, sf):
    return metrics.confusion(scored_leads(spark, sf), CUTOFF, strict=False)


@query("binary_metrics", with_(SCORED, _CONF) + f"""
SELECT CAST({CUTOFF} AS DOUBLE) AS threshold, tn, fp, fn, tp,
       {_ratio('tp + tn', 'tn + fp + fn + tp')} AS accuracy,
       {_ratio('tp', 'tp + fp')} AS "precision",
       {_ratio('tp', 'tp + fn')} AS recall,
       {_ratio('2 * tp', '2 * tp + fp + fn')} AS f1,
       {_nratio('tp', 'tp + fn')} AS sensitivity,
       {_nratio('tn', 'tn + fp')} AS specificity
FROM conf""")
def q_binary_metrics(spark, sf):
    return rnd(metrics.binary_metrics(scored_leads(spark, sf), CUTOFF, strict=False))


_PER_CLASS = """per_class AS (
  SELECT '0' AS cls, tn AS t, fn AS f_pos, fp AS f_neg FROM conf
  UNION ALL SELECT '1', tp, fp, fn FROM conf),
cls_stats AS (
  SELECT cls,
         COALESCE(CAST(t AS DOUBLE) / NULLIF(t + f_pos, 0), 0) AS p,
         COALESCE(CAST(t AS DOUBLE) / NULLIF(t + f_neg, 0), 0) AS r,
         COALESCE(CAST(2 * t AS DOUBLE) / NULLIF(2 * t + f_pos + f_neg, 0), 0) AS f,
         t + f_neg AS support
  FROM per_class WHERE t + f_neg > 0 OR t + f_pos > 0)"""


@query("macro_weighted_f1", with_(SCORED, _CONF, _PER_CLASS) + """
SELECT ROUND(AVG(f), 6) AS macro_f1,
       ROUND(SUM(f * support) / SUM(support), 6) AS weighted_f1
FROM cls_stats""")
def q_macro_weighted_f1(spark, sf):
    return rnd(metrics.macro_weighted_f1(scored_leads(spark, sf), CUTOFF, strict=False))


@query("classification_report", with_(SCORED, _CONF, _PER_CLASS) + """
SELECT cls AS row_label, ROUND(p, 6) AS "precision", ROUND(r, 6) AS recall,
       ROUND(f, 6) AS f1_score, CAST(support AS BIGINT) AS support FROM cls_stats
UNION ALL
SELECT 'accuracy', NULL, NULL, ROUND(CAST(tp + tn AS DOUBLE) / (tp + tn + fp + fn), 6),
       CAST(tp + tn + fp + fn AS BIGINT) FROM conf
UNION ALL
SELECT 'macro avg', ROUND(AVG(p), 6), ROUND(AVG(r), 6), ROUND(AVG(f), 6),
       CAST(SUM(support) AS BIGINT) FROM cls_stats
UNION ALL
SELECT 'weighted avg', ROUND(SUM(p * support) / SUM(support), 6),
       ROUND(SUM(r * support) / SUM(support), 6),
       ROUND(SUM(f * support) / SUM(support), 6), CAST(SUM(support) AS BIGINT)
FROM cls_stats""")
def q_classification_report(spark, sf):
    return rnd(metrics.classification_report(scored_leads(spark, sf), CUTOFF, strict=False))


def _sweep_sql(steps: int, last: int) -> str:
    return f""",
grid AS (SELECT range AS i, CAST(range AS DOUBLE) / {steps} AS t FROM range(0, {last + 1})),
sweep AS (
  SELECT t AS threshold,
         COUNT(*) FILTER (WHERE label = 1 AND score > t) AS tp,
         COUNT(*) FILTER (WHERE label = 0 AND score > t) AS fp,
         COUNT(*) FILTER (WHERE label = 0 AND NOT score > t) AS tn,
         COUNT(*) FILTER (WHERE label = 1 AND NOT score > t) AS fn
  FROM grid, scored GROUP BY t),
rates AS (
  SELECT threshold, tp, fp, tn, fn,
         CAST(tp AS DOUBLE) / NULLIF(tp + fn, 0) AS sensitivity,
         CAST(tn AS DOUBLE) / NULLIF(tn + fp, 0) AS specificity,
         CAST(tp + tn AS DOUBLE) / NULLIF(tp + tn + fp + fn, 0) AS accuracy
  FROM sweep)"""


_SWEEP_OUT = """
SELECT threshold, tp, fp, tn, fn, ROUND(sensitivity, 6) AS sensitivity,
       ROUND(specificity, 6) AS specificity, ROUND(accuracy, 6) AS accuracy FROM rates"""

_OPT = """,
opt AS (SELECT * FROM rates WHERE sensitivity IS NOT NULL AND specificity IS NOT NULL
        ORDER BY ABS(sensitivity - specificity), threshold LIMIT 1)"""


@query("threshold_sweep_101", "WITH " + SCORED + _sweep_sql(100, 100) + _SWEEP_OUT)
def q_sweep_101(spark, sf):
    return rnd(metrics.threshold_sweep(scored_leads(spark, sf), steps=100, strict=True))


@query("threshold_sweep_10", "WITH " + SCORED + _sweep_sql(10, 9) + _SWEEP_OUT)
def q_sweep_10(spark, sf):
    return rnd(metrics.threshold_sweep(scored_leads(spark, sf), steps=10, last=9,
                                       strict=True))


@query("optimal_threshold", "WITH " + SCORED + _sweep_sql(100, 100) + _OPT + """
SELECT threshold AS optimal_threshold, ROUND(sensitivity, 6) AS sensitivity,
       ROUND(specificity, 6) AS specificity,
       ROUND(ABS(sensitivity - specificity), 6) AS abs_diff, tp, fp, tn, fn FROM opt""")
def q_optimal_threshold(spark, sf):
    sw = metrics.threshold_sweep(scored_leads(spark, sf), steps=100, strict=True)
    return rnd(metrics.optimal_threshold(sw))


@query("scores_at_optimum", "WITH " + SCORED + _sweep_sql(100, 100) + _OPT + f"""
SELECT threshold AS optimal_threshold, {_ratio('2 * tp', '2 * tp + fp + fn')} AS f1,
       {_ratio('tp', 'tp + fp')} AS "precision", {_ratio('tp', 'tp + fn')} AS recall,
       {_ratio('tp + tn', 'tp + tn + fp + fn')} AS accuracy FROM opt""")
def q_scores_at_optimum(spark, sf):
    sw = metrics.threshold_sweep(scored_leads(spark, sf), steps=100, strict=True)
    return rnd(metrics.scores_at_optimum(sw))


_CURVE = """,
g AS (SELECT score AS threshold, COUNT(*) FILTER (WHERE label = 1) AS pos,
             COUNT(*) FILTER (WHERE label = 0) AS neg FROM scored GROUP BY score),
c AS (SELECT threshold, pos, neg,
             CAST(SUM(pos) OVER (ORDER BY threshold DESC) AS BIGINT) AS tp,
             CAST(SUM(neg) OVER (ORDER BY threshold DESC) AS BIGINT) AS fp,
             CAST(SUM(pos) OVER () AS BIGINT) AS npos,
             CAST(SUM(neg) OVER () AS BIGINT) AS nneg FROM g),
pr AS (SELECT threshold, CAST(tp AS DOUBLE) / (tp + fp) AS prec,
              CASE WHEN npos = 0 THEN 1.0 ELSE CAST(tp AS DOUBLE) / npos END AS rec
       FROM c)"""


@query("roc_points", "WITH " + SCORED + _CURVE + """
SELECT threshold, ROUND(CAST(fp AS DOUBLE) / NULLIF(nneg, 0), 6) AS fpr,
       ROUND(CAST(tp AS DOUBLE) / NULLIF(npos, 0), 6) AS tpr FROM c
UNION ALL SELECT NULL, 0.0, 0.0""")
def q_roc_points(spark, sf):
    return rnd(curves.roc_points(scored_leads(spark, sf)))


@query("roc_auc", "WITH " + SCORED + _CURVE + """,
pts AS (SELECT CAST(fp AS DOUBLE) / nneg AS x, CAST(tp AS DOUBLE) / npos AS y,
               threshold FROM c)
SELECT ROUND(SUM((x - COALESCE(px, 0)) * (y + COALESCE(py, 0)) / 2), 6) AS roc_auc
FROM (SELECT x, y, LAG(x) OVER (ORDER BY threshold DESC) AS px,
             LAG(y) OVER (ORDER BY threshold DESC) AS py FROM pts)""")
def q_roc_auc(spark, sf):
    return rnd(curves.roc_auc(scored_leads(spark, sf)))


@query("pr_vs_threshold", "WITH " + SCORED + _CURVE + """
SELECT threshold, ROUND(prec, 6) AS "precision", ROUND(rec, 6) AS recall FROM pr""")
def q_pr_vs_threshold(spark, sf):
    return rnd(curves.pr_vs_threshold(scored_leads(spark, sf)))


@query("pr_points", "WITH " + SCORED + _CURVE + """
SELECT threshold, ROUND(prec, 6) AS "precision", ROUND(rec, 6) AS recall FROM pr
UNION ALL SELECT NULL, 1.0, 0.0""")
def q_pr_points(spark, sf):
    return rnd(curves.pr_points(scored_leads(spark, sf)))


@query("pr_auc", "WITH " + SCORED + _CURVE + """
SELECT ROUND(SUM((rec - COALESCE(prev_rec, 0)) * (prec + COALESCE(prev_prec, 1)) / 2), 6)
       AS pr_auc
FROM (SELECT rec, prec, LAG(rec) OVER (ORDER BY threshold DESC) AS prev_rec,
             LAG(prec) OVER (ORDER BY threshold DESC) AS prev_prec FROM pr)""")
def q_pr_auc(spark, sf):
    return rnd(curves.pr_auc(scored_leads(spark, sf)))


@query("lead_scores", "WITH " + SCORED + f"""
SELECT lead_id, label AS actual, score AS predicted_probability,
       CAST(score >= {CUTOFF} AS INTEGER) AS predicted_label,
       CAST(round_even(score * 100, 0) AS INTEGER) AS lead_score FROM scored""")
def q_lead_scores(spark, sf):
    return rnd(score.lead_table(scored_leads(spark, sf), CUTOFF, strict=False))


@query("rank_leads", "WITH " + SCORED + """
SELECT lead_id, label, score, CAST(round_even(score * 100, 0) AS INTEGER) AS lead_score,
       ROW_NUMBER() OVER (ORDER BY score DESC, lead_id) AS rank FROM scored""")
def q_rank_leads(spark, sf):
    s = scored_leads(spark, sf).withColumn(
        "lead_score", F.bround(F.col("score") * 100, 0).cast("int"))
    return rnd(score.rank_leads(s))


_TOP_K = 100


@query("top_leads", "WITH " + SCORED + _sweep_sql(100, 100) + _OPT + f"""
SELECT lead_id, label, score, CAST(round_even(score * 100, 0) AS INTEGER) AS lead_score,
       CAST(score > (SELECT threshold FROM opt) AS INTEGER) AS predicted_label
FROM scored ORDER BY score DESC, lead_id LIMIT {_TOP_K}""")
def q_top_leads(spark, sf):
    """Flagship: scored leads -> 101-point sweep -> optimal cut-off -> top-k
    leads labelled at that cut-off, with their 0-100 scores."""
    s = scored_leads(spark, sf)
    opt = metrics.optimal_threshold(metrics.threshold_sweep(s, 100, strict=True))
    t = opt.first()["optimal_threshold"]  # one scalar decides the label
    top = score.top_leads(s, _TOP_K)
    return rnd(top.select(
        "lead_id", "label", "score",
        F.bround(F.col("score") * 100, 0).cast("int").alias("lead_score"),
        (F.col("score") > F.lit(t)).cast("int").alias("predicted_label")))


@query("score_page", "WITH " + SCORED + """
SELECT lead_id, label, score FROM scored ORDER BY lead_id LIMIT 20 OFFSET 20""")
def q_score_page(spark, sf):
    from ..sources.readers import page
    return rnd(page(scored_leads(spark, sf), ["lead_id"], 20, 20))


@query("stratified_split", "WITH " + SPLIT + """
SELECT lead_id, converted, split FROM splits""")
def q_stratified_split(spark, sf):
    return split.stratified_split(leads(spark, sf).select("lead_id", "converted"),
                                  "converted", "lead_id")


@query("split_sizes", "WITH " + SPLIT + """
SELECT converted, split, COUNT(*) AS n FROM splits GROUP BY converted, split""")
def q_split_sizes(spark, sf):
    s = split.stratified_split(leads(spark, sf).select("lead_id", "converted"),
                               "converted", "lead_id")
    return s.groupBy("converted", "split").agg(F.count(F.lit(1)).alias("n"))


@query("stratified_folds", "WITH " + SPLIT + """
SELECT lead_id, converted, fold FROM splits""")
def q_stratified_folds(spark, sf):
    return split.stratified_folds(leads(spark, sf).select("lead_id", "converted"),
                                  "converted", "lead_id", k=5)


@query("fold_metric_avg", "WITH " + SPLIT + f""",
fs AS (SELECT s.fold, x.label, x.score FROM splits s JOIN scored x USING (lead_id)),
per_fold AS (
  SELECT fold,
         CAST(COUNT(*) FILTER (WHERE (score >= {CUTOFF}) = (label = 1)) AS DOUBLE) / COUNT(*) AS acc,
         COUNT(*) FILTER (WHERE label = 1 AND score >= {CUTOFF}) AS tp,
         COUNT(*) FILTER (WHERE label = 0 AND score >= {CUTOFF}) AS fp,
         COUNT(*) FILTER (WHERE label = 1 AND score < {CUTOFF}) AS fn
  FROM fs GROUP BY fold)
SELECT COUNT(*) AS n_folds, ROUND(AVG(acc), 6) AS mean_accuracy,
       ROUND(AVG(COALESCE(CAST(2 * tp AS DOUBLE) / NULLIF(2 * tp + fp + fn, 0), 0)), 6) AS mean_f1
FROM per_fold""")
def q_fold_metric_avg(spark, sf):
    s = scored_leads(spark, sf)
    folds = split.stratified_folds(s, "label", "lead_id", k=5)
    per = metrics.binary_metrics(folds, CUTOFF, strict=False, by=["fold"])
    return rnd(per.agg(F.count(F.lit(1)).alias("n_folds"),
                       F.avg("accuracy").alias("mean_accuracy"),
                       F.avg("f1").alias("mean_f1")))

