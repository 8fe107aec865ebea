"""ROC and precision-recall curves and their areas.

Rows are first grouped by distinct score (partial aggregation, so a score
shared by a third of all rows costs nothing extra), then cumulative
true/false positive counts in descending score order come from the
range-bucketed ``running_totals`` — never a one-task global window.

The previous curve point is the cumulative count minus the group's own
count, so both trapezoid areas are plain sums with no ``lag``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import safe_ratio
from .ordering import running_totals


def curve_table(df: DataFrame, label: str = "label", score: str = "score",
                n_buckets: int | None = None) -> DataFrame:
    """One row per distinct score: pos/neg in the group, cumulative tp/fp
    for the cut-off ``score >= threshold``, and class totals P/N.  Rows without
    a score can't be ranked: they are left out of the cumulative counts and of P/N alike."""
    g = df.where(F.col(score).isNotNull()).groupBy(F.col(score).alias("threshold")).agg(
        F.count_if(F.col(label) == 1).alias("pos"),
        F.count_if(F.col(label) == 0).alias("neg"))
    c = running_totals(g, "threshold", ["pos", "neg"], descending=True,
                       n_buckets=n_buckets, with_totals=True)
    return c.select("threshold", "pos", "neg",
                    F.col("cum_pos").alias("tp"), F.col("cum_neg").alias("fp"),
                    F.col("total_pos").alias("P"), F.col("total_neg").alias("N"))


def _precision(tp, fp):
    return safe_ratio(tp, tp + fp)


def _recall(tp, P):
    # sklearn: recall is 1 everywhere when there is no positive at all
    return F.when(P == 0, F.lit(1.0)).otherwise(safe_ratio(tp, P))


def roc_points(df: DataFrame, label: str = "label", score: str = "score",
               n_buckets: int | None = None) -> DataFrame:
    """(threshold, fpr, tpr) per distinct score plus the origin.

    The origin's threshold is NULL (no row passes).  Collinear points are
    kept; the area is the same as with them dropped.
    """
    c = curve_table(df, label, score, n_buckets)
    pts = c.select("threshold", safe_ratio(F.col("fp"), F.col("N")).alias("fpr"),
                   safe_ratio(F.col("tp"), F.col("P")).alias("tpr"))
    origin = df.sparkSession.range(1).select(
        F.lit(None).cast("double").alias("threshold"),
        F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return pts.unionByName(origin)


def roc_auc(df: DataFrame, label: str = "label", score: str = "score",
            n_buckets: int | None = None) -> DataFrame:
    """Trapezoid area under the ROC curve (NULL for one-class labels)."""
    c = curve_table(df, label, score, n_buckets)
    area = F.col("neg") * (2 * F.col("tp") - F.col("pos"))
    return c.agg(safe_ratio(F.sum(area.cast("double")),
                            2.0 * F.max("P") * F.max("N")).alias("roc_auc"))


def pr_vs_threshold(df: DataFrame, label: str = "label", score: str = "score",
                    n_buckets: int | None = None) -> DataFrame:
    """Precision and recall at every distinct score (no anchor)."""
    c = curve_table(df, label, score, n_buckets)
    return c.select("threshold", _precision(F.col("tp"), F.col("fp")).alias("precision"),
                    _recall(F.col("tp"), F.col("P")).alias("recall"))


def pr_points(df: DataFrame, label: str = "label", score: str = "score",
              n_buckets: int | None = None) -> DataFrame:
    """W9 plus the end point (precision 1, recall 0, threshold NULL)."""
    anchor = df.sparkSession.range(1).select(
        F.lit(None).cast("double").alias("threshold"),
        F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall"))
    return pr_vs_threshold(df, label, score, n_buckets).unionByName(anchor)


def pr_auc(df: DataFrame, label: str = "label", score: str = "score",
           n_buckets: int | None = None) -> DataFrame:
    """Trapezoid area under (recall, precision) from the end point."""
    c = curve_table(df, label, score, n_buckets)
    tp, fp, P = F.col("tp"), F.col("fp"), F.col("P")
    ptp, pfp = tp - F.col("pos"), fp - F.col("neg")
    prec = _precision(tp, fp)
    prev_prec = F.when(ptp + pfp == 0, F.lit(1.0)).otherwise(_precision(ptp, pfp))
    rec, prev_rec = _recall(tp, P), F.when(ptp + pfp == 0, F.lit(0.0)).otherwise(_recall(ptp, P))
    area = (rec - prev_rec) * (prec + prev_prec) / 2.0
    return c.agg(F.sum(area).alias("pr_auc"))


def curve_dump(df: DataFrame, label: str = "label", score: str = "score",
               n_buckets: int | None = None) -> DataFrame:
    """S10 payload: every curve column in one long table."""
    c = curve_table(df, label, score, n_buckets)
    return c.select("threshold", "tp", "fp",
                    _precision(F.col("tp"), F.col("fp")).alias("precision"),
                    _recall(F.col("tp"), F.col("P")).alias("recall"),
                    safe_ratio(F.col("tp"), F.col("P")).alias("tpr"),
                    safe_ratio(F.col("fp"), F.col("N")).alias("fpr"))
