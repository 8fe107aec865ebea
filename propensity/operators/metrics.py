"""Classification metrics over any ``(label, score)`` table (A14-A20, F12,
F13, W1-W4).

Everything is one hash aggregate with map-side partial aggregation: the
confusion counts are four ``count_if``s, and the 101-point threshold sweep
is a single pass that tags each row with the last grid point it passes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import predicted_label, ratio_or_zero, safe_ratio

CONFUSION = ["tn", "fp", "fn", "tp"]


def confusion(df: DataFrame, threshold: float = 0.5, strict: bool = False,
              label: str = "label", score: str = "score",
              by: list[str] | None = None) -> DataFrame:
    """Tn, fp, fn, tp (optionally per group, e.g. per fold)."""
    y = F.col(label)
    yhat = predicted_label(score, threshold, strict)
    aggs = [F.count_if((y == 0) & (yhat == 0)).alias("tn"),
            F.count_if((y == 0) & (yhat == 1)).alias("fp"),
            F.count_if((y == 1) & (yhat == 0)).alias("fn"),
            F.count_if((y == 1) & (yhat == 1)).alias("tp")]
    return df.groupBy(*(by or [])).agg(*aggs)


def rates(tn: Column, fp: Column, fn: Column, tp: Column) -> list[Column]:
    """A15/A16/A19 from confusion counts.

    precision/recall/F1 use ``zero_division=0``; sensitivity/specificity
    are NULL when undefined (one-class labels).
    """
    n = tn + fp + fn + tp
    precision = ratio_or_zero(tp, tp + fp)
    recall = ratio_or_zero(tp, tp + fn)
    f1 = ratio_or_zero(2 * tp, 2 * tp + fp + fn)
    return [ratio_or_zero(tp + tn, n).alias("accuracy"),
            precision.alias("precision"), recall.alias("recall"),
            f1.alias("f1"),
            safe_ratio(tp, tp + fn).alias("sensitivity"),
            safe_ratio(tn, tn + fp).alias("specificity")]


def binary_metrics(df: DataFrame, threshold: float = 0.5, strict: bool = False,
                   label: str = "label", score: str = "score",
                   by: list[str] | None = None) -> DataFrame:
    """A14-A16 in one row (per group)."""
    c = confusion(df, threshold, strict, label, score, by)
    cols = [F.col(x) for x in CONFUSION]
    return c.select(*(by or []), F.lit(float(threshold)).alias("threshold"),
                    *CONFUSION, *rates(*cols))


def _class_rows(c: DataFrame) -> DataFrame:
    """Per-class precision/recall/F1/support from one confusion row.

    Class 1 uses (tp, fp, fn); class 0 mirrors it as (tn, fn, fp).  A class
    is reported when it occurs in the labels or the predictions.
    """
    rows = F.array(
        F.struct(F.lit("0").alias("cls"), F.col("tn").alias("t"),
                 F.col("fn").alias("f_pos"), F.col("fp").alias("f_neg")),
        F.struct(F.lit("1").alias("cls"), F.col("tp").alias("t"),
                 F.col("fp").alias("f_pos"), F.col("fn").alias("f_neg")))
    x = c.select(F.inline(rows))
    return x.select(
        "cls",
        ratio_or_zero(F.col("t"), F.col("t") + F.col("f_pos")).alias("precision"),
        ratio_or_zero(F.col("t"), F.col("t") + F.col("f_neg")).alias("recall"),
        ratio_or_zero(2 * F.col("t"), 2 * F.col("t") + F.col("f_pos")
                      + F.col("f_neg")).alias("f1_score"),
        (F.col("t") + F.col("f_neg")).alias("support"),
        (F.col("t") + F.col("f_pos")).alias("__predicted"),
    ).where((F.col("support") > 0) | (F.col("__predicted") > 0)).drop("__predicted")


def classification_report(df: DataFrame, threshold: float = 0.5,
                          strict: bool = False, label: str = "label",
                          score: str = "score") -> DataFrame:
    """Per class + accuracy + macro avg + weighted avg rows."""
    c = confusion(df, threshold, strict, label, score)
    per = _class_rows(c)
    summ = per.agg(
        F.avg("precision").alias("m_p"), F.avg("recall").alias("m_r"),
        F.avg("f1_score").alias("m_f"),
        safe_ratio(F.sum(F.col("precision") * F.col("support")), F.sum("support")).alias("w_p"),
        safe_ratio(F.sum(F.col("recall") * F.col("support")), F.sum("support")).alias("w_r"),
        safe_ratio(F.sum(F.col("f1_score") * F.col("support")), F.sum("support")).alias("w_f"),
        F.sum("support").alias("n"))
    rows = summ.select(F.inline(F.array(
        F.struct(F.lit("macro avg").alias("cls"), F.col("m_p").alias("precision"),
                 F.col("m_r").alias("recall"), F.col("m_f").alias("f1_score"),
                 F.col("n").alias("support")),
        F.struct(F.lit("weighted avg").alias("cls"), F.col("w_p").alias("precision"),
                 F.col("w_r").alias("recall"), F.col("w_f").alias("f1_score"),
                 F.col("n").alias("support")))))
    acc_row = c.select(
        F.lit("accuracy").alias("cls"), F.lit(None).cast("double").alias("precision"),
        F.lit(None).cast("double").alias("recall"),
        ratio_or_zero(F.col("tp") + F.col("tn"),
                      F.col("tp") + F.col("tn") + F.col("fp") + F.col("fn")).alias("f1_score"),
        (F.col("tp") + F.col("tn") + F.col("fp") + F.col("fn")).alias("support"))
    return per.unionByName(acc_row).unionByName(rows).withColumnRenamed("cls", "row_label")


def macro_weighted_f1(df: DataFrame, threshold: float = 0.5, strict: bool = False,
                      label: str = "label", score: str = "score") -> DataFrame:
    """Unweighted and support-weighted mean F1 over present classes."""
    per = _class_rows(confusion(df, threshold, strict, label, score))
    return per.agg(
        F.avg("f1_score").alias("macro_f1"),
        safe_ratio(F.sum(F.col("f1_score") * F.col("support")),
                   F.sum("support")).alias("weighted_f1"))


def _last_passed(score: Column, steps: int, last: int, strict: bool) -> Column:
    """Index of the last grid point i/steps that ``score`` passes (-1: none).

    ``score*steps`` can be one ulp off (0.07*100 > 7), so the first guess is
    corrected with exact comparisons against i/steps.
    """
    s = F.lit(float(steps))
    if strict:  # passes i  <=>  i/steps < score
        c = F.ceil(score * s).cast("long") - 1
        k = (F.when((c + 1).cast("double") / s < score, c + 1)
             .when(c.cast("double") / s >= score, c - 1).otherwise(c))
    else:       # passes i  <=>  i/steps <= score
        c = F.floor(score * s).cast("long")
        k = (F.when((c + 1).cast("double") / s <= score, c + 1)
             .when(c.cast("double") / s > score, c - 1).otherwise(c))
    return F.least(F.greatest(k, F.lit(-1)), F.lit(last))


def threshold_sweep(df: DataFrame, steps: int = 100, last: int | None = None,
                    strict: bool = True, label: str = "label",
                    score: str = "score") -> DataFrame:
    """Confusion counts and rates at thresholds i/steps, i=0..last.

    One pass over the data: ``groupBy(last grid index passed)`` gives at most
    ``last+2`` groups; the reverse running sum over that tiny table gives
    every threshold's counts.  The grid table is bounded by ``last+2`` rows.
    """
    last = steps if last is None else last
    spark = df.sparkSession
    k = _last_passed(F.col(score), steps, last, strict)
    per_k = df.groupBy(k.alias("k")).agg(
        F.count_if(F.col(label) == 1).alias("pos"),
        F.count_if(F.col(label) == 0).alias("neg"))
    g = spark.range(-1, last + 1).withColumnRenamed("id", "k")
    t = g.join(F.broadcast(per_k), "k", "left").na.fill(0, ["pos", "neg"])
    w_desc = Window.orderBy(F.col("k").desc()).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    w_all = Window.partitionBy()
    t = t.select("k",
                 F.sum("pos").over(w_desc).alias("tp"),
                 F.sum("neg").over(w_desc).alias("fp"),
                 F.sum("pos").over(w_all).alias("P"),
                 F.sum("neg").over(w_all).alias("N"))
    t = t.where(F.col("k") >= 0)
    tp, fp = F.col("tp"), F.col("fp")
    fn, tn = F.col("P") - tp, F.col("N") - fp
    return t.select(
        (F.col("k").cast("double") / F.lit(float(steps))).alias("threshold"),
        tp.alias("tp"), fp.alias("fp"), tn.alias("tn"), fn.alias("fn"),
        safe_ratio(tp, F.col("P")).alias("sensitivity"),
        safe_ratio(tn, F.col("N")).alias("specificity"),
        ratio_or_zero(tp + tn, F.col("P") + F.col("N")).alias("accuracy"))


def optimal_threshold(sweep: DataFrame) -> DataFrame:
    """Argmin |sensitivity - specificity|, ties -> lowest cut-off."""
    d = F.abs(F.col("sensitivity") - F.col("specificity"))
    return (sweep.where(d.isNotNull())
            .select(F.col("threshold").alias("optimal_threshold"),
                    "sensitivity", "specificity", d.alias("abs_diff"),
                    "tp", "fp", "tn", "fn")
            .orderBy("abs_diff", "optimal_threshold").limit(1))


def scores_at_optimum(sweep: DataFrame) -> DataFrame:
    """F1, precision, recall, accuracy at the optimal cut-off.

    The sweep already holds the confusion counts at every grid point, so no
    second pass over the scored rows is needed.
    """
    o = optimal_threshold(sweep)
    tp, fp, tn, fn = (F.col(x) for x in ("tp", "fp", "tn", "fn"))
    return o.select("optimal_threshold",
                    ratio_or_zero(2 * tp, 2 * tp + fp + fn).alias("f1"),
                    ratio_or_zero(tp, tp + fp).alias("precision"),
                    ratio_or_zero(tp, tp + fn).alias("recall"),
                    ratio_or_zero(tp + tn, tp + tn + fp + fn).alias("accuracy"))
