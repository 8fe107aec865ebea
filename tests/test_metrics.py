import pytest

from propensity.operators import curves, metrics, score
from propensity.functions.scalar import lead_score


def frame(spark, scores, labels):
    return spark.createDataFrame([(i, l, s) for i, (s, l) in enumerate(zip(scores, labels))],
                                 "lead_id long, label int, score double")


TIES = ([0.9, 0.9, 0.7, 0.7, 0.1], [1, 0, 1, 0, 0])


def test_confusion_and_rates(spark):
    df = frame(spark, *TIES)
    c = metrics.binary_metrics(df, 0.7, strict=False).first()
    assert (c.tn, c.fp, c.fn, c.tp) == (1, 2, 0, 2)
    assert c.precision == pytest.approx(0.5) and c.recall == 1.0
    assert c.specificity == pytest.approx(1 / 3)
    s = metrics.binary_metrics(df, 0.7, strict=True).first()
    assert (s.tn, s.fp, s.fn, s.tp) == (2, 1, 1, 1)


def test_roc_pr_on_ties(spark):
    df = frame(spark, *TIES)
    pts = sorted((r.fpr, r.tpr) for r in curves.roc_points(df, n_buckets=2).collect())
    assert pts == [(0.0, 0.0), (pytest.approx(1 / 3), 0.5), (pytest.approx(2 / 3), 1.0), (1.0, 1.0)]
    # trapezoids: (1/3)(0.25) + (1/3)(0.75) + (1/3)(1.0)
    assert curves.roc_auc(df).first().roc_auc == pytest.approx(2 / 3)
    # PR: (r,p) = (0.5,0.5), (1,0.5), (1,0.4) from anchor (0,1)
    assert curves.pr_auc(df, n_buckets=3).first().pr_auc == pytest.approx(0.5 * 0.75 + 0.5 * 0.5)
    pr = sorted((r.threshold is None, r.recall, r.precision) for r in curves.pr_points(df).collect())
    assert len(pr) == 4


def test_auc_matches_bruteforce(spark):
    import random
    rnd = random.Random(7)
    sc = [round(rnd.random(), 2) for _ in range(400)]
    lb = [int(rnd.random() < s) for s in sc]
    df = frame(spark, sc, lb)
    pos = [s for s, l in zip(sc, lb) if l == 1]
    neg = [s for s, l in zip(sc, lb) if l == 0]
    brute = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    for nb in (1, 3, 16):
        assert curves.roc_auc(df, n_buckets=nb).first().roc_auc == pytest.approx(brute)


def test_sweep_grid_edges(spark):
    df = frame(spark, [0.0, 0.07, 0.29, 0.57, 1.0], [0, 1, 0, 1, 1])
    sw = {round(r.threshold, 2): r for r in metrics.threshold_sweep(df, 100, strict=True).collect()}
    assert len(sw) == 101
    assert sw[0.07].tp == 2 and sw[0.06].tp == 3       # 0.07 > 0.07 is false
    assert sw[0.0].tp + sw[0.0].fp == 4                 # 0.0 never passes
    assert sw[1.0].tp == 0                              # 1.0 > 1.0 is false
    brute = {t / 100: sum(1 for s, l in zip([0.0, 0.07, 0.29, 0.57, 1.0], [0, 1, 0, 1, 1])
                          if l == 1 and s > t / 100) for t in range(101)}
    assert {round(k, 2): v.tp for k, v in sw.items()} == {round(k, 2): v for k, v in brute.items()}
    inc = {round(r.threshold, 2): r for r in metrics.threshold_sweep(df, 100, strict=False).collect()}
    assert inc[0.07].tp == 3 and inc[1.0].tp == 1


def test_optimal_threshold_lowest_tie(spark):
    df = frame(spark, *TIES)
    sw = metrics.threshold_sweep(df, 10, last=9, strict=True)
    o = metrics.optimal_threshold(sw).first()
    rows = sorted(((abs(r.sensitivity - r.specificity), r.threshold) for r in sw.collect()))
    assert o.optimal_threshold == rows[0][1]


def test_one_class_labels(spark):
    df = frame(spark, [0.2, 0.4, 0.9], [0, 0, 0])
    m = metrics.binary_metrics(df, 0.3).first()
    assert m.sensitivity is None and m.specificity == pytest.approx(1 / 3)
    assert m.precision == 0.0 and m.f1 == 0.0
    rep = {r.row_label: r for r in metrics.classification_report(df, 0.3).collect()}
    assert set(rep) == {"0", "1", "accuracy", "macro avg", "weighted avg"}  # class 1 predicted
    df0 = frame(spark, [0.1, 0.2], [0, 0])
    rep0 = {r.row_label for r in metrics.classification_report(df0, 0.3).collect()}
    assert rep0 == {"0", "accuracy", "macro avg", "weighted avg"}
    assert curves.roc_auc(df).first().roc_auc is None


def test_lead_score_half_even(spark):
    df = spark.createDataFrame([(0.005,), (0.125,), (0.625,), (0.135,)], "p double")
    got = [r[0] for r in df.select(lead_score("p")).collect()]
    assert got == [0, 12, 62, 14]


def test_rank_is_total_order(spark):
    df = frame(spark, [0.5, 0.9, 0.5, 0.1, 0.9], [0, 1, 1, 0, 0]).repartition(3)
    r = {x.lead_id: x.rank for x in score.rank_leads(df).collect()}
    assert r == {1: 1, 4: 2, 0: 3, 2: 4, 3: 5}


def test_empty_input(spark):
    df = frame(spark, [], []).where("score > 2")
    c = metrics.confusion(df, 0.5).first()
    assert (c.tn, c.fp, c.fn, c.tp) == (0, 0, 0, 0)
    assert curves.roc_points(df).count() == 1
    assert metrics.threshold_sweep(df, 10).count() == 11


def test_auc_agrees_with_spark_evaluator(spark):
    """Cross-check against Spark ML's exact evaluator (numBins=0)."""
    import random
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    from pyspark.ml.linalg import Vectors
    rnd = random.Random(3)
    data = [(round(rnd.random(), 2), int(rnd.random() < 0.4)) for _ in range(500)]
    df = frame(spark, [s for s, _ in data], [l for _, l in data])
    vec = spark.createDataFrame([(Vectors.dense([1 - s, s]), float(l)) for s, l in data],
                                ["raw", "label"])
    ev = BinaryClassificationEvaluator(rawPredictionCol="raw", labelCol="label", numBins=0)
    assert curves.roc_auc(df).first().roc_auc == pytest.approx(ev.evaluate(vec), abs=1e-9)


def test_approx_describe_close_to_exact(spark):
    from propensity.operators import profile
    df = spark.range(0, 1001).selectExpr("cast(id as double) as x")
    e = profile.describe(df, ["x"]).first()
    a = profile.describe(df, ["x"], exact=False).first()
    assert e.q50 == 500.0 and abs(a.q50 - 500.0) <= 1.0
