"""Hot keys and repartitioning must not change any result."""
import random

import pytest
from pyspark.sql import functions as F

from propensity.operators import clean, curves, metrics, profile, score


@pytest.fixture(scope="module")
def hot(spark):
    """A third of all rows share one score (0.5) and one duplicate key."""
    rnd = random.Random(11)
    rows = []
    for i in range(3000):
        s = 0.5 if i % 3 == 0 else round(rnd.random(), 3)
        rows.append((i, int(rnd.random() < s), s, -1 if i % 3 == 0 else i))
    return spark.createDataFrame(rows, "lead_id long, label int, score double, k long"), rows


def brute_auc(rows):
    pos = [r[2] for r in rows if r[1] == 1]
    neg = [r[2] for r in rows if r[1] == 0]
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


def test_auc_with_hot_score(hot):
    df, rows = hot
    want = brute_auc(rows)
    for parts in (1, 7):
        got = curves.roc_auc(df.repartition(parts), n_buckets=5).first().roc_auc
        assert got == pytest.approx(want)


def test_metrics_invariant_to_partitioning(hot):
    df, _ = hot
    a = sorted(tuple(r) for r in metrics.threshold_sweep(df, 100).collect())
    b = sorted(tuple(r) for r in metrics.threshold_sweep(df.repartition(13, "score"), 100).collect())
    assert a == b
    pa = sorted(tuple(r) for r in curves.pr_points(df).collect() if r.threshold is not None)
    pb = sorted(tuple(r) for r in curves.pr_points(df.repartition(5)).collect()
                if r.threshold is not None)
    assert pa == pb


def test_rank_with_hot_score(hot):
    df, rows = hot
    got = {r.lead_id: r.rank for r in score.rank_leads(df.repartition(4)).collect()}
    order = sorted(rows, key=lambda r: (-r[2], r[0]))
    assert got == {r[0]: i + 1 for i, r in enumerate(order)}


def test_dedupe_with_hot_key(hot):
    df, rows = hot
    d = clean.dedupe_first(df.select("k", "lead_id", "score"), ["k"], order=["lead_id"])
    got = {r.k: r.lead_id for r in d.collect()}
    assert got[-1] == 0 and len(got) == 2001
    c = clean.duplicate_count(df, ["k"]).first()
    assert c.n_duplicates == 999


def test_quantiles_with_hot_value(hot):
    df, rows = hot
    import numpy as np
    vals = np.array([r[2] for r in rows])
    q = {r.prob: r.quantile for r in profile.exact_quantiles(df, ["score"], (0.1, 0.5, 0.9)).collect()}
    for p, v in q.items():
        assert v == pytest.approx(float(np.quantile(vals, p)))
