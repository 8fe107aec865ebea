"""Chained imputation from Gram matrices against the same rounds over the rows themselves."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from propensity.operators import chained


def rows_version(x, estimator, max_iter=10, tol=1e-3):
    there = ~np.isnan(x)
    mean, dev = np.nanmean(x, 0), np.nanstd(x, 0)
    z = (x - mean) / np.where(dev > 0, dev, 1)
    limit = tol * np.nanmax(np.abs(z))
    cur = np.where(there, z, 0.0)
    for _ in range(max_iter):
        before = cur.copy()
        for j in sorted(range(x.shape[1]), key=lambda j: (~there[:, j]).sum()):
            if there[:, j].all():
                continue
            o = [k for k in range(x.shape[1]) if k != j]
            a, y = cur[there[:, j]][:, o], cur[there[:, j], j]
            ac, yc = a - a.mean(0), y - y.mean()
            w = estimator(ac.T @ ac, ac.T @ yc, yc @ yc, len(y))
            cur[~there[:, j], j] = y.mean() + (cur[~there[:, j]][:, o] - a.mean(0)) @ w
        if np.abs(cur - before).sum(1).max() < limit:
            break
    return cur * np.where(dev > 0, dev, 1) + mean


@pytest.mark.parametrize("estimator", [chained.bayesian_ridge, chained.ordinary, chained.lasso(0.05)])
def test_equal_to_the_rounds_over_rows(spark, estimator):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(300, 2))
    x = np.column_stack([base[:, 0] * 50 + 3, base @ [1, 2] + rng.normal(size=300) * .2, base[:, 1] ** 2, base @ [-3, 1] * 1000])
    x[rng.random(x.shape) < [.1, .2, .05, .3]] = np.nan
    x[5] = np.nan
    rows = [(i, *[None if np.isnan(v) else float(v) for v in r]) for i, r in enumerate(x)]
    df = spark.createDataFrame(rows, "id int, a double, b double, c double, d double").repartition(4)
    got = np.array([r[1:] for r in chained.impute_chained(df, list("abcd"), estimator).orderBy("id").collect()])
    want = rows_version(x, estimator)
    assert np.allclose(got, want, rtol=1e-6, atol=1e-6) and not np.isnan(got).any()


def test_bayesian_ridge_on_clean_line_and_noise():
    x = np.linspace(-1, 1, 50)
    assert chained.bayesian_ridge(np.array([[x @ x]]), np.array([x @ (3 * x)]), 9 * x @ x, 50)[0] == pytest.approx(3, rel=1e-6)
    y = np.random.default_rng(0).normal(size=50)
    y -= y.mean()
    least = (x @ y) / (x @ x)
    assert abs(chained.bayesian_ridge(np.array([[x @ x]]), np.array([x @ y]), y @ y, 50)[0]) < abs(least)


def test_odd_input(spark):
    df = spark.createDataFrame([(1, 1.0, None, 5.0), (2, None, None, 5.0), (3, float("nan"), None, None)], "id int, a double, b double, c double")
    got = [tuple(r) for r in chained.impute_chained(df, ["a", "b", "c"]).orderBy("id").collect()]
    assert got == [(1, 1.0, None, 5.0), (2, 1.0, None, 5.0), (3, 1.0, None, 5.0)]
    assert chained.impute_chained(df.where("id > 9"), ["a", "b"]).count() == 0
    wide = df.select(*[F.col("a").alias(f"x{i}") for i in range(13)])
    with pytest.raises(ValueError):
        chained.impute_chained(wide, wide.columns)


def test_one_pass_for_all_regressions(spark, monkeypatch):
    """Without rounds for the stopping rule there are two jobs' worth of aggregates whatever the number of fits."""
    calls = []
    real = chained._regression
    monkeypatch.setattr(chained, "_regression", lambda *a: calls.append(1) or real(*a))
    df = spark.range(100).selectExpr("CAST(id AS DOUBLE) a", "IF(id % 7 = 0, NULL, id * 2.0D) b", "IF(id % 5 = 0, NULL, id * -1.0D) c")
    out = chained.impute_chained(df, list("abc"), chained.ordinary, max_iter=3, tol=0.0)
    assert len(calls) == 6 and out.where("abs(b - 2 * a) > 1e-6 OR abs(c + a) > 1e-6").count() == 0
