"""The distributed histogram booster against a single-process numpy version."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from propensity.operators import booster

FEATURES = ["a", "b", "c"]
BASE = {"n_estimators": 4, "max_depth": 3, "learning_rate": 0.3, "subsample": 1.0}


@pytest.fixture(scope="module")
def table():
    rng = np.random.default_rng(8)
    x = np.column_stack([rng.integers(0, 9, 700), rng.normal(size=700).round(1), rng.integers(0, 2, 700)]).astype(float)
    y = (x[:, 0] + 3 * x[:, 2] + rng.normal(size=700) > 6).astype(float)
    x[rng.random(x.shape) < 0.07] = np.nan
    return x, y


@pytest.fixture(scope="module")
def frame(spark, table):
    x, y = table
    rows = [(i, float(t), *[None if np.isnan(v) else float(v) for v in r]) for i, (r, t) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "id long, y double, a double, b double, c double").repartition(5).cache()


def numpy_fit(x, y, bounds, p):
    """Plain recursive trees over sets of rows."""
    p = {**booster.DEFAULTS, **p}
    code = np.zeros(x.shape, int)
    for f, b in enumerate(bounds):
        for i, v in enumerate(x[:, f]):
            code[i, f] = 0 if np.isnan(v) else 1 + sum(v > t for t in b)
    margin = np.zeros(len(y))

    def score(g, h):
        return max(abs(g) - p["reg_alpha"], 0) ** 2 / (h + p["reg_lambda"])

    def grow(rows, depth, g, h, out):
        G, H = g[rows].sum(), h[rows].sum()
        best = None
        for f in range(x.shape[1]) if depth else ():
            for b in sorted(set(code[rows, f]) - {0})[:-1]:
                for missing in (False, True):
                    left = rows & (code[:, f] <= b) & ((code[:, f] > 0) | missing)
                    gl, hl = g[left].sum(), h[left].sum()
                    if hl < p["min_child_weight"] or H - hl < p["min_child_weight"]:
                        continue
                    gain = round((score(gl, hl) + score(G - gl, H - hl) - score(G, H)) * 0.5 - p["gamma"], 9)
                    if best is None or gain > best[0]:
                        best = gain, left
        if best is None or best[0] <= 1e-9:
            out[rows] = -p["learning_rate"] * np.sign(G) * max(abs(G) - p["reg_alpha"], 0) / (H + p["reg_lambda"])
            return
        grow(best[1], depth - 1, g, h, out)
        grow(rows & ~best[1], depth - 1, g, h, out)

    for _ in range(p["n_estimators"]):
        prob = 1 / (1 + np.exp(-margin))
        g, h = (np.rint(v * booster.SCALE) / booster.SCALE for v in (prob - y, prob * (1 - prob)))
        step = np.zeros(len(y))
        grow(np.ones(len(y), bool), p["max_depth"], g, h, step)
        margin += step
    return 1 / (1 + np.exp(-margin))


@pytest.mark.parametrize("extra", [{}, {"reg_alpha": 2.0}, {"reg_lambda": 20.0}, {"gamma": 3.0}, {"min_child_weight": 15.0}])
def test_equal_to_numpy_and_every_axis_acts(frame, table, extra):
    x, y = table
    bounds = booster.bin_bounds(frame, FEATURES)
    model = booster.fit_booster(frame, FEATURES, "y", "id", {**BASE, **extra}, bounds=bounds)
    got = np.array([r[1] for r in booster.predict_booster(model, frame, ["id"]).orderBy("id").collect()])
    want = numpy_fit(x, y, bounds, {**BASE, **extra})
    assert np.abs(got - want).max() < 1e-6
    if extra:
        assert np.abs(got - numpy_fit(x, y, bounds, BASE)).max() > 1e-3


def test_partitions_do_not_matter_and_models_reload(spark, frame, tmp_path, monkeypatch):
    monkeypatch.setattr(booster, "KEEP_EVERY", 2)
    p = {**BASE, "n_estimators": 5, "subsample": 0.7}
    one = booster.fit_booster(frame.coalesce(1), FEATURES, "y", "id", p)
    many = booster.fit_booster(frame.repartition(7), FEATURES, "y", "id", p)
    assert one == many
    again = booster.Booster.load(spark, many.save(spark, str(tmp_path / "m")))
    assert again == many and sum(booster.booster_importance(again).values()) > 0
    assert many != booster.fit_booster(frame, FEATURES, "y", "id", {**p, "seed": 1})


def test_odd_input(spark, frame):
    with pytest.raises(ValueError):
        booster.fit_booster(frame, FEATURES, "y", "id", {"depth": 3})
    empty = booster.fit_booster(frame.where("id < 0"), FEATURES, "y", "id", {**BASE, "n_estimators": 1})
    assert {r[0] for r in booster.predict_booster(empty, frame, []).collect()} == {0.5}
    flat = frame.select("id", F.lit(1.0).alias("a"), F.lit(None).cast("double").alias("b"), F.when(F.col("id") > 3, F.col("y")).alias("y"))
    m = booster.fit_booster(flat, ["a", "b"], "y", "id", {**BASE, "n_estimators": 20, "learning_rate": 1.0})
    assert abs(booster.predict_booster(m, flat, []).first()[0] - flat.agg(F.avg("y")).first()[0]) < 1e-4


@pytest.mark.parametrize("features, nodes", [(3, [2, 3]), (5000, [4, 5, 6, 7])])
def test_sums_by_array_and_by_cell(features, nodes):
    """Exact sums of the open nodes' rows: a feature's usual code gets what the others leave, and many cells need no array."""
    import pyarrow as pa
    rng = np.random.default_rng(2)
    n = 60
    codes = np.where(rng.random((n, features)) < .8, 1, rng.integers(0, 4, (n, features))).astype(np.uint8)
    y, margin = rng.integers(0, 2, n).astype(float), rng.normal(size=n)
    batch = pa.record_batch([pa.array(np.arange(n)), pa.array(y), pa.array([r.tobytes() for r in codes], pa.binary()), pa.array(margin)],
                            names=["key", "y", "codes", "margin"])
    tree = booster.Tree.of_depth(3)
    tree.feature[1:4], tree.bin[1:4] = [0, 1, 2], [1, 1, 1]
    params = {**booster.DEFAULTS, "max_depth": 3, "subsample": 1.0}
    if nodes == [2, 3]:
        tree.feature[2:4] = [-1, -1]
    got = {}
    for out in booster._histogram(features, [], tree, nodes, 0, params)(iter([batch.slice(0, 0), batch.slice(0, 25), batch.slice(25)])):
        for node, f, b, g, h in zip(*[c.to_pylist() for c in out.columns]):
            old = got.get((node, f, b), (0, 0))
            got[node, f, b] = old[0] + g, old[1] + h
    want, prob = {}, 1 / (1 + np.exp(-margin))
    for i in range(n):
        node = 1
        while tree.feature[node] >= 0:
            c = codes[i, tree.feature[node]]
            node = 2 * node + (not (tree.missing_left[node] if c == 0 else c <= tree.bin[node]))
        for f in range(features if node in nodes else 0):
            old = want.get((node, f, int(codes[i, f])), (0, 0))
            want[node, f, int(codes[i, f])] = old[0] + int(np.rint((prob[i] - y[i]) * booster.SCALE)), old[1] + int(np.rint(prob[i] * (1 - prob[i]) * booster.SCALE))
    assert got == want
