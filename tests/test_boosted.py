"""Boosted trees on binned rows: the trees of GBTClassifier, for fits of many rows."""
import re

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.sql import functions as F

from propensity.operators import boosted, boosted_rows, model

NUM, CAT = ["x", "y"], ["c", "d"]
NUMBER = re.compile(r"-?\d+\.\d+(?:E-?\d+)?")


@pytest.fixture(scope="module")
def rows(spark):
    """Two numbers (one with gaps), two categories (one with gaps), a label that hangs on all four."""
    h = lambda k, n: F.pmod(F.xxhash64(F.col("id"), F.lit(k)), F.lit(n))
    d = spark.range(0, 12_000, 1, 3).select(
        (h(1, 1_000_003) / 1e5).alias("x"), F.when(h(2, 10) > 0, (h(3, 40)).cast("double")).alias("y"),
        F.concat(F.lit("c"), h(4, 5)).alias("c"), F.when(h(5, 9) > 0, F.concat(F.lit("d"), h(6, 12))).alias("d"), (h(7, 1000) / 250.0).alias("e"))
    score = F.col("x") / 4 + F.sin(F.col("y")) + (F.col("c") == "c3").cast("double") + F.coalesce(F.length("d"), F.lit(1)) + F.col("e")
    return d.select(*NUM, *CAT, (F.coalesce(score, F.col("e")) > 4.9).cast("int").alias("converted")).cache()


def both(rows, monkeypatch, **params):
    monkeypatch.setattr(model, "BINNED_ROWS", 10**12)
    a = model.fit_model(rows, NUM, CAT, params=params)
    monkeypatch.setattr(model, "BINNED_ROWS", 1)
    monkeypatch.setattr(GBTClassifier, "fit", lambda *_: pytest.fail("the fit of many rows took the way of few"))
    b = model.fit_model(rows, NUM, CAT, params=params)
    monkeypatch.undo()
    return a, b


def shape(m):
    text = m.stages[-1].toDebugString.split("\n", 1)[1]
    return NUMBER.sub("#", text), [float(x) for x in NUMBER.findall(text)]


@pytest.mark.parametrize("params", [{}, {"subsample": 1.0, "learning_rate": 0.1, "max_depth": 2}, {"min_child_weight": 700, "gamma": 0.002, "seed": 7}])
def test_trees_are_those_of_spark(rows, monkeypatch, params):
    a, b = both(rows, monkeypatch, **{"n_estimators": 6, "max_depth": 3, **params})
    (shape_a, numbers_a), (shape_b, numbers_b) = shape(a), shape(b)
    assert shape_a == shape_b and numbers_a == pytest.approx(numbers_b, rel=1e-9, abs=1e-12)
    assert np.allclose(a.stages[-1].featureImportances.toArray(), b.stages[-1].featureImportances.toArray(), rtol=1e-9)
    assert b.stages[-1].extractParamMap().keys() and b.stages[-1].getMaxDepth() == a.stages[-1].getMaxDepth()
    pa, pb = ([r.probability for r in model.predict(m, rows, NUM).collect()] for m in (a, b))
    assert pa == pytest.approx(pb, rel=1e-9)


def test_model_is_saved_and_loaded(rows, monkeypatch, tmp_path):
    _, b = both(rows, monkeypatch, n_estimators=3, max_depth=3)
    b.write().save(str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m"))
    assert shape(again) == shape(b) and again.stages[-1].treeWeights == [1.0, 0.3, 0.3]
    assert model.predict(again, rows.withColumn("c", F.lit("new")).limit(5), ["y"]).count() == 5


def test_nodes_in_parts_and_blocks_give_the_same_trees(rows, monkeypatch):
    _, b = both(rows, monkeypatch, n_estimators=4, max_depth=4)
    monkeypatch.setattr(model, "BINNED_ROWS", 1)
    monkeypatch.setattr(boosted, "SUMS", 1)               # one node a job
    monkeypatch.setattr(boosted, "TASK_ROWS", 1_000)
    monkeypatch.setattr(boosted, "KEEP_EVERY", 2)
    monkeypatch.setattr(boosted_rows, "WIDTH", 1)         # no column shares a code
    c = model.fit_model(rows, NUM, CAT, params={"n_estimators": 4, "max_depth": 4})
    (shape_b, numbers_b), (shape_c, numbers_c) = shape(b), shape(c)
    assert shape_b == shape_c and numbers_b == pytest.approx(numbers_c, rel=1e-9, abs=1e-12)


def test_draws_are_those_of_spark(spark):
    jvm = spark._jvm.org.apache.spark.util.random
    for seed in (43, -5):
        r = jvm.XORShiftRandom(seed)
        want = [r.nextDouble() < 0.3 for _ in range(700)]
        assert boosted_rows.drawn(seed, 0, 700, 0.3).tolist() == want and boosted_rows.drawn(seed, 301, 399, 0.3).tolist() == want[301:]
        assert boosted_rows.xorshift_int(seed) == jvm.XORShiftRandom(seed).nextInt()


def test_labels_other_than_0_and_1_fail(rows, monkeypatch):
    monkeypatch.setattr(model, "BINNED_ROWS", 1)
    for bad in (F.lit(2), F.lit(None).cast("int")):
        with pytest.raises(Exception, match="labels must be 0 or 1"):
            model.fit_model(rows.limit(50).withColumn("converted", bad), NUM, CAT, params={"n_estimators": 1})


def test_all_rows_of_one_class(rows, monkeypatch):
    a, b = both(rows.where("converted = 1").limit(300), monkeypatch, n_estimators=3, max_depth=2)
    assert [r.probability for r in model.predict(b, rows.limit(3), NUM).collect()] == pytest.approx([r.probability for r in model.predict(a, rows.limit(3), NUM).collect()])
