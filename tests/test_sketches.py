"""Mergeable profile rows: merged batches against one pass and against exact numbers."""

import pytest
from pyspark.sql import functions as F

from propensity.operators import profile, sketches


@pytest.fixture(scope="module")
def frame(spark):
    return spark.range(4000).selectExpr(
        "id", "CAST(id % 700 AS DOUBLE) AS v", "IF(id % 9 = 0, NULL, concat('s', id % 37)) AS t",
        "IF(id % 5 = 0, CAST('NaN' AS DOUBLE), id * id * 0.5D) AS w", "CAST(NULL AS DOUBLE) AS nothing")


def test_merged_batches_equal_one_pass(spark, frame, tmp_path):
    path = str(tmp_path / "s")
    for b in range(6):
        sketches.append_batch(spark, path, frame.where((F.col("id") * 7) % 6 == b), f"b{b}")
    sketches.append_batch(spark, path, frame.where((F.col("id") * 7) % 6 == 3), "b3")       # again: replaced, not added
    sketches.append_batch(spark, path, frame.where("id < 0"), "empty")
    merged = {r["column_name"]: r for r in sketches.merged_profile(sketches.read_sketches(spark, path)).collect()}
    once = {r["column_name"]: r for r in sketches.merged_profile(sketches.batch_sketches(frame, "all")).collect()}
    exact = {r["column_name"]: r for r in profile.profile_table(frame.withColumn("w", F.nanvl("w", F.lit(None).cast("double")))).collect()}
    assert set(merged) == set(frame.columns) == set(once)
    for c, r in merged.items():
        for name in ("n_rows", "n_missing", "n_zeros", "min", "max", "data_type", "pct_missing"):
            assert r[name] == once[c][name] == exact[c][name]
        for name in ("mean", "std"):
            assert (r[name] is None) == (exact[c][name] is None) and (r[name] is None or r[name] == pytest.approx(exact[c][name], rel=1e-9))
        assert abs(r["n_distinct"] - exact[c]["n_distinct"]) <= sketches.DISTINCT_ERROR * exact[c]["n_distinct"] + 1
    for c in ("id", "v", "w"):
        values = sorted(r[0] for r in frame.where(f"NOT isnan(CAST({c} AS DOUBLE))").select(c).collect())
        for name, q in (("q25", .25), ("q50", .5), ("q75", .75)):
            x = merged[c][name]
            assert sum(v < x for v in values) / len(values) <= q + sketches.RANK_ERROR
            assert sum(v <= x for v in values) / len(values) >= q - sketches.RANK_ERROR
    assert merged["nothing"]["q50"] is None and merged["t"]["mean"] is None


def test_a_batch_is_one_aggregate(frame):
    plan = sketches.batch_sketches(frame, "x")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Expand" not in plan
