import pandas as pd
import pytest

from helpers import rows
from propensity.operators import clean, profile
from propensity.sources.leads import nan_to_null


@pytest.fixture
def nulls_inf(spark):
    return spark.createDataFrame(
        [(1, 1.0, "7"), (2, None, "x"), (3, float("nan"), "3"), (4, float("inf"), "4"),
         (5, float("-inf"), "5"), (6, 2.5, None)], "id long, v double, t string")


def test_inf_nan_and_coercion(nulls_inf):
    c = clean.coerce_numeric(clean.clean_infinities(nulls_inf), ["t"])
    got = {r.id: (r.v, r.t) for r in c.collect()}
    assert got == {1: (1.0, 7.0), 2: (None, None), 3: (None, 3.0), 4: (None, 4.0),
                   5: (None, 5.0), 6: (2.5, None)}
    assert [r.id for r in clean.drop_incomplete(c).collect()] == [1]


@pytest.fixture
def const_key(spark):
    return spark.createDataFrame(
        [(i, "k", 5.0 if i % 2 else None, None, float(i % 3), f"u{i}") for i in range(6)],
        "id long, const string, const_null double, all_null double, num double, keyish string")


def test_columns_to_drop(const_key):
    got = rows(clean.columns_to_drop(const_key))
    assert got == sorted([("id", "key_like"), ("keyish", "key_like"), ("const", "constant"),
                          ("const_null", "constant"), ("const_null", "zero_variance"),
                          ("all_null", "mostly_missing")])
    assert clean.drop_flagged(const_key).columns == ["num"]


def test_describe_matches_pandas(spark):
    vals = [3.0, 1.0, 4.0, 1.0, 5.0, 9.0, 2.0, 6.0, None]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    d = profile.describe(df, ["x"]).first()
    s = pd.Series(vals, dtype=float).describe()
    assert d["count"] == s["count"]
    for ours, theirs in (("mean", "mean"), ("std", "std"), ("min", "min"), ("q25", "25%"),
                         ("q50", "50%"), ("q75", "75%"), ("max", "max")):
        assert d[ours] == pytest.approx(s[theirs])


def test_spearman_matches_pandas(spark):
    import random
    rnd = random.Random(5)
    data = [(float(rnd.randint(0, 9)), float(rnd.randint(0, 5)), None if i % 7 == 0 else float(i % 4))
            for i in range(200)]
    df = spark.createDataFrame(data, "a double, b double, c double")
    pdf = pd.DataFrame(data, columns=["a", "b", "c"]).astype(float)
    ours = {(r.column_a, r.column_b): r.rho for r in profile.spearman_matrix(df, ["a", "b", "c"]).collect()}
    theirs = pdf.corr(method="spearman")
    for (a, b), v in ours.items():
        assert v == pytest.approx(theirs.loc[a, b], abs=1e-12)


def test_value_counts_keep_null(spark):
    df = spark.createDataFrame([("a",), ("b",), ("a",), (None,)], "c string")
    got = rows(profile.value_counts(df, ["c"]), "value", "n")
    assert got == [(None, 1), ("a", 2), ("b", 1)]
    top = profile.top_values(df, ["c"], k=1).first()
    assert (top.value, top.n) == ("a", 2)


def test_duplicates(spark):
    df = spark.createDataFrame([(1, 1, "x"), (1, 1, "a"), (1, 1, "a"), (2, 1, "z")],
                               "k long, n int, v string")
    assert rows(clean.dedupe_first(df, ["k", "n"])) == [(1, 1, "a"), (2, 1, "z")]
    assert rows(clean.duplicate_rows(df, ["k", "n"])) == [(1, 1, "a"), (1, 1, "x")]
    c = clean.duplicate_count(df, ["k", "n"]).first()
    assert (c.n_rows, c.n_distinct, c.n_duplicates) == (4, 2, 2)


def test_missing_and_nan_normalisation(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,)], "x double")
    m = profile.missing_report(nan_to_null(df)).first()
    assert m.n_missing == 2 and m.pct_missing == pytest.approx(200 / 3)


def test_duplicates_with_null_key(spark):
    df = spark.createDataFrame([(None, "b"), (None, "a"), (1, "x")], "k long, v string")
    assert rows(clean.duplicate_rows(df, ["k"])) == [(None, "b")]
    assert rows(clean.dedupe_first(df, ["k"])) == [(None, "a"), (1, "x")]


def test_column_stats_exact_and_approx(spark):
    df = spark.range(0, 5000).selectExpr("id % 1000 AS k", "cast(id % 7 AS double) AS v")
    ex = {r.column_name: r for r in profile.column_stats(df).collect()}
    ap = {r.column_name: r for r in profile.column_stats(df, approx=True).collect()}
    assert ex["k"].n_distinct == 1000 and ex["v"].n_distinct == 7
    assert abs(ap["k"].n_distinct - 1000) <= 50 and ap["v"].n_distinct == 7
    assert ex["v"].var_samp == pytest.approx(ap["v"].var_samp)
