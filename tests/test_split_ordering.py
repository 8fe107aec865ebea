import pytest
from pyspark.sql import functions as F

from helpers import SF_MID
from propensity.operators import split
from propensity.operators.ordering import global_row_number, running_totals
from propensity.sources.leads import leads


def test_running_totals_exact_any_bucket_count(spark):
    import random
    rnd = random.Random(3)
    data = [(rnd.choice("ab"), float(v), rnd.randint(1, 5)) for v in rnd.sample(range(10000), 500)]
    df = spark.createDataFrame(data, "g string, v double, c int")
    expect = {}
    for g in "ab":
        acc = 0
        for _, v, c in sorted(x for x in data if x[0] == g):
            acc += c
            expect[(g, v)] = acc
    for nb in (1, 2, 7, 64):
        got = {(r.g, r.v): r.cum_c for r in
               running_totals(df, "v", ["c"], ["g"], n_buckets=nb).collect()}
        assert got == expect


def test_global_row_number_skewed(spark):
    # one score value holds half of the rows: the sort still splits it
    df = spark.range(0, 3000).select(
        "id", F.when(F.col("id") % 2 == 0, F.lit(0.5)).otherwise(F.rand(1)).alias("s"))
    r = global_row_number(df.repartition(6), [F.col("s").desc(), "id"]).collect()
    ranks = sorted(x.rn for x in r)
    assert ranks == list(range(1, 3001))
    ordered = sorted(r, key=lambda x: (-x.s, x.id))
    assert [x.rn for x in ordered] == list(range(1, 3001))


@pytest.fixture(scope="module")
def tagged(spark):
    d = leads(spark, SF_MID).select("lead_id", "converted")
    return split.split_and_folds(d, "converted", "lead_id", k=5).toPandas()


def test_split_sizes_exact_and_disjoint(tagged):
    assert tagged.lead_id.is_unique
    for cls, g in tagged.groupby("converted"):
        n = len(g)
        n_train = (g.split == "train").sum()
        n_val = (g.split == "val").sum()
        assert n_train == (70 * n) // 100
        assert n_train + n_val == (85 * n) // 100


def test_fold_balance(tagged):
    for cls, g in tagged.groupby("converted"):
        sizes = g.fold.value_counts()
        assert sizes.max() - sizes.min() <= 1 and len(sizes) == 5


def test_split_independent_of_partitioning(spark, tagged):
    d = leads(spark, SF_MID).select("lead_id", "converted").repartition(13, "lead_id")
    again = split.stratified_split(d, "converted", "lead_id").toPandas()
    m = tagged.merge(again, on="lead_id", suffixes=("", "_b"))
    assert len(m) == len(tagged) and (m.split == m.split_b).all()


def test_split_keeps_null_and_repeated_keys(spark):
    data = [(None if i % 4 == 0 else f"k{i // 3}", None if i % 7 == 0 else i % 2, i) for i in range(400)]
    df = spark.createDataFrame(data, "key string, label int, v int")
    got = split.split_and_folds(df, "label", "key", k=5).toPandas()
    assert sorted(got.v) == list(range(400))
    for cls in (None, 0, 1):
        g = got[got.label.isna() if cls is None else got.label == cls]
        n = sum(r[1] == cls for r in data)
        assert len(g) == n and (g.split == "train").sum() == 70 * n // 100
        assert (g.split != "test").sum() == 85 * n // 100
        sizes = g.fold.value_counts()
        assert len(sizes) == 5 and sizes.max() - sizes.min() <= 1
    again = split.split_and_folds(df.repartition(7, "v"), "label", "key", k=5).toPandas()
    m = got.merge(again, on="v", suffixes=("", "_b"))
    assert len(m) == 400 and (m.split == m.split_b).all() and (m.fold == m.fold_b).all()
