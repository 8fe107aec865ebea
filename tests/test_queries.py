"""Every registered query with an oracle matches DuckDB at sf0.001; every
other query runs.  (The driver runs the same comparison at sf0.01.)"""
import pytest

from helpers import SF_SMALL
from propensity.plans.catalog import oracle_sql, queries
from propensity.plans.check import digest, duck

SLOW = {"sweep", "cross_validate", "validate_model"}


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_oracle_match(spark, con, name):
    sp = queries()[name](spark, SF_SMALL).toPandas()
    od = con.execute(oracle_sql()[name]).fetchdf()
    sc, sn, sh, _ = digest(sp)
    oc, on, oh, _ = digest(od)
    assert (sc, sn) == (oc, on)
    assert sh == oh


@pytest.mark.parametrize("name", sorted(set(queries()) - set(oracle_sql()) - SLOW))
def test_rows_only_queries_run(spark, name):
    assert queries()[name](spark, SF_SMALL).count() > 0


def test_entry_smoke(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.count() > 0
    assert df.columns == ["lead_id", "label", "score", "lead_score", "predicted_label"]
    assert set(e.queries()) >= set(e.oracle_sql())
