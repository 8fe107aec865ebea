"""Physical-plan guards: no cartesian or nested-loop joins in any SQL-checked
query; row-level work never funnels through one partition."""
import pytest

from helpers import SF_SMALL
from propensity.plans.catalog import oracle_sql, queries
from propensity.plans.plan_audit import audit, plan_text

NAMES = sorted(oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_no_cartesian_joins(spark, name):
    r = audit(queries()[name](spark, SF_SMALL))
    assert r["bad_joins"] == []


def test_leads_scan_prunes_columns(spark):
    txt = plan_text(queries()["threshold_sweep_101"](spark, SF_SMALL))
    # the score needs neither the priority nor the status: they are not read
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>" in txt
    assert "o_orderpriority" not in txt
