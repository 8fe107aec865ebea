"""Plan audit: build every registered query and inspect its physical plan.

Reports, per query, the number of shuffles, broadcasts and single-partition
exchanges, and flags cartesian / nested-loop joins.  In this library a
single-partition exchange only ever receives partial aggregates (one row
per task) or a bounded side table (threshold grid, bucket offsets,
per-partition offsets, class counts); ``tests/test_plans.py`` keeps that so.

    python -m propensity.plans.plan_audit [--sf DIR] [name ...]
"""

from __future__ import annotations

import argparse
import sys

BAD_JOINS = ("CartesianProduct", "BroadcastNestedLoopJoin")


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def audit(df) -> dict:
    txt = plan_text(df)
    return {
        "exchanges": txt.count("Exchange hashpartitioning") + txt.count("Exchange rangepartitioning")
        + txt.count("Exchange SinglePartition") + txt.count("Exchange RoundRobinPartitioning"),
        "broadcasts": txt.count("BroadcastExchange"),
        "bad_joins": [j for j in BAD_JOINS if j in txt],
        "single_partition_exchanges": txt.count("Exchange SinglePartition"),
    }


def main(argv=None) -> int:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("names", nargs="*")
    a = ap.parse_args(argv)
    sys.path.insert(0, ".")
    from propensity.plans.catalog import queries
    from propensity.session import local_session
    spark = local_session()
    qs = queries()
    bad = 0
    for n in a.names or sorted(qs):
        r = audit(qs[n](spark, a.sf))
        flag = "BAD " if r["bad_joins"] else "    "
        bad += bool(r["bad_joins"])
        print(f"{flag}{n:28s} shuffles={r['exchanges']:3d} broadcasts={r['broadcasts']:2d} "
              f"single-partition={r['single_partition_exchanges']} {r['bad_joins'] or ''}")
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main())
