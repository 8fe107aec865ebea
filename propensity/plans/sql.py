"""Shared SQL text for the independent DuckDB oracle queries.

The oracle is written by hand from the operator's definition (not generated
from the Spark plan), so a match is real evidence of correctness.
"""

LEADS = """
leads AS (
  SELECT o.o_orderkey AS lead_id, o_orderpriority AS lead_origin,
         c_mktsegment AS lead_source, n_name AS city, o_orderstatus AS last_activity,
         l.total_visits, l.time_on_website, l.page_views_per_visit,
         COALESCE(l.conv, 0) AS converted
  FROM orders o
  LEFT JOIN customer c ON o_custkey = c_custkey
  LEFT JOIN nation n ON c_nationkey = n_nationkey
  LEFT JOIN (SELECT l_orderkey, CAST(COUNT(*) AS DOUBLE) AS total_visits,
                    SUM(l_quantity) AS time_on_website,
                    AVG(l_quantity) AS page_views_per_visit,
                    MAX(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS conv
             FROM lineitem GROUP BY l_orderkey) l ON o.o_orderkey = l.l_orderkey
)"""

SCORED = LEADS + """,
scored AS (
  SELECT lead_id, converted AS label,
         ROUND(1.0 / (1.0 + EXP(-(-1.0 + 0.45 * COALESCE(total_visits, 4)
                                  + 0.01 * COALESCE(page_views_per_visit, 25)))), 6) AS score
  FROM leads
)"""

# stratified 70/15/15 split and 5 folds by md5 order inside each class
SPLIT = SCORED + """,
ranked AS (
  SELECT l.*, ROW_NUMBER() OVER (PARTITION BY converted
                                 ORDER BY md5(CAST(lead_id AS VARCHAR) || '|42'), lead_id) AS rn,
         COUNT(*) OVER (PARTITION BY converted) AS class_n
  FROM leads l
),
splits AS (
  SELECT *, CASE WHEN rn * 100 <= 70 * class_n THEN 'train'
                 WHEN rn * 100 <= 85 * class_n THEN 'val' ELSE 'test' END AS split,
            CAST((rn - 1) % 5 AS INTEGER) AS fold
  FROM ranked
)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",".join(ctes)
