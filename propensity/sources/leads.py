"""The ``leads`` feature table built from the driver's TPC-H-like tables, and
the fixed-weight scored-leads table used by every metric/curve query.

Join plan: the line-item rollup and ``orders`` are both keyed by order key,
so the rollup's hash partitioning is reused by the first join; ``customer``
is a shuffled join on the customer key (it grows with the scale factor);
``nation`` is a fixed 25-row dimension that Spark's size-checked automatic
broadcast handles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .readers import read_table

NUMERIC_FEATURES = ["total_visits", "time_on_website", "page_views_per_visit"]
CATEGORICAL_FEATURES = ["lead_origin", "lead_source", "city", "last_activity"]
LABEL = "converted"
KEY = "lead_id"

# Fixed score weights (the oracle queries use the same text).
SCORE_BIAS = -1.0
SCORE_W_VISITS = 0.45
SCORE_W_PAGES = 0.01
SCORE_FILL_VISITS = 4.0
SCORE_FILL_PAGES = 25.0


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN and NULL are one missing value; normalise NaN to NULL."""
    exprs = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            exprs.append(F.when(F.isnan(f.name), None).otherwise(
                F.col(f.name)).alias(f.name))
        else:
            exprs.append(F.col(f.name))
    return df.select(*exprs)


def order_rollup(lineitem: DataFrame) -> DataFrame:
    """Per-order visit features; partial aggregation happens map-side."""
    return lineitem.groupBy("l_orderkey").agg(
        F.count(F.lit(1)).cast("double").alias("total_visits"),
        F.sum("l_quantity").alias("time_on_website"),
        F.avg("l_quantity").alias("page_views_per_visit"),
        F.max(F.when(F.col("l_returnflag") == "R", 1).otherwise(0)).alias("conv"),
    )


def leads(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus")
    customer = read_table(spark, sf_dir, "customer").select(
        "c_custkey", "c_nationkey", "c_mktsegment")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    roll = order_rollup(read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_quantity", "l_returnflag"))
    j = (orders
         .join(roll, orders.o_orderkey == roll.l_orderkey, "left")
         .join(customer, orders.o_custkey == customer.c_custkey, "left")
         .join(nation, F.col("c_nationkey") == nation.n_nationkey, "left"))
    return nan_to_null(j.select(
        F.col("o_orderkey").alias(KEY),
        F.col("o_orderpriority").alias("lead_origin"),
        F.col("c_mktsegment").alias("lead_source"),
        F.col("n_name").alias("city"),
        F.col("o_orderstatus").alias("last_activity"),
        "total_visits", "time_on_website", "page_views_per_visit",
        F.coalesce(F.col("conv"), F.lit(0)).alias(LABEL),
    ))


def fixed_score(visits: Column | str = "total_visits",
                pages: Column | str = "page_views_per_visit") -> Column:
    """Logistic link of a fixed linear score, rounded to 6 places."""
    v = F.col(visits) if isinstance(visits, str) else visits
    p = F.col(pages) if isinstance(pages, str) else pages
    z = (F.lit(SCORE_BIAS)
         + F.lit(SCORE_W_VISITS) * F.coalesce(v, F.lit(SCORE_FILL_VISITS))
         + F.lit(SCORE_W_PAGES) * F.coalesce(p, F.lit(SCORE_FILL_PAGES)))
    return F.round(F.lit(1.0) / (F.lit(1.0) + F.exp(-z)), 6)


def scored_leads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(lead_id, label, score) — the input of every metric/curve operator."""
    return leads(spark, sf_dir).select(
        KEY, F.col(LABEL).alias("label"), fixed_score().alias("score"))
