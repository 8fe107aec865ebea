"""A1 A2 A6 A10 A12 kept up to date by batches: one row of mergeable statistics per batch and column.

A batch is profiled once, in one aggregate over its rows; its row of counts, moments, extremes, a
HyperLogLog sketch (distinct values) and a KLL sketch (quantiles) is appended to a table.  A profile of any set
of batches is read from that table alone: no earlier row of data is read again.

Counts, extremes, mean and deviation of merged batches are those of one pass.  Distinct counts are within about
3 standard errors of ``1.04 / sqrt(2**LG_K)``, quantiles within about ``2.3 / KLL_K**0.9`` of their rank.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .profile import _is_numeric, _long

LG_K, KLL_K = 14, 400
#: Bounds stated for the estimates: relative for distinct counts (3 standard errors), in rank for quantiles.
DISTINCT_ERROR = 3 * 1.04 / 2 ** (LG_K / 2)
RANK_ERROR = 0.012
SCHEMA = ("batch string, column_name string, data_type string, n_rows long, n_missing long, n_zeros long, n long, mean double, m2 double, "
          "min double, max double, distinct_sketch binary, quantile_sketch binary")


def batch_sketches(df: DataFrame, batch: str, cols: Sequence[str] | None = None) -> DataFrame:
    """One row per column of a batch (SCHEMA), from one aggregate.  NaN counts as missing; moments, extremes and the
    quantile sketch are NULL for columns that hold no numbers."""
    cols = list(cols or df.columns)
    aggs, nothing = [F.count(F.lit(1)).alias("__n")], F.lit(None)
    for c in cols:
        num = _is_numeric(df, c)
        v = F.nanvl(F.col(c).cast("double"), nothing.cast("double")) if num else F.col(c)
        text = v.cast("string")
        aggs += [F.count(v).alias(f"n_{c}"), F.hll_sketch_agg(text, LG_K).alias(f"h_{c}")]
        aggs += [F.count_if(v == 0).alias(f"z_{c}"), F.avg(v).alias(f"a_{c}"), (F.var_pop(v) * F.count(v)).alias(f"v_{c}"), F.min(v).alias(f"lo_{c}"),
                 F.max(v).alias(f"hi_{c}"), F.kll_sketch_agg_double(v, KLL_K).alias(f"q_{c}")] if num else []
    row = df.agg(*aggs)

    def of(c: str, name: str, kind: str):
        return F.col(f"{name}_{c}") if f"{name}_{c}" in row.columns else nothing.cast(kind)

    return _long(row, [F.struct(
        F.lit(batch).alias("batch"), F.lit(c).alias("column_name"), F.lit(df.schema[c].dataType.simpleString()).alias("data_type"),
        F.col("__n").alias("n_rows"), (F.col("__n") - F.col(f"n_{c}")).alias("n_missing"), of(c, "z", "long").alias("n_zeros"),
        F.col(f"n_{c}").alias("n"), of(c, "a", "double").alias("mean"), of(c, "v", "double").alias("m2"), of(c, "lo", "double").alias("min"),
        of(c, "hi", "double").alias("max"), F.col(f"h_{c}").alias("distinct_sketch"), of(c, "q", "binary").alias("quantile_sketch")) for c in cols])


def append_batch(spark: SparkSession, path: str, df: DataFrame, batch: str, cols: Sequence[str] | None = None) -> None:
    """Profiles a batch and keeps its rows under ``path``; the same batch again replaces its own rows only."""
    batch_sketches(df, batch, cols).drop("batch").coalesce(1).write.mode("overwrite").parquet(f"{path}/batch={batch}")


def read_sketches(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCHEMA).option("basePath", path).parquet(f"{path}/batch=*")


def merged_profile(sketches: DataFrame, quantiles: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """One profile row per column over all batches of ``sketches``; with no rows at all an empty profile."""
    m = sketches.groupBy("column_name").agg(
        F.first("data_type").alias("data_type"), F.sum("n_rows").alias("n_rows"), F.sum("n_missing").alias("n_missing"), F.sum("n_zeros").alias("n_zeros"),
        F.sum("n").alias("n"), (F.sum(F.col("mean") * F.col("n")) / F.sum(F.when(F.col("mean").isNotNull(), F.col("n")))).alias("mean"),
        F.min("min").alias("min"), F.max("max").alias("max"),
        F.hll_sketch_estimate(F.hll_union_agg("distinct_sketch")).alias("n_distinct"),
        F.collect_list(F.struct("n", "mean", "m2")).alias("parts"),           # one short struct per batch
        F.kll_merge_agg_double("quantile_sketch").alias("sketch"))
    apart = F.aggregate("parts", F.lit(0.0), lambda s, b: s + F.coalesce(b["m2"] + b["n"] * (b["mean"] - F.col("mean")) * (b["mean"] - F.col("mean")), F.lit(0.0)))
    valued = F.col("mean").isNotNull()
    q = [F.when(valued, F.kll_sketch_get_quantile_double("sketch", F.lit(float(x)))).alias(f"q{round(x * 100):02d}") for x in quantiles]
    return m.select("column_name", "data_type", "n_rows", "n_missing", F.try_divide(F.col("n_missing") * 100.0, F.col("n_rows")).alias("pct_missing"),
                    "n_distinct", "n_zeros", "mean", F.when(valued & (F.col("n") > 1), F.sqrt(apart / (F.col("n") - 1))).alias("std"), "min", "max", *q)
