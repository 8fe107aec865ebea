"""Order-dependent building blocks that stay parallel at scale.

A window with ``ORDER BY`` and no ``PARTITION BY`` runs in a single task.
Ranks, running totals and quantiles are therefore built in two levels:

* ``running_totals``: rows are cut into value ranges (bucket boundaries from
  ``percentile_approx``), per-bucket totals give exact offsets, and the
  running sum inside each bucket is an ordinary partitioned window.  The
  approximate boundaries only affect load balance, never the result.
* ``global_row_number``: a range-partitioned sort (``orderBy``), then the
  position inside each sorted partition plus the row count of all earlier
  partitions.  The sorted table is reliably checkpointed first so the
  positions cannot change if a task is re-run.

Both need only tiny side tables (one row per bucket or per partition).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir


def _n_buckets(df: DataFrame, n: int | None) -> int:
    if n:
        return max(1, int(n))
    return max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def running_totals(df: DataFrame, order_col: str, sum_cols: Sequence[str],
                   part_cols: Sequence[str] = (), descending: bool = False,
                   n_buckets: int | None = None, with_totals: bool = False,
                   prefix: str = "cum_", materialize: bool = True,
                   parts_bound: int | None = None) -> DataFrame:
    """Inclusive running sums of ``sum_cols`` in ``order_col`` order.

    ``df`` must hold one row per (``part_cols``, ``order_col``) value — group
    first (NULL is a value and comes first).  Adds ``{prefix}{c}`` (and ``total_{c}`` when asked).  Exact.
    ``parts_bound``: a known upper bound on the number of parts (e.g. the
    number of listed columns); without it the parts are counted.

    The input is read three times (bucket bounds, bucket totals, the running
    pass), so it is first checkpointed to the shared checkpoint folder: the
    upstream plan runs once and a lost executor cannot change the result.
    """
    parts = list(part_cols)
    nb = _n_buckets(df, n_buckets)
    key = -F.col(order_col) if descending else F.col(order_col)
    work = df.withColumn("__k", key.cast("double"))
    if materialize:
        ensure_checkpoint_dir(df.sparkSession)
        work = work.checkpoint(eager=True)
    fracs = [i / nb for i in range(1, nb)]
    small = True
    if not fracs:
        work = work.withColumn("__bucket", F.lit(0))
    elif not parts:
        # n-1 approximate bounds (a bounded list); Bucketizer finds each row's
        # bucket by binary search in the JVM.  Any monotone bucketing is exact
        # here: equal keys always share a bucket.
        from pyspark.ml.feature import Bucketizer
        b = work.agg(F.percentile_approx("__k", fracs, 10000).alias("b")).first()["b"] or []
        inner = sorted({float(x) for x in b})
        if inner:
            splits = [float("-inf")] + inner + [float("inf")]
            work = Bucketizer(splits=splits, inputCol="__k", outputCol="__bkt",
                              handleInvalid="keep").transform(work)
            work = work.withColumn("__bucket", F.col("__bkt").cast("int")).drop("__bkt")
        else:                                  # empty input: one bucket
            work = work.withColumn("__bucket", F.lit(0))
    else:
        # one row of bounds per part: an equi-join, with a broadcast hint only where the
        # caller knows the number of parts (one per listed column), else left to the
        # size-checked automatic broadcast; buckets per part
        # shrink so that parts x buckets stays near the partition count
        n_parts = parts_bound if parts_bound is not None else \
            work.select(*parts).distinct().count()
        per = max(2, nb // max(1, n_parts))
        fracs = [i / per for i in range(1, per)]
        small = parts_bound is not None
        bounds = work.groupBy(*parts).agg(F.percentile_approx("__k", fracs, 10000).alias("__b"))
        work = work.join(F.broadcast(bounds) if small else bounds, parts, "left").withColumn(
            "__bucket", F.size(F.filter(F.coalesce(F.col("__b"), F.array().cast("array<double>")),
                                        lambda x: x < F.col("__k")))
        ).drop("__b")
    # NULL order values come first, in a bucket of their own
    work = work.withColumn("__bucket", F.when(F.col("__k").isNull(), F.lit(-1)).otherwise(F.col("__bucket")))
    tot = work.groupBy(*parts, "__bucket").agg(
        *[F.sum(c).alias(f"__t_{c}") for c in sum_cols])
    w_before = (Window.partitionBy(*parts).orderBy("__bucket")
                .rowsBetween(Window.unboundedPreceding, -1))
    offs = [F.coalesce(F.sum(f"__t_{c}").over(w_before), F.lit(0)).alias(f"__o_{c}")
            for c in sum_cols]
    if with_totals:
        w_all = Window.partitionBy(*parts)
        offs += [F.sum(f"__t_{c}").over(w_all).alias(f"total_{c}") for c in sum_cols]
    # at most parts x buckets rows
    off = tot.select(*parts, "__bucket", *offs)
    if not parts or small:
        off = F.broadcast(off)
    out = work.join(off, parts + ["__bucket"], "inner")
    # buckets come from the value as a double; inside one the value itself orders, so
    # long and decimal keys beyond 2^53 stay apart
    exact = F.col(order_col).desc_nulls_first() if descending else F.col(order_col).asc_nulls_first()
    w_in = (Window.partitionBy(*parts, "__bucket").orderBy(exact)
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    for c in sum_cols:
        out = out.withColumn(f"{prefix}{c}", F.col(f"__o_{c}") + F.sum(c).over(w_in))
    drop = ["__k", "__bucket"] + [f"__o_{c}" for c in sum_cols]
    return out.drop(*drop)


def global_row_number(df: DataFrame, order_by: Sequence[Column | str],
                      name: str = "rn") -> DataFrame:
    """1-based row number over a total order, computed without a one-task
    window.  ``order_by`` must be a total order (end it with a key)."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    sorted_ = (df.orderBy(*order_by)
               .withColumn("__pid", F.spark_partition_id())
               .withColumn("__mid", F.monotonically_increasing_id()))
    sorted_ = sorted_.checkpoint(eager=True)
    counts = sorted_.groupBy("__pid").agg(F.count(F.lit(1)).alias("__n"),
                                          F.min("__mid").alias("__m0"))
    w = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offs = counts.select("__pid", "__m0",
                         F.coalesce(F.sum("__n").over(w), F.lit(0)).alias("__off"))
    # one row per partition: a proven size bound for the broadcast
    out = sorted_.join(F.broadcast(offs), "__pid")
    out = out.withColumn(name, (F.col("__off") + F.col("__mid") - F.col("__m0")
                                + F.lit(1)).cast("long"))
    return out.drop("__pid", "__mid", "__m0", "__off")


def global_running_sum(df: DataFrame, order_by: Sequence[Column | str],
                       sum_cols: Sequence[str], prefix: str = "cum_") -> DataFrame:
    """Inclusive running sums over a total order of any sortable key
    (strings included): range-partitioned sort, per-partition totals,
    offsets from a one-row-per-partition table, then a running window
    inside each sorted partition."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    sorted_ = (df.orderBy(*order_by)
               .withColumn("__pid", F.spark_partition_id())
               .withColumn("__mid", F.monotonically_increasing_id())).checkpoint(eager=True)
    tot = sorted_.groupBy("__pid").agg(*[F.sum(c).alias(f"__t_{c}") for c in sum_cols])
    w = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offs = tot.select("__pid", *[F.coalesce(F.sum(f"__t_{c}").over(w), F.lit(0)).alias(f"__o_{c}")
                                 for c in sum_cols])
    out = sorted_.join(F.broadcast(offs), "__pid")    # one row per partition
    w_in = (Window.partitionBy("__pid").orderBy("__mid")
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    for c in sum_cols:
        out = out.withColumn(f"{prefix}{c}", F.col(f"__o_{c}") + F.sum(c).over(w_in))
    return out.drop("__pid", "__mid", *[f"__o_{c}" for c in sum_cols])


def row_number_within(df: DataFrame, part_col: str,
                      order_by: Sequence[Column | str],
                      name: str = "rn") -> DataFrame:
    """Row number restarting for each value of ``part_col``.

    The classic ``row_number() over (partition by part ...)`` puts a whole
    class (half the table for a binary label) into one task.  Here the sort
    is global and the per-class offset comes from a tiny count table.
    """
    ranked = global_row_number(df, [F.col(part_col)] + list(order_by), "__g")
    # class sizes from the checkpointed ranking (the upstream is not re-run)
    counts = ranked.groupBy(part_col).agg(F.count(F.lit(1)).alias("__c"))
    w = Window.orderBy(F.col(part_col).asc_nulls_first()).rowsBetween(
        Window.unboundedPreceding, -1)
    before = counts.select(part_col, F.col("__c").alias("__class_n"),
                           F.coalesce(F.sum("__c").over(w), F.lit(0)).alias("__before"))
    # one row per class: broadcast by its size where that is small
    out = ranked.join(before, ranked[part_col].eqNullSafe(before[part_col]),
                      "inner").drop(before[part_col])
    return out.withColumn(name, F.col("__g") - F.col("__before")).drop(
        "__g", "__before")
