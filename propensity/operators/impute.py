"""Imputation.

Statistics are fitted on the training rows only and applied to all rows
with plain column expressions.  Each fit is one aggregate whose result is a
handful of scalars per column.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .ordering import global_running_sum
from .split import unit_hash


def fit_means(train: DataFrame, cols: Sequence[str]) -> dict[str, float | None]:
    """E1 fit: mean of the non-null values of each column (one pass)."""
    if not cols:
        return {}
    row = train.agg(*[F.avg(c).alias(c) for c in cols]).first()
    return {c: row[c] for c in cols}


def fit_modes(train: DataFrame, cols: Sequence[str]) -> dict[str, str | None]:
    """E2 fit: most frequent non-null value, ties -> smallest value.

    All columns in one pass: unpivot, count per (column, value) with
    map-side combining, then keep the top row per column (a window over
    distinct values only).
    """
    if not cols:
        return {}
    structs = [F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value"))
               for c in cols]
    lv = train.select(F.inline(F.array(*structs))).where(F.col("value").isNotNull())
    vc = lv.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("column_name").orderBy(F.col("n").desc(), F.col("value").asc())
    top = vc.withColumn("r", F.row_number().over(w)).where("r = 1").collect()
    found = {r["column_name"]: r["value"] for r in top}
    return {c: found.get(c) for c in cols}


def fill(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Apply fitted fill values (NULL cells only; other columns untouched)."""
    return df.select(*[
        F.coalesce(F.col(c), F.lit(values[c]).cast(df.schema[c].dataType)).alias(c)
        if c in values and values[c] is not None else F.col(c) for c in df.columns])


def impute_mean_mode(df: DataFrame, train: DataFrame, num_cols: Sequence[str],
                     cat_cols: Sequence[str]) -> DataFrame:
    """E1 + E2: train means for numbers, train modes for strings."""
    vals: dict[str, object] = {}
    vals.update(fit_means(train, num_cols))
    vals.update(fit_modes(train, cat_cols))
    return fill(df, vals)


def impute_constant(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """NULL -> constant (e.g. 'Others') per column."""
    return fill(df, values)


def category_bins(train: DataFrame, col: str) -> DataFrame:
    """M7 fit: each non-null level with its [lo, hi) slice of [0,1), slices
    proportional to frequency and laid out in level order.  Bounds are
    integer running counts divided by the total, so they are exact."""
    vc = train.where(F.col(col).isNotNull()).groupBy(F.col(col).alias("level")).agg(
        F.count(F.lit(1)).alias("n"))
    c = global_running_sum(vc, ["level"], ["n"])
    total = c.agg(F.sum("n")).first()[0] or 0         # one scalar
    t = F.lit(float(total))
    return c.select("level", ((F.col("cum_n") - F.col("n")) / t).alias("lo"),
                    (F.col("cum_n") / t).alias("hi"))


def impute_probabilistic(df: DataFrame, train: DataFrame, col: str, key: str,
                         seed: int = 42, grid: int = 1024) -> DataFrame:
    """Fill each NULL with a level drawn in proportion to its train
    frequency.  The draw u = md5(key|column|seed) is fixed per row.

    Range join ``lo <= u < hi`` made an equi-join: every level is listed on
    each of the ``grid`` equal-width cells it overlaps (at most levels+grid
    rows), rows join on their cell, and the exact range test runs after.
    One pass over ``df``: a row that has a value gets a cell below zero, which
    matches nothing and is spread like the others, so plans do not grow when
    several columns are filled one after another.
    """
    bins = category_bins(train, col)
    cells = bins.select("level", "lo", "hi", F.explode(F.sequence(
        F.floor(F.col("lo") * grid).cast("int"),
        F.least(F.floor(F.col("hi") * grid).cast("int"), F.lit(grid - 1)))).alias("cell"))
    u = unit_hash(F.col(key), F.lit(col), F.lit(seed))
    cell = F.floor(F.col("__u") * grid).cast("int")
    rows = df.withColumn("__u", u).withColumn("__cell", F.when(F.col(col).isNull(), cell).otherwise(-1 - cell))
    # left join: a row keeps NULL when there is no level to draw from
    cond = ((rows["__cell"] == cells["cell"]) & (rows["__u"] >= cells["lo"])
            & (rows["__u"] < cells["hi"]))
    return rows.join(cells, cond, "left").select(
        *[F.coalesce(rows[c], F.col("level")).alias(c) if c == col else rows[c] for c in df.columns])


def impute_iterative(df: DataFrame, cols: Sequence[str], max_iter: int = 10,
                     tol: float = 1e-3) -> DataFrame:
    """Round-robin regression imputation of numeric columns.

    Start from the column means; then, column by column (fewest missing
    first), fit ``LinearRegression`` of the column on the others using the
    originally observed rows and overwrite only the originally missing cells.
    Stop after ``max_iter`` rounds, or earlier when the largest per-row sum of
    absolute changes falls below ``tol`` times the largest observed |value|.
    Each round ends with a reliable checkpoint so lineage stays short.
    """
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression

    from ..session import ensure_checkpoint_dir
    ensure_checkpoint_dir(df.sparkSession)
    cols = list(cols)
    stats = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols],
                   F.greatest(*[F.max(F.abs(F.col(c))) for c in cols]).alias("__maxabs")).first()
    order = [c for c in sorted(cols, key=lambda c: (stats[c], cols.index(c))) if stats[c] > 0]
    limit = tol * float(stats["__maxabs"] or 0.0)
    means = fit_means(df, cols)
    cur = df
    for c in cols:
        cur = cur.withColumn(f"__m_{c}", F.col(c).isNull())
    cur = fill(cur, means).checkpoint(eager=True)
    for _ in range(max_iter if order else 0):
        cur = cur.withColumns({f"__prev_{c}": F.col(c) for c in order})
        for c in order:
            others = [o for o in cols if o != c]
            va = VectorAssembler(inputCols=others, outputCol="__x")
            obs = va.transform(cur.where(~F.col(f"__m_{c}")))
            lr = LinearRegression(featuresCol="__x", labelCol=c, predictionCol="__p",
                                  regParam=1e-6)
            model = lr.fit(obs)
            cur = model.transform(va.transform(cur)).withColumn(
                c, F.when(F.col(f"__m_{c}"), F.col("__p")).otherwise(F.col(c))
            ).drop("__x", "__p")
        cur = cur.checkpoint(eager=True)
        change = cur.agg(F.max(sum(F.abs(F.col(c) - F.col(f"__prev_{c}")) for c in order))
                         ).first()[0] or 0.0
        cur = cur.drop(*[f"__prev_{c}" for c in order])
        if change < limit:
            break
    return cur.drop(*[f"__m_{c}" for c in cols])
