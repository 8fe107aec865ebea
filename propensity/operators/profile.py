"""Column profiling.

Wide statistics are one aggregate over the table (a single scan, partial
aggregation per task) whose one-row result is turned into a long
``(column_name, ...)`` table with ``inline``.  Exact quantiles and ranks
use ``running_totals`` over distinct values instead of collecting a whole
column into one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .ordering import running_totals

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
           T.DoubleType, T.DecimalType)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC)]


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def _is_numeric(df: DataFrame, c: str) -> bool:
    return isinstance(df.schema[c].dataType, NUMERIC)


def _long(row_df: DataFrame, structs: list[Column]) -> DataFrame:
    """Turn a one-row wide aggregate into a long table."""
    return row_df.select(F.inline(F.array(*structs)))


def long_values(df: DataFrame, cols: Sequence[str], as_type: str = "string",
                keep_null: bool = True, ids: Sequence[str] = ()) -> DataFrame:
    """Unpivot ``cols`` into (ids..., column_name, value)."""
    structs = [F.struct(*[F.col(i) for i in ids], F.lit(c).alias("column_name"),
                        F.col(c).cast(as_type).alias("value")) for c in cols]
    out = df.select(F.inline(F.array(*structs)))
    return out if keep_null else out.where(F.col("value").isNotNull())


def column_stats(df: DataFrame, cols: Sequence[str] | None = None,
                 approx: bool = False, rsd: float = 0.01) -> DataFrame:
    """A1/A2: distinct non-null count per column and sample variance of
    numeric columns (NULL for others), from one aggregate.  ``approx=True``
    uses HyperLogLog++ (``approx_count_distinct``, relative error ``rsd``):
    one pass with fixed memory per column instead of the exact distinct's
    extra shuffle of (column, value) pairs."""
    cols = list(cols or df.columns)
    aggs = []
    for c in cols:
        aggs.append((F.approx_count_distinct(c, rsd) if approx else F.count_distinct(c))
                    .alias(f"d_{c}"))
        aggs.append(F.var_samp(c).alias(f"v_{c}") if _is_numeric(df, c)
                    else F.lit(None).cast("double").alias(f"v_{c}"))
    row = df.agg(*aggs)
    return _long(row, [F.struct(F.lit(c).alias("column_name"),
                                F.col(f"d_{c}").alias("n_distinct"),
                                F.col(f"v_{c}").alias("var_samp")) for c in cols])


def missing_report(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """A3: missing count and percent per column."""
    cols = list(cols or df.columns)
    row = df.agg(F.count(F.lit(1)).alias("__n"),
                 *[F.count_if(F.col(c).isNull()).alias(f"m_{c}") for c in cols])
    return _long(row, [F.struct(
        F.lit(c).alias("column_name"), F.col(f"m_{c}").alias("n_missing"),
        F.try_divide(F.col(f"m_{c}") * 100.0, F.col("__n")).alias("pct_missing"))
        for c in cols])


def value_counts(df: DataFrame, cols: Sequence[str], dropna: bool = False) -> DataFrame:
    """Counts per value (NULL bucket kept unless ``dropna``) and the
    share of all rows.  One scan and one aggregate for all columns."""
    lv = long_values(df, cols, keep_null=not dropna)
    vc = lv.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))
    # per-column totals: one row per column, joined back (no window that
    # would put every distinct value of a column into one task)
    tot = vc.groupBy("column_name").agg(F.sum("n").alias("__tot"))
    # exactly one row per listed column: a structural bound for the broadcast
    return vc.join(F.broadcast(tot), "column_name").select(
        "column_name", "value", "n", (F.col("n") / F.col("__tot")).alias("share"))


def top_values(df: DataFrame, cols: Sequence[str], k: int = 7,
               dropna: bool = False) -> DataFrame:
    """A4 top-k: most frequent values per column, ties by value."""
    vc = value_counts(df, cols, dropna)
    w = Window.partitionBy("column_name").orderBy(
        F.col("n").desc(), F.col("value").asc_nulls_first())
    return vc.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def distinct_values(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """A5: distinct values (NULL included) per column."""
    return long_values(df, cols).distinct()


def exact_quantiles(df: DataFrame, cols: Sequence[str],
                    probs: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """Exact quantiles with linear interpolation at position p*(n-1).

    Distinct values per column are counted (partial aggregation), running
    counts come from ``running_totals``, and each quantile picks the values
    at positions floor(p*(n-1)) and the next one.  Output:
    (column_name, prob, quantile).
    """
    lv = long_values(df, cols, as_type="double", keep_null=False)
    cnt = lv.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("cnt"))
    rt = running_totals(cnt, "value", ["cnt"], part_cols=["column_name"],
                        with_totals=True, parts_bound=len(cols))
    p = F.explode(F.array(*[F.lit(float(q)) for q in probs])).alias("prob")
    x = rt.select("column_name", "value", "cnt", "cum_cnt", "total_cnt", p)
    pos = F.col("prob") * (F.col("total_cnt") - 1).cast("double")
    lo = F.floor(pos).cast("long")
    hi = F.least(lo + 1, F.col("total_cnt") - 1)
    before = F.col("cum_cnt") - F.col("cnt")
    x = x.select("column_name", "prob", "value", (pos - lo).alias("frac"),
                 ((before <= lo) & (lo < F.col("cum_cnt"))).alias("is_lo"),
                 ((before <= hi) & (hi < F.col("cum_cnt"))).alias("is_hi"))
    x = x.where(F.col("is_lo") | F.col("is_hi"))
    q = x.groupBy("column_name", "prob").agg(
        F.max(F.when(F.col("is_lo"), F.col("value"))).alias("v_lo"),
        F.max(F.when(F.col("is_hi"), F.col("value"))).alias("v_hi"),
        F.max("frac").alias("frac"))
    return q.select("column_name", "prob", (F.col("v_lo") + (F.col("v_hi") - F.col("v_lo"))
                                            * F.col("frac")).alias("quantile"))


def approx_quantiles(df: DataFrame, cols: Sequence[str],
                     probs: Sequence[float] = (0.25, 0.5, 0.75),
                     accuracy: int = 10000) -> DataFrame:
    """Opt-in approximate quantiles (one pass, bounded memory per task);
    same (column_name, prob, quantile) shape as ``exact_quantiles``."""
    row = df.agg(*[F.percentile_approx(F.col(c).cast("double"), list(probs), accuracy)
                   .alias(c) for c in cols])
    structs = [F.struct(F.lit(c).alias("column_name"), F.lit(float(p)).alias("prob"),
                        F.col(c)[i].alias("quantile"))
               for c in cols for i, p in enumerate(probs)]
    return _long(row, structs)


def describe(df: DataFrame, cols: Sequence[str] | None = None,
             exact: bool = True) -> DataFrame:
    """Count, mean, std (ddof 1), min, quartiles, max per column.
    Quartiles are exact (linear interpolation) unless ``exact=False``."""
    cols = list(cols or numeric_columns(df))
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"n_{c}"), F.avg(x).alias(f"a_{c}"),
                 F.stddev_samp(x).alias(f"s_{c}"), F.min(x).alias(f"lo_{c}"),
                 F.max(x).alias(f"hi_{c}")]
    base = _long(df.agg(*aggs), [F.struct(
        F.lit(c).alias("column_name"), F.col(f"n_{c}").alias("count"),
        F.col(f"a_{c}").alias("mean"), F.col(f"s_{c}").alias("std"),
        F.col(f"lo_{c}").alias("min"), F.col(f"hi_{c}").alias("max")) for c in cols])
    quant = exact_quantiles(df, cols) if exact else approx_quantiles(df, cols)
    q = quant.groupBy("column_name").agg(
        F.max(F.when(F.col("prob") == 0.25, F.col("quantile"))).alias("q25"),
        F.max(F.when(F.col("prob") == 0.5, F.col("quantile"))).alias("q50"),
        F.max(F.when(F.col("prob") == 0.75, F.col("quantile"))).alias("q75"))
    return base.join(q, "column_name", "left").select(
        "column_name", "count", "mean", "std", "min", "q25", "q50", "q75", "max")


def box_summary(df: DataFrame, cols: Sequence[str] | None = None,
                whisker: float = 1.5) -> DataFrame:
    """A10: quartiles, 1.5*IQR fences, whisker ends and outlier count."""
    cols = list(cols or numeric_columns(df))
    q = exact_quantiles(df, cols, (0.25, 0.5, 0.75)).groupBy("column_name").agg(
        F.max(F.when(F.col("prob") == 0.25, F.col("quantile"))).alias("q1"),
        F.max(F.when(F.col("prob") == 0.5, F.col("quantile"))).alias("median"),
        F.max(F.when(F.col("prob") == 0.75, F.col("quantile"))).alias("q3"))
    iqr = F.col("q3") - F.col("q1")
    q = q.select("column_name", "q1", "median", "q3", iqr.alias("iqr"),
                 (F.col("q1") - whisker * iqr).alias("lower_fence"),
                 (F.col("q3") + whisker * iqr).alias("upper_fence"))
    lv = long_values(df, cols, as_type="double", keep_null=False)
    j = lv.join(F.broadcast(q), "column_name")        # one row per listed column
    v = F.col("value")
    inside = (v >= F.col("lower_fence")) & (v <= F.col("upper_fence"))
    s = j.groupBy("column_name").agg(
        F.min(F.when(inside, v)).alias("whisker_low"),
        F.max(F.when(inside, v)).alias("whisker_high"),
        F.count_if(~inside).alias("n_outliers"))
    return q.join(s, "column_name", "left")


def two_way_counts(df: DataFrame, x: str, by: str, levels: Sequence[str]) -> DataFrame:
    """Counts of ``x`` values per level of ``by`` (wide, fixed level
    order, zero where a pair does not occur)."""
    return (df.groupBy(x).pivot(by, list(levels)).agg(F.count(F.lit(1)))
            .na.fill(0, list(levels)))


def average_ranks(values: DataFrame, col: str, weight: str = "c") -> DataFrame:
    """Average rank (ties share the mean position) of each distinct value.

    ``values`` holds one row per distinct ``col`` with its multiplicity.
    """
    rt = running_totals(values, col, [weight], with_totals=True)
    return rt.select(col, (F.col(f"cum_{weight}") - F.col(weight)
                           + (F.col(weight) + 1) / 2.0).alias("rank"),
                     F.col(f"total_{weight}").alias("n"))


def spearman_pair(df: DataFrame, a: str, b: str) -> DataFrame:
    """A9 for one pair on pairwise-complete rows: Pearson correlation of
    average ranks, from sums centred on the exact mean rank (n+1)/2."""
    pairs = (df.select(F.col(a).cast("double").alias("x"), F.col(b).cast("double").alias("y"))
             .na.drop().groupBy("x", "y").agg(F.count(F.lit(1)).alias("c")))
    rx = average_ranks(pairs.groupBy("x").agg(F.sum("c").alias("c")), "x")
    ry = average_ranks(pairs.groupBy("y").agg(F.sum("c").alias("c")), "y").drop("n")
    j = pairs.join(rx, "x").join(ry.withColumnRenamed("rank", "ry"), "y")
    m = (F.col("n") + 1) / 2.0
    dx, dy = F.col("rank") - m, F.col("ry") - m
    s = j.agg(F.sum(F.col("c") * dx * dy).alias("sxy"),
              F.sum(F.col("c") * dx * dx).alias("sxx"),
              F.sum(F.col("c") * dy * dy).alias("syy"))
    return s.select(F.lit(a).alias("column_a"), F.lit(b).alias("column_b"),
                    F.try_divide(F.col("sxy"), F.sqrt(F.col("sxx") * F.col("syy"))).alias("rho"))


def spearman_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Full matrix in long form (both orders and the diagonal), on
    pairwise-complete rows like pandas.

    One aggregate counts the complete rows of every pair and of all columns
    together.  Pairs whose complete rows are exactly the all-complete rows
    (equal counts, subset relation) share one rank pass: distinct complete
    tuples are counted, each column's average ranks are joined on once, and
    one aggregate gives every pair's centred sums.  Other pairs are computed
    one by one with ``spearman_pair``.
    """
    cols = list(cols)
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    x = df.select(*[F.col(c).cast("double").alias(c) for c in cols])
    all_ok = F.lit(True)
    for c in cols:
        all_ok = all_ok & F.col(c).isNotNull()
    cnt = x.agg(F.count_if(all_ok).alias("__all"),
                *[F.count_if(F.col(a).isNotNull() & F.col(b).isNotNull()).alias(f"__pair_{a}__{b}")
                  for a, b in pairs]).first()
    shared = [(a, b) for a, b in pairs if cnt[f"__pair_{a}__{b}"] == cnt["__all"]]
    parts = [spearman_pair(df, a, b) for a, b in pairs if (a, b) not in shared]
    if shared:
        used = sorted({c for p in shared for c in p}, key=cols.index)
        tup = x.where(all_ok).groupBy(*used).agg(F.count(F.lit(1)).alias("__w"))
        j = tup
        for c in used:
            r = average_ranks(tup.groupBy(c).agg(F.sum("__w").alias("__w")), c, weight="__w")
            j = j.join(r.select(c, F.col("rank").alias(f"__r_{c}"),
                                F.col("n").alias(f"__n_{c}")), c)
        n = F.col(f"__n_{used[0]}")
        m = (n + 1) / 2.0
        d = {c: F.col(f"__r_{c}") - m for c in used}
        aggs = [F.sum(F.col("__w") * d[c] * d[c]).alias(f"__ss_{c}") for c in used]
        aggs += [F.sum(F.col("__w") * d[a] * d[b]).alias(f"__sp_{a}__{b}") for a, b in shared]
        sums = j.agg(*aggs)
        parts.append(_long(sums, [F.struct(
            F.lit(a).alias("column_a"), F.lit(b).alias("column_b"),
            F.try_divide(F.col(f"__sp_{a}__{b}"),
                         F.sqrt(F.col(f"__ss_{a}") * F.col(f"__ss_{b}"))).alias("rho"))
            for a, b in shared]))
    sym = []
    for p in parts:
        sym.append(p)
        sym.append(p.select(F.col("column_b").alias("column_a"),
                            F.col("column_a").alias("column_b"), "rho"))
    diag = df.agg(*[F.count_distinct(c).alias(c) for c in cols])
    sym.append(_long(diag, [F.struct(
        F.lit(c).alias("column_a"), F.lit(c).alias("column_b"),
        F.when(F.col(c) > 1, F.lit(1.0)).cast("double").alias("rho")) for c in cols]))
    out = sym[0]
    for p in sym[1:]:
        out = out.unionByName(p)
    return out


def profile_table(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """One long profile row per column from one aggregate."""
    cols = list(cols or df.columns)
    aggs = [F.count(F.lit(1)).alias("__n")]
    for c in cols:
        num = _is_numeric(df, c)
        x = F.col(c).cast("double") if num else None
        aggs += [F.count_if(F.col(c).isNull()).alias(f"m_{c}"),
                 F.count_distinct(c).alias(f"d_{c}"),
                 (F.count_if(x == 0).cast("double") if num else F.lit(None).cast("double")).alias(f"z_{c}"),
                 (F.avg(x) if num else F.lit(None).cast("double")).alias(f"a_{c}"),
                 (F.stddev_samp(x) if num else F.lit(None).cast("double")).alias(f"s_{c}"),
                 (F.min(x) if num else F.lit(None).cast("double")).alias(f"lo_{c}"),
                 (F.max(x) if num else F.lit(None).cast("double")).alias(f"hi_{c}")]
    row = df.agg(*aggs)
    return _long(row, [F.struct(
        F.lit(c).alias("column_name"),
        F.lit(df.schema[c].dataType.simpleString()).alias("data_type"),
        F.col("__n").alias("n_rows"), F.col(f"m_{c}").alias("n_missing"),
        F.try_divide(F.col(f"m_{c}") * 100.0, F.col("__n")).alias("pct_missing"),
        F.col(f"d_{c}").alias("n_distinct"), F.col(f"z_{c}").alias("n_zeros"),
        F.col(f"a_{c}").alias("mean"), F.col(f"s_{c}").alias("std"),
        F.col(f"lo_{c}").alias("min"), F.col(f"hi_{c}").alias("max")) for c in cols])


def histogram(df: DataFrame, cols: Sequence[str] | None = None,
              bins: int = 10) -> DataFrame:
    """A12 histogram: equal-width bins between min and max per column.

    Bin i covers [min + i*w, min + (i+1)*w); the maximum goes to the last bin.
    """
    cols = list(cols or numeric_columns(df))
    lv = long_values(df, cols, as_type="double", keep_null=False)
    mm = lv.groupBy("column_name").agg(F.min("value").alias("lo"),
                                       F.max("value").alias("hi"))
    j = lv.join(F.broadcast(mm), "column_name")       # one row per listed column
    span = F.col("hi") - F.col("lo")
    b = F.when(span == 0, F.lit(0)).otherwise(F.least(
        F.floor((F.col("value") - F.col("lo")) / span * bins).cast("int"), F.lit(bins - 1)))
    return j.groupBy("column_name", b.alias("bin")).agg(
        F.count(F.lit(1)).alias("n"), F.min("lo").alias("col_min"),
        F.min("hi").alias("col_max"))
