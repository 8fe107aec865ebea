"""Column and row cleaning.

Data-dependent column drops are decided from one aggregate over the table
(the only driver round-trip is the list of column names to drop).
Duplicate handling is built on hash aggregates, never on a window over a
key, so a key holding a third of the rows does not end up in one task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .profile import NUMERIC, _long

FLOATS = (T.FloatType, T.DoubleType)


def drop_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Drop listed columns; absent names are ignored."""
    return df.drop(*cols)


def rename_columns(df: DataFrame, mapping: Mapping[str, str],
                   lower: bool = True) -> DataFrame:
    """Rename by map, then optionally lower-case every name."""
    out = df.withColumnsRenamed(dict(mapping))
    return out.toDF(*[c.lower() for c in out.columns]) if lower else out


def select_by_type(df: DataFrame, kind: str, exclude: Sequence[str] = ()) -> DataFrame:
    """Keep categorical (string) or numerical columns."""
    want = (T.StringType,) if kind == "categorical" else NUMERIC
    return df.select(*[f.name for f in df.schema.fields
                       if isinstance(f.dataType, want) and f.name not in exclude])


def column_kind(dt: T.DataType) -> str:
    if isinstance(dt, T.StringType):
        return "categorical"
    if isinstance(dt, NUMERIC):
        return "numerical"
    return "other"


def column_info(df: DataFrame) -> DataFrame:
    """Per-column type, kind and non-null count (plus the row count)."""
    fields = df.schema.fields
    row = df.agg(F.count(F.lit(1)).alias("__n"),
                 *[F.count(F.col(f.name)).alias(f"c_{i}") for i, f in enumerate(fields)])
    return _long(row, [F.struct(
        F.lit(f.name).alias("column_name"), F.lit(i).alias("position"),
        F.lit(f.dataType.simpleString()).alias("data_type"),
        F.lit(column_kind(f.dataType)).alias("kind"),
        F.col(f"c_{i}").alias("non_null"), F.col("__n").alias("n_rows"))
        for i, f in enumerate(fields)])


def columns_to_drop(df: DataFrame, max_missing_pct: float = 50.0,
                    cols: Sequence[str] | None = None) -> DataFrame:
    """P4-P7 as a long table (column_name, reason).

    constant: exactly one distinct non-null value (all-NULL has 0, kept);
    zero_variance: numeric with sample variance 0; key_like: distinct count
    equals the row count; mostly_missing: more than ``max_missing_pct`` % NULL.
    """
    cols = list(cols or df.columns)
    aggs = [F.count(F.lit(1)).alias("__n")]
    for c in cols:
        aggs.append(F.count_distinct(c).alias(f"d_{c}"))
        aggs.append(F.count_if(F.col(c).isNull()).alias(f"m_{c}"))
        num = isinstance(df.schema[c].dataType, NUMERIC)
        aggs.append((F.var_samp(c) if num else F.lit(None).cast("double")).alias(f"v_{c}"))
    row = df.agg(*aggs)
    n = F.col("__n")
    structs = []
    for c in cols:
        d, m, v = F.col(f"d_{c}"), F.col(f"m_{c}"), F.col(f"v_{c}")
        for reason, cond in (("constant", d == 1), ("zero_variance", v == 0),
                             ("key_like", (d == n) & (n > 0)),
                             ("mostly_missing", m * 100.0 > n * max_missing_pct)):
            structs.append(F.struct(F.lit(c).alias("column_name"),
                                    F.lit(reason).alias("reason"),
                                    F.coalesce(cond, F.lit(False)).alias("hit")))
    return _long(row, structs).where("hit").drop("hit")


def drop_flagged(df: DataFrame, reasons: Sequence[str] = (
        "constant", "zero_variance", "key_like", "mostly_missing"),
        keep: Sequence[str] = ()) -> DataFrame:
    """Apply P4-P7: one aggregate decides, then the columns are dropped."""
    flagged = columns_to_drop(df).where(F.col("reason").isin(list(reasons)))
    names = sorted({r["column_name"] for r in flagged.collect()} - set(keep))
    return df.drop(*names)


def clean_infinities(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """F1 (+D2): +-infinity and NaN become NULL in floating columns."""
    cols = set(cols or [f.name for f in df.schema.fields if isinstance(f.dataType, FLOATS)])
    bad = [float("inf"), float("-inf")]
    return df.select(*[
        F.when(F.isnan(c) | F.col(c).isin(bad), None).otherwise(F.col(c)).alias(c)
        if c in cols else F.col(c) for c in df.columns])


def coerce_numeric(df: DataFrame, cols: Sequence[str], to: str = "double") -> DataFrame:
    """text to number; failures become NULL (``try_cast`` — a plain
    cast raises under ANSI mode)."""
    cols = set(cols)
    return df.select(*[F.col(c).try_cast(to).alias(c) if c in cols else F.col(c)
                       for c in df.columns])


def drop_incomplete(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """drop rows with any NULL."""
    return df.na.drop("any", subset=list(subset) if subset else None)


def token_columns(df: DataFrame, token: str, cols: Sequence[str] | None = None) -> DataFrame:
    """which string columns contain ``token`` as a whole value."""
    cols = list(cols or [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)])
    row = df.agg(*[F.max((F.col(c) == token).cast("int")).alias(f"t_{c}") for c in cols])
    return _long(row, [F.struct(F.lit(c).alias("column_name"),
                                F.coalesce(F.col(f"t_{c}"), F.lit(0)).alias("has_token"))
                       for c in cols])


def any_null(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """does a column hold a NULL (1/0)."""
    cols = list(cols or df.columns)
    row = df.agg(*[F.max(F.col(c).isNull().cast("int")).alias(f"n_{c}") for c in cols])
    return _long(row, [F.struct(F.lit(c).alias("column_name"),
                                F.coalesce(F.col(f"n_{c}"), F.lit(0)).alias("any_null"))
                       for c in cols])


def _rest(df: DataFrame, subset: Sequence[str]) -> list[str]:
    return [c for c in df.columns if c not in subset]


def dedupe_first(df: DataFrame, subset: Sequence[str] | None = None,
                 order: Sequence[str] | None = None) -> DataFrame:
    """One row per key; the kept row is the smallest by ``order``
    (default: the remaining columns, NULLs first).  A hash aggregate with
    map-side ``min(struct)``, so hot keys are combined before the shuffle."""
    if not subset:
        return df.dropDuplicates()
    rest = list(order) if order else _rest(df, subset)
    others = [c for c in _rest(df, subset) if c not in rest]
    first = df.groupBy(*subset).agg(F.min(F.struct(*rest, *others)).alias("__r"))
    return first.select(*subset, *[F.col(f"__r.{c}").alias(c) for c in rest + others]
                        ).select(*df.columns)


def duplicate_rows(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    """every row that is not the first of its key (first as in
    ``dedupe_first``), each listed as often as it repeats."""
    rest = _rest(df, subset)
    copies = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("__c"))
    first = df.groupBy(*subset).agg(F.min(F.struct(*rest)).alias("__r"))
    first = first.select(*[F.col(k).alias(f"__k_{k}") for k in subset], "__r")
    cond = None
    for k in subset:                       # NULL keys group together, as in groupBy
        c = copies[k].eqNullSafe(first[f"__k_{k}"])
        cond = c if cond is None else cond & c
    j = copies.join(first, cond).drop(*[f"__k_{k}" for k in subset])
    is_first = F.struct(*[F.col(c) for c in rest]).eqNullSafe(F.col("__r")).cast("int")
    extra = (F.col("__c") - is_first).alias("__extra")
    dup = j.select(*df.columns, extra).where(F.col("__extra") > 0)
    return dup.select(*df.columns, F.explode(F.sequence(F.lit(1), F.col("__extra"))
                                             ).alias("__i")).drop("__i")


def duplicate_count(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Rows, distinct keys, and duplicate rows (rows - distinct)."""
    subset = list(subset or df.columns)
    keys = df.groupBy(*subset).agg(F.count(F.lit(1)).alias("c"))
    return keys.agg(F.sum("c").alias("n_rows"), F.count(F.lit(1)).alias("n_distinct"),
                    (F.sum("c") - F.count(F.lit(1))).alias("n_duplicates"))
