"""Scalar column functions (X1-X15).  All are built-in Spark expressions, so
they stay inside whole-stage code generation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def part_after(c: Column | str, sep: str, n: int = 2) -> Column:
    """N-th piece of a string split on a literal separator.

    NULL when the value is NULL or has no separator ("02.Medium" -> "Medium").
    """
    col = _c(c)
    return F.when(F.instr(col, sep) > 0,
                  F.split_part(col, F.lit(sep), F.lit(n)))


def empty_if_null(c: Column | str) -> Column:
    """NULL -> ''."""
    return F.coalesce(_c(c), F.lit(""))


def recode(c: Column | str, mapping: Mapping[str, str | None]) -> Column:
    """Value -> value recode; unmapped values pass through.

    A mapping to ``None`` turns the value into NULL (sentinel removal).
    """
    col = _c(c)
    out = None
    for src, dst in mapping.items():
        cond = col == F.lit(src)
        val = F.lit(dst).cast("string")
        out = F.when(cond, val) if out is None else out.when(cond, val)
    return col if out is None else out.otherwise(col)


def club(c: Column | str, values: Sequence[str], target: str) -> Column:
    """Many values -> one category (category clubbing)."""
    col = _c(c)
    return F.when(col.isin(list(values)), F.lit(target)).otherwise(col)


def null_if(c: Column | str, token: str) -> Column:
    """Sentinel -> NULL."""
    return F.nullif(_c(c), F.lit(token))


def fill_null(c: Column | str, value) -> Column:
    """NULL -> constant category."""
    return F.coalesce(_c(c), F.lit(value))


def yes_no(c: Column | str, yes: int = 0, no: int = 1) -> Column:
    """Yes/No flag to an integer; anything else is NULL.

    The reference maps Yes->0 and No->1 (kept as the default) and returned
    the string 'error' for other values; a NULL keeps the column numeric.
    """
    col = _c(c)
    return (F.when(col == "Yes", F.lit(yes))
            .when(col == "No", F.lit(no))
            .otherwise(F.lit(None).cast("int")))


def lead_score(p: Column | str) -> Column:
    """0-100 score, round half to even (numpy semantics, not half-up)."""
    return F.bround(_c(p) * 100, 0).cast("int")


def abs_diff(a: Column | str, b: Column | str) -> Column:
    """X10."""
    return F.abs(_c(a) - _c(b))


def grid(steps: int, last: int | None = None) -> Column:
    """X11: even grid i/steps for i = 0..last as an array column."""
    last = steps if last is None else last
    return F.transform(F.sequence(F.lit(0), F.lit(last)),
                       lambda i: i.cast("double") / F.lit(float(steps)))


def predicted_label(score: Column | str, threshold, strict: bool) -> Column:
    """F12 (strict ``>``) / F13 (inclusive ``>=``) cut-off predicate."""
    s = _c(score)
    t = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    return (s > t).cast("int") if strict else (s >= t).cast("int")


def iso_time(ts: Column | str) -> Column:
    """ISO-8601 text of a timestamp."""
    return F.date_format(_c(ts), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def sigmoid(z: Column) -> Column:
    """Logistic link."""
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def safe_ratio(num: Column, den: Column) -> Column:
    """Ratio that is NULL (not an error) when the denominator is 0."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def ratio_or_zero(num: Column, den: Column) -> Column:
    """Ratio with the ``zero_division=0`` convention."""
    return F.coalesce(safe_ratio(num, den), F.lit(0.0))
