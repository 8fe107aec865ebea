"""Registered queries: one Spark plan per operator group, and (where the
operator is SQL-expressible) an independent DuckDB oracle over the same
parquet tables.  Every query reads the driver's tables in full.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def rnd(df: DataFrame, digits: int = 6) -> DataFrame:
    """Oracle hygiene for registered outputs: doubles rounded to 6 places and
    timestamps rendered as ISO-8601 text (engines disagree on the in-memory
    timestamp unit, not on the value)."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            out.append(F.round(F.col(f.name), digits).alias(f.name))
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            out.append(F.date_format(F.col(f.name), ISO_FORMAT).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
ISO_SQL = "%Y-%m-%dT%H:%M:%S.%f"      # the same text in DuckDB


def _load_all() -> None:
    # importing the modules registers their queries
    from . import q_booster, q_io, q_metrics, q_neighbours, q_model, q_other, q_prep, q_profile, q_sketches  # noqa: F401


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load_all()
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    _load_all()
    return dict(ORACLE)
