"""Scans and sinks.

Every reader returns a lazy DataFrame so that Catalyst can prune columns and
push filters into the scan; every writer is a single distributed write.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import table_path


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet scan of one driver table."""
    return spark.read.parquet(table_path(sf_dir, name))


def read_collection(spark: SparkSession, path: str, fmt: str = "parquet",
                    schema: T.StructType | str | None = None,
                    **options) -> DataFrame:
    """Full scan of a document collection with the store key dropped.

    Works for any ``spark.read.format(x)`` connector; ``_id`` is removed the
    same way the reference projected it away.
    """
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path).drop("_id")


def union_batches(batches: Iterable[DataFrame]) -> DataFrame:
    """Row-wise append with column union; missing columns are NULL."""
    batches = list(batches)
    if not batches:
        raise ValueError("union_batches needs at least one batch")
    out = batches[0]
    for b in batches[1:]:
        out = out.unionByName(b, allowMissingColumns=True)
    return out


def read_csv(spark: SparkSession, path: str,
             schema: T.StructType | str | None = None) -> DataFrame:
    """S3: CSV scan with a header; types inferred only when no schema given."""
    reader = spark.read.option("header", True)
    if schema is None:
        reader = reader.option("inferSchema", True)
    else:
        reader = reader.schema(schema)
    return reader.csv(path)


def write_parquet(df: DataFrame, path: str,
                  partition_by: Sequence[str] | None = None) -> str:
    """Overwrite a parquet table (optionally split into folders)."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def write_csv(df: DataFrame, path: str) -> str:
    """CSV sink with a header row."""
    df.write.mode("overwrite").option("header", True).csv(path)
    return path


def write_json(df: DataFrame, path: str) -> str:
    """JSON-lines sink for status, metric and curve tables."""
    df.write.mode("overwrite").json(path)
    return path


def append_rows(df: DataFrame, path: str, key: str | None = None,
                fmt: str = "parquet") -> int:
    """Append scored rows to an output table; returns rows written.

    With ``key`` the append is idempotent: rows whose key is already in the
    sink are removed by a ``left_anti`` join before writing (the reference
    re-inserted duplicates on every call).  Of rows that share a key (NULL is a
    key) the one with the smallest content hash is written.  The written count is observed
    during the write itself, so the data is not read twice.
    """
    from pyspark.sql import Observation
    spark = df.sparkSession
    new = df
    if key is not None:
        # an empty append creates the sink (with its schema) on first use
        spark.createDataFrame([], df.schema).write.mode("append").format(fmt).save(path)
        existing = spark.read.format(fmt).load(path).select(F.col(key).alias("__key"))
        first = Window.partitionBy(key).orderBy(F.xxhash64(*df.columns))
        new = (df.withColumn("__nth", F.row_number().over(first)).where("__nth = 1").drop("__nth")
               .join(existing, F.col(key).eqNullSafe(F.col("__key")), "left_anti"))
    obs = Observation(f"append_rows_{uuid.uuid4().hex[:8]}")
    new.observe(obs, F.count(F.lit(1)).alias("n")).write.mode("append").format(fmt).save(path)
    return int(obs.get.get("n", 0))


def page(df: DataFrame, order_by: Sequence[str], start: int,
         size: int) -> DataFrame:
    """One stable page of rows (ordered by a key, then offset/limit)."""
    return df.orderBy(*order_by).offset(start).limit(size)


def is_empty(df: DataFrame) -> bool:
    """Empty-input guard (reads at most one row)."""
    return df.isEmpty()


def require_columns(df: DataFrame, cols: Iterable[str]) -> None:
    """Analysis-time presence guard; no data is scanned."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")


def ingest(df: DataFrame, output_path: str, source: str) -> DataFrame:
    """Copy a source to parquet and return the run record.

    The row count is gathered by ``observe`` during the single write pass,
    so the table is read once.  An empty source writes nothing.
    """
    spark = df.sparkSession
    start = _dt.datetime.now(_dt.timezone.utc)
    rows = 0
    if not is_empty(df):
        from pyspark.sql import Observation
        obs = Observation(f"ingest_{uuid.uuid4().hex[:8]}")
        df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode(
            "overwrite").parquet(output_path)
        rows = int(obs.get["rows"])
    end = _dt.datetime.now(_dt.timezone.utc)
    schema = ("source string, output_path string, rows long, "
              "start_time string, end_time string, duration_s double")
    return spark.createDataFrame(
        [(source, output_path if rows else None, rows,
          start.isoformat(), end.isoformat(),
          (end - start).total_seconds())], schema)
