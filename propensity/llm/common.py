"""Shared pieces of the training-data operators: input, shared tables, packed exchange rows."""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from propensity.session import ensure_checkpoint_dir, table_path

#: Text bytes that one packed request or one group of documents aims at.  It sets how
#: many groups there are, not what they hold: the number of groups grows with the data.
GROUP_BYTES = 8 << 20


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, "documents"))


def saved(df: DataFrame, name: str) -> DataFrame:
    """df written once as a table in the shared folder and read back: cuts the lineage,
    so a lost executor costs a re-read and no recomputation."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tables/{name}-{uuid.uuid4().hex[:12]}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def group_count(df: DataFrame, text: str = "text", per_group: int = GROUP_BYTES) -> int:
    """How many groups of about per_group text bytes df has (one scan, one scalar to the driver)."""
    total = df.agg(F.sum(F.octet_length(F.col(text)).cast("long"))).first()[0]
    return max(1, math.ceil((total or 0) / per_group))


def held_out(doc_id: Column) -> Column:
    """True where crc32 of the id's decimal text is divisible by 5."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def slices(batch: pa.RecordBatch | pa.Table, text: str, max_bytes: int = GROUP_BYTES,
           max_rows: int = 50_000) -> Iterator[tuple[int, int]]:
    """Row ranges of at most max_bytes of text (a longer single text stands alone)."""
    col = batch.column(text)
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    import pyarrow.compute as pc
    sizes = pc.fill_null(pc.binary_length(col), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes, dtype=np.int64)
    i, n = 0, len(sizes)
    while i < n:
        base = ends[i - 1] if i else 0
        j = int(np.searchsorted(ends, base + max_bytes, side="right"))
        j = min(max(j, i + 1), i + max_rows, n)
        yield i, j
        i = j


def pack48(values: np.ndarray) -> bytes:
    """The low 48 bits of each value, six bytes a value."""
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()


def unpack48(blob: bytes) -> np.ndarray:
    raw = np.frombuffer(blob, np.uint8).reshape(-1, 6)
    out = np.zeros((len(raw), 8), np.uint8)
    out[:, :6] = raw
    return out.reshape(-1).view("<u8")


def bucket_of(hashes: np.ndarray, n: int) -> np.ndarray:
    """Bucket from the top 31 bits, which pack48 does not keep except for some of them."""
    return (((hashes >> np.uint64(33)) * np.uint64(n)) >> np.uint64(31)).astype(np.int64)


def splits(sorted_values: np.ndarray) -> np.ndarray:
    """Start index of each run of equal values, with the length appended."""
    n = len(sorted_values)
    if n == 0:
        return np.zeros(1, np.int64)
    return np.r_[0, np.flatnonzero(sorted_values[1:] != sorted_values[:-1]) + 1, n]


def int64s(col) -> np.ndarray:
    """An Arrow long column without nulls as numpy."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    return col.to_numpy(zero_copy_only=False).astype(np.int64)


def blobs(col) -> list[bytes]:
    return [x.as_buffer() for x in (col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col)]
