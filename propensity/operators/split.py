"""Deterministic stratified splits and folds (M1, M2, M5, M7 hash).

Order inside each class is ``md5(key || '|' || seed)`` then the key, so
the result does not depend on partitioning, task order or retries, and is
reproducible in any engine that has md5.  Ranks come from
counts per class and hash prefix plus places inside a prefix, so a class
holding half the table is never a single task and no global sort is needed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType


def hash_order(key: str, seed: int = 42) -> Column:
    return F.md5(F.concat(F.col(key).cast("string"), F.lit(f"|{seed}")))


def unit_hash(*parts: Column | str) -> Column:
    """M7: a uniform number in [0,1) from the first 32 bits of an md5."""
    cols = [F.col(p).cast("string") if isinstance(p, str) else p.cast("string")
            for p in parts]
    h = F.md5(F.concat_ws("|", *cols))
    return F.conv(F.substring(h, 1, 8), 16, 10).cast("long") / F.lit(4294967296.0)


def stratified_rank(df: DataFrame, label: str, key: str, seed: int = 42) -> DataFrame:
    """Adds ``rn`` (1-based rank inside the class) and ``__class_n``.

    The order is a hash, so it is uniform: its first four hex digits cut every
    class, however large, into up to 65,536 even pieces.  Their counts give each
    piece's offset, and a window over (class, piece) the place inside; no global
    sort, and no copy of the rows.

    A NULL key is placed by a hash of the row's plain columns, so such rows are
    ranked and spread like the others; rows with equal keys follow that hash."""
    plain = [F.col(f"`{f.name}`") for f in df.schema if isinstance(f.dataType, AtomicType)]
    rows = df.withColumn("__t", F.xxhash64(*plain) if plain else F.lit(0).cast("long"))
    rows = rows.withColumn("__h", F.coalesce(hash_order(key, seed), F.md5(F.concat(F.col("__t").cast("string"), F.lit(f"|{seed}")))))
    rows = rows.withColumn("__p", F.substring("__h", 1, 4))
    pieces = rows.groupBy(F.col(label).alias("__l"), F.col("__p").alias("__q")).agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy("__l").orderBy("__q").rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.select("__l", "__q", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off"),
                           F.sum("__n").over(Window.partitionBy("__l")).alias("__class_n"))
    inner = F.row_number().over(Window.partitionBy(label, "__p").orderBy("__h", key, "__t"))
    out = rows.withColumn("__i", inner).join(
        pieces, F.col(label).eqNullSafe(F.col("__l")) & (F.col("__p") == F.col("__q")))
    # a fixed order inside each task, so that row-sampling fits on the result repeat
    out = out.sortWithinPartitions("__h", key, "__t")
    return out.withColumn("rn", (F.col("__off") + F.col("__i")).cast("long")).drop(
        "__t", "__h", "__p", "__l", "__q", "__off", "__i")


def stratified_split(df: DataFrame, label: str, key: str, train_pct: int = 70,
                     val_pct: int = 15, seed: int = 42) -> DataFrame:
    """M1: exact per-class 70/15/15 split into ``split`` in {train,val,test}.

    Row ``rn`` of a class of size n is train if rn*100 <= 70n, val if
    rn*100 <= 85n, else test (integer arithmetic, no float rounding).
    """
    r = stratified_rank(df, label, key, seed)
    n = F.col("__class_n")
    split = (F.when(F.col("rn") * 100 <= train_pct * n, F.lit("train"))
             .when(F.col("rn") * 100 <= (train_pct + val_pct) * n, F.lit("val"))
             .otherwise(F.lit("test")))
    return r.withColumn("split", split).drop("rn", "__class_n")


def stratified_folds(df: DataFrame, label: str, key: str, k: int = 5,
                     seed: int = 42) -> DataFrame:
    """M2: round-robin fold id inside each class (fold sizes differ by <= 1
    per class)."""
    r = stratified_rank(df, label, key, seed)
    return r.withColumn("fold", ((F.col("rn") - 1) % k).cast("int")).drop(
        "rn", "__class_n")


def split_and_folds(df: DataFrame, label: str, key: str, k: int = 5,
                    train_pct: int = 70, val_pct: int = 15,
                    seed: int = 42) -> DataFrame:
    """M1 and M2 from one ranking pass."""
    r = stratified_rank(df, label, key, seed)
    n = F.col("__class_n")
    split = (F.when(F.col("rn") * 100 <= train_pct * n, F.lit("train"))
             .when(F.col("rn") * 100 <= (train_pct + val_pct) * n, F.lit("val"))
             .otherwise(F.lit("test")))
    return (r.withColumn("split", split)
            .withColumn("fold", ((F.col("rn") - 1) % k).cast("int"))
            .drop("rn", "__class_n"))


def sorted_slice(df: DataFrame, order_col: str, start: int, stop: int,
                 descending: bool = True, tie_cols: Sequence[str] = ()) -> DataFrame:
    """M5: positions [start, stop) of a sorted table (offset + limit); ties by ``tie_cols``."""
    o = F.col(order_col).desc() if descending else F.col(order_col).asc()
    return df.orderBy(o, *tie_cols).offset(start).limit(stop - start)
