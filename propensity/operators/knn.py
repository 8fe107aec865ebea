"""Nearest-neighbour imputation of categorical columns without comparing all pairs.

Rows are first reduced to distinct patterns of ordinal codes with their counts.  The distance of
two patterns is NaN-Euclidean: squared code differences over the columns both have, scaled by
columns / common columns.  Kept as ``S * (L / m)`` (S the plain sum, m the common columns, L the least common
multiple of 1..columns) it is an integer, so comparisons and ties are exact.

Donors are cut into blocks by their codes in the columns with the most levels; a missing code is a cell of its
own.  A receiver visits the blocks whose codes can lie within a squared radius R of its own, and one task
compares all receivers of a block with its donors as matrices; whatever a receiver has not visited differs by at least
R + 1, so its distance is at least ``(R + 1) * (L / present columns)``.  A receiver whose k-th distance is
below that bound is done.  The others know from their k-th distance how far they must still look, or, with fewer
than k donors so far, go on to a larger radius.  The last stage visits every block.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..session import scratch_path
from .ordering import row_number_within

#: Plans are made for every pair of sets of present columns: at most 4**MAX_COLUMNS.
MAX_COLUMNS = 8
#: Donor masks with fewer patterns than this, or than a 200th of all, share one group of the index.
RARE = 64
#: (most columns of a block, squared radius) of the stages; None visits every block.
STAGES = ((4, 0), (4, 4), (4, None))
#: Cells a column is cut into for the blocks, most blocks, and patterns a block should hold.
CELLS, MOST_BLOCKS, PER_BLOCK = 32, 1 << 15, 128
#: Donor patterns, and receivers, that one task compares at most at a time; distances held at once.
DONORS, RECEIVERS, HELD = 4096, 50_000, 1 << 21
FOUND = "pid long, target int, dist long, code int, cnt long, visited long"


@dataclass
class Patterns:
    """table: pid, the columns' values and codes (c0, c1, ...), cnt and mask (bit i: column i is present).
    levels: t (column number), level and code."""
    table: DataFrame
    cols: list[str]
    levels: DataFrame
    sizes: list[int]

    @property
    def lcm(self) -> int:
        return math.lcm(*range(1, len(self.cols) + 1))


def _kept(df: DataFrame, name: str) -> DataFrame:
    """df written once under the shared folder and read back (sizes known, lineage cut)."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def code_patterns(df: DataFrame, cols: Sequence[str]) -> Patterns:
    """Distinct patterns of ``cols`` with ordinal codes in the order of the levels as text; NULL stays NULL."""
    cols = list(cols)
    if not 1 <= len(cols) <= MAX_COLUMNS:
        raise ValueError(f"between 1 and {MAX_COLUMNS} columns, not {len(cols)}")
    p = _kept(df.groupBy(*cols).agg(F.count(F.lit(1)).alias("cnt")), "patterns")
    pairs = F.array(*[F.struct(F.lit(i).alias("t"), F.col(c).cast("string").alias("level")) for i, c in enumerate(cols)])
    seen = p.select(F.explode(pairs).alias("p")).select("p.t", "p.level").where("level IS NOT NULL").distinct()
    levels = _kept(row_number_within(seen, "t", ["level"]).select("t", "level", (F.col("rn") - 1).cast("int").alias("code")), "levels")
    for i, c in enumerate(cols):
        own = levels.where(F.col("t") == i).select(F.col("level").alias(f"l{i}"), F.col("code").alias(f"c{i}"))
        p = p.join(own, F.col(c).cast("string") == F.col(f"l{i}"), "left").drop(f"l{i}")
    mask = sum((F.when(F.col(f"c{i}").isNotNull(), 1 << i).otherwise(0) for i in range(len(cols))), F.lit(0))
    p = p.withColumn("mask", mask.cast("int")).withColumn("pid", F.monotonically_increasing_id())
    count = {r["t"]: r["count"] for r in levels.groupBy("t").count().collect()}
    return Patterns(_kept(p, "coded"), cols, levels, [count.get(i, 0) for i in range(len(cols))])


def _subsets(masks: dict[int, int], spread: dict[tuple[int, ...], int], width: int, fewest: bool) -> dict[tuple[int, int], tuple[int, tuple[int, ...]]]:
    """For each (receiver mask, donor mask) with a common column the group of donors and the key columns that serve it.

    A mask that many donors share is a group of its own, keyed by the columns that spread it most, as few as leave
    some four donors a bucket; the rare masks form one group, keyed by single columns that several of them share.
    ``fewest`` takes the single column with the fewest codes instead."""
    full = (1 << max(max(s) for s in spread) + 1) - 1
    rare = max(RARE, sum(masks.values()) // 200)
    out = {}
    for rm, (dm, count) in itertools.product(masks, masks.items()):
        common = [s for s in spread if all(rm & dm & 1 << i for i in s) and len(s) <= width]
        if not common or rm == full:
            continue
        best = {w: max((s for s in common if len(s) == w), key=lambda s: (-spread[s] if fewest else spread[s], s)) for w in {len(s) for s in common}}
        if count < rare:
            out[rm, dm] = -1, best[1]
        else:
            out[rm, dm] = dm, next((best[w] for w in sorted(best) if spread[best[w]] * 4 >= count), best[max(best)])
    return out


def _block_columns(p: Patterns, patterns: int, width: int) -> list[tuple[int, int]]:
    """(column, codes a cell) of the blocks: the columns with the most levels, until blocks hold some PER_BLOCK patterns."""
    out, blocks = [], 1
    for i in sorted(range(len(p.cols)), key=lambda i: (-p.sizes[i], i))[:width]:
        step = max(1, -(-p.sizes[i] // CELLS))
        cells = -(-p.sizes[i] // step) + 1                    # one for a missing code
        if out and (blocks * PER_BLOCK >= patterns or blocks * cells > MOST_BLOCKS):
            break
        out.append((i, step))
        blocks *= cells
    return out


def _cells(prefix: str, name: str, places: Sequence[tuple[int, int]]) -> list[Column]:
    return [F.coalesce(F.floor(F.col(f"{prefix}{i}") / step).cast("int"), F.lit(-1)).alias(f"{name}{j}") for j, (i, step) in enumerate(places)]


def _least_gap(places: Sequence[tuple[int, int]]) -> Column:
    """Least sum of squared code differences between rows of the cells q0, q1, ... and b0, b1, ..."""
    total = F.lit(0).cast("long")
    for j, (_, step) in enumerate(places):
        apart = F.abs(F.col(f"q{j}") - F.col(f"b{j}"))
        gap = F.when((F.col(f"q{j}") < 0) | (F.col(f"b{j}") < 0) | (apart == 0), 0).otherwise((apart - 1) * step + 1).cast("long")
        total = total + gap * gap
    return total


def _codes(t: pa.Table, prefix: str, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Codes with 0 where missing, and 1.0 where present."""
    x = np.column_stack([t.column(f"{prefix}{i}").cast(pa.float64()).to_numpy() for i in range(n)])
    there = ~np.isnan(x)
    return np.where(there, x, 0.0), there.astype(np.float64)


def _compare(n: int, lcm: int, k: int):
    """Per block: the k donors of least (distance, code) for each receiver and column it asks for, at most ``upto`` away."""
    schema = pa.schema([("pid", pa.int64()), ("target", pa.int32()), ("dist", pa.int64()), ("code", pa.int32()), ("cnt", pa.int64()), ("visited", pa.int64())])
    factor = np.array([0] + [lcm // m for m in range(1, n + 1)], np.int64)

    def run(receivers: pa.Table, donors: pa.Table) -> pa.Table:
        if not receivers.num_rows or not donors.num_rows:
            return schema.empty_table()
        pid, want, upto = (receivers.column(c).to_numpy() for c in ("pid", "want", "upto"))
        x, xt = _codes(receivers, "c", n)
        y, yt = _codes(donors, "d", n)
        cnt = donors.column("cnt").to_numpy()
        out, size = [], max(1, HELD // len(y))
        for a in range(0, len(x), size):
            b = slice(a, a + size)
            # integers below 2**53, so the products are exact
            s = np.hstack([x[b] * x[b], xt[b], -2 * x[b]]) @ np.hstack([yt, y * y, y]).T
            common = (xt[b] @ yt.T).astype(np.int8)
            dist = s.astype(np.int64) * factor[common]
            for t in range(n):
                rows, have = np.flatnonzero(want[b] >> t & 1), np.flatnonzero(yt[:, t])
                if not len(rows) or not len(have):
                    continue
                code = y[have, t].astype(np.int64)
                have = have[np.argsort(code, kind="stable")]
                d, ok = dist[np.ix_(rows, have)], common[np.ix_(rows, have)] > 0
                d = np.where(ok, d, np.iinfo(np.int64).max)
                if len(have) <= k:
                    first = np.broadcast_to(np.arange(len(have)), d.shape)
                elif (top := int(d.max(where=ok, initial=0))) < (1 << 62) // len(have):
                    key = np.where(ok, d, top + 1) * len(have) + np.arange(len(have))
                    first = np.argpartition(key, k - 1, axis=1)[:, :k]
                else:
                    first = np.argsort(d, axis=1, kind="stable")[:, :k]
                near = np.take_along_axis(d, first, 1)
                i, j = np.nonzero(np.take_along_axis(ok, first, 1) & (near <= upto[b][rows][:, None]))
                donor = have[first[i, j]]
                visited = np.where(np.diff(i, prepend=-1) > 0, ok.sum(axis=1)[i], 0)
                out.append((pid[b][rows[i]], np.full(len(i), t, np.int32), near[i, j], y[donor, t].astype(np.int32), cnt[donor], visited))
        if not out:
            return schema.empty_table()
        return pa.table([pa.array(np.concatenate(c)).cast(f.type) for c, f in zip(zip(*out), schema)], schema=schema)
    return run


def _stage(active: DataFrame, donors: DataFrame, p: Patterns, places: Sequence[tuple[int, int]], k: int) -> DataFrame:
    """Per (pid, target): the candidates that hold the k smallest (distance, code) within ``reach``, counted, with kth and visited."""
    n, width = len(p.cols), len(places)
    at = [f"b{j}" for j in range(width)]
    here = [f"q{j}" for j in range(width)]
    # blocks and the reaches asked of them: at most MOST_BLOCKS short rows a reach, compared as blocks, not as rows
    blocks = donors.groupBy(*at).agg(F.count(F.lit(1)).alias("n"))
    asked = active.select(*here, "reach").distinct().withColumnRenamed("reach", "r_reach")
    met = asked.crossJoin(blocks).where(F.col("r_reach").isNull() | (_least_gap(places) <= F.col("r_reach")))
    met = met.select(*[F.col(c).alias(f"r_{c}") for c in here], "r_reach", *at)
    same = F.col("reach").eqNullSafe(F.col("r_reach"))
    for c in here:
        same = same & (F.col(c) == F.col(f"r_{c}"))
    cells = _kept(active.join(met, same).select("pid", *[f"c{i}" for i in range(n)], "want", "upto", *at), "cells")
    # a block with many donors or receivers is cut into parts, each pair of parts is compared once
    sizes = _kept(cells.groupBy(*at).agg(F.count(F.lit(1)).alias("asks")).join(blocks, at).select(
        *at, F.ceil(F.col("n") / DONORS).cast("int").alias("n_d"), F.ceil(F.col("asks") / RECEIVERS).cast("int").alias("n_r")), "sizes")

    def parts(df: DataFrame, name: Column, own: str, other: str) -> DataFrame:
        """Rows of one part of their own side, for every part of the other side."""
        dealt = df.join(sizes, at).withColumn(own, F.pmod(name, F.col(f"n_{own}")).cast("int"))
        return dealt.withColumn(other, F.explode(F.sequence(F.lit(0), F.col(f"n_{other}") - 1))).drop("n_d", "n_r")

    left = parts(cells, F.xxhash64("pid"), "r", "d")
    right = parts(donors, F.xxhash64(*[f"d{i}" for i in range(n)]), "d", "r")
    by = [*at, "d", "r"]
    found = left.groupBy(*by).cogroup(right.groupBy(*by)).applyInArrow(_compare(n, p.lcm, k), FOUND)
    grouped = found.groupBy("pid", "target", "dist", "code").agg(F.sum("cnt").alias("cnt"), F.sum("visited").alias("visited"))
    w = Window.partitionBy("pid", "target")
    upto = F.sum("cnt").over(w.orderBy("dist", "code"))
    ranked = grouped.withColumn("upto", upto)
    return (ranked.withColumn("kth", F.min(F.when(F.col("upto") >= k, F.col("dist"))).over(w)).withColumn("visited", F.sum("visited").over(w))
            .where(F.col("upto") - F.col("cnt") < k)
            .select("pid", "target", "dist", "code", F.least("cnt", k - (F.col("upto") - F.col("cnt"))).alias("used"), "kth", "visited"))


def nearest_patterns(p: Patterns, k: int = 5, stages=STAGES) -> DataFrame:
    """For every pattern and column it lacks (pid, target) the codes of its k nearest donors.

    One row per (dist, code) with the number ``used`` of rows that hold it; equal distances are taken in code order.
    ``dist`` is the integer distance, ``visited`` the donor patterns compared in the blocks that held a candidate.
    A pair without a donor that has a common column has no row."""
    spark, n = p.table.sparkSession, len(p.cols)
    codes = [f"c{i}" for i in range(n)]
    masks = {r["mask"]: r["n"] for r in p.table.groupBy("mask").agg(F.count(F.lit(1)).alias("n")).collect()}   # at most 2**n rows
    full = (1 << n) - 1
    if masks.keys() <= {0, full}:           # nothing lacks a cell, or nothing but
        return spark.createDataFrame([], "pid long, target int, dist long, code int, used long, visited long")
    plain = p.table.where("mask <> 0").select(*[F.col(f"c{i}").alias(f"d{i}") for i in range(n)], "cnt")
    far = F.lit((1 << 63) - 1).cast("long")
    active = _kept(p.table.where((F.col("mask") != full) & (F.col("mask") != 0)).select(
        "pid", *codes, "mask", F.lit(full).bitwiseXOR(F.col("mask")).cast("int").alias("want"),
        F.lit(None).cast("long").alias("need"), far.alias("upto")), "active")
    found = None
    for width, radius in stages:
        if active.isEmpty():
            break
        places = _block_columns(p, sum(masks.values()), width)
        donors = _kept(plain.select(*plain.columns, *_cells("d", "b", places)), "donors")
        # who knows k donors need not look farther than the k-th of them
        reach = F.coalesce(F.col("need"), F.lit(radius).cast("long"))
        ranged = _kept(active.select("*", *_cells("c", "q", places), reach.alias("reach")), "ranged")
        got = _kept(_stage(ranged, donors, p, places, k), "neighbours")
        if radius is not None:
            unit = F.floor(F.lit(p.lcm) / F.bit_count(F.col("mask")))
            ranges = ranged.select(F.col("pid").alias("a_pid"), unit.alias("unit"), F.col("reach").alias("a_reach"))
            got = _kept(got.join(ranges, F.col("pid") == F.col("a_pid")).withColumn("done", F.coalesce(F.col("kth") < (F.col("a_reach") + 1) * F.col("unit"), F.lit(False))), "judged")
            each = got.groupBy("pid", "target").agg(F.first("done").alias("done"), F.first("kth").alias("kth"), F.first("unit").alias("unit"))
            # a column that is not settled: how far its k-th donor tells to look, NULL without k donors
            each = each.groupBy(F.col("pid").alias("e_pid")).agg(
                F.sum(F.when(F.col("done"), F.pow(F.lit(2), F.col("target")).cast("int")).otherwise(0)).cast("int").alias("settled"),
                F.count(F.when(~F.col("done"), F.lit(1))).alias("open"), F.count(F.when(~F.col("done"), F.col("kth"))).alias("known"),
                F.max(F.when(~F.col("done"), F.floor(F.col("kth") / F.col("unit")))).alias("e_need"), F.max(F.when(~F.col("done"), F.col("kth"))).alias("e_upto"))
            rest = active.drop("need", "upto").join(each, F.col("pid") == F.col("e_pid"), "left")
            rest = rest.withColumn("want", F.col("want").bitwiseAND(F.bitwise_not(F.coalesce("settled", F.lit(0))))).where("want <> 0")
            sure = (F.col("known") == F.col("open")) & (F.col("known") == F.bit_count("want"))
            active = _kept(rest.select("pid", *codes, "mask", "want", F.when(sure, F.col("e_need")).cast("long").alias("need"),
                                       F.coalesce(F.when(sure, F.col("e_upto")), far).alias("upto")), "active")
            got = got.where("done").drop("a_pid", "unit", "a_reach", "done")
        found = got if found is None else found.unionByName(got)
    if found is None:
        found = spark.createDataFrame([], "pid long, target int, dist long, code int, used long, kth long, visited long")
    return found.drop("kth")


def neighbour_codes(p: Patterns, neighbours: DataFrame) -> DataFrame:
    """(pid, target, code): mean code of the neighbours weighted by 1 / distance, cut to a whole level.

    Neighbours at distance 0 count alone; without neighbours the column's mean code is taken.  The mean is
    rounded to 9 places before it is cut, so that a sum such as 2.9999999999 counts as 3."""
    n = len(p.cols)
    zero = F.col("dist") == 0
    weight = F.col("used") / F.sqrt(F.col("dist").cast("double"))
    got = neighbours.groupBy("pid", "target").agg(
        F.sum(F.when(zero, F.col("used"))).alias("z"), F.sum(F.when(zero, F.col("used") * F.col("code"))).alias("zc"),
        F.sum(F.when(~zero, weight)).alias("w"), F.sum(F.when(~zero, weight * F.col("code"))).alias("wc"))
    mean = F.when(F.col("z") > 0, F.col("zc") / F.col("z")).otherwise(F.col("wc") / F.col("w"))
    got = got.select("pid", "target", mean.alias("mean"))
    means = p.table.agg(*[(F.sum(F.col("cnt") * F.col(f"c{i}")) / F.sum(F.when(F.col(f"c{i}").isNotNull(), F.col("cnt")))).alias(f"m{i}") for i in range(n)]).first()
    lacks = p.table.select("pid", F.explode(F.array_compact(F.array(*[F.when(F.col(f"c{i}").isNull(), F.lit(i)) for i in range(n)]))).alias("target"))
    default = F.get(F.array(*[F.lit(means[f"m{i}"]).cast("double") for i in range(n)]), F.col("target"))
    both = lacks.join(got, ["pid", "target"], "left")
    return both.select("pid", "target", F.floor(F.round(F.coalesce("mean", default), 9)).cast("int").alias("code"))


def impute_knn(df: DataFrame, cols: Sequence[str], k: int = 5, stages=STAGES) -> DataFrame:
    """NULLs of categorical ``cols`` filled with the level that the k nearest rows give.

    Rows without NULL in ``cols`` pass as they are; the others join their pattern's fills.  A column
    without any value stays NULL.  An empty table stays empty."""
    p = code_patterns(df, cols)
    codes = neighbour_codes(p, nearest_patterns(p, k, stages))
    named = codes.join(p.levels.withColumnRenamed("t", "target"), ["target", "code"])
    fills = named.groupBy(F.col("pid").alias("f_pid")).agg(*[F.max(F.when(F.col("target") == i, F.col("level"))).alias(f"f{i}") for i in range(len(p.cols))])
    keyed = p.table.join(fills, F.col("pid") == F.col("f_pid")).select(*[F.col(c).alias(f"p{i}") for i, c in enumerate(p.cols)],
                                                                      *[f"f{i}" for i in range(len(p.cols))])
    keyed = _kept(keyed, "fills")
    lacking = F.exists(F.array(*[F.col(c).isNull() for c in p.cols]), lambda x: x)
    rows = df.where(lacking)
    same = F.lit(True)
    for i, c in enumerate(p.cols):
        same = same & rows[c].eqNullSafe(F.col(f"p{i}"))
    types = {f.name: f.dataType for f in df.schema.fields if not isinstance(f.dataType, T.NullType)}
    filled = rows.join(keyed, same, "left").select(
        *[F.coalesce(rows[c], F.col(f"f{p.cols.index(c)}").cast(types[c])).alias(c) if c in p.cols else rows[c] for c in df.columns])
    return df.where(~lacking).unionByName(filled)
