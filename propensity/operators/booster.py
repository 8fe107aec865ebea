"""Second-order boosted trees with leaf penalties, trained on histograms.

Features are binned once by their distinct values or quantiles.  A level of a tree is one job: every task
routes its rows through the trees grown so far and sums gradient and Hessian per (node, feature, bin);
Spark adds the tasks' sums, and window functions turn them into the gain of every split.  Only the best split of
each open node (at most 2**depth rows) comes back to the driver.

Gradients and Hessians are rounded to whole multiples of 2**-24 before they are summed, so sums
are exact and the trees do not depend on how the rows are spread over tasks.

Objective: logistic loss with ``reg_alpha`` (L1) and ``reg_lambda`` (L2) on leaf weights, ``gamma`` per
split and ``min_child_weight`` as least Hessian of a child.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import asdict, dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import scratch_path
from .model import macro_f1_of, sample_grid

DEFAULTS = {"n_estimators": 100, "max_depth": 6, "learning_rate": 0.3, "subsample": 0.8, "gamma": 0.0,
            "reg_alpha": 0.0, "reg_lambda": 1.0, "min_child_weight": 1.0, "seed": 42}
SCALE = 1 << 24
#: Margins are written anew after so many trees, which bounds the trees a task routes its rows through.
KEEP_EVERY = 10
HIST = "node int, feature int, bin int, g long, h long"


@dataclass
class Tree:
    """Nodes in heap order (children of i: 2i and 2i + 1); feature -1 marks a leaf."""
    feature: list[int]
    bin: list[int]
    missing_left: list[bool]
    value: list[float]

    @classmethod
    def of_depth(cls, depth: int) -> Tree:
        n = 2 << depth
        return cls([-1] * n, [0] * n, [False] * n, [0.0] * n)


@dataclass
class Booster:
    features: list[str]
    bounds: list[list[float]]
    params: dict
    trees: list[Tree] = field(default_factory=list)

    def save(self, spark: SparkSession, path: str) -> str:
        spark.createDataFrame([(json.dumps(asdict(self)),)], "value string").write.mode("overwrite").text(path)
        return path

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Booster:
        d = json.loads(spark.read.text(path, wholetext=True).first()[0])
        return cls(d["features"], d["bounds"], d["params"], [Tree(**t) for t in d["trees"]])


def _few_values(features: Sequence[str], limit: int):
    """Per task: the distinct values of each feature, or NULL once there are more than ``limit``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: list[np.ndarray | None] = [np.zeros(0)] * len(features)
        for batch in batches:
            for i, f in enumerate(features):
                if seen[i] is not None:
                    v = batch.column(f).to_numpy(zero_copy_only=False).astype(np.float64)
                    v = np.union1d(seen[i], v[~np.isnan(v)])
                    seen[i] = v if len(v) <= limit else None
        flat = [(i, x) for i, v in enumerate(seen) for x in ([None] if v is None else v.tolist())]
        yield pa.record_batch([pa.array([i for i, _ in flat], pa.int32()), pa.array([x for _, x in flat], pa.float64())], names=["feature", "value"])
    return run


def bin_bounds(df: DataFrame, features: Sequence[str], max_bins: int = 64) -> list[list[float]]:
    """Upper bounds of the bins: all distinct values but the largest where there are at most ``max_bins``, else
    quantiles.  Two passes for all features; at most max_bins values a feature and task come to the driver."""
    x = df.select(*[F.nanvl(F.col(f).cast("double"), F.lit(None).cast("double")).alias(f) for f in features])
    few = (x.mapInArrow(_few_values(features, max_bins), "feature int, value double").groupBy("feature")
           .agg(F.collect_set("value").alias("values"), F.bool_or(F.col("value").isNull()).alias("many")).collect())
    values = {r["feature"]: sorted(r["values"]) for r in few if not r["many"] and len(r["values"]) <= max_bins}
    rest = [f for i, f in enumerate(features) if i not in values and few]
    quantiles = x.agg(*[F.percentile_approx(f, [i / max_bins for i in range(1, max_bins)], 10_000).alias(f) for f in rest]).first() if rest else {}
    return [values[i][:-1] if i in values else sorted(set(quantiles[f] or [])) if f in rest else [] for i, f in enumerate(features)]


def _codes(x: np.ndarray, bounds: Sequence[Sequence[float]]) -> np.ndarray:
    """Bin numbers, 0 for a missing value; bin b holds values up to bounds[b - 1]."""
    out = np.zeros(x.shape, np.uint8)
    for f, b in enumerate(bounds):
        there = ~np.isnan(x[:, f])
        out[there, f] = np.searchsorted(np.asarray(b), x[there, f], side="left") + 1
    return out


def _route(codes: np.ndarray, tree: Tree, depth: int) -> np.ndarray:
    """The node each row ends in."""
    feature, bins = np.array(tree.feature), np.arange(256)
    left = np.where(bins == 0, np.array(tree.missing_left)[:, None], bins <= np.array(tree.bin)[:, None])
    node = np.arange(len(feature))[:, None]
    after = np.where(feature[:, None] >= 0, 2 * node + ~left, node).astype(np.int32).reshape(-1)      # by node and code
    place = np.maximum(feature, 0)
    node, start, flat = np.ones(len(codes), np.int32), np.arange(len(codes)) * codes.shape[1], codes.reshape(-1)
    for _ in range(depth):
        node = after.take(node * 256 + flat.take(start + place.take(node)))
    return node


def _margin(codes: np.ndarray, start: np.ndarray, trees: Sequence[Tree], depth: int) -> np.ndarray:
    margin = start.copy()
    for t in trees:
        margin += np.array(t.value)[_route(codes, t, depth)]
    return margin


def _drawn(key: np.ndarray, tree: int, share: float, seed: int) -> np.ndarray:
    """Rows that a tree is grown on, by a hash of the row's key."""
    if share >= 1:
        return np.ones(len(key), bool)
    x = key.astype(np.uint64) + np.uint64((seed * 1_000_003 + tree + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (x ^ (x >> np.uint64(31))) >> np.uint64(11) < np.uint64(int(share * (1 << 53)))


def _binned(features: Sequence[str], bounds):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.column_stack([batch.column(f).to_numpy(zero_copy_only=False).astype(np.float64) for f in features])
            codes = _codes(x, bounds)
            yield pa.record_batch([batch.column("key"), batch.column("y"), pa.array([r.tobytes() for r in codes], pa.binary()),
                                   pa.array(np.zeros(len(codes)))], names=["key", "y", "codes", "margin"])
    return run


def _rows(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    n = batch.num_rows
    # all codes of a batch lie one after the other in one buffer
    packed = batch.column("codes").cast(pa.large_binary())
    ends = np.frombuffer(packed.buffers()[1], np.int64)[packed.offset:packed.offset + n + 1]
    codes = np.frombuffer(packed.buffers()[2] or b"", np.uint8)[ends[0]:ends[-1]].reshape(n, -1) if n else np.zeros((0, 1), np.uint8)
    return (batch.column("key").to_numpy(), batch.column("y").to_numpy(zero_copy_only=False).astype(np.float64), codes,
            batch.column("margin").to_numpy())


def _histogram(n_features: int, recent: Sequence[Tree], growing: Tree, open_nodes: Sequence[int], index: int, p: Mapping):
    """Sums of the rows that are in an open node, node by node and feature by feature in one array a task."""
    depth = int(p["max_depth"])
    nodes = np.array(sorted(open_nodes))
    place = np.full(2 << depth, -1)
    place[nodes] = np.arange(len(nodes))

    def of_cells(cells: np.ndarray, g: np.ndarray, h: np.ndarray) -> pa.RecordBatch:
        return pa.record_batch([pa.array(nodes[cells // 256 // n_features].astype(np.int32)), pa.array((cells // 256 % n_features).astype(np.int32)),
                                pa.array((cells % 256).astype(np.int32)), pa.array(g), pa.array(h)], names=["node", "feature", "bin", "g", "h"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dense = len(nodes) * n_features <= 1 << 14              # 32 MB an array
        sums = np.zeros((2, len(nodes), n_features * 256) if dense else (2, 0, 0), np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            key, y, codes, margin = _rows(batch)
            use = np.flatnonzero(_drawn(key, index, float(p["subsample"]), int(p["seed"])))
            at = place[_route(codes[use], growing, depth)]
            use, at = use[at >= 0], at[at >= 0]
            if not len(use):
                continue
            codes = codes[use]
            prob = 1 / (1 + np.exp(-_margin(codes, margin[use], recent, depth)))
            # integers whose sums stay below 2**53 in a batch, so adding them as doubles is exact
            g, h = np.rint((prob - y[use]) * SCALE), np.rint(prob * (1 - prob) * SCALE)
            if not dense:
                cells, where = np.unique((at[:, None] * n_features + np.arange(n_features)) * 256 + codes, return_inverse=True)
                yield of_cells(cells, *[np.bincount(where.reshape(-1), np.repeat(v, n_features), len(cells)).astype(np.int64) for v in (g, h)])
                continue
            totals = [np.bincount(at, v, len(nodes)).astype(np.int64) for v in (g, h)]
            # only codes other than a feature's usual one are added one by one, the usual one gets the rest
            usual = np.array([np.bincount(c, minlength=256).argmax() for c in codes[:4096].T])
            row, f = np.nonzero(codes != usual)
            cell = (at[row] * n_features + f) * 256 + codes[row, f]
            most = np.arange(n_features) * 256 + usual
            for s, v, total in zip(sums, (g, h), totals):
                part = np.bincount(cell, v[row], s.size).astype(np.int64).reshape(len(nodes), n_features, 256)
                rest = total[:, None] - part.sum(axis=2)
                s += part.reshape(s.shape)
                s[:, most] += rest
        cells = np.flatnonzero(sums.any(axis=0).reshape(-1))
        yield of_cells(cells, *sums.reshape(2, -1)[:, cells])
    return run


def _score(g: Column, h: Column, p: Mapping) -> Column:
    """Twice the loss that a leaf with these sums takes off."""
    t = F.greatest(F.abs(g) - float(p["reg_alpha"]), F.lit(0.0))
    return t * t / (h + float(p["reg_lambda"]))


def split_gains(hist: DataFrame, p: Mapping) -> DataFrame:
    """Gain of every split: rows of ``hist`` (HIST, whole multiples of 1 / SCALE) up to ``bin`` go left, missing values (bin 0)
    left or right.  A split that leaves a child below ``min_child_weight`` or empty has NULL gain."""
    # the tasks have summed already, so one exchange serves the sums and the windows
    hist = hist.repartition("node", "feature").groupBy("node", "feature", "bin").agg(F.sum("g").alias("g"), F.sum("h").alias("h"))
    of = Window.partitionBy("node", "feature")
    upto = of.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    real = F.col("bin") > 0
    s = hist.select("node", "feature", "bin", F.sum("g").over(of).alias("G"), F.sum("h").over(of).alias("H"),
                    F.sum(F.when(real, F.col("g")).otherwise(0)).over(upto).alias("gl"), F.sum(F.when(real, F.col("h")).otherwise(0)).over(upto).alias("hl"),
                    F.sum(F.when(~real, F.col("g")).otherwise(0)).over(of).alias("gm"), F.sum(F.when(~real, F.col("h")).otherwise(0)).over(of).alias("hm"),
                    F.max("bin").over(of).alias("top"))
    s = s.withColumn("missing_left", F.explode(F.array(F.lit(False), F.lit(True))))
    s = s.select("node", "feature", "bin", "missing_left", "top", *[(F.col(c) / SCALE).alias(c) for c in ("G", "H")],
                 *[((F.col(a) + F.when(F.col("missing_left"), F.col(b)).otherwise(0)) / SCALE).alias(a) for a, b in (("gl", "gm"), ("hl", "hm"))])
    gr, hr = F.col("G") - F.col("gl"), F.col("H") - F.col("hl")
    gain = (_score(F.col("gl"), F.col("hl"), p) + _score(gr, hr, p) - _score(F.col("G"), F.col("H"), p)) * 0.5 - float(p["gamma"])
    fits = (F.col("bin") > 0) & (F.col("bin") < F.col("top")) & (F.col("hl") >= float(p["min_child_weight"])) & (hr >= float(p["min_child_weight"]))
    return s.withColumn("gain", F.when(fits, gain)).drop("top")


def _best(gains: DataFrame) -> list:
    """The best split of each node, ties to the lower feature and bin and to missing values right; one row per open node."""
    order = F.struct(F.round("gain", 9).alias("a"), (-F.col("feature")).alias("b"), (-F.col("bin")).alias("c"), (~F.col("missing_left")).alias("d"))
    what = F.struct("feature", "bin", "missing_left", "gl", "hl", "gain")
    return gains.groupBy("node").agg(F.max_by(what, F.when(F.col("gain").isNotNull(), order)).alias("s"), F.max("G").alias("G"), F.max("H").alias("H")).collect()


def _leaf(g: float, h: float, p: Mapping) -> float:
    t = max(abs(g) - float(p["reg_alpha"]), 0.0)
    return -float(p["learning_rate"]) * (t if g > 0 else -t) / (h + float(p["reg_lambda"])) if h + float(p["reg_lambda"]) > 0 else 0.0


def fit_booster(df: DataFrame, features: Sequence[str], label: str, key: str, params: Mapping | None = None, max_bins: int = 64,
                bounds: list[list[float]] | None = None) -> Booster:
    """Boosted trees over numeric ``features`` (NULL and NaN are missing) for a 0/1 ``label``; rows with a NULL label are left out.

    ``key`` names a row for the subsample of each tree.  Unknown parameters fail."""
    unknown = set(params or {}) - set(DEFAULTS)
    if unknown or (params is not None and not params):
        raise ValueError(f"unknown or empty model parameters: {sorted(unknown)}")
    if not 2 <= max_bins <= 255:
        raise ValueError("max_bins must lie between 2 and 255, as a bin number is one byte")
    p, spark = {**DEFAULTS, **(params or {})}, df.sparkSession
    features = list(features)
    rows = df.where(F.col(label).isNotNull())
    model = Booster(features, bounds or bin_bounds(rows, features, max_bins), dict(p))
    picked = rows.select(F.xxhash64(key).alias("key"), F.col(label).cast("double").alias("y"), *[F.col(f).cast("double").alias(f) for f in features])

    def kept(d: DataFrame) -> DataFrame:
        path = scratch_path(spark, "booster")
        d.write.parquet(path)
        return spark.read.schema(d.schema).parquet(path)

    schema = "key long, y double, codes binary, margin double"
    table = kept(picked.mapInArrow(_binned(features, model.bounds), schema))
    recent: list[Tree] = []
    depth = int(p["max_depth"])
    for index in range(int(p["n_estimators"])):
        tree = Tree.of_depth(depth)
        open_nodes = {1}
        for level in range(depth):
            hist = table.mapInArrow(_histogram(len(features), recent, tree, open_nodes, index, p), HIST)
            found = _best(split_gains(hist, p))
            following = set()
            for r in found:
                s, node = r["s"], r["node"]
                if level == 0:
                    tree.value[1] = _leaf(r["G"], r["H"], p)
                if s is None or s["gain"] <= 1e-9:
                    continue
                tree.feature[node], tree.bin[node], tree.missing_left[node], tree.value[node] = s["feature"], s["bin"], s["missing_left"], 0.0
                tree.value[2 * node] = _leaf(s["gl"], s["hl"], p)
                tree.value[2 * node + 1] = _leaf(r["G"] - s["gl"], r["H"] - s["hl"], p)
                following |= {2 * node, 2 * node + 1}
            if not following:
                break
            open_nodes = following
        model.trees.append(tree)
        recent.append(tree)
        if len(recent) == KEEP_EVERY and index + 1 < int(p["n_estimators"]):
            table, recent = kept(table.mapInArrow(_moved(recent, depth), schema)), []
    return model


def _moved(recent: Sequence[Tree], depth: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, _, codes, margin = _rows(batch)
            yield batch.set_column(3, "margin", pa.array(_margin(codes, margin, recent, depth)))
    return run


def predict_booster(model: Booster, df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """``keep`` columns and ``probability`` of class 1, in Arrow batches."""
    depth = int(model.params["max_depth"])

    @F.pandas_udf("double")
    def probability(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for cols in batches:
            codes = _codes(np.column_stack([c.to_numpy(np.float64, na_value=np.nan) for c in cols]), model.bounds)
            yield pd.Series(1 / (1 + np.exp(-_margin(codes, np.zeros(len(codes)), model.trees, depth))))

    return df.select(*keep, probability(*[F.col(f).cast("double") for f in model.features]).alias("probability"))


def booster_importance(model: Booster) -> dict[str, int]:
    """Number of splits on each feature."""
    used = [f for t in model.trees for f in t.feature if f >= 0]
    return {name: used.count(i) for i, name in enumerate(model.features)}


def root_gains(df: DataFrame, model: Booster, label: str, key: str) -> DataFrame:
    """Gain of every first split of ``model``'s next tree over ``df`` (feature by name, gain NULL where not allowed)."""
    rows = df.where(F.col(label).isNotNull()).select(F.xxhash64(key).alias("key"), F.col(label).cast("double").alias("y"),
                                                     *[F.col(f).cast("double").alias(f) for f in model.features])
    table = rows.mapInArrow(_binned(model.features, model.bounds), "key long, y double, codes binary, margin double")
    hist = table.mapInArrow(_histogram(
        len(model.features), model.trees, Tree.of_depth(int(model.params["max_depth"])), [1], len(model.trees), model.params), HIST)
    name = F.get(F.array(*map(F.lit, model.features)), F.col("feature"))
    return split_gains(hist, model.params).select(name.alias("feature"), "bin", "missing_left", "gl", "hl", "G", "H", "gain")


def booster_sweep(train: DataFrame, val: DataFrame, features: Sequence[str], label: str, key: str, grid: Mapping[str, Sequence],
                  draws: int = 1, seed: int = 42) -> DataFrame:
    """Seeded draws from the grid, each fitted on train and scored on validation by macro F1, best first.
    Bins are made once for all draws; every axis of the grid takes effect."""
    bounds = bin_bounds(train, features)
    rows = []
    for point in sample_grid(grid, draws, seed, skip=()):
        fitted = fit_booster(train, features, label, key, {**point, "subsample": 1.0, "seed": seed}, bounds=bounds)
        f1 = macro_f1_of(predict_booster(fitted, val, [label]), label).first()["macro_f1"]
        rows.append((*[float(point[k]) for k in grid], float(f1)))
    schema = ", ".join(f"{k} double" for k in grid) + ", macro_f1 double"
    return train.sparkSession.createDataFrame(rows, schema).orderBy(F.col("macro_f1").desc())
