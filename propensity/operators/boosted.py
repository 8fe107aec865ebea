"""T1 over many rows: the trees of Spark ML's ``GBTClassifier``, grown on compact binned rows.

``GBTClassifier`` keeps each row as an object of one number per one-hot slot and touches every slot at every level.  Here a
row is a few bytes: a numeric column is its bin, a categorical column its level (all its one-hot slots at once), and
columns of few bins share one code.  A level is one job: tasks route their rows through the tree grown so far and
sum weight, target and squared target per (node, code); the driver picks the splits.  The trees are the same as those of
``GBTClassifier`` but for the order in which doubles are summed: same split candidates (same sampled rows), same rows
drawn for each tree (same generator), same gains, ties, stopping and pruning rules.  The result is a ``GBTClassificationModel``.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

import numpy as np
from pyspark import RDD, StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.util import DefaultParamsWriter
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .boosted_rows import Columns, Grown, first_margins, next_margins, packed, sums_of, targets, xorshift_int

#: Most rows that one task gets.
TASK_ROWS = 4_000_000
#: Blocks are kept as the bytes they are: PySpark's own levels serialize and compress them once more.
KEPT = StorageLevel(True, True, False, True, 1)
#: Most bytes of sums that a level's tasks send to the driver at once.
SUMS = 64 << 20
#: Margins are written to the checkpoint folder after so many trees.
KEEP_EVERY = 10
LEAST_GAIN, EPSILON = -np.finfo(np.float64).max, 2.220446049250313e-16
#: Gains that differ by less than this part of a node's variance are a tie (sums of doubles are exact to about 1e-16).
TIE = 1e-11


def thresholds_of(values: np.ndarray, expected: float, max_splits: int) -> list[float]:
    """Split candidates of one numeric column from its sampled values, of which there should be ``expected``."""
    values = values[values != 0.0]
    if not len(values):
        return []
    found, counts = np.unique(values, return_counts=True)
    missing = expected - len(values)                      # the values that are 0, as far as they can be told
    if missing > EPSILON * len(values) * 100:
        at = int(np.searchsorted(found, 0.0))
        found, counts = np.insert(found, at, 0.0), np.insert(counts.astype(np.float64), at, missing)
    middles = (found[:-1] + found[1:]) / 2.0
    if len(middles) <= max_splits:
        return middles.tolist()
    stride, out, now = expected / (max_splits + 1), [], float(counts[0])
    target = stride
    for i in range(1, len(found)):
        before, now = now, now + float(counts[i])
        if abs(before - target) < abs(now - target):
            out.append(float(middles[i - 1]))
            target += stride
    return out


def _variance(n, s, q):
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(n > 0, (q - s * s / n) / n, 0.0)


def _best_splits(sums: np.ndarray, columns: Columns, parents: Sequence[tuple | None], least_rows: int, least_gain: float):
    """The split of most gain of each node, ties to the lower slot and bin: (slot, cut, gain, stats, left, right, valid)."""
    k = len(columns.thresholds)
    lefts, totals, slots, cuts = [], [], [], []
    for c, t in enumerate(columns.thresholds):
        if t:
            upto = sums[:, :, columns.first[c]:columns.first[c + 1]].cumsum(axis=2)
            lefts.append(upto[:, :, :-1])
            totals.append(np.broadcast_to(upto[:, :, -1:], lefts[-1].shape))
            slots += [c] * len(t)
            cuts.append(np.broadcast_to(np.arange(len(t)), lefts[-1].shape[1:]))
    slot = k
    for i, n in enumerate(columns.levels):
        all_levels = sums[:, :, columns.first[k + i]:columns.first[k + i + 1]]
        total = all_levels.sum(axis=2, keepdims=True)
        one = all_levels[:, :, :n]
        zero = total - one
        zero[:, zero[0] == 0] = 0.0
        with np.errstate(divide="ignore", invalid="ignore"):
            mean = [np.where(s[0] > 0, s[1] / s[0], np.finfo(np.float64).max) for s in (zero, one)]
        first = mean[1] < mean[0]                          # the level's rows go left where their mean is lower
        lefts.append(np.where(first, one, zero))
        totals.append(np.broadcast_to(total, one.shape))
        slots += range(slot, slot + n)
        cuts.append(first.astype(np.int64))
        slot += n
    if not slots:
        total = sums[:, :, columns.first[0]:columns.first[1]].sum(axis=2)
        return [(-1, -1, LEAST_GAIN, tuple(total[:, i]) if p is None else p, None, None, False) for i, p in enumerate(parents)]
    left, total, cut = np.concatenate(lefts, axis=2), np.concatenate(totals, axis=2), np.concatenate(cuts, axis=1)
    right = total - left
    of = np.array([total[:, i, 0] if p is None else p for i, p in enumerate(parents)]).T[:, :, None]
    n = left[0] + right[0]
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = _variance(*of) - left[0] / n * _variance(*left) - right[0] / n * _variance(*right)
    gain[~((left[0] >= least_rows) & (right[0] >= least_rows) & (gain >= least_gain))] = LEAST_GAIN
    out = []
    for i, j in enumerate((gain >= gain.max(axis=1, keepdims=True) - TIE * _variance(*of)).argmax(axis=1)):
        out.append((slots[j], int(cut[i, j]), float(gain[i, j]), tuple(of[:, i, 0]), tuple(left[:, i, j]), tuple(right[:, i, j]), gain[i, j] != LEAST_GAIN))
    return out


def _grow(rows: RDD, tasks: int, columns: Columns, est: GBTClassifier) -> Grown:
    tree, opened = Grown(), [0]
    tree.add((0.0, 0.0, 0.0))
    at_once = max(1, SUMS // (tasks * 24 * int(columns.first[-1])))
    for level in range(est.getMaxDepth()):
        found = []
        for i in range(0, len(opened), at_once):
            nodes = opened[i:i + at_once]
            parts = rows.mapPartitions(sums_of(columns, tree, nodes)).collect()
            found += _best_splits(np.sum(parts, axis=0), columns, [tree.stats[x] if level else None for x in nodes],
                                  est.getMinInstancesPerNode(), est.getMinInfoGain())
        following = []
        for node, (slot, cut, gain, stats, left, right, valid) in zip(opened, found):
            tree.stats[node], tree.valid[node] = tuple(float(x) for x in stats), valid
            if gain <= 0:
                continue
            tree.slot[node], tree.cut[node], tree.gain[node] = slot, cut, gain
            tree.left[node] = tree.add(left)
            tree.add(right)
            following += [c for c, s in ((tree.left[node], left), (tree.left[node] + 1, right)) if abs(_variance(*map(np.float64, s))) >= EPSILON]
        if tree.left[0] >= 0 and any(tree.slot[x] >= 0 for x in opened):
            tree.depth = level + 1
        opened = following
        if not opened:
            break
    return tree


def _nodes(tree: Grown, columns: Columns) -> list[tuple]:
    """Nodes in Spark ML's saved form; children that predict the same are merged into their parent."""
    merged: dict[int, float] = {}
    for node in range(len(tree.slot) - 1, -1, -1):         # children are made after their parent
        if tree.slot[node] < 0:
            merged[node] = tree.value(node)
        else:
            a, b = tree.left[node], tree.left[node] + 1
            if a in merged and b in merged and merged[a] == merged[b]:
                merged[node] = merged[a]
    out: list[tuple] = []

    def add(node: int) -> int:
        at, stats = len(out), tree.stats[node]
        impurity = float(_variance(*map(np.float64, stats)))
        if node in merged:
            if tree.slot[node] < 0 and not tree.valid[node]:
                impurity = -1.0
            out.append((at, merged[node], impurity, list(stats), int(stats[0]), -1.0, -1, -1, (-1, [], -1)))
            return at
        out.append(())
        column, level = columns.slots[tree.slot[node]]
        split = (tree.slot[node], [columns.thresholds[column][tree.cut[node]]], -1) if level < 0 else (tree.slot[node], [float(tree.cut[node])], 2)
        a = add(tree.left[node])
        b = add(tree.left[node] + 1)
        out[at] = (at, tree.value(node), impurity, list(stats), int(stats[0]), tree.gain[node], a, b, split)
        return at

    add(0)
    return out


NODES = ("treeID int, nodeData struct<id:int, prediction:double, impurity:double, impurityStats:array<double>, rawCount:bigint, gain:double, "
         "leftChild:int, rightChild:int, split:struct<featureIndex:int, leftCategoriesOrThreshold:array<double>, numCategories:int>>")
#: Parameters of the classifier that its trees have too.
OF_TREE = ("cacheNodeIds", "checkpointInterval", "featuresCol", "impurity", "labelCol", "leafCol", "maxBins", "maxDepth", "maxMemoryInMB",
           "minInfoGain", "minInstancesPerNode", "minWeightFractionPerNode", "predictionCol", "seed")


def _model(spark: SparkSession, est: GBTClassifier, trees: Sequence[list[tuple]], n_features: int) -> GBTClassificationModel:
    """The fitted model, by way of its saved form."""
    path = scratch_path(spark, "boosted")
    about = json.loads(DefaultParamsWriter._get_metadata_to_save(est, spark, extraMetadata={"numFeatures": n_features, "numTrees": len(trees)}))
    about["class"] = "org.apache.spark.ml.classification.GBTClassificationModel"
    spark.createDataFrame([(json.dumps(about),)], "value string").coalesce(1).write.text(f"{path}/metadata")
    of_tree = {k: {p: v for p, v in about[k].items() if p in OF_TREE} for k in ("paramMap", "defaultParamMap")}
    names = "_1 int, _2 string, _3 double" if tuple(map(int, spark.version.split(".")[:2])) >= (4, 1) else "treeID int, metadata string, weights double"
    metas = [(i, json.dumps({"class": "org.apache.spark.ml.regression.DecisionTreeRegressionModel", "timestamp": about["timestamp"], "sparkVersion": about["sparkVersion"],
                             "uid": f"dtr_{uuid.uuid4().hex[:12]}", **of_tree}), 1.0 if i == 0 else est.getStepSize()) for i in range(len(trees))]
    spark.createDataFrame(metas, names).coalesce(1).write.parquet(f"{path}/treesMetadata")
    spark.createDataFrame([(i, n) for i, t in enumerate(trees) for n in t], NODES).coalesce(1).write.parquet(f"{path}/data")
    return GBTClassificationModel.load(path)


def _delete(spark: SparkSession, path: str | None) -> None:
    if path:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def fit_boosted(encoder: PipelineModel, data: DataFrame, total: int, numbers: Sequence[str], categories: Sequence[tuple[str, int]],
                label: str, est: GBTClassifier) -> GBTClassificationModel:
    """``est`` fitted on the ``total`` rows of ``data``, which the encoder turns into ``numbers`` and level numbers of
    ``categories`` (name, levels).  ``data`` must keep its partitions and their order, which decide the rows drawn."""
    spark = data.sparkSession
    names = [*numbers, *[c for c, _ in categories]]
    rows = PipelineModel(encoder.stages[:-2]).transform(data).select(label, *[F.col(c).cast("double").alias(c) for c in names])

    most = min(est.getMaxBins(), total)
    needed = max(most * most, 10_000)
    share = needed / total if needed < total else 1.0
    sample = rows.select(*numbers)
    if share < 1.0:
        picked = sample._jdf.toJavaRDD().sample(False, share, xorshift_int(est.getSeed()))
        sample = DataFrame(spark._jsparkSession.createDataFrame(picked, sample._jdf.schema()), spark)
    seen = sample.toPandas()
    columns = Columns([thresholds_of(seen[c].to_numpy(np.float64), share * total, most - 1) for c in numbers], [n for _, n in categories])

    blocks = rows.mapInArrow(packed(columns, label, names), "start long, y binary, codes binary")
    parts = data.rdd.getNumPartitions()
    tasks = min(parts, max(spark.sparkContext.defaultParallelism, -(-total // TASK_ROWS)))
    margins = blocks.rdd.mapPartitionsWithIndex(first_margins(columns)).coalesce(tasks).persist(KEPT)
    margins.checkpoint()
    kept, trees = margins, []
    for index in range(est.getMaxIter()):
        if index:
            after = margins.mapPartitions(next_margins(columns, trees[-1], 1.0 if index == 1 else est.getStepSize())).persist(KEPT)
            if index % KEEP_EVERY == 0:
                after.checkpoint()
        else:
            after = margins
        drawn_rows = after.mapPartitions(targets(index, est.getSubsamplingRate(), est.getSeed())).persist(KEPT)
        trees.append(_grow(drawn_rows, tasks, columns, est))
        drawn_rows.unpersist()
        if not index:
            data.unpersist()                               # the blocks are in the checkpoint folder now
        if after is not margins:
            margins.unpersist()
            if index % KEEP_EVERY == 0:
                _delete(spark, kept.getCheckpointFile())
                kept = after
        margins = after
    margins.unpersist()
    _delete(spark, kept.getCheckpointFile())
    return _model(spark, est, [_nodes(t, columns) for t in trees], len(columns.slots))
