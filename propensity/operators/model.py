"""Model operators (T1-T10, M3, P10) on Spark ML.

Training reads a split-tagged table; every fit is a distributed Spark ML
job and every evaluation is a DataFrame aggregate from ``metrics`` /
``curves`` (no collect of predictions).  The boosted-tree classifier is
``GBTClassifier``; the reference's L1/L2 leaf penalties and child-weight
minimum have no GBT counterpart (see README).
"""

from __future__ import annotations

import itertools
import random
from collections.abc import Mapping, Sequence

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from . import curves, metrics
from .boosted import fit_boosted
from .encode import encoded_columns, feature_encoder

# Default boosted-tree settings (trees, depth, learning rate,
# row subsample, seed) and the sweep grid of the reference.
NO_EFFECT = ("reg_alpha", "reg_lambda")      # no counterpart in GBTClassifier
GBT_DEFAULTS = {"n_estimators": 100, "max_depth": 6, "learning_rate": 0.3,
                "subsample": 0.8, "gamma": 0.0, "seed": 42}
# Partitions of the training rows: at least so many, and one for so many rows.
LEAST_PARTS, PART_ROWS = 8, 100_000
# From so many rows on, boosted trees are grown on binned rows (operators/boosted.py): the same trees in less time
# (below, the jobs of either way are too short to tell).
BINNED_ROWS = 500_000
SWEEP_GRID = {
    "n_estimators": [100, 200, 300],
    "max_depth": [3, 5, 7, 10],
    "learning_rate": [0.01, 0.1, 1],
    "reg_alpha": [0.01, 0.1, 1],
    "min_child_weight": [1, 3, 5],
    "gamma": [0, 0.1, 1],
    "reg_lambda": [1, 2, 5],
}


def gbt(label: str = "converted", features: str = "features",
        params: Mapping | None = None) -> GBTClassifier:
    """Boosted trees.  gamma -> minInfoGain, min_child_weight ->
    minInstancesPerNode (closest analogues); alpha/lambda have none."""
    if params is not None and not params:
        raise ValueError("empty model parameters")
    p = {**GBT_DEFAULTS, **(params or {})}
    return GBTClassifier(
        labelCol=label, featuresCol=features, maxIter=int(p["n_estimators"]),
        maxDepth=int(p["max_depth"]), stepSize=float(p["learning_rate"]),
        subsamplingRate=float(p.get("subsample", 1.0)), featureSubsetStrategy="all",
        minInfoGain=float(p.get("gamma", 0.0)),
        minInstancesPerNode=int(p.get("min_child_weight", 1)),
        seed=int(p.get("seed", 42)))


def logistic(label: str = "converted", features: str = "features") -> LogisticRegression:
    """The model the reference's text describes."""
    return LogisticRegression(labelCol=label, featuresCol=features, maxIter=100)


def fit_model(train: DataFrame, num_cols: Sequence[str], cat_cols: Sequence[str],
                   label: str = "converted", params: Mapping | None = None,
                   model: str = "gbt") -> PipelineModel:
    """E10 + T1 as one ``PipelineModel`` fitted on the training rows."""
    est = gbt(label, params=params) if model == "gbt" else logistic(label)
    # each stage fit reads the input again: keep the projected training rows
    # (memory, spilling to disk) until they are encoded
    used = list(dict.fromkeys([*num_cols, *cat_cols, label]))
    # trees draw their subsample by a row's place: rows are dealt by a hash of their values and
    # sorted, so that equal data gives equal models however it was shuffled before
    # a boosted fit is hundreds of short jobs, each two tasks a partition: no more partitions than the rows need
    total = train.count()
    parts = min(int(train.sparkSession.conf.get("spark.sql.shuffle.partitions")),
                max(LEAST_PARTS, -(-total // PART_ROWS)))
    data = train.select(*used).repartition(parts, *used).sortWithinPartitions(*used).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        encoder = feature_encoder(num_cols, cat_cols).fit(data)
        if model == "gbt" and total >= BINNED_ROWS and est.getMaxDepth() > 0 and est.getMaxIter() > 0:
            ensure_checkpoint_dir(train.sparkSession)
            numbers, categories = encoded_columns(encoder)
            return PipelineModel(encoder.stages + [fit_boosted(encoder, data, total, numbers, categories, label, est)])
        # a boosted fit is one job a level: its tasks carry the plan of their input, so the
        # encoded rows are checkpointed (same partitions, same order) and the plan ends there
        ensure_checkpoint_dir(train.sparkSession)
        rows = encoder.transform(data).select("features", label).checkpoint(eager=True)
    finally:
        data.unpersist()
    return _without_training_summary(PipelineModel(encoder.stages + [est.fit(rows)]))


def _without_training_summary(fitted: PipelineModel) -> PipelineModel:
    """A model that keeps its training summary also keeps a reference to the
    session; once the session has used an ``Observation`` that reference is
    no longer serializable and ``transform`` fails (logistic regression).
    The saved-and-loaded model has no summary, so round-trip it through the
    shared checkpoint folder."""
    if not any(getattr(st, "hasSummary", False) for st in fitted.stages):
        return fitted
    from ..session import scratch_path
    spark = SparkSession.getActiveSession()
    path = scratch_path(spark, "model_nosummary")
    fitted.write().overwrite().save(path)
    return PipelineModel.load(path)


def predict(model: PipelineModel, df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Positive-class probability and the 0.5 class label."""
    out = model.transform(df)
    return out.select(*keep, vector_to_array("probability")[1].alias("probability"),
                      F.col("prediction").cast("int").alias("prediction"))


def feature_names(model: PipelineModel, df: DataFrame, features: str = "features") -> list[str]:
    """Names of the assembled vector slots (from the ML attribute metadata)."""
    meta = model.transform(df.limit(0)).schema[features].metadata
    attrs = meta.get("ml_attr", {}).get("attrs", {})
    slots = {}
    for group in attrs.values():
        for a in group:
            slots[a["idx"]] = a["name"]
    return [slots[i] for i in sorted(slots)]


def feature_importance(model: PipelineModel, df: DataFrame) -> DataFrame:
    """T5: (feature, importance) sorted descending."""
    imp = model.stages[-1].featureImportances.toArray().tolist()
    names = feature_names(model, df)
    rows = list(zip(names, [float(x) for x in imp]))
    spark = df.sparkSession
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(
        F.col("importance").desc(), "feature")


def macro_f1_of(pred: DataFrame, label: str) -> DataFrame:
    """A17 on class predictions (cut-off 0.5 on the probability)."""
    return metrics.macro_weighted_f1(pred.withColumnRenamed(label, "label"),
                                     threshold=0.5, strict=True, score="probability")


def _run_parallel(fn, items, parallelism: int):
    """Fit several models as concurrent Spark jobs (as Spark's own
    ``CrossValidator(parallelism=n)`` does); results keep the input order."""
    if parallelism <= 1 or len(items) <= 1:
        return [fn(x) for x in items]
    from multiprocessing.pool import ThreadPool

    from pyspark.util import inheritable_thread_target
    with ThreadPool(min(parallelism, len(items))) as pool:
        return pool.map(inheritable_thread_target(fn), items)


def cross_validate(train: DataFrame, num_cols, cat_cols, label: str = "converted",
                   fold_col: str = "fold", params: Mapping | None = None,
                   parallelism: int = 1) -> DataFrame:
    """Fit on k-1 folds of the TRAINING split, score the held-out
    fold (the reference refitted on test folds, D10); per-fold macro F1 and
    the mean over folds.  Folds can be fitted concurrently."""
    folds = sorted(r[0] for r in train.select(fold_col).distinct().collect())
    spark = train.sparkSession

    def one(k):
        m = fit_model(train.where(F.col(fold_col) != k), num_cols, cat_cols, label, params)
        held = predict(m, train.where(F.col(fold_col) == k), [label])
        return int(k), float(macro_f1_of(held, label).first()["macro_f1"])

    rows = _run_parallel(one, folds, parallelism)
    out = spark.createDataFrame(rows, "fold int, macro_f1 double")
    return out.withColumn("mean_macro_f1", F.avg("macro_f1").over(Window.partitionBy()))


def sample_grid(grid: Mapping[str, Sequence], draws: int, seed: int = 42,
                skip: Sequence[str] = NO_EFFECT) -> list[dict]:
    """Seeded random draws from the grid of the parameters that take effect
    (without replacement, so no two draws are the same fit)."""
    keys = [k for k in grid if k not in skip]
    points = list(itertools.product(*[grid[k] for k in keys]))
    rng = random.Random(seed)
    picked = rng.sample(points, min(draws, len(points)))
    return [dict(zip(keys, p)) for p in picked]


def sweep(train: DataFrame, val: DataFrame, num_cols, cat_cols, label: str = "converted",
          grid: Mapping[str, Sequence] = SWEEP_GRID, draws: int = 1,
          seed: int = 42, parallelism: int = 1) -> DataFrame:
    """Each drawn point is fitted on train and scored on validation by
    macro F1; returns the result table, best first.  Grid parameters without
    effect here (``NO_EFFECT``) come back as NULL; all rows are used by each tree."""
    spark = train.sparkSession

    def one(p):
        m = fit_model(train, num_cols, cat_cols, label, dict(p, subsample=1.0, seed=seed))
        f1 = macro_f1_of(predict(m, val, [label]), label).first()["macro_f1"]
        return (int(p["n_estimators"]), int(p["max_depth"]), float(p["learning_rate"]),
                None, int(p["min_child_weight"]), float(p["gamma"]), None, float(f1))

    rows = _run_parallel(one, sample_grid(grid, draws, seed), parallelism)
    schema = ("n_estimators int, max_depth int, learning_rate double, reg_alpha double, "
              "min_child_weight int, gamma double, reg_lambda double, macro_f1 double")
    return spark.createDataFrame(rows, schema).orderBy(F.col("macro_f1").desc())


def validation_report(pred: DataFrame, label: str = "converted", threshold: float = 0.3,
                      cv_mean: float | None = None) -> DataFrame:
    """Test metrics at the fixed inclusive cut-off, confusion counts and
    both curve areas, as a long (metric, value) table."""
    s = pred.select(F.col(label).alias("label"), F.col("probability").alias("score"))
    bm = metrics.binary_metrics(s, threshold, strict=False)
    auc = curves.roc_auc(s)
    pr = curves.pr_auc(s)
    names = ["accuracy", "precision", "recall", "f1", "tn", "fp", "fn", "tp"]
    long = bm.select(F.inline(F.array(*[F.struct(F.lit(n).alias("metric"),
                                                 F.col(n).cast("double").alias("value"))
                                        for n in names])))
    long = long.unionByName(auc.select(F.lit("roc_auc").alias("metric"),
                                       F.col("roc_auc").alias("value")))
    long = long.unionByName(pr.select(F.lit("pr_auc").alias("metric"),
                                      F.col("pr_auc").alias("value")))
    if cv_mean is not None:
        long = long.unionByName(pred.sparkSession.range(1).select(
            F.lit("cv_mean_macro_f1").alias("metric"), F.lit(float(cv_mean)).alias("value")))
    return long


def score_one(model: PipelineModel, spark, doc: Mapping, schema) -> DataFrame:
    """One lead (a dict) as a one-row DataFrame through the same
    loaded model; batches should call ``predict`` on the whole table."""
    return predict(model, spark.createDataFrame([dict(doc)], schema), list(doc))
