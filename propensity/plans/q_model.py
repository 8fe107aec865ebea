"""Model queries (T1-T10, M3, E10, E11, S15, T8).  Fits are not
SQL-expressible, so these get the rows-only check; the pytest suite adds
quality assertions."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ..functions.scalar import lead_score, predicted_label
from ..operators import encode, metrics, model, split
from ..session import scratch_path
from ..sources import readers
from ..sources.leads import leads
from .catalog import query, rnd

NUM = ["total_visits", "time_on_website", "page_views_per_visit"]
CAT = ["lead_origin", "lead_source", "city", "last_activity"]
CUTOFF = 0.3


def _tagged(spark, sf):
    """Leads with split and fold from one ranking pass, written once: fits and scores
    read the table, and only the splits they need."""
    path = scratch_path(spark, "tagged")
    readers.write_parquet(split.split_and_folds(leads(spark, sf), "converted", "lead_id", k=5), path, ["split"])
    return spark.read.parquet(path)


@query("encode_features")
def q_encode_features(spark, sf):
    """Fit on train, save, load, transform every split."""
    t = _tagged(spark, sf)
    fitted = encode.feature_encoder(NUM, CAT, passthrough=["fold"]).fit(
        t.where(F.col("split") == "train"))
    path = scratch_path(spark, "feature_encoder")
    fitted.write().overwrite().save(path)
    loaded = PipelineModel.load(path)
    out = loaded.transform(t)
    return out.select("lead_id", "split", vector_to_array("features").alias("features"))


@query("train_gbt")
def q_train_gbt(spark, sf):
    """Boosted trees fitted on train; test-split predictions."""
    t = _tagged(spark, sf)
    m = model.fit_model(t.where(F.col("split") == "train"), NUM, CAT)
    return rnd(model.predict(m, t.where(F.col("split") == "test"), ["lead_id", "converted"]))


@query("train_logistic")
def q_train_logistic(spark, sf):
    """Logistic regression with the same feature stages."""
    t = _tagged(spark, sf)
    m = model.fit_model(t.where(F.col("split") == "train"), NUM, CAT, model="logistic")
    return rnd(model.predict(m, t.where(F.col("split") == "test"), ["lead_id", "converted"]))


@query("feature_importance")
def q_feature_importance(spark, sf):
    """T5/M5: importances named by vector slot, sorted descending."""
    t = _tagged(spark, sf)
    tr = t.where(F.col("split") == "train")
    m = model.fit_model(tr, NUM, CAT)
    return rnd(model.feature_importance(m, tr))


@query("cross_validate")
def q_cross_validate(spark, sf):
    """5-fold CV on the training split."""
    t = _tagged(spark, sf)
    return rnd(model.cross_validate(t.where(F.col("split") == "train"), NUM, CAT, parallelism=5))


@query("sweep")
def q_sweep(spark, sf):
    """One seeded draw from the reference grid, fitted on train and
    ranked by validation macro F1."""
    t = _tagged(spark, sf)
    return rnd(model.sweep(t.where(F.col("split") == "train"), t.where(F.col("split") == "val"),
                           NUM, CAT, draws=1))


@query("validate_model")
def q_validate_model(spark, sf):
    """CV mean on train, then test metrics at the fixed cut-off,
    confusion counts, ROC and PR areas."""
    t = _tagged(spark, sf)
    tr = t.where(F.col("split") == "train")
    cv = model.cross_validate(tr, NUM, CAT, parallelism=5).first()["mean_macro_f1"]
    m = model.fit_model(tr, NUM, CAT)
    pred = model.predict(m, t.where(F.col("split") == "test"), ["converted"])
    return rnd(model.validation_report(pred, threshold=CUTOFF, cv_mean=cv))


@query("batch_score")
def q_batch_score(spark, sf):
    """The saved model is loaded once and scores the whole
    table in one distributed pass (the reference loaded it per row)."""
    t = _tagged(spark, sf)
    m = model.fit_model(t.where(F.col("split") == "train"), NUM, CAT)
    path = scratch_path(spark, "lead_model")
    m.write().overwrite().save(path)
    loaded = PipelineModel.load(path)
    p = model.predict(loaded, t, ["lead_id"])
    return rnd(p.select("lead_id", "probability", "prediction",
                        predicted_label("probability", CUTOFF, strict=False).alias("predicted_label"),
                        lead_score("probability").alias("lead_score")))


@query("evaluate_model")
def q_evaluate_model(spark, sf):
    """Model probabilities on validation -> 101-point sweep -> optimal
    cut-off -> F1/precision/recall/accuracy there."""
    t = _tagged(spark, sf)
    m = model.fit_model(t.where(F.col("split") == "train"), NUM, CAT)
    val = model.predict(m, t.where(F.col("split") == "val"), ["converted"])
    s = val.select(F.col("converted").alias("label"), F.col("probability").alias("score"))
    return rnd(metrics.scores_at_optimum(metrics.threshold_sweep(s, 100, strict=True)))


@query("train_flow")
def q_train_flow(spark, sf):
    """D2u: the whole training flow as named steps; returns the test report."""
    from .flows import TrainConfig, train_flow
    cfg = TrainConfig(rules={
        "lead_id": {"type": "integer"},
        "converted": {"type": "integer", "minimum": 0, "maximum": 1},
        "total_visits": {"type": "float", "minimum": 0, "maximum": 300},
        "time_on_website": {"type": "float", "minimum": 0, "maximum": 3000},
        "page_views_per_visit": {"type": "float", "minimum": 0, "maximum": 70},
        "lead_origin": {"type": "string"}, "lead_source": {"type": "string"},
        "city": {"type": "string"}, "last_activity": {"type": "string"}})
    st = train_flow(spark, leads(spark, sf), scratch_path(spark, "train_flow"), cfg).run({})
    if st.get("stop"):
        raise RuntimeError("training flow stopped early")
    return st["report"]


@query("predict_flow")
def q_predict_flow(spark, sf):
    """A saved model scores the whole lead table, at the cut-off tuned on the
    validation split, into an idempotent sink; running the flow twice writes each lead once."""
    from .flows import predict_flow
    t = _tagged(spark, sf)
    m = model.fit_model(t.where(F.col("split") == "train"), NUM, CAT)
    path = scratch_path(spark, "flow_model")
    m.write().overwrite().save(path)
    sink = scratch_path(spark, "flow_scores")
    val = model.predict(m, t.where(F.col("split") == "val"), ["converted"])
    s = val.select(F.col("converted").alias("label"), F.col("probability").alias("score"))
    found = scratch_path(spark, "flow_evaluation")
    readers.write_json(metrics.scores_at_optimum(metrics.threshold_sweep(s, 100, strict=True)), found)
    flow = predict_flow(spark, path, sink, evaluation=found)
    flow.run({"data": t})
    st = flow.run({"data": t})
    return rnd(st["scores"])


@query("importance_tail")
def q_importance_tail(spark, sf):
    """M5: positions 20..40 of the importance table sorted descending (the
    weakest features, candidates for removal)."""
    t = _tagged(spark, sf)
    tr = t.where(F.col("split") == "train")
    m = model.fit_model(tr, NUM, CAT)
    return rnd(split.sorted_slice(model.feature_importance(m, tr), "importance", 20, 41, tie_cols=["feature"]))
