"""Step chains (D2u) and the two end-to-end flows.

A ``Flow`` is an ordered list of named steps, each a function from the
flow state (a dict) to the new state.  Steps only build and write
DataFrames; each one is a distributed Spark job.  ``train_flow`` runs
ingest -> clean -> validate -> split -> encode -> train -> evaluate ->
validate model; ``predict_flow`` loads the saved model once and scores a
whole table into an idempotent sink.
"""

from __future__ import annotations

import os
import time
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalar import lead_score, predicted_label
from ..operators import clean, metrics, model, split, validate
from ..sources import readers
from ..sources.leads import nan_to_null

Step = Callable[[dict], dict]


@dataclass
class Flow:
    name: str
    steps: list[tuple[str, Step]] = field(default_factory=list)
    timings: dict[str, float] = field(default_factory=dict)

    def add_step(self, name: str, fn: Step) -> "Flow":
        self.steps.append((name, fn))
        return self

    def run(self, state: dict) -> dict:
        for name, fn in self.steps:
            t0 = time.perf_counter()
            state = fn(state)
            self.timings[name] = time.perf_counter() - t0
            if state.get("stop"):
                break
        return state


def chain(df: DataFrame, steps: Sequence[Callable[[DataFrame], DataFrame]]) -> DataFrame:
    """D2u for pure DataFrame steps: ``df.transform`` in order."""
    for s in steps:
        df = df.transform(s)
    return df


@dataclass
class TrainConfig:
    key: str = "lead_id"
    label: str = "converted"
    num_cols: Sequence[str] = ("total_visits", "time_on_website", "page_views_per_visit")
    cat_cols: Sequence[str] = ("lead_origin", "lead_source", "city", "last_activity")
    rules: Mapping[str, Mapping] | None = None
    params: Mapping | None = None
    folds: int = 5
    cutoff: float = 0.3          # validation cut-off (inclusive)


def train_flow(spark: SparkSession, source: DataFrame, out_dir: str,
               cfg: TrainConfig = TrainConfig()) -> Flow:
    """Build the training flow; ``flow.run({})`` executes it."""
    keep = [cfg.key, cfg.label, *cfg.num_cols, *cfg.cat_cols]

    def p(name: str) -> str:
        return os.path.join(out_dir, name)

    def ingest(st):
        st["ingest_record"] = readers.ingest(source, p("ingested"), "source")
        st["rows"] = st["ingest_record"].first()["rows"]
        st["stop"] = st["rows"] == 0                       # S14 guard: nothing written
        if not st["stop"]:
            st["data"] = spark.read.parquet(p("ingested"))
        return st

    def clean_step(st):
        readers.require_columns(st["data"], keep)           # S16 guard, no scan
        d = nan_to_null(clean.clean_infinities(st["data"]))
        d = clean.coerce_numeric(d, [c for c in cfg.num_cols
                                     if dict(d.dtypes).get(c) == "string"])
        d = clean.drop_incomplete(d.select(*keep))
        st["data"] = clean.dedupe_first(d, [cfg.key])
        return st

    def validate_step(st):
        if cfg.rules:
            status = validate.validation_status(st["data"], cfg.rules)
            validate.save_status(status, p("validation_status"))
            ok = validate.write_if_valid(st["data"], status, p("validated"))
            st["stop"] = not ok
            if ok:
                st["data"] = spark.read.parquet(p("validated"))
        return st

    def split_step(st):
        t = split.split_and_folds(st["data"], cfg.label, cfg.key, k=cfg.folds)
        readers.write_parquet(t, p("splits"), ["split"])
        st["tagged"] = spark.read.parquet(p("splits"))
        return st

    def train_step(st):
        tr = st["tagged"].where(F.col("split") == "train")
        m = model.fit_model(tr, cfg.num_cols, cfg.cat_cols, cfg.label, cfg.params)
        m.write().overwrite().save(p("model"))
        st["model"] = PipelineModel.load(p("model"))
        return st

    def evaluate_step(st):
        val = model.predict(st["model"], st["tagged"].where(F.col("split") == "val"),
                            [cfg.label])
        s = val.select(F.col(cfg.label).alias("label"), F.col("probability").alias("score"))
        sw = metrics.threshold_sweep(s, 100, strict=True)
        ev = metrics.scores_at_optimum(sw)
        readers.write_json(ev, p("evaluation"))
        st["optimal_threshold"] = ev.first()["optimal_threshold"]
        return st

    def validate_model_step(st):
        test = model.predict(st["model"], st["tagged"].where(F.col("split") == "test"),
                             [cfg.label])
        rep = model.validation_report(test, cfg.label, cfg.cutoff)
        readers.write_json(rep, p("validation"))
        st["report"] = spark.read.json(p("validation"))
        return st

    f = Flow("train")
    for name, fn in [("ingest", ingest), ("clean", clean_step), ("validate", validate_step),
                     ("split", split_step), ("train", train_step), ("evaluate", evaluate_step),
                     ("validate_model", validate_model_step)]:
        f.add_step(name, fn)
    return f


def predict_flow(spark: SparkSession, model_path: str, sink: str, key: str = "lead_id",
                 cutoff: float = 0.3, evaluation: str | None = None) -> Flow:
    """Load once, score the whole input, append new keys only.

    ``evaluation``: the evaluation record that the training flow wrote; the optimum in it (a
    score must exceed it) then replaces ``cutoff`` (a score must reach it)."""
    def load(st):
        st["model"] = PipelineModel.load(model_path)
        st["cutoff"] = cutoff
        if evaluation is not None:
            st["cutoff"] = spark.read.json(evaluation).first()["optimal_threshold"]
        return st

    def score(st):
        pr = model.predict(st["model"], st["data"], [key])
        out = pr.select(key, "probability",
                        predicted_label("probability", st["cutoff"], strict=evaluation is not None).alias("predicted_label"),
                        lead_score("probability").alias("lead_score"))
        st["written"] = readers.append_rows(out, sink, key=key)
        st["scores"] = spark.read.parquet(sink)
        return st

    return Flow("predict").add_step("load", load).add_step("score", score)
