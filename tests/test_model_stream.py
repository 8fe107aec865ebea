import pytest
from pyspark.sql import functions as F

from helpers import SF_MID
from propensity.operators import curves, model, split
from propensity.sources.leads import leads

NUM = ["total_visits", "time_on_website", "page_views_per_visit"]
CAT = ["lead_origin", "lead_source", "city", "last_activity"]


@pytest.fixture(scope="module")
def tagged(spark):
    return split.split_and_folds(leads(spark, SF_MID), "converted", "lead_id").cache()


def test_gbt_quality_and_importance(spark, tagged):
    m = model.fit_model(tagged.where("split = 'train'"), NUM, CAT, params={"n_estimators": 10})
    pred = model.predict(m, tagged.where("split = 'test'"), ["converted"])
    auc = curves.roc_auc(pred.select(F.col("converted").alias("label"),
                                     F.col("probability").alias("score"))).first().roc_auc
    assert 0.6 < auc <= 1.0
    imp = model.feature_importance(m, tagged.where("split = 'train'")).collect()
    assert len(imp) == 3 + 5 + 5 + 25 + 3
    assert sum(r.importance for r in imp) == pytest.approx(1.0)


def test_sweep_grid_draw_is_seeded():
    a = model.sample_grid(model.SWEEP_GRID, 3, seed=42)
    assert a == model.sample_grid(model.SWEEP_GRID, 3, seed=42)
    assert len({tuple(p.items()) for p in a}) == 3
    n = 1
    for v in model.SWEEP_GRID.values():
        n *= len(v)
    assert n == 2916


def test_stream_scores_each_lead_once(spark):
    from propensity.plans.q_io import _run_stream
    sink, record = _run_stream(spark, "/root/testdata/sf0.001")
    out = spark.read.parquet(sink)
    n = leads(spark, "/root/testdata/sf0.001").count()
    assert out.count() == n and out.select("lead_id").distinct().count() == n
    rec = spark.read.parquet(record).agg(F.sum("rows_written")).first()[0]
    assert rec == n


def test_stream_restart_is_exactly_once(spark, tmp_path):
    """Re-running the stream on the same checkpoint writes nothing; new files
    (including leads already in the sink) only add the new leads."""
    from propensity.plans.q_io import _score_batch
    from propensity.streaming.scoring import score_stream
    d = leads(spark, "/root/testdata/sf0.001")
    src, sink, ck = (str(tmp_path / x) for x in ("src", "sink", "ck"))
    first = d.where(F.col("lead_origin") != "5-LOW")
    first.write.parquet(src)
    score_stream(spark, src, d.schema, _score_batch, sink, ck)
    n1 = spark.read.parquet(sink).count()
    assert n1 == first.count()
    score_stream(spark, src, d.schema, _score_batch, sink, ck)          # nothing new
    assert spark.read.parquet(sink).count() == n1
    d.write.mode("append").parquet(src)                                  # all leads again
    score_stream(spark, src, d.schema, _score_batch, sink, ck)
    out = spark.read.parquet(sink)
    assert out.count() == d.count() == out.select("lead_id").distinct().count()


def test_document_collection_scan_and_batches(spark, tmp_path):
    """A JSON document collection with a store key; batches with
    different fields are appended by name."""
    from propensity.sources import readers
    a = spark.createDataFrame([("x1", 1, "API", 2.0)], "_id string, lead_id long, lead_origin string, v double")
    b = spark.createDataFrame([("x2", 2, 3.0)], "_id string, lead_id long, v double")
    a.write.json(str(tmp_path / "a"))
    b.write.json(str(tmp_path / "b"))
    ra = readers.read_collection(spark, str(tmp_path / "a"), "json")
    rb = readers.read_collection(spark, str(tmp_path / "b"), "json")
    out = readers.union_batches([ra, rb])
    assert "_id" not in out.columns
    got = sorted((r.lead_id, r.lead_origin, r.v) for r in out.collect())
    assert got == [(1, "API", 2.0), (2, None, 3.0)]
    with pytest.raises(ValueError):
        readers.require_columns(out, ["lead_id", "missing_col"])
    assert readers.is_empty(out.where("lead_id > 5"))


def test_parallel_cv_equals_sequential(spark):
    t = split.split_and_folds(leads(spark, "/root/testdata/sf0.001"), "converted", "lead_id", k=3)
    tr = t.where("split = 'train'")
    a = model.cross_validate(tr, NUM, CAT, params={"n_estimators": 3}, parallelism=1).collect()
    b = model.cross_validate(tr, NUM, CAT, params={"n_estimators": 3}, parallelism=3).collect()
    assert sorted(tuple(r) for r in a) == sorted(tuple(r) for r in b)


def test_score_one_lead_matches_batch(spark, tagged):
    m = model.fit_model(tagged.where("split = 'train'"), NUM, CAT, params={"n_estimators": 3})
    row = tagged.where("split = 'test'").select("lead_id", *NUM, *CAT).limit(1).collect()[0]
    schema = tagged.select("lead_id", *NUM, *CAT).schema
    one = model.score_one(m, spark, row.asDict(), schema).first()
    batch = model.predict(m, tagged.where(F.col("lead_id") == row.lead_id), ["lead_id"]).first()
    assert one.probability == pytest.approx(batch.probability)


def test_scalar_helpers(spark):
    from propensity.functions import scalar as X
    r = spark.range(1).select(
        X.grid(10, 9).alias("g"), X.abs_diff(F.lit(0.2), F.lit(0.5)).alias("d"),
        X.iso_time(F.lit("2024-01-02 03:04:05").cast("timestamp")).alias("t")).first()
    assert r.g == [i / 10 for i in range(10)]
    assert r.d == pytest.approx(0.3)
    assert r.t == "2024-01-02T03:04:05.000000"


def test_logistic_after_observation(spark, tagged):
    """An Observation earlier in the session must not break model transform."""
    from pyspark.sql import Observation
    o = Observation("obs_before_lr")
    tagged.observe(o, F.count(F.lit(1))).limit(1).collect()
    m = model.fit_model(tagged.where("split = 'train'"), NUM, CAT, model="logistic")
    assert model.predict(m, tagged.where("split = 'test'"), ["lead_id"]).count() > 0


def test_train_flow_stops_on_empty_input(spark, tmp_path):
    from propensity.plans.flows import train_flow
    empty = leads(spark, "/root/testdata/sf0.001").where("lead_id < 0")
    st = train_flow(spark, empty, str(tmp_path / "flow")).run({})
    assert st["stop"] and st["rows"] == 0 and "model" not in st


def test_train_flow_writes_status_and_metrics(spark, tmp_path):
    """The flow writes the validation status, evaluation scores,
    the split table and the model; every step is timed."""
    from propensity.plans.flows import TrainConfig, train_flow
    rules = {"lead_id": {"type": "integer"},
             "converted": {"type": "integer", "minimum": 0, "maximum": 1},
             **{c: {"type": "float"} for c in NUM}, **{c: {"type": "string"} for c in CAT}}
    out = str(tmp_path / "flow")
    f = train_flow(spark, leads(spark, "/root/testdata/sf0.001"), out,
                   TrainConfig(params={"n_estimators": 3}, rules=rules))
    st = f.run({})
    assert not st.get("stop")
    status = spark.read.json(out + "/validation_status").collect()
    assert {r.status for r in status} == {"Valid"}
    ev = spark.read.json(out + "/evaluation").first()
    assert 0.0 <= ev.optimal_threshold <= 1.0
    assert {r.metric for r in st["report"].collect()} >= {"accuracy", "roc_auc", "pr_auc"}
    assert set(f.timings) == {"ingest", "clean", "validate", "split", "train", "evaluate",
                              "validate_model"}


def test_sweep_draws_no_fit_twice():
    points = model.sample_grid(model.SWEEP_GRID, 2916, seed=1)
    assert len(points) == 324 and not set(points[0]) & set(model.NO_EFFECT)
    assert len({tuple(p.items()) for p in points}) == 324


def test_fit_reads_encoded_rows_without_their_plan(spark, monkeypatch):
    """Every level of a boosted fit is a job whose tasks carry the input's plan: it ends at the encoded rows."""
    from pyspark.ml.classification import GBTClassifier
    seen, fit = [], GBTClassifier.fit
    monkeypatch.setattr(GBTClassifier, "fit", lambda self, df, *a: (seen.append(df), fit(self, df, *a))[1])
    rows = spark.createDataFrame([(float(i % 7), "ab"[i % 2], i % 3 % 2) for i in range(40)], "x double, c string, converted int")
    model.fit_model(rows, ["x"], ["c"], params={"n_estimators": 1, "max_depth": 1})
    plan = seen[0]._jdf.queryExecution().executedPlan().toString()
    assert "Scan ExistingRDD" in plan and "Exchange" not in plan and "InMemory" not in plan
    assert seen[0].columns == ["features", "converted"] and seen[0].schema["features"].metadata["ml_attr"]["attrs"]["binary"]


def test_model_queries_read_the_tagged_leads_from_files(spark, tmp_path):
    from propensity.plans import q_model
    for name, rows, schema in [
            ("orders", [(i, i % 3, "1-URGENT", "F") for i in range(40)], "o_orderkey long, o_custkey long, o_orderpriority string, o_orderstatus string"),
            ("lineitem", [(i, float(i), "RN"[i % 2]) for i in range(40)], "l_orderkey long, l_quantity double, l_returnflag string"),
            ("customer", [(0, 0, "AUTO"), (1, 0, "AUTO")], "c_custkey long, c_nationkey long, c_mktsegment string"),
            ("nation", [(0, "PERU")], "n_nationkey long, n_name string")]:
        spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / f"{name}.parquet"))
    t = q_model._tagged(spark, str(tmp_path))
    assert all("/scratch/tagged-" in f for f in t.inputFiles())
    assert sorted(r.lead_id for r in t.collect()) == list(range(40)) and t.where("split = 'val'").count() == 6


def test_fit_has_as_many_partitions_as_its_rows_need(spark, monkeypatch):
    got = []

    class Seen:
        def fit(self, rows):
            got.append((rows.rdd.getNumPartitions(), rows.count()))
            raise StopIteration

    monkeypatch.setattr(model, "gbt", lambda *a, **k: Seen())
    rows = spark.range(1000).selectExpr("id % 2 AS converted", "cast(id AS double) AS x", "concat('c', id % 3) AS c")
    was = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for parts, per in (("200", model.PART_ROWS), ("200", 50), ("4", 50)):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            monkeypatch.setattr(model, "PART_ROWS", per)
            with pytest.raises(StopIteration):
                model.fit_model(rows, ["x"], ["c"])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", was)
    assert got == [(8, 1000), (20, 1000), (4, 1000)]
