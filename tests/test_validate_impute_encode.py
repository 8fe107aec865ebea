import pytest

from helpers import rows
from propensity.functions import scalar as X
from propensity.operators import encode, impute, validate

RULES = {
    "origin": {"type": "string", "enum": ["API", "Landing Page Submission"]},
    "visits": {"type": "float", "minimum": 0, "maximum": 300},
    "pages": {"type": "float", "minimum": 0, "maximum": 70},
    "flag": {"type": "integer", "minimum": 0, "maximum": 1},
    "bad_type": {"type": "float"},
    "declared_absent": {"type": "string"},
}


@pytest.fixture
def bad_schema(spark):
    return spark.createDataFrame(
        [("API", 10.0, 1.0, 0, 1, "x"), ("Other", 500.0, None, 1, 2, "y"),
         (None, 5.0, 3.0, 1, 3, "z")],
        "origin string, visits double, pages double, flag int, bad_type int, extra string")


def test_validation_messages(bad_schema):
    st = dict(rows(validate.validation_status(bad_schema, RULES, report_absent=True)))
    assert st["origin"] == "Invalid categorical values: {'Other', None}"
    assert st["visits"] == "Out of range: [0, 300]"
    assert st["pages"] == "Out of range: [0, 70]"          # NULL fails the range
    assert st["flag"] == "Valid"
    assert st["bad_type"] == "Incorrect dtype: expected float, got int"
    assert st["extra"] == "Column missing in schema"
    assert st["declared_absent"] == "Column missing in data"
    assert not validate.all_valid(validate.validation_status(bad_schema, RULES))


def test_validation_gate_passes(spark):
    ok = spark.createDataFrame([("API", 1.0)], "origin string, visits double")
    st = validate.validation_status(ok, RULES)
    assert validate.all_valid(st)


def test_mode_tie_smallest(spark):
    df = spark.createDataFrame([("b",), ("a",), ("a",), ("b",), (None,)], "c string")
    assert impute.fit_modes(df, ["c"]) == {"c": "a"}
    filled = impute.impute_mean_mode(df, df, [], ["c"])
    assert sorted(r.c for r in filled.collect()) == ["a", "a", "a", "b", "b"]


def test_probabilistic_fill_uses_train_levels(spark):
    df = spark.createDataFrame([(i, None if i % 4 == 0 else "ab"[i % 2]) for i in range(400)],
                               "id long, c string")
    out = impute.impute_probabilistic(df, df, "c", "id")
    got = {r.id: r.c for r in out.collect()}
    assert len(got) == 400 and set(got.values()) == {"a", "b"}
    again = {r.id: r.c for r in impute.impute_probabilistic(df.repartition(5), df, "c", "id").collect()}
    assert got == again


@pytest.fixture
def unknown_cat(spark):
    train = spark.createDataFrame([("a",), ("b",), ("c",), ("a",)], "c string")
    test = spark.createDataFrame([("b",), ("zzz",), (None,)], "c string")
    return train, test


def test_one_hot_unknown_is_zero(unknown_cat):
    train, test = unknown_cat
    out = encode.one_hot_all(train, test, "c")
    assert out.columns == ["c_a", "c_b", "c_c"]
    assert sorted(tuple(r) for r in out.collect()) == [(0.0, 0.0, 0.0), (0.0, 0.0, 0.0),
                                                      (0.0, 1.0, 0.0)]
    drop_first = encode.one_hot(test, "c", encode.levels(train, "c"), drop_first=True)
    assert drop_first.columns == ["c_b", "c_c"]


def test_ordinal_unknown_and_null(unknown_cat):
    train, test = unknown_cat
    t = encode.level_table(train, "c")
    e = encode.ordinal_encode(test, "c", t, "code")
    d = encode.ordinal_decode(e, "code", t, "back")
    got = {r.c: (r.code, r.back) for r in d.collect()}
    assert got == {"b": (1, "b"), "zzz": (-1, None), None: (None, None)}


def test_population_scaler(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0), (None, 5.0)], "x double, k double")
    st = encode.fit_population_scaler(df, ["x", "k"])
    assert st["x"] == (2.0, 1.0)                   # ddof 0
    z = rows(encode.standardize(df, st), "x", "k")
    assert z == [(None, 0.0), (-1.0, 0.0), (1.0, 0.0)]
    back = encode.inverse_standardize(encode.standardize(df, st), st)
    assert sorted(r.x for r in back.collect() if r.x is not None) == [1.0, 3.0]


def test_scalar_recodes(spark):
    df = spark.createDataFrame([("02.Medium",), ("High",), (None,), ("Select",), ("Yes",), ("No",)],
                               "c string")
    got = [tuple(r) for r in df.select(X.part_after("c", "."), X.null_if("c", "Select"),
                                       X.yes_no("c"), X.empty_if_null("c"),
                                       X.recode("c", {"High": "H", "Select": None})).collect()]
    assert got[0][0] == "Medium" and got[1][0] is None and got[2][0] is None
    assert got[3][1] is None and got[4][2] == 0 and got[5][2] == 1 and got[0][2] is None
    assert got[2][3] == "" and got[1][4] == "H" and got[3][4] is None and got[0][4] == "02.Medium"


def test_feature_encoder_save_load(spark, tmp_path):
    from pyspark.ml import PipelineModel
    from pyspark.ml.functions import vector_to_array
    df = spark.createDataFrame([(1.0, "a"), (3.0, "b"), (None, None), (5.0, "b")],
                               "x double, c string")
    m = encode.feature_encoder(["x"], ["c"]).fit(df)
    p = str(tmp_path / "fp")
    m.write().overwrite().save(p)
    a = [r[0] for r in m.transform(df).select(vector_to_array("features")).collect()]
    b = [r[0] for r in PipelineModel.load(p).transform(df).select(vector_to_array("features")).collect()]
    assert a == b
    # NULL number -> train mean 3 -> scaled 0; NULL string -> mode 'b'
    assert a[2] == [0.0, 0.0, 1.0]
    with pytest.raises(ValueError):
        encode.feature_encoder([], ["c"])


def test_iterative_imputation_recovers_linear_relation(spark):
    rows = [(float(i), None if i % 5 == 0 else 2.0 * i + 1.0, float(i % 3)) for i in range(60)]
    df = spark.createDataFrame(rows, "x double, y double, z double")
    out = impute.impute_iterative(df, ["x", "y", "z"], max_iter=5)
    got = {r.x: r.y for r in out.collect()}
    assert len(got) == 60
    for i in range(0, 60, 5):
        assert got[float(i)] == pytest.approx(2.0 * i + 1.0, abs=1e-3)


def test_probabilistic_fill_keeps_rows_without_levels(spark):
    df = spark.createDataFrame([(1, None), (2, None)], "id long, c string")
    out = impute.impute_probabilistic(df, df, "c", "id")
    assert sorted((r.id, r.c) for r in out.collect()) == [(1, None), (2, None)]


def test_probabilistic_fill_reads_its_input_once(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(i, None if i % 3 else "ab"[i % 2], None if i % 2 else "c") for i in range(60)], "k long, a string, b string").write.parquet(path)
    d = spark.read.parquet(path)
    out = d
    for c in ("a", "b"):
        out = impute.impute_probabilistic(out, d, c, "k")
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count(" parquet") == 1 or plan.count("Relation [k") == 1
    rows = {r.k: r for r in out.collect()}
    assert len(rows) == 60 and all(r.a in "ab" and r.b == "c" for r in rows.values())
    assert all(rows[i].a == "ab"[i % 2] for i in range(0, 60, 3))
