"""The gate that checks while it writes."""

import pytest
from helpers import rows
from pyspark.sql import functions as F

from propensity.operators import publish

RULES = {"k": {"type": "integer"}, "c": {"type": "string", "enum": ["a", "b"]}, "x": {"type": "float", "minimum": 0, "maximum": 10}}


@pytest.fixture
def good(spark):
    return spark.createDataFrame([(1, "a", 0.0), (2, "b", 10.0), (3, "a", 5.0)], "k long, c string, x double")


def test_newest_passing_version_is_read(spark, good, tmp_path):
    root = str(tmp_path)
    assert publish.read_published(spark, root) is None
    first = publish.publish(good, RULES, root, "v1")
    assert first.passed and first.n_rows == 3 and {r.status for r in first.status.collect()} == {"Valid"}
    for bad in ((4, "z", 1.0), (4, None, 1.0), (4, "a", None), (4, "a", 10.5), (4, "a", float("nan"))):
        broken = publish.publish(good.union(spark.createDataFrame([bad], good.schema)), RULES, root, "v2")
        assert not broken.passed and broken.n_rows == 4
        assert [r.column_name for r in broken.status.collect() if r.status != "Valid"] in (["c"], ["x"])
    assert rows(publish.read_published(spark, root)) == rows(good)
    assert publish.publish(good.where("k = 1"), RULES, root, "v2").passed
    assert publish.read_published(spark, root).count() == 1 and publish.read_published(spark, root, "v1").count() == 3


def test_interrupted_version_is_not_seen_and_can_be_written_again(spark, good, tmp_path):
    root = str(tmp_path)
    publish.publish(good, RULES, root, "v1")
    good.limit(1).write.parquet(f"{root}/staging/v2")            # as if the job ended before its manifest
    assert publish.read_published(spark, root).count() == 3
    assert publish.publish(good.limit(2), RULES, root, "v2").passed and publish.read_published(spark, root).count() == 2


def test_input_is_computed_once(spark, good, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def counted(k):
        seen.add(1)
        return k
    assert publish.publish(good.withColumn("k", counted("k")), RULES, str(tmp_path), "v1").passed
    assert seen.value == 3


def test_wrong_type_or_undeclared_column_writes_nothing(spark, good, tmp_path):
    assert not publish.publish(good.withColumn("new", F.lit(1)), RULES, str(tmp_path), "v1").passed
    assert not publish.publish(good.withColumn("k", F.lit("text")), RULES, str(tmp_path), "v1").passed
    assert not (tmp_path / "staging").exists()
    assert publish.publish(good.where("k > 9"), RULES, str(tmp_path), "v1").passed
    with pytest.raises(ValueError):
        publish.publish(good, RULES, str(tmp_path), "../x")
