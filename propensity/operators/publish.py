"""A table is checked while it is written and becomes visible by a manifest.

Rows go to a staging folder of their version; the rules' violations are counted by aggregates observed in
that same job, so the input is computed once.  A manifest is written last and only if no rule fails.  Readers
follow the newest manifest: a failed or interrupted version is never seen and the one before stays in force;
publishing a version again writes its folder anew.
"""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .validate import MSG_VALID, validation_status

MANIFEST = "version string, path string, n_rows long, seq long"


@dataclass(frozen=True)
class Published:
    version: str
    passed: bool
    n_rows: int
    status: DataFrame


def _violations(df: DataFrame, rules: Mapping[str, Mapping]) -> dict[str, Column]:
    """Per column with an enum or a range the number of rows that break it; NULL breaks both, NaN the range."""
    out = {}
    for c in df.columns:
        rule = rules.get(c) or {}
        x, bad = F.col(f"`{c}`"), None
        if "enum" in rule:
            bad = x.isNull() | ~x.isin(list(rule["enum"]))
        elif rule.get("minimum") is not None and rule.get("maximum") is not None:
            bad = ~F.coalesce(x.between(rule["minimum"], rule["maximum"]), F.lit(False))
        if bad is not None:
            out[c] = F.count_if(bad)
    return out


def publish(df: DataFrame, rules: Mapping[str, Mapping], root: str, version: str) -> Published:
    """Writes ``df`` as ``version`` and makes it visible if it keeps all rules.

    Undeclared columns and wrong types fail before anything is written.  The status table is that of
    ``validation_status``; its messages with offending values are made from the staged rows, and only after a
    rule failed."""
    if not re.fullmatch(r"[\w.-]+", version):
        raise ValueError(f"not a version name: {version!r}")
    spark = df.sparkSession
    typed = validation_status(spark.createDataFrame([], df.schema), rules)
    if not typed.where(F.col("status") != MSG_VALID).isEmpty():
        return Published(version, False, 0, typed)
    counts = _violations(df, rules)
    seen = Observation()
    names = {c: f"bad_{i}" for i, c in enumerate(counts)}
    path = f"{root}/staging/{version}"
    df.observe(seen, F.count(F.lit(1)).alias("n"), *[counts[c].alias(names[c]) for c in counts]).write.mode("overwrite").parquet(path)
    found = seen.get
    staged = spark.read.schema(df.schema).parquet(path)
    if any(found[n] for n in names.values()):
        return Published(version, False, found["n"], validation_status(staged, rules))
    seq = 1 + (_manifests(spark, root).agg(F.max("seq")).first()[0] or 0)
    (spark.createDataFrame([(version, path, found["n"], seq)], MANIFEST).coalesce(1)
     .write.mode("overwrite").json(f"{root}/manifest/{version}"))
    return Published(version, True, found["n"], typed)


def _manifests(spark: SparkSession, root: str) -> DataFrame:
    """One short row per published version; none while nothing is published."""
    jvm = spark._jvm
    folder = jvm.org.apache.hadoop.fs.Path(f"{root}/manifest")
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return spark.createDataFrame([], MANIFEST)
    return spark.read.schema(MANIFEST).json(f"{root}/manifest/*")


def read_published(spark: SparkSession, root: str, version: str | None = None) -> DataFrame | None:
    """The rows of the newest visible version (or the one named); None if there is none."""
    m = _manifests(spark, root)
    last = (m.where(F.col("version") == version) if version else m).orderBy(F.desc("seq")).limit(1).collect()
    return spark.read.parquet(last[0]["path"]) if last else None
