"""Session for the training-data operators; workers find the package by PYTHONPATH."""

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from propensity.session import local_session
    s = local_session(4, shuffle_partitions=4)
    env = s.sparkContext.environment
    env["PYTHONPATH"] = os.pathsep.join(filter(None, [ROOT, env.get("PYTHONPATH", "")]))
    return s


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and blank texts, ties, repeated rows, a long text, copies, near copies, clashing extra columns."""
    base = " ".join(f"w{i}" for i in range(60))
    near = base.replace("w59", "zz")
    rows = [(1, base, "en", "a"), (2, base.upper(), "en", "a"), (3, near, "en", None), (4, None, None, "b"), (5, "", "en", "b"), (6, " \t\n", "fr", "b"),
            (7, "one two", "en", "c"), (8, "One  two", "en", "c"), (9, "x " * 30_000, "de", "c"), (10, base + " tail " + "q " * 20, "en", "a"),
            (10, "other text of the same id here", "en", "a"), (11, "café 中文 слово", "fr", "d"), (12, "12 34 !!", None, "d"),
            (13, base, "en", "a"), (13, base, "en", "a"), (None, "text without an id " + base, "en", "a")]
    df = spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], SCHEMA)
    return df.selectExpr("*", "doc_id AS hi", "text AS node", "n_chars AS size", "lang AS chunk")


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
