"""The same operators on the other driver tables: ``labels`` as a second
binary label set (A14-A18) and ``events`` for profiling and ingest."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import metrics, profile
from ..session import scratch_path
from ..sources import readers
from .catalog import query, rnd

CUT = 0.5

_LCONF = f"""WITH scored AS (SELECT quality AS label, CAST(1 - toxic AS DOUBLE) AS score FROM labels),
conf AS (
  SELECT COUNT(*) FILTER (WHERE label = 0 AND score < {CUT}) AS tn,
         COUNT(*) FILTER (WHERE label = 0 AND score >= {CUT}) AS fp,
         COUNT(*) FILTER (WHERE label = 1 AND score < {CUT}) AS fn,
         COUNT(*) FILTER (WHERE label = 1 AND score >= {CUT}) AS tp
  FROM scored),
per_class AS (
  SELECT '0' AS cls, tn AS t, fn AS f_pos, fp AS f_neg FROM conf
  UNION ALL SELECT '1', tp, fp, fn FROM conf),
cls_stats AS (
  SELECT cls,
         COALESCE(CAST(t AS DOUBLE) / NULLIF(t + f_pos, 0), 0) AS p,
         COALESCE(CAST(t AS DOUBLE) / NULLIF(t + f_neg, 0), 0) AS r,
         COALESCE(CAST(2 * t AS DOUBLE) / NULLIF(2 * t + f_pos + f_neg, 0), 0) AS f,
         t + f_neg AS support
  FROM per_class WHERE t + f_neg > 0 OR t + f_pos > 0)"""


def _labels(spark, sf):
    """Label = quality; predicted quality = not toxic (a 0/1 score)."""
    return readers.read_table(spark, sf, "labels").select(
        "doc_id", F.col("quality").alias("label"),
        (F.lit(1) - F.col("toxic")).cast("double").alias("score"))


@query("labels_confusion", _LCONF + " SELECT tn, fp, fn, tp FROM conf")
def q_labels_confusion(spark, sf):
    return metrics.confusion(_labels(spark, sf), CUT, strict=False)


@query("labels_classification_report", _LCONF + """
SELECT cls AS row_label, ROUND(p, 6) AS "precision", ROUND(r, 6) AS recall,
       ROUND(f, 6) AS f1_score, CAST(support AS BIGINT) AS support FROM cls_stats
UNION ALL
SELECT 'accuracy', NULL, NULL, ROUND(CAST(tp + tn AS DOUBLE) / (tp + tn + fp + fn), 6),
       CAST(tp + tn + fp + fn AS BIGINT) FROM conf
UNION ALL
SELECT 'macro avg', ROUND(AVG(p), 6), ROUND(AVG(r), 6), ROUND(AVG(f), 6),
       CAST(SUM(support) AS BIGINT) FROM cls_stats
UNION ALL
SELECT 'weighted avg', ROUND(SUM(p * support) / SUM(support), 6),
       ROUND(SUM(r * support) / SUM(support), 6),
       ROUND(SUM(f * support) / SUM(support), 6), CAST(SUM(support) AS BIGINT)
FROM cls_stats""")
def q_labels_classification_report(spark, sf):
    return rnd(metrics.classification_report(_labels(spark, sf), CUT, strict=False))


@query("labels_macro_weighted_f1", _LCONF + """
SELECT ROUND(AVG(f), 6) AS macro_f1, ROUND(SUM(f * support) / SUM(support), 6) AS weighted_f1
FROM cls_stats""")
def q_labels_macro_weighted_f1(spark, sf):
    return rnd(metrics.macro_weighted_f1(_labels(spark, sf), CUT, strict=False))


EVENT_COLS = [("event_id", "bigint", True), ("ts", "timestamp_ntz", False),
              ("user_id", "bigint", True), ("event_type", "string", False),
              ("value", "double", True), ("props", "string", False)]


def _events_profile_sql() -> str:
    parts = []
    for c, t, num in EVENT_COLS:
        x = f"CAST({c} AS DOUBLE)"
        parts.append(
            f"SELECT '{c}' AS column_name, '{t}' AS data_type, COUNT(*) AS n_rows, "
            f"COUNT(*) FILTER (WHERE {c} IS NULL) AS n_missing, "
            f"ROUND(COUNT(*) FILTER (WHERE {c} IS NULL) * 100.0 / COUNT(*), 6) AS pct_missing, "
            f"COUNT(DISTINCT {c}) AS n_distinct, "
            + (f"CAST(COUNT(*) FILTER (WHERE {x} = 0) AS DOUBLE)" if num else "CAST(NULL AS DOUBLE)")
            + " AS n_zeros, "
            + (f"ROUND(AVG({x}), 6)" if num else "CAST(NULL AS DOUBLE)") + " AS mean, "
            + (f"ROUND(STDDEV_SAMP({x}), 6)" if num else "CAST(NULL AS DOUBLE)") + " AS std, "
            + (f"MIN({x})" if num else "CAST(NULL AS DOUBLE)") + " AS min, "
            + (f"MAX({x})" if num else "CAST(NULL AS DOUBLE)") + " AS max FROM events")
    return "\nUNION ALL\n".join(parts)


@query("events_profile", _events_profile_sql())
def q_events_profile(spark, sf):
    """A12 on the event table (timestamps and JSON text are non-numeric)."""
    return rnd(profile.profile_table(readers.read_table(spark, sf, "events")))


@query("events_value_counts", """
SELECT 'event_type' AS column_name, event_type AS value, COUNT(*) AS n,
       ROUND(CAST(COUNT(*) AS DOUBLE) / SUM(COUNT(*)) OVER (), 6) AS share
FROM events GROUP BY event_type""")
def q_events_value_counts(spark, sf):
    return rnd(profile.value_counts(readers.read_table(spark, sf, "events"), ["event_type"]))


@query("events_describe", """
SELECT 'value' AS column_name, COUNT(value) AS count, ROUND(AVG(value), 6) AS mean,
       ROUND(STDDEV_SAMP(value), 6) AS std, ROUND(MIN(value), 6) AS min,
       ROUND(QUANTILE_CONT(value, 0.25), 6) AS q25, ROUND(QUANTILE_CONT(value, 0.5), 6) AS q50,
       ROUND(QUANTILE_CONT(value, 0.75), 6) AS q75, ROUND(MAX(value), 6) AS max FROM events""")
def q_events_describe(spark, sf):
    return rnd(profile.describe(readers.read_table(spark, sf, "events"), ["value"]))


@query("events_ingest_record")
def q_events_ingest_record(spark, sf):
    """S7 on the event table (run times differ: rows-only check)."""
    ev = readers.read_table(spark, sf, "events")
    return readers.ingest(ev, scratch_path(spark, "events_ingest"), "events")
