"""Source/sink queries (S1-S16, U1, ST1-ST3).  Scratch output goes under
the session's shared checkpoint folder."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.scalar import lead_score
from ..operators import curves, split
from ..session import scratch_path, table_path
from ..sources import readers
from ..sources.leads import fixed_score, leads, scored_leads
from ..streaming.scoring import score_stream
from .catalog import ISO_SQL, query, rnd
from .sql import SCORED, SPLIT, with_

ORDER_COLS = ("o_orderkey, o_custkey, o_orderstatus, o_totalprice, "
              f"strftime(o_orderdate, '{ISO_SQL}') AS o_orderdate")


@query("scan_union_batches", f"""
SELECT {ORDER_COLS}, o_orderpriority FROM orders WHERE o_orderstatus = 'F'
UNION ALL
SELECT {ORDER_COLS}, NULL AS o_orderpriority FROM orders WHERE o_orderstatus = 'O'
UNION ALL
SELECT {ORDER_COLS}, o_orderpriority FROM orders
WHERE o_orderstatus IS NULL OR o_orderstatus NOT IN ('F', 'O')""")
def q_scan_union_batches(spark, sf):
    """A collection read in batches, one batch lacking a column."""
    src = readers.read_collection(spark, table_path(sf, "orders"), "parquet")
    st = F.col("o_orderstatus")
    return rnd(readers.union_batches([
        src.where(st == "F"),
        src.where(st == "O").drop("o_orderpriority"),
        src.where(st.isNull() | ~st.isin("F", "O"))]))


@query("csv_roundtrip", "SELECT * FROM customer")
def q_csv_roundtrip(spark, sf):
    """S6 then S3: write CSV with a header, read it back with the schema."""
    c = readers.read_table(spark, sf, "customer")
    path = readers.write_csv(c, scratch_path(spark, "customer_csv"))
    return rnd(readers.read_csv(spark, path, c.schema))


@query("parquet_roundtrip", with_(SPLIT) + """
SELECT lead_id, lead_origin, lead_source, city, last_activity, total_visits, time_on_website,
       page_views_per_visit, converted, split FROM splits""")
def q_parquet_roundtrip(spark, sf):
    """Split-tagged table written in one folder per split."""
    s = split.stratified_split(leads(spark, sf), "converted", "lead_id")
    path = readers.write_parquet(s, scratch_path(spark, "leads_split"), ["split"])
    return rnd(readers.read_collection(spark, path, "parquet"))


@query("json_curve_dump", "WITH " + SCORED + """,
g AS (SELECT score AS threshold, COUNT(*) FILTER (WHERE label = 1) AS pos,
             COUNT(*) FILTER (WHERE label = 0) AS neg FROM scored GROUP BY score),
c AS (SELECT threshold,
             CAST(SUM(pos) OVER (ORDER BY threshold DESC) AS BIGINT) AS tp,
             CAST(SUM(neg) OVER (ORDER BY threshold DESC) AS BIGINT) AS fp,
             SUM(pos) OVER () AS npos, SUM(neg) OVER () AS nneg FROM g)
SELECT threshold, tp, fp, ROUND(CAST(tp AS DOUBLE) / (tp + fp), 6) AS "precision",
       ROUND(CAST(tp AS DOUBLE) / npos, 6) AS recall, ROUND(CAST(tp AS DOUBLE) / npos, 6) AS tpr,
       ROUND(CAST(fp AS DOUBLE) / nneg, 6) AS fpr FROM c""")
def q_json_curve_dump(spark, sf):
    """Curve table -> JSON lines -> read back with its schema."""
    c = curves.curve_dump(scored_leads(spark, sf))
    path = readers.write_json(c, scratch_path(spark, "curve_json"))
    return rnd(spark.read.schema(c.schema).json(path))


@query("ingest_record")
def q_ingest_record(spark, sf):
    """S7/S13/S14/X13 (run times differ per run: rows-only check)."""
    d = leads(spark, sf)
    return readers.ingest(d, scratch_path(spark, "ingest"), "leads")


@query("append_scores_idempotent", "WITH " + SCORED + """
SELECT lead_id, label, score FROM scored""")
def q_append_scores_idempotent(spark, sf):
    """Appending the same scores again (and an overlapping subset)
    leaves exactly one row per lead in the sink."""
    s = scored_leads(spark, sf)
    sink = scratch_path(spark, "scores_sink")
    readers.append_rows(s.where(F.col("label") == 1), sink, key="lead_id")
    readers.append_rows(s, sink, key="lead_id")
    readers.append_rows(s, sink, key="lead_id")
    return rnd(spark.read.parquet(sink))


def _score_batch(df):
    return df.select("lead_id", F.col("converted").alias("label"),
                     fixed_score().alias("score")).withColumn(
        "lead_score", lead_score("score"))


def _run_stream(spark, sf):
    d = leads(spark, sf)
    src = scratch_path(spark, "stream_src")
    o = F.col("lead_origin")
    # files arrive in three drops; the middle drop arrives twice
    parts = [d.where(o.isin("1-URGENT", "2-HIGH")), d.where(o.isin("3-MEDIUM", "4-NOT SPECIFIED")),
             d.where(o.isNull() | ~o.isin("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED"))]
    parts.insert(2, parts[1])
    for p in parts:
        p.write.mode("append").parquet(src)
    sink = scratch_path(spark, "stream_sink")
    record = scratch_path(spark, "stream_record")
    score_stream(spark, src, d.schema, _score_batch, sink, scratch_path(spark, "stream_ckpt"),
                 record_dir=record, files_per_batch=2)
    return sink, record


@query("stream_score", "WITH " + SCORED + """
SELECT lead_id, label, score, CAST(round_even(score * 100, 0) AS INTEGER) AS lead_score
FROM scored""")
def q_stream_score(spark, sf):
    """ST1/ST2: incremental, idempotent scoring of arriving lead files."""
    sink, _ = _run_stream(spark, sf)
    return rnd(spark.read.parquet(sink))


@query("stream_batches")
def q_stream_batches(spark, sf):
    """ST3: per-batch run record of the scoring stream (rows-only check)."""
    _, record = _run_stream(spark, sf)
    return spark.read.parquet(record)
