"""Mixing sources to target weights by hash-threshold histograms (DataFrame functions only).

Every document gets a fixed 60-bit hash of its id.  A source's target is some whole repetitions of
all its documents plus a remainder; the documents whose hash lies below the source's threshold are
taken once more.  The threshold is found without sorting: sum the sizes by source and the next 12 bits of the
hash, find the bucket in which the running sum passes the remainder, and look only into that bucket
for the next 12 bits, until it holds one hash value.  A larger target has a larger threshold, so takes nest.

A source with a third of all rows is combined into at most 4096 sums per task before any
shuffle.  The tables of sources and thresholds have one row per source."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from propensity.llm.common import saved

BITS, STEP = 60, 12
WEIGHTS = (3, 1, 2)


def words_in(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def id_hash(doc_id: Column) -> Column:
    """The first 60 bits of the MD5 of the id's decimal text (empty text for a null id)."""
    return F.conv(F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), 1, 15), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """(sid, source, source_size, target): sources by code point, null last, weigh `weights` in turn and share
    `share` times all sizes; a target stops at `most` times its source's size, the excess goes to the
    others by weight.  That is filling up to one level: sources in the order of size over weight are full as
    long as the level left for the rest reaches theirs."""
    # one row per source from here on: these windows order sources, not documents
    totals = saved(sizes.groupBy("source").agg(F.sum("size").alias("source_size")), "sources")
    order = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*map(F.lit, weights)), (F.col("sid") % len(weights)) + 1)
    s = totals.withColumn("sid", F.row_number().over(order) - 1).withColumn("w", w.cast("double"))
    s = s.withColumn("full", F.col("source_size") * F.lit(float(most)))
    up = Window.orderBy(F.col("full") / F.col("w"), "sid")
    everything = Window.partitionBy()
    s = (s.withColumn("all", F.sum("source_size").over(everything) * F.lit(float(share)))
         .withColumn("before", F.coalesce(F.sum("full").over(up.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
         .withColumn("rest", F.sum("w").over(up.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
         .withColumn("level", (F.col("all") - F.col("before")) / F.col("rest"))
         .withColumn("open", F.col("level") < F.col("full") / F.col("w"))
         .withColumn("nth", F.row_number().over(up)))
    final = F.min_by(F.col("level"), F.when(F.col("open"), F.col("nth"))).over(everything)
    s = s.withColumn("final", final)
    target = F.when(F.col("final").isNull(), F.col("full")).otherwise(F.least("full", F.col("final") * F.col("w")))
    return saved(s.select("sid", "source", "source_size", target.alias("target")), "targets")


def thresholds(rows: DataFrame, targets: DataFrame) -> DataFrame:
    """(sid, repeats, low, high, also): documents are taken `repeats` times, once more below `low`,
    and those in [low, high) once more if `also`."""
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    state = targets.select("sid", whole.alias("repeats"), (F.col("target") - whole * F.col("source_size")).alias("left"),
                           F.lit(0).cast("long").alias("low"), F.lit(1 << BITS).cast("long").alias("high"))
    state = saved(state, "state")
    for shift in range(BITS - STEP, -1, -STEP):
        inside = rows.join(state, "sid").where("key >= low and key < high")
        bucket = F.shiftright("key", shift)
        sums = saved(inside.groupBy("sid", bucket.alias("bucket")).agg(
            F.sum("size").alias("size"), F.count("*").alias("docs"), F.min("key").alias("k0"), F.max("key").alias("k1")), "histogram")
        so_far = Window.partitionBy("sid").orderBy("bucket")
        cum = sums.withColumn("upto", F.sum("size").over(so_far))
        edge = (cum.join(state.select("sid", "left"), "sid").where(F.col("upto") > F.col("left")).groupBy("sid")
                .agg(F.min_by(F.struct("bucket", "size", "upto", "docs", "k0", "k1"), "bucket").alias("e")))
        low = F.shiftleft(F.col("e.bucket"), shift)
        state = saved(state.join(edge, "sid", "left").select(
            "sid", "repeats", (F.col("left") - F.coalesce(F.col("e.upto") - F.col("e.size"), F.lit(0))).alias("left"),
            F.coalesce(low, "high").alias("low"), F.coalesce(low + (1 << shift), "high").alias("high"),
            F.coalesce("e.size", F.lit(0)).alias("edge"), (F.col("e.k0") < F.col("e.k1")).alias("split")), "state")
        more = not state.where("split").isEmpty()
        last = state.select("sid", "repeats", "low", "high", (F.col("left") * 2 >= F.col("edge")).alias("also"))
        if not more:
            break
        state = state.drop("edge", "split")
    return last


def mix_sources(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, most: float = 2.0, with_source: bool = False) -> DataFrame:
    """Per row of docs(doc_id, text, source): size (words), source_size, target, copies (times taken) and taken (words).

    The document at the threshold is taken if that brings the source nearer to its target.  Null text has size
    0; a null source is a source, ordered last; rows with equal or null doc_id share a hash and are taken
    together; no document, empty ones included, is taken more than `most` times, rounded up.  Other columns are ignored; an empty table gives an empty result."""
    rows = docs.select("doc_id", "source", words_in(F.col("text")).alias("size"), id_hash(F.col("doc_id")).alias("key"))
    rows = saved(rows, "sizes")
    targets = source_targets(rows, weights, share, most)
    t = targets.select("sid", F.col("source").alias("s"), "source_size", "target")
    rows = rows.join(t, F.col("source").eqNullSafe(F.col("s"))).drop("s")
    cut = thresholds(rows.select("sid", "size", "key"), targets)
    once_more = (F.col("key") < F.col("low")) | (F.col("also") & (F.col("key") < F.col("high")))
    copies = F.least(F.col("repeats") + once_more.cast("long"), F.lit(math.ceil(most)).cast("long"))     # a document of size 0 is no exception
    return (rows.join(cut, "sid").withColumn("copies", copies)
            .select("doc_id", *["source"] * with_source, "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies"))
