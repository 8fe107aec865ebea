"""Corpus pipeline: quality, exact duplicates, near duplicates, source mix, packing.

Each stage takes the documents its predecessor kept (columns doc_id, text, lang, source, n_chars and whatever
else the table has) and returns those it keeps, the last one packed pieces.  Rows are matched by doc_id, in the
exact stage by doc_id and text; nulls count as equal.  The docstrings give each stage's result for odd rows."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from propensity.llm.common import documents, saved
from propensity.llm.exact_dedup import exact_dedup
from propensity.llm.jaccard_join import jaccard_join
from propensity.llm.mix_sources import mix_sources
from propensity.llm.packing import pack
from propensity.llm.quality import fit_quality, score_quality
from propensity.llm.tokens import tokenizer_path
from propensity.session import table_path

#: Share below which the classifier rejects a document.
LEAST_QUALITY = 0.3


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score at least LEAST_QUALITY; the classifier is trained on the labelled documents among them.
    Null and empty texts score the share of good labels; repeated rows score alike; an empty table stays empty."""
    model = fit_quality(docs, spark.read.parquet(table_path(sf_dir, "labels")))
    score = "quality"
    while score in docs.columns:
        score += "_"
    return score_quality(docs, model, score).where(F.col(score) >= LEAST_QUALITY).select(docs.columns)


def _rows(docs: DataFrame, *columns: Column) -> DataFrame:
    """docs with each row as one column `row`, beside `id` and further columns: their names can't clash with the table's."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").cast("long").alias("id"), *columns)


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts (A-Z folded, null as empty): the one with the largest doc_id.
    Of rows with equal text and doc_id the one whose columns hash lowest stays; different texts under one doc_id, or
    without one, are different documents and all stay."""
    folded = F.translate(F.coalesce(F.col("text").cast("string"), F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    comparable = [f"`{f.name}`" for f in docs.schema if "map<" not in f.dataType.simpleString()]
    rows = _rows(docs, F.sha2(folded.cast("binary"), 256).alias("sha"), F.xxhash64(*comparable).alias("place"))
    stay = exact_dedup(docs).where("kept").select(F.col("doc_id").alias("stay_id"), F.col("text_sha256").alias("stay_sha")).distinct()
    kept = rows.join(stay, F.col("id").eqNullSafe(F.col("stay_id")) & (F.col("sha") == F.col("stay_sha")), "left_semi")
    if not kept.groupBy("id", "sha").count().where("count > 1").isEmpty():
        kept = kept.groupBy("id", "sha").agg(F.min_by("row", "place").alias("row"))
    return kept.select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by a five-word shingle similarity of 0.8 or more: the one with the smallest doc_id.
    Rows under one doc_id are one document, which stays if one of them is the smallest of its group; rows without a
    doc_id, and texts without a word, stay."""
    found = jaccard_join(docs, width=5, percent=80, with_links=False)
    stay = found.where("doc_id = component_id OR doc_id IS NULL").select(F.col("doc_id").alias("stay_id")).distinct()
    return _rows(docs).join(stay, F.col("id").eqNullSafe(F.col("stay_id")), "left_semi").select("row.*")


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: not at all, once or twice.  A null source is a source; rows with equal or
    null doc_id in one source are taken alike."""
    taken = mix_sources(docs.select("doc_id", "text", "source"), with_source=True).where("copies > 0").select(
        F.col("doc_id").cast("long").alias("taken_id"), F.col("source").alias("taken_source"), "copies").distinct()
    both = F.col("id").eqNullSafe(F.col("taken_id")) & F.col("row.source").eqNullSafe(F.col("taken_source"))
    return _rows(docs).join(taken, both).select("row", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).select("row.*")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 4096 tokens in sequences; a null text is empty and has its end token alone."""
    return pack(docs, tokenizer_path("word_bpe_49k.json"), end=2)


STAGES = [("quality", quality), ("exact_duplicates", exact_duplicates), ("near_duplicates", near_duplicates), ("source_mix", source_mix), ("packing", packing)]

#: The classifier and the tokenizer have no SQL form; tests/llm/test_pipeline.py holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
