"""Scored-lead tables, ranking and pages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import lead_score, predicted_label
from .ordering import global_row_number


def lead_table(df: DataFrame, threshold: float = 0.3, strict: bool = False,
               key: str = "lead_id", label: str = "label",
               score: str = "score") -> DataFrame:
    """Actual, probability, label at the cut-off, 0-100 score."""
    return df.select(
        key, F.col(label).alias("actual"),
        F.col(score).alias("predicted_probability"),
        predicted_label(score, threshold, strict).alias("predicted_label"),
        lead_score(score).alias("lead_score"))


def rank_leads(df: DataFrame, key: str = "lead_id",
               score: str = "score") -> DataFrame:
    """Rank 1 = highest score; ties broken by key.  Distributed."""
    return global_row_number(df, [F.col(score).desc(), F.col(key).asc()], "rank")


def top_leads(df: DataFrame, k: int, key: str = "lead_id",
              score: str = "score") -> DataFrame:
    """Top-k report; each partition keeps only k rows before the merge."""
    return df.orderBy(F.col(score).desc(), F.col(key).asc()).limit(k)
