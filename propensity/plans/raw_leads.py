"""Cleaning of the raw lead export (the CSV with display-name columns) into
the lead schema, as one DataFrame -> DataFrame function built from the
library's operators.

Order of the steps: drop key-like and constant columns (the key is kept),
split the "NN.Level" index columns, drop the raw score columns, drop
columns more than half empty, recode/club categories and turn 'Select'
into a category or NULL, impute numbers (round-robin regression) and the
remaining categorical NULLs (frequency draw — the all-pairs KNN step is not
built, see README), drop the low-information columns, map Yes/No flags,
rename to the lead schema, and keep the first of identical rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalar as X
from ..operators import clean, impute

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's recoding for the same results).
# ---------------------------------------------------------------------------
SELECT_TOKEN = "Select"
INDEX_COLUMNS = ["Asymmetrique Activity Index", "Asymmetrique Profile Index"]
SCORE_COLUMNS = ["Asymmetrique Activity Score", "Asymmetrique Profile Score"]
MANAGEMENT_SPECIALIZATIONS = [
    "Finance Management", "Human Resource Management", "Marketing Management",
    "Operations Management", "IT Projects Management", "Supply Chain Management",
    "Healthcare Management", "Hospitality Management", "Retail Management"]
TAG_GROUPS = {
    "No phone number": ["invalid number", "wrong number given", "number not provided"],
    "Lost": ["Lost to EINS", "Lost to Others"],
    "Try Calling again": ["Ringing", "switched off", "Busy", "opp hangup"],
    "Not Interested/Not Eligible": ["Not doing further education",
                                    "Diploma holder (Not Eligible)"],
    "Considering next admission": ["Interested in Next batch", "Still Thinking",
                                   "Shall take in the next coming month"],
    "Univerity Recongnition issues": ["University not recognized",
                                      "Recognition issue (DEC approval)"],
}
RARE_ACTIVITIES = [
    "Had a Phone Conversation", "Approached upfront", "View in browser link Clicked",
    "Email Marked Spam", "Email Received", "Resubscribed to emails",
    "Visited Booth in Tradeshow", "Unreachable", "Unsubscribed"]
RARE_SOURCES = [
    "bing", "Click2call", "Live Chat", "Press_Release", "welearnblog_Home", "blog",
    "testone", "NC_EDM", "youtubechannel", "Pay per Click Ads", "WeLearn"]
LOW_INFORMATION_COLUMNS = [
    "Newspaper", "Search", "Newspaper Article", "X Education Forums",
    "Digital Advertisement", "Through Recommendations", "Do Not Call", "Country"]
YES_NO_COLUMNS = ["Do Not Email", "A free copy of Mastering The Interview"]
RENAME = {
    "Lead Origin": "lead_origin",
    "Lead Source": "lead_source",
    "Do Not Email": "do_not_email",
    "Converted": "converted",
    "TotalVisits": "total_visits",
    "Total Time Spent on Website": "time_on_website",
    "Page Views Per Visit": "page_views_per_visit",
    "Last Activity": "last_activity",
    "Specialization": "specialization",
    "How did you hear about X Education": "hear_about_x",
    "What is your current occupation": "current_job",
    "What matters most to you in choosing a course": "course_selection_factor",
    "Tags": "tags",
    "City": "city",
    "Asymmetrique Activity Index": "activity_index",
    "Asymmetrique Profile Index": "profile_index",
    "A free copy of Mastering The Interview": "free_interview_copy",
    "Last Notable Activity": "last_notable_activity",
}
LABEL = "Converted"
# ---------------------------------------------------------------------------


def _recode(df: DataFrame, col: str, expr) -> DataFrame:
    return df.withColumn(col, expr) if col in df.columns else df


def recode_raw_categories(df: DataFrame) -> DataFrame:
    """X3-X6 on the raw columns (each step only if the column exists)."""
    c = F.col
    df = _recode(df, "Specialization", X.club(
        X.recode(X.fill_null(X.recode("Specialization", {SELECT_TOKEN: "Others"}), "Others"),
                 {"E-COMMERCE": "E-Business"}), MANAGEMENT_SPECIALIZATIONS, "Management"))
    tags = c("Tags")
    for target, values in TAG_GROUPS.items():
        tags = X.club(tags, values, target)
    df = _recode(df, "Tags", X.fill_null(tags, "Others"))
    df = _recode(df, "How did you hear about X Education",
                 X.recode("How did you hear about X Education", {SELECT_TOKEN: "Other"}))
    df = _recode(df, "City", X.null_if("City", SELECT_TOKEN))
    df = _recode(df, "Lead Profile", X.null_if("Lead Profile", SELECT_TOKEN))
    df = _recode(df, "Last Activity", X.club("Last Activity", RARE_ACTIVITIES, "others"))
    src = X.recode("Lead Source", {"google": "Google", "Facebook": "Social Media"})
    df = _recode(df, "Lead Source", X.fill_null(X.club(src, RARE_SOURCES, "Others"), "Others"))
    return df


def clean_raw_leads(raw: DataFrame, key: str = "Lead Number", seed: int = 42,
                    iterative_rounds: int = 10) -> DataFrame:
    """Raw lead export -> lead schema (see the module docstring)."""
    df = clean.clean_infinities(raw)
    flagged = clean.columns_to_drop(df).where(
        F.col("reason").isin("key_like", "constant")).collect()
    df = df.drop(*sorted({r["column_name"] for r in flagged} - {key, LABEL}))
    for col in INDEX_COLUMNS:
        df = _recode(df, col, X.part_after(X.empty_if_null(col), "."))
    df = clean.drop_columns(df, SCORE_COLUMNS)
    mostly_empty = clean.columns_to_drop(df).where(F.col("reason") == "mostly_missing").collect()
    df = df.drop(*sorted({r["column_name"] for r in mostly_empty} - {key, LABEL}))
    df = recode_raw_categories(df)
    numeric = [f.name for f in df.schema.fields
               if f.name not in (key, LABEL) and f.dataType.typeName() in ("double", "long",
                                                                           "integer", "float")]
    if numeric and iterative_rounds:
        df = impute.impute_iterative(df, numeric, max_iter=iterative_rounds)
    cats = [f.name for f in df.schema.fields if f.dataType.typeName() == "string"
            and f.name not in YES_NO_COLUMNS]
    for col in cats:
        if df.where(F.col(col).isNull()).limit(1).count():
            df = impute.impute_probabilistic(df, df, col, key, seed=seed)
    df = clean.drop_columns(df, LOW_INFORMATION_COLUMNS)
    for col in YES_NO_COLUMNS:
        df = _recode(df, col, X.yes_no(col))
    df = clean.rename_columns(df, {**RENAME, key: "lead_id"}, lower=True)
    rest = [c for c in df.columns if c != "lead_id"]
    return clean.dedupe_first(df, rest, order=["lead_id"]) if rest else df
