"""Raw lead export -> lead schema, on hand-made rows with the raw quirks
('Select' tokens, '02.Medium' levels, google/Google, Yes/No flags, mostly
empty, constant and key-like columns, duplicates)."""
import pytest

from propensity.plans.raw_leads import clean_raw_leads

COLS = ["Prospect ID", "Lead Number", "Lead Origin", "Lead Source", "Do Not Email", "Converted",
        "TotalVisits", "Total Time Spent on Website", "Page Views Per Visit", "Last Activity",
        "Specialization", "Tags", "City", "Asymmetrique Activity Index",
        "Asymmetrique Activity Score", "Magazine", "Newspaper",
        "A free copy of Mastering The Interview", "Lead Profile"]
SCHEMA = ("`Prospect ID` string, `Lead Number` long, `Lead Origin` string, `Lead Source` string, "
          "`Do Not Email` string, `Converted` int, `TotalVisits` double, "
          "`Total Time Spent on Website` double, `Page Views Per Visit` double, "
          "`Last Activity` string, `Specialization` string, `Tags` string, `City` string, "
          "`Asymmetrique Activity Index` string, `Asymmetrique Activity Score` double, "
          "`Magazine` string, `Newspaper` string, `A free copy of Mastering The Interview` string, "
          "`Lead Profile` string")


@pytest.fixture
def raw(spark):
    rows = [
        ("p1", 1, "API", "google", "No", 1, 2.0, 100.0, 2.0, "Email Opened", "Select", "Ringing",
         "Mumbai", "02.Medium", 14.0, "No", "No", "Yes", None),
        ("p2", 2, "API", "Google", "Yes", 0, None, 50.0, 1.0, "Unreachable", None, None,
         "Select", "01.High", 16.0, "No", "Yes", "No", None),
        ("p3", 3, "Lead Import", "Facebook", "No", 0, 4.0, 20.0, 4.0, "SMS Sent",
         "Finance Management", "Lost to EINS", "Mumbai", None, 12.0, "No", "No", "No", "Select"),
        ("p4", 4, "API", "bing", "No", 1, 3.0, 80.0, 1.5, "SMS Sent", "E-COMMERCE", "Busy",
         "Thane & Outskirts", "03.Low", 10.0, "No", "No", "Yes", None),
        ("p5", 5, "API", None, "No", 1, 3.0, 80.0, 1.5, "SMS Sent", "E-COMMERCE", "Busy",
         "Thane & Outskirts", "03.Low", 10.0, "No", "No", "Yes", None),
        ("p6", 6, "API", None, "No", 1, 3.0, 80.0, 1.5, "SMS Sent", "E-COMMERCE", "Busy",
         "Thane & Outskirts", "03.Low", 10.0, "No", "No", "Yes", None),
    ]
    return spark.createDataFrame(rows, SCHEMA)


def test_clean_raw_leads(raw):
    out = clean_raw_leads(raw, iterative_rounds=2)
    cols = set(out.columns)
    assert "lead_id" in cols and "converted" in cols
    for gone in ("prospect id", "magazine", "newspaper", "asymmetrique activity score",
                 "lead profile", "Prospect ID"):
        assert gone not in cols
    got = {r.lead_id: r for r in out.collect()}
    # after recoding, 'bing' and NULL sources are both 'Others': leads 5 and 6
    # repeat lead 4 and only the first is kept
    assert set(got) == {1, 2, 3, 4}
    assert got[1].lead_source == "Google" and got[2].lead_source == "Google"
    assert got[3].lead_source == "Social Media" and got[4].lead_source == "Others"
    assert got[1].specialization == "Others" and got[2].specialization == "Others"
    assert got[3].specialization == "Management" and got[4].specialization == "E-Business"
    assert got[1].tags == "Try Calling again" and got[2].tags == "Others"
    assert got[3].tags == "Lost"
    assert got[2].last_activity == "others"
    assert got[1].activity_index == "Medium" and got[2].activity_index == "High"
    assert got[3].activity_index in {"Medium", "High", "Low"}  # drawn from the levels
    assert got[2].city in {"Mumbai", "Thane & Outskirts"}
    assert got[1].do_not_email == 1 and got[2].do_not_email == 0
    assert got[1].free_interview_copy == 0
    assert got[2].total_visits is not None
