"""Job-title rules, one row per branch and edge."""

import pytest
from pyspark.sql import functions as F

from leadframe.functions import dictionaries as d
from leadframe.operators import titles as T

DEPARTMENT = {
    "Customer Success Manager": "sales", "cs lead": "sales", "Head of E-Commerce": "e-commerce",
    "Developer Advocate": "marketing", "Pre-Sales Consultant": "sales", "Solutions Engineer": "sales",
    "Cloud Architect": "engineering & technical", "Test Automation Lead": "engineering & technical",
    "Quality Manager": "operations", "TPM": "engineering & technical", "Digital Project Manager": "engineering & technical",
    "Project Manager": "operations", "Recruiter": "human resources & hr", "GDPR Officer": "legal & law",
    "RevOps Lead": "sales", "Salesforce Developer": "engineering & technical", "Help Desk Agent": "operations",
    "seo analyst": "marketing", "data analyst": "engineering & technical", "Logistics Planner": "operations",
    "CEO": "c-suite", "Vice President": "c-suite", "homeowner": "c-suite", "SVP": "c-suite",
    "Product Owner": "product", "Process Owner": None, "Data Owner": None, "Content Writer": "marketing",
    "HR": "human resources & hr", "Talent Lead": "human resources & hr", "pm": "product", "pm s helper": None,
    "PO": "product", "Account Executive": None, "account exec": "sales", "Office Manager": "operations",
    "DevOps": "engineering & technical", "UX": "graphics & design", "Controller": "finance & accounting",
    "Trainer": "consulting", "Astronaut": None, "Service Advice": None, "Chief X Officer": "c-suite", "Chief Executive Officer": None,
    "Data Analyst": None, "3d": "graphics & design", "Größe Marketing": "marketing", "éceo": None,
}

LEVEL = {
    "Executive Assistant to the CEO": "mid", "Office of the CEO": "mid", "CEO": "c-suite", "Vice President": "c-suite",
    "VP Sales": "executive", "EVP": "executive", "Head of X": "lead/head/director", "Director": "lead/head/director",
    "Product Owner": "", "Sales Manager": "manager", "Intern": "entry lvl", "Junior Dev": "entry lvl",
    "Senior Dev": "senior/expert/specialist", "Marketing Specialist": "senior/expert/specialist",
    "Assistant": "mid", "Developer": "", "": "", "pm": "manager", "pm s": "",
}

TAG = {
    "VP of Sales": "VP", "vice president": "VP", "Co-Owner": "Co-Owner", "co founder": "Co-Founder", "President": "President",
    "Owner": "Owner", "Founder & CEO": "Founder", "CEO": "CEO", "Chief Marketing Officer": "CMO", "CSO": "CSO",
    "chief operating officer": "COO", "CGO": "CGO", "Product Owner": None, "Manager": None, "Coowner": "Co-Owner",
}


def test_department(column):
    got = column(list(DEPARTMENT), T.department)
    assert dict(zip(DEPARTMENT, got)) == DEPARTMENT


def test_level(column):
    assert dict(zip(LEVEL, column(list(LEVEL), T.level))) == LEVEL


def test_tag(column):
    assert dict(zip(TAG, column(list(TAG), T.c_level_tag))) == TAG
    assert column(["CSO"], lambda c: T.c_level_tag(c, {"CSO": "CMO"})) == ["CMO"]


def test_rule_order_is_stable(column, monkeypatch):
    """Dropping the last rules never changes a title an earlier rule settles."""
    before = dict(zip(DEPARTMENT, column(list(DEPARTMENT), T.department)))
    monkeypatch.setattr(d, "DEPARTMENT_WORDS", d.DEPARTMENT_WORDS[:4])
    after = dict(zip(DEPARTMENT, column(list(DEPARTMENT), T.department)))
    kept = {label for label, _ in d.DEPARTMENT_WORDS[:4]}
    for title, label in before.items():
        assert after[title] == label or label not in kept


@pytest.fixture()
def rows(spark):
    data = [(1, "CEO"), (2, " "), (3, None), (4, "Wizard"), (5, "wizard  two"), (6, "Unknown thing")]
    return spark.createDataFrame(data, "row_idx bigint, title string")


def test_cascade(spark, rows):
    cache = spark.createDataFrame([("Wizard", "consulting", 0.9)], "title_norm string, label string, score double")
    scores = spark.createDataFrame(
        [("Wizard", "sales", 0.99), ("wizard two", "sales", 0.6), ("wizard two", "product", 0.2),
         ("Unknown thing", "sales", 0.5)], "title_norm string, label string, score double")
    got = {r.row_idx: (r.category, r.score) for r in T.classify_titles(rows, cache, scores).collect()}
    assert got == {1: ("c-suite", 1.0), 2: ("", 0.0), 3: ("", 0.0), 4: ("consulting", 0.9),
                   5: ("sales", 0.6), 6: ("other", 0.5)}


def test_cascade_without_lookups(rows):
    got = {r.row_idx: r.category for r in T.classify_titles(rows).collect()}
    assert got == {1: "c-suite", 2: "", 3: "", 4: None, 5: None, 6: None}


def test_cascade_keeps_every_row_of_a_hot_title(spark):
    """One unresolved title and the blanks hold most of the rows."""
    data = spark.range(30_000).select(
        F.col("id").alias("row_idx"),
        F.when(F.col("id") % 3 == 0, "Wizard").when(F.col("id") % 3 == 1, "")
        .otherwise(F.concat(F.lit("thing "), F.col("id").cast("string"))).alias("title"))
    cache = spark.createDataFrame([("Wizard", "consulting", 0.9), ("thing 5", "product", 0.8)],
                                  "title_norm string, label string, score double")
    got = {(r.category, r["count"]) for r in T.classify_titles(data, cache).groupBy("category").count().collect()}
    assert got == {("consulting", 10_000), ("", 10_000), ("product", 1), (None, 9_999)}


def test_position_tags(spark, rows):
    renames = spark.createDataFrame([("Wizard", " Magician ")], "title string, renamed string")
    got = {r.row_idx: r.position_tag for r in T.tag_positions(rows, renames).collect()}
    assert got == {1: "CEO", 2: "empty", 3: "empty", 4: "Magician", 5: "error", 6: "error"}


def test_simplify(spark):
    cases = {
        "Team Lead": "Team Lead", "E-Commerce Architect & Innovation Engineer": "E-Commerce Architect",
        "Lead Developer / Tech Lead": "Lead Developer", "Founder, Managing Partner": "Founder",
        "Chief of Marketing in Shopco": "CMO", "Chief of Technology": "CTO", "🚀 Senior Ninja": "Senior Ninja",
        "Head of Finance": "Head of Finance", "": "",
    }
    rows = spark.createDataFrame([(k, v) for k, v in cases.items()], "t string, want string")
    for r in T.simplify_titles(rows, "t").collect():
        assert r.short_title == r.want


def test_unresolved(spark, rows):
    cache = spark.createDataFrame([("Wizard", "x", 1.0)], "title_norm string, label string, score double")
    got = {r.title_norm for r in T.unresolved_titles(rows, cache).collect()}
    assert got == {"wizard two", "Unknown thing"}
