import re

import pytest
from pyspark.sql import functions as F

from leadframe.operators import crm, pages

PEOPLE = ("i int, title string, seniority string, department string, city string, organization_country string, label string, "
          "organization_name string, industry string, email_status string, employees int, prospected boolean, keyword_tags array<string>")
ROWS = [
    (1, "Head of Sales", "Head", "Sales", "Berlin", "Germany", "A", "Org", "Retail", "verified", 50, False, ["Ecommerce", "B2B"]),
    (2, "sales intern", "intern", "sales", "berlin", "germany", "a", "org", "retail", "verified", 50, True, ["ecom"]),
    (3, None, None, None, None, None, None, None, None, None, None, None, None),
    (4, "CMO", "c_suite", "marketing", "PARIS", "France", "b", "Ürg", "Food", "guessed", 500, None, []),
    (5, "Owner", "OWNER", "sales", "Rome", "Italy", "c", "Org", "retail", "verified", 5, False, ["x\x1fy", "é"]),
]
CRITERIA = [
    {"titles": ("SALES",)}, {"not_titles": ("Sales",)}, {"seniorities": ("owner", "HEAD")}, {"departments": ("Sales",)}, {"locations": ("berlin", "rome")},
    {"organization_locations": ("GERMANY",)}, {"email_status": "verified"}, {"employees": (10, 500)}, {"prospected": False}, {"labels": ("A", "B")},
    {"organizations": ("üRG",)}, {"keyword_tags": ("ECOMMERCE", "É")}, {"industries": ("retail", "food")}, {"keyword_tags": ("x\x1fy",)}, {"keyword_tags": ("ecomm",)},
    {"titles": ("sales", "owner"), "not_titles": ("intern",), "industries": ("Retail",), "email_status": "verified"}, {},
]
WANT = [{1, 2}, {3, 4, 5}, {1, 5}, {1, 2, 5}, {1, 2, 5}, {1, 2}, {1, 2, 5}, {1, 2, 4}, {1, 5}, {1, 2, 4}, {4}, {1, 5}, {1, 2, 4, 5}, {5}, set(), {1, 5}, {1, 2, 3, 4, 5}]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    people = spark.createDataFrame(ROWS, PEOPLE)
    return people, crm.write_search_table(people, str(tmp_path_factory.mktemp("search") / "people"))


@pytest.mark.parametrize("criteria, want", list(zip(CRITERIA, WANT)))
def test_each_criterion_on_plain_and_stored_people(tables, criteria, want):
    for table in tables:
        got = crm.people_search(table, **criteria)
        assert {r.i for r in got.collect()} == want and got.columns == tables[0].columns


def test_criteria_reach_the_scan(spark, tables):
    keep = spark.conf.get("spark.sql.maxMetadataStringLength")
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    stored = crm.people_search(tables[1], titles=("a",), not_titles=("b",), seniorities=("x", "y"), departments=("x", "y"), locations=("x", "y"),
                               organization_locations=("x", "y"), labels=("x", "y"), organizations=("x", "y"), industries=("x", "y"),
                               keyword_tags=("t",), email_status="v", employees=(1, 2), prospected=True)
    plan = stored._jdf.queryExecution().executedPlan().toString()
    spark.conf.set("spark.sql.maxMetadataStringLength", keep)
    pushed = re.search(r"PushedFilters: (.*)", plan).group(1)
    for column in ("seniority", "department", "city", "organization_country", "label", "organization_name", "industry"):
        assert f"In({column}_key, [x,y])" in pushed
    for text in ("StringContains(title_key,a)", "Not(StringContains(title_key,b))", "StringContains(keyword_tags_key,", "EqualTo(email_status,v)",
                 "GreaterThanOrEqual(employees,1)", "EqualTo(prospected,true)"):
        assert text in pushed


def test_loads_are_counted_by_the_write(spark, tmp_path):
    records = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (7, "d"), (None, "e")], "load int, v string").repartition(3)
    announced = spark.createDataFrame([(1, 2), (2, 5), (3, 0), (4, 1)], "load int, announced bigint")
    reads = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            reads.add(batch.num_rows)
            yield batch

    got = crm.write_loads(records.mapInArrow(counted, records.schema), announced, "load", str(tmp_path / "out"))
    assert {tuple(r) for r in got.collect()} == {(1, 2, 2, True), (2, 5, 1, False), (3, 0, 0, True), (4, 1, 0, False), (None, None, 2, None)}
    assert spark.read.parquet(str(tmp_path / "out")).count() == 5 and reads.value == 5
    again = crm.write_loads(records.where("load < 3"), announced, "load", str(tmp_path / "out"))
    assert again.count() == 4 and spark.read.parquet(str(tmp_path / "out")).count() == 8


def test_broken_fetches_are_errors(spark):
    cells = spark.createDataFrame([(1, "a.com"), (2, "b.com"), (3, "c.com"), (4, "d.com"), (5, "nope"), (6, "e.com")], "row_idx int, raw string")
    tries = spark.createDataFrame([
        ("https://a.com", "requests", None, None, "timed out"), ("https://b.com", "requests", None, None, "timed out"),
        ("https://b.com", "selenium", 200, "<p>commerce</p>", None), ("https://c.com", "requests", 403, None, " "),
        ("https://d.com", "requests", 200, "", "late"), ("https://e.com", "brightdata", None, None, "another source")],
        "url string, source string, status int, html string, error string")
    label = lambda **kw: {r.row_idx: r.label for r in pages.ecommerce_domains(cells, tries, **kw).collect()}
    assert label(error="error") == {1: "Error", 2: "Yes", 3: "No content", 4: "No content", 5: "Invalid domain", 6: "No content"}
    assert label()[1] == "No content"
