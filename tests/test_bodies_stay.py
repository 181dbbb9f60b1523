"""Page bodies stay where they are read: no exchange of a plan carries them."""

import re

import pytest
from pyspark.sql import functions as F

from leadframe.operators import crawl, profile
from leadframe.operators.joins import might_be_in
from leadframe.plans import QUERIES
from leadframe.session import materialize


def moved(df, column="html"):
    """Exchanges of the plan that carry the column."""
    text = df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    blocks = re.findall(r"\(\d+\) (?:Broadcast|Shuffle)?Exchange.*?\n(Input.*?)\n", text)
    assert blocks or "Exchange" not in text
    return [b for b in blocks if re.search(rf"\b{column}#", b)]


@pytest.fixture
def plain_joins(spark):
    keep = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    for k, v in keep.items():
        spark.conf.set(k, v)


def test_the_check_sees_a_moved_body(spark, plain_joins):
    pages = spark.createDataFrame([("u", "h")], "url string, html string").repartition(2)
    assert moved(pages.join(spark.createDataFrame([("u",)], "url string"), "url"))


@pytest.mark.parametrize("name", ["about_description", "listing_to_profiles", "discover_and_extract"])
def test_no_exchange_of_bodies(spark, sf_dir, plain_joins, name):
    assert moved(QUERIES[name](spark, sf_dir)) == []


def test_bloom_filter_keeps_every_wanted_row(spark):
    rows = spark.range(50_000).select(F.concat(F.lit("key "), F.col("id").cast("string")).alias("k"), (F.col("id") % 7).alias("n"))
    wanted = materialize(rows.where("n = 3").select("k", "n").limit(5_000), "wanted")
    near = rows.where(might_be_in(["k", "n"], wanted, ["k", "n"]))
    assert near.join(wanted, ["k", "n"], "left_semi").count() == 5_000
    assert near.count() < 5_000 + 500
    none = materialize(rows.where("n > 9").select("k"), "none")
    assert rows.where(might_be_in(["k"], none, ["k"])).count() == 0


def test_listing_reads_repeated_and_missing_pages(spark):
    listing = spark.createDataFrame([("<a href='https://x.de/info_1'> https://x.de/info_2 https://x.de/info_1",), (None,)], "html string")
    pages = spark.createDataFrame([("https://x.de/info_1", "<p>a"), ("https://x.de/info_1", "<p>b"), ("https://x.de/info_9", "<p>c")],
                                  "url string, html string")
    pattern = r"https://x\.de/info_\d+"
    assert sorted(r.html for r in crawl.listing_profiles(pages, listing, pattern).collect()) == ["<p>a", "<p>b"]
    read = lambda p: profile.main_content(p, "html", "text").select("url", "text")
    assert crawl.listing_profiles(pages, listing, pattern, read=read).columns == ["url", "text"]


def test_discovery_follows_the_settled_source(spark):
    rows = [("https://s.de/", "requests", None), ("https://s.de/", "selenium", '<a href="/p/1">1</a><a href="https://t.de/p/9">x</a>'),
            ("https://s.de/", "brightdata", '<a href="/p/hidden">no</a>'), ("https://s.de/p/1", "requests", '<a href="/p/2">2</a><title>One</title>'),
            ("https://s.de/p/1", "requests", '<a href="/p/2">2</a><title>One</title>'), ("https://s.de/p/2", "brightdata", '<a href="/p/3">3</a><title>Two</title>'),
            ("https://s.de/p/3", "requests", " ")]
    attempts = spark.createDataFrame(rows, "url string, source string, html string")
    starts = spark.createDataFrame([("https://s.de/",)], "start string")
    got = {r.URL: (r.fetch_source, r.title) for r in crawl.discover(attempts, starts, "/p/", max_depth=2).collect()}
    assert got == {"https://s.de/p/1": ("requests", "One"), "https://s.de/p/2": ("brightdata", "Two"), "https://s.de/p/3": ("", "")}
