"""Discovery, records and logs over landed pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import crawl, fetch, profile, records
from . import twin as q
from .fixtures import cte, frame
from .page_queries import _PROFILE_SQL, _WINNERS
from .registry import query
from .text_queries import _links_sql

_HOST = "lower(split_part(split_part({}, '://', 2), '/', 1))"


def _bfs_sql(edges: str, starts: str, max_depth: int) -> str:
    """Reached pages level by level; the collected links are their targets."""
    return f"""inner_edges AS (SELECT DISTINCT src, dst FROM ({edges}) WHERE {_HOST.format('src')} = {_HOST.format('dst')}),
    reached AS (
      SELECT start, start AS page, 0 AS depth FROM ({starts})
      UNION
      SELECT start, dst, depth + 1 FROM reached JOIN inner_edges ON src = page WHERE depth < {max_depth}),
    collected AS (SELECT start, dst AS url, min(depth) AS depth FROM reached JOIN inner_edges ON src = page GROUP BY 1, 2)
    """


_SHOPS = "SELECT DISTINCT 'https://shop' || CAST(p_partkey % 3 AS varchar) || '.example.com/' AS start FROM part"


def _shop_starts(spark, sf):
    return frame(spark, sf, "part").select(F.concat(
        F.lit("https://shop"), (F.col("p_partkey") % 3).cast("string"), F.lit(".example.com/")).alias("start")).distinct()


@query("crawl_bfs", cte("graph_edges") + "," + _bfs_sql("SELECT src, dst FROM graph_edges", _SHOPS, 2)
       + "SELECT start, url, depth FROM collected")
def crawl_bfs(spark, sf):
    return crawl.crawl_bfs(frame(spark, sf, "graph_edges"), _shop_starts(spark, sf), max_depth=2)


_SITES = "SELECT url AS start FROM site_pages WHERE page_id < 3"


def _site_crawl(spark, sf, depth):
    pages = frame(spark, sf, "site_pages")
    starts = pages.where(F.col("page_id") < 3).select(F.col("url").alias("start"))
    return crawl.crawl_bfs(crawl.page_links(pages), starts, max_depth=depth)


@query("crawl_bfs_filtered", cte("site_pages") + "," + _bfs_sql(_links_sql("site_pages"), _SITES, 2)
       + "SELECT DISTINCT url FROM collected WHERE contains(url, '/info_')")
def crawl_bfs_filtered(spark, sf):
    found = _site_crawl(spark, sf, 2)
    return found.where(F.col("url").contains("/info_")).select("url").distinct()


_SITE_LINKS = "SELECT src, dst FROM (" + _links_sql("site_pages") + ")"


@query("crawl_summary", cte("site_pages") + f"""
    SELECT count(*) AS links, count(*) FILTER (WHERE contains(dst, '/info_')) AS matched_links,
      count(DISTINCT CASE WHEN contains(dst, '/info_') THEN dst END) AS distinct_links, count(DISTINCT src) AS pages
    FROM ({_SITE_LINKS})""")
def crawl_summary(spark, sf):
    return crawl.crawl_summary(crawl.page_links(frame(spark, sf, "site_pages")), "/info_")


@query("listing_to_profiles", cte("profile_pages", "listing_pages")
       + _PROFILE_SQL + " WHERE s_suppkey IN (SELECT l_suppkey FROM lineitem)")
def listing_to_profiles(spark, sf):
    return crawl.listing_profiles(
        frame(spark, sf, "profile_pages").select("url", "html"), frame(spark, sf, "listing_pages"),
        r"https://shops\.example\.com/review/info_[a-zA-Z0-9]+",
        read=lambda pages: profile.extract_profiles(pages, keep=("url",))).drop("url")


# what each page shows, by the source that settles it
_SOURCE = """CASE WHEN html IS NULL THEN '' WHEN page_id % 4 IN (0, 2) THEN 'requests' WHEN page_id % 8 IN (3, 5) THEN 'selenium'
    WHEN page_id % 8 = 1 THEN 'brightdata' ELSE '' END"""


@query("discover_and_extract", cte("site_pages") + f""", chosen AS (SELECT url, page_id, {_SOURCE} AS src, html FROM site_pages),
    shown AS (SELECT url, page_id, src, html FROM chosen WHERE src <> ''),
    """ + _bfs_sql(_links_sql("shown"), _SITES, 3) + rf"""
    SELECT url AS "URL", coalesce(src, '') AS fetch_source,
      coalesce({q.collapse(q.entities(q.group('html', '(?is)<title[^>]*>(.*?)</title')))}, '') AS title,
      coalesce(src || ' ' || page_id, '') AS description,
      coalesce(array_to_string(list_sort(list_distinct(list_append(list_transform(regexp_extract_all(html,
        '[a-zA-Z0-9._%+\-]+@[a-zA-Z0-9.\-]+\.[a-zA-Z]{{2,}}'), lambda e: lower(e)), src || '@site' || page_id % 3 || '.example.com'))), '; '), '') AS emails,
      coalesce('+48' || page_id, '') AS phones, coalesce('Road ' || page_id || ', 00-001 Town', '') AS address,
      coalesce(array_to_string(list_sort(list_distinct(regexp_extract_all(html,
        '(?i)href="(https?://(?:[a-z0-9\-]+\.)*(?:facebook|linkedin|instagram|twitter|x|youtube|tiktok)\.com/[^"\s]*)"', 1))), '; '), '') AS socials,
      coalesce('slogan: via ' || src, '') AS notes
    FROM (SELECT DISTINCT url FROM collected WHERE contains(url, '/info_')) LEFT JOIN shown USING (url)""")
def discover_and_extract(spark, sf):
    starts = frame(spark, sf, "site_pages").where(F.col("page_id") < 3).select(F.col("url").alias("start"))
    return crawl.discover(frame(spark, sf, "site_attempts"), starts, "/info_", max_depth=3)


def _record_inputs(spark, sf):
    fetched = fetch.first_settled_facts(frame(spark, sf, "attempts"))
    answers = frame(spark, sf, "pages").select(
        F.concat(F.lit("https://d"), F.col("page_id").cast("string"), F.lit(".example.com")).alias("url"),
        F.when(F.col("page_id") % 3 == 0, F.lit("plain answer"))
        .otherwise(F.concat(F.lit('{"Company Name": "Firm '), "page_id", F.lit('"}'))).alias("model_output"))
    return fetched, answers


_ANSWER_SQL = """SELECT 'https://d' || page_id || '.example.com' AS url, page_id,
    CASE WHEN page_id % 3 = 0 THEN 'plain answer' ELSE '{"Company Name": "Firm ' || page_id || '"}' END AS model_output FROM pages"""


@query("record_assemble", cte("attempts") + f"""
    SELECT w.url, w.source AS fetch_source, 'company' AS mode,
      CASE WHEN page_id % 3 = 0 THEN '{{"raw":"plain answer"}}' ELSE '{{"Company Name":"Firm ' || page_id || '"}}' END AS data
    FROM {_WINNERS} AS w JOIN ({_ANSWER_SQL}) AS a ON w.url = a.url""")
def record_assemble(spark, sf):
    fetched, answers = _record_inputs(spark, sf)
    return records.assemble_records(fetched, answers, "company").withColumn("data", F.to_json("data"))


@query("result_log", cte("attempts") + f"""
    SELECT u.url AS "URL", coalesce(w.source, '') AS fetch_source, CASE WHEN w.url IS NULL THEN '' ELSE a.model_output END AS model_output
    FROM (SELECT DISTINCT url FROM attempts) AS u LEFT JOIN {_WINNERS} AS w ON u.url = w.url JOIN ({_ANSWER_SQL}) AS a ON a.url = u.url""")
def result_log(spark, sf):
    fetched, answers = _record_inputs(spark, sf)
    return records.result_log(fetched, answers)

