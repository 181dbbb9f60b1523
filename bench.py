"""Time the headline queries and print one JSON line.

The given text tables are one row group each, which one core reads.  They are
rewritten before the clock starts, as several files like any table of a cluster.

BENCH_SF_DIR   input folder, default /root/testdata/sf0.1
BENCH_CPUS     cores of the local master, default 8
BENCH_QUERIES  comma-separated names instead of the headline list, or "all"
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from leadframe.plans import QUERIES
from leadframe.session import build_session

HEADLINE = (
    "html_to_text_flat", "html_to_text_lines", "strip_consent", "keyword_votes", "classify_exhibitor",
    "classify_ecommerce", "classify_shop_sp", "shop_category_tags", "classify_shop_domains", "classify_title",
    "classify_level", "classify_title_cascade", "position_tag_cascade", "page_links", "links_sorted", "about_link",
    "page_contacts", "main_content", "payload_to_columns_company", "payload_to_columns_speaker", "exhibitor_score",
    "deals_flatten", "companies_flatten", "contacts_flatten", "prospects_union", "enrich_email", "fetch_coalesce",
    "crawl_bfs", "crawl_bfs_filtered", "discover_and_extract", "writeback_preserve", "stream_classify",
)


def _spread_tables(spark, sf_dir: str, parts: int) -> str:
    """A folder with the same tables, the two text tables in ``parts`` files."""
    folder = tempfile.mkdtemp(prefix="bench-tables-")
    for name in os.listdir(sf_dir):
        if name in ("documents.parquet", "pages.parquet"):
            spark.read.parquet(f"{sf_dir}/{name}").repartition(parts).write.parquet(f"{folder}/{name}")
        else:
            os.symlink(os.path.abspath(f"{sf_dir}/{name}"), f"{folder}/{name}")
    return folder


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES")
    names = list(QUERIES) if chosen == "all" else chosen.split(",") if chosen else HEADLINE
    spark = build_session("bench", f"local[{cpus}]", spark__sql__shuffle__partitions=str(max(int(cpus), 1)),
                          spark__driver__memory="16g", spark__checkpoint__dir=tempfile.mkdtemp(prefix="bench-"))
    spark.sparkContext.setLogLevel("ERROR")
    tables = _spread_tables(spark, sf_dir, int(cpus))
    spark.read.parquet(f"{tables}/customer.parquet").count()  # start-up is not measured
    times = {}
    for name in names:
        began = time.perf_counter()
        QUERIES[name](spark, tables).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - began, 3)
    spark.stop()
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "text_tables": f"rewritten as {cpus} files, untimed", "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()
