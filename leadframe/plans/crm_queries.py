"""CRM flattening, search, enrichment and write-back queries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from ..operators import crm, enrich, writeback
from ..session import scratch_path
from ..sources import files
from . import twin as q
from .fixtures import cte, frame
from .registry import query


def company_pages(spark, sf):
    """Landed company pages: suppliers as accounts, customers as organizations."""

    def listed(table, key, name, balance, out):
        item = F.struct(
            F.col(name).alias("name"), F.concat(F.lower(F.replace(name, F.lit("#"), F.lit(""))), F.lit(".com")).alias("primary_domain"),
            F.when(F.col(balance) > 0, F.floor(balance).cast("string")).alias("organization_revenue"),
            F.lit("+48 1").alias("sanitized_phone"), F.lit(1990).alias("founded_year"))
        return frame(spark, sf, table).groupBy(F.floor(F.col(key) / 100).cast("bigint").alias("page_no")) \
            .agg(F.collect_list(item).alias(out))

    accounts = listed("supplier", "s_suppkey", "s_name", "s_acctbal", "accounts")
    organizations = listed("customer", "c_custkey", "c_name", "c_acctbal", "organizations")
    return accounts.join(organizations, "page_no", "full")


def _company_select(name, balance):
    return f"""SELECT {name} AS name, lower(replace({name}, '#', '')) || '.com' AS domain,
      CASE WHEN {balance} > 0 THEN CAST(CAST(floor({balance}) AS bigint) AS varchar) ELSE '' END AS organization_revenue,
      '' AS organization_city, '' AS organization_country, '' AS website_url, '' AS linkedin_url, '' AS twitter_url,
      '' AS facebook_url, '1990' AS founded_year, '' AS market_cap, '+48 1' AS phone, '' AS alexa_ranking"""


@query("companies_flatten", f"""
    {_company_select('s_name', 's_acctbal')} FROM supplier UNION ALL {_company_select('c_name', 'c_acctbal')} FROM customer""")
def companies_flatten(spark, sf):
    return crm.flatten_companies(company_pages(spark, sf))


@query("contacts_flatten", cte("people") + """
    SELECT first_name, coalesce(last_name, '') AS last_name, CASE WHEN employees > 500 THEN organization_name ELSE '' END AS organization_name,
      title, '' AS linkedin_url, city, organization_country AS country, email, '' AS phone, -1 AS "confidence score", 'not_in_hunter' AS mail_status
    FROM people""")
def contacts_flatten(spark, sf):
    org = F.when(F.col("employees") > 500, F.struct(F.col("organization_name").alias("name")))
    item = F.struct("first_name", "last_name", org.alias("organization"), "title", "city",
                    F.col("organization_country").alias("country"), "email")
    landed = frame(spark, sf, "people").groupBy(F.floor(F.col("row_idx") / 100).alias("page_no")) \
        .agg(F.collect_list(item).alias("contacts"))
    return crm.flatten_contacts(landed)


@query("deals_flatten", """
    WITH deal_page AS (SELECT CAST(floor(o_orderkey / 8) AS bigint) AS page_no, max(o_totalprice) AS top FROM orders GROUP BY 1)
    SELECT CAST(o_orderkey AS varchar) AS id, 'Deal ' || o_orderkey AS title, CAST(CAST(floor(o_totalprice) AS bigint) AS varchar) AS value,
      'EUR' AS currency, o_orderstatus AS status, CAST(NULL AS varchar) AS add_time, CAST(NULL AS varchar) AS update_time, CAST(o_orderkey % 5 AS varchar) AS stage_id,
      CAST(NULL AS varchar) AS pipeline_id, CAST(NULL AS varchar) AS owner_name, CASE WHEN o_orderkey % 2 = 0 THEN 'P' || o_orderkey END AS person_name,
      CASE WHEN o_orderkey % 3 = 0 THEN 'Org' END AS org_name,
      CASE WHEN o_orderkey % 2 = 0 AND o_orderkey % 5 <> 0 THEN 'p' || o_orderkey || '@example.com' END AS person_email,
      CASE WHEN o_orderkey % 3 = 0 THEN 'Street 1' END AS org_address, o_orderpriority AS lost_reason,
      CAST(NULL AS varchar) AS close_time, CAST(NULL AS varchar) AS won_time, CAST(NULL AS varchar) AS first_won_time
    FROM orders JOIN deal_page AS p ON p.page_no = floor(o_orderkey / 8) WHERE top BETWEEN 150000 AND 499000""")
def deals_flatten(spark, sf):
    return crm.flatten_deals(frame(spark, sf, "deal_pages"))


@query("deals_failed", """
    SELECT page_no % 25 AS load_id, count(*) AS pages, count(*) FILTER (WHERE top > 499000) AS failed
    FROM (SELECT CAST(floor(o_orderkey / 8) AS bigint) AS page_no, max(o_totalprice) AS top FROM orders GROUP BY 1) GROUP BY 1""")
def deals_failed(spark, sf):
    return crm.failed_pages(frame(spark, sf, "deal_pages"), "load_id")


_CUTOFF = "2024-01-02T00:00:00+0000"
_KINDS = ("click", "error", "purchase", "signup", "view")
# Every form of time the service sends, and one that is none, by user.
_TIME_FORMS = ("yyyy-MM-dd'T'HH:mm:ss'+0000'", "yyyy-MM-dd'T'HH:mm:ss'Z'", "yyyy-MM-dd'T'HH:mm:ss",
               "yyyy-MM-dd'T'HH:mm:ss'.250Z'", "yyyy-MM-dd'T'HH:mm:ss'.250+00:00'", "yyyy-MM-dd HH:mm:ss", "'never'")
_EVENT_TIME = """CASE WHEN user_id % 7 IN (3, 4) THEN date_trunc('second', ts) + INTERVAL 250 MILLISECONDS
    WHEN user_id % 7 <> 6 THEN date_trunc('second', ts) END"""


def _prospects(spark, sf):
    when = F.coalesce(*[F.when(F.col("user_id") % 7 == i, F.date_format("ts", form)) for i, form in enumerate(_TIME_FORMS)])
    return frame(spark, sf, "events").select("event_id", "event_type", "value", "props",
                                             when.alias("last_contacted"))


@query("prospects_since", f"""
    SELECT event_id, event_type, CAST({_EVENT_TIME} AS timestamp) AS last_contacted
    FROM events WHERE {_EVENT_TIME} >= TIMESTAMP '2024-01-02 00:00:00'""")
def prospects_since(spark, sf):
    rows = _prospects(spark, sf).select("event_id", "event_type", "last_contacted")
    return crm.recent_prospects(rows, _CUTOFF)


@query("prospects_union", f"""
    SELECT event_id, CAST({_EVENT_TIME} AS timestamp) AS last_contacted, event_type || '_value' AS name, value
    FROM events WHERE {_EVENT_TIME} >= TIMESTAMP '2024-01-02 00:00:00'""")
def prospects_union(spark, sf):
    """Pages with a column of their own each, outer-united without naming the columns: one scan, long rows."""
    rows = _prospects(spark, sf).select("event_id", "last_contacted", F.concat("event_type", F.lit("_value")).alias("name"), "value")
    return crm.recent_prospects(rows, _CUTOFF)


@query("prospects_outer", f"""
    SELECT event_id, CAST({_EVENT_TIME} AS timestamp) AS last_contacted, CASE WHEN event_id % 2 = 0 THEN value END AS even_value,
      CASE WHEN event_id % 2 = 1 THEN event_type END AS odd_type
    FROM events WHERE {_EVENT_TIME} >= TIMESTAMP '2024-01-02 00:00:00'""")
def prospects_outer(spark, sf):
    rows, even = _prospects(spark, sf), F.col("event_id") % 2 == 0
    return crm.union_prospects([
        rows.where(even).select("event_id", "last_contacted", F.col("value").alias("even_value")),
        rows.where(~even).select("event_id", "last_contacted", F.col("event_type").alias("odd_type"))], _CUTOFF)


def _record_pages(spark, sf):
    member = F.when(F.col("event_type") == "view", F.concat(F.lit('"viewer": "v'), "user_id")) \
        .otherwise(F.concat(F.lit('"actor": "u'), "user_id"))
    record = F.concat(F.lit('{"id": '), "event_id", F.lit(", "), member, F.lit('"}'))
    return frame(spark, sf, "events").groupBy(F.floor(F.col("event_id") / 20).alias("page_no")) \
        .agg(F.concat(F.lit("["), F.array_join(F.array_sort(F.collect_list(record)), ","), F.lit("]")).alias("payload"))


@query("prospects_widen", """
    SELECT CAST(event_id AS varchar) AS id, CASE WHEN event_type = 'view' THEN 'v' || user_id END AS viewer,
      CASE WHEN event_type <> 'view' THEN 'u' || user_id END AS actor
    FROM events""")
def prospects_widen(spark, sf):
    return crm.widen_prospects(_record_pages(spark, sf), ("actor", "id", "viewer"))


@query("prospects_members", """
    WITH r AS (SELECT CAST(floor(event_id / 20) AS bigint) AS page_no, event_id, event_type, user_id FROM events)
    SELECT page_no, 'id' AS name, CAST(event_id AS varchar) AS value FROM r
    UNION ALL SELECT page_no, CASE WHEN event_type = 'view' THEN 'viewer' ELSE 'actor' END,
      CASE WHEN event_type = 'view' THEN 'v' ELSE 'u' END || user_id FROM r""")
def prospects_members(spark, sf):
    return crm.prospect_members(_record_pages(spark, sf), "page_no").drop("record")


@query("people_search", cte("people") + """
    SELECT row_idx, title FROM people
    WHERE (contains(lower(title), 'marketing') OR contains(lower(title), 'sales')) AND NOT contains(lower(title), 'analyst')
      AND lower(industry) IN ('building', 'machinery', 'household') AND email_status = 'verified' AND employees BETWEEN 11 AND 9000""")
def people_search(spark, sf):
    return crm.people_search(
        frame(spark, sf, "people"), titles=("marketing", "sales"), not_titles=("analyst",),
        industries=("building", "machinery", "household"), email_status="verified", employees=(11, 9000),
    ).select("row_idx", "title")


@query("people_search_all", cte("people_wide") + """
    SELECT row_idx, title, seniority, department FROM people_wide
    WHERE (contains(lower(title), 'a') OR contains(lower(title), 'chief')) AND NOT contains(lower(title), 'intern')
      AND lower(seniority) IN ('owner', 'c_suite', 'vp', 'head') AND lower(department) IN ('master_marketing', 'master_sales')
      AND city <> 'NATION_3' AND lower(organization_country) NOT IN ('nation_4', 'nation_5') AND email_status = 'verified'
      AND employees BETWEEN 500 AND 9500 AND prospected = false AND lower(label) IN ('building', 'machinery', 'furniture', 'automobile')
      AND lower(organization_name) IN ('org building', 'org machinery', 'org furniture') AND lower(industry) <> 'household'
      AND (list_contains(keyword_tags, 'tag 1') OR list_contains(keyword_tags, 'machinery'))""")
def people_search_all(spark, sf):
    """All thirteen criteria against a stored search table."""
    table = crm.write_search_table(frame(spark, sf, "people_wide"), scratch_path(spark, "people"))
    places = [f"Nation_{i}" for i in range(25)]
    return crm.people_search(
        table, titles=("A", "chief"), not_titles=("intern",), seniorities=("owner", "C_Suite", "vp", "head"),
        departments=("master_marketing", "Master_Sales"), locations=[p for p in places if p != "Nation_3"],
        organization_locations=[p for p in places if p not in ("Nation_4", "Nation_5")], email_status="verified", employees=(500, 9500),
        prospected=False, labels=("building", "machinery", "furniture", "automobile"),
        organizations=("Org building", "org machinery", "org FURNITURE"), keyword_tags=("Tag 1", "machinery"),
        industries=("building", "machinery", "furniture", "automobile")).select("row_idx", "title", "seniority", "department")


@query("load_totals", """
    WITH page AS (SELECT CAST(floor(o_orderkey / 8) AS bigint) AS page_no, max(o_totalprice) AS top, count(*) AS n FROM orders GROUP BY 1),
    load AS (SELECT page_no % 25 AS load_id, CAST(sum(n) AS bigint) AS announced,
        CAST(coalesce(sum(n) FILTER (WHERE top BETWEEN 150000 AND 499000), 0) AS bigint) AS found FROM page GROUP BY 1)
    SELECT load_id, announced, found, found >= announced AS complete FROM load WHERE load_id < 20
    UNION ALL
    SELECT NULL, NULL, CAST(sum(found) AS bigint), NULL FROM load WHERE load_id >= 20 HAVING sum(found) > 0""")
def load_totals(spark, sf):
    """Deals written against the totals their loads announced; failed pages are missing, five loads announced nothing."""
    deals = crm.flatten_deals(frame(spark, sf, "deal_pages"), keep=("load_id",))
    return crm.write_loads(deals, frame(spark, sf, "deal_loads"), "load_id", scratch_path(spark, "deals"))


@query("company_search", cte("people") + """
    SELECT row_idx, organization_name FROM people
    WHERE (employees BETWEEN 21 AND 200 OR employees BETWEEN 5000 AND 999999)
      AND lower(organization_country) IN ('nation_1', 'nation_2', 'nation_12')""")
def company_search(spark, sf):
    return crm.company_search(
        frame(spark, sf, "people"), employee_ranges=((21, 200), (5000, 999999)),
        locations=("nation_1", "nation_2", "nation_12"),
    ).select("row_idx", "organization_name")


_PERSON_OK = " AND ".join(f"NOT {q.blank(c)}" for c in ("first_name", "last_name", "organization_name"))


@query("enrich_email", cte("people", "email_lookup") + f"""
    SELECT p.row_idx, coalesce(l.email, '') AS email, coalesce(CAST(l.confidence_score AS varchar), '') AS confidence_score,
      coalesce(l.mail_status, '') AS mail_status
    FROM (SELECT row_idx, trim(organization_name) AS o, trim(first_name) AS f, trim(last_name) AS s, {_PERSON_OK} AS ok FROM people) AS p
    LEFT JOIN email_lookup AS l ON ok AND l.organization_name = o AND l.first_name = f AND l.last_name = s""")
def enrich_email(spark, sf):
    people = frame(spark, sf, "people").select("row_idx", "first_name", "last_name", "organization_name")
    return enrich.enrich_email(people, frame(spark, sf, "email_lookup"), "row_idx") \
        .select("row_idx", "email", "confidence_score", "mail_status")


@query("enrich_company_email", """
    SELECT s_name AS name, s_suppkey, CASE WHEN n % 3 = 0 THEN NULL ELSE 'a' || s_suppkey || '@x.com' END AS email
    FROM (SELECT s_name, s_suppkey, s_nationkey AS n FROM supplier)""")
def enrich_company_email(spark, sf):
    suppliers = frame(spark, sf, "supplier")
    address = F.concat(F.lit("a"), "s_suppkey", F.lit("@x.com"))
    emails = F.when(F.col("s_nationkey") % 3 == 0, F.array().cast("array<struct<value:string>>")) \
        .otherwise(F.array(F.struct(address.alias("value")), F.struct(F.lit("second@x.com").alias("value"))))
    found = suppliers.select(F.col("s_name").alias("name"), emails.alias("emails"))
    companies = suppliers.select(F.col("s_name").alias("name"), "s_suppkey", F.lit("old").alias("email"))
    return enrich.enrich_company_email(companies, found, "s_suppkey").select("name", "s_suppkey", "email")


@query("verify_email", cte("people", "email_status") + """
    SELECT row_idx, people.email, status AS mail_status
    FROM people LEFT JOIN email_status ON people.email <> '' AND people.email = email_status.email""")
def verify_email(spark, sf):
    people = frame(spark, sf, "people").select("row_idx", "email")
    return enrich.verify_email(people, frame(spark, sf, "email_status"), "row_idx")


# --- rows of a sheet and their write-back ---------------------------------

@query("scan_row_range", cte("titles") + f"""
    SELECT row_idx, {q.strip('title')} AS title FROM titles WHERE row_idx >= 2 AND NOT {q.blank('title')}""")
def scan_row_range(spark, sf):
    return files.scan_rows(frame(spark, sf, "titles"), start=2, value="title")


def _sheet(spark, sf):
    return frame(spark, sf, "pages").select(F.col("page_id").alias("row_idx"), "url")


@query("writeback_blankfill", cte("fresh_labels") + """
    SELECT page_id AS row_idx, url, coalesce(label, '') AS label FROM pages LEFT JOIN fresh_labels ON page_id = row_idx""")
def writeback_blankfill(spark, sf):
    return writeback.fill_blank(_sheet(spark, sf), frame(spark, sf, "fresh_labels"), ["label"])


@query("writeback_preserve", cte("fresh_labels", "existing_labels") + """
    SELECT e.row_idx, CASE WHEN f.row_idx IS NOT NULL THEN f.label ELSE coalesce(e.label, '') END AS label
    FROM existing_labels AS e LEFT JOIN fresh_labels AS f ON e.row_idx = f.row_idx""")
def writeback_preserve(spark, sf):
    return writeback.keep_existing(frame(spark, sf, "existing_labels"), frame(spark, sf, "fresh_labels"))


@query("writeback_skip_empty", cte("fresh_labels") + f"""
    WITH b AS (SELECT page_id AS row_idx, CAST(floor(page_id / 3) AS bigint) AS bucket, coalesce(label, '') AS label
      FROM pages LEFT JOIN fresh_labels ON page_id = row_idx)
    SELECT * FROM b WHERE bucket IN (SELECT bucket FROM b WHERE NOT {q.blank('label')})""".replace("WITH b AS", ", b AS", 1))
def writeback_skip_empty(spark, sf):
    filled = writeback.fill_blank(_sheet(spark, sf), frame(spark, sf, "fresh_labels"), ["label"])
    updates = filled.select("row_idx", writeback.bucket_of("row_idx", 0, 3).alias("bucket"), "label")
    return writeback.skip_empty_buckets(updates, "bucket", "label").select("row_idx", "bucket", "label")


@query("bucket_progress", cte("titles") + f"""
    SELECT CAST(floor((row_idx - 1) / 200) AS bigint) AS bucket, min(row_idx) AS first_row, max(row_idx) AS last_row,
      count(*) AS rows, count(*) FILTER (WHERE NOT {q.blank('title')}) AS filled
    FROM titles GROUP BY 1""")
def bucket_progress(spark, sf):
    return writeback.bucket_progress(frame(spark, sf, "titles"), 1, 200, "title")


@query("incremental_anti", cte("fresh_labels") + """
    SELECT page_id AS row_idx, url FROM pages WHERE page_id NOT IN (SELECT row_idx FROM fresh_labels)""")
def incremental_anti(spark, sf):
    return writeback.not_done_yet(_sheet(spark, sf), frame(spark, sf, "fresh_labels"), "row_idx")
