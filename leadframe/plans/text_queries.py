"""Text, HTML, URL and payload functions over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dictionaries as d
from ..functions import html as H
from ..functions import payload as P
from ..functions import text as X
from ..functions import urls as U
from ..operators import crawl, dictionary, pages, records
from ..session import scratch_path
from ..sources import files
from . import twin as q
from .fixtures import cte, frame
from .registry import query


@query("str_strip", f"""
    SELECT doc_id, {q.strip("chr(160) || ' ' || text || chr(10) || chr(8195)")} AS stripped FROM documents""")
def str_strip(spark, sf):
    padded = F.concat(F.lit("\xa0 "), F.col("text"), F.lit("\n "))
    return frame(spark, sf, "documents").select("doc_id", X.py_strip(padded).alias("stripped"))


@query("title_normalize", cte("titles") + f"""
    SELECT row_idx, {q.collapse('title')} AS title_norm FROM titles""")
def title_normalize(spark, sf):
    return frame(spark, sf, "titles").select("row_idx", X.collapse_ws("title").alias("title_norm"))


@query("text_nonblank", f"""
    SELECT conv_id, turn, {q.nonblank("replace(text, '. ', '. ' || chr(13) || chr(10) || ' ' || chr(10))")} AS clean
    FROM conversations""")
def text_nonblank(spark, sf):
    spaced = F.replace(F.col("text"), F.lit(". "), F.lit(". \r\n \n"))
    return frame(spark, sf, "conversations").select(
        "conv_id", "turn", X.nonblank_lines(spaced).alias("clean"))


@query("html_to_text_flat", cte("pages_kw") + f"""
    SELECT page_id, {q.flat_text('html')} AS text FROM pages_kw""")
def html_to_text_flat(spark, sf):
    return H.html_to_text_flat(frame(spark, sf, "pages_kw"), "html", "text").select("page_id", "text")


@query("html_to_text_lines", cte("pages_kw") + f"""
    SELECT page_id, {q.nonblank('nodes')} AS text
    FROM (SELECT page_id, {q.node_lines('html')} AS nodes FROM pages_kw)""")
def html_to_text_lines(spark, sf):
    return H.html_to_text_lines(frame(spark, sf, "pages_kw"), "html", "text", consent_lines=0) \
        .select("page_id", "text")


@query("strip_consent", cte("pages_kw") + f"""
    SELECT page_id, {q.nonblank(q.cut_head('nodes', 50, H.CONSENT_MARKERS))} AS text,
      {q.nonblank(q.cut_head('nodes', 50, H.CONSENT_MARKERS_SHORT))} AS text_short,
      {q.cut_head('flat', 30, H.CONSENT_MARKERS_RAW)} AS text_raw
    FROM (SELECT page_id, {q.node_lines('html')} AS nodes, {q.flat_text('html')} AS flat FROM pages_kw)""")
def strip_consent(spark, sf):
    df = H.html_to_node_lines(frame(spark, sf, "pages_kw"), "html", "nodes")
    df = H.html_to_text_flat(df, "html", "flat")
    df = X.drop_head_if_marked(df, "nodes", "long", 50, H.CONSENT_MARKERS)
    df = X.drop_head_if_marked(df, "nodes", "short", 50, H.CONSENT_MARKERS_SHORT)
    df = X.drop_head_if_marked(df, "flat", "text_raw", 30, H.CONSENT_MARKERS_RAW)
    return df.select("page_id", X.nonblank_lines("long").alias("text"),
                     X.nonblank_lines("short").alias("text_short"), "text_raw")


@query("cell_clean", f"""
    SELECT doc_id, {q.strip("replace(replace(text, chr(10), ' '), chr(13), '')")} AS cell FROM documents""")
def cell_clean(spark, sf):
    return frame(spark, sf, "documents").select("doc_id", X.clean_cell("text").alias("cell"))


@query("domain_valid", cte("domains") + f"""
    SELECT row_idx, {q.valid_domain('raw')} AS raw_valid, {q.valid_domain(q.bare_domain('raw'))} AS host_valid
    FROM domains""")
def domain_valid(spark, sf):
    return frame(spark, sf, "domains").select(
        "row_idx", U.is_valid_domain("raw").alias("raw_valid"),
        U.is_valid_domain(U.normalize_domain("raw")).alias("host_valid"))


@query("domain_normalize", cte("domains") + f"""
    SELECT row_idx, {q.bare_domain('raw')} AS domain FROM domains""")
def domain_normalize(spark, sf):
    return frame(spark, sf, "domains").select("row_idx", U.normalize_domain("raw").alias("domain"))


@query("url_host", "SELECT page_id, lower(split_part(split_part(split_part(split_part(url, '://', 2), '/', 1), '?', 1), '#', 1)) AS host FROM pages")
def url_host(spark, sf):
    return frame(spark, sf, "pages").select("page_id", U.host_of("url").alias("host"))


@query("url_match_key", "SELECT page_id, url FROM pages WHERE contains(url, '/en/')")
def url_match_key(spark, sf):
    return frame(spark, sf, "pages").select("page_id", "url").where(F.col("url").contains("/en/"))


_HREF_SQL = r"""regexp_extract_all(regexp_replace(html, '(?is)<!--.*?-->|<script[\s/>].*?</script\s*>|<style[\s/>].*?</style\s*>', '', 'g'),
    '(?is)<a\s(?:[^>]*?\s)?href\s*=\s*("[^"]+"|''[^'']+''|[^\s"''>]+)', 1)"""

# Root-relative, absolute and fragment links; the derived sites add dot segments.
_RESOLVED_SQL = """CASE WHEN starts_with(h, 'http') OR starts_with(h, 'mailto:') OR starts_with(h, 'tel:') THEN h
    WHEN starts_with(h, '/x/../') THEN site || '/' || substr(h, 7)
    WHEN starts_with(h, '/') THEN site || h
    WHEN starts_with(h, './') THEN site || substr(h, 2)
    WHEN starts_with(h, '#') THEN split_part(src, '#', 1) || h
    ELSE site || '/' || h END"""


def _links_sql(table: str) -> str:
    return f"""
    SELECT DISTINCT page_id, src, {_RESOLVED_SQL} AS dst FROM (
      SELECT page_id, url AS src, regexp_extract(url, '^([a-z]+://[^/?#]*)', 1) AS site,
        {q.entities("unnest(list_transform(" + _HREF_SQL + ", lambda x: trim(x, '\"''')))")} AS h
      FROM {table} WHERE html IS NOT NULL)"""


@query("page_links", _links_sql("pages"))
def page_links(spark, sf):
    return crawl.page_links(frame(spark, sf, "pages"), keep=("page_id",))


@query("url_resolve", cte("site_pages") + _links_sql("site_pages"))
def url_resolve(spark, sf):
    return crawl.page_links(frame(spark, sf, "site_pages"), keep=("page_id",))


@query("links_distinct", f"SELECT DISTINCT dst AS url FROM ({_links_sql('pages')})")
def links_distinct(spark, sf):
    return crawl.page_links(frame(spark, sf, "pages")).select(F.col("dst").alias("url")).distinct()


@query("links_sorted", f"SELECT DISTINCT dst AS url FROM ({_links_sql('pages')}) ORDER BY url")
def links_sorted(spark, sf):
    return links_distinct(spark, sf).orderBy("url")


@query("links_pattern", cte("listing_pages") + r"""
    SELECT page_no, array_to_string(list_sort(list_distinct(regexp_extract_all(html, 'https://shops\.example\.com/review/info_[a-zA-Z0-9]+'))), ' ') AS links
    FROM listing_pages""")
def links_pattern(spark, sf):
    links = crawl.pattern_links("html", r"https://shops\.example\.com/review/info_[a-zA-Z0-9]+")
    return frame(spark, sf, "listing_pages").select(
        "page_no", F.array_join(F.array_sort(links), " ").alias("links"))


@query("about_link", cte("anchored") + """
    SELECT key, CASE key % 6 WHEN 0 THEN url || '/About-us' WHEN 1 THEN url || '/o-nas' WHEN 2 THEN url || '/x'
        WHEN 5 THEN url || '/team?x=1&y=2' END AS about_url
    FROM anchored""")
def about_link(spark, sf):
    return crawl.about_link(frame(spark, sf, "anchored"), "url", "html").select("key", "about_url")


@query("page_contacts", cte("contact_pages") + rf"""
    SELECT doc_id, 'Doc ' || doc_id || ' & more' AS title,
      'About ' || source || CASE WHEN doc_id % 2 = 0 THEN '' ELSE ' > name=description' END AS description,
      array_to_string(list_sort(list_distinct(list_transform(regexp_extract_all(html, '[a-zA-Z0-9._%+\-]+@[a-zA-Z0-9.\-]+\.[a-zA-Z]{{2,}}'), lambda e: lower(e)))), ' ') AS emails,
      concat_ws(' ', CASE WHEN doc_id % 4 = 0 OR doc_id % 6 = 0 THEN '+4930' || doc_id END) AS phones,
      CASE doc_id % 6 WHEN 0 THEN 'Street ' || doc_id || ', 10115 Town, DE' WHEN 1 THEN 'Line ' || doc_id || ', Town'
        WHEN 2 THEN 'Road ' || doc_id || ', Paris' END AS address,
      array_to_string(list_sort(list_distinct(regexp_extract_all(html, '(?i)href="(https?://(?:[a-z0-9\-]+\.)*linkedin\.com/[^"]*)"', 1))), ' ') AS socials,
      CASE doc_id % 6 WHEN 0 THEN 'slogan: Say ' || lang WHEN 1 THEN 'vatID: 7' END AS notes
    FROM contact_pages JOIN documents USING (doc_id)""")
def page_contacts(spark, sf):
    found = records.page_contacts(frame(spark, sf, "contact_pages"))
    joined = [F.array_join(c, " ").alias(c) for c in ("emails", "phones", "socials")]
    return found.select("doc_id", "title", "description", *joined, "address", "notes")


@query("followers_parse", cte("follower_texts") + r"""
    SELECT row_idx, username, TRY_CAST(nullif(digits, '') AS bigint) AS followers,
      CASE WHEN NOT found THEN 'not_found' WHEN digits = '' THEN 'error' ELSE 'ok' END AS status
    FROM (SELECT row_idx, username, regexp_matches(body, 'FOLLOWERS\s+[\d,\s]+') AS found,
            regexp_replace(regexp_extract(body, 'FOLLOWERS\s+([\d,\s]+)', 1), '[^\d]', '', 'g') AS digits
          FROM follower_texts)""")
def followers_parse(spark, sf):
    value, status = X.parse_followers("body")
    return frame(spark, sf, "follower_texts").select(
        "row_idx", "username", value.alias("followers"), status.alias("status"))


@query("payload_json_or_raw", cte("company_outputs") + """
    SELECT doc_id, CASE WHEN json_valid(model_output) THEN 'object' ELSE 'raw' END AS kind,
      CASE WHEN json_valid(model_output) THEN NULL ELSE model_output END AS raw,
      CASE WHEN json_valid(model_output) THEN json_extract_string(model_output, '$."Company Domain"') END AS company_domain
    FROM company_outputs""")
def payload_json_or_raw(spark, sf):
    parsed = frame(spark, sf, "company_outputs").select("doc_id", P.json_or_raw("model_output").alias("data"))
    raw = F.try_variant_get("data", "$.raw", "string")
    return parsed.select(
        "doc_id", F.when(raw.isNull(), F.lit("object")).otherwise(F.lit("raw")).alias("kind"), raw.alias("raw"),
        F.try_variant_get("data", "$['Company Domain']", "string").alias("company_domain"))


_FENCE_SQL = r"'(?is)```(?:\s*json)?\s*(\{.*?\})\s*```'"


def _unfence_sql(x: str) -> str:
    return f"CASE WHEN regexp_matches({x}, {_FENCE_SQL}) THEN regexp_extract({x}, {_FENCE_SQL}, 1) ELSE {x} END"


@query("payload_unfence", cte("company_outputs") + f"""
    SELECT doc_id, {_unfence_sql('model_output')} AS body FROM company_outputs""")
def payload_unfence(spark, sf):
    return frame(spark, sf, "company_outputs").select("doc_id", P.unfence("model_output").alias("body"))


def _fields_sql(mode: str) -> str:
    parts = []
    for name in P.RECORD_FIELDS[mode]:
        key = '"' + r"\s+".join(name.split()) + r'"\s*:\s*'
        quoted = q.group("body", f'(?i){key}"([^"]*)"')
        value = quoted
        if name in P.LOOSE_FIELDS:
            bare = q.group("body", f"(?i){key}([^,\n}}]+)")
            value = f"CASE WHEN {q.has('body', key + chr(34) + '[^' + chr(34) + ']*' + chr(34))} THEN {quoted} ELSE {bare} END"
        parts.append(f'{q.strip(value)} AS "{name}"')
    return ", ".join(parts)


def _columns_sql(table: str, mode: str) -> str:
    return cte(table) + f"""
    SELECT url AS "URL", {_fields_sql(mode)}
    FROM (SELECT url, {_unfence_sql('model_output')} AS body FROM {table})"""


@query("payload_to_columns_company", _columns_sql("company_outputs", "company"))
def payload_to_columns_company(spark, sf):
    outputs = frame(spark, sf, "company_outputs").withColumn("data", P.json_or_raw("model_output"))
    return records.payload_to_columns(outputs, "company")


@query("payload_to_columns_speaker", _columns_sql("speaker_outputs", "speaker"))
def payload_to_columns_speaker(spark, sf):
    outputs = frame(spark, sf, "speaker_outputs").withColumn("data", P.json_or_raw("model_output"))
    return records.payload_to_columns(outputs, "speaker")


@query("prompt_requests", """
    SELECT doc_id, CAST(part AS integer) AS part, 'Name the one group that fits source ' || coalesce(source, '') || '. Page text:' || chr(10)
      || substr(text, CAST(part * 12000 + 1 AS integer), 12000) AS prompt
    FROM documents, unnest(range(0, greatest(1, CAST(ceil(length(text) / 12000.0) AS bigint)))) AS t(part) WHERE trim(text) <> ''""")
def prompt_requests(spark, sf):
    return records.request_table(
        frame(spark, sf, "documents"),
        "Name the one group that fits source {source}. Page text:\n{text}", "doc_id", text=12000)


# Endings go one at a time; no name of the table has twelve.
_ENDING_SQL = "'(?i)^(.*[^\\s,])[\\s,]+(?:" + "|".join(d.COMPANY_ENDINGS) + ")$', '\\1'"
_CLEAN = "trim(translate(name, '®™©', ''))"
for _ in range(12):
    _CLEAN = f"regexp_replace({_CLEAN}, {_ENDING_SQL})"


@query("company_name_clean", cte("company_names") + f"""
    SELECT key, name, coalesce(nullif(trim({_CLEAN}), ''), trim(name)) AS clean FROM company_names""")
def company_name_clean(spark, sf):
    return frame(spark, sf, "company_names").select("key", "name", pages.clean_company_name("name").alias("clean"))


@query("anchors", cte("anchored") + """
    SELECT key, pos, href, text FROM (
      SELECT key, 0 AS pos, CASE key % 6 WHEN 0 THEN '/start' WHEN 1 THEN 'https://facebook.com/about' WHEN 2 THEN '/x'
          WHEN 3 THEN '/contact' WHEN 4 THEN 'https://www.linkedin.com/company/a' ELSE '/team?x=1&y=2' END AS href,
        CASE key % 6 WHEN 0 THEN 'Start' WHEN 1 THEN 'fb' WHEN 2 THEN 'Our Story' WHEN 3 THEN 'Contact' WHEN 4 THEN 'li' ELSE 'T' END AS text
      FROM anchored
      UNION ALL
      SELECT key, 1, CASE key % 6 WHEN 0 THEN '/About-us' ELSE '/o-nas' END, CASE key % 6 WHEN 0 THEN 'Us' ELSE 'O nas' END
      FROM anchored WHERE key % 6 < 2)""")
def anchors(spark, sf):
    return crawl.anchors(frame(spark, sf, "anchored"), "key")


@query("company_gaps_fill", _columns_sql("company_outputs", "company").replace("SELECT url AS", ", cols AS (SELECT url AS", 1) + """)
    SELECT "URL", "Company Name", "Company Domain",
      CASE WHEN "Email" NOT IN ('', 'null') THEN "Email" WHEN doc_id % 3 = 0 THEN 'info@' || source || '.example.com' ELSE '' END AS "Email",
      CASE WHEN "Phone Number" <> '' THEN "Phone Number" WHEN doc_id % 4 = 0 THEN '+4930' || doc_id ELSE '' END AS "Phone Number",
      "Address", "Hall Number", "Stand Number", "Description", "Linkedin link"
    FROM cols JOIN (SELECT 'https://expo.example.com/' || doc_id AS "URL", doc_id, source FROM documents) USING ("URL")""")
def company_gaps_fill(spark, sf):
    docs = frame(spark, sf, "documents")
    # what the landed page itself shows: a mailto link and a phone link
    html = F.concat(
        F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit('<a href="mailto:Info@'), "source", F.lit('.example.com">m</a>'))).otherwise(""),
        F.when(F.col("doc_id") % 4 == 0, F.concat(F.lit('<a href="tel:+49 (30) '), "doc_id", F.lit('">t</a>'))).otherwise(""))
    shown = records.page_contacts(docs.select(
        F.concat(F.lit("https://expo.example.com/"), "doc_id").alias("url"), html.alias("html")))
    return records.fill_company_gaps(payload_to_columns_company(spark, sf), shown)


_WORD_RUN = r"[\p{L}\p{N}_]+"


@query("dictionary_hits", f"""
    WITH own AS (SELECT doc_id, unnest(list_distinct(regexp_extract_all(lower(text), '{_WORD_RUN}'))) AS w FROM documents)
    SELECT doc_id, substr(w, 1, 1) AS "group", count(*) AS names FROM own WHERE length(w) > 2 AND w NOT LIKE '%e' GROUP BY 1, 2""")
def dictionary_hits(spark, sf):
    """A dictionary of words of the corpus, kept as JSON, looked up in every document: over 10,000 entries from sf 0.01 on."""
    docs = frame(spark, sf, "documents")
    words = docs.select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit(_WORD_RUN), F.lit(0))).alias("w")).distinct() \
        .where("length(w) > 2 AND w NOT LIKE '%e'")
    path = scratch_path(spark, "dictionary")
    words.select(F.to_json(F.create_map(F.substring("w", 1, 1), F.create_map("w", "w")))).write.text(path)
    found = dictionary.dictionary_hits(docs, "doc_id", "text", files.read_dictionary(spark, path, lines=True), whole_words=True)
    return found.groupBy("doc_id", "group").agg(F.count("*").alias("names"))
