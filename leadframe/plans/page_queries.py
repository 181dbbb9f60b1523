"""Page classification, label validation and scoring queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dictionaries as d
from ..functions import html as H
from ..functions.text import nonblank_lines
from ..operators import crawl, fetch, pages, profile, scoring
from . import twin as q
from .fixtures import cte, frame
from .registry import query

_SIDES = d.EXHIBITOR_KEYWORDS
_VOTES = f"""{q.any_of('t', _SIDES['strong_yes'].values())} AS strong_yes,
    {q.votes('t', _SIDES['maybe'].values())} AS maybe_hits, {q.votes('t', _SIDES['strong_no'].values())} AS no_hits"""
_TEXTS = f"(SELECT page_id, lower(coalesce({q.nonblank(q.flat_text('html'))}, '')) AS t FROM pages_kw)"


def _page_text(spark, sf):
    df = H.html_to_text_flat(frame(spark, sf, "pages_kw"), "html", "flat")
    return df.select("page_id", nonblank_lines("flat").alias("text"))


@query("keyword_votes", cte("pages_kw") + f"SELECT page_id, {_VOTES} FROM {_TEXTS}")
def keyword_votes(spark, sf):
    return pages.with_votes(_page_text(spark, sf), "text").drop("text")


# Domains joined with the first attempt that has text, by their bare host.
_WINNERS = f"""(SELECT url, html, source FROM (
      SELECT url, html, source, row_number() OVER (PARTITION BY url ORDER BY
        CASE source WHEN 'requests' THEN 1 WHEN 'selenium' THEN 2 ELSE 3 END) AS n
      FROM attempts WHERE NOT {q.blank('html')}) WHERE n = 1)"""
def _attempt_texts(markers, attempts: str = "attempts") -> str:
    return f"""(SELECT url, source, status, flat, CASE WHEN source = 'brightdata'
    THEN {q.nonblank(q.cut_head('nodes', 50, markers))} ELSE {q.nonblank('flat')} END AS text
    FROM (SELECT url, source, status, {q.flat_text('html')} AS flat, {q.node_lines('html')} AS nodes FROM {attempts}))"""


def _domain_facts(sources, settled: str, value: str, cell: str = q.strip("raw"), markers=H.CONSENT_MARKERS_SHORT,
                  attempts: str = "attempts") -> str:
    """Domain cells with a value of the first settled attempt of their URL."""
    return f"""(SELECT dm.row_idx, domain, {value} AS t
    FROM (SELECT row_idx, {cell} AS domain FROM domains WHERE trim(raw) <> '') AS dm
    LEFT JOIN (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY
        CASE source WHEN 'requests' THEN 1 WHEN 'selenium' THEN 2 ELSE 3 END) AS n
      FROM {_attempt_texts(markers, attempts)} WHERE source IN {q.in_list(sources)} AND {settled}) WHERE n = 1) AS w
    ON w.url = 'https://' || domain AND {q.valid_domain('domain')})"""


_ALL = ("requests", "selenium", "brightdata")
_DOMAIN_TEXTS = _domain_facts(_ALL, f"status = 200 AND NOT {q.blank('text')}", "lower(coalesce(text, ''))")
_ANSWERED_TEXTS = _domain_facts(_ALL[:2], "status = 200", "lower(coalesce(text, ''))")


@query("classify_exhibitor", cte("domains", "attempts") + f"""
    SELECT row_idx, domain, CASE WHEN NOT {q.valid_domain('domain')} THEN 'Invalid domain'
        WHEN strong_yes AND no_hits < 2 THEN 'Yes' WHEN maybe_hits >= 3 AND no_hits < 2 THEN 'Maybe'
        WHEN t = '' THEN 'No content' ELSE 'No' END AS label,
      'Yes: ' || CASE WHEN strong_yes THEN 'True' ELSE 'False' END || ' Maybe: ' || maybe_hits || ' No: ' || no_hits AS stats
    FROM (SELECT row_idx, domain, t, {_VOTES} FROM {_DOMAIN_TEXTS})""")
def classify_exhibitor(spark, sf):
    return pages.exhibitor_domains(frame(spark, sf, "domains"), frame(spark, sf, "attempts"))


@query("classify_ecommerce", cte("domains", "attempts") + f"""
    SELECT row_idx, domain, CASE WHEN NOT {q.valid_domain('domain')} THEN 'Invalid domain' WHEN t = '' THEN 'No content'
        WHEN {q.has('t', pages.E_COMMERCE_WORD)} THEN 'Yes' ELSE 'No' END AS label
    FROM {_ANSWERED_TEXTS}""")
def classify_ecommerce(spark, sf):
    return pages.ecommerce_domains(frame(spark, sf, "domains"), frame(spark, sf, "attempts"))


@query("classify_ecommerce_errors", cte("domains", "broken_attempts") + f"""
    SELECT row_idx, domain, CASE WHEN NOT {q.valid_domain('domain')} THEN 'Invalid domain'
        WHEN t IS NULL AND domain IN (SELECT split_part(url, '://', 2) FROM broken_attempts
            WHERE source IN ('requests', 'selenium') AND NOT {q.blank('error')}) THEN 'Error'
        WHEN coalesce(t, '') = '' THEN 'No content' WHEN {q.has('t', pages.E_COMMERCE_WORD)} THEN 'Yes' ELSE 'No' END AS label
    FROM {_domain_facts(_ALL[:2], "status = 200", "CASE WHEN status = 200 THEN lower(coalesce(text, '')) END", attempts="broken_attempts")}""")
def classify_ecommerce_errors(spark, sf):
    return pages.ecommerce_domains(frame(spark, sf, "domains"), frame(spark, sf, "broken_attempts"), error="error")


_EVIDENCE = ", ".join(f"{q.votes('t', side.values())} AS {name}" for name, side in (
    ("shop_strong", d.SHOP_STRONG), ("shop_soft", d.SHOP_SOFT),
    ("sp_strong", d.PROVIDER_STRONG), ("sp_soft", d.PROVIDER_SOFT)))
_CONSENT_TEXTS = f"""(SELECT page_id, lower(coalesce({q.nonblank(q.cut_head('nodes', 50, H.CONSENT_MARKERS))}, '')) AS t
    FROM (SELECT page_id, {q.node_lines('html')} AS nodes FROM pages_kw))"""


def _line_text(spark, sf):
    return H.html_to_text_lines(frame(spark, sf, "pages_kw"), "html", "text").select("page_id", "text")


@query("classify_shop_sp", cte("pages_kw") + f"""
    SELECT page_id, shop_strong, shop_soft, sp_strong, sp_soft,
      CASE WHEN t = '' THEN 'Unscrapable'
        WHEN shop_strong > 0 AND ({q.has('t', q.wide_edges(d.PROVIDER_STRONG['software']))} OR shop_strong < sp_strong) THEN 'Service Provider'
        WHEN shop_strong > 0 THEN 'Shop' WHEN sp_strong > 0 THEN 'Service Provider'
        WHEN shop_soft > sp_soft THEN 'Shop' WHEN shop_soft < sp_soft THEN 'Service Provider' ELSE 'Unclear' END AS label
    FROM (SELECT page_id, t, {_EVIDENCE} FROM {_CONSENT_TEXTS})""")
def classify_shop_sp(spark, sf):
    return pages.classify_shop_sp(_line_text(spark, sf), "text").drop("text")


@query("shop_category_tags", cte("pages_kw") + f"""
    SELECT page_id, concat_ws(',', {', '.join(f"CASE WHEN {q.has('t', p, '')} THEN '{n}' END" for n, p in d.SHOP_CATEGORIES.items())}) AS categories
    FROM {_CONSENT_TEXTS}""")
def shop_category_tags(spark, sf):
    tagged = pages.shop_categories(_line_text(spark, sf), "text")
    return tagged.select("page_id", F.array_join("categories", ",").alias("categories"))


_FIRST = q.strip("split_part(trim(coalesce(model_output, '')), chr(10), 1)")


_JOINED = "FROM pages LEFT JOIN responses ON page_id = row_idx"


def _page_rows(spark, sf):
    return frame(spark, sf, "pages").select(F.col("page_id").alias("row_idx"))


@query("label_validate", cte("responses") + f"""
    SELECT page_id AS row_idx, CASE WHEN {_FIRST} IN {q.in_list(d.SHOP_LABELS)} THEN {_FIRST} ELSE 'Unclear' END AS label {_JOINED}""")
def label_validate(spark, sf):
    return pages.label_from_response(
        _page_rows(spark, sf), frame(spark, sf, "responses"), "row_idx", d.SHOP_LABELS)


@query("label_validate_lenient", cte("responses") + f"""
    SELECT page_id AS row_idx, CASE WHEN {_FIRST} = '' THEN 'Unclear' ELSE {_FIRST} END AS label {_JOINED}""")
def label_validate_lenient(spark, sf):
    return pages.label_from_response(
        _page_rows(spark, sf), frame(spark, sf, "responses"), "row_idx", d.SHOP_LABELS, strict=False)


_INDUSTRY = d.TAXONOMIES["industry"]
_ANSWERS = (("Toys and Baby Products", _INDUSTRY[2]), ("electronics AND computers", _INDUSTRY[3]),
            (" Luggage and Bags\nbecause", _INDUSTRY[6]), ("Automotive and Accessorie", _INDUSTRY[10]),
            ("Something else", "Unclear"), ("", "Unclear"), ("Travel & Hospitality", "Unclear"))


@query("taxonomy_label", f"""
    SELECT doc_id, list_extract([{', '.join(q.lit(v) for _, v in _ANSWERS)}], CAST(n_chars % {len(_ANSWERS)} AS int) + 1) AS industry
    FROM documents""")
def taxonomy_label(spark, sf):
    answers = F.array(*[F.lit(a) for a, _ in _ANSWERS])
    output = F.element_at(answers, (F.col("n_chars") % len(_ANSWERS) + 1).cast("int"))
    return frame(spark, sf, "documents").select(
        "doc_id", pages.taxonomy_label(output, "industry").alias("industry"))


def _told(labels):
    """An answer as a model writes it, and the label it stands for: every label in three spellings, and one that is none."""
    spellings = (str.upper, lambda v: f"  {v.replace(' ', '')} ", lambda v: v[:-1] if len(v) > 9 else v)
    return [(spellings[i % 3](v), v) for i, v in enumerate(labels * 3)] + [("none of these", "Unclear")]


_OTHER_TAXONOMIES = ("awards", "shop_kind", "expo_fit")


@query("taxonomy_labels_other", "SELECT doc_id, " + ", ".join(
    f"list_extract([{', '.join(q.lit(v) for _, v in _told(d.TAXONOMIES[t]))}], CAST(n_chars % {len(_told(d.TAXONOMIES[t]))} AS int) + 1) AS {t}"
    for t in _OTHER_TAXONOMIES) + " FROM documents")
def taxonomy_labels_other(spark, sf):
    """Answers of one line, with the reasons below it, to the labels of three taxonomies."""
    def answer(taxonomy):
        told = F.array(*[F.lit(a) for a, _ in _told(d.TAXONOMIES[taxonomy])])
        return F.concat(F.element_at(told, (F.col("n_chars") % F.size(told) + 1).cast("int")), F.lit("\n"), "text")

    return frame(spark, sf, "documents").select(
        "doc_id", *[pages.taxonomy_label(answer(t), t).alias(t) for t in _OTHER_TAXONOMIES])


@query("fit_line_parse", f"""
    SELECT doc_id, source || '.com' AS domain, CASE WHEN lang = 'en' THEN 'Yes' ELSE 'No' END AS fit, {q.strip('text')} AS explanation
    FROM documents""")
def fit_line_parse(spark, sf):
    line = F.concat("source", F.lit(".com; "), F.when(F.col("lang") == "en", "Yes").otherwise("No"),
                    F.lit(" ;"), "text")
    lines = frame(spark, sf, "documents").select("doc_id", line.alias("line"))
    return pages.split_fit_line(lines, "line").drop("line")


_ERROR_TEXT = q.flat_text("html")


@query("fetch_error_code", cte("attempts") + f"""
    SELECT url, source, CASE WHEN status <> 200 THEN 'HTTP_' || status
      WHEN regexp_matches(coalesce({_ERROR_TEXT}, ''), '(?i)attention required|cloudflare|verify you are human|captcha|access denied|blocked')
      THEN 'Cloudflare/Captcha' END AS err
    FROM attempts""")
def fetch_error_code(spark, sf):
    texts = H.html_to_text_flat(frame(spark, sf, "attempts"), "html", "text")
    return texts.select("url", "source", pages.fetch_error("status", "text").alias("err"))


@query("fetch_coalesce", cte("attempts") + f"""
    SELECT u.url, w.html, coalesce(w.source, '') AS source
    FROM (SELECT DISTINCT url FROM attempts) AS u LEFT JOIN {_WINNERS} AS w ON u.url = w.url""")
def fetch_coalesce(spark, sf):
    return fetch.first_settled(frame(spark, sf, "attempts"))


def _policy_sql(settled: str, stages: str) -> str:
    return cte("attempts") + f"""
    SELECT u.url, w.html, coalesce(w.source, '') AS source
    FROM (SELECT DISTINCT url FROM attempts) AS u LEFT JOIN (
      SELECT url, html, source, row_number() OVER (PARTITION BY url ORDER BY source {stages}) AS n
      FROM attempts WHERE source IN ('requests', 'selenium') AND {settled}) AS w ON u.url = w.url AND n = 1"""


@query("fetch_first_answer", _policy_sql("status = 200", "ASC"))
def fetch_first_answer(spark, sf):
    return fetch.first_settled(frame(spark, sf, "attempts"), ("requests", "selenium"), fetch.answered())


@query("fetch_retry_empty", _policy_sql(f"(status <> 200 OR NOT {q.blank('html')})", "ASC"))
def fetch_retry_empty(spark, sf):
    return fetch.first_settled(frame(spark, sf, "attempts"), ("requests", "selenium"),
                               fetch.failed_or_has_html())


_SIZE_SQL = "CASE alexa_rank " + " ".join(f"WHEN '{b}' THEN {p}" for b, p in d.EMPLOYEE_BANDS.items()) + " ELSE 0 END"
_INT_SQL = "CASE WHEN regexp_matches(trim(revenue), '^[+-]?[0-9]+$') THEN CAST(trim(revenue) AS bigint) END"
_REVENUE_SQL = f"""CASE WHEN {_INT_SQL} IS NULL THEN 0
    {' '.join(f'WHEN {_INT_SQL} >= {t} THEN {p}' for t, p in d.REVENUE_STEPS)} ELSE 1 END"""


@query("size_score", cte("score_input") + f"SELECT domain, CAST({_SIZE_SQL} AS int) AS size_score FROM score_input")
def size_score(spark, sf):
    return frame(spark, sf, "score_input").select("domain", scoring.size_score("alexa_rank").alias("size_score"))


@query("revenue_score", cte("score_input") + f"SELECT domain, CAST({_REVENUE_SQL} AS int) AS revenue_score FROM score_input")
def revenue_score(spark, sf):
    return frame(spark, sf, "score_input").select("domain", scoring.revenue_score("revenue").alias("revenue_score"))


@query("bucket_score", cte("score_input") + f"""
    SELECT domain, CAST(CASE WHEN v IS NULL THEN 0 WHEN v >= 10000000 THEN 10 WHEN v >= 1000000 THEN 8 WHEN v >= 500000 THEN 5 ELSE 3 END AS int) AS revenue_points,
      CAST(CASE WHEN v IS NULL THEN 0 WHEN v <= 10000 THEN 10 WHEN v <= 100000 THEN 8 WHEN v <= 500000 THEN 6 WHEN v <= 1000000 THEN 4 ELSE 2 END AS int) AS rank_points
    FROM (SELECT domain, {_INT_SQL} AS v FROM score_input)""")
def bucket_score(spark, sf):
    return frame(spark, sf, "score_input").select(
        "domain", scoring.retired_revenue_score("revenue").alias("revenue_points"),
        scoring.retired_rank_score("revenue").alias("rank_points"))


@query("exhibitor_score", cte("score_input", "score_answers") + f"""
    SELECT domain, score AS llm_score, size_score, revenue_score,
      CASE WHEN score = -1 THEN -1.0::double ELSE round((score + size_score + revenue_score) * 100.0::double
        / (60 + CASE WHEN size_score > 0 THEN 10 ELSE 0 END + CASE WHEN revenue_score > 0 THEN 10 ELSE 0 END), 2) END AS total_score,
      reasons, exhibitor_type, error
    FROM (SELECT domain, size_score, revenue_score, reasons, error, exhibitor_type,
        CASE WHEN regexp_matches(lower(reasons), '{'|'.join(d.SCRAPE_FAILED)}') THEN -1 ELSE base END AS score
      FROM (SELECT domain, CAST({_SIZE_SQL} AS bigint) AS size_score, CAST({_REVENUE_SQL} AS bigint) AS revenue_score,
          CASE WHEN description = '' THEN 'no_description' WHEN j IS NULL THEN ''
            ELSE replace(array_to_string(CAST(json_extract_string(j, '$.reasons[*]') AS varchar[]), ','), ' ', '_') END AS reasons,
          CASE WHEN description = '' THEN '' ELSE coalesce(json_extract_string(j, '$.exhibitor_type'), 'N/A') END AS exhibitor_type,
          CASE WHEN description <> '' AND j IS NULL THEN 'unreadable answer' END AS error,
          CASE WHEN description = '' THEN -1 ELSE coalesce(CAST(json_extract_string(j, '$.score') AS bigint), 0) END AS base
        FROM (SELECT score_input.*, CASE WHEN json_valid(answer) THEN answer END AS j
              FROM score_input LEFT JOIN score_answers USING (domain))))""")
def exhibitor_score(spark, sf):
    return scoring.score_exhibitors(frame(spark, sf, "score_input"), frame(spark, sf, "score_answers"))


@query("fit_rubric", cte("pages_kw") + f"""
    SELECT page_id, kind AS exhibitor_type, CAST(CASE WHEN kind <> 'other' THEN 50 ELSE 0 END
      + CASE WHEN {q.any_of('t', [d.FIT_B2B])} THEN 5 ELSE 0 END + CASE WHEN {q.any_of('t', [d.FIT_INNOVATION])} THEN 5 ELSE 0 END AS bigint) AS fit_score
    FROM (SELECT page_id, t, CASE {' '.join(f"WHEN {q.has('t', p, '')} THEN '{n}'" for n, p in d.FIT_CATEGORIES.items())} ELSE 'other' END AS kind
          FROM {_TEXTS})""")
def fit_rubric(spark, sf):
    return scoring.fit_rubric(_page_text(spark, sf), "text").drop("text")


# The tag tree restated: events of a page are walked by recursion, with the open elements as a list.
_TREE = f"""
    bare AS (SELECT page_id, regexp_replace(coalesce(html, ''),
        '(?is)<!--.*?(?:-->|\\z)|<(?:script[\\s/>].*?(?:</script\\s*>|\\z)|style[\\s/>].*?(?:</style\\s*>|\\z))', '<wbr>', 'g') AS page FROM pages_kw),
    said AS (SELECT page_id, regexp_extract_all(page, '<[a-zA-Z/!](?:[^<>"'']|"[^"]*"|''[^'']*'')*>|[^<]+|<') AS said FROM bare),
    events AS (SELECT page_id, list_transform(said, lambda e: {{
        'name': lower(regexp_extract(e, '^</?([a-zA-Z][^\\s/>]*)', 1)),
        'kind': CASE WHEN regexp_matches(e, '^</[a-zA-Z]') THEN 'close' WHEN regexp_matches(e, '^<!.|^</') THEN 'none' WHEN NOT regexp_matches(e, '^<[a-zA-Z]') THEN 'text'
          WHEN e LIKE '%/>' OR regexp_matches(lower(e), '^<(area|base|br|col|embed|hr|img|input|link|meta|source|track|wbr)[\\s/>]') THEN 'single' ELSE 'open' END,
        'said': e}}) AS events FROM said),
    walk AS (
      SELECT page_id, 0 AS i, CAST([] AS STRUCT(id INTEGER, name VARCHAR)[]) AS open, events[1:0] AS now, events FROM events
      UNION ALL
      SELECT page_id, i + 1, CASE e.kind WHEN 'open' THEN list_append(open, {{'id': CAST(i + 1 AS INTEGER), 'name': e.name}})
          WHEN 'close' THEN CASE WHEN list_contains(list_transform(open, lambda o: o.name), e.name)
            THEN open[1:len(open) - list_position(list_reverse(list_transform(open, lambda o: o.name)), e.name)] ELSE open END
          ELSE open END, [e], events
      FROM (SELECT page_id, i, open, events, events[i + 1] AS e FROM walk WHERE i < len(events))),
    steps AS (SELECT page_id, i, open, now[1].kind AS kind, now[1].name AS name, now[1].said AS said FROM walk WHERE i > 0),
    box AS (SELECT page_id, coalesce(min(i) FILTER (WHERE name = 'article'), min(i) FILTER (WHERE name = 'main'), min(i) FILTER (WHERE name = 'body')) AS box
      FROM steps WHERE kind = 'open' GROUP BY 1),
    part AS (SELECT s.page_id, s.i FROM steps AS s JOIN box USING (page_id)
      WHERE kind = 'open' AND name IN ('h1', 'h2', 'h3', 'p', 'ul') AND s.i <> box AND list_contains(list_transform(open, lambda o: o.id), box)
        AND NOT list_has_any(list_transform(list_filter(open, lambda o: o.id > box), lambda o: o.name), ['nav', 'footer', 'script', 'style'])),
    words AS (SELECT page_id, i, open, {q.strip(q.entities('said'))} AS said FROM steps WHERE kind = 'text'),
    lines AS (SELECT p.page_id, p.i, string_agg(w.said, '' ORDER BY w.i) AS line FROM part AS p JOIN words AS w
      ON w.page_id = p.page_id AND w.said <> '' AND list_contains(list_transform(w.open, lambda o: o.id), CAST(p.i AS INTEGER))
        AND NOT list_has_any(list_transform(list_filter(w.open, lambda o: o.id > p.i), lambda o: o.name), ['nav', 'footer', 'script', 'style', 'template'])
      GROUP BY 1, 2)"""


@query("main_content", cte("pages_kw") + "," + _TREE + """
    SELECT page_id, coalesce(string_agg(line, chr(10) ORDER BY i), '') AS content FROM pages_kw LEFT JOIN lines USING (page_id) GROUP BY 1""")
def main_content(spark, sf):
    return profile.main_content(frame(spark, sf, "pages_kw"), "html", "content").select("page_id", "content")


_PROFILE_SQL = """SELECT url AS "Page URL", 's' || s_suppkey || '.example.com' AS "Domain", '+48 ' || s_suppkey AS "Phone",
    s_name || ' Street 1 ' || n_name AS "Address", 'Ann Lee, Bob Ray' AS "Contact person",
    CASE WHEN s_suppkey % 4 = 0 THEN '' ELSE 'About ' || s_name END AS "About"
    FROM profile_pages JOIN supplier USING (s_suppkey) JOIN nation ON n_nationkey = supplier.s_nationkey"""


@query("profile_extract", cte("profile_pages") + _PROFILE_SQL)
def profile_extract(spark, sf):
    return profile.extract_profiles(frame(spark, sf, "profile_pages"))


_WALL = "(?i)attention required|cloudflare|verify you are human|captcha|access denied|blocked"
_READABLE = f"""(status = 200 AND NOT {q.blank(q.cut_head('flat', 30, H.CONSENT_MARKERS_RAW))}
    AND NOT (source = 'requests' AND regexp_matches(text, '{_WALL}')))"""


@query("classify_shop_domains", cte("domains", "attempts", "responses") + f"""
    SELECT f.row_idx, domain, CASE WHEN NOT coalesce(t, false) THEN 'Unscrapable'
        WHEN {_FIRST} IN {q.in_list(d.SHOP_LABELS)} THEN {_FIRST} ELSE 'Unclear' END AS label
    FROM {_domain_facts(_ALL[:2], f"(status <> 200 OR NOT {q.blank('text')})", _READABLE)} AS f
    LEFT JOIN responses AS r ON r.row_idx = f.row_idx""")
def classify_shop_domains(spark, sf):
    return pages.label_domains(frame(spark, sf, "domains"), frame(spark, sf, "attempts"),
                               frame(spark, sf, "responses"))


_RAW_READABLE = f"(status = 200 AND NOT {q.blank('text')})"


@query("classify_shop_domains_raw", cte("domains", "attempts", "responses") + f"""
    SELECT f.row_idx, domain, CASE WHEN NOT coalesce(t, false) THEN 'Unscrapable'
        WHEN {_FIRST} IN {q.in_list(d.SHOP_LABELS)} THEN {_FIRST} ELSE 'Unclear' END AS label
    FROM {_domain_facts(_ALL[2:], f"(status <> 200 OR NOT {q.blank('text')})", _RAW_READABLE, q.bare_domain('raw'), H.CONSENT_MARKERS)} AS f
    LEFT JOIN responses AS r ON r.row_idx = f.row_idx""")
def classify_shop_domains_raw(spark, sf):
    return pages.label_domains(frame(spark, sf, "domains"), frame(spark, sf, "attempts"), frame(spark, sf, "responses"),
                               stages=("brightdata",), as_lines=("brightdata",))


@query("about_description", cte("anchored") + """
    SELECT key, url || CASE key % 6 WHEN 0 THEN '/About-us' WHEN 1 THEN '/o-nas' WHEN 2 THEN '/x' WHEN 5 THEN '/team?x=1&y=2' ELSE '' END AS target,
      CASE WHEN key % 6 = 0 THEN 'About' || chr(10) || 'onetwo' || chr(10) || 'We are ' || key
           WHEN key % 6 IN (1, 2, 5) THEN '' ELSE body END AS description
    FROM anchored JOIN (SELECT s_suppkey AS key, s_name AS body FROM supplier
      UNION ALL SELECT doc_id + 1000000, """ + q.strip("text") + """ FROM documents) USING (key)""")
def about_description(spark, sf):
    return crawl.about_descriptions(frame(spark, sf, "anchored"), frame(spark, sf, "about_pages"), "key")
