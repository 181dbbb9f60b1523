"""Lead tables derived from the given star-schema tables.

Each table is one SELECT that Spark and the SQL twin run alike, over all rows of
the tables it names.  Double brackets mark the few spots where the two dialects
spell the same thing differently.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()




def pick(values, index: str) -> str:
    """The value at an integer index; the list is one folded literal."""
    items = ", ".join(f"'{v}'" for v in values)
    return f"[[list(]]{items}[[)at]] CAST({index} AS int) + 1)"


def _div(column: str, by: int) -> str:
    return f"CAST(floor({column} / {by}) AS bigint)"


_PREFIX = ("", "Senior ", "Junior ", "Head of ", "Lead ", "Director of ", "Vice President ",
           "Chief ", "Assistant ", "VP ", "Principal ", "Intern ", "Global ")
_AREA = ("Marketing", "Sales", "Product", "Finance", "Legal", "IT", "HR", "Customer Support",
         "Customer Success", "E-commerce", "Logistics", "Data", "Cloud", "Design", "Operations",
         "Analytics", "analytics", "Quality Assurance", "Payroll", "Compliance", "Content",
         "Business Development", "UX", "Ninja", "Astronomy", "Product  Owner", "Warehouse")
_ROLE = (" Manager", " Specialist", " Owner", " Engineer", " Analyst", " analyst", " Architect",
         " Consultant", " Director", " Expert", "", " Assistant", " Lead", " Scientist",
         " Project Manager", " Evangelist", " PM", " Wizard", " Trainee")
_SPECIAL = (
    "CEO", "Co-Founder", "co founder & CEO", "Product Owner", "Process Owner", "Homeowner",
    "Vice President", "EVP Sales", "Executive Assistant to the CEO", "Office of the CEO",
    "Chief Executive Officer", "Chief Marketing Officer", "Chief Strategy Officer", "CSO", "CGO",
    "chief growth officer", "COO", "CMO", "President", "Co-Owner", "Owner", "Founder",
    "Developer Advocate", "devrel", "Pre-Sales", "Solutions Engineer", "Cloud Architect", "SDET",
    "Factory Supervisor", "TPM", "IT Project Manager", "Project Manager", "Recruiter",
    "Paralegal", "GDPR Officer", "RevOps Lead", "CRM Manager", "Salesforce Admin", "Help Desk",
    "call center agent", "seo analyst", "data analyst", "Data Analyst", "Procurement", "hr",
    "pm s helper", "pm", "PO", "ux", "3d artist", "controller", "coach", "Wizard", "Stargazer",
    "Chairman", "chief x", "CS", "cs lead", "CTO / Co-Founder", "Master Chef", "Data Owner",
    "Office Manager", "Chief of Marketing in Acme", "Chief of Technology",
    "Head of Talent Success, Acme", "Founder, Managing Partner", "Lead Developer / Tech Lead",
)

_NORM = "regexp_replace(trim(title), ' +', ' '[[g]])"

# Phrases put into every page, one after the other, so that each label occurs.
_PHRASES = (
    "Your e-commerce partner",
    "logistics, payment gateway and billing for merchants",
    "add to cart, buy now, checkout, wishlist",
    "e-commerce platform: add to cart, buy now, in stock",
    "We use cookies</p><p>second line",
    "Attention Required: verify you are human",
    "Fulfillment and dashboard analytics integration",
    "API reference, sandbox and add to cart demo",
    "commerce news &amp; caf&eacute; culture &#8217;quoted&#8217;&nbsp;text &amp;lt;",
    "<!-- cart --><script>var t = 1 < 2; // checkout now <p></script><a title=\"a > b\">plain</a>",
    "Gr&ouml;&szlig;e w&auml;hlen, jetzt kaufen, lieferzeit, laptop, sofa",
)

_SOURCES = ("requests", "selenium", "brightdata")


def _attempts() -> str:
    parts = []
    for n, source in enumerate(_SOURCES):
        parts.append(f"""
        SELECT 'https://d' || CAST(page_id AS string) || '.example.com' AS url,
               '{source}' AS source,
               CASE WHEN (page_id + {n}) % 5 = 0 THEN 403
                    WHEN (page_id + {n}) % 7 = 0 THEN 500 ELSE 200 END AS status,
               CASE WHEN (page_id * 3 + {n}) % 4 = 0 THEN NULL
                    WHEN (page_id * 3 + {n}) % 5 = 1 THEN '  ' ELSE html END AS html
        FROM {{pages_kw}}""")
    return " UNION ALL ".join(parts)


_DESC = "replace(replace(replace(text, '\"', ''), chr(92), ''), chr(10), ' ')"
_TICKS = "```"


def _json(*pairs: tuple[str, str]) -> str:
    """SQL text of a JSON object; values are SQL expressions of quoted text."""
    inner = " || ', ' || ".join(f"'\"{name}\": ' || {value}" for name, value in pairs)
    return f"'{{{{' || {inner} || '}}}}'"


def _quoted(expr: str) -> str:
    return f"'\"' || {expr} || '\"'"


_COMPANY_JSON = _json(
    ("Company Name", _quoted("'Firm ' || CAST(doc_id AS string)")),
    ("Company Domain", _quoted("source || '.example.com'")),
    ("Email", "CASE WHEN doc_id % 4 = 0 THEN 'null' ELSE '\"info@' || source || '.example.com\"' END"),
    ("Phone Number", "CASE WHEN doc_id % 3 = 0 THEN CAST(doc_id + 100000 AS string) "
                     "ELSE '\"+48 ' || CAST(doc_id AS string) || '\"' END"),
    ("Address", _quoted("'Street ' || CAST(n_chars AS string)")),
    ("Hall Number", _quoted("''")),
    ("Description", _quoted(_DESC)),
    ("Linkedin  link", _quoted("'https://linkedin.example/' || source")),
)
_SPEAKER_JSON = _json(
    ("company name", _quoted("' Firm ' || CAST(doc_id AS string) || ' '")),
    ("Speaker First name", _quoted("CASE WHEN doc_id % 5 = 0 THEN 'An' || chr(92) || '\"na' ELSE 'Anna' END")),
    ("Speaker Last name", _quoted("'L' || CAST(doc_id AS string)")),
    ("Topic of talk", _quoted(_DESC)),
    ("Language", "CASE WHEN doc_id % 4 = 1 THEN 'null' ELSE '\"' || lang || '\"' END"),
    ("Date and hour", _quoted("'2025-03-01 10:00'")),
)


def _outputs(body: str) -> str:
    return f"""
    SELECT doc_id, 'https://expo.example.com/' || CAST(doc_id AS string) AS url,
      CASE doc_id % 5
        WHEN 0 THEN '{_TICKS}json' || chr(10) || {body} || chr(10) || '{_TICKS}'
        WHEN 1 THEN {body}
        WHEN 2 THEN 'Here you go:' || chr(10) || '{_TICKS} JSON ' || {body} || '{_TICKS}' || chr(10) || 'Done.'
        WHEN 3 THEN {body}
        ELSE 'Sorry, nothing found in ' || lang END AS model_output
    FROM {{documents}}"""


FIXTURES: dict[str, tuple[tuple[str, ...], str]] = {
    "titles": (("customer",), f"""
        SELECT c_custkey + 1 AS row_idx,
          CASE WHEN c_custkey % 11 = 0 THEN upper(raw) WHEN c_custkey % 7 = 0 THEN ' ' || replace(raw, ' ', '  ')
               ELSE raw END AS title
        FROM (SELECT c_custkey,
                CASE WHEN c_custkey % 17 = 0 THEN '' WHEN c_custkey % 17 = 1 THEN '   '
                     WHEN c_custkey % 3 = 0 THEN {pick(_SPECIAL, f"{_div('c_custkey', 3)} % {len(_SPECIAL)}")}
                     ELSE {pick(_PREFIX, f'c_custkey % {len(_PREFIX)}')}
                       || {pick(_AREA, f"{_div('c_custkey', 13)} % {len(_AREA)}")}
                       || {pick(_ROLE, f"{_div('c_custkey', 7)} % {len(_ROLE)}")} END AS raw
              FROM {{customer}}) AS t"""),
    "titles_norm": (("titles",), f"""
        SELECT {_NORM} AS title_norm, min(row_idx) AS first_row, max(row_idx) AS last_row
        FROM {{titles}} GROUP BY 1"""),
    "label_cache": (("titles_norm",), """
        SELECT title_norm, CASE WHEN title_norm LIKE '%e%' THEN 'consulting' ELSE 'product' END AS label,
               CAST(length(title_norm) AS double) / 64 AS score
        FROM {titles_norm} WHERE last_row < first_row * 30"""),
    "title_scores": (("titles_norm",), " UNION ALL ".join(
        f"SELECT title_norm, '{label}' AS label, "
        f"CAST((length(title_norm) * 7 + {n * 17}) % 101 AS double) / 101 AS score "
        "FROM {titles_norm} WHERE title_norm <> ''"
        for n, label in enumerate(("marketing", "sales", "product", "finance & accounting")))),
    "renames": (("titles",), """
        SELECT DISTINCT trim(title) AS title, ' ' || upper(trim(title)) || ' ' AS renamed
        FROM {titles} WHERE title LIKE '%a%'"""),
    "pages_kw": (("pages",), f"""
        SELECT page_id, url,
          CASE page_id % 13 WHEN 11 THEN NULL WHEN 12 THEN '<html><body> <p></p></body></html>'
            ELSE replace(html, '<body>', '<body><div><p>' || {pick(_PHRASES, 'page_id % 13')} || '</p></div>') END AS html
        FROM {{pages}}"""),
    "domains": (("pages",), """
        SELECT page_id + 1 AS row_idx,
          CASE page_id % 9
            WHEN 0 THEN 'd' || CAST(page_id AS string) || '.example.com'
            WHEN 1 THEN ' https://d' || CAST(page_id AS string) || '.example.com/path?q=1 '
            WHEN 2 THEN 'www.d' || CAST(page_id AS string) || '.example.com'
            WHEN 3 THEN 'http://user@d' || CAST(page_id AS string) || '.example.com:8080/x'
            WHEN 4 THEN '.d' || CAST(page_id AS string) || '.example.com/'
            WHEN 5 THEN 'not a domain'
            WHEN 6 THEN ''
            WHEN 7 THEN url
            ELSE 'd' || CAST(page_id AS string) || '.example.c0m' END AS raw
        FROM {pages}"""),
    "attempts": (("pages_kw",), _attempts()),
    "broken_attempts": (("attempts",), """
        SELECT *, CASE WHEN status = 500 THEN 'timed out' WHEN status = 403 THEN ' ' END AS error FROM {attempts}"""),
    "deal_loads": (("orders",), f"""
        SELECT {_div('o_orderkey', 8)} % 25 AS load_id, count(*) AS announced FROM {{orders}}
        WHERE {_div('o_orderkey', 8)} % 25 < 20 GROUP BY 1"""),
    "responses": (("pages",), """
        SELECT page_id AS row_idx, CASE page_id % 8
            WHEN 0 THEN 'Shop' WHEN 1 THEN ' Service Provider ' WHEN 2 THEN 'Shop' || chr(10) || 'because of the cart'
            WHEN 3 THEN 'A shop' WHEN 4 THEN '' WHEN 5 THEN NULL
            WHEN 6 THEN 'maybe' || chr(10) || 'Shop' ELSE 'shop' END AS model_output
        FROM {pages} WHERE url NOT LIKE '%.html'"""),
    "existing_labels": (("pages",), """
        SELECT page_id AS row_idx, CASE WHEN page_id % 4 = 0 THEN NULL ELSE 'old ' || CAST(page_id AS string) END AS label
        FROM {pages}"""),
    "fresh_labels": (("pages",), """
        SELECT page_id AS row_idx, CASE WHEN url LIKE '%page%' THEN '' ELSE 'new' END AS label
        FROM {pages} WHERE url LIKE 'https%'"""),
    "score_input": (("customer", "orders"), """
        SELECT 'd' || CAST(c_custkey AS string) || '.example.com' AS domain,
          CASE c_custkey % 8 WHEN 0 THEN '1-10' WHEN 1 THEN '11-50' WHEN 2 THEN '51-200' WHEN 3 THEN '201-500'
               WHEN 4 THEN '201+' WHEN 5 THEN '501+' WHEN 6 THEN '' ELSE '1 - 10' END AS alexa_rank,
          CASE c_custkey % 9 WHEN 0 THEN '' WHEN 1 THEN 'abc' WHEN 2 THEN '12.5' WHEN 3 THEN '-5'
               WHEN 4 THEN ' ' || CAST(total AS string) || ' ' WHEN 5 THEN CAST(total % 70000 AS string)
               ELSE CAST(total AS string) END AS revenue,
          CASE WHEN c_custkey % 10 = 0 THEN '' ELSE 'about ' || c_mktsegment END AS description
        FROM {customer} LEFT JOIN (
            SELECT o_custkey, sum(CAST(floor(o_totalprice) AS bigint)) AS total
            FROM {orders} GROUP BY o_custkey) AS o ON c_custkey = o_custkey"""),
    "score_answers": (("customer",), """
        SELECT 'd' || CAST(c_custkey AS string) || '.example.com' AS domain, CASE c_custkey % 7
            WHEN 0 THEN '{{"score": 45, "reasons": ["b2b saas", "ai"], "exhibitor_type": "technology solutions"}}'
            WHEN 1 THEN '{{"score": 60, "reasons": ["payments"], "exhibitor_type": "payments solutions"}}'
            WHEN 2 THEN '{{"score": 10, "reasons": ["Access Denied"], "exhibitor_type": "other"}}'
            WHEN 3 THEN '{{"score": 33, "reasons": []}}'
            WHEN 4 THEN 'no json'
            WHEN 5 THEN '{{"reasons": ["logistics hub", "3pl"], "exhibitor_type": "logistics and supply chain"}}'
            ELSE '{{"score": ' || CAST(c_custkey % 61 AS string) || ', "reasons": ["r"], "exhibitor_type": "other"}}' END AS answer
        FROM {customer} WHERE c_mktsegment <> 'BUILDING'"""),
    "company_outputs": (("documents",), _outputs(_COMPANY_JSON)),
    "speaker_outputs": (("documents",), _outputs(_SPEAKER_JSON)),
    "people": (("customer", "nation"), f"""
        SELECT c_custkey AS row_idx,
          CASE WHEN c_custkey % 13 = 0 THEN ' ' ELSE 'First' || CAST({_div('c_custkey', 3)} AS string) END AS first_name,
          CASE WHEN c_custkey % 19 = 0 THEN NULL ELSE 'Last' || CAST(c_custkey AS string) || ' ' END AS last_name,
          'Org ' || c_mktsegment AS organization_name,
          {pick(_PREFIX, f'c_custkey % {len(_PREFIX)}')} || {pick(_AREA, f"{_div('c_custkey', 13)} % {len(_AREA)}")}
            || {pick(_ROLE, f"{_div('c_custkey', 7)} % {len(_ROLE)}")} AS title,
          CASE WHEN c_custkey % 6 = 0 THEN '' ELSE 'p' || CAST(c_custkey AS string) || '@example.com' END AS email,
          n_name AS city, c_mktsegment AS industry,
          CASE WHEN c_acctbal > 5000 THEN 'verified' ELSE 'unverified' END AS email_status,
          CAST(floor(abs(c_acctbal)) AS bigint) AS employees, n_name AS organization_country,
          c_mktsegment AS label
        FROM {{customer}} JOIN {{nation}} ON c_nationkey = n_nationkey"""),
    "people_wide": (("people",), f"""
        SELECT *, {pick(("Owner", "C_suite", "VP", "Head", "Manager"), 'row_idx % 5')} AS seniority,
          {pick(("Master_Marketing", "master_sales", "engineering"), f"{_div('row_idx', 2)} % 3")} AS department,
          CASE WHEN row_idx % 11 = 3 THEN NULL ELSE row_idx % 4 = 0 END AS prospected,
          CASE WHEN row_idx % 9 = 0 THEN NULL ELSE split('Ecommerce,' || lower(industry) || ',tag ' || CAST(row_idx % 3 AS string), ',') END AS keyword_tags
        FROM {{people}}"""),
    "email_lookup": (("people",), """
        SELECT organization_name, trim(first_name) AS first_name, trim(last_name) AS last_name,
          'found' || CAST(row_idx AS string) || '@example.com' AS email,
          CAST(row_idx % 100 AS int) AS confidence_score,
          CASE WHEN employees > 3000 THEN 'valid' ELSE 'accept_all' END AS mail_status
        FROM {people} WHERE organization_name <> 'Org BUILDING'"""),
    "email_status": (("people",), """
        SELECT email, CASE WHEN employees > 4000 THEN 'valid' ELSE 'invalid' END AS status
        FROM {people} WHERE email <> '' AND industry <> 'MACHINERY'"""),
    "deal_pages": (("orders",), f"""
        SELECT page_no % 25 AS load_id, page_no,
          CASE WHEN top_price > 499000 THEN '{{{{"success": false, "error": "limit"}}}}'
               WHEN top_price < 150000 THEN '{{{{"success": true, "data": null}}}}'
               ELSE '{{{{"success": true, "data": [' || deals || ']}}}}' END AS payload
        FROM (SELECT {_div('o_orderkey', 8)} AS page_no, max(o_totalprice) AS top_price, string_agg(
            '{{{{"id": ' || CAST(o_orderkey AS string) || ', "title": "Deal ' || CAST(o_orderkey AS string)
            || '", "value": ' || CAST(CAST(floor(o_totalprice) AS bigint) AS string)
            || ', "currency": "EUR", "status": "' || o_orderstatus || '", "stage_id": ' || CAST(o_orderkey % 5 AS string)
            || ', "owner_name": null, "person_id": ' || CASE WHEN o_orderkey % 2 = 0
                 THEN '{{{{"name": "P' || CAST(o_orderkey AS string) || '", "email": ['
                      || CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE '{{{{"value": "p' || CAST(o_orderkey AS string) || '@example.com"}}}}' END || ']}}}}'
                 ELSE CAST(o_orderkey AS string) END
            || ', "org_id": ' || CASE WHEN o_orderkey % 3 = 0 THEN '{{{{"name": "Org", "address": "Street 1"}}}}' ELSE 'null' END
            || ', "lost_reason": "' || o_orderpriority || '"}}}}', ', ') AS deals
          FROM {{orders}} GROUP BY 1) AS o"""),
    "graph_edges": (("lineitem", "part"), """
        SELECT src, dst FROM (
          SELECT 'https://shop' || CAST(l_orderkey % 3 AS string) || '.example.com/o/' || CAST(l_orderkey AS string) AS src,
                 'https://shop' || CAST(l_partkey % 3 AS string) || '.example.com/p/' || CAST(l_partkey AS string) AS dst
          FROM {lineitem}
          UNION ALL
          SELECT 'https://shop' || CAST(l_partkey % 3 AS string) || '.example.com/p/' || CAST(l_partkey AS string),
                 'https://shop' || CAST(l_orderkey % 3 AS string) || '.example.com/o/' || CAST(l_orderkey AS string)
          FROM {lineitem}
          UNION ALL
          SELECT 'https://shop' || CAST(p_partkey % 3 AS string) || '.example.com/',
                 'https://shop' || CAST(p_partkey % 3 AS string) || '.example.com/p/' || CAST(p_partkey AS string)
          FROM {part} WHERE p_brand = 'Brand#2'
          UNION ALL
          SELECT 'https://shop' || CAST(p_partkey % 3 AS string) || '.example.com/p/' || CAST(p_partkey AS string),
                 'https://shop' || CAST(p_partkey % 3 AS string) || '.example.com/'
          FROM {part}) AS e"""),
    "site_pages": (("pages",), f"""
        SELECT page_id, 'https://site' || CAST(page_id % 3 AS string) || '.example.com/info_' || CAST(page_id AS string) AS url,
          CASE WHEN page_id % 10 = 9 THEN NULL ELSE replace(html, '<body>', '<body>'
            || '<a class="n" href="info_' || CAST(page_id + 3 * (4 * {_div('page_id', 3)} + 1) AS string) || '">1</a>'
            || '<a href="./info_' || CAST(page_id % 3 + 3 * (4 * {_div('page_id', 3)} + 2) AS string) || '">2</a>'
            || '<a href="/x/../info_' || CAST(page_id % 3 + 3 * (4 * {_div('page_id', 3)} + 3) AS string) || '">3</a>'
            || '<a href="https://site' || CAST((page_id + 1) % 3 AS string) || '.example.com/info_' || CAST(page_id + 1 AS string) || '">4</a>'
            || '<a href="/info_' || CAST(page_id % 3 + 3 * (4 * {_div('page_id', 3)} + 4) AS string) || '#top">5</a>') END AS html
        FROM {{pages}}"""),
    "site_attempts": (("site_pages",), " UNION ALL ".join(f"""
        SELECT url, '{source}' AS source, CASE {gaps} ELSE replace(html, '</head>', '<meta content="{source} ' || CAST(page_id AS string)
          || '" name="description"><script type="application/ld+json">{{{{"slogan": "via {source}", "telephone": "+48 ' || CAST(page_id AS string)
          || '", "email": "{source}@site' || CAST(page_id % 3 AS string) || '.example.com", "address": {{{{"streetAddress": "Road ' || CAST(page_id AS string)
          || '", "postalCode": "00-001", "addressLocality": "Town"}}}}}}}}</script></head>') END AS html
        FROM {{site_pages}}""" for source, gaps in (
            ("brightdata", "WHEN page_id % 8 = 7 THEN ''"), ("requests", "WHEN page_id % 4 = 1 THEN NULL WHEN page_id % 4 = 3 THEN ' '"),
            ("selenium", "WHEN page_id % 8 IN (1, 7) THEN NULL")))),
    "follower_texts": (("customer",), """
        SELECT c_custkey AS row_idx, 'user' || CAST(c_custkey AS string) AS username, CASE c_custkey % 6
            WHEN 0 THEN 'POSTS 3 FOLLOWERS' || chr(10) || CAST(c_custkey + 1000 AS string) || chr(10) || 'FOLLOWING 2'
            WHEN 1 THEN 'FOLLOWERS 1,' || CAST(c_custkey % 900 + 100 AS string)
            WHEN 2 THEN 'FOLLOWERS 12 345' || chr(10) || 'x'
            WHEN 3 THEN 'followers 9'
            WHEN 4 THEN 'FOLLOWERS ,'
            ELSE 'no numbers here' END AS body
        FROM {customer}"""),
    "company_names": (("supplier", "customer"), f"""
        SELECT key, {pick(("Acme", "Media4U e-Commerce", "zeroseven design", "Nordic Tools", "Group", "Zen®", "Blue Sky"), 'key % 7')}
          || {pick((" GmbH", " Inc.", " France", " Media Group Ltd", "", " Sp. z o.o.", ", LLC", " Studios", " Global Holding AG", " GmbH & Co. KG", "®"), 'key % 11')} AS name
        FROM (SELECT s_suppkey AS key FROM {{supplier}} UNION ALL SELECT c_custkey + 1000000 FROM {{customer}}) AS k"""),
    "contact_pages": (("documents",), """
        SELECT doc_id, '<html><head><title> Doc ' || CAST(doc_id AS string) || ' &amp; more</title>'
          || '<meta charset="utf-8">' || CASE WHEN doc_id % 2 = 0 THEN '<meta name="description" content="About ' || source || ' ">'
               ELSE '<meta content=''About ' || source || ' > name=description '' data-x NAME = description />' END
          || CASE doc_id % 6 WHEN 0 THEN '<script type="application/ld+json">{{"@context": "https://schema.org", "@graph": [{{"@type": "WebSite"}}, '
                    || '{{"@type": "Organization", "slogan": "Say ' || lang || '", "telephone": "+49 30 ' || CAST(doc_id AS string)
                    || '", "address": {{"@type": "PostalAddress", "streetAddress": "Street ' || CAST(doc_id AS string)
                    || '", "postalCode": "10115", "addressLocality": "Town", "addressCountry": {{"name": "DE"}}}}}}]}}</script>'
               WHEN 1 THEN '<script type=''application/ld+json''>[{{"address": "Line ' || CAST(doc_id AS string) || ',  Town", "openingHours": ["Mo"], "vatID": 7}}]</script>'
               WHEN 2 THEN '<script type="application/ld+json">{{"address": broken</script>' ELSE '' END
          || '</head><body><p>' || text || '</p>'
          || CASE WHEN doc_id % 6 = 2 THEN '<div itemprop="address" itemscope><b itemprop="streetAddress">Road ' || CAST(doc_id AS string)
               || ' </b><meta content="Paris" itemprop=''addressLocality''></div>' ELSE '' END
          || CASE WHEN doc_id % 3 = 0 THEN '<a href="mailto:Info@' || source || '.example.com">mail</a>' ELSE '' END
          || CASE WHEN doc_id % 4 = 0 THEN '<a href="tel:+49 (30) ' || CAST(doc_id AS string) || '">call</a>' ELSE '' END
          || CASE WHEN doc_id % 5 = 0 THEN '<a href="https://www.linkedin.com/company/' || source || '">in</a>' ELSE '' END
          || '</body></html>' AS html
        FROM {documents}"""),
    "anchored": (("supplier", "documents"), """
        SELECT key, 'https://' || host AS url, '<body><!-- <a href="/about-hidden">x</a> --><nav>' || CASE key % 6
            WHEN 0 THEN '<a href="/start">Start</a><a class="m" href="/About-us">Us</a>'
            WHEN 1 THEN '<a href="https://facebook.com/about">fb</a><a href=''/o-nas''>O nas</a>'
            WHEN 2 THEN '<a href="/x">Our <b>Story</b></a>'
            WHEN 3 THEN '<a href="/contact">Contact</a>'
            WHEN 4 THEN '<a href="https://www.linkedin.com/company/a">li</a>'
            ELSE '<a href=/team?x=1&amp;y=2>T</a>' END || '</nav><p>' || body || '</p></body>' AS html
        FROM (SELECT s_suppkey AS key, 's' || CAST(s_suppkey AS string) || '.example.com' AS host, s_name AS body FROM {supplier}
              UNION ALL SELECT doc_id + 1000000, 'doc' || CAST(doc_id AS string) || '.example.com', text FROM {documents}) AS k"""),
    "profile_pages": (("supplier", "nation"), """
        SELECT s_suppkey, s_nationkey, 'https://shops.example.com/review/info_' || CAST(s_suppkey AS string) AS url,
          '<html><body><a href="//s' || CAST(s_suppkey AS string) || '.example.com" class="logo companyHeader_companyLogoLinkWrapper__hLXvD">x</a>'
          || '<a class="contactInfo_companyContactDetailLink__OzJ99" href="mailto:a@b.c">m</a>'
          || '<a class="contactInfo_companyContactDetailLink__OzJ99" href="tel:+48' || CAST(s_suppkey AS string) || '">+48 ' || CAST(s_suppkey AS string) || '</a>'
          || '<div><div class="contactInfo_companyOrgName__HK12P">' || s_name || '</div><span> Street 1<br>' || n_name || '</span></div>'
          || '<div><h5 class="contactInfo_legalHeadline__dkozH">Vertreten durch</h5><p>x</p>'
          || '<span class="contactInfo_legalInfoText__D83Rl">Ann Lee<br>Bob Ray</span></div>'
          || CASE WHEN s_suppkey % 4 = 0 THEN '' ELSE '<div class="companyDetails_companyDescription__rruNt"><span>About' || chr(10) || s_name || '</span></div>' END
          || '</body></html>' AS html
        FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey"""),
    "listing_pages": (("profile_pages", "lineitem"), """
        SELECT CAST(floor(l_orderkey / 4) AS bigint) AS page_no, '<ul>' || string_agg(DISTINCT
            '<li><a href="https://shops.example.com/review/info_' || CAST(l_suppkey AS string) || '">p</a></li>', '') || '</ul>' AS html
        FROM {lineitem} GROUP BY 1"""),
    "about_pages": (("anchored",), """
        SELECT url, html FROM {anchored}
        UNION ALL
        SELECT url || '/About-us', '<html><body><nav><p>menu</p></nav><main><h1>About</h1><ul><li>one</li><li> two </li></ul><p>We are '
          || CAST(key AS string) || '</p><footer><p>foot</p></footer></main></body></html>'
        FROM {anchored} WHERE html LIKE '%/About-us%'"""),
}


_DIALECT = {
    "spark": {"[[g]]": "", "[[list(]]": "element_at(array(", "[[)at]]": "),"},
    "duckdb": {"[[g]]": ", 'g'", "[[list(]]": "list_extract([", "[[)at]]": "],"},
}


def _template(name: str, dialect: str) -> str:
    text = FIXTURES[name][1]
    for mark, replacement in _DIALECT[dialect].items():
        text = text.replace(mark, replacement)
    return text


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def frame(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, or a derived one built from it."""
    if name in TABLES:
        return table(spark, sf_dir, name)
    inputs, _ = FIXTURES[name]
    return spark.sql(_template(name, "spark"), **{i: frame(spark, sf_dir, i) for i in inputs})


def cte(*names: str) -> str:
    """``WITH`` clause that defines the named derived tables for the SQL twin."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name in TABLES or name in ordered:
            return
        for needed in FIXTURES[name][0]:
            visit(needed)
        ordered.append(name)

    for name in names:
        visit(name)
    bodies = []
    for name in ordered:
        sql = _template(name, "duckdb").format(**{i: i for i in FIXTURES[name][0]})
        bodies.append(f"{name} AS ({sql})")
    return "WITH RECURSIVE " + ",\n".join(bodies) + "\n"
