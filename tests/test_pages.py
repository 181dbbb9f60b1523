"""Votes, labels, scores and payloads on hand-written rows."""

import re

import pytest
from pyspark.sql import functions as F

from leadframe.functions import dictionaries as d
from leadframe.functions import payload as P
from leadframe.functions.rules import guarded, required_literal
from leadframe.operators import fetch, pages, profile, records, scoring

VOTES = {
    "": ("No content", "Yes: False Maybe: 0 No: 0"),
    "Our E-Commerce suite": ("Yes", "Yes: True Maybe: 0 No: 0"),
    "ecommerce with cart": ("Yes", "Yes: True Maybe: 0 No: 1"),
    "ecommerce cart wishlist": ("No", "Yes: True Maybe: 0 No: 2"),
    "logistics billing gateway": ("Maybe", "Yes: False Maybe: 3 No: 0"),
    "logistics billing": ("No", "Yes: False Maybe: 2 No: 0"),
    "logistics logistics logistics": ("No", "Yes: False Maybe: 1 No: 0"),
    "Cartoon": ("No", "Yes: False Maybe: 0 No: 1"),
    "facturación": ("No", "Yes: False Maybe: 2 No: 0"),
}


def test_exhibitor_vote(spark):
    rows = spark.createDataFrame([("a.com", t) for t in VOTES], "domain string, text string")
    got = {r.text: (r.label, r.stats) for r in pages.classify_exhibitor(rows, "domain", "text").collect()}
    assert got == VOTES


def test_exhibitor_invalid_domain(spark):
    rows = spark.createDataFrame([("nope", "e-commerce")], "domain string, text string")
    got = pages.classify_exhibitor(rows, "domain", "text").first()
    assert (got.label, got.stats) == ("Invalid domain", "Yes: False Maybe: 0 No: 0")


def test_votes_agree_with_re_on_given_texts(spark, sf_dir):
    """Brute force over whole documents: every pattern with Python's engine."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    sides = d.EXHIBITOR_KEYWORDS
    for r in pages.with_votes(docs, "text").collect():
        low = r.text.lower()
        count = {s: sum(bool(re.search(p, low)) for p in sides[s].values()) for s in sides}
        assert (r.strong_yes, r.maybe_hits, r.no_hits) == \
            (count["strong_yes"] > 0, count["maybe"], count["strong_no"])


def test_guard_changes_nothing():
    words = "our store and checkout now, plug-in, stocks, versand kasse e commerce".split(" ")
    for side in d.EXHIBITOR_KEYWORDS.values():
        for pattern in side.values():
            for word in words + [" ".join(words)]:
                assert bool(re.search(pattern, word)) == bool(re.search(guarded(pattern), word))
    assert guarded(r"\bab|cd") == r"\bab|cd" and guarded("a?b|c") == "a?b|c"


@pytest.mark.parametrize("branch,literal", [
    ("cart", "cart"), (r"add\s?to\s?cart", "cart"), ("stocks?", "stock"), ("fulfil(?:l)?ment", "fulfil"),
    (r"\b3pl\b", "3pl"), ("[0-9]{1,2}% off", "% off"), ("(?:a|b)[0-9]+", ""), (r"plug[-\s]?in", "plug"), ("ab+c", "ab"),
    (r"co\.uk", "co.uk"), ("ab{2}cd", "cd")])
def test_required_literal(branch, literal):
    assert required_literal(branch) == literal


def test_ecommerce(spark):
    cases = {("a.com", "Commerce!"): "Yes", ("a.com", "e commerce"): "Yes", ("a.com", "commercial"): "No",
             ("a.com", "  "): "No content", ("a.com", None): "No content", ("a", "commerce"): "Invalid domain"}
    rows = spark.createDataFrame(list(cases), "domain string, text string")
    for r in pages.classify_ecommerce(rows, "domain", "text").collect():
        assert r.label == cases[(r.domain, r.text)]


def test_shop_or_provider(spark):
    cases = {
        "add to cart, free shipping": "Shop", "api reference and merchant account": "Service Provider",
        "freight and rest api, merchant account": "Service Provider", "12,99 € new arrivals": "Shop",
        "monthly fee, book a demo": "Service Provider", "hello": "Unclear", " ": "Unscrapable",
    }
    rows = spark.createDataFrame([(t,) for t in cases], "text string")
    assert {r.text: r.label for r in pages.classify_shop_sp(rows, "text").collect()} == cases


def test_closed_labels(column):
    cases = {"Shop": "Shop", " Shop \n": "Shop", "Shop\nbecause": "Shop", "shop": "Unclear", "x\nShop": "Unclear",
             "": "Unclear", None: "Unclear"}
    assert column(list(cases), lambda c: P.unwrap_closed_label(c, d.SHOP_LABELS)) == list(cases.values())
    assert column(["A shop\nx", ""], lambda c: P.unwrap_closed_label(c, d.SHOP_LABELS, strict=False)) == \
        ["A shop", "Unclear"]


def test_taxonomy(column):
    texts = ["Luggage and Bags", "luggage AND bags", "Automotive and Accessorie", "Bags", None]
    assert column(texts, lambda c: pages.taxonomy_label(c, "industry")) == \
        ["Luggage and Bags", "Luggage and Bags", "Automotive and Accessories", "Unclear", "Unclear"]
    assert column(["shop", "Shops", "UNKNOWN"], lambda c: pages.taxonomy_label(c, "shop_kind")) == \
        ["Unclear", "Shops", "Unknown"]


def test_company_names(column):
    cases = {"Media4U e-Commerce Agency": "Media4U e-Commerce", "Zucchini France": "Zucchini", "ZLOGIC": "ZLOGIC",
             "Zen®": "Zen", "Acme GmbH & Co. KG": "Acme", "Acme, Inc.": "Acme", "GmbH": "GmbH", "": "",
             "Blue Sky Group Ltd": "Blue Sky"}
    assert column(list(cases), pages.clean_company_name) == list(cases.values())


def test_fit_line(spark):
    rows = spark.createDataFrame([("a.com;Yes;one; two",), ("a.com",), (None,)], "line string")
    got = [(r.domain, r.fit, r.explanation) for r in pages.split_fit_line(rows, "line").collect()]
    assert got == [("a.com", "Yes", "one; two"), ("a.com", "", ""), ("", "", "")]


def test_fetch_error(spark):
    rows = spark.createDataFrame([(200, "ok"), (403, "ok"), (200, "Please solve the CAPTCHA"), (200, None)],
                                 "status int, text string")
    got = [r.e for r in rows.select(pages.fetch_error("status", "text").alias("e")).collect()]
    assert got == [None, "HTTP_403", "Cloudflare/Captcha", None]


ATTEMPTS = [
    ("a", "requests", 200, "A1"), ("a", "selenium", 200, "A2"), ("b", "requests", 500, None),
    ("b", "selenium", 200, "B2"), ("c", "requests", 200, "  "), ("c", "brightdata", 200, "C3"),
    ("d", "requests", 200, ""), ("d", "selenium", 404, None), ("e", "selenium", 200, "E2"),
]


def test_repeated_attempts_give_one_row(spark):
    rows = spark.createDataFrame([*ATTEMPTS, ("a", "requests", 200, "A9"), ("e", "selenium", 200, "E2")],
                                 "url string, source string, status int, html string")
    got = fetch.first_settled(rows).collect()
    assert sorted(r.url for r in got) == ["a", "b", "c", "d", "e"]
    assert {r.url: r.html for r in got}["a"] in ("A1", "A9")


def settle(spark, *args):
    rows = spark.createDataFrame(ATTEMPTS, "url string, source string, status int, html string")
    return {r.url: (r.html, r.source) for r in fetch.first_settled(rows, *args).collect()}


def test_first_success(spark):
    assert settle(spark) == {"a": ("A1", "requests"), "b": ("B2", "selenium"), "c": ("C3", "brightdata"),
                             "d": (None, ""), "e": ("E2", "selenium")}


def test_facts_choose_the_same_attempt(spark):
    rows = spark.createDataFrame(ATTEMPTS, "url string, source string, status int, html string")
    for args in ((fetch.THREE_STAGES, None), (("requests", "selenium"), fetch.answered()),
                 (("requests", "selenium"), fetch.failed_or_has_html())):
        bodies = {r.url: (r.html, r.source) for r in fetch.first_settled(rows, *args).collect()}
        facts = fetch.first_settled_facts(rows, *args, payload=("html",)).collect()
        assert {r.url: (r.html, r.source) for r in facts} == bodies


def test_two_stage_policies(spark):
    two = ("requests", "selenium")
    assert settle(spark, two, fetch.answered()) == {
        "a": ("A1", "requests"), "b": ("B2", "selenium"), "c": ("  ", "requests"), "d": ("", "requests"),
        "e": ("E2", "selenium")}
    assert settle(spark, two, fetch.failed_or_has_html()) == {
        "a": ("A1", "requests"), "b": (None, "requests"), "c": (None, ""), "d": (None, "selenium"),
        "e": ("E2", "selenium")}


@pytest.mark.parametrize("text,ok", [
    ('{"a": 1}', True), ('{"a": 1} tail', False), ('{"a": 1}, {"b": 2}', False), ("[1, 2]", True), ("", False),
    ('{"a": 1}}', False), ('"text"', True), ("plain", False), ('{"a": 1}]', False), ("{'a': 1}", False)])
def test_strict_json(column, text, ok):
    assert column([text], lambda c: P.strict_json(c).isNotNull()) == [ok]


def test_json_or_raw(column):
    assert column(['{"a":"ü"}', "no"], lambda c: F.to_json(P.json_or_raw(c))) == ['{"a":"ü"}', '{"raw":"no"}']


def test_payload_text(column):
    def texts(c):
        return P.payload_text(F.try_parse_json(c))
    assert column(['{"raw":"r"}', '{"raw":"","b":1}', '"s"', '{"b":[1]}'], texts) == \
        ["r", '{"b":1,"raw":""}', "s", '{"b":[1]}']


def test_unfence(column):
    texts = ['x ```json\n{"a": {"b": 1}}\n``` y', '``` JSON {"a":1}```', '{"a":1}', "``` python\nx```",
             '```json {"a":1}``` ```json {"b":2}```']
    assert column(texts, P.unfence) == ['{"a": {"b": 1}}', '{"a":1}', '{"a":1}', "``` python\nx```", '{"a":1}']


def test_fields(column):
    text = '{"company  NAME" : " Acme \\"X\\" ", "Email": null, "Phone Number": "", "Address": 5}'
    assert column([text], lambda c: P.field(c, "Company Name")) == ['Acme \\']
    assert column([text], lambda c: P.field(c, "Address")) == [""]
    assert column([text], lambda c: P.field_loose(c, "Email")) == ["null"]
    assert column([text], lambda c: P.field_loose(c, "Phone Number")) == [""]
    assert column(['"Email": a@b.c }', '"Email": "open'], lambda c: P.field_loose(c, "Email")) == ["a@b.c", '"open']


def test_scores(column):
    assert column(["1-10", "501+", "201+", "1 - 10", "", None], scoring.size_score) == [1, 10, 8, 0, 0, 0]
    assert column(["1000000", "999999", "300000", "100000", "50000", "5000", "4999", "-3", "12.5", "x", "", None],
                  scoring.revenue_score) == [10, 8, 8, 7, 4, 3, 1, 1, 0, 0, 0, 0]
    assert column(["10,000", "10001", "900000", "2000000", "x"], scoring.retired_rank_score) == [10, 8, 4, 2, 0]


def test_total_score(spark):
    rows = spark.createDataFrame([
        ("a", "501+", "1000000", "text"), ("b", "", "", "text"), ("c", "1-10", "x", ""), ("d", "1-10", "x", "text"),
        ("e", "11-50", "5000", "text")], "domain string, alexa_rank string, revenue string, description string")
    answers = spark.createDataFrame([
        ("a", '{"score": 60, "reasons": ["B2B SaaS", "ai"], "exhibitor_type": "other"}'), ("b", '{"score": 10}'),
        ("c", '{"score": 60}'), ("d", "broken"), ("e", '{"score": 9, "reasons": ["Access denied"]}')],
        "domain string, answer string")
    got = {r.domain: (r.llm_score, r.total_score, r.reasons, r.exhibitor_type, r.error)
           for r in scoring.score_exhibitors(rows, answers).collect()}
    assert got == {
        "a": (60, 100.0, "B2B_SaaS,ai", "other", None), "b": (10, 16.67, "", "N/A", None),
        "c": (-1, -1.0, "no_description", "", None), "d": (0, 1.43, "", "N/A", "unreadable answer"),
        "e": (-1, -1.0, "Access_denied", "N/A", None)}
    short = {r.domain: r.reasons for r in scoring.score_exhibitors(rows, answers, style="underscore").collect()}
    assert short["a"] == "B2B SaaS_ai"


def test_main_content():
    page = ("<body><nav><p>menu</p></nav><article><h1> T <i>x</i></h1><p>a<p>b</p></p><ul><li>1</li><li><p>2</p></li></ul>"
            "<footer><p>f</p></footer><script>s</script></article><p>out</p></body>")
    assert profile.content_text(page) == "Tx\nab\nb\n12\n2"
    assert profile.content_text("<main><h2>m</h2></main>") == "m"
    assert profile.content_text("<body><p>b</p></body>") == "b"
    assert profile.content_text("<p>none</p>") == "" and profile.content_text(None) == ""


def test_main_content_of_broken_pages(spark):
    pages_ = {"<body><p>a<!-- c --> b</p>" + "<!-- " * 50_000: "ab", "<body><p>x</p>" + "<a " * 50_000: "x",
              "<body><script>'<!--'</script><p>y</p>": "y"}
    rows = spark.createDataFrame([(p,) for p in pages_], "html string")
    assert {r.html: r.o for r in profile.main_content(rows, "html", "o").collect()} == pages_


def test_profile_defaults_to_blanks():
    assert set(profile.profile_fields("<p>x</p>", d.PROFILE_CLASSES, d.PROFILE_CONTACT_HEADING).values()) == {""}


def test_requests(spark):
    rows = spark.createDataFrame([(1, "a.com", "long text"), (2, "b.com", " ")], "k int, domain string, body string")
    got = records.request_table(rows, "About {domain}:\n{body}!", "k", body=4).collect()
    assert sorted((r.k, r.part, r.prompt) for r in got) == [
        (1, 0, "About a.com:\nlong!"), (1, 1, "About a.com:\n tex!"), (1, 2, "About a.com:\nt!")]


def test_head_cut_counts_raw_lines_once(spark):
    notice = "We use cookies consent gdpr\n"
    late = "<html><body>" + notice + "<br>\n" * 40 + "real text</body></html>"
    twice = "<html><body>" + "".join(f"<p>{'cookie consent gdpr' if i in (3, 55) else f'line {i}'}</p>" for i in range(70)) + "</body></html>"
    cells = spark.createDataFrame([(1, "a.com"), (2, "b.com")], "row_idx int, raw string")
    answers = spark.createDataFrame([(1, "Shop"), (2, "Shop")], "row_idx int, model_output string")
    tries = spark.createDataFrame([("https://a.com", "requests", 200, late), ("https://b.com", "brightdata", 200, twice)],
                                  "url string, source string, status int, html string")
    plain = {r.row_idx: r.label for r in pages.label_domains(cells, tries, answers).collect()}
    raw = {r.row_idx: r.label for r in pages.label_domains(cells, tries, answers, stages=("brightdata",), as_lines=("brightdata",)).collect()}
    assert (plain[1], raw[2]) == ("Shop", "Shop")


def test_cells_must_be_bare_domains(spark):
    cells = spark.createDataFrame([(1, "https://a.com/x"), (2, " a.com ")], "row_idx int, raw string")
    tries = spark.createDataFrame([("https://a.com", "requests", 200, "<p>commerce</p>")], "url string, source string, status int, html string")
    for label in (pages.exhibitor_domains, pages.ecommerce_domains):
        strict = {r.row_idx: r.label for r in label(cells, tries).collect()}
        open_ = {r.row_idx: r.label for r in label(cells, tries, normalize=True).collect()}
        assert strict[1] == "Invalid domain" and strict[2] == open_[1] == open_[2] != "Invalid domain"
