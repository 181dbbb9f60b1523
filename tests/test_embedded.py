import pytest
from pyspark.sql import functions as F

from leadframe.functions import embedded
from leadframe.operators import crawl, records


def test_attributes(column):
    tags = ["<meta content='a > b name=description' NAME = Description data-x/>", '<a href=x?y=1 title="it\'s \"">', "<br>", "<p", None,
            "<i a='1' a=2 b=\"\" c = ''>text a=3</i>"]
    got = column(tags, lambda t: F.transform(embedded.attributes(t), lambda a: F.concat_ws("|", a["name"], a["value"])))
    assert got[0] == ["content|a > b name=description", "name|Description", "data-x|"]
    assert got[2] == [] and got[3] == [] and got[4] is None
    assert got[5] == ["a|1", "a|2", "b|", "c|"]


@pytest.mark.parametrize("html, want", [
    ('<meta name="description" content="one">', "one"), ("<META content='two' name=DESCRIPTION>", "two"),
    ('<meta property="og:title" content="name=description"><meta content="three" name="description"><meta name=description content=four>', "three"),
    ('<meta name="description">', ""), ("<p>none</p>", ""), ('<meta name="description" content="5 > 4 &amp; more">', "5 > 4 & more")])
def test_description_in_any_order(spark, html, want):
    assert records.page_contacts(spark.createDataFrame([(html,)], "html string")).head().description == want


def _page(*blocks):
    return "".join(f'<script type="application/ld+json">{b}</script>' for b in blocks)


ADDRESSES = {
    _page('{"address": "  Main St 1,\\n Town "}'): "Main St 1, Town",
    _page("not json", '{"address": {"streetAddress": "S 1", "postalCode": 12345, "addressLocality": "T", "addressRegion": "R", "addressCountry": "DE"}}'): "S 1, 12345 T, R, DE",
    _page('[{"name": "x"}, {"address": [{"streetAddress": "S 2"}, {"streetAddress": "S 3"}]}]'): "S 2",
    _page('{"@graph": [{"address": {"addressLocality": "T"}}]}'): "T",
    _page('{"address": {"addressCountry": {"name": "Poland"}}}', '{"address": "later"}'): "Poland",
    _page('{"address": {}}') + "<p itemprop='streetAddress'>  Road\n 5 </p><span class=x itemprop=postalCode>99</span>": "Road 5, 99",
    '<meta itemprop="addressLocality" content="Rome">': "Rome",
    "<p>itemprop= none</p>": None, "": None, _page("[]", "7", "null"): None,
}


def test_addresses(column):
    got = column([*ADDRESSES, None], lambda t: embedded.first_address(embedded.json_ld(t), embedded.microdata(t)))
    assert got == [*ADDRESSES.values(), None]


def test_notes_phones_and_missing_pages(spark):
    page = _page('{"slogan": "Go", "vatID": "DE1", "telephone": "+49 (30) 1-2"}', '{"slogan": "Later", "foundingDate": 1999, "openingHours": ["Mo", "Tu"]}')
    got = records.page_contacts(spark.createDataFrame([(page + '<a href="tel:0301">x</a>',), (None,)], "html string")).collect()
    assert got[0].notes == "slogan: Go; foundingDate: 1999; vatID: DE1" and got[0].phones == ["+493012", "0301"]
    assert got[1].notes is None and got[1].address is None


def test_about_link_decodes_all_references(spark):
    page = '<a href="/o-&#110;as?a=1&amp;b=&auml;">x</a>'
    words = '<a href="/x">&Uuml;ber uns &#97;bout</a>'
    rows = spark.createDataFrame([(1, "https://a.de/b", page), (2, "https://a.de/b", words)], "i int, url string, html string")
    assert [r.about_url for r in crawl.about_link(rows, "url", "html").orderBy("i").collect()] == ["https://a.de/o-nas?a=1&b=ä", "https://a.de/x"]
