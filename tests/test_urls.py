"""URL helpers against urllib.parse."""

from itertools import product
from urllib.parse import urljoin, urlparse

from leadframe.functions import urls as U

BASES = ["http://a.com", "http://a.com/", "https://a.com/b/c/d", "https://a.com/b/c/", "https://a.com/b?x=1#f",
         "https://u@a.com:81/b/../c/d.html?q=/x/", "https://a.com//b//c"]
HREFS = ["", "x", "/x", "x/y", "./x", "../x", "../../x", "../../../../x", "x/./y/../z", "/x/../y", "/..", "..", ".",
         "?q=1", "#top", "//h.org/p", "http://other.com/z", "mailto:a@b.c", "x?y=../z", "x#../y", "a//b", "/a//b",
         " x", "x\ny", "tel:+48", "x/", "./", "/./a", "x../y", "..x"]


def test_resolve(spark):
    pairs = list(product(BASES, HREFS))
    rows = spark.createDataFrame([(i, b, h) for i, (b, h) in enumerate(pairs)], "i int, b string, h string")
    got = [r.u for r in rows.select("i", U.resolve_url("b", "h").alias("u")).orderBy("i").collect()]
    wrong = [(b, h, g, urljoin(b, h)) for (b, h), g in zip(pairs, got) if g != urljoin(b, h)]
    assert wrong == []


def test_host(column):
    urls = ["https://A.com:80/x", "http://u@b.com?q", "//c.com/d", "d.com/e", "", "HTTP://E.com#f", "ftp://f.org"]
    assert column(urls, U.host_of) == [urlparse(u).netloc.lower() for u in urls]


def test_normalize_domain(column):
    cases = {
        "site.com": "site.com", " https://site.com/path ": "site.com", "www.site.com": "site.com",
        "http://user@www.Site.com:8080/x": "Site.com", "..site.com": "site.com", "": "", "a b": "a b",
        "http://www.www.x.com": "www.x.com", "http:///only/path": "/only/path", "x.com?q=1": "x.com",
        "ftp://x.com#y": "x.com",
    }
    assert column(list(cases), U.normalize_domain) == list(cases.values())


def test_normalize_is_idempotent(column):
    once = column(["https://www.a.com:1/x", "b.org", ".c.net/"], U.normalize_domain)
    assert column(once, U.normalize_domain) == once


def test_valid_domain(column):
    cases = {"a.com": True, "a-b.co.uk": True, "a": False, "a.c": False, "1.2.3.4": False, "a.com/": False,
             "ä.com": False, "": False, None: False, "-.xx": True}
    assert column(list(cases), U.is_valid_domain) == list(cases.values())
