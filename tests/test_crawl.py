"""Discovery against a plain queue, and links against the standard parser."""

import random
from collections import deque
from html.parser import HTMLParser
from urllib.parse import urljoin, urlparse

import pytest

from leadframe.operators import crawl


def queue_crawl(edges, start, max_depth):
    """Pages reached within the depth, first come first served."""
    links = {}
    for src, dst in edges:
        links.setdefault(src, []).append(dst)
    host, seen, found = urlparse(start).netloc, set(), set()
    queue = deque([(start, 0)])
    while queue:
        url, depth = queue.popleft()
        if url in seen:
            continue
        seen.add(url)
        for dst in links.get(url, []):
            if urlparse(dst).netloc == host:
                found.add(dst)
                if depth < max_depth:
                    queue.append((dst, depth + 1))
    return found


@pytest.mark.parametrize("depth", [0, 1, 2, 4])
def test_bfs(spark, depth):
    rng = random.Random(depth)
    urls = [f"https://h{i % 3}.com/{i}" for i in range(60)]
    edges = [(rng.choice(urls), rng.choice(urls)) for _ in range(160)]
    edges += [(urls[0], urls[3]), (urls[3], urls[0]), (urls[1], urls[1])]
    edge_rows = spark.createDataFrame(edges, "src string, dst string")
    starts = spark.createDataFrame([(u,) for u in urls[:3]] + [("https://none.com/",)], "start string")
    got = {}
    for r in crawl.crawl_bfs(edge_rows, starts, depth).collect():
        assert r.url not in got.setdefault(r.start, set())
        got[r.start].add(r.url)
    for start in urls[:3]:
        assert got.get(start, set()) == queue_crawl(edges, start, depth)


def test_bfs_grows_with_depth(spark):
    edges = spark.createDataFrame([(f"http://a/{i}", f"http://a/{i + 1}") for i in range(6)], "src string, dst string")
    start = spark.createDataFrame([("http://a/0",)], "start string")
    sizes = [crawl.crawl_bfs(edges, start, n).count() for n in range(4)]
    assert sizes == [1, 2, 3, 4]


def test_bfs_with_a_hub(spark):
    """One page links to, and is linked from, most of the site."""
    hub = "http://a/hub"
    edges = [(hub, f"http://a/{i}") for i in range(5000)] + [(f"http://a/{i}", hub) for i in range(5000)]
    rows = spark.createDataFrame(edges, "src string, dst string")
    got = crawl.crawl_bfs(rows, spark.createDataFrame([(hub,)], "start string"), 2)
    assert got.count() == 5001


class Links(HTMLParser):
    def __init__(self):
        super().__init__()
        self.hrefs = []

    def handle_starttag(self, tag, attrs):
        href = dict(attrs).get("href")
        if tag == "a" and href:
            self.hrefs.append(href)


def test_links_of_given_pages(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/pages.parquet")
    got = {}
    for r in crawl.page_links(rows).collect():
        got.setdefault(r.src, []).append(r.dst)
    for r in rows.collect():
        parser = Links()
        parser.feed(r.html)
        assert sorted(got.get(r.url, [])) == sorted({urljoin(r.url, h) for h in parser.hrefs})


def test_links_edge_cases(spark):
    html = ("<a href='/a'>1</a><A class=x HREF = \"b?x=1&amp;y=2\">2</A><a href=c>3</a><a name=n>4</a><a href=''>5</a>"
            "<!-- <a href='/no'>x</a> --><script>'<a href=\"/no\">'</script><abbr href='/no'>x</abbr><a\nhref='#f'>6</a>"
            "<a data-href='/no'>7</a><a href='/a'>8</a>")
    rows = spark.createDataFrame([("https://h.com/d/e?q", html), ("https://n.com/", None)], "url string, html string")
    got = sorted(r.dst for r in crawl.page_links(rows).collect())
    assert got == ["https://h.com/a", "https://h.com/d/b?x=1&y=2", "https://h.com/d/c", "https://h.com/d/e?q#f"]


def test_links_of_unclosed_tags(spark):
    rows = spark.createDataFrame([("https://h.com/", "<a " * 100_000 + "<a href=x>")], "url string, html string")
    assert [r.dst for r in crawl.page_links(rows).collect()] == ["https://h.com/x"]
    assert crawl.about_link(rows, "url", "html").first().about_url is None


def test_about_link(spark):
    cases = [
        ("<a href='/x'>About us</a>", "https://a.com/x"), ("<a href='/O-NAS'>x</a>", "https://a.com/O-NAS"),
        ("<a href='https://facebook.com/about'>f</a><a href='/team'>t</a>", "https://a.com/team"),
        ("<a href='/y'>contact</a>", None), ("<a href='/1'>our <b>mission</b></a><a href='/about'>2</a>", "https://a.com/1"),
        (None, None)]
    rows = spark.createDataFrame([(i, "https://a.com", h) for i, (h, _) in enumerate(cases)], "i int, url string, html string")
    got = crawl.about_link(rows, "url", "html").orderBy("i").collect()
    assert [r.about_url for r in got] == [want for _, want in cases]


def test_summary(spark):
    rows = spark.createDataFrame([("p", "/k/1"), ("p", "/z"), ("q", "/k/1")], "src string, dst string")
    got = crawl.crawl_summary(rows, "/k/").first()
    assert (got.links, got.matched_links, got.distinct_links, got.pages) == (3, 2, 1, 2)


def test_links_behind_odd_attributes(spark):
    html = """<a title="a > b" href="/x">X</a><a data-href="/no" title='href="/no"' href='/y'>Y</a><a class=c\nhref=/z>Z</a>
        <a "stray" href="/s">S</a><a title="href=/q">none</a><abbr href="/no">no</abbr>"""
    pages = spark.createDataFrame([("http://h.de/", html)], "url string, html string")
    assert [r.dst for r in crawl.page_links(pages).collect()] == ["http://h.de/x", "http://h.de/y", "http://h.de/z", "http://h.de/s"]
    assert [(r.href, r.text) for r in crawl.anchors(pages, "url").orderBy("pos").collect()] == \
        [("/x", "X"), ("/y", "Y"), ("/z", "Z"), ("/s", "S")]
