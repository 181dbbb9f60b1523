import time

import pytest

from leadframe.llm.html_render import extract, render


@pytest.mark.parametrize("page, text", [
    ("<p>one<p>two<br>three", "one\n\ntwo\nthree"),
    ("<html><head><title>no</title><body>yes", "yes"),
    ("text <b>in</b> <i>line</i>\n  more", "text in line more"),
    ("<div>a</div><div>b</div>", "a\nb"),
    ("<ul><li>one<li>two<ul><li>deep</ul><li>three</ul>", "- one\n- two\n  - deep\n- three"),
    ("<ol start=3><li>x</li><li>y</ol>z", "3. x\n4. y\n\nz"),
    ("<table><tr><th>name<th>n<tr><td>apples<td>3<tr><td>figs<td>12</table>", "name    n\napples  3\nfigs    12"),
    ("<table><caption>c<tr><td>a<br>b<td>c<tr><td>longer</table>end", "c\n\na  c\nb\nlonger\n\nend"),
    ("<p>a<div hidden>b</div><span style='display : none'>c</span><i aria-hidden=true>d</i>e", "a\n\ne"),
    ("<script>if (a</b>c) {}</script><style>p{}</style>x<!-- y > --> z", "x z"),
    ("<pre>\n  a\n    b\n</pre>c", "  a\n    b\n\nc"),
    ("a &lt; b &amp;c &eacute; &#233; &copy", "a < b &c é é ©"),
    ("<a title=\"x > y\" href='/z'>link</a>", "link"),
    ("<dl><dt>t<dd>d<dt>u<dd>e</dl>", "t\nd\nu\ne"),
    ("1 < 2 and <3", "1 < 2 and <3"),
    ("never <b closed", "never <b closed"),
    ("<select><option>a<option>b</select><textarea>t</textarea>x", "x"),
    ("", ""), (None, None),
])
def test_render(page, text):
    assert render(page) == text


@pytest.mark.parametrize("part", ["<", "<a ", "<div>", "<table><tr><td>", "<p a=\"", "<!--", "<script>", "</p>", "<li>", "<a b='", "&", "<ul><li>"])
def test_odd_pages_take_linear_time(part):
    began = time.process_time()
    render(part * 5_000 + "end")
    assert time.process_time() - began < 5


def test_no_visible_text_is_lost(spark, sf_dir):
    """Letters of every page, as the standard parser sees them outside hidden elements."""
    from html.parser import HTMLParser

    class Plain(HTMLParser):
        out, off = "", 0

        def handle_starttag(self, tag, attrs):
            self.off += tag in ("head", "script", "style")

        def handle_endtag(self, tag):
            self.off -= tag in ("head", "script", "style")

        def handle_data(self, data):
            self.out += "" if self.off else data

    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    html = {r.page_id: r.html for r in pages.collect()}
    rows = extract(pages).collect()
    assert len(rows) == len(html)
    for r in rows:
        plain = Plain()
        plain.feed(html[r.page_id])
        squeeze = lambda s: "".join(c for c in s if c.isalnum())
        assert squeeze(r.text) == squeeze(plain.out)
        assert r.n_lines == (r.text.count("\n") + 1 if r.text else 0)


def test_odd_rows(spark):
    schema = "page_id bigint, url string, html string, text string, n_lines int"
    rows = [(1, None, None, "t", 0), (None, "u", "<p>x", "t", 0), (2, "u", "", None, 0), (2, "u", "", None, 0), (3, "u", "<b>" * 100_000 + "y", "", 0)]
    got = extract(spark.createDataFrame(rows, schema)).collect()
    assert sorted((tuple(r) for r in got), key=str) == sorted([(1, None, 0), (None, "x", 1), (2, "", 0), (2, "", 0), (3, "y", 1)], key=str)
    assert extract(spark.createDataFrame([], schema)).collect() == []


@pytest.mark.parametrize("depth", [10, 300, 20_000])
def test_hidden_at_any_depth(depth):
    page = "<div>" * depth + "<div style='display:none'>secret</div><p>seen" + "</div>" * depth + "end"
    assert render(page).split() == ["seen", "end"]


def test_spanning_cells():
    page = ("<table><tr><th>a<th colspan=2>both<th>d<tr><td rowspan='2'>tall<td>b1<td>c1<td>d1<tr><td>b22<td>c2<td>d2"
            "<tr><td>" + "x" * 70 + "<td>b<td>c<td>d</table>")
    lines = render(page).strip().split("\n")
    at = [lines[1].index(w) for w in ("tall", "b1", "c1", "d1")]
    assert [lines[2].index(w) for w in ("b22", "c2", "d2")] == at[1:] and lines[0].index("both") == at[1] and lines[0].index("d") == at[3]
    assert lines[3].split() == ["x" * 70, "b", "c", "d"]
