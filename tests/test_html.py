"""HTML to text against the standard library's parser."""

from html.parser import HTMLParser

from leadframe.functions import html as H


class Visible(HTMLParser):
    def __init__(self, hidden):
        super().__init__(convert_charrefs=True)
        self.hidden, self.depth, self.nodes, self.new = hidden, 0, [], True

    def handle_starttag(self, tag, attrs):
        self.depth += tag in self.hidden
        self.new = True

    def handle_endtag(self, tag):
        self.depth -= tag in self.hidden
        self.new = True

    def handle_comment(self, data):
        self.new = True

    handle_decl = handle_pi = handle_comment

    def handle_data(self, data):
        if not self.depth:
            if self.new or not self.nodes:
                self.nodes.append(data)
            else:
                self.nodes[-1] += data
        self.new = False


def nodes(html, hidden):
    parser = Visible(hidden)
    parser.feed(html)
    parser.close()
    return parser.nodes


PAGES = [
    "<p>a</p><p>b</p>", "<p>a</p>\n<p> b </p>", "x<!-- c > d -->y", "a<br>b<br/>c",
    '<a title="a > b">t</a>', "<script>if (a<b) '</p>'</script>z", "<style>p{}</style> q ",
    "&lt;b&gt; &amp;lt; &#65;&#x42; caf&eacute; &nbsp;&euro;&#8217;&#150; &unknown;", "1 < 2 and 3 > 2",
    "<SCRIPT type='x'>x</SCRIPT>y", "<!DOCTYPE html><html><body>k</body></html>",
    "<p> </p><p>ü</p>", "<div><noscript>n</noscript><svg><text>s</text></svg>v</div>",
    "<textarea>keep</textarea><template><p>t</p></template>u", "<p class=x data-y='>'>w</p>",
]


def run(spark, pages, op):
    rows = spark.createDataFrame([(i, p) for i, p in enumerate(pages)], "i int, html string")
    return [r.o for r in op(rows, "html", "o").orderBy("i").collect()]


def test_flat(spark):
    expected = [" ".join(nodes(p, {"script", "style", "template"})).strip() for p in PAGES]
    assert run(spark, PAGES, H.html_to_text_flat) == expected


def test_node_lines(spark):
    hidden = {"script", "style", "template", "noscript", "svg"}
    expected = ["\n".join(s for s in (n.strip() for n in nodes(p, hidden)) if s) for p in PAGES]
    assert run(spark, PAGES, H.html_to_node_lines) == expected


def test_given_pages(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/pages.parquet")
    flat = H.html_to_text_flat(rows, "html", "o").select("html", "o").collect()
    for r in flat:
        assert r.o == " ".join(nodes(r.html, {"script", "style", "template"})).strip()


def test_unclosed_elements_end_with_the_page(spark):
    assert run(spark, ["a<script>b", "a<!-- b", "a <style>p"], H.html_to_text_flat) == ["a", "a", "a"]


def test_many_adjacent_tags_and_long_attributes(spark):
    page = "<b>" * 50_000 + "x" + "</b>" * 50_000 + '<img src="data:' + "A" * 300_000 + '">y'
    assert run(spark, [page], H.html_to_text_flat) == ["x y"]


def test_unclosed_tags_are_scanned_once(spark):
    assert run(spark, ["<a " * 300_000 + "x"], H.html_to_text_flat)[0].endswith("x")


def test_lines_with_consent_cut(spark):
    page = "<p>We use cookies</p>" + "".join(f"<p>l{i}</p>" for i in range(60))
    out = run(spark, [page], H.html_to_text_lines)[0]
    assert out.split("\n")[0] == "l49" and out.endswith("l59")
    assert run(spark, ["<p>cookie</p><p>short</p>"], H.html_to_text_lines) == [""]


def test_references_like_the_standard_library(spark):
    from html import unescape

    texts = ["&copy 2020", "caf&eacute &eacutex", "&check;&comma;&fjlig;", "&#00000065;&#x0041;&#65 &#x41g", "&notit; &notin;", "&amp;lt; &ampamp;",
             "&#128;&#150;&#0;&#xD800;&#x110000;&#99999999999999;", "&#1;&#11;&#xFDD0;&#xFFFF;&#127;", "& &; &x; &#; &#x; &unknown; a&b", "&AMP;&LT&GT;", "&&amp;&"]
    df = H.decode_entities(spark.createDataFrame(list(enumerate(texts)), "i int, t string"), "t", "out")
    assert [r.out for r in df.orderBy("i").collect()] == [unescape(t) for t in texts]
