"""Fields that need the tag tree: main content and company profiles.

Regexes cannot follow parents, siblings and unclosed tags, so these two read
the page with the standard library's parser inside an Arrow-batched UDF.  Each
page is one row and independent of the others; nothing is grouped.
"""

from __future__ import annotations

import sys
from html.parser import HTMLParser

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dictionaries import PROFILE_CLASSES, PROFILE_CONTACT_HEADING
from ..functions.html import HIDDEN_BLOCKS
from ..functions.text import STRIP_CHARS, _c, clean_cell

# The helpers travel with the job, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_SILENT = frozenset(("script", "style", "template"))


class _Node:
    __slots__ = ("tag", "attrs", "parent", "children")

    def __init__(self, tag, attrs=(), parent=None):
        self.tag, self.attrs, self.parent, self.children = tag, dict(attrs), parent, []

    def walk(self):
        """Elements below this one in document order, without recursion."""
        stack = [c for c in reversed(self.children) if isinstance(c, _Node)]
        while stack:
            node = stack.pop()
            yield node
            stack.extend(c for c in reversed(node.children) if isinstance(c, _Node))

    def strings(self, skip=frozenset()):
        stack = list(reversed(self.children))
        while stack:
            item = stack.pop()
            if isinstance(item, str):
                yield item
            elif item.tag not in _SILENT and item.tag not in skip:
                stack.extend(reversed(item.children))

    def text(self, separator="", strip=False, skip=frozenset()):
        parts = self.strings(skip)
        if strip:
            parts = (p for p in (s.strip(STRIP_CHARS) for s in parts) if p)
        return separator.join(parts)

    def has_class(self, name):
        return name in (self.attrs.get("class") or "").split()


class _Tree(HTMLParser):
    """Lenient tree: an end tag closes up to its nearest open start tag."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.open = _Node("")

    def handle_starttag(self, tag, attrs):
        node = _Node(tag, attrs, self.open)
        self.open.children.append(node)
        if tag not in _VOID:
            self.open = node

    def handle_startendtag(self, tag, attrs):
        self.open.children.append(_Node(tag, attrs, self.open))

    def handle_endtag(self, tag):
        node = self.open
        while node is not self.root and node.tag != tag:
            node = node.parent
        if node is not self.root:
            self.open = node.parent

    def handle_data(self, data):
        self.open.children.append(data)


def _parse(html: str) -> _Node:
    tree = _Tree()
    end = html.rfind(">") + 1  # behind the last tag a '<' can only be text
    tree.feed(html[:end] + html[end:].replace("<", ""))
    tree.close()
    return tree.root


_DROPPED = frozenset(("nav", "footer", "script", "style"))
_CONTENT = frozenset(("h1", "h2", "h3", "p", "ul"))


def _inside(node, container, tags) -> bool:
    while node is not container:
        if node.tag in tags:
            return True
        node = node.parent
    return False


def content_text(html: str | None) -> str:
    """Headings, paragraphs and lists of the first article, main or body."""
    elements = list(_parse(html or "").walk())
    container = next((n for tag in ("article", "main", "body") for n in elements if n.tag == tag), None)
    if container is None:
        return ""
    texts = [n.text(strip=True, skip=_DROPPED) for n in container.walk()
             if n.tag in _CONTENT and not _inside(n, container, _DROPPED)]
    return "\n".join(t for t in texts if t)


def profile_fields(html: str | None, classes: dict[str, str], heading: str) -> dict[str, str]:
    """Domain, phone, address, contact persons and description of a profile."""
    elements = list(_parse(html or "").walk())

    def first(tag, field, test=lambda n: True):
        return next((n for n in elements if n.tag == tag and n.has_class(classes[field]) and test(n)), None)

    out = dict.fromkeys(("domain", "phone", "address", "contact", "about"), "")
    link = first("a", "domain")
    if link is not None and link.attrs.get("href") is not None:
        out["domain"] = link.attrs["href"].replace("//", "")
    phone = first("a", "phone", lambda n: "tel:" in (n.attrs.get("href") or ""))
    if phone is not None:
        out["phone"] = phone.text()
    name = first("div", "address")
    if name is not None:
        out["address"] = name.parent.text(" ", strip=True)
    title = first("h5", "contact_heading", lambda n: n.text() == heading)
    if title is not None:
        siblings = title.parent.children
        after = siblings[next(i for i, c in enumerate(siblings) if c is title) + 1:]
        person = next((c for c in after if isinstance(c, _Node) and c.tag == "span"
                       and c.has_class(classes["contact"])), None)
        if person is not None:
            out["contact"] = person.text(", ", strip=True)
    about = first("div", "about")
    span = about and next((n for n in about.walk() if n.tag == "span"), None)
    if span is not None:
        out["about"] = span.text()
    return out


def _without_hidden(html) -> Column:
    """Page for the parser: hidden blocks shrink to an empty element, so the
    texts around them stay apart."""
    return F.regexp_replace(_c(html), HIDDEN_BLOCKS, "<wbr>")


def main_content(df: DataFrame, html: str, out: str) -> DataFrame:
    """Readable content of each page, one line per element."""

    @F.pandas_udf("string")
    def content(column: pd.Series) -> pd.Series:
        return column.map(content_text)

    return df.withColumn(out, content(_without_hidden(html)))


def extract_profiles(pages: DataFrame, url: str = "url", html: str = "html",
                     classes: dict[str, str] = PROFILE_CLASSES,
                     heading: str = PROFILE_CONTACT_HEADING, keep: tuple[str, ...] = ()) -> DataFrame:
    """Profile pages to six one-line columns behind those to ``keep``.  ``classes`` selects the fields."""

    @F.pandas_udf("domain string, phone string, address string, contact string, about string")
    def fields(column: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([profile_fields(h, classes, heading) for h in column],
                            columns=["domain", "phone", "address", "contact", "about"])

    names = (("Domain", "domain"), ("Phone", "phone"), ("Address", "address"),
             ("Contact person", "contact"), ("About", "about"))
    staged = pages.select(*keep, F.col(url).alias("_url"), fields(_without_hidden(html)).alias("_f"))
    return staged.select(*keep, clean_cell("_url").alias("Page URL"),
                         *[clean_cell(f"_f.{source}").alias(name) for name, source in names])
