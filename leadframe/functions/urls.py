"""Domain and URL helpers as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import _c, py_strip

# Fixed value: the accepted shape of a domain.
DOMAIN_SHAPE = r"^[a-zA-Z0-9\-\.]+\.[a-zA-Z]{2,}$"
_SCHEME = r"^[a-zA-Z][a-zA-Z0-9+.\-]*:"


def is_valid_domain(col) -> Column:
    return F.coalesce(_c(col).rlike(DOMAIN_SHAPE), F.lit(False))


def host_of(url) -> Column:
    """Lower-cased authority including port and user-info, '' if there is none."""
    return F.lower(F.regexp_extract(_c(url), r"^(?:[a-zA-Z][a-zA-Z0-9+.\-]*:)?//([^/?#]*)", 1))


def normalize_domain(raw) -> Column:
    """Bare host of a domain-or-URL cell: no scheme, path, user, port or www."""
    text = py_strip(_c(raw))
    # what follows "scheme://", or the cell itself when there is no scheme
    tail = F.regexp_replace(text, r"^.*?://", "")
    authority = F.regexp_extract(tail, r"^([^/?#]*)", 1)
    path = F.regexp_extract(tail, r"^([^?#]*)", 1)
    host = F.coalesce(F.nullif(authority, F.lit("")), path)
    host = F.substring_index(F.regexp_replace(host, r"^.*@", ""), ":", 1)
    host = F.ltrim(py_strip(host), F.lit("."))
    return F.regexp_replace(host, r"^www\.", "")


def build_url(domain, scheme: str = "https") -> Column:
    return F.concat(F.lit(f"{scheme}://"), _c(domain))


def _merge_dots(path: Column) -> Column:
    """RFC 3986 dot-segment removal over the '/'-separated segments."""
    segments = F.split(path, "/")

    def step(acc: Column, segment: Column) -> Column:
        parent = F.when(F.size(acc) > 1, F.slice(acc, F.lit(1), F.size(acc) - 1)).otherwise(acc)
        return (
            F.when(segment == "..", parent)
            .when(segment == ".", acc)
            .otherwise(F.array_append(acc, segment))
        )

    merged = F.aggregate(segments, F.array().cast("array<string>"), step)
    trailing = F.when(path.rlike(r"/\.\.?$"), F.lit("/")).otherwise(F.lit(""))
    return F.concat(F.array_join(merged, "/"), trailing)


def base_parts(base) -> Column:
    """What resolving needs to know about a base URL, as one struct."""
    base = _c(base)
    path = F.regexp_extract(base, r"^[a-zA-Z][a-zA-Z0-9+.\-]*://[^/?#]*([^?#]*)", 1)
    return F.struct(
        base.alias("url"),
        F.regexp_extract(base, r"^([a-zA-Z][a-zA-Z0-9+.\-]*:)", 1).alias("scheme"),
        F.regexp_extract(base, r"^([a-zA-Z][a-zA-Z0-9+.\-]*://[^/?#]*)", 1).alias("site"),
        path.alias("path"),
        F.regexp_extract(base, r"^[^?#]*(\?[^#]*)", 1).alias("query"),
        F.coalesce(F.nullif(F.regexp_extract(path, r"^(.*/)", 1), F.lit("")), F.lit("/")).alias("folder"),
    )


def clean_href(href) -> Column:
    """A browser ignores tabs and newlines in a link and blanks before it."""
    return F.ltrim(F.translate(_c(href), "\t\r\n", ""))


def resolve_href(parts: Column, href: Column) -> Column:
    """Join a cleaned href with the :func:`base_parts` of its page."""
    href_path = F.regexp_extract(href, r"^([^?#]*)", 1)
    href_tail = F.regexp_extract(href, r"^[^?#]*(.*)$", 1)
    relative = F.regexp_replace(F.concat(parts["folder"], href_path), "/+", "/")
    full_path = F.when(href.startswith("/"), href_path).otherwise(relative)
    has_dots = parts["folder"].contains("./") | href.contains("./") | href.rlike(r"(?:^|/)\.\.?(?:[/?#]|$)")
    path = F.when(has_dots, _merge_dots(full_path)).otherwise(full_path)
    return (
        F.when(href == "", parts["url"])
        .when(href.rlike(_SCHEME), href)
        .when(href.startswith("//"), F.concat(parts["scheme"], href))
        .when(href.startswith("?"), F.concat(parts["site"], parts["path"], href))
        .when(href.startswith("#"), F.concat(parts["site"], parts["path"], parts["query"], href))
        .otherwise(F.concat(parts["site"], path, href_tail))
    )


def resolve_url(base, href) -> Column:
    """``urljoin`` for http(s) bases; fragments stay, dot segments merge."""
    return resolve_href(base_parts(base), clean_href(href))


# Attributes before href: quoted values are kept whole, so they may hold '>' or 'href='.
_BEFORE = r"""(?:(?:(?!href\s*=)[^\s=<>"'/]++(?:\s*+=\s*+(?:"[^"]*"|'[^']*'|[^\s"'<>]++))?+|["'=])[\s/]*+)*+"""
_VALUE = r"""(?:"[^"]+"|'[^']+'|[^\s"'>]+)"""
# An anchor's href with its quotes; bare values are allowed as well.
HREF = rf"(?is)<a[\s/]++{_BEFORE}href\s*=\s*({_VALUE})"
TAG = r"""(?s)<(?:[^<>"']++|"[^"]*"|'[^']*')*+>"""
ANCHOR = rf"""(?is)<a[\s/]++{_BEFORE}href\s*=\s*{_VALUE}(?:[^<>"']++|"[^"]*"|'[^']*')*+>.*?(?:</a\s*>|\z)"""


def unquote(value) -> Column:
    return F.regexp_replace(_c(value), r"""^["']|["']$""", "")
