"""Links and breadth-first discovery over landed pages."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dictionaries as d
from ..functions.html import HIDDEN_BLOCKS, decode_entities
from ..functions.text import _c, _literal
from ..functions.urls import ANCHOR, HREF, TAG, base_parts, clean_href, host_of, resolve_href, unquote
from ..session import materialize
from .fetch import THREE_STAGES, first_settled_facts
from .joins import might_be_in
from .profile import main_content
from .records import page_contacts


def page_links(pages: DataFrame, url: str = "url", html: str = "html",
               keep: tuple[str, ...] = ()) -> DataFrame:
    """``src, dst`` for every link of a page, once per page and target.

    Links are decoded, resolved and made distinct inside the page's own row, so
    the step needs no shuffle.
    """
    hrefs = F.transform(F.regexp_extract_all("_visible", F.lit(HREF), F.lit(1)),
                        lambda x: clean_href(unquote(x)))
    listed = (
        pages.select(*keep, F.col(url).alias("src"),
                     F.regexp_replace(html, HIDDEN_BLOCKS, "").alias("_visible"))
        .withColumn("_hrefs", F.array_join(hrefs, "\n"))
        .withColumn("_base", base_parts("src"))
        .drop("_visible")
    )
    decoded = decode_entities(listed, "_hrefs", "_hrefs")
    targets = F.transform(F.filter(F.split("_hrefs", "\n"), lambda h: h != ""),
                          lambda h: resolve_href(F.col("_base"), h))
    return decoded.select(*keep, "src", F.explode(F.array_distinct(targets)).alias("dst"))


def pattern_links(html, pattern: str) -> Column:
    """Distinct matches of a link pattern anywhere in the markup."""
    return F.array_distinct(F.regexp_extract_all(_c(html), F.lit(pattern), F.lit(0)))


def _anchor_list(html) -> Column:
    """Anchors of a page in document order: raw target and link text."""

    def anchor(markup: Column) -> Column:
        return F.struct(unquote(F.regexp_extract(markup, HREF, 1)).alias("href"),
                        F.regexp_replace(markup, TAG, "").alias("text"))

    visible = F.regexp_replace(_c(html), HIDDEN_BLOCKS, "")
    return F.transform(F.regexp_extract_all(visible, F.lit(ANCHOR), F.lit(0)), anchor)


def anchors(pages: DataFrame, key: str, html: str = "html") -> DataFrame:
    """``key, pos, href, text`` for every link, in document order."""
    rows = pages.select(key, F.posexplode(_anchor_list(html)).alias("pos", "a"))
    decoded = decode_entities(rows.select(key, "pos", F.col("a.href").alias("href"),
                                          F.col("a.text").alias("text")), "href", "href")
    return decode_entities(decoded, "text", "text")


def about_link(pages: DataFrame, url: str, html: str, out: str = "about_url") -> DataFrame:
    """First link that looks like an about page, NULL when there is none.

    Keywords are looked for in the lower-cased target and link text; links to
    the two excluded networks are skipped.
    """
    words = "|".join(_literal(w) for w in d.ABOUT_WORDS)
    told = F.transform(_anchor_list(html), lambda a: F.concat(clean_href(a["href"]), F.lit("\x02"), a["text"]))
    staged = decode_entities(pages.withColumn("_base", base_parts(url)).withColumn("_anchors", F.array_join(told, "\x01")),
                             "_anchors", "_anchors")
    seen = F.filter(F.split("_anchors", "\x01"), lambda a: F.lower(a).rlike(words))
    targets = F.transform(seen, lambda a: resolve_href(F.col("_base"), F.substring_index(a, "\x02", 1)))
    allowed = F.filter(targets, lambda u: ~u.rlike("|".join(d.ABOUT_EXCLUDED)))
    return staged.withColumn(out, F.get(allowed, F.lit(0))).drop("_anchors", "_base")


def about_descriptions(homepages: DataFrame, pages: DataFrame, key: str, url: str = "url",
                       html: str = "html") -> DataFrame:
    """Main text of each site's about page, or of its homepage without one.

    Pages that may be wanted are picked where they are read, by a Bloom filter
    of the wanted addresses, and only their text is joined: no page is moved.
    """
    wanted = materialize(about_link(homepages, url, html).select(
        key, F.coalesce("about_url", url).alias("target")), "about")
    near = pages.where(might_be_in([url], wanted, ["target"])).select(F.col(url).alias("target"), html)
    texts = main_content(near, html, "description").select("target", "description")
    return wanted.join(texts, "target", "left").select(
        key, "target", F.coalesce("description", F.lit("")).alias("description"))


def crawl_bfs(edges: DataFrame, starts: DataFrame, max_depth: int = 1) -> DataFrame:
    """All same-host links of the pages up to ``max_depth`` clicks from a start.

    ``edges``: ``src, dst``; ``starts``: ``start``.  Many sites are crawled at
    once; the result is ``start, url, depth`` with the depth of the page on
    which the link was first seen.

    Off-host edges are dropped before the loop.  Each level is one join of the
    frontier with the edges on the page URL, so a large site is spread over the
    cluster, and one anti join against the links already collected.  Every
    level is written to the shared folder: the plan stays short, a lost
    executor costs one level at most, and a frontier of known small size is
    joined without moving the edges.
    """
    inner = edges.where(host_of("src") == host_of("dst")).select("src", "dst")
    if max_depth > 0:
        inner = materialize(inner, "edges")  # pages are parsed once, not once per level
    frontier = starts.select("start", F.col("start").alias("url")).distinct()
    collected, expanded = None, frontier
    for depth in range(max_depth + 1):
        found = (
            frontier.join(inner, F.col("url") == F.col("src"))
            .select("start", F.col("dst").alias("url")).distinct()
        )
        if collected is not None:
            found = found.join(collected.select("start", "url"), ["start", "url"], "left_anti")
        found = materialize(found.withColumn("depth", F.lit(depth)), "level")
        collected = found if collected is None else collected.unionAll(found)
        if depth == max_depth or found.isEmpty():
            break
        # the start page itself may be linked; it was expanded at depth 0
        frontier = found.select("start", "url").where(F.col("start") != F.col("url"))
    return collected


def listing_profiles(pages: DataFrame, listing: DataFrame, pattern: str, html: str = "html", url: str = "url",
                     read: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Listing pages -> distinct profile links -> landed profile pages.

    ``read`` makes small rows of pages, row by row, and keeps their address; it
    runs where pages are read, on those that may be wanted, and only what it
    returns is joined.  Without it the wanted pages themselves are.
    """
    links = materialize(listing.select(F.explode(pattern_links(html, pattern)).alias(url)).distinct(), "links")
    near = pages.where(might_be_in([url], links, [url]))
    return (read(near) if read else near).join(links, url, "left_semi")


def discover(attempts: DataFrame, starts: DataFrame, match: str, max_depth: int = 1, stages=THREE_STAGES) -> DataFrame:
    """``URL, fetch_source`` and the contact fields of all pages found from the starts whose address holds ``match``.

    ``attempts``: ``url, source, html``.  A page is what the first source that
    brought text says; its links are followed on the same host, ``max_depth``
    clicks deep.  Which attempt counts is settled on narrow facts, and links and
    contact fields are read in the row of the body, so that bodies never move.
    A page that no source brought has empty fields.
    """
    tried = attempts.withColumn("_pick", F.xxhash64("html"))
    chosen = materialize(first_settled_facts(tried, stages, key="url", payload=("_pick",)).where("source <> ''")
                         .select("url", "source", "_pick"), "chosen")
    one = ["url", "source", "_pick"]
    links = page_links(tried, keep=("source", "_pick")).join(chosen.withColumnRenamed("url", "src"), ["src", "source", "_pick"], "left_semi")
    found = crawl_bfs(links.select("src", "dst"), starts, max_depth)
    matched = found.where(F.col("url").contains(match)).select("url").distinct()
    wanted = materialize(matched.join(chosen, "url", "left"), "wanted")
    fields = ("title", "description", "emails", "phones", "address", "socials", "notes")
    near = page_contacts(tried.where(might_be_in(one, wanted, one))).select(*one, *fields).dropDuplicates(one)
    lists = ("emails", "phones", "socials")
    return wanted.join(near, one, "left").select(
        F.col("url").alias("URL"), F.coalesce("source", F.lit("")).alias("fetch_source"),
        *[F.coalesce(F.array_join(f, "; ") if f in lists else F.col(f), F.lit("")).alias(f) for f in fields])


def crawl_summary(edges: DataFrame, key: str) -> DataFrame:
    """One row of counters: links, matched, distinct matched, pages."""
    matched = F.col("dst").contains(key)
    return edges.agg(
        F.count("*").alias("links"),
        F.count_if(matched).alias("matched_links"),
        F.count_distinct(F.when(matched, F.col("dst"))).alias("distinct_links"),
        F.count_distinct("src").alias("pages"),
    )
