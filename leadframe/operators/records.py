"""Extraction records, request tables and result logs."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.embedded import first_address, json_ld, meta_content, microdata, node_texts, notes
from ..functions.html import decode_entities
from ..functions.payload import json_or_raw, payload_text, record_columns, unfence
from ..functions.text import _c, collapse_ws, is_blank, or_empty, py_strip

_SOCIAL = r"(?i)href\s*=\s*[\"'](https?://(?:[a-z0-9\-]+\.)*(?:facebook|linkedin|instagram|twitter|x|youtube|tiktok)\.com/[^\"'\s]*)"
_EMAIL_CHARS = r"a-zA-Z0-9._%+\-"
EMAIL = rf"(?<![{_EMAIL_CHARS}])[{_EMAIL_CHARS}]++@[a-zA-Z0-9.\-]+\.[a-zA-Z]{{2,}}"


def assemble_records(fetched: DataFrame, responses: DataFrame, mode: str) -> DataFrame:
    """``url, fetch_source, mode, data`` for every page that was fetched."""
    table = responses.select("url", "model_output")
    return fetched.where(F.col("source") != "").select("url", F.col("source").alias("fetch_source")) \
        .join(table, "url") \
        .select("url", "fetch_source", F.lit(mode).alias("mode"), json_or_raw("model_output").alias("data"))


def payload_to_columns(records: DataFrame, mode: str, url: str = "url", data: str = "data"
                       ) -> DataFrame:
    """Records to the fixed columns of the mode; ``data`` is a VARIANT."""
    staged = records.select(F.col(url).alias("URL"), payload_text(data).alias("_text")) \
        .select("URL", unfence("_text").alias("_body"))
    return staged.select("URL", *record_columns("_body", mode))


def fill_company_gaps(companies: DataFrame, contacts: DataFrame) -> DataFrame:
    """Blank e-mail and phone cells from what the page itself shows.

    ``contacts``: ``url`` with the columns of :func:`page_contacts`.
    """
    shown = contacts.select(F.col("url").alias("URL"), F.get("emails", F.lit(0)).alias("_email"),
                            F.get("phones", F.lit(0)).alias("_phone"))
    joined = companies.join(shown, "URL", "left")
    found = {"Email": "_email", "Phone Number": "_phone"}
    return joined.select(*[
        F.coalesce(F.nullif(F.nullif(f"`{c}`", F.lit("")), F.lit("null")), found[c], F.lit("")).alias(c)
        if c in found else F.col(f"`{c}`") for c in companies.columns])


def request_table(rows: DataFrame, template: str, key: str, **limits: int) -> DataFrame:
    """``key, part, prompt`` rows for a batch inference job.

    ``template`` names columns in braces.  A column with a limit is asked about
    in parts of at most that many characters, 0, 1, …, which together hold its
    whole text.  Missing cells count as empty; rows whose last-named column is
    blank ask for nothing.
    """
    if len(limits) > 1:
        raise ValueError("one column at most can be cut into parts")
    names = re.findall(r"\{(\w+)\}", template)
    asked = rows.where(~is_blank(names[-1]))
    long, limit = next(iter(limits.items()), (None, 0))
    last = F.greatest(F.ceil(F.length(or_empty(long)) / limit).cast("int") - 1, F.lit(0)) if long else F.lit(0)
    numbered = asked.select("*", F.explode(F.sequence(F.lit(0), last)).alias("part"))
    pieces: list[Column] = []
    for i, piece in enumerate(re.split(r"\{(\w+)\}", template)):
        if i % 2 == 0:
            pieces.append(F.lit(piece))
        else:
            pieces.append(F.substr(or_empty(piece), F.col("part") * limit + 1, F.lit(limit)) if piece == long else or_empty(piece))
    return numbered.select(key, "part", F.concat(*pieces).alias("prompt"))


def result_log(fetched: DataFrame, outputs: DataFrame | None = None, output: Column | None = None
               ) -> DataFrame:
    """``URL, fetch_source, model_output``; a failed fetch logs blanks.

    The output is a landed table ``url, model_output``, or a column of the
    fetched rows themselves.  Page bodies stay out of the join.
    """
    failed = F.coalesce("source", F.lit("")) == ""
    if "html" in fetched.columns:
        failed = failed | is_blank("html")
    failed = failed.alias("_failed")
    if output is not None:
        joined = fetched.select("url", "source", failed, output.alias("model_output"))
    else:
        joined = fetched.select("url", "source", failed).join(
            outputs.select("url", "model_output"), "url", "left")
    return joined.select(
        F.col("url").alias("URL"),
        F.when(F.col("_failed"), F.lit("")).otherwise(F.col("source")).alias("fetch_source"),
        F.when(F.col("_failed"), F.lit("")).otherwise(F.coalesce("model_output", F.lit(""))).alias("model_output"))


def _distinct_sorted(col: Column) -> Column:
    return F.array_sort(F.array_distinct(col))


def page_contacts(pages: DataFrame, html: str = "html") -> DataFrame:
    """Title, description, e-mails, phones, address, social links and notes of a page.

    Address and notes come from embedded structured data (JSON-LD, for the
    address also microdata) and are NULL without it; its telephone numbers are
    phones too.
    """
    page = _c(html)
    staged = pages.select("*", json_ld(page).alias("_nodes"), microdata(page).alias("_items"))
    digits = lambda p: F.regexp_replace(p, r"[^0-9+]", "")
    phones = F.regexp_extract_all(page, F.lit(r"(?i)href\s*=\s*[\"']tel:([^\"']+)"), F.lit(1))
    none = F.array().cast("array<string>")
    mails = F.when(page.contains("@"), F.regexp_extract_all(page, F.lit(EMAIL), F.lit(0))) \
        .when(page.isNotNull(), none)
    read = staged.select(
        *pages.columns,
        collapse_ws(F.regexp_extract(page, r"(?is)<title[^>]*>(.*?)</title", 1)).alias("title"),
        py_strip(meta_content(page, "description")).alias("description"),
        _distinct_sorted(F.transform(mails, F.lower)).alias("emails"),
        _distinct_sorted(F.transform(F.concat(phones, node_texts(F.col("_nodes"), "$.telephone")), digits)).alias("phones"),
        first_address(F.col("_nodes"), F.col("_items")).alias("address"),
        _distinct_sorted(F.regexp_extract_all(page, F.lit(_SOCIAL), F.lit(1))).alias("socials"),
        notes(F.col("_nodes")).alias("notes"),
    )
    return decode_entities(decode_entities(read, "title", "title"), "description", "description")
