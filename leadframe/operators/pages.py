"""Page text: keyword votes, closed labels, categories."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dictionaries as d
from ..functions.html import (
    CONSENT_MARKERS, CONSENT_MARKERS_RAW, CONSENT_MARKERS_SHORT, html_to_text_flat, html_to_text_lines)
from ..functions.payload import unwrap_closed_label
from ..functions.rules import any_match, count_matches, found_literals, matched_names, matches
from ..functions.text import (
    _c, _literal, drop_head_if_marked, is_blank, nonblank_lines, or_empty, py_strip)
from ..functions.urls import build_url, is_valid_domain, normalize_domain
from .fetch import answered, first_settled_facts
from .joins import lookup, spread_key

E_COMMERCE_WORD = r"\b(e[\s\-]?commerce|commerce)\b"


def _searched(df: DataFrame, text: str, *dictionaries) -> tuple[DataFrame, Column]:
    """The lower-cased text and the dictionary words that occur in it."""
    low = df.withColumn("_low", F.lower(or_empty(text))) \
        .withColumn("_found", found_literals("_low", *dictionaries))
    return low, F.col("_found")


def with_votes(df: DataFrame, text: str, dictionary=d.EXHIBITOR_KEYWORDS) -> DataFrame:
    """Vote counters of a text: any strong yes, maybe count, strong no count."""
    sides = {side: dictionary[side] for side in ("strong_yes", "maybe", "strong_no")}
    low, found = _searched(df, text, *sides.values())
    return low.select(
        *df.columns,
        any_match("_low", sides["strong_yes"], found).alias("strong_yes"),
        count_matches("_low", sides["maybe"], found).alias("maybe_hits"),
        count_matches("_low", sides["strong_no"], found).alias("no_hits"),
    )


def exhibitor_label(domain, blank: Column) -> tuple[Column, Column]:
    """Label and vote summary from the counters of :func:`with_votes`."""
    few_no = F.coalesce(F.col("no_hits"), F.lit(0)) < 2
    label = (
        F.when(~is_valid_domain(domain), F.lit("Invalid domain"))
        .when(F.col("strong_yes") & few_no, F.lit("Yes"))
        .when((F.col("maybe_hits") >= 3) & few_no, F.lit("Maybe"))
        .when(blank, F.lit("No content"))
        .otherwise(F.lit("No"))
    )
    stats = F.concat(
        F.lit("Yes: "), F.initcap(F.coalesce("strong_yes", F.lit(False)).cast("string")),
        F.lit(" Maybe: "), F.coalesce("maybe_hits", F.lit(0)).cast("string"),
        F.lit(" No: "), F.coalesce("no_hits", F.lit(0)).cast("string"),
    )
    return label.alias("label"), stats.alias("stats")


def classify_exhibitor(df: DataFrame, domain: str, text: str,
                       dictionary=d.EXHIBITOR_KEYWORDS) -> DataFrame:
    """Yes / Maybe / No / No content / Invalid domain, with a vote summary.

    Invalid domains are settled before any text is searched.
    """
    usable = df.withColumn("_vote_text", F.when(is_valid_domain(domain) & ~is_blank(text), F.col(text)))
    voted = with_votes(usable, "_vote_text", dictionary)
    return voted.select(*df.columns, *exhibitor_label(domain, is_blank("_vote_text")))


def _domain_cells(domains: DataFrame, raw: str, normalize: bool) -> DataFrame:
    """Stripped non-blank cells, as bare domains if asked for, with the URL of the valid ones."""
    cells = domains.where(~is_blank(raw)).withColumn("domain", normalize_domain(raw) if normalize else py_strip(raw))
    return cells.withColumn("_url", F.when(is_valid_domain("domain"), build_url("domain")))


def _attach(cells: DataFrame, facts: DataFrame, row_id: str) -> DataFrame:
    values = [c for c in facts.columns if c != "url"]
    key = spread_key(F.col("_url").isNotNull(), F.col("_url"), F.col(row_id))
    return lookup(cells, facts, key, "url", values, row_id)


def _attempt_texts(attempts: DataFrame, as_lines: tuple[str, ...] = (),
                   markers=CONSENT_MARKERS_SHORT, keep_flat: bool = False) -> DataFrame:
    """Clean text of every attempt in ``_text``, with ``keep_flat`` its uncleaned lines in ``_raw_lines``.

    Sources named in ``as_lines`` deliver raw pages: hidden elements and a
    consent banner are cut from those as well.
    """
    raw = F.col("source").isin(*as_lines) if as_lines else F.lit(False)
    flat = html_to_text_flat(attempts.withColumn("_page", F.when(~raw, F.col("html"))), "_page", "_flat")
    if keep_flat:
        flat = flat.withColumn("_raw_lines", F.col("_flat"))
    if not as_lines:
        return flat.withColumn("_text", nonblank_lines("_flat")).drop("_page", "_flat")
    both = html_to_text_lines(flat.withColumn("_page", F.when(raw, F.col("html"))), "_page", "_lines",
                              markers=markers)
    return both.withColumn("_text", F.coalesce(nonblank_lines("_flat"), "_lines")) \
        .drop("_page", "_flat", "_lines")


def exhibitor_domains(domains: DataFrame, attempts: DataFrame, raw: str = "raw",
                      row_id: str = "row_idx", dictionary=d.EXHIBITOR_KEYWORDS, normalize: bool = False) -> DataFrame:
    """Domain cells to exhibitor labels, from landed fetch attempts.

    A cell must hold a bare domain; ``normalize`` takes it out of a URL first.

    The first source that brought any text counts.  Every page becomes its vote
    counters where it is read; choosing the attempt and joining the domains
    then moves a few numbers per page.
    """
    votes = with_votes(_attempt_texts(attempts, ("brightdata",)), "_text", dictionary) \
        .withColumn("blank", is_blank("_text"))
    facts = ("strong_yes", "maybe_hits", "no_hits", "blank")
    settled = answered() & ~F.col("blank")
    chosen = first_settled_facts(votes, settled=settled, payload=facts).drop("source")
    joined = _attach(_domain_cells(domains, raw, normalize), chosen, row_id)
    return joined.select(row_id, "domain",
                         *exhibitor_label("domain", F.coalesce("blank", F.lit(True))))


def ecommerce_domains(domains: DataFrame, attempts: DataFrame, raw: str = "raw",
                      row_id: str = "row_idx", stages=("requests", "selenium"), normalize: bool = False,
                      error: str | None = None) -> DataFrame:
    """Domain cells to Yes / No / No content / Invalid domain / Error.

    An answered page without text is final; only failed requests fall through.
    ``error`` names a column of the attempts with what broke a fetch; a domain
    that no attempt settled is an Error if one of them broke, else without content.
    """
    facts = _attempt_texts(attempts).select(
        "url", "source", "status", "html", is_blank("_text").alias("blank"),
        matches("_text", E_COMMERCE_WORD).alias("hit"))
    chosen = first_settled_facts(facts, stages, answered(), payload=("blank", "hit")).drop("source")
    if error:
        broken = attempts.where(F.col("source").isin(*stages) & ~is_blank(error)).select("url", F.lit(True).alias("broken")).distinct()
        chosen = chosen.join(broken, "url", "left")
    else:
        chosen = chosen.withColumn("broken", F.lit(None).cast("boolean"))
    joined = _attach(_domain_cells(domains, raw, normalize), chosen, row_id)
    label = (
        F.when(~is_valid_domain("domain"), F.lit("Invalid domain"))
        .when(F.col("blank").isNull() & F.col("broken"), F.lit("Error"))
        .when(F.coalesce("blank", F.lit(True)), F.lit("No content"))
        .when(F.col("hit"), F.lit("Yes"))
        .otherwise(F.lit("No"))
    )
    return joined.select(row_id, "domain", label.alias("label"))


def classify_ecommerce(df: DataFrame, domain: str, text: str) -> DataFrame:
    """Does the page speak of commerce at all?"""
    label = (
        F.when(~is_valid_domain(domain), F.lit("Invalid domain"))
        .when(is_blank(text), F.lit("No content"))
        .when(matches(text, E_COMMERCE_WORD), F.lit("Yes"))
        .otherwise(F.lit("No"))
    )
    return df.withColumn("label", label)


def _shop_evidence(df: DataFrame, text: str) -> DataFrame:
    sides = {"shop_strong": d.SHOP_STRONG, "shop_soft": d.SHOP_SOFT,
             "sp_strong": d.PROVIDER_STRONG, "sp_soft": d.PROVIDER_SOFT}
    low, found = _searched(df, text, *sides.values())
    return low.select(*df.columns, *[
        count_matches("_low", patterns, found).alias(name) for name, patterns in sides.items()])


def classify_shop_sp(df: DataFrame, text: str) -> DataFrame:
    """Shop or Service Provider from strong and soft evidence.

    A real order flow makes a shop, unless the page also offers software for
    shops: that is a demo store of a platform.  Without decisive evidence the
    soft signals tip the balance.
    """
    voted = _shop_evidence(df, text)
    demo = matches(text, d.PROVIDER_STRONG["software"])
    shop, provider = F.lit(d.SHOP_LABELS[0]), F.lit(d.SHOP_LABELS[1])
    label = (
        F.when(is_blank(text), F.lit("Unscrapable"))
        .when((F.col("shop_strong") > 0) & demo, provider)
        .when((F.col("shop_strong") > 0) & (F.col("shop_strong") >= F.col("sp_strong")), shop)
        .when(F.col("sp_strong") > 0, provider)
        .when(F.col("shop_soft") > F.col("sp_soft"), shop)
        .when(F.col("sp_soft") > F.col("shop_soft"), provider)
        .otherwise(F.lit("Unclear"))
    )
    return voted.withColumn("label", label)


def shop_categories(df: DataFrame, text: str, out: str = "categories") -> DataFrame:
    """Names of the shop categories whose words occur, in dictionary order."""
    low, found = _searched(df, text, d.SHOP_CATEGORIES)
    return low.select(*df.columns, matched_names("_low", d.SHOP_CATEGORIES, found).alias(out))


def label_domains(domains: DataFrame, attempts: DataFrame, responses: DataFrame, labels=d.SHOP_LABELS,
                  strict: bool = True, raw: str = "raw", row_id: str = "row_idx",
                  stages=("requests", "selenium"), as_lines: tuple[str, ...] = (), normalize: bool | None = None
                  ) -> DataFrame:
    """Domain cells to landed model labels, ``Unscrapable`` where no text was had.

    An invalid domain, an error status, a bot wall on the first request and an
    empty page are all unscrapable; an answered empty page is retried by the
    next stage.  ``responses`` has one ``row_idx, model_output`` row per cell.
    With ``stages=as_lines=("brightdata",)`` one raw fetcher is the only stage;
    only then are cells normalized, unless ``normalize`` says otherwise.

    A consent notice costs a page its first 30 raw lines; the pages of raw
    fetchers have lost theirs already and are not cut again.
    """
    texts = _attempt_texts(attempts, as_lines, CONSENT_MARKERS, keep_flat=True)
    cut = drop_head_if_marked(texts, "_raw_lines", "_headless", 30, CONSENT_MARKERS_RAW) \
        .withColumn("_cut", F.when(F.col("source").isin(*as_lines), F.col("_text")).otherwise(F.col("_headless"))
                    if as_lines else F.col("_headless"))
    walled = (F.col("source") == "requests") & fetch_error("status", "_text").isNotNull()
    facts = cut.select("url", "source", "status", "html", "_text",
                       (answered() & ~is_blank("_cut") & ~walled).alias("readable"))
    settled = ~answered() | ~is_blank("_text")
    chosen = first_settled_facts(facts, stages, settled, payload=("readable",)).drop("source")
    cells = _attach(_domain_cells(domains, raw, bool(as_lines) if normalize is None else normalize), chosen, row_id)
    joined = cells.join(responses.select(row_id, "model_output"), row_id, "left")
    label = F.when(F.col("_url").isNull() | ~F.coalesce("readable", F.lit(False)), F.lit("Unscrapable")) \
        .otherwise(unwrap_closed_label("model_output", labels, strict))
    return joined.select(row_id, "domain", label.alias("label"))


def label_from_response(rows: DataFrame, responses: DataFrame, key: str, labels,
                        strict: bool = True, out: str = "label") -> DataFrame:
    """Attach landed model output and hold it to the closed label set.

    ``responses`` has one ``key, model_output`` row per key; a row without a
    response is ``Unclear``.
    """
    table = responses.select(key, "model_output")
    joined = rows.join(table, key, "left")
    return joined.select(
        *rows.columns, unwrap_closed_label("model_output", labels, strict).alias(out))


def _label_key(col: Column) -> Column:
    return F.regexp_replace(F.lower(col), r"[^a-z0-9]", "")


def taxonomy_label(output, taxonomy: str, default: str = "Unclear") -> Column:
    """Canonical label of a taxonomy, compared without case and punctuation.

    Answers that drop the final letter of a label still match it.
    """
    first = F.regexp_extract(py_strip(or_empty(output)), r"^([^\n\r]*)", 1)
    key = _label_key(first)
    chain = F
    for label in d.TAXONOMIES[taxonomy]:
        plain = "".join(ch for ch in label.lower() if ch.isascii() and ch.isalnum())
        near = [plain, plain[:-1]] if len(plain) > 8 else [plain]
        chain = chain.when(key.isin(*near), F.lit(label))
    return chain.otherwise(F.lit(default))


def fetch_error(status, text) -> Column:
    """``HTTP_<code>`` for a failed request, a marker for a bot wall, else NULL."""
    wall = "|".join(_literal(m.lower()) for m in d.BOT_WALL_MARKERS)
    return F.when(_c(status) != 200, F.concat(F.lit("HTTP_"), _c(status).cast("string"))) \
        .when(F.lower(or_empty(text)).rlike(wall), F.lit("Cloudflare/Captcha"))


def split_fit_line(df: DataFrame, line: str) -> DataFrame:
    """``domain;fit;explanation`` into three columns; the rest stays whole."""
    parts = F.split(F.col(line), ";", 3)
    names = ("domain", "fit", "explanation")
    return df.select("*", *[
        F.coalesce(py_strip(F.get(parts, F.lit(i))), F.lit("")).alias(n)
        for i, n in enumerate(names)])


def clean_company_name(name) -> Column:
    """Brand name without legal form, generic words, regions or marks.

    All endings go, however many; a name that would become empty is kept.
    """
    endings = "|".join(d.COMPANY_ENDINGS)
    original = py_strip(or_empty(name))
    text = py_strip(F.regexp_replace(original, "[®™©]", ""))
    text = F.regexp_replace(text, rf"(?i)^(.*?[^\s,])(?:[\s,]+(?:{endings}))+$", "$1")
    return F.coalesce(F.nullif(py_strip(text), F.lit("")), original)
