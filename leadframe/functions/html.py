"""HTML to text on the JVM side.

Everything here is a staged chain of built-in string functions, so a page never
leaves the JVM.  The steps are separate projections on purpose: the markup pass
is the expensive one, and as a column of its own it is evaluated once even
though later steps read it several times.
"""

from __future__ import annotations

import json
from html.entities import html5

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import drop_head_if_marked, join_nonblank, nonblank_lines, py_strip

_GAP = "\x01"


def _attributes(atomic: bool) -> str:
    # Attribute text up to the closing '>', with quoted values kept whole.  A bare
    # '<' ends the attempt, so a run of unclosed tags is scanned once, not once per tag.
    body = r"""[^<>=]+|=\s*"[^"]*"|=\s*'[^']*'|="""
    return f"(?>{body})*+" if atomic else f"(?:{body})*"


def markup_pattern(dropped: tuple[str, ...], atomic: bool = True) -> str:
    """One regex that consumes comments, whole dropped elements and tags.

    A single left-to-right pass settles which construct comes first, so markup
    inside a script string or a comment is never taken for a tag.  An element
    that is never closed runs to the end of the page.
    """
    blocks = "|".join(rf"{name}[\s/>].*?(?:</{name}\s*>|\z)" for name in dropped)
    return rf"(?is)<(?:!--.*?(?:-->|\z)|{blocks}|[a-z/!?]{_attributes(atomic)}>)"


# Comments, scripts and styles hold no links and no readable text.
HIDDEN_BLOCKS = (r"(?is)<(?:!--.*?(?:-->|\z)|script[\s/>].*?(?:</script\s*>|\z)"
                 r"|style[\s/>].*?(?:</style\s*>|\z))")

# Elements whose text is never part of the visible text.
FLAT_DROPPED = ("script", "style", "template")
LINES_DROPPED = ("script", "style", "template", "noscript", "svg")


# Names that browsers also accept without the semicolon, longest first.
_LEGACY = sorted((name for name in html5 if not name.endswith(";")), key=lambda name: (-len(name), name))
#: References to the C1 range mean the Windows code page; these numbers are no characters.
_C1 = {code: bytes([code]).decode("cp1252", errors="ignore") for code in range(128, 160)}
_COMMON = {"amp;": "&", "lt;": "<", "gt;": ">", "quot;": '"', "nbsp;": "\xa0"}


def _literal_map(table: dict) -> Column:
    # one literal that the optimizer folds, instead of thousands of them
    return F.from_json(F.lit(json.dumps(table)), "map<string,string>")


def _named_entity(name: Column) -> Column:
    """``name;`` to its text; the common ones need no look-up in the long table."""
    common = F
    for known, char in _COMMON.items():
        common = common.when(name == known, F.lit(char))
    return common.when(name != "", F.try_element_at(_literal_map(html5), name))


def _numeric_entity(digits: Column) -> Column:
    """Character of a reference by number, decimal or with x, however many zeros it starts with."""
    short = F.regexp_replace(digits, "^[xX]?0*(?=.)", "")
    value = F.when(digits.rlike("^[xX]"), F.conv(short, 16, 10)).otherwise(F.conv(short, 10, 10))
    code = F.when(F.length(short) <= 8, value.try_cast("bigint")).otherwise(F.lit(1 << 32))
    char = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
    legacy = F.try_element_at(_literal_map({str(k): v for k, v in _C1.items() if v}), code.cast("string"))
    none = code.between(1, 8) | code.between(14, 31) | (code == 127) | (code == 11) \
        | code.between(0xFDD0, 0xFDEF) | (code.bitwiseAND(F.lit(0xFFFE)) == 0xFFFE)
    broken = (code == 0) | code.between(0xD800, 0xDFFF) | (code > 0x10FFFF)
    return F.when(broken, F.lit("\ufffd")).when(none, F.lit("")).otherwise(F.coalesce(legacy, char))


def decode_entities(df: DataFrame, text: str, out: str) -> DataFrame:
    """Decode character references as browsers do; texts without '&' skip the work.

    The text is cut at every '&' and each piece decodes the reference it starts
    with, so nothing that decoding produces is decoded again.
    """
    source = F.col(text)

    def decoded(piece: Column, index: Column) -> Column:
        digits = F.regexp_extract(piece, r"^#([xX][0-9a-fA-F]+|[0-9]+);?", 1)
        full = F.regexp_extract(piece, r"^[A-Za-z][A-Za-z0-9]{0,31};", 0)
        whole = _named_entity(full)
        legacy = F.regexp_extract(piece, "^(?:" + "|".join(_LEGACY) + ")", 0)
        return F.when(index == 0, piece) \
            .when(digits != "", F.concat(_numeric_entity(digits), F.regexp_replace(piece, r"^#(?:[xX][0-9a-fA-F]+|[0-9]+);?", ""))) \
            .when(whole.isNotNull(), F.concat(whole, F.substr(piece, F.length(full) + 1))) \
            .when(legacy != "", F.concat(F.try_element_at(_literal_map({n: html5[n] for n in _LEGACY}), legacy),
                                         F.substr(piece, F.length(legacy) + 1))) \
            .otherwise(F.concat(F.lit("&"), piece))

    pieces = F.transform(F.split(source, "&"), decoded)
    return df.withColumn(out, F.when(source.contains("&"), F.array_join(pieces, "")).otherwise(source))


def _unmarked(df: DataFrame, html: str, dropped) -> DataFrame:
    staged = df.withColumn("_gaps", F.regexp_replace(F.col(html), markup_pattern(dropped), _GAP))
    return decode_entities(staged, "_gaps", "_gaps")


def html_to_text_flat(df: DataFrame, html: str, out: str) -> DataFrame:
    """All visible text nodes joined by one space, outer blanks stripped."""
    joined = py_strip(F.regexp_replace("_gaps", f"{_GAP}+", " "))
    return _unmarked(df, html, FLAT_DROPPED).withColumn(out, joined).drop("_gaps")


def html_to_node_lines(df: DataFrame, html: str, out: str) -> DataFrame:
    """Stripped text nodes, one per line; breaks inside a node are kept."""
    return _unmarked(df, html, LINES_DROPPED) \
        .withColumn(out, join_nonblank(F.col("_gaps"), _GAP)).drop("_gaps")


# Words that mark a consent banner, one list per tool variant.
CONSENT_MARKERS = (
    "cookie", "gdpr", "consent", "We use cookies", "Używamy plików cookie",
    "Wir verwenden Cookies", "Usamos cookies", "Wij gebruiken cookies", "RODO",
)
CONSENT_MARKERS_SHORT = ("cookie", "gdpr", "consent", "rodo")
CONSENT_MARKERS_RAW = CONSENT_MARKERS[:8]


def html_to_text_lines(df: DataFrame, html: str, out: str, consent_lines: int = 50,
                       markers=CONSENT_MARKERS) -> DataFrame:
    """Visible text as clean lines, with a consent banner cut from the head."""
    staged = html_to_node_lines(df, html, "_nodes")
    if consent_lines:
        staged = drop_head_if_marked(staged, "_nodes", "_nodes", consent_lines, markers)
    return staged.withColumn(out, nonblank_lines("_nodes")).drop("_nodes")


__all__ = [
    "CONSENT_MARKERS", "CONSENT_MARKERS_RAW", "CONSENT_MARKERS_SHORT", "FLAT_DROPPED", "HIDDEN_BLOCKS",
    "LINES_DROPPED", "decode_entities", "html_to_node_lines", "html_to_text_flat",
    "html_to_text_lines", "markup_pattern",
]
