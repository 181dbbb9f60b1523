"""SQL text pieces of the twins, in the dialect of the checking engine.

They restate the semantics with that engine's own functions (lists, RE2
patterns) instead of translating the Spark expressions.
"""

from __future__ import annotations

import re
from html.entities import name2codepoint

from ..functions.text import LINE_BREAKS, STRIP_CHARS


def lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def strip(x: str) -> str:
    return f"trim({x}, {lit(STRIP_CHARS)})"


def blank(x: str) -> str:
    return f"(coalesce({strip(x)}, '') = '')"


def collapse(x: str) -> str:
    return f"regexp_replace({strip(f'coalesce({x}, {lit(str())})')}, {lit(f'[{STRIP_CHARS}]+')}, ' ', 'g')"


def has(x: str, pattern: str, flags: str = "(?i)") -> str:
    return f"coalesce(regexp_matches({x}, {lit(flags + pattern)}), false)"


def group(x: str, pattern: str, n: int = 1) -> str:
    return f"regexp_extract({x}, {lit(pattern)}, {n})"


def sub(x: str, pattern: str, by: str) -> str:
    return f"regexp_replace({x}, {lit(pattern)}, {lit(by)}, 'g')"


def lines(x: str) -> str:
    """List of stripped lines."""
    unified = sub(x, f"\r\n|[{LINE_BREAKS}]", "\n")
    return f"list_transform(string_split({unified}, chr(10)), lambda l: {strip('l')})"


def joined(items: str, source: str) -> str:
    """Lines back to a text; no lines make an empty text, not NULL."""
    return f"coalesce(array_to_string({items}, chr(10)), CASE WHEN {source} IS NOT NULL THEN '' END)"


def nonblank(x: str) -> str:
    return joined(f"list_filter({lines(x)}, lambda l: l <> '')", x)


# The references that occur in the derived pages.
_KNOWN = {
    "nbsp": "\xa0", "eacute": "é", "ouml": "ö", "szlig": "ß", "auml": "ä", "middot": "·",
    "copy": "©", "quot": '"', "lt": "<", "gt": ">", "#8217": "’", "#39": "'",
}
assert all(ord(v) == name2codepoint[k] for k, v in _KNOWN.items() if k[0] != "#")


def entities(x: str) -> str:
    for name, char in _KNOWN.items():
        x = f"replace({x}, '&{name};', {lit(char)})"
    return f"replace({x}, '&amp;', '&')"


def unmarked(html: str, dropped) -> str:
    """Markup replaced by chr(1), references decoded: whole elements and comments go first, then single tags."""
    whole = [rf"<{name}(?:[\s/][^>]*)?>.*?</{name}\s*>|<{name}[\s/>].*" for name in dropped]
    everything = "|".join([r"<!--.*?-->|<!--.*", *whole, r"""</?[a-z][^\s/>]*(?:"[^"]*"|'[^']*'|[^<>"'])*>|<[!?/][^<>]*>"""])
    return entities(f"regexp_replace({html}, {lit('(?is)' + everything)}, chr(1), 'g')")


def flat_text(html: str) -> str:
    dropped = ("script", "style", "template")
    return strip(sub(unmarked(html, dropped), "\x01+", " "))


def node_lines(html: str) -> str:
    """Stripped, non-empty text nodes joined by newlines."""
    dropped = ("script", "style", "template", "noscript", "svg")
    nodes = f"list_transform(string_split({unmarked(html, dropped)}, chr(1)), lambda n: {strip('n')})"
    return joined(f"list_filter({nodes}, lambda n: n <> '')", html)


def cut_head(text: str, n: int, markers) -> str:
    """Drop the first ``n`` lines when a marker occurs in them."""
    words = "|".join(m.lower().replace(".", r"\.") for m in markers)
    split = f"string_split({sub(text, f'{chr(13)}{chr(10)}|[{LINE_BREAKS}]', chr(10))}, chr(10))"
    head = f"lower(array_to_string(list_slice({split}, 1, {n}), chr(10)))"
    rest = joined(f"list_slice({split}, {n + 1}, len({split}))", text)
    return f"(CASE WHEN regexp_matches({head}, {lit(words)}) THEN {rest} ELSE {text} END)"


def wide_edges(pattern: str) -> str:
    r"""Word edges that know letters beyond ASCII, for a yes-or-no search."""
    other = r"[^\\p{L}\\p{M}\\p{N}_]"
    return re.sub(r"\\b(\w+)\\b", rf"(?:^|{other})\1(?:$|{other})", pattern)


def votes(text: str, patterns) -> str:
    return " + ".join(f"CAST({has(text, wide_edges(p), '')} AS bigint)" for p in patterns) or "0"


def any_of(text: str, patterns) -> str:
    return "(" + " OR ".join(has(text, wide_edges(p), "") for p in patterns) + ")"


def in_list(values) -> str:
    return "(" + ", ".join(lit(v) for v in values) + ")"


def valid_domain(x: str) -> str:
    return f"coalesce(regexp_matches({x}, '^[a-zA-Z0-9.-]+\\.[a-zA-Z]{{2,}}$'), false)"


def bare_domain(x: str) -> str:
    """Host of a domain cell, step by step."""
    tail = f"regexp_replace({strip(x)}, '^.*?://', '')"
    authority = group(tail, "^([^/?#]*)")
    host = f"(CASE WHEN {authority} = '' THEN {group(tail, '^([^?#]*)')} ELSE {authority} END)"
    host = f"split_part(list_extract(string_split({host}, '@'), -1), ':', 1)"
    return f"regexp_replace(ltrim({strip(host)}, '.'), '^www\\.', '')"
