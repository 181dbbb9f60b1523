"""Plain-text column helpers with Python string semantics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The characters Python's str.strip() removes and the ones
# str.splitlines() breaks on.
STRIP_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x20\x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
LINE_BREAKS = "\n\x0b\x0c\r\x1c\x1d\x1e\x85\u2028\u2029"

BLANK_CLASS = f"[{STRIP_CHARS}]"
LINE_BREAK = f"(?:\r\n|[{LINE_BREAKS}])"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def py_strip(col) -> Column:
    """``str.strip()``: trims every Unicode blank, not only spaces."""
    return F.btrim(_c(col), F.lit(STRIP_CHARS))


def is_blank(col) -> Column:
    """NULL, empty and whitespace-only all count as blank; never NULL itself."""
    return F.coalesce(py_strip(col) == "", F.lit(True))


def or_empty(col) -> Column:
    return F.coalesce(_c(col), F.lit(""))


def collapse_ws(col) -> Column:
    """Strip, then squeeze each blank run to one space; NULL becomes ''."""
    return F.regexp_replace(py_strip(or_empty(col)), f"{BLANK_CLASS}+", " ")


def nonblank_lines(col) -> Column:
    """Trim every line, drop the empty ones, join with newlines."""
    return join_nonblank(_c(col), f"[{LINE_BREAKS}]")


def join_nonblank(col: Column, breaks: str) -> Column:
    """Pieces between the breaks, stripped, without the empty ones, as lines."""
    pieces = F.transform(F.split(col, breaks), py_strip)
    return F.array_join(F.filter(pieces, lambda p: p != ""), "\n")


def unify_line_breaks(col) -> Column:
    return F.regexp_replace(_c(col), LINE_BREAK, "\n")


def clean_cell(col) -> Column:
    """One-line cell: newlines become spaces, carriage returns vanish."""
    return py_strip(F.translate(_c(col), "\n\r", " "))


def drop_head_if_marked(df: DataFrame, text: str, out: str, n: int, markers) -> DataFrame:
    """Cut the first ``n`` lines when one of ``markers`` occurs in them.

    A banner at the top of a page is removed together with everything else in
    the head, so a page of at most ``n`` lines becomes empty.
    """
    alternation = "|".join(_literal(m.lower()) for m in markers)
    head = F.substring_index(F.col("_lines"), "\n", n)
    rest = F.expr("substring(_lines, length(_head) + 2)")
    return (
        df.withColumn("_lines", unify_line_breaks(F.col(text)))
        .withColumn("_head", head)
        .withColumn(out, F.when(F.lower("_head").rlike(alternation), rest).otherwise(F.col("_lines")))
        .drop("_lines", "_head")
    )


def _literal(word: str) -> str:
    return "".join(f"\\{ch}" if ch in r"\.[]{}()*+-?^$|&" else ch for ch in word)


def first_group(col, pattern: str, group: int = 1) -> Column:
    """Captured group or NULL when the pattern does not occur."""
    return F.get(F.regexp_extract_all(_c(col), F.lit(pattern), F.lit(group)), F.lit(0))


def parse_int(col) -> Column:
    """``int(text)`` or NULL; a decimal point or letter is not an integer."""
    text = py_strip(_c(col))
    return F.when(text.rlike(r"^[+-]?[0-9]{1,38}\z"), text.try_cast("decimal(38,0)"))


def parse_timestamp(col, formats=("yyyy-MM-dd'T'HH:mm:ss[.SSSSSSSSS][XXX][Z]",
                                  "yyyy-MM-dd HH:mm:ss[.SSSSSSSSS][XXX][Z]", "yyyy-MM-dd")) -> Column:
    """First accepted format wins; fraction and zone are optional; anything else becomes NULL."""
    return F.coalesce(*[F.try_to_timestamp(_c(col), F.lit(fmt)) for fmt in formats])


def parse_followers(text) -> tuple[Column, Column]:
    """Number after the upper-case word FOLLOWERS and a status column."""
    found = F.regexp_extract(_c(text), r"FOLLOWERS[\s]+([0-9,\s]+)", 1)
    digits = F.regexp_replace(found, r"[,\s]", "")
    value = F.when(digits != "", digits.try_cast("bigint"))
    matched = _c(text).rlike(r"FOLLOWERS[\s]+[0-9,\s]")
    status = (
        F.when(~F.coalesce(matched, F.lit(False)), F.lit("not_found"))
        .when(value.isNull(), F.lit("error"))
        .otherwise(F.lit("ok"))
    )
    return value, status
