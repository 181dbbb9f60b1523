"""Ordered regex rules and keyword votes as column expressions.

Rule order carries meaning, so a rule list becomes one CASE: Spark evaluates
its branches lazily and stops at the first hit, as the ladder of ifs would.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import _c

# Unicode classes and Unicode case folding, independent of the JDK's defaults.
IGNORE_CASE = "(?iU)"
EXACT_CASE = "(?U)"


def matches(col, pattern: str, flags: str = IGNORE_CASE) -> Column:
    """Regex search that is false, not NULL, for a missing text."""
    return F.coalesce(_c(col).rlike(flags + pattern), F.lit(False))


def bounded(words: Iterable[str]) -> str:
    """Words delimited by anything but an ASCII letter, or by the text's edge."""
    return "(?:^|[^a-zA-Z])(?:" + "|".join(words) + ")(?:[^a-zA-Z]|$)"


def first_match(rules: Sequence[tuple[Column, object]], default=None) -> Column:
    """Label of the first rule whose condition holds."""
    chain = F
    for condition, label in rules:
        chain = chain.when(condition, F.lit(label))
    return chain.otherwise(F.lit(default))


def _top_level_branches(pattern: str) -> list[str]:
    parts, depth, start, in_class, i = [], 0, 0, False, 0
    while i < len(pattern):
        ch = pattern[i]
        if ch == "\\":
            i += 2
            continue
        if in_class:
            in_class = ch != "]"
        elif ch == "[":
            in_class = True
        elif ch == "(":
            depth += 1
        elif ch == ")":
            depth -= 1
        elif ch == "|" and depth == 0:
            parts.append(pattern[start:i])
            start = i + 1
        i += 1
    parts.append(pattern[start:])
    return parts


def guarded(pattern: str) -> str:
    """Put a one-character look-ahead before an alternation of plain words.

    The text is scanned once per pattern; testing one character class per
    position is far cheaper than trying every alternative there.  Patterns
    whose alternatives do not all start with a plain letter stay as they are.
    """
    branches = _top_level_branches(pattern)
    firsts = {b[:1] for b in branches}
    optional = any(len(b) > 1 and b[1] in "?*{" for b in branches)
    if optional or not all(f.isalpha() for f in firsts):
        return pattern
    return f"(?=[{''.join(sorted(firsts))}])(?:{pattern})"


def _closing(pattern: str, i: int) -> int:
    """Index of the bracket that closes the one at ``i``."""
    close, depth = {"(": ")", "[": "]", "{": "}"}[pattern[i]], 0
    opening = pattern[i]
    while i < len(pattern):
        if pattern[i] == "\\":
            i += 1
        elif pattern[i] == opening and (opening != "[" or depth == 0):
            depth += 1
        elif pattern[i] == close:
            depth -= 1
            if depth == 0:
                return i
        i += 1
    raise ValueError(f"unbalanced {opening} in {pattern}")


def required_literal(branch: str) -> str:
    """Longest plain text that every match of an alternative contains."""
    runs, run, i = [], "", 0
    while i < len(branch):
        ch = branch[i]
        if ch == "\\" and not branch[i + 1].isalnum():
            run, i = run + branch[i + 1], i + 2
            continue
        if ch in "?*{":  # the character before it may be missing
            run = run[:-1]
        if ch in "([{":
            i = _closing(branch, i)
        elif ch == "\\":
            i += 1
        if ch in "\\([{?*+.^$":
            runs.append(run)
            run = ""
        else:
            run += ch
        i += 1
    return max([*runs, run], key=len)


_ENTRY = "array<struct<name:string,plain:array<string>,needed:array<string>,scan:string>>"


def _entry(name: str, pattern: str) -> dict:
    """One dictionary entry: plain alternatives, and a regex for the others.

    A substring test is far cheaper than a regex scan.  Alternatives that are
    plain text are only tested that way; the others are scanned for only in
    texts that contain the plain part they cannot do without.
    """
    branches = [(b, required_literal(b)) for b in _top_level_branches(pattern)]
    scanned = [b for b, literal in branches if literal != b]
    needed = {literal for b, literal in branches if literal != b}
    return {
        "name": name,
        "plain": [b for b, literal in branches if literal == b],
        "needed": sorted(needed) if all(needed) else [],
        "scan": EXACT_CASE + guarded("|".join(scanned)) if scanned else None,
    }


def found_literals(text, *dictionaries: Mapping[str, str]) -> Column:
    """Plain parts of the patterns that occur in a lower-cased text.

    All words of the dictionaries are looked for in one pass over the text by a
    multi-pattern automaton.  This is the one search that leaves the JVM, in
    Arrow batches: with some two hundred words it measured about ten times
    faster than as many substring tests.  Executors without the automaton
    library test the words one by one.
    """
    entries = [_entry(n, p) for patterns in dictionaries for n, p in patterns.items()]
    words = sorted({w for e in entries for w in (*e["plain"], *e["needed"])})

    @F.pandas_udf("array<string>")
    def search(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        try:
            import ahocorasick
        except ImportError:
            def find(value):
                return [w for w in words if value and w in value]
        else:
            automaton = ahocorasick.Automaton()
            for word in words:
                automaton.add_word(word, word)
            automaton.make_automaton()

            def find(value):
                return list({word for _, word in automaton.iter(value)}) if value else []

        for batch in batches:
            yield batch.map(find)

    return search(_c(text))


def occurring(text, patterns: Mapping[str, str], found: Column | None = None) -> Column:
    """Dictionary entries that occur in a lower-cased text.

    The dictionary is one folded literal, so the plan stays small however many
    patterns there are.  ``found`` is the column of :func:`found_literals`;
    without it the words of a small dictionary are tested one by one.  A
    missing text has no entries.
    """
    text = _c(text)
    entries = F.from_json(F.lit(json.dumps([_entry(n, p) for n, p in patterns.items()])), _ENTRY)

    def any_of(words: Column) -> Column:
        return F.exists(words, text.contains) if found is None else F.arrays_overlap(found, words)

    def occurs(entry: Column) -> Column:
        present = (F.size(entry["needed"]) == 0) | any_of(entry["needed"])
        scanned = entry["scan"].isNotNull() & present & F.rlike(text, entry["scan"])
        return any_of(entry["plain"]) | scanned

    return F.filter(entries, lambda entry: F.coalesce(occurs(entry), F.lit(False)))


def _named(patterns) -> Mapping[str, str]:
    return patterns if isinstance(patterns, Mapping) else {str(i): p for i, p in enumerate(patterns)}


def count_matches(text, patterns, found: Column | None = None) -> Column:
    """How many different patterns occur, however often each of them does."""
    return F.size(occurring(text, _named(patterns), found)).cast("bigint")


def any_match(text, patterns, found: Column | None = None) -> Column:
    """Does any pattern of the group occur in the lower-cased text?"""
    return count_matches(text, patterns, found) > 0


def matched_names(text, patterns: Mapping[str, str], found: Column | None = None) -> Column:
    """Names of the patterns that occur, in dictionary order."""
    return F.transform(occurring(text, patterns, found), lambda entry: entry["name"])
