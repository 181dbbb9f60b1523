"""Large keyword dictionaries that are tables themselves."""

from __future__ import annotations

import re
import sys
from collections import defaultdict
from collections.abc import Iterator
from itertools import accumulate, chain

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.rules import EXACT_CASE, _entry

# The helpers travel with the job, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Characters of a dictionary of whole words that are compiled on the driver; a larger one is joined.
HELD_CHARS = 200_000


def _compiled(rows, whole_words: bool) -> bytes:
    """Automaton over the plain parts of all entries, and the entries behind each part, as bytes.

    A part leads to (entry, whether it needs the entry's regex); an entry without any plain part is always tried.
    """
    import ahocorasick

    parts: dict[str, list[tuple[int, bool]]] = {}
    entries, always = [], []
    for number, row in enumerate(rows):
        if whole_words:
            entry = {"plain": [row.pattern.lower()], "needed": [], "scan": None}
        else:
            entry = _entry(row.name, row.pattern)
        scan = entry["scan"] and entry["scan"].removeprefix(EXACT_CASE)
        entries.append((row.group, row.name, scan))
        for word in entry["plain"]:
            if word:
                parts.setdefault(word, []).append((number, False))
        for word in entry["needed"]:
            parts.setdefault(word, []).append((number, True))
        if scan and not entry["needed"]:
            always.append(number)
    automaton = ahocorasick.Automaton()
    for word, leads in parts.items():
        automaton.add_word(word, (len(word), tuple(leads)))
    if parts:
        automaton.make_automaton()
    return cloudpickle.dumps((automaton if parts else None, entries, always))


def _edge(text: str, at: int) -> bool:
    return not 0 <= at < len(text) or not (text[at].isalnum() or text[at] == "_")


def _found(text: str, automaton, entries: list, always: list[int], scans: dict, whole_words: bool) -> set[int]:
    found, tried = set(), set(always)
    if automaton is not None:
        for end, (size, leads) in automaton.iter(text):
            if whole_words and not (_edge(text, end - size) and _edge(text, end + 1)):
                continue
            for number, needs in leads:
                (tried if needs else found).add(number)
    for number in tried - found:
        if number not in scans:
            scans[number] = re.compile(entries[number][2])
        if scans[number].search(text):
            found.add(number)
    return found


def _shape(pattern: str) -> tuple[int, int, int]:
    """Word runs of a pattern, characters before the first and after the last; without any, 0 and all characters."""
    runs = [m.span() for m in re.finditer(r"\w+", pattern)]
    return (len(runs), runs[0][0], len(pattern) - runs[-1][1]) if runs else (0, len(pattern), 0)


def _pieces(text: str, shapes: list[tuple[int, int, int]]) -> set[str]:
    """Parts of a text that have one of the shapes and begin and end at word edges."""
    if shapes == [(1, 0, 0)]:
        return set(re.findall(r"\w+", text))
    runs = [m.span() for m in re.finditer(r"\w+", text)]
    # a part lies between the end of the run before it and the start of the run after it, and touches neither
    starts, ends = [*[r[0] for r in runs], len(text) + 1], [-1, *[r[1] for r in runs]]
    found = set()
    for k, before, after in shapes:
        for i in range(len(starts) - k):
            if k:
                first, last = starts[i] - before, ends[i + k] + after
                if first > ends[i] and last < starts[i + k]:
                    found.add(text[first:last])
            else:
                found.update(text[first:first + before] for first in range(ends[i] + 1, starts[i] - before))
    return found


def _joined_hits(rows: DataFrame, key: str, text: str, words: DataFrame) -> DataFrame:
    """Hits of whole words by a join of the dictionary with all parts of the texts that look like an entry.

    A word that is in many texts leaves a task as one row for each Arrow batch, not for each text.
    """
    def shaped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            patterns = [p.lower() for p in batch.column(2).to_pylist()]
            shapes = zip(*[_shape(p) for p in patterns]) if patterns else ((), (), ())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(patterns, pa.string()),
                                              *[pa.array(s, pa.int32()) for s in shapes]],
                                             ["group", "name", "_piece", "runs", "before", "after"])

    entries = words.mapInArrow(shaped, "`group` string, name string, _piece string, runs int, before int, after int")
    shapes = [tuple(r) for r in entries.select("runs", "before", "after").distinct().collect()]
    entries = entries.select("group", "name", "_piece").distinct()
    several = not entries.groupBy("group", "name").agg(F.count("*").alias("n")).where("n > 1").isEmpty()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            where: defaultdict[str, list[int]] = defaultdict(list)
            for i, value in enumerate(batch.column(1).to_pylist()):
                for piece in _pieces(value, shapes) if value else ():
                    where[piece].append(i)
            offsets = pa.array([0, *accumulate(map(len, where.values()))], pa.int32())
            places = pa.array(chain.from_iterable(where.values()), pa.int64())
            own = pa.StructArray.from_arrays([batch.column(i).take(places) for i in (0, 2)], ["key", "row"])
            yield pa.RecordBatch.from_arrays([pa.array(where, pa.string()), pa.ListArray.from_arrays(offsets, own)], ["_piece", "_own"])

    # only an entry with several patterns can be found twice in a row; the row's number then tells it from others with its key
    number = F.monotonically_increasing_id() if several else F.lit(None).cast("long")
    own = f"array<struct<key: {rows.schema[key].dataType.simpleString()}, row: bigint>>"
    found = rows.select(key, F.lower(text).alias("_low"), number.alias("_row")).mapInArrow(cut, f"_piece string, _own {own}") \
        .join(entries, "_piece").select("group", "name", F.explode("_own").alias("_own")) \
        .select(F.col("_own.key").alias(key), "group", "name", F.col("_own.row").alias("_row"))
    return (found.distinct() if several else found).drop("_row")


def dictionary_hits(rows: DataFrame, key: str, text: str, dictionary: DataFrame, whole_words: bool = False,
                    block_chars: int = 2_000_000) -> DataFrame:
    """``key, group, name`` of every dictionary entry that occurs in a text, once for each row and entry.

    ``dictionary`` has columns ``group, name, pattern``: patterns in lower case,
    as :func:`files.read_dictionary` gives them; with ``whole_words`` plain words
    or phrases in any case that must begin and end at word edges.  Texts are
    compared in lower case; missing ones hold nothing, blank patterns are skipped.

    The dictionary is compiled once, into an automaton that finds all plain
    parts in one pass over a text, and broadcast.  A dictionary of more than
    ``block_chars`` characters is searched in as many blocks, one pass each.
    One of whole words that exceeds ``block_chars`` or ``HELD_CHARS`` is joined
    with the words of the texts instead, and may grow with them.
    """
    spark = rows.sparkSession
    words = dictionary.select(F.col("group").cast("string").alias("group"), F.col("name").cast("string").alias("name"), "pattern") \
        .where("trim(pattern) <> ''").distinct()
    size = words.agg(F.sum(F.length("pattern"))).head()[0] or 0
    if whole_words and size > min(block_chars, HELD_CHARS):
        return _joined_hits(rows, key, text, words)
    blocks = size // block_chars + 1
    block = F.pmod(F.xxhash64("group", "name", "pattern"), F.lit(blocks))
    schema = f"{rows.select(key).schema[0].simpleString().replace(':', ' ', 1)}, `group` string, name string"
    out = None
    for b in range(blocks):
        held = spark.sparkContext.broadcast(_compiled(words.where(block == b).orderBy("group", "name", "pattern").collect(), whole_words))

        def search(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            automaton, entries, always = cloudpickle.loads(held.value)
            scans: dict[int, re.Pattern] = {}
            for batch in batches:
                places, names = [], []
                for i, value in enumerate(batch.column(1).to_pylist()):
                    own = {entries[n][:2] for n in _found(value, automaton, entries, always, scans, whole_words)} if value else ()
                    places += [i] * len(own)
                    names += own
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(places, pa.int64())), pa.array([n[0] for n in names], pa.string()),
                     pa.array([n[1] for n in names], pa.string())], [key, "group", "name"])

        found = rows.select(key, F.lower(text).alias("_low")).mapInArrow(search, schema)
        out = found if out is None else out.unionByName(found)
    # an entry with patterns in several blocks may be found in each; within a row that is rare and the rows are narrow
    return out if blocks == 1 else out.distinct()
