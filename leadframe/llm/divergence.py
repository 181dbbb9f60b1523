"""How far the sources of a language diverge in their words (operator 13).

Terms with equal counts in a group and in its language form a cell; the
difference is worked out once for each cell, cells are ranked by their running
multiplicity, and only cells that reach the wanted ranks are expanded to terms.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .common import column, only, shipped, tidy_shuffles

TERM = rb"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"  # of UTF-8: code points from 128 on have no byte below 128
PIECE = 1 << 20  # code points of a long text that are searched at once
HELD = 500_000  # counted terms that a task holds before it hands them on
CELLS = 1 << 20  # numbers of the table that one step of the pair sums holds
SCALE, SMOOTH = 1_000_000_000, 5
EXACT = "decimal(38,0)"


def _pieces(text: bytes, pattern: re.Pattern) -> Iterator[list[bytes]]:
    """Terms of a text; a long one is cut where no term goes on."""
    start, size = 0, len(text)
    while start < size:
        end = start + PIECE
        while end < size and pattern.match(text, end, end + 1):
            end += 1
        yield pattern.findall(text, start, min(end, size))
        start = end


def _counted(term: bytes) -> Callable:
    """(lang, source, term, n, docs) of what a task has read, each term once for each ``HELD`` entries."""
    def told(found: dict) -> Iterator[pa.RecordBatch]:
        for (lang, source), (total, docs) in found.items():
            terms = list(total)
            yield pa.RecordBatch.from_arrays(
                [pa.repeat(lang, len(terms)), pa.repeat(source, len(terms)), pa.array(terms, pa.binary()).cast(pa.string()),
                 pa.array(total.values(), pa.int64()), pa.array(map(docs.__getitem__, terms), pa.int64())],
                ["lang", "source", "term", "n", "docs"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pattern, found, held = re.compile(term), {}, 0
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text")).cast(pa.large_binary()).to_pylist()
            for text, lang, source in zip(texts, column(batch, "lang"), column(batch, "source")):
                total, docs = found.setdefault((lang or "", source or ""), (Counter(), Counter()))
                size, own = len(total), set()
                for terms in _pieces((text or b"").lower(), pattern):  # of bytes, so only A-Z change
                    total.update(terms)
                    own.update(terms)
                docs.update(own)
                held += len(total) - size
                if held > HELD:
                    yield from told(found)
                    found, held = {}, 0
        yield from told(found)
    return run


def _share(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(SCALE * (count + SMOOTH) / (total + SMOOTH * terms)), exact; null without terms."""
    above = (count.cast(EXACT) + SMOOTH) * F.lit(SCALE).cast("decimal(10,0)")
    below = total.cast(EXACT) + terms.cast(EXACT) * SMOOTH
    return F.when(terms > 0, F.call_function("div", above.cast(EXACT), below.cast(EXACT)) + 1)


def vocabulary(docs: DataFrame, min_docs: int = 30, term: bytes = TERM) -> DataFrame:
    """Kept terms of every group that has them: lang, term, lang_n, source, n."""
    counts = only(docs, "text", "lang", "source").mapInArrow(_counted(term), "lang string, source string, term string, n bigint, docs bigint") \
        .groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    counts = materialize(counts, "counts")
    kept = counts.groupBy("lang", "term").agg(F.sum("docs").alias("_docs"), F.sum("n").alias("lang_n")) \
        .where(F.col("_docs") >= min_docs).drop("_docs")
    return counts.drop("docs").join(materialize(kept, "kept"), ["lang", "term"])


def group_totals(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """lang, source, at (its place within the lang), total, lang_total, terms of every group of ``docs``."""
    empty, zero = F.lit(""), F.lit(0).cast("long")
    found = docs.select(F.coalesce("lang", empty).alias("lang"), F.coalesce("source", empty).alias("source")).distinct()
    langs = kept.select("lang", "term", "lang_n").distinct().groupBy("lang").agg(F.count("*").alias("terms"), F.sum("lang_n").alias("lang_total"))
    own = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    return found.join(langs, "lang", "left").join(own, ["lang", "source"], "left").select(
        "lang", "source", (F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1).alias("at"),
        *[F.coalesce(c, zero).alias(c) for c in ("total", "lang_total", "terms")])


def top_terms(kept: DataFrame, groups: DataFrame, ranks: int = 50) -> DataFrame:
    """lang, source, item, value, rank: the terms that a group uses more than its language does."""
    cells = kept.groupBy("lang", "source", "n", "lang_n").agg(F.count("*").alias("m")) \
        .join(groups, ["lang", "source"]) \
        .withColumn("value", _share(F.col("n"), F.col("total"), F.col("terms")) - _share(F.col("lang_n"), F.col("lang_total"), F.col("terms"))) \
        .where("value > 0").select("lang", "source", "n", "lang_n", "m", "value")
    cells = materialize(cells, "cells")
    # every value has a term at least, so that no more than ``ranks`` values can reach these ranks
    merged = cells.groupBy("lang", "source", "value").agg(F.sum("m").alias("m"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"))
    before = F.sum("m").over(order.rowsBetween(Window.unboundedPreceding, -1))
    reached = merged.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= ranks) \
        .withColumn("before", F.coalesce(before, F.lit(0))).where(F.col("before") < ranks).drop("_r", "m")
    wanted = cells.join(reached, ["lang", "source", "value"]).select("lang", "source", "n", "lang_n", "value", "before")
    tied = Window.partitionBy("lang", "source", "value").orderBy("term")
    return kept.join(wanted, ["lang", "source", "n", "lang_n"]).withColumn("_r", F.row_number().over(tied)).where(F.col("_r") <= ranks) \
        .withColumn("rank", (F.col("before") + F.col("_r")).cast("int")).where(F.col("rank") <= ranks) \
        .select("lang", "source", F.col("term").alias("item"), "value", "rank")


def _pair_sums(bases) -> Callable:
    """(lang, a, b, value): sums of |p - q| over the terms a task has read, a < b places of groups within the lang.

    ``bases`` holds the p of an absent term for each group of a lang.
    """
    names = ["lang", "a", "b", "value"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = np.array(column(batch, "lang"), object)
            at, shares = (batch.column(batch.schema.get_field_index(c)) for c in ("at", "p"))
            for lang in dict.fromkeys(langs.tolist()):
                rows = pa.array(np.flatnonzero(langs == lang))
                base = np.array(bases.value[lang], np.int64)
                step = max(1, CELLS // len(base))
                sums = np.zeros((len(base), len(base)), np.int64)
                for first in range(0, len(rows), step):
                    own, told = at.take(rows[first:first + step]), shares.take(rows[first:first + step])
                    table = np.tile(base, (len(own), 1))
                    lengths = np.diff(own.offsets.to_numpy())
                    table[np.repeat(np.arange(len(own)), lengths), own.flatten().to_numpy()] = told.flatten().to_numpy()
                    for a in range(len(base) - 1):
                        sums[a, a + 1:] += np.abs(table[:, a + 1:] - table[:, a:a + 1]).sum(axis=0)
                a, b = np.triu_indices(len(base), 1)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(a), pa.string()), pa.array(a.astype(np.int32)),
                                                  pa.array(b.astype(np.int32)), pa.array(sums[a, b])], names)
    return run


def pairs(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, source, item, value, rank: every other source of the language, the most different first.

    The sums leave a task as one number for each pair of sources, which is what
    the result holds; the terms of a pair are never written out.
    """
    spark = kept.sparkSession
    base = groups.select("lang", "at", _share(F.lit(0), F.col("total"), F.col("terms")).alias("p"))
    bases: dict[str, list[int]] = {}
    # one number for each group; the result has the square of that for a lang
    for row in base.where("p IS NOT NULL").orderBy("lang", "at").toLocalIterator():
        bases.setdefault(row.lang, []).append(row.p)
    told = kept.join(groups, ["lang", "source"]) \
        .select("lang", "term", "at", _share(F.col("n"), F.col("total"), F.col("terms")).alias("p"))
    rows = told.groupBy("lang", "term").agg(F.collect_list("at").alias("at"), F.collect_list("p").alias("p"))
    sums = rows.mapInArrow(_pair_sums(spark.sparkContext.broadcast(bases)), "lang string, a int, b int, value bigint") \
        .groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    left = groups.select("lang", "source", F.col("at").alias("a"))
    right = groups.select("lang", F.col("source").alias("item"), F.col("at").alias("b"))
    both = sums.unionByName(sums.select("lang", F.col("a").alias("b"), F.col("b").alias("a"), "value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return left.join(right, "lang").where("a <> b").join(both, ["lang", "a", "b"], "left") \
        .select("lang", "source", "item", F.coalesce("value", F.lit(0).cast("long")).alias("value")) \
        .withColumn("rank", F.row_number().over(order))


def audit(docs: DataFrame, min_docs: int = 30, ranks: int = 50) -> DataFrame:
    """lang, source, part, item, value, rank of every group (lang, source) of ``docs``.

    Terms are runs of A-Z, a-z and code points from 128 on, A-Z lower-cased; a
    language keeps the terms in at least ``min_docs`` of its documents.  A term
    with c of the N kept occurrences of a group has the share
    1 + floor(10^9 (c + 5) / (N + 5 V)) there, V being the number of kept terms.
    Part ``pair`` ranks the other sources of the language by the sum of share
    differences over all kept terms, part ``term`` the terms the group has and
    uses more than the language, up to rank ``ranks``.  Larger values come
    first, equal ones in the order of their UTF-8 bytes.

    Null text, lang and source count as empty.  Every row is a document, also
    where rows repeat.  A group without terms still has its pairs; with no kept
    term their value is 0.  An empty table gives an empty result; other columns
    are ignored.
    """
    with tidy_shuffles(docs.sparkSession):
        kept = materialize(vocabulary(docs, min_docs), "vocabulary")
        groups = materialize(group_totals(docs, kept), "groups")
        parts = [pairs(kept, groups).withColumn("part", F.lit("pair")), top_terms(kept, groups, ranks).withColumn("part", F.lit("term"))]
        return parts[0].unionByName(parts[1]).select("lang", "source", "part", "item", "value", "rank")


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
o AS (SELECT lang, source, r, unnest(terms) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS n FROM o GROUP BY lang, term HAVING count(DISTINCT r) >= 30),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT o.lang, o.source, o.term, count(*) AS n FROM o JOIN kept k ON k.lang = o.lang AND k.term = o.term GROUP BY ALL),
v AS (SELECT lang, count(*) AS v, sum(n)::HUGEINT AS n FROM kept GROUP BY lang),
gn AS (SELECT g.lang, g.source, coalesce(sum(c.n), 0)::HUGEINT AS n FROM g LEFT JOIN c ON c.lang = g.lang AND c.source = g.source GROUP BY ALL),
p AS (SELECT gn.lang, gn.source, k.term, coalesce(c.n, 0) AS n, 1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 5)) // (gn.n + 5 * v.v) AS p,
             1 + (1000000000::HUGEINT * (k.n + 5)) // (v.n + 5 * v.v) AS q
      FROM gn JOIN kept k ON k.lang = gn.lang JOIN v ON v.lang = gn.lang
      LEFT JOIN c ON c.lang = gn.lang AND c.source = gn.source AND c.term = k.term),
s AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
      FROM p a JOIN p b ON b.lang = a.lang AND b.term = a.term AND b.source <> a.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, b.source AS item, coalesce(s.value, 0) AS value FROM g a JOIN g b ON b.lang = a.lang AND b.source <> a.source
          LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
terms AS (SELECT lang, source, term AS item, p - q AS value FROM p WHERE n > 0 AND p > q)
SELECT lang, source, 'pair' AS part, item, CAST(value AS BIGINT) AS value,
       CAST(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS INTEGER) AS rank FROM pairs
UNION ALL
SELECT lang, source, 'term' AS part, item, CAST(value AS BIGINT) AS value,
       CAST(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS INTEGER) AS rank FROM terms
QUALIFY rank <= 50
"""

shipped(__name__)
