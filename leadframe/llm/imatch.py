"""I-Match fingerprints of documents (operator 4).

Column expressions only.  Terms within a band of inverse document frequency form
the lexicon; it is dealt to random subsets, and each is hashed over the distinct
terms that a document has in it.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..session import materialize
from .common import lower_ascii, only, tidy_shuffles, words

#: One term in so many belongs to a given subset; as many subsets leave no term out.
SPARSE = 128
SUBSETS = SPARSE
#: A lexicon of so many terms at most is sent to the tasks (about 70 MB); a larger one is joined by shuffle.
BROADCAST_TERMS = 2_000_000


def next_texts(docs: DataFrame, bucket_rows: int = 2_000) -> DataFrame:
    """_id, doc_id, text, next_id, next_text: each row with the next by descending doc_id, after the last the first.

    Rows are dealt to key ranges of about ``bucket_rows`` rows; each range also
    gets the first row of the next lower one, so no task sees more than a range.
    """
    dealt, line = _dealt(docs, bucket_rows)
    return dealt.withColumn("next_id", F.lead("_id").over(line)).withColumn("next_text", F.lead("text").over(line)) \
        .where(~F.col("_ghost")).select("_id", "doc_id", "text", "next_id", "next_text")


def _dealt(docs: DataFrame, bucket_rows: int = 2_000) -> tuple[DataFrame, WindowSpec]:
    """Rows by range, with the first of the next lower range as a ghost, and the window that leads to the next row."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    found = rows.agg(F.count("*").alias("n"), F.count("doc_id").alias("ids")).head()
    parts = min(10_000, found.n // bucket_rows + 1)
    shares = [i / parts for i in range(1, parts)]
    bounds = rows.agg(F.percentile_approx("doc_id", F.lit(shares), 100_000).alias("b")).head().b if shares and found.ids else []
    bounds = sorted(set(bounds))
    rows = rows.withColumn("_part", _range(F.col("doc_id"), bounds)).withColumn("_id", F.monotonically_increasing_id())
    place = F.struct(F.col("doc_id").isNotNull().alias("a"), "doc_id", F.xxhash64("text").alias("h"), "_id")
    heads = rows.groupBy("_part").agg(F.max(place).alias("top"))
    # one row for each range: their number is bounded by ``parts``
    ring = Window.orderBy("_part")
    above = F.coalesce(F.lead("_part").over(ring), F.first("_part").over(ring.rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing)))
    heads = heads.withColumn("_to", above).select(F.col("top._id").alias("_id"), "_to")
    ghosts = rows.join(F.broadcast(heads), "_id").select("doc_id", "text", F.col("_to").alias("_part"), "_id", F.lit(True).alias("_ghost"))
    dealt = rows.select("doc_id", "text", "_part", "_id", F.lit(False).alias("_ghost")).unionByName(ghosts) \
        .withColumn("_hash", F.xxhash64("text"))
    return dealt, Window.partitionBy("_part").orderBy(
        "_ghost", F.col("doc_id").desc_nulls_last(), F.col("_hash").desc(), F.col("_id").desc())


def _range(value: Column, bounds: list[int]) -> Column:
    """Number of bounds below a value, found by halving; null lies below all."""
    if not bounds:
        return F.lit(0)

    def split(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(value > bounds[middle], split(middle + 1, high)).otherwise(split(low, middle))

    return F.when(value.isNull(), 0).otherwise(split(0, len(bounds)))


def edited(text: Column, other: Column) -> Column:
    """The last third of the code points replaced by as many of the other text, or all of it."""
    cut = F.floor(F.length(text) / 3).cast("int")
    return F.concat(F.substr(text, F.lit(1), F.length(text) - cut), F.substr(other, F.lit(1), cut))


def terms(text: Column) -> Column:
    """Hashes of the distinct lower-cased terms."""
    return F.array_distinct(F.transform(words(lower_ascii(text)), lambda w: F.xxhash64(w)))


def _print(parts: Column, name: str, whole: Column) -> Column:
    """``subset:hash`` of every subset in which a text has a term; a text without any goes by its own hash."""
    own = F.filter(parts, lambda p: p[name].isNotNull())
    told = F.transform(own, lambda p: F.concat(F.hex(p.k), F.lit(":"), F.lower(F.hex(p[name]))))
    return F.when(F.size(own) > 0, F.array_join(told, ".")).otherwise(F.concat(F.lit("text:"), F.lower(F.hex(whole))))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal hashes among the subsets in which either text has a term; 1 for equal fingerprints."""
    x, y = F.split(a, r"\."), F.split(b, r"\.")
    subsets = lambda c: F.transform(c, lambda p: F.substring_index(p, ":", 1))
    told = F.size(F.array_union(subsets(x), subsets(y)))
    return F.when(a == b, F.lit(1.0)).when(a.startswith("text:") | b.startswith("text:"), F.lit(0.0)) \
        .otherwise(F.size(F.array_intersect(x, y)) / told)


def _lexicon(docs: DataFrame, low: float, high: float) -> DataFrame:
    """h: hashes of the terms within the band, hinted as a broadcast if they are few enough."""
    with tidy_shuffles(docs.sparkSession):
        total = docs.count()
        counted = docs.select(F.explode(terms(F.col("text"))).alias("h")).groupBy("h").agg(F.count("*").alias("df"))
        lexicon = materialize(counted.where(F.col("df").between(total ** (1 - high), total ** (1 - low))).select("h"), "lexicon")
    return F.broadcast(lexicon) if lexicon.count() <= BROADCAST_TERMS else lexicon


def fingerprints(docs: DataFrame, low: float = 0.2, high: float = 0.8) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    Terms are blank-separated, A-Z lower-cased.  With N documents, the lexicon
    holds the terms whose idf, ln(N / df) / ln(N), lies within ``low`` … ``high``:
    neither stop words nor one-off spellings, at any corpus size.  Each of the 128
    subsets is a random 1/128 of the lexicon, chosen by hash, so that an edit
    leaves some untouched; together they hold all of it.  Document frequencies are counted over all documents.

    The edited text has the last third replaced by the start of the next document
    by descending ``doc_id``.  Null text counts as empty; a text without a
    lexicon term is fingerprinted whole.  Equal ``doc_id`` are ordered by text,
    null ids come last.  A single document is its own next.  An empty table
    gives an empty result; other columns are ignored.
    """
    docs = only(docs, "doc_id", "text")
    lexicon = _lexicon(docs, low, high).withColumn("_in", F.lit(True))
    dealt, line = _dealt(docs)
    # all that follows stays within the ranges, so nothing is moved again
    rows = dealt.withColumn("_edited", F.when(~F.col("_ghost"), edited(F.col("text"), F.lead("text").over(line))))
    keys = ["_part", "_ghost", "_id", "doc_id", "_hash", "n_chars", "edited_sha256", "_edited_hash"]
    rows = rows.select(
        "_part", "_ghost", "_id", "doc_id", "_hash", F.length("text").cast("long").alias("n_chars"),
        F.sha2(F.col("_edited").cast("binary"), 256).alias("edited_sha256"), F.xxhash64("_edited").alias("_edited_hash"),
        terms(F.col("text")).alias("_terms"), F.coalesce(terms(F.col("_edited")), F.array().cast("array<bigint>")).alias("_edited_terms"))
    rows = rows.select(*keys, F.size("_terms").alias("_own"), F.posexplode_outer(F.concat("_terms", "_edited_terms")).alias("_at", "h"))
    rows = rows.join(lexicon, "h", "left").withColumn("k", F.when(F.col("_in"), F.pmod("h", F.lit(SPARSE))))
    # hashes of distinct terms, so their exclusive or is a hash of the set
    term, own = F.when(F.col("_in"), F.xxhash64("h")), F.col("_at") < F.col("_own")
    parts = rows.groupBy(*keys, "k").agg(F.bit_xor(F.when(own, term)).alias("own"), F.bit_xor(F.when(~own, term)).alias("edited"))
    prints = parts.groupBy(*keys).agg(F.array_sort(F.collect_list(
        F.when(F.col("k").isNotNull(), F.struct("k", "own", "edited")))).alias("_parts"))
    prints = prints.select(*keys, _print(F.col("_parts"), "own", F.col("_hash")).alias("fingerprint"),
                           _print(F.col("_parts"), "edited", F.col("_edited_hash")).alias("edited_fingerprint"))
    return prints.withColumn("_next", F.lead("fingerprint").over(line)).where(~F.col("_ghost")).select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("_next")).alias("near_next"))
