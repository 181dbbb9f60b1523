"""Mixing sources to target weights (operator 7)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD

WEIGHTS = (5, 2, 1)


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = 1.0, max_epochs: int = 3) -> DataFrame:
    """Target of every source from ``sizes`` (source, _name, source_size), one row per source.

    Sources in code-point order, null last, get the weights in turn.  The budget
    ``share`` × all words is shared by weight; a source stops at ``max_epochs``
    times its size and the excess is reshared.  Sorted by the level at which each
    source fills up, the levels offered rise up to the first that overfills no
    source and fall after it; so one ordered prefix sum replaces the rounds.  Sources are names that people
    maintain; this table has one row for each.
    """
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]),
                          (F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1).cast("int"))
    cap = F.col("source_size") * max_epochs
    levels = sizes.withColumn("_w", weight).withColumn("_cap", cap) \
        .withColumn("_level", F.col("_cap") / F.col("_w"))
    order = Window.orderBy("_level", F.col("source").isNull(), "source")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    rest = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.partitionBy(F.lit(1))
    budget = F.sum("source_size").over(whole) * F.lit(share)
    here = (budget - F.coalesce(F.sum("_cap").over(before), F.lit(0))) / F.sum("_w").over(rest)
    final = F.max(F.when(F.col("_here") <= F.col("_level"), F.col("_here"))).over(whole)
    return levels.withColumn("_here", here).withColumn("_final", final) \
        .select("source", "_name", "source_size", F.when(F.col("_final").isNull() | (F.col("_level") < F.col("_final")),
                                                F.col("_cap").cast("double"))
                .otherwise(F.col("_final") * F.col("_w")).alias("target"))


def mix(docs: DataFrame, size: Column | None = None, weights=WEIGHTS, share: float = 1.0, max_epochs: int = 3,
        seed: int = 7, bucket_rows: int = 2_000) -> DataFrame:
    """How often the mix takes each document: (doc_id, source, size, source_size, target, epochs, taken).

    Every document has a random key, the hash of seed and ``doc_id``; within a
    source the order is by key.  A source is taken whole as often as it fits
    into its target, and once more up to the document at which the running sum
    of sizes comes nearest to what is left.  The running sum has two levels: a
    key range (its number grows with the table, about ``bucket_rows`` rows each
    even in the largest source) and the rows inside it, so no task ever holds a
    whole source.  Equal input gives equal output on any number of partitions.

    Null or blank text has size 0 and is taken 0 times; null ``source`` is a
    source of its own, null ``doc_id`` is keyed like the empty string; of rows
    that repeat a ``doc_id``, smaller ones come first.  An empty table
    gives an empty result.  Other columns are ignored.
    """
    return _decided(docs.select("doc_id", "source", "text"), size, weights, share, max_epochs, seed, bucket_rows) \
        .select("_row.doc_id", "_row.source", "size", "source_size", "target", "epochs",
                (F.col("epochs") * F.col("size")).cast("long").alias("taken"))


def mixed_documents(docs: DataFrame, size: Column | None = None, weights=WEIGHTS, share: float = 1.0,
                    max_epochs: int = 3, seed: int = 7, bucket_rows: int = 2_000) -> DataFrame:
    """The documents themselves, all columns, each as often as :func:`mix` takes it; one shuffle of the texts."""
    chosen = _decided(docs, size, weights, share, max_epochs, seed, bucket_rows).where("epochs > 0")
    return chosen.select("_row", F.explode(F.sequence(F.lit(1), F.col("epochs"))).alias("_epoch")).select("_row.*")


def _decided(docs: DataFrame, size: Column | None, weights, share: float, max_epochs: int, seed: int,
             bucket_rows: int) -> DataFrame:
    """_row (the whole row), size, source_size, target, epochs"""
    size = n_words(F.col("text")) if size is None else size
    bits = max(0, min(31, (docs.count() // bucket_rows).bit_length()))
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"))
    name = F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit(""))  # null too is a source, and joins like one
    bucket = F.shiftright(F.conv(F.substring("_key", 1, 8), 16, 10).cast("long"), 32 - bits)

    def keyed(*columns: Column) -> DataFrame:
        return docs.select(*columns, "source", size.cast("long").alias("size"), key.alias("_key"), name.alias("_name")) \
            .withColumn("_bucket", bucket)

    parts = keyed().groupBy("source", "_name", "_bucket").agg(F.sum("size").alias("_sum"))
    sizes = parts.groupBy("source", "_name").agg(F.sum("_sum").cast("long").alias("source_size"))
    ahead = Window.partitionBy("_name").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.withColumn("_ahead", F.coalesce(F.sum("_sum").over(ahead), F.lit(0))).select("_name", "_bucket", "_ahead")
    plan = offsets.join(source_targets(sizes, weights, share, max_epochs).drop("source"), "_name")
    inside = Window.partitionBy("_name", "_bucket").orderBy("_key", "size") \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = keyed(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")) \
        .withColumn("_run", F.sum("size").over(inside)).drop("source")
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    left = F.col("target") - F.col("_whole") * F.col("source_size")
    middle = F.col("_ahead") + F.col("_run") - F.col("size") / 2.0
    epochs = F.when(F.col("size") > 0, F.col("_whole") + (middle < left).cast("long")).otherwise(F.lit(0))
    return summed.join(plan, ["_name", "_bucket"]).withColumn("_whole", whole.cast("long")) \
        .select("_row", "size", "source_size", "target", epochs.cast("int").alias("epochs"))


ORACLE = r"""
WITH d AS (SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
                  md5('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS key FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, source_size * 3 AS cap,
             CASE (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3
                  WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight FROM s),
-- the rounds of sharing end at the one level l with sum(min(cap, weight * l)) = budget
h AS (SELECT a.source, a.source_size, a.cap, a.weight, a.cap / a.weight AS own,
             ((SELECT CAST(sum(source_size) AS DOUBLE) FROM w)
               - coalesce((SELECT sum(b.cap) FROM w b WHERE b.cap / b.weight < a.cap / a.weight), 0))
             / (SELECT sum(b.weight) FROM w b WHERE b.cap / b.weight >= a.cap / a.weight) AS here FROM w a),
f AS (SELECT max(here) FILTER (WHERE here <= own) AS l FROM h),
t AS (SELECT source, source_size, CASE WHEN l IS NULL OR own < l THEN CAST(cap AS DOUBLE) ELSE l * weight END AS target FROM h, f),
r AS (SELECT d.doc_id, d.size, t.source_size, t.target,
             CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size) ELSE 0 END AS whole,
             sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.size ROWS UNBOUNDED PRECEDING) - d.size / 2.0 AS middle
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       CAST(size * (whole + CASE WHEN middle < target - whole * source_size THEN 1 ELSE 0 END) AS BIGINT) AS taken FROM r
"""
