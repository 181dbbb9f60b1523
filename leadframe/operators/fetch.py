"""Choosing among landed fetch attempts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import is_blank
from ..session import materialize
from .joins import might_be_in, pinned

# The order in which fetchers are tried.
THREE_STAGES = ("requests", "selenium", "brightdata")


def has_html(html: str = "html") -> Column:
    """Default rule: any page text ends the chain."""
    return ~is_blank(html)


def answered(status: str = "status", html: str = "html") -> Column:
    """A 200 ends the chain even when the page is empty.

    A fetcher that reports no status has answered when it brought a page.
    """
    return F.coalesce(F.col(status) == 200, has_html(html))


def failed_or_has_html(status: str = "status", html: str = "html") -> Column:
    """Only an empty 200 is retried; an error status is final."""
    return ~answered(status, html) | has_html(html)


def first_settled(attempts: DataFrame, stages=THREE_STAGES, settled: Column | None = None,
                  key: str = "url", payload: tuple[str, ...] = ("html",)) -> DataFrame:
    """First attempt per URL that settles it, else NULL payload and source ''.

    The choice is made on narrow facts, one aggregation over one scan, and
    written; the payload is read a second time, where a Bloom filter of the choice
    leaves out the attempts that lost, and joined to it.  Of several attempts
    of one source at a URL the one with the least payload hash counts.  This is
    for page bodies; when a page is reduced to a few columns first,
    :func:`first_settled_facts` alone is better.
    """
    marked = attempts.withColumn("_pick", F.xxhash64(*payload))
    best = materialize(first_settled_facts(marked, stages, settled, key, payload=("_pick",)).select(
        F.col(key).alias("_key"), F.col("_pick").alias("_best"), F.col("source").alias("_stage")), "settled")
    bodies = attempts.where(F.col("source").isin(*stages)) \
        .where(might_be_in([key, "source", F.xxhash64(*payload)], best, ["_key", "_stage", "_best"])) \
        .select(F.col(key).alias("_k"), F.col("source").alias("_s"), *payload, F.xxhash64(*payload).alias("_p"))
    joined = best.join(bodies, (F.col("_key") == F.col("_k")) & (F.col("_stage") == F.col("_s")) & (F.col("_best") == F.col("_p")),
                       "left")
    return joined.select(F.col("_key").alias(key), *payload, F.col("_stage").alias("source")).dropDuplicates([key])


def first_settled_facts(attempts: DataFrame, stages=THREE_STAGES, settled: Column | None = None,
                        key: str = "url", payload: tuple[str, ...] = ()) -> DataFrame:
    """Like :func:`first_settled` for a few columns computed from the page.

    Every attempt is evaluated once and becomes one narrow value where it is
    read; the smallest stage per URL is found by one aggregation.
    """
    settled = has_html() if settled is None else settled
    rank = F.coalesce(*[F.when(F.col("source") == s, F.lit(i)) for i, s in enumerate(stages)])
    fact = F.when(settled, F.struct(rank.alias("_rank"), *payload, "source"))
    tried = attempts.where(F.col("source").isin(*stages))
    best = pinned(tried, "_fact", fact).select(key, "_fact").groupBy(key).agg(F.min("_fact").alias("_fact"))
    return best.select(key, *[F.col(f"_fact.{c}").alias(c) for c in payload],
                       F.coalesce("_fact.source", F.lit("")).alias("source"))
