"""Enrichment from landed lookup tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import is_blank, py_strip
from ..sources import snapshots
from .joins import lookup, spread_key

_PERSON = ("organization_name", "first_name", "last_name")


def _person_key(prefix: str = ""):
    return F.concat_ws("\x1f", *[py_strip(prefix + c) for c in _PERSON])


def enrich_email(people: DataFrame, found: DataFrame, row_id: str) -> DataFrame:
    """E-mail, confidence and status per person; blanks where a name is missing.

    ``found`` has one row per organisation, first and last name.  People with a
    missing name are never looked up, and do not pile up on one key either.
    """
    complete = ~is_blank("organization_name") & ~is_blank("first_name") & ~is_blank("last_name")
    table = found.select(
        _person_key().alias("_person"),
        F.struct("email", F.col("confidence_score").cast("string").alias("confidence_score"),
                 "mail_status").alias("_hit"))
    key = spread_key(complete, _person_key(), F.col(row_id))
    joined = lookup(people, table, key, "_person", ["_hit"], row_id)
    filled = [F.coalesce(f"_hit.{c}", F.lit("")).alias(c)
              for c in ("email", "confidence_score", "mail_status")]
    return joined.select(*people.columns, *filled)


def enrich_company_email(companies: DataFrame, found: DataFrame, row_id: str) -> DataFrame:
    """First e-mail of the company's landed list replaces ``email``."""
    first = found.select(F.col("name").alias("_company"),
                         F.get("emails", F.lit(0))["value"].alias("email"))
    key = spread_key(~is_blank("name"), F.col("name"), F.col(row_id))
    return lookup(companies.drop("email"), first, key, "_company", ["email"], row_id)


def verify_email(people: DataFrame, statuses: DataFrame, row_id: str) -> DataFrame:
    """Verification status per e-mail, NULL when it was never checked."""
    key = spread_key(~is_blank("email"), F.col("email"), F.col(row_id))
    table = statuses.select(F.col("email").alias("_address"), F.col("status").alias("mail_status"))
    return lookup(people, table, key, "_address", ["mail_status"], row_id)


def cache_probe(titles: DataFrame, cache: DataFrame, key: str = "title_norm") -> DataFrame:
    """Distinct keys with their cached answer and a hit flag."""
    wanted = titles.select(key).distinct()
    hits = cache.select(key, "label", "score", F.lit(True).alias("_hit"))
    return wanted.join(hits, key, "left").select(
        key, "label", "score", F.coalesce("_hit", F.lit(False)).alias("hit"))


def cache_additions(answers: DataFrame, cache: DataFrame, key: str = "title_norm") -> DataFrame:
    """Answers whose key the cache does not hold yet, once per key."""
    fresh = answers.groupBy(key).agg(F.max(F.struct("score", "label")).alias("_best")) \
        .select(key, F.col("_best.label").alias("label"), F.col("_best.score").alias("score"))
    return fresh.join(cache.select(key), key, "left_anti")


def persist_cache(answers: DataFrame, path: str, key: str = "title_norm") -> DataFrame:
    """Add answers to the cache kept at ``path`` and replace it; the new cache.

    A key keeps the answer it has.  Readers see the old cache until the new one
    is complete, also if the write fails.  Without new keys nothing is written.
    """
    spark = answers.sparkSession
    schema = answers.select(key, "label", "score").schema
    cache = snapshots.read(spark, path, schema)
    fresh = cache_additions(answers, cache, key).select(key, "label", "score")
    if snapshots.current(spark, path) and fresh.isEmpty():
        return cache
    return snapshots.replace(cache.select(key, "label", "score").unionByName(fresh), path)
