"""Fit scores: employee band, revenue steps, weighted total, offline rubric."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dictionaries as d
from ..functions.payload import join_reasons, strict_json
from ..functions.rules import any_match, matched_names
from ..functions.text import _c, is_blank, or_empty, parse_int


def size_score(band) -> Column:
    """Exact employee band to points, 0 for anything else."""
    pairs = [F.lit(x) for pair in d.EMPLOYEE_BANDS.items() for x in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), _c(band)), F.lit(0))


def stepped(value, steps, otherwise: int, ascending: bool = False) -> Column:
    """Points of the first step reached: ``>=`` going down, ``<=`` going up."""
    chain = F
    for threshold, points in steps:
        reached = value <= threshold if ascending else value >= threshold
        chain = chain.when(reached, F.lit(points))
    return F.when(value.isNull(), F.lit(0)).otherwise(chain.otherwise(F.lit(otherwise)))


def revenue_score(revenue) -> Column:
    """Revenue text to points; 0 when it is not an integer."""
    return stepped(parse_int(revenue), d.REVENUE_STEPS, 1)


def retired_rank_score(rank) -> Column:
    """Older scale: a smaller site rank earns more points."""
    return stepped(parse_int(F.replace(_c(rank), F.lit(","), F.lit(""))),
                   d.RETIRED_RANK_STEPS, 2, ascending=True)


def retired_revenue_score(revenue) -> Column:
    return stepped(parse_int(revenue), d.RETIRED_REVENUE_STEPS, 3)


def scrape_failed(reasons, markers=d.SCRAPE_FAILED) -> Column:
    return F.coalesce(F.lower(_c(reasons)).rlike("|".join(markers)), F.lit(False))


def score_exhibitors(rows: DataFrame, answers: DataFrame, style: str = "comma") -> DataFrame:
    """Weighted total per domain.

    ``rows``: ``domain, alexa_rank, revenue, description``; ``answers``: one row
    per domain with the landed JSON text ``answer``.  A missing description
    scores -1, an unreadable answer 0; a row is never dropped, the ``error``
    column says what was wrong.
    """
    markers = d.SCRAPE_FAILED if style == "comma" else d.SCRAPE_FAILED_SHORT
    table = answers.select("domain", strict_json("answer").alias("_json"))
    joined = rows.join(table, "domain", "left")
    described = ~is_blank("description")
    unreadable = described & F.col("_json").isNull()
    landed = F.coalesce(F.try_variant_get("_json", "$.reasons", "array<string>"),
                        F.array().cast("array<string>"))
    staged = joined.select(
        *rows.columns,
        F.when(described, landed).otherwise(F.array(F.lit("no_description"))).alias("_reasons"),
        F.when(described, F.coalesce(F.try_variant_get("_json", "$.score", "bigint"), F.lit(0)))
        .otherwise(F.lit(-1)).alias("_score"),
        F.when(described, F.coalesce(F.try_variant_get("_json", "$.exhibitor_type", "string"),
                                     F.lit("N/A"))).otherwise(F.lit("")).alias("exhibitor_type"),
        F.when(unreadable, F.lit("unreadable answer")).alias("error"),
        size_score("alexa_rank").cast("bigint").alias("size_score"),
        revenue_score("revenue").cast("bigint").alias("revenue_score"),
    ).withColumn("reasons", join_reasons("_reasons", style)) \
        .withColumn("llm_score", F.when(scrape_failed("reasons", markers), F.lit(-1))
                    .otherwise(F.col("_score")).cast("bigint"))
    weight = 60 + F.when(F.col("size_score") > 0, 10).otherwise(0) \
        + F.when(F.col("revenue_score") > 0, 10).otherwise(0)
    points = F.col("llm_score") + F.col("size_score") + F.col("revenue_score")
    total = F.when(F.col("llm_score") == -1, F.lit(-1.0)) \
        .otherwise(F.round((points * 100).cast("double") / weight, 2))
    return staged.withColumn("total_score", total).select(
        "domain", "llm_score", "size_score", "revenue_score", "total_score", "reasons",
        "exhibitor_type", "error")


def fit_rubric(df: DataFrame, text: str) -> DataFrame:
    """Offline stand-in for a model score: 50 category, 5 B2B, 5 innovation."""
    low = df.withColumn("_low", F.lower(or_empty(text)))
    category = F.coalesce(F.get(matched_names("_low", d.FIT_CATEGORIES), F.lit(0)), F.lit("other"))
    scored = low.select(*df.columns, category.alias("exhibitor_type"),
                        any_match("_low", [d.FIT_B2B]).alias("_b2b"),
                        any_match("_low", [d.FIT_INNOVATION]).alias("_new"))
    points = F.when(F.col("exhibitor_type") != "other", 50).otherwise(0) \
        + F.when(F.col("_b2b"), 5).otherwise(0) + F.when(F.col("_new"), 5).otherwise(0)
    return scored.withColumn("fit_score", points.cast("bigint")).drop("_b2b", "_new")
