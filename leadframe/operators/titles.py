"""Job titles: department, seniority level, top-level tag, clean-up."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dictionaries as d
from ..functions.rules import bounded, first_match, matches
from ..functions.text import _c, collapse_ws, or_empty, py_strip
from .joins import lookup, pinned, spread_key

MIN_SCORE = 0.55


def owns_product(title) -> Column:
    return matches(title, d.PRODUCT_OWNER)


def owns_something_else(title) -> Column:
    """Process, data, design, test or service owner: not a company owner."""
    return matches(title, d.OTHER_OWNER)


def is_vice_president(title) -> Column:
    return matches(title, d.VICE_PRESIDENT)


def _is_c_suite(title) -> Column:
    return matches(title, d.C_SUITE) & ~owns_product(title) & ~owns_something_else(title)


def department(title) -> Column:
    """Department of a normalized title, NULL when no rule applies."""
    t = _c(title)
    engineering, people, law = "engineering & technical", "human resources & hr", "legal & law"
    analyst = t.contains("analyst") | t.contains("analytics")
    top = (matches(t, d.C_SUITE) | is_vice_president(t)) & ~owns_product(t) & ~owns_something_else(t)
    specific = [
        (matches(t, d.CUSTOMER_SUCCESS), "sales"),
        (matches(t, d.E_COMMERCE_TITLE), "e-commerce"),
        (matches(t, d.DEVELOPER_RELATIONS), "marketing"),
        (matches(t, d.PRE_SALES), "sales"),
        (matches(t, d.ARCHITECT), engineering),
        (matches(t, d.QA_SOFTWARE), engineering),
        (matches(t, d.QA_OPERATIONS), "operations"),
        (matches(t, f"{d.TECH_PROGRAM_MANAGER}|{d.IT_PROJECT_MANAGER}"), engineering),
        (matches(t, d.PROJECT_MANAGER), "operations"),
        (matches(t, d.HUMAN_RESOURCES), people),
        (matches(t, f"{d.LEGAL}|{d.COMPLIANCE}"), law),
        (matches(t, d.SALES_OPERATIONS), "sales"),
        (matches(t, d.SALESFORCE_TECH), engineering),
        (matches(t, d.SUPPORT), "operations"),
        (analyst & matches(t, d.MARKETING_ANALYTICS), "marketing"),
        (analyst, engineering),
        (matches(t, d.OPERATIONS_EXTRA), "operations"),
        (top, "c-suite"),
    ]
    general = [(matches(t, bounded(words)), label) for label, words in d.DEPARTMENT_WORDS]
    return first_match(specific + general)


def level(title) -> Column:
    """Seniority level of a normalized title, '' when no rule applies."""
    t = _c(title)
    rules = [
        (matches(t, d.EXECUTIVE_ASSISTANT), "mid"),
        (_is_c_suite(t), "c-suite"),
        (is_vice_president(t), "executive"),
    ]
    rules += [(matches(t, bounded(words)), label) for label, words in d.LEVEL_WORDS]
    return first_match(rules, "")


def c_level_tag(title, label_map: dict[str, str] | None = None) -> Column:
    """Top-level tag or NULL.  ``label_map={"CSO": "CMO"}`` files strategy
    officers under marketing, as the original rule list did."""
    renamed = label_map or {}
    t = _c(title)
    product = F.coalesce(F.lower(t).contains("product owner"), F.lit(False))
    tags = [(matches(t, pattern), renamed.get(tag, tag)) for tag, pattern in d.C_LEVEL_TAGS]
    return first_match([(product, None)] + tags)


def best_label(scores: DataFrame, key: str, label: str = "label", score: str = "score",
               min_score: float = MIN_SCORE) -> DataFrame:
    """Highest-scoring label per key; below the threshold it is ``other``.

    Ties go to the alphabetically last label, so reruns agree.
    """
    top = scores.groupBy(key).agg(F.max(F.struct(F.col(score), F.col(label))).alias("_top"))
    weak = F.col(f"_top.{score}") < min_score
    return top.select(
        key,
        F.when(weak, F.lit("other")).otherwise(F.col(f"_top.{label}")).alias("label"),
        F.col(f"_top.{score}").alias("score"),
    )


def classify_titles(titles: DataFrame, cache: DataFrame | None = None,
                    scores: DataFrame | None = None, title: str = "title",
                    row_id: str = "row_idx") -> DataFrame:
    """Department, score and level per row: rules, then cache, then model.

    ``cache`` has ``title_norm, label, score``; ``scores`` holds landed model
    scores ``title_norm, label, score``.  Cache and model are merged into one
    table first, so the rows cross the network once, and only rows that no rule
    settled look anything up.
    """
    staged = titles.withColumn("title_norm", collapse_ws(title)) \
        .withColumn("_rule", F.when(F.col("title_norm") != "", department("title_norm")))
    answers = None
    if cache is not None:
        answers = cache.select("title_norm", "label", "score")
    if scores is not None:
        model = best_label(scores, "title_norm")
        if answers is None:
            answers = model
        else:
            cached = answers.select("title_norm", F.struct("label", "score").alias("_hit"))
            answers = model.join(cached, "title_norm", "full").select(
                "title_norm",
                F.coalesce("_hit.label", "label").alias("label"),
                F.coalesce("_hit.score", "score").alias("score"),
            )
    if answers is not None:
        open_row = F.col("_rule").isNull() & (F.col("title_norm") != "")
        key = spread_key(open_row, F.col("title_norm"), F.col(row_id))
        renamed = answers.select(F.col("title_norm").alias("_t"),
                                 F.struct("label", "score").alias("_answer"))
        staged = lookup(staged, renamed, key, "_t", ["_answer"], row_id,
                        counted=F.col("title_norm"))
    else:
        staged = staged.withColumn("_answer", F.lit(None).cast("struct<label:string,score:double>"))
    by_rule = F.col("_rule").isNotNull()
    blank = F.col("title_norm") == ""
    return staged.select(
        *[c for c in titles.columns],
        F.when(blank, F.lit("")).when(by_rule, F.col("_rule"))
        .otherwise(F.col("_answer.label")).alias("category"),
        F.when(blank, F.lit(0.0)).when(by_rule, F.lit(1.0))
        .otherwise(F.col("_answer.score")).alias("score"),
        level("title_norm").alias("level"),
    )


def tag_positions(positions: DataFrame, renames: DataFrame, title: str = "title",
                  row_id: str = "row_idx") -> DataFrame:
    """Blank -> ``empty``; tag by rule; else the landed rename, else ``error``.

    ``renames`` has one row per ``title`` with the model's ``renamed`` text.
    """
    staged = positions.withColumn("_t", py_strip(or_empty(title))) \
        .withColumn("_tag", F.when(F.col("_t") == "", F.lit("empty")).otherwise(c_level_tag("_t")))
    key = spread_key(F.col("_tag").isNull(), F.col("_t"), F.col(row_id))
    table = renames.select(F.col("title").alias("_rt"), py_strip("renamed").alias("_renamed"))
    joined = lookup(staged, table, key, "_rt", ["_renamed"], row_id, counted=F.col("_t"))
    return joined.select(
        *positions.columns, F.coalesce("_tag", "_renamed", F.lit("error")).alias("position_tag"))


def simplify_titles(df: DataFrame, title: str, out: str = "short_title") -> DataFrame:
    """Short form for correspondence: no symbols, one role, no company."""
    text = F.regexp_replace(or_empty(title), r"[\p{So}\p{Sk}\p{Cn}\x{fe0f}]", "")
    first_role = F.regexp_extract(collapse_ws(text), r"^([^/|&,]*)", 1)
    role = py_strip(F.regexp_replace(first_role, r"(?i)\s+(?:at|in|@)\s+.*$", ""))
    chief = first_match([
        (matches("_role", rf"^chief\s+of\s+(?:{area})\b"), short) for area, short in d.CHIEF_OF])
    return df.withColumn("_role", role) \
        .withColumn(out, F.coalesce(chief, F.nullif("_role", F.lit("")), collapse_ws(title))) \
        .drop("_role")


def unresolved_titles(titles: DataFrame, cache: DataFrame, title: str = "title") -> DataFrame:
    """Distinct titles that neither a rule nor the cache settles."""
    norm = titles.select(collapse_ws(title).alias("title_norm")).distinct()
    ruled = pinned(norm, "_rule", F.when(F.col("title_norm") == "", F.lit("")).otherwise(department("title_norm")))
    todo = ruled.where(F.col("_rule").isNull()).select("title_norm")
    return todo.join(cache.select("title_norm"), "title_norm", "left_anti")
