"""Job-title queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dictionaries as d
from ..functions.text import collapse_ws
from ..operators import enrich, infer, titles
from ..session import scratch_path
from ..sources import snapshots
from . import twin as q
from .fixtures import cte, frame
from .registry import query

# The checking engine has no look-around: blank out the excluded spellings first.
_NO_PRODUCT_OWNER = q.sub("t", r"(?i)product\s(owner)", "~")
_NO_PM_S = q.sub("t", r"(?i)\bpm.s\b", "~")
_CSUITE = q.has(_NO_PRODUCT_OWNER, d.C_SUITE.replace(r"(?<!product\s)", ""))
_PRODUCT = q.has("t", d.PRODUCT_OWNER)
_OTHER = q.has("t", d.OTHER_OWNER)
_VP = q.has("t", d.VICE_PRESIDENT)


def _words(words) -> str:
    text = "t"
    plain = []
    for word in words:
        if "(?!" in word:
            text, word = _NO_PM_S, word.split("(?!")[0]
        plain.append(word)
    return q.has(text, "(?:^|[^a-zA-Z])(?:" + "|".join(plain) + ")(?:[^a-zA-Z]|$)")


def _norm(table: str = "titles") -> str:
    return f"(SELECT row_idx, {q.collapse('title')} AS t FROM {table})"


_DEPARTMENT = f"""CASE
    WHEN {q.has('t', d.CUSTOMER_SUCCESS)} THEN 'sales'
    WHEN {q.has('t', d.E_COMMERCE_TITLE)} THEN 'e-commerce'
    WHEN {q.has('t', d.DEVELOPER_RELATIONS)} THEN 'marketing'
    WHEN {q.has('t', d.PRE_SALES)} THEN 'sales'
    WHEN {q.has('t', d.ARCHITECT)} OR {q.has('t', d.QA_SOFTWARE)} THEN 'engineering & technical'
    WHEN {q.has('t', d.QA_OPERATIONS)} THEN 'operations'
    WHEN {q.has('t', d.TECH_PROGRAM_MANAGER)} OR {q.has('t', d.IT_PROJECT_MANAGER)} THEN 'engineering & technical'
    WHEN {q.has('t', d.PROJECT_MANAGER)} THEN 'operations'
    WHEN {q.has('t', d.HUMAN_RESOURCES)} THEN 'human resources & hr'
    WHEN {q.has('t', d.LEGAL)} OR {q.has('t', d.COMPLIANCE)} THEN 'legal & law'
    WHEN {q.has('t', d.SALES_OPERATIONS)} THEN 'sales'
    WHEN {q.has('t', d.SALESFORCE_TECH)} THEN 'engineering & technical'
    WHEN {q.has('t', d.SUPPORT)} THEN 'operations'
    WHEN contains(t, 'analyst') OR contains(t, 'analytics') THEN
      CASE WHEN {q.has('t', d.MARKETING_ANALYTICS)} THEN 'marketing' ELSE 'engineering & technical' END
    WHEN {q.has('t', d.OPERATIONS_EXTRA)} THEN 'operations'
    WHEN NOT {_PRODUCT} AND NOT {_OTHER} AND ({_CSUITE} OR {_VP}) THEN 'c-suite'
    {' '.join(f"WHEN {_words(w)} THEN {q.lit(label)}" for label, w in d.DEPARTMENT_WORDS)}
    END"""

_LEVEL = f"""CASE
    WHEN {q.has('t', d.EXECUTIVE_ASSISTANT)} THEN 'mid'
    WHEN NOT {_PRODUCT} AND NOT {_OTHER} AND {_CSUITE} THEN 'c-suite'
    WHEN {_VP} THEN 'executive'
    {' '.join(f"WHEN {_words(w)} THEN {q.lit(label)}" for label, w in d.LEVEL_WORDS)}
    ELSE '' END"""

_TAG = f"""CASE WHEN contains(lower(t), 'product owner') THEN NULL
    {' '.join(f"WHEN {q.has('t', p)} THEN {q.lit(tag)}" for tag, p in d.C_LEVEL_TAGS)} END"""

_BEST = """(SELECT title_norm, CASE WHEN max(score) < 0.55 THEN 'other' ELSE arg_max(label, score) END AS label,
    max(score) AS score FROM title_scores GROUP BY title_norm)"""


def _titles(spark, sf):
    return frame(spark, sf, "titles")


@query("title_flags", cte("titles") + f"""
    SELECT row_idx, {_PRODUCT} AS product_owner, {_OTHER} AS other_owner, {_VP} AS vice_president FROM {_norm()}""")
def title_flags(spark, sf):
    return _titles(spark, sf).withColumn("t", collapse_ws("title")).select(
        "row_idx", titles.owns_product("t").alias("product_owner"),
        titles.owns_something_else("t").alias("other_owner"),
        titles.is_vice_president("t").alias("vice_president"))


@query("classify_title", cte("titles") + f"SELECT row_idx, {_DEPARTMENT} AS department FROM {_norm()}")
def classify_title(spark, sf):
    return _titles(spark, sf).withColumn("t", collapse_ws("title")) \
        .select("row_idx", titles.department("t").alias("department"))


@query("classify_level", cte("titles") + f"SELECT row_idx, {_LEVEL} AS level FROM {_norm()}")
def classify_level(spark, sf):
    return _titles(spark, sf).withColumn("t", collapse_ws("title")) \
        .select("row_idx", titles.level("t").alias("level"))


@query("c_level_tag", cte("titles") + f"""
    SELECT row_idx, {_TAG} AS tag, CASE WHEN {_TAG} = 'CSO' THEN 'CMO' ELSE {_TAG} END AS legacy_tag
    FROM (SELECT row_idx, title AS t FROM titles)""")
def c_level_tag(spark, sf):
    return _titles(spark, sf).select(
        "row_idx", titles.c_level_tag("title").alias("tag"),
        titles.c_level_tag("title", {"CSO": "CMO"}).alias("legacy_tag"))


@query("argmax_label", cte("title_scores") + f"SELECT title_norm, label, score FROM {_BEST}")
def argmax_label(spark, sf):
    return titles.best_label(frame(spark, sf, "title_scores"), "title_norm")


@query("classify_title_cascade", cte("titles", "label_cache", "title_scores") + f"""
    SELECT row_idx, CASE WHEN t = '' THEN '' ELSE coalesce(dep, c.label, m.label) END AS category,
      CASE WHEN t = '' THEN 0.0::double WHEN dep IS NOT NULL THEN 1.0::double ELSE coalesce(c.score, m.score) END AS score,
      {_LEVEL} AS level
    FROM (SELECT row_idx, t, {_DEPARTMENT} AS dep FROM {_norm()}) AS r
    LEFT JOIN label_cache AS c ON c.title_norm = t LEFT JOIN {_BEST} AS m ON m.title_norm = t""")
def classify_title_cascade(spark, sf):
    return titles.classify_titles(
        _titles(spark, sf), frame(spark, sf, "label_cache"), frame(spark, sf, "title_scores")
    ).select("row_idx", "category", "score", "level")


@query("position_tag_cascade", cte("titles", "renames") + f"""
    SELECT row_idx, CASE WHEN t = '' THEN 'empty' ELSE coalesce({_TAG}, trim(renamed), 'error') END AS position_tag
    FROM (SELECT row_idx, trim(title) AS t FROM titles) AS r LEFT JOIN renames ON renames.title = t""")
def position_tag_cascade(spark, sf):
    return titles.tag_positions(_titles(spark, sf), frame(spark, sf, "renames")) \
        .select("row_idx", "position_tag")


_CHIEF = " ".join(
    rf"WHEN regexp_matches(role, '(?i)^chief\s+of\s+(?:{area})\b') THEN '{short}'" for area, short in d.CHIEF_OF)


@query("title_simplify", cte("titles") + rf"""
    SELECT row_idx, coalesce(CASE {_CHIEF} END,
      nullif(role, ''), t) AS short_title
    FROM (SELECT row_idx, t, trim(regexp_replace(regexp_extract(t, '^([^/|&,]*)', 1), '(?i)\s+(?:at|in|@)\s+.*$', '')) AS role
          FROM {_norm()})""")
def title_simplify(spark, sf):
    return titles.simplify_titles(_titles(spark, sf), "title").select("row_idx", "short_title")


@query("cache_probe", cte("titles_norm", "label_cache") + """
    SELECT t.title_norm, label, score, c.title_norm IS NOT NULL AS hit
    FROM titles_norm AS t LEFT JOIN label_cache AS c ON t.title_norm = c.title_norm""")
def cache_probe(spark, sf):
    wanted = _titles(spark, sf).select(collapse_ws("title").alias("title_norm"))
    return enrich.cache_probe(wanted, frame(spark, sf, "label_cache"))


@query("label_cache_update", cte("titles", "label_cache", "title_scores") + f"""
    SELECT title_norm, label, score FROM label_cache
    UNION ALL
    SELECT m.title_norm, label, score FROM {_BEST} AS m
    WHERE title_norm NOT IN (SELECT title_norm FROM label_cache)
      AND title_norm IN (SELECT t FROM {_norm()} WHERE {_DEPARTMENT} IS NULL)""")
def label_cache_update(spark, sf):
    cache = frame(spark, sf, "label_cache")
    todo = titles.unresolved_titles(_titles(spark, sf), cache)
    answers = titles.best_label(frame(spark, sf, "title_scores"), "title_norm") \
        .join(todo, "title_norm", "left_semi")
    return cache.unionByName(enrich.cache_additions(answers, cache))


def _answers(spark, sf):
    """The best landed answer of every title; those of the cache are answers too, but come too late."""
    return titles.best_label(frame(spark, sf, "title_scores"), "title_norm")


@query("cache_replace", cte("titles", "label_cache", "title_scores") + f"""
    SELECT title_norm, label, score FROM label_cache
    UNION ALL
    SELECT m.title_norm, label, score FROM {_BEST} AS m WHERE title_norm NOT IN (SELECT title_norm FROM label_cache)""")
def cache_replace(spark, sf):
    """A kept cache is read, added to and replaced twice."""
    path = scratch_path(spark, "cache")
    snapshots.replace(frame(spark, sf, "label_cache"), path)
    answers = _answers(spark, sf)
    for part in (F.length("title_norm") % 2 == 0, F.lit(True)):
        enrich.persist_cache(answers.where(part), path)
    return snapshots.read(spark, path)


@query("batch_infer", cte("titles") + f"""
    SELECT row_idx, t AS title_norm, CASE WHEN t <> '' THEN CASE WHEN length(t) > 20 THEN 'long' ELSE 'short' END END AS label,
      CASE WHEN t <> '' THEN length(t) / 100 END AS score FROM {_norm()}""")
def batch_infer(spark, sf):
    def length_model(texts):  # deterministic stand-in for a user's model
        return [("long" if len(t) > 20 else "short", len(t) / 100) for t in texts]

    norm = _titles(spark, sf).select("row_idx", collapse_ws("title").alias("title_norm"))
    return infer.batch_infer(norm, "title_norm", length_model, "row_idx")
