"""File layouts written and read back, and the incremental run."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import collapse_ws
from ..operators import titles
from ..session import scratch_path
from ..sources import files, snapshots
from ..streaming import incremental
from .fixtures import cte, frame
from .registry import TWINS, query
from .text_queries import payload_to_columns_company

_SUPPLIER = """SELECT CAST(s_suppkey AS varchar) AS "key", s_name AS "name", 'a, "b"; c' AS "note" FROM supplier"""


def _suppliers(spark, sf):
    return frame(spark, sf, "supplier").select(
        F.col("s_suppkey").cast("string").alias("key"), F.col("s_name").alias("name"),
        F.lit('a, "b"; c').alias("note"))


def _round_trip(spark, df, sep, header=True, mark=False):
    path = scratch_path(spark, "delimited")
    columns = df.columns
    if mark:  # a byte-order mark in front of the first header name
        renamed = df.withColumnRenamed(columns[0], "\ufeff" + columns[0])
        files.write_delimited(renamed, path, renamed.columns, sep)
    else:
        df.write.option("header", header).option("sep", sep).option("escape", '"').csv(path)
    return files.read_delimited(spark, path, columns, sep, header)


@query("src_csv_header", _SUPPLIER)
def src_csv_header(spark, sf):
    return _round_trip(spark, _suppliers(spark, sf), ",", mark=True)


@query("src_tsv", _SUPPLIER)
def src_tsv(spark, sf):
    return _round_trip(spark, _suppliers(spark, sf), "\t")


_LAYOUTS = """SELECT CAST(s_suppkey AS varchar) AS "key", CASE WHEN s_suppkey % 3 < 2 THEN s_name END AS "name",
    CASE s_suppkey % 3 WHEN 0 THEN 'line ' || s_suppkey || chr(10) || 'a, "b"; c' WHEN 2 THEN 'two' END AS "note",
    CASE WHEN s_suppkey % 3 = 1 THEN CAST(s_nationkey AS varchar) END AS "extra column" FROM supplier"""


def _delivered(spark, sf, sep):
    """Suppliers in files of three layouts: other order, a further column, a missing one; cells with line breaks."""
    path = scratch_path(spark, "layouts")
    rows = frame(spark, sf, "supplier").select(F.col("s_suppkey").cast("string").alias("key"), F.col("s_name").alias("name"), "s_suppkey",
                                               F.col("s_nationkey").cast("string").alias("extra column"))
    broken = F.concat(F.lit("line "), "key", F.lit('\na, "b"; c'))
    layouts = (rows.where("s_suppkey % 3 = 0").select("key", "name", broken.alias("note")),
               rows.where("s_suppkey % 3 = 1").select("extra column", "name", "key"),
               rows.where("s_suppkey % 3 = 2").select(F.lit("two").alias("note"), "key"))
    for part in layouts:
        files.write_delimited(part, path, part.columns, sep, mode="append")
    return files.read_delimited(spark, path, ("key", "name", "note"), sep, multi_line=True)


@query("src_csv_layouts", _LAYOUTS)
def src_csv_layouts(spark, sf):
    return _delivered(spark, sf, ",")


@query("src_tsv_layouts", _LAYOUTS)
def src_tsv_layouts(spark, sf):
    return _delivered(spark, sf, "\t")


@query("src_csv_noheader", "SELECT s_name AS username FROM supplier")
def src_csv_noheader(spark, sf):
    names = _suppliers(spark, sf).select(F.col("name").alias("username"))
    return _round_trip(spark, names, ",", header=False)


@query("src_url_list", "SELECT url FROM pages")
def src_url_list(spark, sf):
    path = scratch_path(spark, "urls")
    pages = frame(spark, sf, "pages")
    word = F.when(F.col("page_id") % 2 == 0, F.lit("URL")).otherwise(F.lit(" url "))
    listed = pages.select(F.explode(F.array(F.col("url"), word, F.lit(" "))).alias("url"))
    listed.write.option("header", False).csv(path)
    return files.read_url_list(spark, path)


@query("src_jsonl_tolerant", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS bigint) AS k FROM events WHERE user_id % 5 <> 0")
def src_jsonl_tolerant(spark, sf):
    path = scratch_path(spark, "jsonl")
    events = frame(spark, sf, "events")
    line = F.concat(F.lit('{"id": '), "event_id", F.lit(', "props": '), "props", F.lit("}"))
    broken = F.when(F.col("user_id") % 5 != 0, line).when(F.col("user_id") % 10 == 0, F.lit("")) \
        .otherwise(F.concat(line, F.lit(", oops")))
    events.select(broken.alias("value")).write.text(path)
    return files.read_jsonl(spark, path).select(
        F.try_variant_get("item", "$.id", "bigint").alias("event_id"),
        F.try_variant_get("item", "$.props.k", "bigint").alias("k"))


@query("page_urls", """SELECT n_nationkey, page_no, 'https://list' || n_nationkey || '.example.com/?page=' || page_no AS url
    FROM (SELECT n_nationkey, unnest(range(1, pages + 1)) AS page_no FROM
      (SELECT s_nationkey AS n_nationkey, count(*) AS pages FROM supplier GROUP BY 1))""")
def page_urls(spark, sf):
    sites = frame(spark, sf, "supplier").groupBy(F.col("s_nationkey").alias("n_nationkey")).agg(F.count("*").alias("pages"))
    base = F.concat(F.lit("https://list"), F.col("n_nationkey").cast("string"), F.lit(".example.com/?page="))
    return files.page_urls_of(sites, base, "pages", F.lit(1).cast("bigint")).drop("pages")


def _written(spark, df, sep):
    path = scratch_path(spark, "sink")
    files.write_delimited(df, path, df.columns, sep)
    back = files.read_delimited(spark, path, df.columns, sep)
    return back.select(*[F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in df.columns])


@query("sink_csv", TWINS["payload_to_columns_company"])
def sink_csv(spark, sf):
    return _written(spark, payload_to_columns_company(spark, sf), ",")


@query("sink_csv_semicolon", TWINS["payload_to_columns_company"])
def sink_csv_semicolon(spark, sf):
    return _written(spark, payload_to_columns_company(spark, sf), ";")


@query("sink_jsonl_append", "SELECT doc_id, lang, text FROM documents UNION ALL SELECT page_id, 'html', url FROM pages")
def sink_jsonl_append(spark, sf):
    path = scratch_path(spark, "append")
    files.write_jsonl(frame(spark, sf, "documents").select("doc_id", "lang", "text"), path)
    pages = frame(spark, sf, "pages")
    files.write_jsonl(pages.select(F.col("page_id").alias("doc_id"), F.lit("html").alias("lang"),
                                   F.col("url").alias("text")), path)
    return files.read_jsonl(spark, path).select(
        F.try_variant_get("item", "$.doc_id", "bigint").alias("doc_id"),
        F.try_variant_get("item", "$.lang", "string").alias("lang"),
        F.try_variant_get("item", "$.text", "string").alias("text"))


@query("sink_json_rewrite", "SELECT doc_id, lang, text FROM documents")
def sink_json_rewrite(spark, sf):
    """A JSON file of all records so far, rewritten after each of three deliveries."""
    path = scratch_path(spark, "rewrite")
    rows = frame(spark, sf, "documents").select("doc_id", "lang", "text")
    for i in range(3):
        so_far = snapshots.read(spark, path, rows.schema, "json")
        snapshots.replace(so_far.unionByName(rows.where(F.col("doc_id") % 3 == i)), path, form="json")
    return snapshots.read(spark, path, rows.schema, "json")


def _labelled(df):
    return df.select("row_idx", titles.department(collapse_ws("title")).alias("department"),
                     titles.level(collapse_ws("title")).alias("level"))


def _stream_twin():
    from .title_queries import _DEPARTMENT, _LEVEL, _norm

    return cte("titles") + f"SELECT row_idx, {_DEPARTMENT} AS department, {_LEVEL} AS level FROM {_norm()}"


@query("stream_classify", _stream_twin())
def stream_classify(spark, sf):
    """Two deliveries of files, one run after each; nothing is labelled twice."""
    base = scratch_path(spark, "stream")
    rows = frame(spark, sf, "titles")
    for part in (rows.where(F.col("title").like("%e%")), rows.where(~F.col("title").like("%e%"))):
        part.write.mode("append").parquet(f"{base}/in")
        incremental.run_available(spark, f"{base}/in", rows.schema, _labelled, f"{base}/out", f"{base}/state")
    return spark.read.parquet(f"{base}/out")


@query("stream_upsert", """SELECT user_id, event_id, event_type, value FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS n FROM events) WHERE n = 1""")
def stream_upsert(spark, sf):
    """The last event of every user, from two deliveries; the second is replayed once it is in."""
    base = scratch_path(spark, "upserts")
    rows = frame(spark, sf, "events").select("user_id", "event_id", "event_type", "value")
    arrived = (rows.where(F.col("event_id") % 3 != 0), rows.where(F.col("event_id") % 3 == 0))
    for part in arrived:
        part.write.mode("append").parquet(f"{base}/in")
        incremental.run_upserts(spark, f"{base}/in", rows.schema, lambda df: df, f"{base}/out", f"{base}/state", "user_id", "event_id")
    wrong = arrived[1].withColumn("event_id", F.col("event_id") + 10**9)  # would show, were batch 1 added again
    assert not incremental.upsert_batch(wrong, 1, f"{base}/out", "user_id", "event_id", f"{base}/state")
    return snapshots.read(spark, f"{base}/out")
