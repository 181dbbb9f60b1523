"""CRM pages, lookups, write-back, files and the incremental run."""

import json

import pytest
from pyspark.sql import functions as F

from leadframe.operators import crm, enrich, infer, joins, writeback
from leadframe.session import scratch_path, work_dir
from leadframe.sources import files
from leadframe.streaming import incremental


def test_companies(spark):
    schema = ("page_no int, accounts array<struct<name:string,primary_domain:string,founded_year:int>>,"
              "organizations array<struct<name:string,primary_domain:string,founded_year:int>>")
    rows = spark.createDataFrame([(1, [("A", "a.com", 1990)], None), (2, None, [("B", None, None)]), (3, None, None)], schema)
    got = crm.flatten_companies(rows).collect()
    assert [(r.name, r.domain, r.founded_year, r.phone) for r in got] == [("A", "a.com", "1990", ""), ("B", "", "", "")]
    assert got[0].__fields__ == [name for name, _ in crm.COMPANY_COLUMNS]


def test_deals(spark):
    page = {"success": True, "data": [
        {"id": 1, "person_id": {"name": "P", "email": [{"value": "p@x"}, {"value": "q@x"}]}, "org_id": {"name": "O", "address": "S"}},
        {"id": 2, "person_id": 7, "org_id": None}, {"id": 3, "person_id": {"name": "R", "email": []}}]}
    rows = spark.createDataFrame([
        (1, json.dumps(page)), (2, '{"success": true, "data": null}'), (3, '{"success": false}'),
        (4, json.dumps({"success": True, "data": [{"id": 9}]}))], "page_no int, payload string")
    got = {r.id: (r.person_name, r.person_email, r.org_name, r.org_address) for r in crm.flatten_deals(rows).collect()}
    assert got == {"1": ("P", "p@x", "O", "S"), "2": (None, None, None, None), "3": ("R", None, None, None),
                   "9": (None, None, None, None)}


def test_failed_pages_cost_no_others(spark):
    def page(load, no, ok):
        return load, no, json.dumps({"success": ok, "data": [{"id": f"{load}{no}"}]})
    rows = spark.createDataFrame([page("a", 1, True), page("a", 2, False), page("a", 3, True), page("b", 1, True), ("b", 2, "broken")],
                                 "load string, page_no int, payload string")
    assert {r.id for r in crm.flatten_deals(rows).collect()} == {"a1", "a3", "b1"}
    assert {tuple(r) for r in crm.failed_pages(rows, "load").collect()} == {("a", 3, 1), ("b", 2, 1)}


def test_prospects(spark):
    a = spark.createDataFrame([("1", "2025-03-02T00:00:00+0000", "x"), ("2", "bad", "y")], "id string, last_contacted string, extra string")
    b = spark.createDataFrame([("3", "2025-02-28T23:59:59+0000", 5), ("4", "2025-03-01T01:00:00+0100", 6)], "id string, last_contacted string, other int")
    got = crm.union_prospects([a, b], "2025-03-01T00:00:00+0000")
    assert got.columns == ["id", "last_contacted", "extra", "other"]
    assert {(r.id, r.extra, r.other) for r in got.collect()} == {("1", "x", None), ("4", None, 6)}


def test_widen(spark):
    rows = spark.createDataFrame([('[{"a": 1}, {"b": "x", "a": null}]',), ("{}",), ("bad",)], "payload string")
    assert {tuple(r)[1:] for r in crm.prospect_members(rows.selectExpr("1 AS p", "payload"), "p").collect()} == \
        {(0, "a", "1"), (1, "b", "x"), (1, "a", None)}
    got = crm.widen_prospects(rows, ["a", "b"])
    assert got.columns == ["a", "b"] and {(r.a, r.b) for r in got.collect()} == {("1", None), (None, "x")}


def test_search(spark):
    rows = spark.createDataFrame([
        ("Marketing Manager", "Berlin", 50, "verified", ["Ecommerce"]), ("SEO Marketing", "berlin", 50, "verified", ["x"]),
        ("Sales Manager", "Paris", 50, "verified", ["ecommerce"]), ("Marketing", "Berlin", 5, "verified", ["ecommerce"])],
        "title string, city string, employees int, email_status string, keyword_tags array<string>")
    got = crm.people_search(rows, titles=["marketing"], not_titles=["seo"], locations=["BERLIN"], employees=(11, 500),
                            email_status="verified", keyword_tags=["ecommerce"])
    assert [r.title for r in got.collect()] == ["Marketing Manager"]


def test_lookup_with_hot_key(spark):
    """A key with a third of the rows, blank keys with another third."""
    base = spark.range(9_000).select(
        "id", F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.lit(None))
        .otherwise(F.concat(F.lit("k"), F.col("id").cast("string"))).alias("key"))
    table = spark.createDataFrame([("hot", 1), ("k2", 2), ("unused", 3)], "key string, v int").withColumnRenamed("key", "tk")
    key = joins.spread_key(F.col("key").isNotNull(), F.col("key"), F.col("id"))
    got = joins.lookup(base, table, key, "tk", ["v"], "id")
    assert {(r.v, r["count"]) for r in got.groupBy("v").count().collect()} == {(1, 3000), (2, 1), (None, 5999)}
    assert [r._hk for r in joins.hot_keys(base, F.col("key"), 0.4).collect()] == []
    assert {r._hk for r in joins.hot_keys(base, F.col("key"), 0.01).collect()} == {"hot", None}


def test_enrich(spark):
    people = spark.createDataFrame([(1, " Org ", "Ann", "Lee"), (2, "Org", "", "Lee"), (3, "Org", "Bob", "Ray")],
                                   "id int, organization_name string, first_name string, last_name string")
    found = spark.createDataFrame([("Org", "Ann", "Lee", "a@x", 90, "valid"), ("Org", "", "Lee", "no@x", 1, "x")],
                                  "organization_name string, first_name string, last_name string, email string, confidence_score int, mail_status string")
    got = {r.id: (r.email, r.confidence_score, r.mail_status) for r in enrich.enrich_email(people, found, "id").collect()}
    assert got == {1: ("a@x", "90", "valid"), 2: ("", "", ""), 3: ("", "", "")}


def test_cache_additions(spark):
    cache = spark.createDataFrame([("a", "x", 0.9)], "title_norm string, label string, score double")
    answers = spark.createDataFrame([("a", "y", 0.8), ("b", "z", 0.7), ("b", "z", 0.7)], "title_norm string, label string, score double")
    assert [(r.title_norm, r.label) for r in enrich.cache_additions(answers, cache).collect()] == [("b", "z")]


def test_writeback(spark):
    base = spark.createDataFrame([(1, "old"), (2, "old"), (3, None)], "row_idx int, label string")
    fresh = spark.createDataFrame([(1, "new"), (9, "stray")], "row_idx int, label string")
    kept = writeback.keep_existing(base, fresh)
    assert {(r.row_idx, r.label) for r in kept.collect()} == {(1, "new"), (2, "old"), (3, "")}
    filled = writeback.fill_blank(base.select("row_idx"), fresh, ["label"])
    assert {(r.row_idx, r.label) for r in filled.collect()} == {(1, "new"), (2, ""), (3, "")}


def test_skip_empty(spark):
    rows = spark.createDataFrame([(0, 0, ""), (1, 0, " "), (2, 1, ""), (3, 1, "x")], "row_idx int, b int, label string")
    assert {r.row_idx for r in writeback.skip_empty_buckets(rows, "b", "label").collect()} == {2, 3}


def test_scan_rows(spark):
    rows = spark.createDataFrame([(1, "head"), (2, " a "), (3, ""), (4, None), (5, "b")], "row_idx int, value string")
    assert [(r.row_idx, r.value) for r in files.scan_rows(rows, 2).collect()] == [(2, "a"), (5, "b")]
    assert [r.row_idx for r in files.scan_rows(rows, 1, 2).collect()] == [1, 2]


def test_scan_reaches_the_files(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/pages.parquet").withColumnRenamed("page_id", "row_idx")
    plan = files.scan_rows(rows, 5, 9, value="url").select("row_idx", "url")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(page_id,5)" in plan and "html" not in plan.split("ReadSchema")[1]


def test_broken_lines(spark):
    path = scratch_path(spark, "lines")
    spark.createDataFrame([('{"a":1}',), ("",), ("{",), ('{"a":2} x',), (" [1] ",)], "value string").write.text(path)
    assert files.read_jsonl(spark, path).count() == 2


def test_overwrite_and_append(spark):
    path = scratch_path(spark, "jsonl")
    one = spark.createDataFrame([("ż", None)], "a string, b string")
    files.write_jsonl(one, path)
    files.write_jsonl(one, path)
    assert spark.read.text(path).distinct().first().value == '{"a":"ż","b":null}'
    assert spark.read.text(path).count() == 2
    files.write_jsonl(one, path, mode="overwrite")
    assert spark.read.text(path).count() == 1


@pytest.mark.parametrize("suffix", ["json", "yaml"])
def test_dictionary_file(spark, tmp_path, suffix):
    path = tmp_path / f"rules.{suffix}"
    path.write_text('{"maybe": {"a": "x\\\\s?y"}}', encoding="utf-8")
    assert files.load_dictionary(spark, str(path)) == {"maybe": {"a": r"x\s?y"}}


def test_batch_infer_asks_once_per_text(spark):
    rows = spark.createDataFrame([(i, "same" if i % 2 else f"t{i}") for i in range(20)] + [(99, None)], "id int, t string")

    def model(texts):
        assert len(texts) == len(set(texts)) and len(texts) <= 3
        return [(t.upper(), 1.0) for t in texts]

    got = {r.id: r.label for r in infer.batch_infer(rows, "t", model, "id", batch=3).collect()}
    assert got[1] == "SAME" and got[2] == "T2" and got[99] is None and len(got) == 21


def test_stream_equals_batch_and_resumes(spark):
    base = scratch_path(spark, "stream")
    first = spark.createDataFrame([(1, " a "), (2, "b")], "id int, t string")
    second = spark.createDataFrame([(3, "c ")], "id int, t string")

    def op(df):
        return df.select("id", F.trim("t").alias("t"))

    for rows in (first, second, None):
        if rows is not None:
            rows.write.mode("append").parquet(f"{base}/in")
        incremental.run_available(spark, f"{base}/in", first.schema, op, f"{base}/out", f"{base}/state")
    assert sorted(map(tuple, spark.read.parquet(f"{base}/out").collect())) == [(1, "a"), (2, "b"), (3, "c")]


def test_standing_query(spark):
    base = scratch_path(spark, "standing")
    rows = spark.createDataFrame([(1, "a")], "id int, t string")
    rows.write.parquet(f"{base}/in")
    query = incremental.start_continuous(spark, f"{base}/in", rows.schema, lambda df: df, f"{base}/out",
                                         f"{base}/state", "1 second")
    try:
        query.processAllAvailable()
        assert spark.read.parquet(f"{base}/out").count() == 1
    finally:
        query.stop()


class Cluster:
    """A session that is not local, with or without a shared folder."""

    def __init__(self, folder):
        self.conf = self.sparkContext = self
        self.folder, self.master, self.applicationId = folder, "spark://host:7077", "app"

    def get(self, key, default=None):
        return self.folder

    def getConf(self):
        return self


def test_work_dir_follows_the_cluster_setting(spark):
    assert work_dir(spark) == work_dir(spark)
    assert work_dir(Cluster("hdfs://shared/folder/")) == "hdfs://shared/folder"
    with pytest.raises(RuntimeError):
        work_dir(Cluster(None))


def test_delimited_files_go_by_name(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text('﻿extra,b,a\n1,"two\nlines",x\n2,"q ""r""",\n', encoding="utf-8")
    got = files.read_delimited(spark, str(path), ["a", "b", "missing"], multi_line=True)
    assert got.columns == ["a", "b", "missing", "extra"]
    assert [tuple(r) for r in got.collect()] == [("x", "two\nlines", None, "1"), (None, 'q "r"', None, "2")]
