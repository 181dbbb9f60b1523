import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from leadframe.llm import decontam, ngram_join
from leadframe.llm.queries import ORACLES, QUERIES


def test_registered():
    import __spark_entry__ as entry

    names = entry.queries()
    assert [sum(n.startswith(f"op{i}_") for n in names) for i in range(1, 14)] == [1] * 13
    assert "pipeline" in names and set(QUERIES) <= set(names) and set(ORACLES) <= set(entry.oracle_sql())
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "near_copies", "benchmark_leaks", "mixing", "packing"]


def test_stages(spark, sf_dir, documents, texts):
    docs, seen = documents, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf_dir).cache()
        assert docs.columns == documents.columns
        seen.append({r.doc_id for r in docs.collect()})
    language, copies, leaks, mixed = seen
    assert language == {d for d, t in texts.items() if any(c.isalpha() for c in t or "")}
    assert copies == {r.component_id for r in ngram_join.join(documents.where(F.col("doc_id").isin(list(language)))).collect()}
    bad = {r.doc_id for r in decontam.leaks(documents, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).collect()}
    assert leaks == copies - bad
    assert mixed <= leaks
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
    assert {d for r in packed.select("doc_ids").collect() for d in r.doc_ids} == mixed


@pytest.mark.parametrize("which", ["odd", "empty"])
def test_odd_rows(spark, sf_dir, odd, empty, which):
    docs = {"odd": odd, "empty": empty}[which]
    columns = docs.columns
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf_dir).cache()
        assert docs.columns == columns
    rows = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).collect()
    assert {d for r in rows for d in r.doc_ids} <= {None, 4, 6, 7, 9, 10}
    assert bool(rows) == (which == "odd")
