import duckdb
import pytest

from leadframe.llm import mixing
from leadframe.llm.mixing import mix, mixed_documents
from pyspark.sql import functions as F


def rounds(sizes, weights=(5, 2, 1), most=3):
    """Targets as the contract words them: share, cap, share the excess again."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    budget, done, target = float(sum(sizes.values())), {}, {}
    while True:
        rest = [s for s in names if s not in done]
        left = budget - sum(done.values())
        target = {s: left * weight[s] / sum(weight[t] for t in rest) for s in rest} | done
        over = [s for s in rest if target[s] > most * sizes[s]]
        if not over:
            return target
        done |= {s: float(most * sizes[s]) for s in over}
        if len(done) == len(names):
            return done


def agree(docs, **kw):
    rows = mix(docs, **kw).collect()
    assert len(rows) == docs.count()
    sizes, taken, targets = {}, {}, {}
    for r in rows:
        sizes[r.source] = sizes.get(r.source, 0) + r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
        targets[r.source] = r.target
        assert r.taken % r.size == 0 and r.taken <= 3 * r.size if r.size else r.taken == 0
    for source, target in rounds(sizes).items() if sizes else ():
        assert targets[source] == pytest.approx(target)
        largest = max((r.size for r in rows if r.source == source), default=0)
        assert abs(taken[source] - target) <= largest
    assert all(r.source_size == sizes[r.source] for r in rows)
    return sorted((tuple(r) for r in rows), key=str)


@pytest.mark.parametrize("rows", [1, 17, 100_000])
def test_targets_and_cuts(documents, rows):
    agree(documents, bucket_rows=rows)


def test_partitions_and_buckets_do_not_matter(documents):
    same = agree(documents)
    assert same == agree(documents.repartition(7), bucket_rows=9) == agree(documents, bucket_rows=1)


def test_skewed_sources(spark):
    rows = [(i, "w " * (i % 9), "big" if i % 3 else f"s{i % 7}") for i in range(3_000)] + [(9_000, "x " * 40, None), (9_001, "", "empty")]
    agree(spark.createDataFrame(rows, "doc_id bigint, text string, source string"), bucket_rows=100)


def test_sql(documents, sf_dir):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    expected = {tuple(r) for r in con.execute(mixing.ORACLE).fetchall()}
    assert {tuple(r) for r in mix(documents).select("doc_id", "size", "source_size", "target", "taken").collect()} == expected


def test_odd_rows(odd, empty):
    agree(odd)
    assert mix(empty).collect() == [] and mixed_documents(empty).collect() == []
    copies = mixed_documents(odd)
    assert copies.columns == odd.columns
    taken = {(r.doc_id, r.source): r.epochs for r in mix(odd).collect()}
    counts = {(r.doc_id, r.source): r["count"] for r in copies.groupBy("doc_id", "source").count().collect()}
    for key, n in counts.items():
        assert n == taken[key] * (2 if key[0] == 7 else 1)
    assert all(copies.where(F.col("doc_id") == d).isEmpty() for d in (1, 2, 3))
