import pytest
from pyspark.sql import functions as F

from leadframe.operators import enrich
from leadframe.sources import snapshots
from leadframe.streaming import incremental


def _failing(df):
    """The table, but its last row fails while it is written."""
    return df.withColumn("n", F.when(F.col("k") == 9, F.raise_error(F.lit("lost halfway")).cast("int")).otherwise(F.col("n")))


def test_a_failed_write_leaves_the_old_version(spark, tmp_path):
    path = str(tmp_path / "table")
    assert snapshots.current(spark, path) is None and snapshots.read(spark, path, "k int").count() == 0
    with pytest.raises(ValueError):
        snapshots.read(spark, path)
    rows = spark.range(10).select(F.col("id").cast("int").alias("k"), F.lit(1).alias("n"))
    assert snapshots.replace(rows, path).count() == 10
    with pytest.raises(Exception, match="lost halfway"):
        snapshots.replace(_failing(rows.repartition(4)), path)
    assert snapshots.current(spark, path)[0] == 1 and snapshots.read(spark, path).count() == 10
    old = snapshots.read(spark, path)
    snapshots.replace(old.where("k < 3"), path)  # computed from the version it replaces
    assert snapshots.current(spark, path)[0] == 2
    assert snapshots.read(spark, path).count() == 3 and old.count() == 10  # who reads the old one goes on


def test_cache_keeps_its_answers(spark, tmp_path):
    path = str(tmp_path / "cache")
    batch = lambda *rows: spark.createDataFrame(rows, "title_norm string, label string, score double")
    enrich.persist_cache(batch(("a", "x", 0.5), ("a", "y", 0.7)), path)
    enrich.persist_cache(batch(("a", "z", 0.9), ("b", "z", 0.1)), path)
    enrich.persist_cache(batch(("b", "never", 1.0)), path)
    assert sorted(map(tuple, snapshots.read(spark, path).collect())) == [("a", "y", 0.7), ("b", "z", 0.1)]
    assert snapshots.current(spark, path)[0] == 2


def test_replayed_batches_change_nothing(spark, tmp_path):
    target, rows = str(tmp_path / "t"), "k int, at int, v string"
    batch = lambda *r: spark.createDataFrame(list(r), rows)
    add = lambda df, n: incremental.upsert_batch(df, n, target, "k", "at", "s")
    assert add(batch((1, 1, "a"), (2, 5, "b"), (1, 3, "c"), (3, None, "n")), 0)
    assert add(batch((1, 2, "late"), (2, 6, "d"), (4, 1, "e"), (3, 0, "m")), 1)
    want = [(1, 3, "c"), (2, 6, "d"), (3, 0, "m"), (4, 1, "e")]
    assert sorted(map(tuple, snapshots.read(spark, target).collect())) == want
    with pytest.raises(Exception, match="lost halfway"):  # the batch fails before its commit and is played again
        incremental.upsert_batch(batch((9, 9, "x")).withColumn("v", F.raise_error(F.lit("lost halfway")).cast("string")), 2, target, "k", "at", "s")
    assert add(batch((9, 9, "x")), 2) and not add(batch((9, 10, "y")), 2) and not add(batch((1, 99, "z")), 0)
    assert sorted(map(tuple, snapshots.read(spark, target).collect())) == [*want, (9, 9, "x")]
    assert incremental.upsert_batch(batch((9, 10, "y")), 2, target, "k", "at", "another source")


def test_a_run_that_lost_its_progress_adds_nothing_twice(spark, tmp_path):
    import shutil

    base = str(tmp_path)
    schema = "k int, at int, v int"
    run = lambda: incremental.run_upserts(spark, f"{base}/in", schema, lambda df: df, f"{base}/out", f"{base}/state", "k", "at")
    spark.createDataFrame([(1, 1, 1), (2, 1, 1)], schema).write.parquet(f"{base}/in")
    run()
    assert snapshots.current(spark, f"{base}/out")[0] == 1
    shutil.rmtree(f"{base}/state/commits")  # the stream forgets that it has finished batch 0 and plays it again
    run()
    assert snapshots.current(spark, f"{base}/out")[0] == 1 and snapshots.read(spark, f"{base}/out").count() == 2
    spark.createDataFrame([(1, 2, 7)], schema).write.mode("append").parquet(f"{base}/in")
    run()
    assert sorted(map(tuple, snapshots.read(spark, f"{base}/out").collect())) == [(1, 2, 7), (2, 1, 1)]
