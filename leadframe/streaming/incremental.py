"""Incremental runs: new files in, labelled rows appended exactly once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import snapshots


def run_available(spark: SparkSession, source: str, schema, transform: Callable[[DataFrame], DataFrame],
                  sink: str, checkpoint: str, files_per_trigger: int | None = None) -> None:
    """Process every file that has arrived since the last run, then stop.

    ``transform`` is any row-wise operator of this package.  The checkpoint
    remembers the files that were read and the file sink commits each batch
    once, so running it again adds nothing twice.  Both folders must be
    reachable from every executor.
    """
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    query = (
        transform(reader.parquet(source)).writeStream.format("parquet").outputMode("append")
        .option("path", sink).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()


def start_continuous(spark: SparkSession, source: str, schema, transform: Callable[[DataFrame], DataFrame],
                     sink: str, checkpoint: str, interval: str = "1 minute"):
    """The same run as a standing query; returns the handle."""
    return (
        transform(spark.readStream.schema(schema).parquet(source))
        .writeStream.format("parquet").outputMode("append")
        .option("path", sink).option("checkpointLocation", checkpoint)
        .trigger(processingTime=interval).start()
    )


def upsert(table: DataFrame, batch: DataFrame, key: str, order: str) -> DataFrame:
    """Rows of the batch replace those of the table with the same key, unless they are older.

    Of several rows with one key and ``order`` the greatest row counts; NULL
    ``order`` is the oldest, and rows of the table win ties.
    """
    rows = F.struct(F.col(order).isNotNull().alias("known"), F.col(order).alias("at"), F.col("_old"), F.struct(*table.columns).alias("row"))
    both = table.withColumn("_old", F.lit(True)).unionByName(batch.select(*table.columns).withColumn("_old", F.lit(False)))
    return both.groupBy(F.col(key).alias("_key")).agg(F.max(rows).alias("best")).select("best.row.*")


def upsert_batch(batch: DataFrame, batch_id: int, target: str, key: str, order: str, source: str) -> bool:
    """Upsert one batch into the table kept at ``target``; False if it is in there already.

    The commit that publishes the rows also notes the batch.  So a batch that is
    replayed after a failure, at whatever point it came, is added once.
    """
    spark = batch.sparkSession
    if snapshots.committed(spark, target, source, batch_id):
        return False
    snapshots.replace(upsert(snapshots.read(spark, target, batch.schema), batch, key, order), target, source, batch_id)
    return True


def run_upserts(spark: SparkSession, source: str, schema, transform: Callable[[DataFrame], DataFrame], target: str,
                checkpoint: str, key: str, order: str, files_per_trigger: int | None = None) -> None:
    """Process the files that have arrived since the last run and upsert their rows by key, then stop.

    Writing to a plain table is not part of a stream's own exactly-once promise;
    the batch ids in the table's commit log are.  They belong to this
    ``checkpoint``, which names the source in the log.
    """
    def add(batch: DataFrame, batch_id: int) -> None:
        upsert_batch(batch, batch_id, target, key, order, checkpoint)

    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    transform(reader.parquet(source)).writeStream.foreachBatch(add).option("checkpointLocation", checkpoint) \
        .trigger(availableNow=True).start().awaitTermination()
