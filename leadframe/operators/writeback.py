"""Keyed write-back: results return to their rows by row number, never by
position."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import is_blank


def fill_blank(base: DataFrame, results: DataFrame, columns: list[str], key: str = "row_idx"
               ) -> DataFrame:
    """Every base row with its result columns, '' where there is no result."""
    joined = base.join(results.select(key, *columns), key, "left")
    return joined.select(*base.columns, *[F.coalesce(c, F.lit("")).alias(c) for c in columns])


def keep_existing(base: DataFrame, results: DataFrame, column: str = "label",
                  key: str = "row_idx") -> DataFrame:
    """New value where the row was processed, else the old one, else ''."""
    fresh = results.select(key, F.struct(F.col(column)).alias("_new"))
    joined = base.join(fresh, key, "left")
    value = F.when(F.col("_new").isNotNull(), F.col(f"_new.{column}")).otherwise(F.col(column))
    rest = [c for c in base.columns if c != column]
    return joined.select(*rest, F.coalesce(value, F.lit("")).alias(column))


def bucket_of(row: str, start: int, size: int) -> Column:
    return F.floor((F.col(row) - start) / size).cast("bigint")


def skip_empty_buckets(updates: DataFrame, bucket: str, column: str) -> DataFrame:
    """Rows of the buckets that hold at least one value.

    The flags are aggregated map-side and filtered first; the semi join then
    only meets buckets worth writing.
    """
    worth = updates.where(~is_blank(column)).select(bucket).distinct()
    return updates.join(worth, bucket, "left_semi")


def bucket_progress(rows: DataFrame, start: int, size: int, value: str, row: str = "row_idx"
                    ) -> DataFrame:
    """Per bucket: first and last row, rows and filled rows."""
    return rows.groupBy(bucket_of(row, start, size).alias("bucket")).agg(
        F.min(row).alias("first_row"), F.max(row).alias("last_row"),
        F.count("*").alias("rows"), F.count_if(~is_blank(value)).alias("filled"))


def not_done_yet(work: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Work whose key is not in the output yet."""
    return work.join(done.select(key), key, "left_anti")
