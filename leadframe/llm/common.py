"""Shared by the operators of this package."""

from __future__ import annotations

import sys
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space and words of the contracts.
BLANKS = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()


def shipped(name: str) -> None:
    """Send a module's functions to executors by value, so that they need no package."""
    cloudpickle.register_pickle_by_value(sys.modules[name])


class Sent:
    """A broadcast of an object of our own classes, as bytes that executors can read without this package."""

    def __init__(self, spark: SparkSession, value: object):
        self._bytes, self._value = spark.sparkContext.broadcast(cloudpickle.dumps(value)), None

    def __getstate__(self) -> dict:
        return {"_bytes": self._bytes, "_value": None}

    @property
    def value(self) -> object:
        if self._value is None:
            self._value = cloudpickle.loads(self._bytes.value)
        return self._value


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def words(text: Column) -> Column:
    """Words in reading order; no words for null, empty or blank text."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), BLANKS, -1), lambda w: w != "")


def only(df: DataFrame, *names: str) -> DataFrame:
    """The named columns alone, whatever else the table has."""
    return df.select(*[F.col(f"`{n}`") for n in names])


def column(batch: pa.RecordBatch, name: str) -> list:
    return batch.column(batch.schema.get_field_index(name)).to_pylist()


@contextmanager
def setting(spark: SparkSession, key: str, value: object) -> Iterator[None]:
    """A setting of the session for the queries run inside."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, str(value))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def tidy_shuffles(spark: SparkSession):
    """Let Spark drop the shuffle files of every query as soon as it has ended.

    For operators that write each step to the shared folder: none of their
    shuffles is read again, and without this all of them pile up on the disks.
    """
    return setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


shipped(__name__)
