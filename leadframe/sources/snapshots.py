"""Tables that are replaced as a whole, and stay readable while they are.

Every version is a folder of its own.  A row in the commit log names it, and is
appended after the folder is complete: readers follow the last row, so a write
that fails halfway changes nothing for them.  Spark's file committer publishes a
log row at once, on any storage, and no file is ever overwritten.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_LOG = "version bigint, folder string, source string, batch bigint"


def _log(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.schema(_LOG).json(f"{path}/commits")
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def current(spark: SparkSession, path: str) -> tuple[int, str] | None:
    """Number and folder of the version that counts; None before the first.

    Of two writers that commit the same number, the folder name decides, alike for every reader.
    """
    log = _log(spark, path)
    if log is None:
        return None
    last = log.agg(F.max(F.struct("version", "folder")).alias("last")).head().last
    return (last.version, f"{path}/{last.folder}") if last else None


def read(spark: SparkSession, path: str, schema=None, form: str = "parquet") -> DataFrame:
    """The current version; an empty table of ``schema`` before the first.  JSON needs the schema."""
    found = current(spark, path)
    if found:
        reader = spark.read.schema(schema) if form == "json" else spark.read
        return reader.format(form).load(found[1])
    if schema is None:
        raise ValueError(f"no version of {path} has been committed")
    return spark.createDataFrame([], schema)


def replace(df: DataFrame, path: str, source: str | None = None, batch: int | None = None, form: str = "parquet") -> DataFrame:
    """Write ``df`` as the next version, Parquet or JSON lines, and read it back.

    ``df`` may be computed from the current version.  ``source`` and ``batch``
    are noted with the commit, see :func:`committed`.
    """
    spark = df.sparkSession
    found = current(spark, path)
    folder = f"versions/{uuid.uuid4().hex}"
    df.write.format(form).save(f"{path}/{folder}")
    row = spark.range(1).select(F.lit(found[0] + 1 if found else 1).cast("bigint").alias("version"), F.lit(folder).alias("folder"),
                                F.lit(source).cast("string").alias("source"), F.lit(batch).cast("bigint").alias("batch"))
    row.coalesce(1).write.mode("append").json(f"{path}/commits")
    return spark.read.schema(df.schema).format(form).load(f"{path}/{folder}")


def committed(spark: SparkSession, path: str, source: str, batch: int) -> bool:
    """Whether a version with this batch of this source is in the log: data and ledger are one commit."""
    log = _log(spark, path)
    return log is not None and not log.where((F.col("source") == source) & (F.col("batch") == batch)).isEmpty()
