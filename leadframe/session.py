"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_CHECKPOINT_KEY = "spark.checkpoint.dir"
_local_dirs: dict[str, str] = {}


def build_session(app: str = "leadframe", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings the operators expect.

    UTC keeps timestamps comparable between runs; adaptive execution sizes the
    shuffles and splits skewed join partitions.  Anything in ``conf`` wins.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
    }
    settings.update({k.replace("__", "."): v for k, v in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_dir(spark: SparkSession) -> str:
    """Shared folder for hand-over tables and streaming state.

    The cluster names it in ``spark.checkpoint.dir``.  Only a local master may
    fall back to a folder of this machine, because there driver and executors
    are the same process.
    """
    sc = spark.sparkContext
    configured = spark.conf.get(_CHECKPOINT_KEY, None) or sc.getConf().get(_CHECKPOINT_KEY)
    if configured:
        return configured.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError(
            f"set {_CHECKPOINT_KEY} to a folder every executor can reach; "
            "a machine-local folder would be lost with its machine"
        )
    app = sc.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="leadframe-")
    return _local_dirs[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared work folder."""
    return f"{work_dir(spark)}/leadframe/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write a table to the shared folder and go on from there.

    Like a reliable checkpoint it cuts the lineage and survives lost executors.
    Unlike one it is columnar and has a known size, so the next join knows
    whether this side is small.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
