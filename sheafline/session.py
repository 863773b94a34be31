"""Session defaults and the checkpoint location."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession


def build_session(app_name: str = "sheafline", **conf: str) -> SparkSession:
    """A session with the settings the library expects; cluster settings stay with the cluster."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        # Recording the call site of every column costs most of the time it takes to build a plan.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_BUILT: dict = {}


def built_once(name: str, build: Callable):
    """Columns that depend on nothing but names, built once per driver JVM.

    A large expression costs thousands of round trips to the JVM; the built columns are immutable and serve
    every later plan.
    """
    gateway, column = _BUILT.get(name, (None, None))
    if gateway is None or gateway is not SparkContext._gateway:
        column = build()
        _BUILT[name] = (SparkContext._gateway, column)
    return column


#: The folder of each local application.
_LOCAL_FOLDERS: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder for checkpoints and intermediate tables: the one the cluster names in ``spark.checkpoint.dir``.

    A local session without one gets a temporary folder; a cluster without one is a configuration error,
    because a machine-local folder would not survive the loss of an executor.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured
    if spark.sparkContext.master.startswith("local"):
        application = spark.sparkContext.applicationId
        if application not in _LOCAL_FOLDERS:
            _LOCAL_FOLDERS[application] = tempfile.mkdtemp(prefix="spark-")
        return _LOCAL_FOLDERS[application]
    raise RuntimeError("spark.checkpoint.dir is not set: name a shared folder for checkpoints")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def spread(df: DataFrame) -> DataFrame:
    """Deal rows out to all cores when the input has fewer splits than that, as one big file has.

    Meant for inputs of costly row-local work. With as many splits as cores, the usual case at scale, the
    input is left alone and nothing is shuffled.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to a new table in the shared folder and continue from the written copy.

    A table, unlike an RDD checkpoint, keeps column pruning, filters and sizes for the plans that read it.
    """
    path = scratch_path(df.sparkSession, "cut")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
