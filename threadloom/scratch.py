"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_ROOT: dict[str, str] = {}
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def prepare(spark: SparkSession) -> None:
    """Lets Python workers of a local session import this package where the driver's folder isn't theirs."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    workers = spark.sparkContext.environment
    paths = [p for p in workers.get("PYTHONPATH", os.environ.get("PYTHONPATH", "")).split(os.pathsep) if p]
    if spark.sparkContext.master.startswith("local[") and root not in paths:
        workers["PYTHONPATH"] = os.pathsep.join([*paths, root])


def scratch_root(spark: SparkSession) -> str:
    """A folder of this session below ``spark.checkpoint.dir``, which all executors share.

    Only where that setting is missing (tests on one machine) a temporary folder is made.
    It goes when the driver ends.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = "file://" + tempfile.gettempdir()
    key = f"{spark.sparkContext.applicationId}|{base}"
    if key not in _ROOT:
        _ROOT[key] = f"{base.rstrip('/')}/threadloom-{uuid.uuid4().hex}"
        atexit.register(_remove, spark, _ROOT[key])
    return _ROOT[key]


def _remove(spark: SparkSession, path: str) -> None:
    try:
        drop_path(spark, path)
    except Exception:  # noqa: BLE001  the gateway may be gone when the interpreter ends
        pass


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def drop_path(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def materialize(df: DataFrame, label: str, options: dict | None = None) -> DataFrame:
    """Writes df to the shared folder and reads it back: lineage ends here and survives lost executors. options: of the Parquet writer.

    Nothing reads the write's shuffle files again, so Spark is told to drop them when it ends."""
    spark = df.sparkSession
    prepare(spark)
    path = scratch_path(spark, label)
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.options(compression="zstd", **(options or {})).parquet(path)
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


def release(df: DataFrame) -> None:
    """Deletes a materialized table that nothing reads any more."""
    drop_path(df.sparkSession, df._scratch)
