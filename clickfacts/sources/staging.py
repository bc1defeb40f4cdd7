"""Materialised intermediate tables in the folder the cluster shares.

A staged frame is written once and read back as a Parquet table: later jobs prune its columns, the lineage ends
there, and a lost executor costs a re-read instead of a re-computation.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"


_LOCAL_ROOTS: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a temporary one only where one process is the whole cluster."""
    configured = spark.conf.get(_SETTING, None)
    if configured:
        return configured.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError(f"set {_SETTING} to a folder all executors share")
    application = spark.sparkContext.applicationId
    if application not in _LOCAL_ROOTS:
        _LOCAL_ROOTS[application] = tempfile.mkdtemp(prefix="clickfacts-")
    return _LOCAL_ROOTS[application]


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no other run uses."""
    return f"{shared_root(spark)}/clickfacts/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Write ``df`` once and return the table read back."""
    spark = df.sparkSession
    target = path or fresh_path(spark, name)
    df.write.mode("overwrite").parquet(target)
    return spark.read.schema(df.schema).parquet(target)


def discard(spark: SparkSession, path: str) -> None:
    """Delete a staged table that is not needed any more."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
