"""Fact and report tables on shared storage."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickfacts.operators.clean import keep_one
from clickfacts.operators.tables import lacking
from clickfacts.sources import staging


def days_of(df: DataFrame) -> set[date]:
    """Days in a frame; at most one row per calendar day reaches the driver."""
    return {r.date for r in df.select("date").distinct().collect() if r.date is not None}


def _folders(spark: SparkSession, path: str) -> dict[str, frozenset[str]]:
    """The partition folders of a table and the names of their files, from the listing; nothing is read."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(root):
        return {}
    found = [f.getPath() for f in files.listStatus(root) if f.isDirectory() and f.getPath().getName().startswith("date=")]
    return {p.getName(): frozenset(f.getPath().getName() for f in files.listStatus(p)) for p in found}


def write_fact(df: DataFrame, path: str, days: Iterable[date] | None = None) -> None:
    """Replace days of a table partitioned by ``date``; other days stay.

    The days that ``df`` holds are replaced, and with ``days`` also those of them for which it has no row (any more):
    folders of these days whose files the write has left as they were are removed afterwards.
    """
    spark = df.sparkSession
    names = {f"date={d}" for d in days or ()}
    before = {name: files for name, files in _folders(spark, path).items() if name in names} if names else {}
    (
        df.hint("rebalance", F.col("date"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("date")
        .parquet(path)
    )
    after = _folders(spark, path) if before else {}
    for name in sorted(n for n, files in before.items() if after.get(n) == files):
        staging.discard(spark, f"{path}/{name}")


def exists(spark: SparkSession, path: str) -> bool:
    """Whether the table has a partition yet."""
    return bool(_folders(spark, path))


def read_fact(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """The stored table; with ``schema`` in its column order, also while the table has no rows."""
    if schema is None:
        return spark.read.parquet(path)
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def write_reports(reports: DataFrame, path: str, mode: str = "append") -> None:
    """Quarantine reports as JSON, one document per line, below ``event_type=``."""
    reports.write.mode(mode).partitionBy("event_type").json(path)


def append_table(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def append_new(
    df: DataFrame, path: str, key: Sequence[str], order: Sequence[str] = (), order_only: Sequence[str] = ()
) -> None:
    """Append the rows whose key the table at ``path`` lacks; of arriving rows with one key the first by ``order``.

    A stored row stays (first writer wins), NULL equals NULL in keys, and a missing table is begun. Only the stored
    days that arrive are read. Columns in ``order_only`` serve the order and are not stored.
    """
    spark = df.sparkSession
    fresh = keep_one(df, key, order)
    if _folders(spark, path):
        stored = read_fact(spark, path, df.drop(*order_only).schema)
        arriving = days_of(df)
        fresh = lacking(fresh, stored.where(F.col("date").isin(*arriving) | F.col("date").isNull()), key)
    fresh.drop(*order_only).write.mode("append").partitionBy("date").parquet(path)
