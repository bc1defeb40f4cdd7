"""Helpers the operators share: reading tables, cutting lineage, Arrow batches of bounded size."""

from __future__ import annotations

import os
import re
import tempfile
import zipfile
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Words are maximal runs of letters and digits in lower case.
NON_WORD = r"[^\p{L}\p{N}]+"
#: Text a Python worker holds at a time, in characters; a longer single text is still processed whole.
CHUNK_CHARS = 1 << 21


def tidy(spark: SparkSession) -> SparkSession:
    """Let shuffle files go when the action that wrote them ends, instead of when the driver collects its garbage.

    Set before data frames are made. The operators cut their lineage, so no later action reads these files; one that
    does (a frame collected twice) computes them again."""
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")
    return spark


def ship(spark: SparkSession) -> SparkSession:
    """Send this package to the Python workers, once per application: they need not share the driver's files."""
    tidy(spark)
    context = spark.sparkContext
    if not getattr(context, "_clickfacts_shipped", False):
        root = Path(__file__).resolve().parents[2]
        handle, path = tempfile.mkstemp(prefix="clickfacts-", suffix=".zip")
        os.close(handle)
        with zipfile.ZipFile(path, "w") as archive:
            for module in sorted((root / "clickfacts").rglob("*.py")):
                archive.write(module, module.relative_to(root))
        context.addPyFile(path)
        context._clickfacts_shipped = True
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; a temporary one only where the setting is absent on a local master."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not re.fullmatch(r"local(\[.*\])?", context.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(tempfile.mkdtemp(prefix="clickfacts-llm-"))
    return context.getCheckpointDir().rstrip("/")


def cut(df: DataFrame) -> DataFrame:
    """The rows of ``df``, computed once and kept in the shared checkpoint folder; lineage ends there."""
    context = df.sparkSession.sparkContext
    folder = shared_dir(df.sparkSession)
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return df.checkpoint()


def words(text: Column) -> Column:
    """Lower-case words of a text; null and empty texts give an empty array."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), NON_WORD, -1), lambda w: w != "")


def crc32(text: Column) -> Column:
    """Unsigned CRC-32 of the UTF-8 bytes; a null text counts as empty."""
    return F.crc32(F.coalesce(text, F.lit("")).cast("binary"))


def chunks(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Slices of the batches with about ``CHUNK_CHARS`` of text each, and their texts (null as empty)."""
    for batch in batches:
        index = batch.schema.get_field_index(column)
        sizes = pc.fill_null(pc.binary_length(batch.column(index)), 0).to_pylist()
        start = total = 0
        for stop, size in enumerate(sizes, 1):
            total += size
            if total >= CHUNK_CHARS or stop == len(sizes):
                part = batch.slice(start, stop - start)
                yield part, [t or "" for t in part.column(index).to_pylist()]
                start, total = stop, 0


def appended(part: pa.RecordBatch, columns: dict[str, pa.Array]) -> pa.RecordBatch:
    """The rows of ``part`` with further columns; a column of the same name is replaced."""
    kept = {n: part.column(i) for i, n in enumerate(part.schema.names) if n not in columns}
    return pa.RecordBatch.from_pydict(kept | columns)


def bounded_sample(df: DataFrame, key: str, label: str, per_label: int) -> DataFrame:
    """At most ``per_label`` rows of each non-null label: those whose keys have the smallest hashes.

    Keys are ranked without the other columns, and every task keeps only ``per_label`` of them per label before the
    shuffle; the rows are then fetched by the bounded set of keys.
    """
    order = Window.partitionBy(label).orderBy(F.xxhash64(F.lit("sample"), key), key)
    chosen = (
        df.where(F.col(label).isNotNull())
        .select(key, label)
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= per_label)
        .select(key, label)
        .distinct()
    )
    # Few rows by construction. The keys alone are joined first: that join moves below any join that made ``df``.
    chosen = cut(chosen)
    rows = df.join(F.broadcast(chosen.select(key).distinct()), key, "left_semi")
    return rows.join(F.broadcast(chosen), [key, label], "left_semi")
