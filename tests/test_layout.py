"""Queries per file over zones written with small target sizes: their rows must not follow the size of files."""

import pytest

import __spark_entry__ as entry
from clickfacts.queries import registry
from tests import oracle

SMALL = "/root/testdata/sf0.001"
PER_FILE = (
    "file_summary file_failures line_numbers quarantine_top100 quarantine_records quarantine_report ingest_metrics "
    "gated_feed stream_ingest"
).split()
SETTINGS = {
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1",
    "spark.sql.files.maxRecordsPerFile": "7",
}


@pytest.fixture(scope="module")
def small_target(spark):
    """Zones and ingests of their own, written as if every type and day were beyond the target size."""
    kept = {k: spark.conf.get(k, None) for k in SETTINGS}
    states = [registry._ZONES, registry._INGESTS]
    saved = [dict(s) for s in states]
    for k, v in SETTINGS.items():
        spark.conf.set(k, v)
    for s in states:
        s.clear()
    yield spark
    for k, v in kept.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    for s, old in zip(states, saved, strict=True):
        s.clear()
        s.update(old)


@pytest.mark.parametrize("name", PER_FILE)
def test_rows_do_not_follow_file_sizes(small_target, name):
    sql = entry.oracle_sql()[name]
    assert oracle.spark_rows(entry.queries()[name](small_target, SMALL)) == oracle.sql_rows(oracle.connect(SMALL), sql)


def test_large_day_is_one_file(spark, tmp_path):
    """A type and day whose lines come from many tasks and exceed the target size."""
    from pyspark.sql import functions as F

    from clickfacts.sources import raw

    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    kept = spark.conf.get(key)
    spark.conf.set(key, "1k")
    try:
        lines = spark.range(0, 4000, 1, 16).select(
            F.lit("page_view").alias("event_type"),
            F.lit("2024").alias("year"),
            F.lit("01").alias("month"),
            F.lit("02").alias("day"),
            "id",
            F.concat(F.sha2(F.col("id").cast("string"), 256), F.lit(" "), F.col("id")).alias("value"),
        )
        raw.write_lines(lines, f"{tmp_path}/raw", ["id"], whole=True)
    finally:
        spark.conf.set(key, kept)
    found = raw.list_files(spark, f"{tmp_path}/raw").collect()
    assert len(found) == 1
    got = [int(r.value.split()[1]) for r in spark.read.text(found[0].path).collect()]
    assert got == list(range(4000))
