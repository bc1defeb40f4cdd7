"""Validated ingest of newly arrived files, found by listing a zone or named by notices."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from clickfacts import schemas
from clickfacts.functions import columns as C
from clickfacts.operators import quality
from clickfacts.plans.ingest import Ingest
from clickfacts.session import configure
from clickfacts.sources import raw, staging

TABLES = ("file_summary", "failures", "reports", "quarantine", "metrics")


#: Columns of a streamed binary file.
_FILES = "path string, modificationTime timestamp, length long, content binary"


def line_stream(spark: SparkSession, root: str, base: str, files_per_batch: int | None = None) -> DataFrame:
    """Stream of event lines; a file is always whole inside one micro-batch, one that does not decode is a row."""

    def reader(form: str, pattern: str) -> DataFrame:
        read = spark.readStream.format(form).option("recursiveFileLookup", "true").option("pathGlobFilter", pattern)
        if form == "binaryFile":
            read = read.schema(_FILES)
        return (read.option("maxFilesPerTrigger", files_per_batch) if files_per_batch else read).load(root)

    return raw.isolated_lines(reader, root, base)


def _report(lines: DataFrame, batch_id: int, out: str, base: str, now: datetime | None, missing: DataFrame | None = None) -> None:
    """Validates the lines of a micro-batch and writes one folder per table, replaced as a whole by a replay."""
    target = f"{out}/checked/batch_id={batch_id}"
    checked = quality.stage_validated(raw.with_positions(lines), "checked", target)
    done = Ingest(checked, base, now or datetime.now(UTC))
    failures = done.failures if missing is None else done.failures.unionByName(missing)
    metrics = quality.ingest_metrics(done.summary, failures, F.lit(done.now))
    for name, df in zip(TABLES, (done.summary, failures, done.reports, done.quarantine, metrics), strict=True):
        df.write.mode("overwrite").parquet(f"{out}/{name}/batch_id={batch_id}")
    # All reports are written; a replay would validate the batch again.
    staging.discard(lines.sparkSession, target)


def start_ingest(
    spark: SparkSession,
    root: str,
    out: str,
    checkpoint: str,
    base: str | None = None,
    now: datetime | None = None,
    files_per_batch: int | None = None,
    available_now: bool = True,
) -> StreamingQuery:
    """Validate arriving files and write their reports below ``out``.

    Every table gets one folder per micro-batch, replaced as a whole when a batch is replayed after a failure, so
    each file is reported exactly once however often its batch ran.
    """
    configure(spark)
    base = raw.parent(root) if base is None else base
    out = out.rstrip("/")

    def process(batch: DataFrame, batch_id: int) -> None:
        _report(batch, batch_id, out, base, now)

    lines = line_stream(spark, root, base, files_per_batch)
    writer = lines.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def notified_objects(notices: DataFrame, bucket: str, redelivery: str) -> DataFrame:
    """Keys of event files a stream of notices (``bucket``, ``key``, further columns) names in ``bucket``.

    Keys are form-decoded; reports and catalogs are left out. A notice that comes again within ``redelivery`` of its
    first arrival is the same one: keyed state with that time to live. Notices of one object that differ in a further
    column (a version, an event time) are different notices.
    """
    arrived = notices.where(F.col("bucket") == bucket).withColumn("_arrived", F.current_timestamp())
    fresh = arrived.withWatermark("_arrived", redelivery).dropDuplicatesWithinWatermark(notices.columns)
    key = C.notified_key(F.col("key"))
    return fresh.select(key.alias("key")).where(C.is_event_key(F.col("key"), schemas.NON_EVENT_PREFIXES))


def _present(spark: SparkSession, paths: list[str]) -> dict[str, bool]:
    """Which of the objects exist, asked one by one: nothing is listed."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    configuration = spark._jsc.hadoopConfiguration()
    return {p: hadoop(p).getFileSystem(configuration).exists(hadoop(p)) for p in paths}


def start_notified(
    notices: DataFrame,
    bucket: str,
    root: str,
    out: str,
    checkpoint: str,
    redelivery: str = "1 day",
    now: datetime | None = None,
    available_now: bool = True,
) -> StreamingQuery:
    """Validate exactly the objects that a stream of notices names; the zone is never listed.

    ``root`` is the folder of the bucket. The keys of a micro-batch go through the driver, so the source of the notices
    bounds them (files or offsets per trigger). An object that is gone by then is a failure with a reason. Outputs are
    those of ``start_ingest``.
    """
    spark = configure(notices.sparkSession)
    out, root = out.rstrip("/"), root.rstrip("/")
    base = raw.folder(root)

    def process(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        keys = sorted({r.key for r in batch.collect()})
        present = _present(session, [f"{root}/{k}" for k in keys])
        found = [p for p, there in present.items() if there]

        def reader(form: str, pattern: str) -> DataFrame | None:
            own = [p for p in found if p.endswith(".gz") == (pattern == raw.GZIP)]
            return session.read.format(form).load([raw.escaped(p) for p in own]) if own else None

        gone = [(f"{root}/{k}", k, 0, "the object is missing") for k in keys if not present[f"{root}/{k}"]]
        missing = session.createDataFrame(gone, "path string, failure_key string, fatal_lines long, reason string")
        _report(raw.isolated_lines(reader, root, base), batch_id, out, base, now, missing)

    writer = notified_objects(notices, bucket, redelivery).writeStream.foreachBatch(process).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
