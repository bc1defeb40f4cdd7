"""Record validation, file summaries, quarantine reports and ingest metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from clickfacts.functions import columns as C
from clickfacts.functions import rules
from clickfacts.session import expression_code
from clickfacts.sources import staging

VALID, INVALID, FATAL = "valid", "invalid", "fatal"
# Column of a line frame that says why a file cannot be decoded; such a row fails its file.
BROKEN = "broken"


def validate(lines: DataFrame, line: str = "line") -> DataFrame:
    """Adds ``event_type`` (of the payload), ``status`` and ``errors`` to a frame of JSON lines.

    ``status`` is valid, invalid, or fatal for a record that fails its whole file. A stored frame can be filtered and
    counted by it without reading the errors.

    The outcome leaves through a one-element ``inline``: later filters on it stop there instead of being pushed down
    with a second copy of all parsing and checking in them.
    """
    keep = lines.columns
    parsed = rules.with_value(lines.withColumn(line, C.strip(F.col(line))), line)
    found, fatal = rules.compiled(lines.sparkSession.sparkContext.applicationId)
    fatal = ~F.is_valid_utf8(F.col(line)) | fatal
    if BROKEN in lines.columns:
        fatal = F.col(BROKEN).isNotNull() | F.coalesce(fatal, F.lit(False))
    judged = parsed.select(*keep, F.col(rules.KIND), fatal.alias("_fatal"), found.alias("_errors"))
    status = F.when(F.col("_fatal"), FATAL).when(F.size("_errors") == 0, VALID).otherwise(INVALID)
    errors = F.when(F.col("_fatal"), F.array().cast(rules.ERRORS_TYPE)).otherwise(F.col("_errors"))
    outcome = F.struct(F.col(rules.KIND).alias("event_type"), status.alias("status"), errors.alias("errors"))
    return judged.select(*keep, F.inline(F.array(outcome)))


def stage_validated(lines: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """``validate`` written once and read back.

    The checks of all event types are more code than one method can hold, so the write compiles them one by one.
    """
    checked = validate(lines)
    with expression_code(lines.sparkSession):
        return staging.stage(checked, name, path)


def is_valid() -> Column:
    return F.col("status") == VALID


def is_invalid() -> Column:
    return F.col("status") == INVALID


def is_fatal() -> Column:
    return F.col("status") == FATAL


def split_valid(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Valid and invalid records; records that fail their file are in neither."""
    return checked.where(is_valid()), checked.where(is_invalid())


def blocks(checked: DataFrame) -> DataFrame:
    """One row per scan split: its lines, its first position and the lines of the file before it.

    The window runs over splits, not lines, so a file that holds a large part of all lines is still a short group.
    """
    per_block = checked.groupBy("path", "block").agg(F.count("*").alias("lines"), F.min("pos").alias("first_pos"))
    earlier = W.partitionBy("path").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    return per_block.withColumn("lines_before", F.coalesce(F.sum("lines").over(earlier), F.lit(0)))


def number_lines(rows: DataFrame, block_index: DataFrame) -> DataFrame:
    """Adds ``line_no``, counted from 1 over the non-blank lines of a file.

    ``rows`` may be any subset of the frame ``block_index`` was built from.
    """
    index = block_index.select("path", "block", "first_pos", "lines_before")
    number = F.col("lines_before") + F.col("pos") - F.col("first_pos") + 1
    return (
        rows.join(index, ["path", "block"])
        .withColumn("line_no", number.cast("bigint"))
        .drop("first_pos", "lines_before")
    )


def failed_files(checked: DataFrame, base: str = "/") -> DataFrame:
    """Files with at least one record that cannot be processed at all, or that cannot be decoded: ``reason`` says why."""
    why = F.max(BROKEN) if BROKEN in checked.columns else F.lit(None).cast("string")
    hit = checked.where(is_fatal()).groupBy("path").agg(F.count("*").alias("fatal_lines"), why.alias("reason"))
    return hit.select("path", C.object_key(F.col("path"), base).alias("failure_key"), "fatal_lines", "reason")


def file_summary(checked: DataFrame, base: str = "/", files: DataFrame | None = None) -> DataFrame:
    """Counts and error rate per file, failed files left out.

    With ``files`` (path, size_bytes) files without any line appear with zeros.
    """
    per_file = checked.groupBy("path").agg(
        F.max("size_bytes").alias("size_bytes"),
        F.count("*").alias("total"),
        F.count_if(is_valid()).alias("valid"),
        F.count_if(is_invalid()).alias("invalid"),
        F.bool_or(is_fatal()).alias("failed"),
    )
    if files is not None:
        per_file = (
            files.select("path", F.col("size_bytes").alias("_size"))
            .join(per_file, "path", "left")
            .withColumn("size_bytes", F.coalesce("size_bytes", "_size"))
            .drop("_size")
            .na.fill({"total": 0, "valid": 0, "invalid": 0, "failed": False})
        )
    rate = F.when(F.col("total") > 0, F.round(F.col("invalid") / F.col("total") * 100, 2)).otherwise(0.0)
    keyed = per_file.where(~F.col("failed")).withColumn("key", C.object_key(F.col("path"), base))
    return keyed.select(
        "path",
        "key",
        C.path_event_type(F.col("key")).alias("event_type"),
        "size_bytes",
        "total",
        "valid",
        "invalid",
        rate.alias("error_rate_pct"),
    )


def first_invalid(checked: DataFrame, n: int) -> DataFrame:
    """The first ``n`` invalid records of every file, by position; every task keeps at most ``n`` before the shuffle."""
    whole = W.partitionBy("path").orderBy("block", "pos")
    ranked = checked.where(is_invalid()).withColumn("rank", F.row_number().over(whole))
    return ranked.where(F.col("rank") <= n)


def quarantine_records(checked: DataFrame, n: int | None = None) -> DataFrame:
    """Invalid records of every file that did not fail: line number, event or whole raw line, errors.

    All of them, or with ``n`` the first of every file.
    """
    bad = checked.where(is_invalid()) if n is None else first_invalid(checked, n)
    kept = bad.join(failed_files(checked).select("path"), "path", "left_anti")
    numbered = number_lines(kept, blocks(checked))
    broken = F.exists("errors", lambda e: e["code"] == "INVALID_JSON")
    return numbered.select(
        "path",
        "line_no",
        F.when(~broken, F.col("line")).alias("event"),
        F.when(broken, F.col("line")).alias("raw"),
        "errors",
    )


def quarantine_table(checked: DataFrame, base: str = "/") -> DataFrame:
    """Every invalid record, one row each, with the event type and day its file's key names."""
    key = C.object_key(F.col("path"), base)
    return quarantine_records(checked).select(
        "*", C.path_event_type(key).alias("event_type"), C.path_date(key).alias("date")
    )


def quarantine(checked: DataFrame, now: Column, base: str = "/", n: int | None = None) -> DataFrame:
    """One report per file with invalid records: counts, and with ``n`` its first records in line order.

    The records themselves are in ``quarantine_table``, whatever their number.
    """
    report = file_summary(checked, base).where(F.col("invalid") > 0)
    columns = [
        C.quarantine_key(F.col("key"), now).alias("quarantine_key"),
        F.col("key").alias("original_key"),
        F.col("event_type"),
        F.date_format(now, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("processed_at"),
        F.col("total").alias("total_records"),
        F.col("invalid").alias("invalid_count"),
        F.col("error_rate_pct"),
    ]
    if n is None:
        return report.select(*columns)
    records = (
        quarantine_records(checked, n)
        .groupBy("path")
        .agg(F.sort_array(F.collect_list(F.struct("line_no", "event", "raw", "errors"))).alias("invalid_events"))
    )
    return report.join(records, "path").select(*columns, "invalid_events")


def ingest_metrics(summary: DataFrame, failures: DataFrame, now: Column) -> DataFrame:
    """Metric points in long form: four per processed file, one per failed file."""
    point = "name string, value double, unit string"
    points = F.array(
        F.struct(F.lit("FilesProcessed"), F.lit(1.0), F.lit("Count")),
        F.struct(F.lit("RecordsValid"), F.col("valid").cast("double"), F.lit("Count")),
        F.struct(F.lit("RecordsInvalid"), F.col("invalid").cast("double"), F.lit("Count")),
        F.struct(F.lit("FileSizeBytes"), F.col("size_bytes").cast("double"), F.lit("Bytes")),
    ).cast(f"array<struct<{point.replace(' ', ':').replace(',:', ',')}>>")
    processed = summary.select(
        F.inline(points), F.lit("EventType").alias("dimension"), F.col("event_type").alias("dimension_value")
    )
    failed = failures.select(
        F.lit("ProcessingErrors").alias("name"),
        F.lit(1.0).alias("value"),
        F.lit("Count").alias("unit"),
        F.lit("S3Key").alias("dimension"),
        F.col("failure_key").alias("dimension_value"),
    )
    return processed.unionByName(failed).withColumn("timestamp", now)


def error_profile(checked: DataFrame) -> DataFrame:
    """Records per payload event type, error code and field."""
    flat = checked.where(is_invalid()).select("event_type", F.explode("errors").alias("e"))
    return flat.groupBy("event_type", F.col("e.code").alias("code"), F.col("e.field").alias("field")).agg(
        F.count("*").alias("records")
    )
