"""Validation of raw files: one pass over the text, then reports from the staged result."""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from clickfacts.functions import columns as C
from clickfacts.operators import quality
from clickfacts.session import configure
from clickfacts.sources import raw, tables


@dataclass(frozen=True)
class Ingest:
    """Validated lines and the reports derived from them."""

    checked: DataFrame
    base: str
    now: datetime
    files: DataFrame | None = None
    #: What the writes of the summary and the failures saw; filled by ``write``.
    seen: dict[str, Observation] = field(default_factory=dict)

    @property
    def totals(self) -> dict[str, float]:
        """Totals of the metrics, observed while ``write`` wrote its tables: they cost no job of their own."""
        if not self.seen:
            raise ValueError("totals are observed by write()")
        found = {**self.seen["summary"].get, **self.seen["failures"].get}
        return {name: float(value or 0) for name, value in found.items()}

    def _observed(self, name: str, df: DataFrame, **totals: Column) -> DataFrame:
        self.seen[name] = Observation(f"{name}-{uuid.uuid4().hex}")
        return df.observe(self.seen[name], *[c.alias(n) for n, c in totals.items()])

    @property
    def summary(self) -> DataFrame:
        return quality.file_summary(self.checked, self.base, self.files)

    @property
    def failures(self) -> DataFrame:
        return quality.failed_files(self.checked, self.base)

    @property
    def reports(self) -> DataFrame:
        """One report per file with invalid records; the records are in ``quarantine``."""
        return quality.quarantine(self.checked, F.lit(self.now), self.base)

    def first_reports(self, n: int) -> DataFrame:
        """Reports that also hold the first ``n`` invalid records of their file."""
        return quality.quarantine(self.checked, F.lit(self.now), self.base, n)

    @property
    def quarantine(self) -> DataFrame:
        """Every invalid record of the files that did not fail."""
        return quality.quarantine_table(self.checked, self.base)

    @property
    def metrics(self) -> DataFrame:
        return quality.ingest_metrics(self.summary, self.failures, F.lit(self.now))

    @property
    def valid_events(self) -> DataFrame:
        """Lines of valid records; the opt-in clean feed."""
        return quality.split_valid(self.checked)[0].select("path", "event_type", "line")

    def write_feed(self, root: str) -> None:
        """The valid records of files that did not fail as a raw zone, below the day of the file they came from."""
        kept = quality.split_valid(self.checked)[0].join(self.failures.select("path"), "path", "left_anti")
        day = C.path_date(C.object_key(F.col("path"), self.base))
        lines = kept.select("path", "block", "pos", F.col("line").alias("value"), "event_type", *raw.raw_partitions(day))
        raw.write_lines(lines, root, ["path", "block", "pos"])

    def write(self, out: str) -> None:
        """All outputs below ``out``: summary, failures, reports, quarantined records, metrics and the gated feed.

        A repeated run over the same files replaces all but the metrics, which are a log and are appended.
        """
        out = out.rstrip("/")
        summary = self._observed(
            "summary",
            self.summary,
            FilesProcessed=F.count("*"),
            RecordsValid=F.sum("valid"),
            RecordsInvalid=F.sum("invalid"),
            FileSizeBytes=F.sum("size_bytes"),
        )
        summary.write.mode("overwrite").parquet(f"{out}/file_summary")
        failures = self._observed("failures", self.failures, ProcessingErrors=F.count("*"))
        failures.write.mode("overwrite").parquet(f"{out}/failures")
        tables.write_reports(self.reports, f"{out}/reports", "overwrite")
        quarantined = self.quarantine.hint("rebalance", F.col("event_type"), F.col("date"))
        quarantined.write.mode("overwrite").partitionBy("event_type", "date").parquet(f"{out}/quarantine")
        tables.append_table(self.metrics, f"{out}/metrics")
        self.write_feed(f"{out}/feed")


def run(
    spark: SparkSession,
    root: str,
    base: str | None = None,
    now: datetime | None = None,
    checked_path: str | None = None,
    with_empty_files: bool = False,
    out: str | None = None,
    spread: bool = False,
    isolate: bool = True,
) -> Ingest:
    """Validate every line below ``root`` once, stage the outcome, and with ``out`` write all outputs below it.

    The text is read and parsed in a single pass; line positions are stored with the rows, so all reports agree on
    them, and every report reads only the columns it needs from the staged table. A gzip file that does not decode is
    one row of the failures and in no other report, unless ``isolate`` is off: then it fails the run.
    """
    configure(spark)
    base = raw.parent(root) if base is None else base
    lines = raw.read_lines(spark, root, base, spread=spread, isolate=isolate)
    checked = quality.stage_validated(lines, "checked", checked_path)
    files = raw.list_files(spark, root, base) if with_empty_files else None
    done = Ingest(checked, base, now or datetime.now(UTC), files)
    if out:
        done.write(out)
    return done
