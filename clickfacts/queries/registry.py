"""Registry of named queries and shared inputs."""

from __future__ import annotations

from collections.abc import Callable
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickfacts.operators import clean, quality
from clickfacts.plans import ingest
from clickfacts.session import configure
from clickfacts.sources import raw, staging, star, tables

Runner = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Runner] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Runner], Runner]:
    """Register a query under ``name``; without ``sql`` it has no SQL counterpart."""

    def register(run: Runner) -> Runner:
        def ready(spark: SparkSession, sf_dir: str) -> DataFrame:
            return run(configure(spark), sf_dir)

        QUERIES[name] = ready
        if sql is not None:
            ORACLES[name] = sql.strip()
        return run

    return register


def day(c: str = "date") -> Column:
    """Date as text, the form it has in every result."""
    return F.date_format(c, "yyyy-MM-dd").alias("date")


def rounded(c: str, digits: int = 4, name: str | None = None) -> Column:
    return F.round(c, digits).alias(name or c)


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.fact_table(spark, sf_dir, "events")


def dealt_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` before work that is long for every row."""
    return star.dealt(events(spark, sf_dir))


def page_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.clean_page_views(star.raw_page_views(events(spark, sf_dir)))


# Raw zones, stored facts and validated lines are derived from the tables once per application, input folder and state
# of its files, and shared by the queries over them.
_ZONES: dict[tuple[str, str, str, int, int], str] = {}


def _state(spark: SparkSession, sf_dir: str) -> tuple[int, int]:
    """Size and time of the input, so that changed files are derived from again."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/events.parquet")
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return files.getContentSummary(path).getLength(), files.getFileStatus(path).getModificationTime()


def _zone(spark: SparkSession, sf_dir: str, name: str, write: Callable[[str], None]) -> str:
    key = (spark.sparkContext.applicationId, sf_dir, name, *_state(spark, sf_dir))
    if key not in _ZONES:
        root = f"{staging.fresh_path(spark, name)}/raw"
        write(root)
        _ZONES[key] = root
    return _ZONES[key]


def line_zone(spark: SparkSession, sf_dir: str) -> str:
    """All events as raw lines, faults and blank lines included; one file per type and day, however large."""

    def write(root: str) -> None:
        raw.write_lines(star.raw_files(dealt_events(spark, sf_dir)), root, ["event_id", "part"], whole=True)

    return _zone(spark, sf_dir, "lines", write)


def weekly_zone(spark: SparkSession, sf_dir: str) -> str:
    """The lines of ``line_zone`` under the first day of their week."""

    def write(root: str) -> None:
        lines = star.raw_files(dealt_events(spark, sf_dir), F.date_trunc("week", "ts"))
        raw.write_lines(lines, root, ["event_id", "part"], whole=True)

    return _zone(spark, sf_dir, "weekly", write)


def typed_zone(spark: SparkSession, sf_dir: str) -> str:
    """Well-formed events of all five types."""
    frames = star.typed_events(events(spark, sf_dir)).values()
    both = clean.union_events(*frames)
    return _zone(spark, sf_dir, "typed", lambda root: raw.write_raw(both, root, F.col("date")))


def view_zone(spark: SparkSession, sf_dir: str) -> str:
    """All events as page views with blemishes; no other event type present."""
    views = star.raw_page_views(events(spark, sf_dir))
    return _zone(spark, sf_dir, "views", lambda root: raw.write_raw(views, root, F.col("date")))


#: Events that are shuffled at a time, about: their shuffle files go before the next.
ROUND_ROWS = 60_000_000


def in_rounds(frame: DataFrame, rows: int) -> list[DataFrame]:
    """A frame of about ``rows`` events as parts of about ``ROUND_ROWS``, a session in one of them.

    The condition is on the session alone, so that it reaches the tables below a join or an aggregate by session.
    """
    n = max(1, -(-rows // ROUND_ROWS))
    return [frame] if n == 1 else [frame.where(F.pmod(F.xxhash64("session_id"), F.lit(n)) == i) for i in range(n)]


def scattered_zone(spark: SparkSession, sf_dir: str, kind: str, together: bool = False) -> str:
    """Events of one type in two files to a type and day (products: year); copies lie apart unless ``together``.

    Page views of some minutes have no day: their path names no date. A zone whose copies lie apart is the caller's own,
    who may take its files away.
    """
    rows = 0
    if kind == "page_view":
        frame = star.raw_page_views(dealt_events(spark, sf_dir))
        undated = F.minute(F.try_to_timestamp("timestamp")) % 13 == 0
        frame = frame.withColumn("date", F.when(~undated, F.col("date")))
    else:
        lines, orders = (star.fact_table(spark, sf_dir, t) for t in ("lineitem", "orders"))
        frame = {"product_view": star.raw_product_views, "cart_event": star.raw_cart_events}[kind](lines, orders)
        frame = frame.withColumn("date", F.trunc("date", "year"))
        rows = 2 * star.table(spark, sf_dir, "lineitem").count()
    by = ["session_id", "page_url", "timestamp"] if together else frame.columns

    def write(root: str) -> None:
        for i, some in enumerate(in_rounds(frame, rows)):
            raw.write_scattered(some, root, F.col("date"), 2, by, mode="append" if i else "overwrite")

    if together:
        return _zone(spark, sf_dir, f"together-{kind}", write)
    root = f"{staging.fresh_path(spark, f'apart-{kind}')}/raw"
    write(root)
    return root


def stored_fact(spark: SparkSession, sf_dir: str, name: str, build: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """A fact over the page views as a table partitioned by day, written once and read back."""
    df = build(page_views(spark, sf_dir))
    path = _zone(spark, sf_dir, name, lambda root: tables.write_fact(df, root))
    return tables.read_fact(spark, path, df.schema)


_CHECKED: dict[tuple[str, str, int, int], DataFrame] = {}


def checked_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events as validated lines: parsed once, stored, and read by column."""
    key = (spark.sparkContext.applicationId, sf_dir, *_state(spark, sf_dir))
    if key not in _CHECKED:
        _CHECKED[key] = quality.stage_validated(star.raw_lines(dealt_events(spark, sf_dir)), "checked-lines")
    return _CHECKED[key]


_INGESTS: dict[tuple[str, str], ingest.Ingest] = {}


def ingested(spark: SparkSession, sf_dir: str, zone: Callable[[SparkSession, str], str] = line_zone) -> ingest.Ingest:
    """The validated zone, staged once per application and zone."""
    root = zone(spark, sf_dir)
    key = (spark.sparkContext.applicationId, root)
    if key not in _INGESTS:
        _INGESTS[key] = ingest.run(spark, root, now=datetime(2024, 2, 1, 1, 2, 3, tzinfo=UTC), spread=True)
    return _INGESTS[key]
