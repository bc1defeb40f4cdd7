"""Daily facts: raw zone in, fact and serving tables out, any number of days in one job."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from clickfacts.operators import clean, pages, sessions
from clickfacts.session import configure
from clickfacts.sources import raw, staging, tables

FACT_TABLES = (
    "top_pages_by_time",
    "bounce_rate_by_page_type",
    "anomalies",
    "page_metrics",
    "session_summary",
)
# Tables of the cleaned feeds that a daily run writes beside the facts.
FEED_TABLES = {"product_view": "product_views", "cart_event": "cart_events"}


def facts(pv: DataFrame) -> dict[str, DataFrame]:
    """All fact tables over cleaned page views."""
    st = sessions.session_time(pv)
    return {
        "top_pages_by_time": pages.top_pages_by_day(pages.page_stats(pv)).drop("rank"),
        "bounce_rate_by_page_type": pages.bounce_rate(pv),
        "anomalies": sessions.anomaly_table(sessions.session_anomalies(st)),
        "page_metrics": pages.page_metrics(pv),
        "session_summary": sessions.session_summary(pv),
    }


def run(
    spark: SparkSession, raw_root: str, out_root: str, dates: Iterable[date] | None = None
) -> dict[str, DataFrame]:
    """Build and write the facts and feeds of the given days (all days by default); returns the stored tables.

    The cleaned page views are staged once, so the raw JSON is parsed and deduplicated a single time for all facts.
    Each table replaces exactly the processed days: a repeated run gives the same tables. All tables are written before
    any is read back, with their schemas, so a table without rows is an empty one. ``raw_root`` may be the gated feed
    of ``ingest.run``.
    """
    configure(spark)
    wanted = set(dates) if dates is not None else None
    cleaned = clean.clean_page_views(raw.read_events(spark, raw_root, "page_view", wanted))
    staged = staging.fresh_path(spark, "page-views")
    pv = staging.stage(
        cleaned.select(
            "date", "session_id", "user_id", "page_url", "page_type", "device_type", "country", "time_on_page_seconds"
        ),
        "page-views",
        staged,
    )
    days = tables.days_of(pv) if wanted is None else wanted
    out = {**facts(pv), **{FEED_TABLES[kind]: df for kind, df in feeds(spark, raw_root, wanted).items()}}
    root = out_root.rstrip("/")
    for name, df in out.items():
        tables.write_fact(df, f"{root}/{name}", days)
    staging.discard(spark, staged)
    return {name: tables.read_fact(spark, f"{root}/{name}", df.schema) for name, df in out.items()}


def feeds(spark: SparkSession, raw_root: str, dates: Iterable[date] | None = None) -> dict[str, DataFrame]:
    """Cleaned product views and cart events; empty where the zone has none."""
    days = list(dates) if dates is not None else None
    return {
        "product_view": clean.clean_product_views(raw.read_events(spark, raw_root, "product_view", days)),
        "cart_event": clean.clean_cart_events(raw.read_events(spark, raw_root, "cart_event", days)),
    }
