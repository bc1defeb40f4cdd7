"""Page rankings, bounce rates and per-page metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# Fixed value: rows of the page ranking.
TOP_PAGES = 20


def page_stats(pv: DataFrame, by: Sequence[str] = ("date", "page_url", "page_type")) -> DataFrame:
    """Mean time, views and distinct sessions per page.

    The session level comes first: it merges a hot page per session on the map side and spreads it over all
    tasks, and turns the distinct count into a plain count.
    """
    per_session = pv.groupBy(*by, "session_id").agg(
        F.sum("time_on_page_seconds").alias("seconds"), F.count("*").alias("views")
    )
    return of_sessions(per_session, by)


def of_sessions(per_session: DataFrame, by: Sequence[str]) -> DataFrame:
    """Page statistics from one row of ``seconds`` and ``views`` per session."""
    return per_session.groupBy(*by).agg(
        (F.sum("seconds") / F.sum("views")).alias("avg_time_on_page_seconds"),
        F.sum("views").alias("total_views"),
        F.count("*").alias("unique_sessions"),
    )


def top_pages(stats: DataFrame, n: int = TOP_PAGES) -> DataFrame:
    """The ``n`` pages with the longest mean time; ties by url and type."""
    return stats.orderBy(F.desc("avg_time_on_page_seconds"), "page_url", "page_type").limit(n)


def top_pages_by_day(stats: DataFrame, n: int = TOP_PAGES) -> DataFrame:
    """``top_pages`` for every day at once, with the position in the day."""
    day = W.partitionBy("date").orderBy(F.desc("avg_time_on_page_seconds"), "page_url", "page_type")
    return stats.withColumn("rank", F.row_number().over(day)).where(F.col("rank") <= n)


def session_counts(pv: DataFrame, by: str = "page_type") -> DataFrame:
    """Views per day, session and page type (or another page attribute)."""
    return pv.groupBy("date", "session_id", by).agg(F.count("*").alias("views"))


def bounce_rate(pv: DataFrame, by: str = "page_type") -> DataFrame:
    """Share of sessions with exactly one view of a page type, per day.

    Sessions and bounces come out of one aggregate. The unknown (NULL) type never counts as bounced.
    """
    bounced = (F.col("views") == 1) & F.col(by).isNotNull()
    return (
        session_counts(pv, by)
        .groupBy("date", by)
        .agg(F.count("*").alias("total"), F.count_if(bounced).alias("bounces"))
        .withColumn("bounce_rate", F.round(F.col("bounces") / F.col("total"), 4))
    )


def complete(rates: DataFrame, groups: DataFrame, by: str = "page_type") -> DataFrame:
    """``rates`` with a row for every day and group of ``groups``, zeros for those without a session."""
    wanted = groups.select(F.col("date").alias("_date"), F.col(by).alias("_by"))
    on = F.col("date").eqNullSafe(F.col("_date")) & F.col(by).eqNullSafe(F.col("_by"))
    joined = wanted.join(rates, on, "left").select(
        F.col("_date").alias("date"), F.col("_by").alias(by), *[c for c in rates.columns if c not in ("date", by)]
    )
    return joined.na.fill(0, [c for c in rates.columns if c not in ("date", by)])


def page_metrics(pv: DataFrame) -> DataFrame:
    """Per day and url: mean time, share of sessions that saw it once, sessions. Not truncated."""
    per_session = pv.groupBy("date", "page_url", "session_id").agg(
        F.min("page_type").alias("page_type"),
        F.sum("time_on_page_seconds").alias("seconds"),
        F.count("*").alias("views"),
    )
    return per_session.groupBy("date", "page_url").agg(
        F.min("page_type").alias("page_type"),
        (F.sum("seconds") / F.sum("views")).alias("avg_time_on_page"),
        F.round(F.count_if(F.col("views") == 1) / F.count("*"), 4).alias("bounce_rate"),
        F.count("*").alias("total_sessions"),
    )
