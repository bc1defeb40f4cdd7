"""Parametrised reports over the serving tables.

``strict`` checks its arguments and formats the result; without it arguments are taken as they come and the stored
columns are returned. Equality filters on ``date`` prune partitions of a stored table.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from clickfacts import schemas
from clickfacts.functions import columns as C

# Accepted metrics and their columns, default limits, default day of the lenient form.
METRICS = {"bounce_rate": "bounce_rate", "time_on_page": "avg_time_on_page"}
DEFAULT_LIMIT = 10
MAX_LIMIT = 100
DEFAULT_DATE = "2026-05-20"


def _parsed(day: str | None) -> datetime | None:
    try:
        return datetime.strptime(day or "", "%Y-%m-%d")
    except (TypeError, ValueError):
        return None


def on_date(df: DataFrame, day: str, strict: bool) -> DataFrame:
    """Rows of one day. A day not written ``YYYY-MM-DD`` is an error (strict) or matches nothing.

    A valid day without zero-filling, such as ``2026-5-2``, matches nothing in both forms: days are text keys.
    """
    parsed = _parsed(day)
    if strict and not day:
        raise ValueError("date is required (YYYY-MM-DD)")
    if strict and parsed is None:
        raise ValueError("date must have the form YYYY-MM-DD")
    if parsed is None or f"{parsed:%Y-%m-%d}" != day:
        return df.where(F.lit(False))
    return df.where(F.col("date") == F.lit(parsed.date()))


def _checked_limit(limit: int | str, most: int) -> int:
    try:
        n = int(limit)
    except (TypeError, ValueError):
        n = 0
    if not 1 <= n <= most:
        raise ValueError(f"limit must be an integer between 1 and {most}")
    return n


def pages_top(
    page_metrics: DataFrame,
    metric: str | None = None,
    date: str | None = None,
    limit: int | str = DEFAULT_LIMIT,
    strict: bool = True,
    most: int = MAX_LIMIT,
) -> DataFrame:
    """The ``limit`` pages of a day with the highest bounce rate or mean time.

    ``strict`` refuses a limit above ``most``; a caller that wants longer reports passes a larger one.
    """
    if strict:
        if metric not in METRICS:
            raise ValueError(f"metric must be one of {', '.join(METRICS)}")
        column, n = METRICS[metric], _checked_limit(limit, most)
    else:
        column = METRICS["bounce_rate" if metric in (None, "bounce_rate") else "time_on_page"]
        n, date = int(limit), DEFAULT_DATE if date is None else date
    order = [F.col(column).desc_nulls_last(), F.col("page_url")]
    top = on_date(page_metrics, date, strict).orderBy(*order).limit(n)
    if not strict:
        return top.select("date", "page_url", "page_type", "avg_time_on_page", "bounce_rate", "total_sessions")
    # Only the ``n`` rows of the report reach this window.
    rank = F.row_number().over(W.partitionBy("date").orderBy(*order))
    return top.select(
        rank.cast("bigint").alias("rank"),
        "page_url",
        "page_type",
        F.round("avg_time_on_page", 2).alias("avg_time_on_page_seconds"),
        F.round("bounce_rate", 4).alias("bounce_rate"),
        C.percent_text(F.col("bounce_rate")).alias("bounce_rate_pct"),
        "total_sessions",
    )


def _session_rows(
    summary: DataFrame, date: str | None, country: str | None, device: str | None, strict: bool
) -> DataFrame:
    if strict and device and device not in schemas.DEVICES:
        raise ValueError(f"device must be one of {', '.join(schemas.DEVICES)}")
    if not strict and date is None:
        date = DEFAULT_DATE
    rows = on_date(summary, date, strict)
    if country:
        rows = rows.where(F.col("country") == country.upper())
    if device:
        rows = rows.where(F.col("device_type") == (device if strict else device.lower()))
    return rows


def sessions_summary(
    session_summary: DataFrame,
    date: str | None = None,
    country: str | None = None,
    device: str | None = None,
    strict: bool = True,
    totals: bool = False,
) -> DataFrame:
    """Sessions, durations, views and users of a day by country and device, largest first.

    With ``totals`` a row with NULL country and device and ``is_total`` set holds the sums over all rows.
    """
    rows = _session_rows(session_summary, date, country, device, strict)
    if not strict:
        return rows.select(
            "date", "country", "device_type", "total_sessions", "avg_session_duration", "total_pageviews", "unique_users"
        )
    measures = [
        F.sum("total_sessions").alias("total_sessions"),
        F.avg("avg_session_duration").alias("avg_duration"),
        F.sum("total_pageviews").alias("total_pageviews"),
        F.sum("unique_users").alias("unique_users"),
    ]
    if totals:
        groups = [["country", "device_type"], []]
        grouped = rows.groupingSets(groups, "country", "device_type").agg(
            (F.grouping_id() > 0).alias("is_total"), *measures
        )
    else:
        grouped = rows.groupBy("country", "device_type").agg(*measures)
    duration = F.round("avg_duration", 2)
    out = grouped.select(
        "country",
        "device_type",
        "total_sessions",
        (F.when(~F.col("is_total"), duration) if totals else duration).alias("avg_session_duration_minutes"),
        "total_pageviews",
        "unique_users",
        C.safe_ratio(F.col("total_pageviews"), F.col("total_sessions")).alias("pageviews_per_session"),
        *(["is_total"] if totals else []),
    )
    first = [F.desc("is_total")] if totals else []
    return out.orderBy(*first, F.desc("total_sessions"), "country", "device_type")


def anomalies(table: DataFrame, date: str | None = None, strict: bool = True) -> DataFrame:
    """Anomalies of a day, highest score first; ``strict`` adds the severity of the unrounded score."""
    if not strict and date is None:
        date = DEFAULT_DATE
    rows = on_date(table, date, strict)
    order = [F.col("z_score").desc_nulls_last(), F.col("session_id"), F.col("anomaly_type")]
    columns = ["session_id", "user_id", "anomaly_type", "z_score", "metric_value", "description"]
    if not strict:
        return rows.orderBy(*order).select("date", *columns)
    return rows.orderBy(*order).select(
        "session_id",
        "user_id",
        "anomaly_type",
        F.round("z_score", 3).alias("z_score"),
        F.round("metric_value", 2).alias("metric_value"),
        "description",
        C.severity(F.col("z_score")).alias("severity"),
    )


def anomaly_counts(table: DataFrame) -> DataFrame:
    """Number of anomalies per day, type and severity."""
    return table.groupBy("date", "anomaly_type", C.severity(F.col("z_score")).alias("severity")).agg(
        F.count("*").alias("total_anomalies")
    )
