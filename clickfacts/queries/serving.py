"""Reports over the serving tables, for one day of the data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickfacts.operators import pages, serve, sessions
from clickfacts.queries import sql as S
from clickfacts.queries.registry import day, query, rounded, stored_fact
from clickfacts.schemas import PAGE_METRICS_KEY
from clickfacts.sources import staging
from clickfacts.sources import tables as writes

# The reported day, country and device of the registered queries.
DAY = "2024-01-15"
COUNTRY = "n7"
DEVICE = "Mobile"


def _page_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored_fact(spark, sf_dir, "page_metrics", pages.page_metrics)


def _summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored_fact(spark, sf_dir, "session_summary", sessions.session_summary)


def _anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    def build(pv: DataFrame) -> DataFrame:
        return sessions.anomaly_table(sessions.session_anomalies(sessions.session_time(pv)))

    return stored_fact(spark, sf_dir, "anomalies", build)


def _top_sql(order: str, limit: int) -> str:
    return S.PAGE_METRICS + f"""
SELECT row_number() OVER (ORDER BY {order} DESC NULLS LAST, page_url) AS rank, page_url, page_type,
       round(avg_time_on_page, 2) AS avg_time_on_page_seconds, bounce_rate,
       printf('%.1f%%', round(bounce_rate * 100, 1)) AS bounce_rate_pct, total_sessions
FROM page_metrics WHERE date = '{DAY}'
QUALIFY rank <= {limit}
"""


@query("pages_top_bounce", _top_sql("bounce_rate", 10))
def _pages_top_bounce(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serve.pages_top(_page_metrics(spark, sf_dir), "bounce_rate", DAY)


@query("pages_top_time", _top_sql("avg_time_on_page", 25))
def _pages_top_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serve.pages_top(_page_metrics(spark, sf_dir), "time_on_page", DAY, 25)


@query(
    "pages_top_lax",
    S.PAGE_METRICS + f"""
SELECT date, page_url, page_type, round(avg_time_on_page, 4) AS avg_time_on_page, bounce_rate, total_sessions
FROM page_metrics WHERE date = '{DAY}'
ORDER BY page_metrics.avg_time_on_page DESC NULLS LAST, page_url LIMIT 10
""",
)
def _pages_top_lax(spark: SparkSession, sf_dir: str) -> DataFrame:
    top = serve.pages_top(_page_metrics(spark, sf_dir), "anything else", DAY, strict=False)
    return top.select(
        day(), "page_url", "page_type", rounded("avg_time_on_page"), "bounce_rate", "total_sessions"
    )


_SUMMARY_COLUMNS = """
       country, device_type, total_sessions, round(avg_session_duration, 2) AS avg_session_duration_minutes,
       total_pageviews, unique_users, round(total_pageviews / total_sessions, 2) AS pageviews_per_session"""


@query("sessions_summary", S.SESSION_SUMMARY + f"SELECT {_SUMMARY_COLUMNS} FROM session_summary WHERE date = '{DAY}'")
def _sessions_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serve.sessions_summary(_summary(spark, sf_dir), DAY)


@query(
    "sessions_summary_filtered",
    S.SESSION_SUMMARY + f"SELECT {_SUMMARY_COLUMNS} FROM session_summary WHERE date = '{DAY}' AND country = 'N7'",
)
def _sessions_summary_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serve.sessions_summary(_summary(spark, sf_dir), DAY, country=COUNTRY)


@query(
    "sessions_summary_rollup",
    S.SESSION_SUMMARY + f"""
SELECT country, device_type, CAST(sum(total_sessions) AS BIGINT) AS total_sessions,
       CASE WHEN grouping(country, device_type) = 0 THEN round(avg(avg_session_duration), 2) END
         AS avg_session_duration_minutes,
       CAST(sum(total_pageviews) AS BIGINT) AS total_pageviews, CAST(sum(unique_users) AS BIGINT) AS unique_users,
       round(sum(total_pageviews) / sum(total_sessions), 2) AS pageviews_per_session,
       CASE WHEN grouping(country, device_type) = 0 THEN 'group' ELSE 'total' END AS row_kind
FROM session_summary WHERE date = '{DAY}'
GROUP BY GROUPING SETS ((country, device_type), ())
""",
)
def _sessions_summary_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = serve.sessions_summary(_summary(spark, sf_dir), DAY, totals=True)
    return out.withColumn("row_kind", F.when(F.col("is_total"), "total").otherwise("group")).drop("is_total")


@query(
    "sessions_summary_lax",
    S.SESSION_SUMMARY + f"""
SELECT date, country, device_type, total_sessions, round(avg_session_duration, 8) AS avg_session_duration,
       total_pageviews, unique_users
FROM session_summary WHERE date = '{DAY}' AND device_type = 'mobile'
""",
)
def _sessions_summary_lax(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = serve.sessions_summary(_summary(spark, sf_dir), DAY, device=DEVICE, strict=False)
    return rows.withColumn("date", day()).withColumn("avg_session_duration", rounded("avg_session_duration", 8))


@query(
    "anomalies_by_date",
    S.ANOMALIES + f"""
SELECT session_id, user_id, anomaly_type, round(z_score, 3) AS z_score, round(metric_value, 2) AS metric_value,
       description, CASE WHEN z_score >= 4 THEN 'high' WHEN z_score >= 3 THEN 'medium' ELSE 'low' END AS severity
FROM anomalies WHERE date = '{DAY}'
""",
)
def _anomalies_by_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serve.anomalies(_anomalies(spark, sf_dir), DAY)


@query(
    "anomalies_lax",
    S.ANOMALIES + f"""
SELECT date, session_id, user_id, anomaly_type, round(z_score, 4) AS z_score, metric_value, description
FROM anomalies WHERE date = '{DAY}'
""",
)
def _anomalies_lax(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = serve.anomalies(_anomalies(spark, sf_dir), DAY, strict=False)
    return rows.withColumn("date", day()).withColumn("z_score", rounded("z_score"))


@query(
    "anomaly_counts",
    S.ANOMALIES + """
SELECT date, anomaly_type, CASE WHEN z_score >= 4 THEN 'high' WHEN z_score >= 3 THEN 'medium' ELSE 'low' END
         AS severity, count(*) AS total_anomalies
FROM anomalies GROUP BY ALL
""",
)
def _anomaly_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = serve.anomaly_counts(_anomalies(spark, sf_dir))
    return counts.select(day(), "anomaly_type", "severity", "total_anomalies")


@query(
    "insert_or_ignore",
    S.PAGE_METRICS + f"""
SELECT date, page_url, page_type, round(avg_time_on_page, 4) AS avg_time_on_page, bounce_rate,
       CASE WHEN date <= '{DAY}' THEN total_sessions ELSE total_sessions + 1000 END AS total_sessions
FROM page_metrics
""",
)
def _insert_or_ignore(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All days arrive twice at a stored table that holds the days up to ``DAY``; stored and first rows win."""
    metrics = _page_metrics(spark, sf_dir)
    stored = metrics.where(F.col("date") <= F.lit(DAY).cast("date"))
    again = F.explode(F.array(F.lit(1000), F.lit(2000)))
    arriving = metrics.withColumn("plus", again).withColumn("total_sessions", F.col("total_sessions") + F.col("plus"))
    path = staging.fresh_path(spark, "insert")
    writes.write_fact(stored, path)
    writes.append_new(arriving, path, PAGE_METRICS_KEY, ["plus"], ["plus"])
    merged = writes.read_fact(spark, path, metrics.schema)
    return merged.select(
        day(), "page_url", "page_type", rounded("avg_time_on_page"), "bounce_rate", "total_sessions"
    )
