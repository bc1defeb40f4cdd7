"""Cleaning and fact queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickfacts.functions import columns as C
from clickfacts.operators import clean, pages, sessions, sketches
from clickfacts.queries import sql as S
from clickfacts.queries.registry import day, events, page_views, query, rounded, stored_fact
from clickfacts.sources import star


@query(
    "clean_page_views",
    S.PV + """
SELECT date, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS viewed_at, session_id, user_id, page_url, page_type,
       device_type, country, seconds AS time_on_page_seconds
FROM pv
""",
)
def _clean_page_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_views(spark, sf_dir).select(
        day(),
        F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("viewed_at"),
        "session_id",
        "user_id",
        "page_url",
        "page_type",
        "device_type",
        "country",
        "time_on_page_seconds",
    )


@query(
    "impute_clamp",
    """
WITH t AS (SELECT event_id, CASE WHEN event_id % 20 = 3 THEN NULL ELSE (value - 20) * 500 END AS x FROM events)
SELECT event_id, round(CASE WHEN x IS NULL THEN 30.0 WHEN x < 0 THEN 0.0 WHEN x > 86400 THEN 86400.0 ELSE x END, 4)
       AS seconds
FROM t
""",
)
def _impute_clamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = F.when(F.col("event_id") % 20 != 3, (F.col("value") - 20) * 500)
    return events(spark, sf_dir).select("event_id", F.round(C.impute_clamp(x), 4).alias("seconds"))


@query(
    "dedup_page_views",
    S.PV + """
SELECT date, count(*) AS views, count(DISTINCT session_id) AS sessions, round(sum(seconds), 2) AS seconds
FROM pv GROUP BY date
""",
)
def _dedup_page_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = clean.parse_page_views(star.raw_page_views(events(spark, sf_dir)))
    unique = clean.dedup_page_views(parsed)
    per_session = unique.groupBy("date", "session_id").agg(
        F.count("*").alias("views"), F.sum(C.impute_clamp(F.col("time_on_page_seconds"))).alias("seconds")
    )
    return per_session.groupBy("date").agg(
        F.sum("views").alias("views"), F.count("*").alias("sessions"), F.round(F.sum("seconds"), 2).alias("seconds")
    ).select(day(), "views", "sessions", "seconds")


@query(
    "dedup_product_views",
    """
WITH copies AS (
  SELECT strftime(l_shipdate, '%Y-%m-%d') AS date, 'ORD-' || l_orderkey AS session_id,
         'PROD-' || l_partkey AS product_id, 'USR-' || o_custkey AS user_id, 'cat-' || l_returnflag AS category,
         CASE WHEN l_linenumber <> 3 THEN CAST(CAST(l_extendedprice AS DECIMAL(18, 2)) AS DOUBLE) END AS price,
         CAST(CASE WHEN copy = 0 THEN l_quantity WHEN l_linenumber % 2 = 0 THEN 0.5 END AS DOUBLE)
           AS time_on_page_seconds
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey, (VALUES (0), (1)) c(copy)
  WHERE (l_orderkey + l_partkey) % 29 <> 0
)
SELECT date, session_id, product_id, user_id, category, price, time_on_page_seconds
FROM copies
QUALIFY row_number() OVER (PARTITION BY date, session_id, product_id
  ORDER BY time_on_page_seconds DESC NULLS LAST, user_id DESC, category DESC, price DESC NULLS LAST) = 1
""",
)
def _dedup_product_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines, orders = star.fact_table(spark, sf_dir, "lineitem"), star.table(spark, sf_dir, "orders")
    return clean.clean_product_views(star.raw_product_views(lines, orders)).select(
        day(), "session_id", "product_id", "user_id", "category", "price", "time_on_page_seconds"
    )


@query(
    "dedup_cart_events",
    """
SELECT DISTINCT strftime(l_shipdate, '%Y-%m-%d') AS date, 'ORD-' || l_orderkey AS session_id,
       'PROD-' || l_partkey AS product_id,
       CASE WHEN l_linenumber % 5 IN (0, 1) THEN 'add' ELSE 'remove' END AS action, 'USR-' || o_custkey AS user_id
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
WHERE l_linenumber % 5 <> 4
""",
)
def _dedup_cart_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines, orders = star.fact_table(spark, sf_dir, "lineitem"), star.table(spark, sf_dir, "orders")
    return clean.clean_cart_events(star.raw_cart_events(lines, orders)).select(
        day(), "session_id", "product_id", "action", "user_id"
    )


@query(
    "page_stats",
    S.PAGE_STATS + """
SELECT date, page_url, page_type, round(avg_time_on_page_seconds, 4) AS avg_time_on_page_seconds, total_views,
       unique_sessions
FROM page_stats
""",
)
def _page_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.page_stats(page_views(spark, sf_dir)).select(
        day(), "page_url", "page_type", rounded("avg_time_on_page_seconds"), "total_views", "unique_sessions"
    )


@query(
    "top_pages",
    S.PV + """
SELECT page_url, page_type, round(avg(seconds), 4) AS avg_time_on_page_seconds, count(*) AS total_views,
       count(DISTINCT session_id) AS unique_sessions
FROM pv GROUP BY page_url, page_type
ORDER BY avg(seconds) DESC, page_url NULLS FIRST, page_type NULLS FIRST LIMIT 20
""",
)
def _top_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = pages.page_stats(page_views(spark, sf_dir), ("page_url", "page_type"))
    return pages.top_pages(stats).withColumn("avg_time_on_page_seconds", rounded("avg_time_on_page_seconds"))


@query(
    "top_pages_by_day",
    S.PAGE_STATS + """
SELECT date, row_number() OVER (PARTITION BY date
         ORDER BY avg_time_on_page_seconds DESC, page_url NULLS FIRST, page_type NULLS FIRST) AS rank,
       page_url, page_type, round(avg_time_on_page_seconds, 4) AS avg_time_on_page_seconds, total_views,
       unique_sessions
FROM page_stats
QUALIFY rank <= 20
""",
)
def _top_pages_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.top_pages_by_day(pages.page_stats(page_views(spark, sf_dir))).select(
        day(),
        F.col("rank").cast("bigint").alias("rank"),
        "page_url",
        "page_type",
        rounded("avg_time_on_page_seconds"),
        "total_views",
        "unique_sessions",
    )


@query(
    "session_type_counts",
    S.BOUNCE + "SELECT date, session_id, page_type, views FROM type_sessions",
)
def _session_type_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.session_counts(page_views(spark, sf_dir)).select(day(), "session_id", "page_type", "views")


_BOUNCE_SQL = S.BOUNCE + """
SELECT date, page_type, total, bounces, round(bounces / total, 4) AS bounce_rate FROM bounce
"""


@query("bounce_rate", _BOUNCE_SQL)
def bounce_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.bounce_rate(page_views(spark, sf_dir)).select(day(), "page_type", "total", "bounces", "bounce_rate")


@query("bounce_rate_join", _BOUNCE_SQL + "UNION ALL SELECT DISTINCT date, 'unseen', 0, 0, 0.0 FROM pv")
def _bounce_rate_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for every type of a day and for one that no session saw."""
    views = page_views(spark, sf_dir)
    seen = views.select("date", F.explode(F.array("page_type", F.lit("unseen"))).alias("page_type")).distinct()
    return pages.complete(pages.bounce_rate(views), seen).select(day(), "page_type", "total", "bounces", "bounce_rate")


@query("session_time", S.SESSION_TIME + "SELECT date, session_id, user_id, total_time FROM st")
def _session_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sessions.session_time(page_views(spark, sf_dir)).select(day(), "session_id", "user_id", "total_time")


@query(
    "time_stats",
    S.TIME_STATS + "SELECT date, round(m, 4) AS mean_time, round(s, 4) AS stddev_time, q1, q3 FROM stats",
)
def _time_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sessions.time_stats(sessions.session_time(page_views(spark, sf_dir))).select(
        day(), rounded("mean_time"), rounded("stddev_time"), "q1", "q3"
    )


@query(
    "session_anomalies",
    S.ANOMALIES + """
SELECT session_id, user_id, anomaly_type, round(z_score, 4) AS z_score, metric_value, description, date FROM anomalies
""",
)
def session_anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sessions.session_anomalies(sessions.session_time(page_views(spark, sf_dir))).select(
        "session_id", "user_id", "anomaly_type", rounded("z_score"), "metric_value", "description", day()
    )


@query(
    "page_metrics",
    S.PAGE_METRICS + """
SELECT date, page_url, page_type, round(avg_time_on_page, 4) AS avg_time_on_page, bounce_rate, total_sessions
FROM page_metrics
""",
)
def _page_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.page_metrics(page_views(spark, sf_dir)).select(
        day(), "page_url", "page_type", rounded("avg_time_on_page"), "bounce_rate", "total_sessions"
    )


@query(
    "session_summary",
    S.SESSION_SUMMARY + """
SELECT date, country, device_type, total_sessions, round(avg_session_duration, 8) AS avg_session_duration,
       total_pageviews, unique_users
FROM session_summary
""",
)
def _session_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sessions.session_summary(page_views(spark, sf_dir)).select(
        day(),
        "country",
        "device_type",
        "total_sessions",
        rounded("avg_session_duration", 8),
        "total_pageviews",
        "unique_users",
    )


@query(
    "rapid_clicks",
    """
WITH per_minute AS (
  SELECT strftime(ts, '%Y-%m-%d') AS date, user_id, date_trunc('minute', ts) AS minute, count(*) AS n
  FROM events GROUP BY ALL
),
rate AS (SELECT date, user_id, CAST(max(n) AS DOUBLE) AS clicks FROM per_minute GROUP BY date, user_id),
stats AS (
  SELECT date, avg(clicks) AS m, coalesce(nullif(stddev_samp(clicks), 0), 1) AS s FROM rate GROUP BY date
)
SELECT date, 'SES-' || user_id || '-' || replace(date, '-', '') AS session_id, 'USR-' || user_id AS user_id,
       'rapid_clicks' AS anomaly_type, round(abs((clicks - m) / s), 4) AS z_score, clicks AS metric_value
FROM rate JOIN stats USING (date)
WHERE abs((clicks - m) / s) >= 3
""",
)
def _rapid_clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sessions.rapid_clicks(star.clicks(events(spark, sf_dir))).select(
        day(), "session_id", "user_id", "anomaly_type", rounded("z_score"), "metric_value"
    )


def _week(c: str = "date") -> Column:
    return F.date_format(F.date_trunc("week", F.col(c)), "yyyy-MM-dd").alias("week")


@query(
    "quartiles_by_week",
    S.PV + """
SELECT strftime(date_trunc('week', CAST(date AS DATE)), '%Y-%m-%d') AS week, page_type, count(*) AS n,
       true AS q25_holds, true AS q50_holds, true AS q75_holds
FROM pv GROUP BY ALL
""",
)
def _quartiles_by_week(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quartiles of page time per week and type from stored daily summaries, held against the exact ranks of all views."""
    views = page_views(spark, sf_dir)
    daily = stored_fact(
        spark, sf_dir, "time-quantiles", lambda pv: sketches.quantile_sketches(pv, "time_on_page_seconds", ["date", "page_type"])
    )
    parts = {"q25": 0.25, "q50": 0.5, "q75": 0.75}
    merged = sketches.merge_quantiles(daily.withColumn("week", _week()), ["week", "page_type"])
    found = merged.select("week", F.col("page_type").alias("_type"), *[sketches.quantile(p).alias(q) for q, p in parts.items()])
    timed = views.select(_week(), "page_type", F.col("time_on_page_seconds").alias("t"))
    held = timed.withColumnRenamed("week", "_week").join(
        found, (F.col("_week") == F.col("week")) & F.col("page_type").eqNullSafe(F.col("_type"))
    )
    ranks = [c for q in parts for c in (F.avg((F.col("t") < F.col(q)).cast("int")).alias(f"{q}_lo"), F.avg((F.col("t") <= F.col(q)).cast("int")).alias(f"{q}_hi"))]
    ranked = held.groupBy("week", "page_type").agg(F.count("*").alias("n"), *ranks)
    # The quantile's rank is a range where its value repeats.
    holds = [
        ((F.col(f"{q}_lo") - F.lit(p) <= sketches.RANK_ERROR) & (F.lit(p) - F.col(f"{q}_hi") <= sketches.RANK_ERROR)).alias(f"{q}_holds")
        for q, p in parts.items()
    ]
    return ranked.select("week", "page_type", "n", *holds)


@query(
    "visitors_by_week",
    S.PV + """,
weekly AS (
  SELECT strftime(date_trunc('week', CAST(date AS DATE)), '%Y-%m-%d') AS week, page_url, user_id,
         count(*) FILTER (isodow(CAST(date AS DATE)) <= 3) > 0 AND count(*) FILTER (isodow(CAST(date AS DATE)) > 3) > 0 AS back
  FROM pv GROUP BY ALL
),
everyone AS (
  SELECT strftime(date_trunc('week', CAST(date AS DATE)), '%Y-%m-%d') AS week, '(all)' AS page_url, user_id,
         count(*) FILTER (isodow(CAST(date AS DATE)) <= 3) > 0 AND count(*) FILTER (isodow(CAST(date AS DATE)) > 3) > 0 AS back
  FROM pv GROUP BY ALL
)
SELECT week, page_url, count(*) AS visitors, count(*) FILTER (back) AS returning, true AS visitors_hold, true AS returning_hold
FROM (SELECT * FROM weekly UNION ALL SELECT * FROM everyone) GROUP BY ALL
""",
)
def _visitors_by_week(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visitors per url and week, and those of both its halves: exact, and whether stored daily summaries agree."""
    views = page_views(spark, sf_dir)
    daily = stored_fact(spark, sf_dir, "visitors", lambda pv: sketches.distinct_sketches(pv, "user_id", ["date", "page_url"]))
    half = F.when(F.weekday("date") < 3, "first").otherwise("second").alias("half")
    paged = sketches.merge_distinct(daily.withColumns({"week": _week(), "half": half}), ["week", "half", "page_url"])
    parts = paged.unionByName(sketches.merge_distinct(paged, ["week", "half"]).withColumn("page_url", F.lit("(all)")))
    halves = [parts.where(F.col("half") == h).drop("half") for h in ("first", "second")]
    both = sketches.returning(*halves, ["week", "page_url"]).select(
        "week", "page_url", sketches.distinct_count().alias("back"), sketches.distinct_count("union").alias("of")
    )
    estimates = sketches.merge_distinct(parts, ["week", "page_url"]).select("week", "page_url", sketches.distinct_count().alias("people"))
    # The exact form: one row per week, page and visitor.
    pages_of = views.select(_week(), F.explode(F.array("page_url", F.lit("(all)"))).alias("page_url"), "user_id", half)
    seen = pages_of.groupBy("week", "page_url", "user_id").agg(F.count_distinct("half").alias("halves"))
    exact = seen.groupBy("week", "page_url").agg(F.count("*").alias("visitors"), F.count_if(F.col("halves") == 2).alias("returning"))
    error = sketches.distinct_error()
    joined = exact.join(estimates, ["week", "page_url"], "left").join(both, ["week", "page_url"], "left").na.fill(0)
    return joined.select(
        "week", "page_url", "visitors", "returning",
        (F.abs(F.col("people") - F.col("visitors")) <= F.col("visitors") * error).alias("visitors_hold"),
        (F.abs(F.col("back") - F.col("returning")) <= F.col("of") * error).alias("returning_hold"),
    )
