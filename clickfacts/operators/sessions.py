"""Session times, their statistics, outliers and the session summary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickfacts.operators.clean import keep_one
from clickfacts.schemas import ANOMALIES_KEY

# Outlier limits and texts.
Z_LIMIT = 3.0
IQR_FACTOR = 1.5
HIGH_TIME = "high_time_on_page"
RAPID_CLICKS = "rapid_clicks"
TIME_TEXT = ("Tiempo anomalo: ", " seg")
CLICK_TEXT = ("Clics por minuto: ", "")


def session_time(pv: DataFrame) -> DataFrame:
    """Total page time per day, session and user.

    Rounded to microseconds, so the total does not depend on the order of summation.
    """
    return pv.groupBy("date", "session_id", "user_id").agg(
        F.round(F.sum("time_on_page_seconds"), 6).alias("total_time")
    )


def time_stats(st: DataFrame, value: str = "total_time") -> DataFrame:
    """Mean, sample deviation and approximate quartiles per day, safe to divide by."""
    quartiles = F.percentile_approx(value, [0.25, 0.75])
    stats = st.groupBy("date").agg(
        F.mean(value).alias("m"), F.stddev(value).alias("s"), quartiles.alias("q")
    )
    return stats.select(
        "date",
        F.coalesce("m", F.lit(0.0)).alias("mean_time"),
        F.coalesce(F.nullif("s", F.lit(0.0)), F.lit(1.0)).alias("stddev_time"),
        F.coalesce(F.get("q", F.lit(0)), F.lit(0.0)).alias("q1"),
        F.coalesce(F.get("q", F.lit(1)), F.lit(0.0)).alias("q3"),
    )


def _outliers(
    st: DataFrame, value: str, kind: str, text: tuple[str, str], z: float, k: float | None
) -> DataFrame:
    # One row of statistics per day; the measured size decides how they are joined. Sessions without a date are
    # compared among themselves.
    stats = time_stats(st, value).withColumnRenamed("date", "_day")
    scored = st.join(stats, F.col("date").eqNullSafe(F.col("_day"))).withColumn(
        "z_score", F.abs((F.col(value) - F.col("mean_time")) / F.col("stddev_time"))
    )
    hit: Column = F.col("z_score") >= z
    if k is not None:
        reach = (F.col("q3") - F.col("q1")) * k
        hit = hit | (F.col(value) < F.col("q1") - reach) | (F.col(value) > F.col("q3") + reach)
    return scored.where(hit).select(
        "session_id",
        "user_id",
        F.lit(kind).alias("anomaly_type"),
        "z_score",
        F.col(value).cast("double").alias("metric_value"),
        F.concat(F.lit(text[0]), F.col(value).cast("string"), F.lit(text[1])).alias("description"),
        "date",
    )


def session_anomalies(st: DataFrame, z: float = Z_LIMIT, k: float = IQR_FACTOR) -> DataFrame:
    """Sessions whose total time is far from the day's mean or outside its quartile fences, both tails."""
    return _outliers(st, "total_time", HIGH_TIME, TIME_TEXT, z, k)


def click_rate(clicks: DataFrame) -> DataFrame:
    """Highest number of clicks within one minute, per day, session and user."""
    minute = F.window("timestamp", "1 minute")["start"]
    per_minute = clicks.groupBy("date", "session_id", "user_id", minute.alias("minute")).agg(F.count("*").alias("n"))
    return per_minute.groupBy("date", "session_id", "user_id").agg(F.max("n").cast("double").alias("clicks_per_minute"))


def rapid_clicks(clicks: DataFrame, z: float = Z_LIMIT) -> DataFrame:
    """Sessions whose click rate is far from the day's mean."""
    return _outliers(click_rate(clicks), "clicks_per_minute", RAPID_CLICKS, CLICK_TEXT, z, None)


def anomaly_table(anomalies: DataFrame) -> DataFrame:
    """Anomalies at the key of the serving table; on a clash the highest score stays, then the lowest user."""
    ranked = anomalies.withColumn("_down", -F.col("z_score"))
    return keep_one(ranked, ANOMALIES_KEY, ["_down", "user_id"]).drop("_down")


def session_summary(pv: DataFrame) -> DataFrame:
    """Sessions, mean session minutes, views and users per day, country and device."""
    by = ["date", "country", "device_type"]
    visits = pv.groupBy(*by, "session_id", "user_id").agg(
        F.sum("time_on_page_seconds").alias("seconds"), F.count("*").alias("views")
    )
    # Sessions and users are counted level by level, without a copy of every row per distinct count.
    per_session = visits.groupBy(*by, "session_id").agg(F.sum("seconds").alias("seconds"), F.sum("views").alias("views"))
    sessions = per_session.groupBy(*by).agg(
        F.count("session_id").alias("total_sessions"), F.sum("seconds").alias("seconds"), F.sum("views").alias("total_pageviews")
    )
    users = visits.groupBy(*by, "user_id").agg(F.lit(1).alias("one")).groupBy(*by).agg(F.count("user_id").alias("unique_users"))
    same = F.lit(True)
    for c in by:
        same = same & F.col(f"s.{c}").eqNullSafe(F.col(f"u.{c}"))
    return sessions.alias("s").join(users.alias("u"), same).select(
        *[F.col(f"s.{c}") for c in by],
        "total_sessions",
        (F.col("seconds") / 60.0 / F.col("total_sessions")).alias("avg_session_duration"),
        "total_pageviews",
        "unique_users",
    )
