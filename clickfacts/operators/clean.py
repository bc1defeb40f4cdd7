"""Cleaning and deterministic deduplication of page views, product views and cart events."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickfacts import schemas
from clickfacts.functions import columns as C

# What identifies an event. Days are processed separately, so ``date`` is part of every key.
PAGE_VIEW_KEY = ("date", "session_id", "page_url", "timestamp")
PRODUCT_VIEW_KEY = ("date", "session_id", "product_id", "timestamp")
CART_EVENT_KEY = ("date", "session_id", "product_id", "action", "timestamp")


def keep_one(df: DataFrame, key: Sequence[str], by: Sequence[str] = (), largest: bool = False) -> DataFrame:
    """One row per key: the smallest (or largest) by the columns ``by``, ties decided by all remaining columns.

    The result is the same on every run. An extreme over one struct merges on the map side, so many copies of one key
    shrink to one row per task before the shuffle. NULL keys compare equal; NULL is smaller than every value.
    """
    rest = [c for c in df.columns if c not in key and c not in by]
    pick = F.max if largest else F.min
    best = pick(F.struct(*by, *rest)).alias("best")
    return df.groupBy(*key).agg(best).select(*[c if c in key else F.col(f"best.{c}") for c in df.columns])


def parse_page_views(raw: DataFrame) -> DataFrame:
    """Typed and filtered page views, before deduplication and time repair."""
    return raw.na.drop(subset=["user_id", "session_id"]).withColumns(
        {
            "timestamp": F.try_to_timestamp("timestamp"),
            "time_on_page_seconds": C.to_double(F.col("time_on_page_seconds")),
            "page_type": C.lower_trim(F.col("page_type")),
            "device_type": C.lower_trim(F.col("device_type")),
            "country": C.upper_trim(F.col("country")),
        }
    )


def dedup_page_views(parsed: DataFrame) -> DataFrame:
    """One view per session, url and time; the longest one survives."""
    return keep_one(parsed, PAGE_VIEW_KEY, ["time_on_page_seconds", "user_id"], largest=True)


def unique_page_views(parsed: DataFrame) -> DataFrame:
    """Parsed page views one per key, time within a day."""
    return dedup_page_views(parsed).withColumn("time_on_page_seconds", C.impute_clamp(F.col("time_on_page_seconds")))


def clean_page_views(raw: DataFrame) -> DataFrame:
    """Page views ready for the facts: typed, attributed, one per key, time within a day."""
    return unique_page_views(parse_page_views(raw))


def parse_product_views(raw: DataFrame) -> DataFrame:
    """Typed product views with a product; times are not repaired."""
    return raw.na.drop(subset=["product_id"]).withColumns(
        {
            "timestamp": F.try_to_timestamp("timestamp"),
            "price": C.to_double(F.col("price")),
            "time_on_page_seconds": C.to_double(F.col("time_on_page_seconds")),
        }
    )


def dedup_product_views(parsed: DataFrame) -> DataFrame:
    """One view per session, product and time; the longest one survives."""
    return keep_one(parsed, PRODUCT_VIEW_KEY, ["time_on_page_seconds", "user_id"], largest=True)


def clean_product_views(raw: DataFrame) -> DataFrame:
    """Product views with a product, one per session, product and time; times are not repaired."""
    return dedup_product_views(parse_product_views(raw))


def parse_cart_events(raw: DataFrame) -> DataFrame:
    """Typed cart events with a known action."""
    return raw.withColumns(
        {"timestamp": F.try_to_timestamp("timestamp"), "action": C.lower_trim(F.col("action"))}
    ).where(F.col("action").isin(*schemas.CART_ACTIONS))


def dedup_cart_events(parsed: DataFrame) -> DataFrame:
    """One event per session, product, action and time."""
    return keep_one(parsed, CART_EVENT_KEY, ["user_id"], largest=True)


def clean_cart_events(raw: DataFrame) -> DataFrame:
    """Cart events with a known action, one per session, product, action and time."""
    return dedup_cart_events(parse_cart_events(raw))


def union_events(*frames: DataFrame) -> DataFrame:
    """All typed event frames as one, absent fields NULL."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out
