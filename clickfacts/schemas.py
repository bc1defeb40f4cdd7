"""Record shapes and the event contract. Data only."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: event contract -------------------------------------------------------------
# Fields each event type must carry, in reporting order.
REQUIRED_FIELDS = {
    "page_view": (
        "event_type", "user_id", "session_id", "page_url", "page_type", "timestamp",
        "time_on_page_seconds", "referrer", "device_type", "country",
    ),
    "click": (
        "event_type", "user_id", "session_id", "element_id", "element_type", "page_url",
        "timestamp", "x_position", "y_position",
    ),
    "search": ("event_type", "user_id", "session_id", "query", "results_count", "timestamp"),
    "product_view": (
        "event_type", "user_id", "session_id", "product_id", "category", "price", "timestamp",
        "time_on_page_seconds",
    ),
    "cart_event": ("event_type", "user_id", "session_id", "product_id", "action", "timestamp"),
}
# Inclusive bounds; the listed fields must also be JSON numbers.
NUMERIC_BOUNDS = {
    "page_view": {"time_on_page_seconds": (0, 86400)},
    "click": {"x_position": (0, 7680), "y_position": (0, 4320)},
    "search": {"results_count": (0, 10000)},
    "product_view": {"price": (0, 100000), "time_on_page_seconds": (0, 86400)},
    "cart_event": {},
}
ALLOWED_VALUES = {
    "page_view": {
        "page_type": ("home", "category", "product", "cart", "checkout", "search", "other"),
        "device_type": ("mobile", "desktop", "tablet"),
    },
    "click": {},
    "search": {},
    "product_view": {},
    "cart_event": {"action": ("add", "remove")},
}
EVENT_TYPES = ("page_view", "click", "search", "product_view", "cart_event")
DEVICES = ("mobile", "desktop", "tablet")
CART_ACTIONS = ("add", "remove")
NON_EVENT_PREFIXES = ("quarantine/", "reference/")
# --- end of fixed values ----------------------------------------------------------------------


_STRING = T.StringType()


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, _STRING) for n in names])


# Raw events are read as text fields: a numeric read schema would turn a quoted number into NULL before
# the cleaning step could cast it.
RAW_EVENT_SCHEMAS = {kind: _strings(*names) for kind, names in REQUIRED_FIELDS.items()}

PRODUCT_CATALOG = T.StructType(
    [
        T.StructField("product_id", _STRING),
        T.StructField("name", _STRING),
        T.StructField("category", _STRING),
        T.StructField("price", T.DoubleType()),
    ]
)
USER_CATALOG = _strings("user_id", "country", "device_type")

PAGE_METRICS = T.StructType(
    [
        T.StructField("date", T.DateType()),
        T.StructField("page_url", _STRING),
        T.StructField("page_type", _STRING),
        T.StructField("avg_time_on_page", T.DoubleType()),
        T.StructField("bounce_rate", T.DoubleType()),
        T.StructField("total_sessions", T.LongType()),
    ]
)
SESSION_SUMMARY = T.StructType(
    [
        T.StructField("date", T.DateType()),
        T.StructField("country", _STRING),
        T.StructField("device_type", _STRING),
        T.StructField("total_sessions", T.LongType()),
        T.StructField("avg_session_duration", T.DoubleType()),
        T.StructField("total_pageviews", T.LongType()),
        T.StructField("unique_users", T.LongType()),
    ]
)
ANOMALIES = T.StructType(
    [
        T.StructField("date", T.DateType()),
        T.StructField("session_id", _STRING),
        T.StructField("user_id", _STRING),
        T.StructField("anomaly_type", _STRING),
        T.StructField("z_score", T.DoubleType()),
        T.StructField("metric_value", T.DoubleType()),
        T.StructField("description", _STRING),
    ]
)
# Primary keys of the serving tables.
PAGE_METRICS_KEY = ("date", "page_url")
SESSION_SUMMARY_KEY = ("date", "country", "device_type")
ANOMALIES_KEY = ("date", "session_id", "anomaly_type")
