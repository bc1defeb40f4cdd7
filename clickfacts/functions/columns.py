"""Normalisation, clamping, formatting and path helpers used by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Page-time repair and severity limits.
DEFAULT_SECONDS = 30.0
MIN_SECONDS = 0.0
MAX_SECONDS = 86400.0
SEVERITY_HIGH = 4.0
SEVERITY_MEDIUM = 3.0

# Every character a text strip removes at the ends of a line.
STRIP_CHARS = (
    " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def lower_trim(c: Column) -> Column:
    return F.lower(F.trim(c))


def upper_trim(c: Column) -> Column:
    return F.upper(F.trim(c))


def strip(c: Column) -> Column:
    return F.trim(c, F.lit(STRIP_CHARS))


def to_double(c: Column) -> Column:
    """Numeric coercion; text that is not a number gives NULL under ANSI mode too."""
    return c.try_cast("double")


def impute_clamp(
    c: Column, default: float = DEFAULT_SECONDS, low: float = MIN_SECONDS, high: float = MAX_SECONDS
) -> Column:
    """NULL becomes ``default``, the rest is pulled into [low, high]; NaN sorts above everything, so it gives ``high``."""
    return F.greatest(F.lit(low), F.least(F.lit(high), F.coalesce(c, F.lit(default))))


def safe_ratio(num: Column, den: Column, digits: int = 2) -> Column:
    """``num / den`` rounded; 0 where the denominator is 0 or missing."""
    return F.when(F.coalesce(den, F.lit(0)) == 0, F.lit(0.0)).otherwise(
        F.round(F.try_divide(num.cast("double"), den.cast("double")), digits)
    )


def percent_text(c: Column) -> Column:
    return F.format_string("%.1f%%", F.round(c * 100, 1))


def severity(z: Column) -> Column:
    return F.when(z >= SEVERITY_HIGH, "high").when(z >= SEVERITY_MEDIUM, "medium").otherwise("low")


def object_key(path: Column, base: str = "/") -> Column:
    """Key of a file below ``base``: the file URI without scheme, host and base folder, percent-escapes decoded.

    A ``+`` in a file URI is a literal plus, so it is escaped before decoding.
    """
    local = F.regexp_replace(path, r"^[a-zA-Z][a-zA-Z0-9+.-]*:(//[^/]*)?(?=/)", "")
    local = F.url_decode(F.replace(local, F.lit("+"), F.lit("%2B")))
    stem = base.rstrip("/") + "/"
    return F.when(F.startswith(local, F.lit(stem)), F.substr(local, F.lit(len(stem) + 1))).otherwise(local)


def notified_key(c: Column) -> Column:
    """Key as it stands in an object-store notification: form-encoded, ``+`` means space."""
    return F.try_url_decode(c)


def path_event_type(key: Column) -> Column:
    """Value of the first ``event_type=`` path segment, ``unknown`` without one."""
    pattern = r"(?:^|/)event_type=([^/=]*)"
    return F.when(key.rlike(pattern), F.regexp_extract(key, pattern, 1)).otherwise("unknown")


def path_date(key: Column) -> Column:
    """Date from ``year=/month=/day=`` path segments, NULL when they are missing or no date."""
    parts = [F.regexp_extract(key, rf"(?:^|/){p}=(\d+)", 1) for p in ("year", "month", "day")]
    text = F.concat_ws("-", parts[0], F.lpad(parts[1], 2, "0"), F.lpad(parts[2], 2, "0"))
    return F.try_to_timestamp(text, F.lit("yyyy-MM-dd")).cast("date")


def is_event_key(key: Column, prefixes: tuple[str, ...]) -> Column:
    keep = F.lit(True)
    for prefix in prefixes:
        keep = keep & ~F.startswith(key, F.lit(prefix))
    return keep


def quarantine_key(key: Column, now: Column) -> Column:
    """Report key for an input key: same path below ``quarantine/``, with the processing time as suffix."""
    base = key
    for part in ("raw/", ".json.gz", ".json"):
        base = F.replace(base, F.lit(part), F.lit(""))
    return F.concat(F.lit("quarantine/"), base, F.lit("_errors_"), F.date_format(now, "yyyyMMdd_HHmmss"), F.lit(".json"))
