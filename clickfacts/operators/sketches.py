"""Mergeable summaries per day: quantiles and distinct counts over any span of days without the rows.

A summary is one binary value per group. Stored per day (and page, type, ...), groups and days are merged later, again
and again; a merge costs rows in proportion to the stored groups, whatever number of events they stand for. Exact forms are
in ``pages`` and ``sessions``.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rank error of quantiles as a share of the rows, and entries of a distinct summary as a power of two.
RANK_ERROR, LOG_ENTRIES = 0.02, 12


def quantile_size(rank_error: float = RANK_ERROR) -> int:
    """Size parameter of a quantile summary whose rank error is hardly ever above ``rank_error``.

    The published bound of these summaries, 2.446 / k^0.9433 with 99 % confidence, is put at half the error.
    """
    return min(65535, max(8, math.ceil((2.446 / (rank_error / 2)) ** (1 / 0.9433))))


def quantile_sketches(df: DataFrame, value: str, by: Sequence[str], rank_error: float = RANK_ERROR) -> DataFrame:
    """One ``quantiles`` summary of ``value`` per group, with ``n`` values; NULL and NaN values do not count."""
    known = F.when(~F.isnan(value), F.col(value))
    sketch = F.kll_sketch_agg_double(known, F.lit(quantile_size(rank_error)))
    return df.groupBy(*by).agg(sketch.alias("quantiles"), F.count(known).alias("n"))


def merge_quantiles(sketches: DataFrame, by: Sequence[str]) -> DataFrame:
    """Coarser groups of quantile summaries: the summaries of all their parts as one."""
    return sketches.where("n > 0").groupBy(*by).agg(F.kll_merge_agg_double("quantiles").alias("quantiles"), F.sum("n").alias("n"))


def quantile(p: float) -> Column:
    """The ``p`` quantile of a merged summary."""
    return F.kll_sketch_get_quantile_double("quantiles", F.lit(p))


def distinct_sketches(df: DataFrame, value: str, by: Sequence[str], log_entries: int = LOG_ENTRIES) -> DataFrame:
    """One ``members`` summary of the distinct ``value`` per group: unions and intersections of it are possible."""
    return df.groupBy(*by).agg(F.theta_sketch_agg(value, F.lit(log_entries)).alias("members"))


def merge_distinct(sketches: DataFrame, by: Sequence[str], log_entries: int = LOG_ENTRIES) -> DataFrame:
    """Coarser groups: everyone in any of their parts."""
    return sketches.groupBy(*by).agg(F.theta_union_agg("members", F.lit(log_entries)).alias("members"))


def returning(earlier: DataFrame, later: DataFrame, by: Sequence[str]) -> DataFrame:
    """Per group the summary of those in both periods, and ``union``, the summary its error is a share of."""
    a, b = earlier.withColumnRenamed("members", "_a"), later.withColumnRenamed("members", "_b")
    both = a.join(b, list(by))
    return both.select(*by, F.theta_intersection("_a", "_b").alias("members"), F.theta_union("_a", "_b").alias("union"))


def distinct_count(members: str = "members") -> Column:
    return F.theta_sketch_estimate(members)


def distinct_error(log_entries: int = LOG_ENTRIES, deviations: float = 5.0) -> float:
    """Bound of the relative error: ``deviations`` times the standard deviation of an estimate."""
    return deviations / math.sqrt(2**log_entries)
