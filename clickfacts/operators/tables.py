"""Keyed table operations: insert-or-ignore, catalog enrichment, event counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickfacts.operators.clean import keep_one

_SPREAD = 1 << 16


def lacking(incoming: DataFrame, target: DataFrame, key: Sequence[str]) -> DataFrame:
    """Incoming rows whose key the target lacks; NULL equals NULL."""
    known = target.select(*[F.col(c).alias(f"_{c}") for c in key])
    same = F.lit(True)
    for c in key:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    return incoming.join(known, same, "left_anti")


def new_rows(target: DataFrame, incoming: DataFrame, key: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """Incoming rows whose key the target lacks; of several with one key the first by ``order``."""
    return lacking(keep_one(incoming, key, order), target, key).select(*target.columns)


def insert_or_ignore(
    target: DataFrame, incoming: DataFrame, key: Sequence[str], order: Sequence[str] = ()
) -> DataFrame:
    """The target with the new rows appended; rows with a key already present are ignored."""
    return target.unionByName(new_rows(target, incoming, key, order))


def hot_keys(events: DataFrame, key: str, share: float = 0.001, most: int = 1000) -> list:
    """Keys that hold about ``share`` of the rows or more, found by one aggregate with a bounded frequency summary.

    At most ``most`` keys reach the driver. Counts are estimates; what is joined does not depend on them.
    """
    top = events.where(F.col(key).isNotNull()).agg(
        F.expr(f"approx_top_k(`{key}`, {most}, {most * 20})").alias("top"), F.count("*").alias("n")
    )
    found = top.select(F.inline("top"), "n").where(F.col("count") >= F.greatest(F.col("n") * share, F.lit(2)))
    return [r[0] for r in found.select("item").collect()]


def enrich(events: DataFrame, catalog: DataFrame, key: str, attributes: Sequence[str], hot: Sequence = ()) -> DataFrame:
    """Left join of catalog attributes; an attribute the events carry already is kept where it is not NULL.

    No broadcast is forced on the catalog: the size limit of the optimizer decides. Beyond it the join shuffles. Events
    whose key is in ``hot`` (``hot_keys``) get their attributes before, from the few catalog rows of these keys, and are
    then spread over all tasks like the events without a key, which match nothing: no key gathers in one task, and the
    events are scanned once. Without ``hot`` hot keys are left to adaptive execution.
    """
    few = catalog.where(F.col(key).isin(*hot)).select(F.col(key).alias("_hot"), *[F.col(a).alias(f"_hot_{a}") for a in attributes])
    at_home = F.col(key).isin(*hot) if hot else F.lit(False)
    # As many rows as hot keys: bounded by the caller's list.
    started = events.join(F.broadcast(few), F.col(key) == F.col("_hot"), "left") if hot else events
    away = F.col(key).isNull() | at_home
    # A number of the key's own, which the optimizer cannot fold away; rows that are spread have one that no key has.
    own = F.pmod(F.xxhash64(key), F.lit(_SPREAD))
    spread = F.when(away, -1 - F.pmod(F.xxhash64(*events.columns), F.lit(_SPREAD))).otherwise(own)
    side = catalog.where(F.col(key).isNotNull()).select(key, *[F.col(a).alias(f"_{a}") for a in attributes], own.alias("_spread"))
    joined = started.withColumn("_spread", spread).join(side, [key, "_spread"], "left")
    for a in attributes:
        found = [F.col(f"_{a}"), *([F.col(f"_hot_{a}")] if hot else [])]
        joined = joined.withColumn(a, F.coalesce(*([F.col(a)] if a in events.columns else []), *found))
    return joined.drop("_spread", "_hot", *[f"_{a}" for a in attributes], *[f"_hot_{a}" for a in attributes])


def events_per_type(events: DataFrame) -> DataFrame:
    return events.groupBy("event_type").agg(F.count("*").alias("events"))
