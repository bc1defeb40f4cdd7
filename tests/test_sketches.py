"""Mergeable summaries, and enrichment with hot keys."""

from statistics import median

import pytest
from pyspark.sql import functions as F

from clickfacts.operators import sketches, tables


@pytest.fixture(scope="module")
def values(spark):
    rows = spark.range(60_000).withColumn("day", F.col("id") % 7).withColumn("part", F.col("id") % 3)
    return rows.withColumn("v", F.pmod(F.xxhash64("id"), F.lit(10_000)).cast("double"))


def test_merged_quantiles_stay_in_their_bound(values):
    daily = sketches.quantile_sketches(values, "v", ["day", "part"])
    for by in (["part"], []):
        for r in sketches.merge_quantiles(daily, by).select(*by, "n", *[sketches.quantile(p).alias(str(p)) for p in (0.0, 0.25, 0.5, 0.99)]).collect():
            own = values.where(F.col("part") == r.part) if by else values
            assert r.n == own.count()
            for p in (0.25, 0.5, 0.99):
                low, high = own.agg(F.avg((F.col("v") < r[str(p)]).cast("int")), F.avg((F.col("v") <= r[str(p)]).cast("int"))).first()
                assert low - sketches.RANK_ERROR <= p <= high + sketches.RANK_ERROR
    assert sketches.quantile_size(0.001) > sketches.quantile_size(0.02) > sketches.quantile_size(0.2) >= 8


def test_quantiles_of_odd_values(spark):
    rows = spark.createDataFrame([("a", 1.0), ("a", None), ("a", float("nan")), ("b", None), (None, 2.0)], "g string, v double")
    daily = sketches.quantile_sketches(rows, "v", ["g"])
    assert {r.g: r.n for r in daily.collect()} == {"a": 1, "b": 0, None: 1}
    got = sketches.merge_quantiles(daily, ["g"]).select("g", sketches.quantile(0.5).alias("q")).collect()
    assert {r.g: r.q for r in got} == {"a": 1.0, None: 2.0}
    assert sketches.merge_quantiles(daily.limit(0), ["g"]).count() == 0


def test_distinct_summaries(spark, values):
    people = values.withColumn("who", F.col("id") % 20_000)
    daily = sketches.distinct_sketches(people, "who", ["day"])
    whole = sketches.merge_distinct(daily.withColumn("all", F.lit(1)), ["all"]).select(sketches.distinct_count()).first()[0]
    assert abs(whole - 20_000) <= 20_000 * sketches.distinct_error()
    a, b = (sketches.distinct_sketches(people.where(c).withColumn("g", F.lit(1)), "who", ["g"]) for c in ("who < 12000", "who >= 8000"))
    r = sketches.returning(a, b, ["g"]).select(sketches.distinct_count(), sketches.distinct_count("union")).first()
    assert abs(r[0] - 4_000) <= 20_000 * sketches.distinct_error() and abs(r[1] - 20_000) <= 20_000 * sketches.distinct_error()


def test_hot_keys_do_not_gather(spark):
    """Half of all rows in one key, a fifth without: no task beyond twice the median, without the skew rule or a broadcast."""
    events = spark.range(40_000).select(
        F.when(F.col("id") % 2 == 0, "hot").when(F.col("id") % 5 != 0, F.concat(F.lit("u"), F.col("id") % 3000)).alias("k"),
        "id", F.when(F.col("id") % 7 == 0, "own").alias("a"),
    )
    catalog = spark.createDataFrame([("hot", "A", 1), *[(f"u{i}", f"A{i}", None) for i in range(0, 3000, 2)], (None, "never", 9)], "k string, a string, b int")
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in settings}
    hot = tables.hot_keys(events, "k", 0.01)
    assert hot == ["hot"]
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        got = tables.enrich(events, catalog, "k", ["a", "b"], hot).withColumn("task", F.spark_partition_id())
        sizes = [r["count"] for r in got.groupBy("task").count().collect()]
        rows = sorted(map(tuple, got.drop("task").collect()), key=repr)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert max(sizes) <= 2 * median(sizes) and len(sizes) == 8
    assert rows == sorted(map(tuple, tables.enrich(events, catalog, "k", ["a", "b"]).collect()), key=repr)
    assert tables.hot_keys(events.limit(0), "k") == [] == tables.hot_keys(events.select(F.lit(None).cast("string").alias("k")), "k")
