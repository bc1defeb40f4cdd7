"""Scans, sinks, catalogs and streaming jobs."""

from __future__ import annotations

from datetime import UTC, date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickfacts.functions import columns as C
from clickfacts.operators import clean, quality, tables
from clickfacts.plans import daily, ingest
from clickfacts.queries import facts  # noqa: F401  (its SQL is used here)
from clickfacts.queries import sql as S
from clickfacts.queries.registry import (
    ORACLES,
    day,
    events,
    in_rounds,
    ingested,
    line_zone,
    query,
    rounded,
    scattered_zone,
    typed_zone,
    view_zone,
)
from clickfacts.session import shuffles_go
from clickfacts.sources import raw, staging, star
from clickfacts.streaming import ingest as stream_ingest
from clickfacts.streaming import pageviews

SCAN_DAY = date(2024, 1, 10)
# Files of a micro-batch: of a day's zone, and of a year's.
FILES_PER_BATCH, FEED_FILES_PER_BATCH = 24, 5

_KIND = """CASE event_type WHEN 'view' THEN 'page_view' WHEN 'click' THEN 'click' WHEN 'signup' THEN 'search'
              WHEN 'purchase' THEN 'product_view' ELSE 'cart_event' END"""


@query(
    "scan_day_type",
    f"""
SELECT strftime(ts, '%Y-%m-%d') AS date, 'page_view' AS event_type,
       'SES-' || user_id || '-' || strftime(ts, '%Y%m%d') AS session_id,
       '/p/' || regexp_extract(props, '"k": *([0-9]+)', 1) AS page_url,
       CAST(CAST(value AS DECIMAL(18, 2)) AS DOUBLE) AS time_on_page_seconds
FROM events WHERE event_type = 'view' AND CAST(ts AS DATE) = DATE '{SCAN_DAY}'
""",
)
def _scan_day_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = raw.read_events(spark, typed_zone(spark, sf_dir), "page_view", [SCAN_DAY])
    seconds = C.to_double(F.col("time_on_page_seconds")).alias("time_on_page_seconds")
    return found.select(day(), "event_type", "session_id", "page_url", seconds)


@query(
    "scan_optional_empty",
    """
SELECT 'page_view' AS source, 2 * count(*) AS records FROM events
UNION ALL SELECT 'product_view', 0
UNION ALL SELECT 'cart_event', 0
""",
)
def _scan_optional_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A zone without product views and carts reads as empty frames."""
    root = view_zone(spark, sf_dir)
    feeds = {"page_view": raw.read_events(spark, root, "page_view"), **daily.feeds(spark, root)}
    counts = [df.agg(F.count("*").alias("records")).select(F.lit(n).alias("source"), "records") for n, df in feeds.items()]
    return clean.union_events(*counts)


@query(
    "raw_line_scan",
    f"SELECT {_KIND} AS event_type, strftime(ts, '%Y-%m-%d') AS date, count(*) AS lines FROM events GROUP BY ALL",
)
def _raw_line_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = line_zone(spark, sf_dir)
    per_file = raw.read_lines(spark, root).groupBy("path").agg(F.count("*").alias("lines"))
    key = C.object_key(F.col("path"), raw.parent(root))
    keyed = per_file.select(C.path_event_type(key).alias("event_type"), C.path_date(key).alias("date"), "lines")
    return keyed.groupBy("event_type", "date").agg(F.sum("lines").alias("lines")).withColumn("date", day())


@query(
    "raw_sink_roundtrip",
    f"""
SELECT {_KIND} AS event_type, strftime(ts, '%Y-%m-%d') AS date, count(*) AS events,
       count(DISTINCT user_id) AS users,
       round(coalesce(sum(CASE WHEN event_type IN ('view', 'purchase') THEN CAST(value AS DECIMAL(18, 2)) END), 0), 2)::DOUBLE
         AS seconds
FROM events GROUP BY ALL
""",
)
def _raw_sink_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = typed_zone(spark, sf_dir)
    back = clean.union_events(*[raw.read_events(spark, root, kind) for kind in star.KINDS.values()])
    seconds = F.sum(C.to_double(F.col("time_on_page_seconds")))
    return back.groupBy("event_type", "date").agg(
        F.count("*").alias("events"),
        F.countDistinct("user_id").alias("users"),
        F.round(F.coalesce(seconds, F.lit(0.0)), 2).alias("seconds"),
    ).withColumn("date", day())


@query(
    "raw_payload_type",
    f"SELECT {_KIND} AS event_type, count(*) AS lines FROM events GROUP BY ALL",
)
def _raw_payload_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored payload names its event type although the path does too."""
    lines = raw.read_lines(spark, typed_zone(spark, sf_dir))
    named = lines.select(F.get_json_object("line", "$.event_type").alias("event_type"))
    return named.groupBy("event_type").agg(F.count("*").alias("lines"))


@query(
    "facts_roundtrip",
    S.ANOMALIES
    + S.PAGE_STATS.removeprefix(S.PV)
    + S.PAGE_METRICS.removeprefix(S.PV)
    + S.BOUNCE.removeprefix(S.PV)
    + S.SESSION_SUMMARY.removeprefix(S.PV)
    + """,
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY date
            ORDER BY avg_time_on_page_seconds DESC, page_url NULLS FIRST, page_type NULLS FIRST) AS rank
  FROM page_stats
)
SELECT 'top_pages_by_time' AS fact, date, page_url AS name, page_type AS kind, round(avg_time_on_page_seconds, 4) AS value,
       total_views AS n1, unique_sessions AS n2, NULL::BIGINT AS n3, NULL AS text FROM ranked WHERE rank <= 20
UNION ALL SELECT 'bounce_rate_by_page_type', date, NULL, page_type, round(bounces / total, 4), total, bounces, NULL, NULL FROM bounce
UNION ALL SELECT 'anomalies', date, session_id, anomaly_type, round(z_score, 6), NULL, NULL, NULL, user_id || ' ' || description FROM anomalies
UNION ALL SELECT 'page_metrics', date, page_url, page_type, round(avg_time_on_page, 4), total_sessions, NULL, NULL, CAST(bounce_rate AS VARCHAR)
  FROM page_metrics
UNION ALL SELECT 'session_summary', date, country, device_type, round(avg_session_duration, 6), total_sessions, total_pageviews, unique_users, NULL
  FROM session_summary
""",
)
def _facts_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole daily job: raw zone to stored fact tables, all their rows read back."""
    stored = daily.run(spark, view_zone(spark, sf_dir), staging.fresh_path(spark, "facts"))
    # Per table: name, kind, value and its digits, counts, text.
    columns = {
        "top_pages_by_time": ("page_url", "page_type", "avg_time_on_page_seconds", 4, ["total_views", "unique_sessions"], None),
        "bounce_rate_by_page_type": (None, "page_type", "bounce_rate", 4, ["total", "bounces"], None),
        "anomalies": ("session_id", "anomaly_type", "z_score", 6, [], F.concat("user_id", F.lit(" "), "description")),
        "page_metrics": ("page_url", "page_type", "avg_time_on_page", 4, ["total_sessions"], F.col("bounce_rate").cast("string")),
        "session_summary": (
            "country", "device_type", "avg_session_duration", 6, ["total_sessions", "total_pageviews", "unique_users"], None,
        ),
    }
    rows = []
    for fact, (name, kind, value, digits, counts, text) in columns.items():
        own = [F.col(name) if name else F.lit(None).cast("string"), F.col(kind), F.round(value, digits)]
        own += [F.col(c) for c in counts] + [F.lit(None).cast("long")] * (3 - len(counts))
        own.append(F.lit(None).cast("string") if text is None else text)
        named = [c.alias(n) for c, n in zip(own, ("name", "kind", "value", "n1", "n2", "n3", "text"), strict=True)]
        rows.append(stored[fact].select(F.lit(fact).alias("fact"), day(), *named))
    return clean.union_events(*rows)


@query(
    "catalog_enrich",
    f"""
WITH e AS (
  SELECT {_KIND} AS kind, user_id, CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS BIGINT) AS k FROM events
)
SELECT kind AS event_type, n_name AS country,
       (['mobile', 'desktop', 'tablet'])[CAST(user_id % 3 AS INTEGER) + 1] AS device_type,
       CASE WHEN kind IN ('product_view', 'cart_event') THEN p_type END AS category, count(*) AS events,
       round(sum(CASE WHEN kind IN ('product_view', 'cart_event') THEN p_retailprice ELSE 0 END), 2) AS price
FROM e LEFT JOIN customer ON c_custkey = user_id LEFT JOIN nation ON n_nationkey = c_nationkey
       LEFT JOIN part ON p_partkey = k
WHERE kind <> 'page_view'
GROUP BY ALL
""",
)
def _catalog_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Country and device for the events that lack them, category and price for those with a product."""
    frames = star.typed_events(events(spark, sf_dir))
    users = star.users(star.table(spark, sf_dir, "customer"), star.table(spark, sf_dir, "nation"))
    products = star.products(star.table(spark, sf_dir, "part"))
    lacking = clean.union_events(*[frames[k].select(*_present(frames[k])) for k in frames if k != "page_view"])
    located = tables.enrich(lacking, users, "user_id", ["country", "device_type"])
    priced = tables.enrich(located, products, "product_id", ["category", "price"])
    return priced.groupBy("event_type", "country", "device_type", "category").agg(
        F.count("*").alias("events"), F.round(F.coalesce(F.sum("price"), F.lit(0.0)), 2).alias("price")
    )


def _stored_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = typed_zone(spark, sf_dir)
    return clean.union_events(*[raw.read_events(spark, root, kind) for kind in star.KINDS.values()])


def _present(frame: DataFrame) -> list[str]:
    return [c for c in ("event_type", "user_id", "session_id", "product_id", "category", "price") if c in frame.columns]


@query(
    "all_events_union",
    f"""
SELECT {_KIND} AS event_type, strftime(ts, '%Y-%m-%d') AS date, count(*) AS events,
       count(*) FILTER (event_type IN ('view', 'click')) AS with_page,
       count(*) FILTER (event_type IN ('purchase', 'error')) AS with_product,
       count(*) FILTER (event_type = 'signup') AS with_query
FROM events GROUP BY ALL
""",
)
def _all_events_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The typed frames of the raw zone as one; each reads the files of its own type only."""
    every = _stored_types(spark, sf_dir)
    return every.groupBy("event_type", "date").agg(
        F.count("*").alias("events"),
        F.count("page_url").alias("with_page"),
        F.count("product_id").alias("with_product"),
        F.count("query").alias("with_query"),
    ).withColumn("date", day())


@query("events_per_type", f"SELECT {_KIND} AS event_type, count(*) AS events FROM events GROUP BY ALL")
def _events_per_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.events_per_type(_stored_types(spark, sf_dir))


@query(
    "stream_ingest",
    S.FILES + """
SELECT event_type, date, total, valid, invalid, round(invalid / total * 100, 2) AS error_rate_pct
FROM files WHERE NOT failed
""",
)
def _stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All files of the line zone through the streaming job."""
    out = staging.fresh_path(spark, "stream")
    stream_ingest.start_ingest(spark, line_zone(spark, sf_dir), out, f"{out}-state").awaitTermination()
    found = spark.read.parquet(f"{out}/file_summary")
    return found.select(
        "event_type", C.path_date(F.col("key")).alias("date"), "total", "valid", "invalid", "error_rate_pct"
    ).withColumn("date", day())


def _batch_files(spark: SparkSession, root: str, files: int) -> int:
    """Files of a micro-batch over a scattered zone, their days in no order.

    Where long days are in more files, a micro-batch takes more: a third of the zone, up to two files for each core.
    """
    third = -(-raw.list_files(spark, root).count() // 3)
    return max(files, min(third, 2 * spark.sparkContext.defaultParallelism))


def _feed_stream(spark: SparkSession, sf_dir: str, kind: str, files: int, together: bool = False) -> DataFrame:
    """The files of a scattered zone in several micro-batches."""
    root = scattered_zone(spark, sf_dir, kind, together)
    return raw.stream_events(spark, root, kind, _batch_files(spark, root, files))


def _unique(spark: SparkSession, sf_dir: str, kind: str, files: int) -> DataFrame:
    """Unique events of a zone of its own: its files go as they are read, and its state with the end of the stream.

    Many events are merged in rounds and stored, and what the micro-batches have written goes.
    """
    out = staging.fresh_path(spark, f"stream-{kind}")
    with shuffles_go(spark):
        root = scattered_zone(spark, sf_dir, kind)
        feed = raw.stream_events(spark, root, kind, _batch_files(spark, root, files), consume=True)
        pageviews.start_unique(feed, kind, out, f"{out}-state").awaitTermination()
        for path in (root.rpartition("/")[0], f"{out}-state"):
            staging.discard(spark, path)
        rounds = in_rounds(pageviews.read_unique(spark, out, kind), spark.read.parquet(out).count())
        if len(rounds) > 1:
            for some in rounds:
                some.write.mode("append").option("compression", "zstd").parquet(f"{out}-unique")
    if len(rounds) == 1:
        return pageviews.read_unique(spark, out, kind).withColumn("date", day())
    staging.discard(spark, out)
    return spark.read.schema(rounds[0].schema).parquet(f"{out}-unique").withColumn("date", day())


# Page views as in a batch, those of some minutes without a day.
_UNDATED = """
SELECT CASE WHEN minute(ts) % 13 <> 0 THEN date END AS date, """


@query(
    "stream_dedup",
    S.PV + _UNDATED + """session_id, page_url, user_id, page_type,
       greatest(coalesce(seconds_1, seconds_2), coalesce(seconds_2, seconds_1))::DOUBLE AS time_on_page_seconds
FROM pv JOIN (SELECT event_id, seconds_1, seconds_2 FROM first_copy) USING (event_id)
""",
)
def _stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unique page views, copies in different micro-batches; the longest one survives as in a batch."""
    return _unique(spark, sf_dir, "page_view", FILES_PER_BATCH).select(
        "date", "session_id", "page_url", "user_id", "page_type", "time_on_page_seconds"
    )


_BY_YEAR = "strftime(date_trunc('year', CAST(date AS DATE)), '%Y-%m-%d') AS date"


@query("stream_dedup_products", f"SELECT * REPLACE ({_BY_YEAR}) FROM ({ORACLES['dedup_product_views']}) dated")
def _stream_dedup_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _unique(spark, sf_dir, "product_view", FEED_FILES_PER_BATCH).select(
        "date", "session_id", "product_id", "user_id", "category", "price", "time_on_page_seconds"
    )


@query("stream_dedup_carts", f"SELECT * REPLACE ({_BY_YEAR}) FROM ({ORACLES['dedup_cart_events']}) dated")
def _stream_dedup_carts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _unique(spark, sf_dir, "cart_event", FEED_FILES_PER_BATCH).select("date", "session_id", "product_id", "action", "user_id")


@query(
    "stream_page_stats",
    S.PV + _UNDATED + """page_url, page_type, round(avg(seconds), 4) AS avg_time_on_page_seconds, count(*) AS total_views,
       count(DISTINCT session_id) AS unique_sessions
FROM pv GROUP BY ALL
""",
)
def _stream_page_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics of all views, undated ones included, added up over several micro-batches."""
    out = staging.fresh_path(spark, "stream-stats")
    views = clean.parse_page_views(_feed_stream(spark, sf_dir, "page_view", FILES_PER_BATCH, together=True))
    pageviews.start_page_stats(views, out, f"{out}-state").awaitTermination()
    return pageviews.read_page_stats(spark, out).select(
        day(), "page_url", "page_type", rounded("avg_time_on_page_seconds"), "total_views", "unique_sessions"
    )


@query(
    "gated_feed",
    S.FILES + "SELECT event_type, date, valid AS events FROM files WHERE NOT failed AND valid > 0",
)
def _gated_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid records of files that did not fail, written as a raw zone and read back by type."""
    root = f"{staging.fresh_path(spark, 'gated')}/feed"
    ingested(spark, sf_dir).write_feed(root)
    back = clean.union_events(*[raw.read_events(spark, root, kind) for kind in star.KINDS.values()])
    return back.groupBy("event_type", "date").agg(F.count("*").alias("events")).withColumn("date", day())


@query(
    "feeds_roundtrip",
    f"""
SELECT CASE {_KIND} WHEN 'product_view' THEN 'product_views' ELSE 'cart_events' END AS feed,
       strftime(ts, '%Y-%m-%d') AS date,
       count(DISTINCT (user_id, regexp_extract(props, '"k": *([0-9]+)', 1), ts)) AS events
FROM events WHERE {_KIND} IN ('product_view', 'cart_event') GROUP BY ALL
""",
)
def _feeds_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned product views and cart events as the daily run stores them."""
    stored = daily.run(spark, typed_zone(spark, sf_dir), staging.fresh_path(spark, "feeds"))
    counts = [
        stored[name].groupBy("date").agg(F.count("*").alias("events")).select(F.lit(name).alias("feed"), day(), "events")
        for name in daily.FEED_TABLES.values()
    ]
    return clean.union_events(*counts)


def _damaged(files: DataFrame) -> DataFrame:
    """Gzip files as rows, every seventh day cut in half, the next without its magic number, the next with a bad byte."""

    def run(batches):  # noqa: ANN001, ANN202
        import gzip

        import pyarrow as pa

        for batch in batches:
            made = []
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist(), strict=True):
                kind = int(path.rpartition("/day=")[2][:2]) % 7
                if kind == 0:
                    content = content[: len(content) // 2]
                elif kind == 1:
                    content = b"\x00" + content[1:]
                elif kind == 2:
                    content = gzip.compress(gzip.decompress(content) + b'{"event_type": "\xff"}\n')
                made.append({"path": path, "length": len(content), "content": content})
            yield pa.RecordBatch.from_pylist(made)

    return files.select("path", "content").mapInArrow(run, "path string, length long, content binary")


@query(
    "file_isolation",
    S.FILES + """,
damaged AS (
  SELECT *, CAST(string_split(date, '-')[3] AS INTEGER) % 7 AS kind FROM files
)
SELECT event_type, date,
       CASE WHEN kind IN (0, 1) THEN 'undecodable' WHEN kind = 2 OR failed THEN 'unprocessable' ELSE 'read' END AS outcome,
       CASE WHEN kind > 2 AND NOT failed THEN total END AS total,
       CASE WHEN kind > 2 AND NOT failed THEN valid END AS valid,
       CASE WHEN kind > 2 AND NOT failed THEN invalid END AS invalid
FROM damaged
""",
)
def _file_isolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All files of the line zone, some of them damaged: those are named, the others are complete."""
    root = line_zone(spark, sf_dir)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    lines = raw.with_positions(raw.decoded(_damaged(files)))
    done = ingest.Ingest(quality.stage_validated(lines, "isolation"), raw.parent(root), datetime(2024, 2, 1, tzinfo=UTC))
    failed = done.failures.select(
        F.col("failure_key").alias("key"),
        F.when(F.col("reason").isNotNull(), "undecodable").otherwise("unprocessable").alias("outcome"),
        *[F.lit(None).cast("long").alias(c) for c in ("total", "valid", "invalid")],
    )
    read = done.summary.select("key", F.lit("read").alias("outcome"), "total", "valid", "invalid")
    both = read.unionByName(failed)
    key = F.col("key")
    return both.select(C.path_event_type(key).alias("event_type"), C.path_date(key).alias("date"), "outcome", "total", "valid", "invalid").withColumn("date", day())


@query(
    "stream_notified",
    S.FILES + """,
named AS (SELECT * FROM files WHERE CAST(string_split(date, '-')[3] AS INTEGER) % 2 = 1)
SELECT event_type, date, CASE WHEN failed THEN 'unprocessable' ELSE 'read' END AS outcome, 1::BIGINT AS times,
       CASE WHEN NOT failed THEN total END AS total, CASE WHEN NOT failed THEN invalid END AS invalid
FROM named
UNION ALL SELECT event_type, '2099-01-01', 'missing', 1, NULL, NULL FROM (SELECT DISTINCT event_type FROM files)
""",
)
def _stream_notified(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Notices of the odd days' files, each sent three times, of an object per type that is gone, and of reports."""
    root = line_zone(spark, sf_dir)
    path = staging.fresh_path(spark, "notified")
    key = C.object_key(F.col("path"), raw.parent(root))
    files = raw.list_files(spark, root).select(key.alias("key"), F.col("size_bytes").alias("size"))
    named = files.where(F.dayofmonth(C.path_date(F.col("key"))) % 2 == 1)
    kinds = files.select(C.path_event_type(F.col("key")).alias("kind")).distinct()
    gone = kinds.select(F.concat(F.lit("raw/event_type="), "kind", F.lit("/year=2099/month=01/day=01/gone.json.gz")).alias("key"), F.lit(1).cast("long").alias("size"))
    reports = kinds.select(F.concat(F.lit("quarantine/"), "kind", F.lit(".json")).alias("key"), F.lit(1).cast("long").alias("size"))
    notices = named.unionByName(gone).unionByName(reports).select(F.lit("shop").alias("bucket"), F.url_encode("key").alias("key"), "size")
    sent = notices.withColumn("turn", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))))
    sent.repartition(3, "turn").drop("turn").write.json(f"{path}/notices")
    stream = spark.readStream.schema("bucket string, key string, size long").option("maxFilesPerTrigger", 1).json(f"{path}/notices")
    bucket = root.rstrip("/").rpartition("/")[0]
    stream_ingest.start_notified(stream, "shop", bucket, f"{path}/out", f"{path}/state").awaitTermination()
    summary = spark.read.parquet(f"{path}/out/file_summary").select("key", F.lit("read").alias("outcome"), "total", "invalid")
    failures = spark.read.parquet(f"{path}/out/failures").select(
        F.col("failure_key").alias("key"), F.when(F.col("reason").isNull(), "unprocessable").otherwise("missing").alias("outcome"),
        *[F.lit(None).cast("long").alias(c) for c in ("total", "invalid")],
    )
    every = summary.unionByName(failures).groupBy("key", "outcome").agg(
        F.count("*").alias("times"), F.max("total").alias("total"), F.max("invalid").alias("invalid")
    )
    key = F.col("key")
    return every.select(C.path_event_type(key).alias("event_type"), C.path_date(key).alias("date"), "outcome", "times", "total", "invalid").withColumn("date", day())


@query(
    "enrich_hot_user",
    """
WITH e AS (SELECT CASE WHEN event_id % 2 = 0 THEN 7 WHEN event_id % 3 <> 0 THEN user_id END AS user_id FROM events)
SELECT n_name AS country, CASE WHEN c_custkey IS NOT NULL THEN (['mobile', 'desktop', 'tablet'])[CAST(user_id % 3 AS INTEGER) + 1] END
         AS device_type, count(*) AS events
FROM e LEFT JOIN customer ON c_custkey = user_id LEFT JOIN nation ON n_nationkey = c_nationkey GROUP BY ALL
""",
)
def _enrich_hot_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One user holds half of all events, a sixth has none: country and device by user."""
    hot = F.when(F.col("event_id") % 2 == 0, F.lit(7)).when(F.col("event_id") % 3 != 0, F.col("user_id"))
    given = star.fact_table(spark, sf_dir, "events").select("event_id", F.concat(F.lit("USR-"), hot).alias("user_id"))
    users = star.users(star.table(spark, sf_dir, "customer"), star.table(spark, sf_dir, "nation"))
    found = tables.enrich(given, users, "user_id", ["country", "device_type"], tables.hot_keys(given, "user_id"))
    return found.groupBy("country", "device_type").agg(F.count("*").alias("events"))
