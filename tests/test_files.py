"""Raw zone, line numbers, file reports, catalogs."""

import gzip
import json
from datetime import UTC, date, datetime
from urllib.parse import quote_plus

import pytest
from pyspark.sql import functions as F

from clickfacts import schemas
from clickfacts.functions import columns as C
from clickfacts.operators import clean, quality
from clickfacts.plans import daily, ingest
from clickfacts.queries import registry
from clickfacts.sources import catalog, raw, staging, star, tables
from clickfacts.streaming.ingest import start_ingest, start_notified
from tests.test_rules import OTHERS, line, page

NOW = datetime(2026, 5, 21, 1, 2, 3, tzinfo=UTC)


def put(root, key, lines):
    path = root / key
    path.parent.mkdir(parents=True, exist_ok=True)
    data = "".join(text + "\n" for text in lines).encode()
    path.write_bytes(gzip.compress(data) if key.endswith(".gz") else data)


@pytest.fixture(scope="module")
def lake(tmp_path_factory):
    root = tmp_path_factory.mktemp("lake")
    bad = page(country="")
    put(root, "raw/event_type=page_view/year=2026/month=05/day=20/events.json.gz", [page(), "  ", "{bad" + "x" * 300, bad])
    put(root, "raw/event_type=click/year=2026/month=05/day=20/events.json", [bad] * 150 + [line(OTHERS["click"])] * 50)
    put(root, "raw/event_type=search/year=2026/month=05/day=20/events.json", [line(OTHERS["search"]), "[1]", bad])
    put(root, "raw/event_type=cart_event/year=2026/month=05/day=20/events.json", ["", " "])
    put(root, "raw/odd name+x.json", [line(OTHERS["cart_event"])])
    put(root, "quarantine/old.json", [bad])
    put(root, "reference/users/catalog.json", ['{"user_id":"u"}'])
    put(root, "processed/x.json", [page()])
    return root


@pytest.fixture(scope="module")
def done(spark, lake):
    return ingest.run(spark, str(lake / "raw"), now=NOW, with_empty_files=True)


PAGE_KEY = "raw/event_type=page_view/year=2026/month=05/day=20/events.json.gz"
CLICK_KEY = "raw/event_type=click/year=2026/month=05/day=20/events.json"


def test_summary(done):
    got = {r.key: (r.event_type, r.total, r.valid, r.invalid, r.error_rate_pct) for r in done.summary.collect()}
    assert got == {
        PAGE_KEY: ("page_view", 3, 1, 2, 66.67),
        CLICK_KEY: ("click", 200, 50, 150, 75.0),
        "raw/event_type=cart_event/year=2026/month=05/day=20/events.json": ("cart_event", 0, 0, 0, 0.0),
        "raw/odd name+x.json": ("unknown", 1, 1, 0, 0.0),
    }


def test_failures(done):
    (r,) = done.failures.collect()
    assert (r.failure_key, r.fatal_lines) == ("raw/event_type=search/year=2026/month=05/day=20/events.json", 1)


def test_reports(done):
    reports = {r.original_key: r for r in done.first_reports(100).collect()}
    assert set(reports) == {PAGE_KEY, CLICK_KEY} and "invalid_events" not in done.reports.columns
    r = reports[PAGE_KEY]
    assert r.quarantine_key == (
        "quarantine/event_type=page_view/year=2026/month=05/day=20/events_errors_20260521_010203.json"
    )
    assert (r.total_records, r.invalid_count, r.error_rate_pct) == (3, 2, 66.67)
    assert r.processed_at == "2026-05-21T01:02:03.000000Z"
    first, second = r.invalid_events
    assert (first.line_no, first.event, len(first.raw), first.errors[0].code) == (2, None, 304, "INVALID_JSON")
    assert (second.line_no, json.loads(second.event)["country"], second.raw) == (3, "", None)
    r = reports[CLICK_KEY]
    assert (r.invalid_count, [e.line_no for e in r.invalid_events]) == (150, list(range(1, 101)))
    every = done.quarantine.collect()
    assert sorted(e.line_no for e in every if e.event_type == "click") == list(range(1, 151))
    assert {str(e.date) for e in every} == {"2026-05-20"} and max(len(e.raw or "") for e in every) == 304


def test_metrics(done, lake):
    points = {(r["name"], r.dimension_value): (r.value, r.unit) for r in done.metrics.collect()}
    assert points["RecordsInvalid", "click"] == (150.0, "Count")
    assert points["FileSizeBytes", "page_view"] == (float((lake / PAGE_KEY).stat().st_size), "Bytes")
    assert points["FilesProcessed", "unknown"] == (1.0, "Count")
    assert points["ProcessingErrors", "raw/event_type=search/year=2026/month=05/day=20/events.json"] == (1.0, "Count")
    assert len(points) == 4 * 4 + 1


def test_split_is_a_partition(done):
    valid, invalid = quality.split_valid(done.checked)
    fatal = done.checked.where(quality.is_fatal())
    assert valid.count() + invalid.count() + fatal.count() == done.checked.count()
    assert done.valid_events.count() == valid.count()


def test_reports_as_json(spark, done, tmp_path):
    tables.write_reports(done.reports, str(tmp_path / "quarantine"))
    back = spark.read.json(str(tmp_path / "quarantine"))
    assert back.count() == 2 and "event_type" in back.columns


def test_mixed_root_leaves_out_reports_and_catalogs(spark, lake):
    lines = raw.read_lines(spark, str(lake), str(lake))
    keys = {r.key for r in lines.select(C.object_key(F.col("path"), str(lake)).alias("key")).distinct().collect()}
    assert "processed/x.json" in keys and PAGE_KEY in keys
    assert not any(k.startswith(("quarantine/", "reference/")) for k in keys)
    assert raw.read_lines(spark, str(lake / "quarantine"), str(lake)).count() == 0
    assert raw.list_files(spark, str(lake), str(lake)).count() == 6


def test_line_numbers_over_many_splits(spark, tmp_path):
    big = [json.dumps({"n": i}) if i % 3 else "" for i in range(9000)]
    put(tmp_path, "raw/a.json", big)
    put(tmp_path, "raw/b.json.gz", big[:4000])
    put(tmp_path, "raw/c.json", big[5:800])
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8000")
    spark.conf.set("spark.sql.files.openCostInBytes", "100")
    try:
        lines = staging.stage(raw.read_lines(spark, str(tmp_path / "raw")), "lines")
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    index = quality.blocks(lines)
    assert index.count() > 10
    rows = quality.number_lines(lines, index).collect()
    for name, source in (("a.json", big), ("b.json.gz", big[:4000]), ("c.json", big[5:800])):
        want = {text: i + 1 for i, text in enumerate(t for t in source if t)}
        assert {r.line: r.line_no for r in rows if r.path.endswith(name)} == want
    some = lines.where(F.col("line").contains("77"))
    assert all(r.line_no > 0 for r in quality.number_lines(some, index).collect())


def test_lines_can_be_spread(spark, tmp_path):
    text = [json.dumps({"n": i}) for i in range(5000)]
    put(tmp_path, "raw/a.json.gz", text)
    put(tmp_path, "raw/b.json.gz", text[:10])
    put(tmp_path, "raw/c.json", text)
    lines = raw.read_lines(spark, str(tmp_path / "raw"), spread=True)
    staged = staging.stage(lines, "lines")
    rows = quality.number_lines(staged, quality.blocks(staged)).collect()
    for name, n in (("a.json.gz", 5000), ("b.json.gz", 10), ("c.json", 5000)):
        got = {r.line: r.line_no for r in rows if r.path.endswith(name)}
        assert got == {t: i + 1 for i, t in enumerate(text[:n])}
    plan = lines._jdf.queryExecution().executedPlan().toString()
    assert "RoundRobinPartitioning" in plan


def test_queries_over_files_spread_their_lines(spark, tmp_path, monkeypatch):
    """One large file is read by one task and checked by several."""
    put(tmp_path, "raw/event_type=page_view/year=2026/month=05/day=20/a.json.gz", [page(session_id=f"{i}" * 20) for i in range(4000)])
    name, size = "spark.sql.adaptive.coalescePartitions.minPartitionSize", "1k"
    kept = spark.conf.get(name)
    spark.conf.set(name, size)
    try:
        done = registry.ingested(spark, str(tmp_path), lambda *_: str(tmp_path / "raw"))
    finally:
        spark.conf.set(name, kept)
    assert done.checked.select(F.input_file_name()).distinct().count() > 1
    assert [r.total for r in done.summary.collect()] == [4000]


def test_long_work_per_row_is_dealt_by_rows(spark, monkeypatch):
    """A table that is one small file is many tasks where the work per row is long; one that is dealt already stays."""
    events = spark.createDataFrame([(i % 3 or None,) for i in range(250)], "event_id long").coalesce(1)
    kept = spark.conf.get("spark.clickfacts.tasks", None)
    assert star.dealt(events, 100).rdd.getNumPartitions() == 1
    try:
        spark.conf.unset("spark.clickfacts.tasks")
        dealt = star.dealt(events, 100)
        assert dealt.rdd.getNumPartitions() == 3 and sorted(map(str, dealt.collect())) == sorted(map(str, events.collect()))
        assert star.dealt(events.limit(0), 100).count() == 0
        monkeypatch.setattr(star, "dealt", lambda df: df.repartition(7))
        assert registry.dealt_events(spark, "/root/testdata/sf0.001").rdd.getNumPartitions() == 7
    finally:
        if kept:
            spark.conf.set("spark.clickfacts.tasks", kept)


def test_first_invalid_of_a_large_file(spark):
    rows = [("f", b * (40 << 30), b * 1000 + i, "x", "invalid") for b in range(8) for i in range(30)]
    df = spark.createDataFrame(rows, "path string, block long, pos long, line string, status string").repartition(5)
    got = sorted(r.pos for r in quality.first_invalid(df, 50).collect())
    assert got == [r[2] for r in rows][:50]


def test_keys(spark):
    rows = [
        ("raw/event_type=click/year=2026/month=05/day=20/events.json.gz", "click"), ("raw/x.json", "unknown"),
        ("event_type=/a", ""), ("a/event_type=b=c/d", "b"), ("my_event_type=x/a", "unknown"),
    ]
    df = spark.createDataFrame(rows, "key string, want string")
    got = df.select("want", C.path_event_type(F.col("key")).alias("got"), C.quarantine_key(F.col("key"), F.lit(NOW)).alias("q"))
    for r in got.collect():
        assert r.got == r.want
    assert got.first().q == "quarantine/event_type=click/year=2026/month=05/day=20/events_errors_20260521_010203.json"
    uris = ["file:/a/b/raw/x%20y+z.json", "file:///a/b/raw/x%20y+z.json", "s3a://bucket/a/b/raw/x%20y+z.json", "/a/b/raw/x y+z.json"]
    keys = spark.createDataFrame([(u,) for u in uris], "u string").select(C.object_key(F.col("u"), "/a/b")).collect()
    assert {r[0] for r in keys} == {"raw/x y+z.json"}
    note = spark.createDataFrame([("raw/a+b%2Bc.json",)], "u string").select(C.notified_key(F.col("u"))).first()[0]
    assert note == "raw/a b+c.json"
    assert raw.parent("s3a://bucket/lake/raw/") == "/lake" and raw.parent("/x/raw") == "/x" and raw.parent("s3://b/raw") == "/"


def test_raw_zone(spark, tmp_path):
    events = star.table(spark, "/root/testdata/sf0.001", "events")
    frames = star.typed_events(events)
    both = clean.union_events(*frames.values()).drop("date")
    root = str(tmp_path / "raw")
    raw.write_raw(both, root)
    assert (tmp_path / "raw" / "event_type=click" / "year=2024" / "month=01" / "day=05").is_dir()
    kept = spark.read.text(root).select(F.get_json_object("value", "$.event_type").alias("t")).groupBy("t").count()
    assert {r.t: r["count"] for r in kept.collect()} == {k: f.count() for k, f in frames.items()}
    one = raw.read_events(spark, root, "search", [date(2024, 1, 5), date(2024, 1, 6)])
    assert {r.date.day for r in one.collect()} == {5, 6}
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_type" in plan
    assert raw.read_events(spark, root, "click", [date(2030, 1, 1)]).count() == 0
    feeds = daily.feeds(spark, root)
    assert feeds["cart_event"].count() > 0


def test_mixed_file_and_catalogs(spark, tmp_path):
    products = spark.createDataFrame([("P1", "n", "books", 9.5)], schemas.PRODUCT_CATALOG)
    catalog.write_catalog(products, str(tmp_path / "products"))
    catalog.write_catalog(products, str(tmp_path / "products"))
    assert catalog.read_products(spark, str(tmp_path / "products")).collect() == products.collect()
    users = spark.createDataFrame([("U1", "CO", "mobile")], schemas.USER_CATALOG)
    catalog.write_catalog(users, str(tmp_path / "users"))
    assert catalog.read_users(spark, str(tmp_path / "users")).collect() == users.collect()
    raw.write_mixed(users, str(tmp_path / "mixed"))
    assert spark.read.json(str(tmp_path / "mixed")).count() == 1


def test_daily_job_is_repeatable(spark, tmp_path):
    events = star.table(spark, "/root/testdata/sf0.001", "events")
    root = str(tmp_path / "raw")
    raw.write_raw(star.raw_page_views(events), root, F.col("date"))
    out = str(tmp_path / "out")
    first = {n: sorted(map(str, df.collect())) for n, df in daily.run(spark, root, out).items()}
    again = {n: sorted(map(str, df.collect())) for n, df in daily.run(spark, root, out).items()}
    assert set(first) == {*daily.FACT_TABLES, *daily.FEED_TABLES.values()} and first == again
    stale = [("s", "u", "t", 9.0, 1.0, "", date(2024, 1, d)) for d in (7, 8)]
    names = ["session_id", "user_id", "anomaly_type", "z_score", "metric_value", "description", "date"]
    has = {r.date.day for r in tables.read_fact(spark, f"{out}/anomalies").collect()}
    assert not {7, 8} <= has
    tables.write_fact(spark.createDataFrame(stale, names), f"{out}/anomalies")
    daily.run(spark, root, out, [date(2024, 1, 8)])
    day = daily.run(spark, root, out, [date(2024, 1, 7)])
    assert {n: sorted(map(str, df.collect())) for n, df in day.items()} == first


def test_corrupt_file_can_be_skipped(spark, tmp_path):
    put(tmp_path, "raw/good.json.gz", [page()] * 3)
    (tmp_path / "raw" / "bad.json.gz").write_bytes(b"not gzip at all")
    assert raw.read_lines(spark, str(tmp_path / "raw"), skip_corrupt_files=True).count() == 3
    with pytest.raises(Exception, match="(?i)gzip|FAILED_READ_FILE|file"):
        raw.read_lines(spark, str(tmp_path / "raw")).count()


def _zone_with_damage(root):
    """Two good files of several members and lines, and one of every kind of damage."""
    good = "\n".join([page()] * 3).encode()
    files = {
        "good.json.gz": gzip.compress(good + b"\r\n") + gzip.compress(b"\n" + page().encode()) + b"\0" * 20,
        "long.json.gz": gzip.compress(b"\n".join([page().encode()] * 30_000)),
        "half.json.gz": gzip.compress(b"\n".join([page().encode()] * 30_000))[:-400],
        "magic.json.gz": b"not gzip at all",
        "nothing.json.gz": b"",
        "tail.json.gz": gzip.compress(good) + b"rest",
        "bytes.json.gz": gzip.compress(good + b"\n{\"event_type\": \"\xff\"}"),
        "plain.json": good,
    }
    folder = root / "raw" / "event_type=page_view"
    folder.mkdir(parents=True)
    for name, content in files.items():
        (folder / name).write_bytes(content)


_READ = {"good.json.gz": 4, "long.json.gz": 30_000, "plain.json": 3}
_FAILED = {"half.json.gz": "EOFError", "magic.json.gz": "error", "tail.json.gz": "error", "bytes.json.gz": None}


def _outcome(summary, failures):
    read = {r.key.rpartition("/")[2]: r.total for r in summary.collect()}
    failed = {r.failure_key.rpartition("/")[2]: r.reason and r.reason.partition(":")[0] for r in failures.collect()}
    return read, failed


def test_unreadable_files_fail_alone(spark, tmp_path):
    _zone_with_damage(tmp_path)
    done = ingest.run(spark, str(tmp_path / "raw"), now=NOW)
    assert _outcome(done.summary, done.failures) == (_READ, _FAILED)
    assert done.quarantine.count() == 0 and done.valid_events.join(done.failures, "path", "left_anti").count() == sum(_READ.values())
    numbered = quality.number_lines(done.checked, quality.blocks(done.checked))
    rows = numbered.where("path LIKE '%long.json.gz'").agg({"line_no": "max", "path": "count"}).first()
    assert set(rows) == {30_000}


def test_unreadable_files_in_a_stream(spark, tmp_path):
    _zone_with_damage(tmp_path)
    out = str(tmp_path / "out")
    start_ingest(spark, str(tmp_path / "raw"), out, str(tmp_path / "state"), now=NOW, files_per_batch=2).awaitTermination()
    assert _outcome(*[spark.read.parquet(f"{out}/{t}") for t in ("file_summary", "failures")]) == (_READ, _FAILED)


def test_notices_decide_what_is_read(spark, tmp_path):
    """Encoded keys, a repeated notice, another bucket, a report, a missing object; files without a notice stay unread."""
    bucket, out = tmp_path / "bucket", str(tmp_path / "out")
    odd = "raw/event_type=click/odd {name}+[x],y.json"
    for key in (odd, "raw/unnamed.json", "quarantine/r.json", "raw/a.json.gz"):
        put(bucket, key, [line(OTHERS["click"])] * 2)
    names = [odd, odd, "quarantine/r.json", "raw/gone.json", "raw/a.json.gz"]
    notices = [{"bucket": "shop", "key": quote_plus(k)} for k in names] + [{"bucket": "other", "key": "raw/unnamed.json"}]
    (tmp_path / "n").mkdir()
    for i, n in enumerate([*notices, notices[0]]):
        (tmp_path / "n" / f"{i}.json").write_text(json.dumps(n))
    for _ in range(2):
        stream = spark.readStream.schema("bucket string, key string").option("maxFilesPerTrigger", 3).json(str(tmp_path / "n"))
        start_notified(stream, "shop", str(bucket), out, str(tmp_path / "state"), now=NOW).awaitTermination()
    got = [(r.key, r.total) for r in spark.read.parquet(f"{out}/file_summary").collect()]
    assert sorted(got) == [("raw/a.json.gz", 2), (odd, 2)]
    assert [(r.failure_key, r.reason) for r in spark.read.parquet(f"{out}/failures").collect()] == [("raw/gone.json", "the object is missing")]


def test_daily_job_without_rows(spark, tmp_path):
    """A day without anomalies, and one without page views: all tables are there, with their schemas."""
    root = str(tmp_path / "raw")
    put(tmp_path, "raw/event_type=page_view/year=2026/month=05/day=20/events.json", [page(session_id=f"s{i}") for i in range(3)])
    put(tmp_path, "raw/event_type=click/year=2026/month=05/day=21/events.json", [line(OTHERS["click"])])
    quiet = daily.run(spark, root, str(tmp_path / "a"), [date(2026, 5, 20)])
    assert quiet["anomalies"].count() == 0 and quiet["page_metrics"].count() == 1
    none = daily.run(spark, root, str(tmp_path / "b"), [date(2026, 5, 21)])
    assert {n: df.count() for n, df in none.items()} == dict.fromkeys(none, 0)
    assert {n: df.dtypes for n, df in none.items()} == {n: df.dtypes for n, df in quiet.items()}


def test_outputs_of_an_ingest(spark, lake, tmp_path):
    out = str(tmp_path / "out")
    for _ in range(2):
        done = ingest.run(spark, str(lake / "raw"), now=NOW, out=out)
    assert spark.read.parquet(f"{out}/quarantine").count() == 152
    assert spark.read.json(f"{out}/reports").count() == 2
    assert spark.read.parquet(f"{out}/metrics").count() == 2 * done.metrics.count()
    feed = raw.read_events(spark, f"{out}/feed", "click")
    assert feed.count() == 50 and {str(r.date) for r in feed.collect()} == {"2026-05-20"}
    # The search file failed as a whole.
    assert raw.read_events(spark, f"{out}/feed", "search").count() == 0


def test_append_new_keeps_the_first(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = [(1, None, "b", date(2026, 5, 1)), (2, None, "a", date(2026, 5, 1)), (1, "x", "c", date(2026, 5, 2))]
    df = spark.createDataFrame(rows, "nth int, k string, v string, date date")
    for _ in range(2):
        tables.append_new(df, path, ["date", "k"], ["nth"], ["nth"])
    got = {(r.k, r.v) for r in tables.read_fact(spark, path).collect()}
    assert got == {(None, "b"), ("x", "c")} and tables.read_fact(spark, path).count() == 2
