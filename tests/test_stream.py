"""Streaming jobs against their batch counterparts."""

import os
import shutil
import time
import uuid
from datetime import UTC, date, datetime

from pyspark.sql import functions as F

from clickfacts.operators import clean, pages
from clickfacts.plans import ingest
from clickfacts.queries import registry, storage
from clickfacts.sources import raw, star
from clickfacts.streaming import ingest as stream
from clickfacts.streaming import pageviews

NOW = datetime(2024, 2, 1, tzinfo=UTC)
SMALL = "/root/testdata/sf0.001"


def content(df, *drop):
    kept = df.drop(*drop)
    return sorted(map(str, kept.select(sorted(kept.columns)).collect()))


def test_ingest_equals_batch_and_survives_replay(spark, tmp_path):
    root, out, state = (str(tmp_path / n) for n in ("raw", "out", "state"))
    raw.write_lines(star.raw_files(star.table(spark, SMALL, "events")), root, ["event_id", "part"])

    def go():
        stream.start_ingest(spark, root, out, state, now=NOW, files_per_batch=40).awaitTermination()
        return {t: content(spark.read.parquet(f"{out}/{t}"), "batch_id", "path") for t in stream.TABLES}

    first = go()
    assert spark.read.parquet(f"{out}/file_summary").select("batch_id").distinct().count() > 1
    batch = ingest.run(spark, root, now=NOW)
    outputs = (batch.summary, batch.failures, batch.reports, batch.quarantine, batch.metrics)
    for name, df in zip(stream.TABLES, outputs, strict=True):
        assert first[name] == content(df, "path"), name
    assert go() == first
    # The last batch is replayed when its commit is lost.
    commits = sorted((tmp_path / "state" / "commits").glob("[0-9]*"), key=lambda p: int(p.name))
    lost = tmp_path / "lost"
    lost.mkdir()
    shutil.move(commits[-1], lost / commits[-1].name)
    for crc in (tmp_path / "state" / "commits").glob(f".{commits[-1].name}.crc"):
        shutil.move(crc, lost / crc.name)
    assert go() == first


def _lose_last_commit(tmp_path, state):
    """The last batch is replayed when its commit is lost."""
    commits = sorted((state / "commits").glob("[0-9]*"), key=lambda p: int(p.name))
    lost = tmp_path / f"lost-{uuid.uuid4().hex}"
    lost.mkdir()
    for p in (commits[-1], state / "commits" / f".{commits[-1].name}.crc"):
        if p.exists():
            shutil.move(p, lost / p.name)


def _undated(views):
    return views.withColumn("date", F.when(F.length("session_id") % 5 != 0, F.col("date")))


def test_unique_events_over_batches(spark, tmp_path):
    """Copies in different files and batches, days out of order, undated views, a replay: the survivors of a batch job."""
    views = _undated(star.raw_page_views(star.table(spark, SMALL, "events")))
    root, out, state = (str(tmp_path / n) for n in ("raw", "out", "state"))
    raw.write_scattered(views, root, F.col("date"), 3, views.columns)

    def go():
        pageviews.start_unique(raw.stream_events(spark, root, "page_view", 20), "page_view", out, state).awaitTermination()
        return content(pageviews.read_unique(spark, out, "page_view"))

    first = go()
    want = clean.dedup_page_views(clean.parse_page_views(views))
    assert first == content(want) and want.where("date IS NULL").count()
    assert spark.read.parquet(out).select("batch_id").distinct().count() > 3
    rows = spark.read.parquet(out).count()
    _lose_last_commit(tmp_path, tmp_path / "state")
    assert go() == first and spark.read.parquet(out).count() == rows
    # A day that is delivered once more adds no row while the state remembers it.
    again = views.where(F.col("date") == views.agg(F.min("date")).first()[0])
    raw.write_scattered(again, f"{root}-again", F.col("date"), 1, ["session_id"])
    shutil.copytree(f"{root}-again", root, dirs_exist_ok=True)
    assert go() == first and spark.read.parquet(out).count() == rows


def test_other_versions_after_the_state_are_merged(spark, tmp_path):
    """A copy that comes when the state has forgotten its key stands beside it and is merged by the reader."""
    out = str(tmp_path / "out")
    rows = [("page_view", f"u{i}", "s", f"/p/{i % 3}", "home", "2024-01-01T00:00:0{}Z".format(i % 3), str(i), "", "", "", date(2024, 1, 1)) for i in range(9)]
    names = "event_type user_id session_id page_url page_type timestamp time_on_page_seconds referrer device_type country".split()
    views = spark.createDataFrame(rows, ", ".join(f"{n} string" for n in names) + ", date date")
    for i in range(3):
        root = str(tmp_path / f"raw{i}")
        raw.write_raw(views.where(F.col("user_id").isin([f"u{3 * i + j}" for j in range(3)])), root, F.col("date"))
        # A new state every time, as after the time to live.
        events = raw.stream_events(spark, root, "page_view")
        pageviews.start_unique(events, "page_view", f"{out}/part={i}", str(tmp_path / f"state{i}")).awaitTermination()
    assert spark.read.parquet(out).count() == 9
    got = pageviews.read_unique(spark, out, "page_view").drop("part")
    assert sorted((r.page_url, r.time_on_page_seconds) for r in got.collect()) == [(f"/p/{i}", 6.0 + i) for i in range(3)]


def test_page_stats_add_up(spark, tmp_path):
    """Several runs, days out of order, undated views, copies, a replay; a batch reads and writes its own rows only."""
    views = _undated(star.raw_page_views(star.table(spark, SMALL, "events")))
    root, out, state = (str(tmp_path / n) for n in ("raw", "out", "state"))
    days = [r.date for r in views.select("date").distinct().orderBy(F.col("date").desc_nulls_first()).collect()]
    queries = []

    def go():
        parsed = clean.parse_page_views(raw.stream_events(spark, root, "page_view", 20))
        query = pageviews.start_page_stats(parsed, out, state)
        query.awaitTermination()
        queries.append(query)
        return content(pageviews.read_page_stats(spark, out))

    def some_of(some):
        null = F.col("date").isNull() if None in some else F.lit(False)
        return views.where(F.col("date").isin([d for d in some if d]) | null)

    for some in (days[:5], days[20:], days[5:20]):
        raw.write_raw(some_of(some), root, F.col("date"))
        got = go()
    want = pages.page_stats(clean.clean_page_views(views))
    assert got == content(want) and want.where("date IS NULL").count()
    # A stored day in a new file adds nothing, neither does a replay; the batch read the rows of that day alone.
    raw.write_raw(some_of(days[7:8]), root, F.col("date"))
    assert go() == got
    assert sum(p.numInputRows for p in queries[-1].recentProgress) == some_of(days[7:8]).count()
    partials = spark.read.parquet(out)
    last = partials.agg(F.max("batch_id")).first()[0]
    assert last < 8 and partials.where("batch_id > 2").count() < partials.count()
    _lose_last_commit(tmp_path, tmp_path / "state")
    assert go() == got


def test_long_days_are_more_files(spark, tmp_path):
    """No file of a scattered zone is much longer than asked for, each is a task's, and copies of a key can stay together."""
    views = _undated(star.raw_page_views(star.table(spark, SMALL, "events")))
    by, root = ["session_id", "page_url", "timestamp"], str(tmp_path / "raw")
    raw.write_scattered(views, root, F.col("date"), 2, by, rows=20)
    stored = spark.read.json(root).select("*", F.input_file_name().alias("file"))
    assert content(stored, "file", "year", "month", "day") == content(views.select(*[F.to_json(F.struct(*views.columns)).alias("j")]).select(
        F.from_json("j", stored.drop("file", "year", "month", "day").schema).alias("r")).select("r.*"))
    per_file = [r["count"] for r in stored.groupBy("file").count().collect()]
    assert len(per_file) > 62 and max(per_file) < 60
    assert stored.groupBy(*by, "date").agg(F.count_distinct("file").alias("n")).agg(F.max("n")).first()[0] == 1
    raw.write_scattered(views.limit(0), f"{root}-none", F.col("date"), 2, by)


def test_state_is_on_disk_and_holds_digests(spark, tmp_path):
    views = star.raw_page_views(star.table(spark, SMALL, "events"))
    root = str(tmp_path / "raw")
    raw.write_raw(views, root, F.col("date"))
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    events = raw.stream_events(spark, root, "page_view")
    unique = pageviews.start_unique(events, "page_view", str(tmp_path / "unique"), str(tmp_path / "state"))
    stats = pageviews.start_page_stats(clean.parse_page_views(events), str(tmp_path / "stats"), str(tmp_path / "stats-state"))
    for query in (unique, stats):
        query.awaitTermination()
        assert "rocksdbPutCount" in str([p.json for p in query.recentProgress])
    assert spark.conf.get(name) == before
    keys = spark.read.format("statestore").load(str(tmp_path / "state")).select("key.*")
    assert keys.dtypes == [("_digest", "binary")]


def test_digests_differ_where_rows_do(spark):
    rows = [("a", None, 1), ("a", "", 1), (None, "a", 1), ('a","t":"', "b", 1), ("a", '","t":"b', 1), ("a", "b", 1), ("a", "b", 2)]
    df = spark.createDataFrame(rows, "s string, t string, n long").withColumn("at", F.timestamp_micros("n"))
    digests = [r[0] for r in df.select(pageviews._digest(df)).collect()]
    assert len(set(digests)) == len(rows) and digests == [r[0] for r in df.select(pageviews._digest(df)).collect()]


def test_a_long_day_of_a_batch_is_split(spark, tmp_path):
    """Streams with state run without adaptive execution; the write of their batches still splits a day by size."""
    rows = spark.range(20000).select(F.lit(date(2024, 1, 1)).alias("date"), F.sha2(F.col("id").cast("string"), 256).alias("text"))
    sizes = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k", "spark.sql.adaptive.enabled": "false"}
    kept = {k: spark.conf.get(k) for k in sizes}
    try:
        for k, v in sizes.items():
            spark.conf.set(k, v)
        pageviews._write(rows.repartition(8), str(tmp_path / "out"), 0)
        assert spark.conf.get("spark.sql.adaptive.enabled") == "false"
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
    assert len(list((tmp_path / "out").glob("batch_id=0/date=*/*.parquet"))) > 1


def test_a_batch_takes_more_files_of_a_large_zone(spark, tmp_path, monkeypatch):
    root = tmp_path / "raw"
    monkeypatch.setattr(storage, "scattered_zone", lambda *_: str(root))
    taken = []
    monkeypatch.setattr(storage.raw, "stream_events", lambda spark, root, kind, files: taken.append(files))
    cores = spark.sparkContext.defaultParallelism
    for n in (3, 30, 9 * cores):
        for i in range(n):
            path = root / f"event_type=page_view/year=2024/month=01/day=01/{i}.json"
            path.parent.mkdir(parents=True, exist_ok=True)
            path.write_text("{}\n")
        storage._feed_stream(spark, "none", "page_view", 5)
    assert taken == [5, 10, 2 * cores]


def _order_tables(spark, folder, orders=40):
    """Order lines of some keys, repeated lines, a line without an order and a null key."""
    rows = [(k, 100 + k % 7, n, float(k), 10.5 * k, "ANR"[k % 3], datetime(1995 + k % 3, 1 + k % 12, 3)) for k in range(orders) for n in range(1, 7)]
    rows += [*rows[:9], (999, 1, 1, 1.0, 2.0, "A", datetime(1995, 1, 1)), (None, 1, 1, 1.0, 2.0, "A", datetime(1995, 1, 1))]
    names = "l_orderkey long, l_partkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_returnflag string, l_shipdate timestamp"
    spark.createDataFrame(rows, names).write.parquet(f"{folder}/lineitem.parquet")
    customers = [(k, k % 11 or None) for k in range(orders)]
    spark.createDataFrame([*customers, (None, 3)], "o_orderkey long, o_custkey long").write.parquet(f"{folder}/orders.parquet")
    return (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("lineitem", "orders"))


def _shuffles(spark):
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {n for top in disk.localDirsString() for _, _, names in os.walk(top) for n in names if n.startswith("shuffle_") and n.endswith(".data")}


def _gone(found):
    until = time.monotonic() + 10
    while found() and time.monotonic() < until:
        time.sleep(0.1)
    return not found()


def _unique_rows(spark, tmp_path, monkeypatch, name, kind, raw_rows):
    """A dedup query in one round and in several: the rows of a batch job; only unique events stay on disk, no shuffle file."""
    lines, orders = _order_tables(spark, tmp_path)
    columns = registry.QUERIES[name](spark, str(tmp_path)).columns
    feed = pageviews.FEEDS[kind]
    dated = raw_rows(lines, orders).withColumn("date", F.trunc("date", "year"))
    want = content(feed.one(feed.parse(dated)).withColumn("date", registry.day()).select(columns))
    for rows in (registry.ROUND_ROWS, 30):
        shared, before = tmp_path / f"shared{rows}", _shuffles(spark)
        monkeypatch.setattr(registry, "ROUND_ROWS", rows)
        monkeypatch.setattr(storage.staging, "shared_root", lambda _, to=shared: str(to))
        got = registry.QUERIES[name](spark, str(tmp_path))
        assert _gone(lambda: _shuffles(spark) - before)
        assert content(got) == want, rows
        left = {p.name for p in (shared / "clickfacts").iterdir() if not p.name.startswith("scattered-")}
        assert len(left) == 1 and left.pop().endswith("-unique") == (rows == 30)


def test_carts_leave_their_unique_events_only(spark, tmp_path, monkeypatch):
    _unique_rows(spark, tmp_path, monkeypatch, "stream_dedup_carts", "cart_event", star.raw_cart_events)


def test_products_leave_their_unique_events_only(spark, tmp_path, monkeypatch):
    _unique_rows(spark, tmp_path, monkeypatch, "stream_dedup_products", "product_view", star.raw_product_views)


def test_a_round_selects_sessions_below_the_join(spark, tmp_path, monkeypatch):
    lines, orders = _order_tables(spark, tmp_path)
    monkeypatch.setattr(registry, "ROUND_ROWS", 100)
    rounds = registry.in_rounds(star.raw_cart_events(lines, orders), 300)
    plan = rounds[0]._jdf.queryExecution().optimizedPlan().toString()
    assert len(rounds) == 3 and plan.index("Join") < plan.index("pmod") and plan.count("pmod") == 2
    assert sorted(r for some in rounds for r in content(some)) == content(star.raw_cart_events(lines, orders))


def test_checkpoints_hold_changes_of_short_digests(spark, tmp_path):
    """The checkpoint has each change once and no rewritten state, and forgets old batches; read files go if asked."""
    views = star.raw_page_views(star.table(spark, SMALL, "events"))
    root, out, state = (str(tmp_path / n) for n in ("raw", "out", "state"))
    raw.write_scattered(views, root, F.col("date"), 2, views.columns)
    events = raw.stream_events(spark, root, "page_view", 12, consume=True)
    pageviews.start_unique(events, "page_view", out, state).awaitTermination()
    assert content(pageviews.read_unique(spark, out, "page_view")) == content(clean.dedup_page_views(clean.parse_page_views(views)))
    names = [p.name for p in (tmp_path / "state" / "state").rglob("*")]
    assert any(n.endswith(".changelog") for n in names) and not any(n.endswith(".sst") for n in names)
    assert len([p for p in (tmp_path / "state" / "commits").iterdir() if p.name.isdigit()]) <= 3
    assert [len(r[0]) for r in spark.read.format("statestore").load(state).select("key._digest").distinct().limit(5).collect()] == [16] * 5
    # The files of the last batch may stay.
    left = [p for p in (tmp_path / "raw").rglob("*.gz")]
    assert len(left) <= 12


def test_parts_of_the_state_are_bounded_by_cores(spark, tmp_path):
    name = "spark.sql.shuffle.partitions"
    before, most = spark.conf.get(name), 4 * spark.sparkContext.defaultParallelism
    try:
        for given in (most + 100, most, 3):
            spark.conf.set(name, given)
            with storage.pageviews.state_on_disk(spark):
                assert int(spark.conf.get(name)) == min(given, most)
            assert int(spark.conf.get(name)) == given
    finally:
        spark.conf.set(name, before)
