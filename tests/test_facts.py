"""Cleaning and facts on a small day worked out by hand."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from clickfacts.operators import clean, pages, sessions
from clickfacts.plans import daily

DAY = date(2026, 5, 20)
RAW = "user_id string, session_id string, page_url string, page_type string, timestamp string, " \
      "time_on_page_seconds string, device_type string, country string, date date"


def view(session, user, url, kind, at, seconds, device=" Mobile", country="co "):
    return (user, session, url, kind, f"2026-05-20T{at}Z", seconds, device, country, DAY)


ROWS = [
    view("s1", "u1", "/home", " Home ", "10:00:00", "60"),
    view("s1", "u1", "/home", " Home ", "10:00:00", "60"),
    view("s1", "u1", "/cart", "cart", "10:01:00", "10"),
    view("s2", "u2", "/home", "home", "11:00:00", "30"),
    view("s2", "u2", "/home", "home", "11:00:30", None),
    view("s3", "u3", "/home", "home", "12:00:00", "-5"),
    view("s4", "u4", "/x", None, "13:00:00", "100000"),
    view("s5", None, "/home", "home", "14:00:00", "20"),
]


@pytest.fixture(scope="module")
def raw(spark):
    return spark.createDataFrame(ROWS, RAW)


@pytest.fixture(scope="module")
def pv(raw):
    return clean.clean_page_views(raw).cache()


def test_clean(pv):
    rows = pv.collect()
    assert sorted(r.time_on_page_seconds for r in rows) == [0, 10, 30, 30, 60, 86400]
    assert {(r.device_type, r.country) for r in rows} == {("mobile", "CO")}


def test_cleaning_is_idempotent(pv):
    again = clean.clean_page_views(pv.withColumn("timestamp", F.col("timestamp").cast("string")))
    columns = sorted(pv.columns)
    assert sorted(map(str, again.select(columns).collect())) == sorted(map(str, pv.select(columns).collect()))


def test_bounce(pv):
    want = {("home", 3, 2, 0.6667), ("cart", 1, 1, 1.0), (None, 1, 0, 0.0)}
    rates = pages.bounce_rate(pv)
    assert {(r.page_type, r.total, r.bounces, r.bounce_rate) for r in rates.collect()} == want
    groups = pv.select("date", F.explode(F.array("page_type", F.lit("none"))).alias("page_type")).distinct()
    assert {(r.page_type, r.total, r.bounces, r.bounce_rate) for r in pages.complete(rates, groups).collect()} == want | {("none", 0, 0, 0.0)}


def test_page_stats(pv):
    top = [(r.page_url, r.avg_time_on_page_seconds, r.total_views, r.unique_sessions)
           for r in pages.top_pages(pages.page_stats(pv)).collect()]
    assert top == [("/x", 86400.0, 1, 1), ("/home", 30.0, 4, 3), ("/cart", 10.0, 1, 1)]
    assert pages.top_pages(pages.page_stats(pv), 1).count() == 1


def test_top_pages_by_day_agrees_with_single_days(spark):
    rows = [("s%d" % (i % 7), "u", f"/{i % 31}", "t", f"2026-05-{20 + i % 3}T00:00:{i % 60:02d}Z", str(i * 7 % 101), "d",
             "c", date(2026, 5, 20 + i % 3)) for i in range(600)]
    stats = pages.page_stats(clean.clean_page_views(spark.createDataFrame(rows, RAW)))
    by_day = pages.top_pages_by_day(stats, 5).orderBy("date", "rank").collect()
    for d in (20, 21, 22):
        one = pages.top_pages(stats.where(F.col("date") == date(2026, 5, d)), 5).collect()
        assert [r.page_url for r in one] == [r.page_url for r in by_day if r.date.day == d]


def test_session_time(pv):
    assert {r.session_id: r.total_time for r in sessions.session_time(pv).collect()} == {
        "s1": 70.0, "s2": 60.0, "s3": 0.0, "s4": 86400.0
    }


def test_page_metrics(pv):
    got = {r.page_url: (r.page_type, r.avg_time_on_page, r.bounce_rate, r.total_sessions)
           for r in pages.page_metrics(pv).collect()}
    assert got == {"/home": ("home", 30.0, 0.6667, 3), "/cart": ("cart", 10.0, 1.0, 1), "/x": (None, 86400.0, 1.0, 1)}


def test_session_summary(pv):
    r = sessions.session_summary(pv).first()
    assert (r.country, r.device_type, r.total_sessions, r.total_pageviews, r.unique_users) == ("CO", "mobile", 4, 6, 4)
    assert r.avg_session_duration == pytest.approx((70 + 60 + 0 + 86400) / 4 / 60)


def _times(spark, values, day=DAY):
    return spark.createDataFrame(
        [(day, f"s{i}", f"u{i}", float(v)) for i, v in enumerate(values)],
        "date date, session_id string, user_id string, total_time double",
    )


def test_one_session_has_no_deviation(spark):
    st = _times(spark, [50])
    r = sessions.time_stats(st).first()
    assert (r.mean_time, r.stddev_time, r.q1, r.q3) == (50.0, 1.0, 50.0, 50.0)
    assert sessions.session_anomalies(st).count() == 0


def test_equal_sessions(spark):
    assert sessions.session_anomalies(_times(spark, [7] * 20)).count() == 0


def test_anomalies_both_tails_and_days_apart(spark):
    st = _times(spark, [100 + i % 5 for i in range(50)] + [1000, 0]).unionByName(
        _times(spark, [1000 + i % 5 for i in range(50)], date(2026, 5, 21))
    )
    rows = {(r.date.day, r.metric_value): r for r in sessions.session_anomalies(st).collect()}
    assert set(rows) == {(20, 1000.0), (20, 0.0)}
    high = rows[20, 1000.0]
    assert high.anomaly_type == "high_time_on_page"
    assert high.description == "Tiempo anomalo: 1000.0 seg"
    values = [100 + i % 5 for i in range(50)] + [1000, 0]
    mean = sum(values) / len(values)
    dev = (sum((v - mean) ** 2 for v in values) / (len(values) - 1)) ** 0.5
    assert high.z_score == pytest.approx((1000 - mean) / dev)


def test_anomaly_table_key(spark):
    schema = "session_id string, user_id string, anomaly_type string, z_score double, metric_value double, " \
             "description string, date date"
    rows = [("s", "u2", "t", 5.0, 1.0, "", DAY), ("s", "u1", "t", 5.0, 2.0, "", DAY), ("s", "u0", "t", 4.0, 3.0, "", DAY),
            ("s", "u0", "other", 1.0, 3.0, "", DAY)]
    got = sessions.anomaly_table(spark.createDataFrame(rows, schema)).collect()
    assert {(r.user_id, r.anomaly_type) for r in got} == {("u1", "t"), ("u0", "other")}


def test_keep_one_is_deterministic_and_null_safe(spark):
    rows = [(None, 1, "a"), (None, 1, "b"), (None, None, "c"), ("k", 3, "x"), ("k", 3, "y"), ("k", 9, None)]
    df = spark.createDataFrame(rows, "k string, v int, w string")
    for parts in (1, 3, 6):
        got = clean.keep_one(df.repartition(parts), ["k"], ["v"], largest=True).collect()
        assert {tuple(r) for r in got} == {(None, 1, "b"), ("k", 9, None)}
        got = clean.keep_one(df.repartition(parts), ["k"], ["v"]).collect()
        assert {tuple(r) for r in got} == {(None, None, "c"), ("k", 3, "x")}


def test_unreadable_values_do_not_raise(spark):
    bad = ("u", "s", "p", "c", "n/a", "not a time", "x", DAY)
    views = spark.createDataFrame(
        [bad, bad, ("u", "s", None, "c", "1", "2026-05-20", "1", DAY)],
        "user_id string, session_id string, product_id string, category string, price string, timestamp string, "
        "time_on_page_seconds string, date date",
    )
    got = clean.clean_product_views(views).collect()
    assert [(r.price, r.timestamp, r.time_on_page_seconds) for r in got] == [(None, None, None)]


def test_cart_actions(spark):
    carts = spark.createDataFrame(
        [("u", "s", "p", a, "2026-05-20", DAY) for a in (" ADD", "add", "remove", "buy", None)],
        "user_id string, session_id string, product_id string, action string, timestamp string, date date",
    )
    assert sorted(r.action for r in clean.clean_cart_events(carts).collect()) == ["add", "remove"]


def test_rapid_clicks(spark):
    rows = [(DAY, f"s{i}", f"u{i}", f"2026-05-20 00:{i % 60:02d}:00") for i in range(60)]
    rows += [(DAY, "bot", "b", f"2026-05-20 10:00:{i:02d}") for i in range(40)]
    clicks = spark.createDataFrame(rows, "date date, session_id string, user_id string, t string").select(
        "date", "session_id", "user_id", F.to_timestamp("t").alias("timestamp")
    )
    (r,) = sessions.rapid_clicks(clicks).collect()
    assert (r.session_id, r.metric_value, r.anomaly_type) == ("bot", 40.0, "rapid_clicks")


def test_hot_session_page_and_copies(spark):
    """A third of all rows in one session, a third copies of one view: results match plain aggregation."""
    n = 30_000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 500)).alias("session_id"),
        F.lit("u").alias("user_id"),
        F.when(F.col("id") % 3 != 2, "/hot").otherwise(F.concat(F.lit("/"), F.col("id") % 50)).alias("page_url"),
        F.lit("t").alias("page_type"),
        F.when(F.col("id") % 3 == 1, "2026-05-20T00:00:00Z").otherwise(
            F.date_format(F.timestamp_seconds(F.lit(1779235200) + F.col("id")), "yyyy-MM-dd'T'HH:mm:ss'Z'")
        ).alias("timestamp"),
        (F.col("id") % 100).cast("string").alias("time_on_page_seconds"),
        F.lit("mobile").alias("device_type"),
        F.lit("CO").alias("country"),
        F.lit(DAY).alias("date"),
    )
    views = clean.clean_page_views(df).cache()
    pdf = df.toPandas()
    pdf["time_on_page_seconds"] = pdf["time_on_page_seconds"].astype(float)
    unique = pdf.groupby(["session_id", "page_url", "timestamp"], as_index=False)["time_on_page_seconds"].max()
    assert views.count() == len(unique)
    want = unique.groupby("page_url").agg(n=("session_id", "size"), s=("session_id", "nunique"))
    got = {r.page_url: (r.total_views, r.unique_sessions) for r in pages.page_stats(views).collect()}
    assert got == {u: (r.n, r.s) for u, r in want.iterrows()}
    times = unique.groupby("session_id")["time_on_page_seconds"].sum()
    assert {r.session_id: r.total_time for r in sessions.session_time(views).collect()} == dict(times)


def test_facts_over_days_equal_facts_per_day(spark):
    rows = []
    for d in (20, 21):
        for i in range(200):
            rows.append((f"u{i % 9}", f"s{i % 40}", f"/{i % 11}", f"t{i % 4}", f"2026-05-{d}T00:{i % 60:02d}:00Z",
                         str(i * d % 97), "mobile", "CO", date(2026, 5, d)))
    pv = clean.clean_page_views(spark.createDataFrame(rows, RAW)).cache()
    together = daily.facts(pv)
    for d in (20, 21):
        one = date(2026, 5, d)
        alone = daily.facts(pv.where(F.col("date") == one))
        for name, df in together.items():
            got = sorted(map(str, df.where(F.col("date") == one).collect()))
            assert got == sorted(map(str, alone[name].collect())), name
