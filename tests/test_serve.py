"""Reports over the seed rows of the serving tables (fixed values)."""

from datetime import date

import pytest

from clickfacts import schemas
from clickfacts.operators import serve, tables
from clickfacts.sources import tables as stored

DAY = "2026-05-20"
D = date(2026, 5, 20)
PAGES = [
    ("/home", "home", 45.2, 0.32, 1200),
    ("/category/electronics", "category", 67.8, 0.21, 980),
    ("/product/PROD-0001", "product", 120.5, 0.15, 750),
    ("/cart", "cart", 89.3, 0.45, 430),
    ("/checkout", "checkout", 210.1, 0.60, 200),
    ("/category/clothing", "category", 55.4, 0.28, 870),
    ("/product/PROD-0002", "product", 95.2, 0.18, 620),
    ("/search", "search", 38.7, 0.41, 540),
    ("/product/PROD-0003", "product", 145.0, 0.12, 390),
    ("/category/sports", "category", 72.1, 0.25, 310),
]
SESSIONS = [
    ("CO", "mobile", 3200, 4.5, 9800, 2100),
    ("CO", "desktop", 1800, 7.2, 7200, 1400),
    ("MX", "mobile", 2900, 3.8, 8700, 1900),
    ("MX", "desktop", 1500, 6.9, 5800, 1200),
    ("US", "mobile", 2100, 5.1, 6300, 1700),
    ("US", "desktop", 2400, 8.3, 9600, 2000),
    ("AR", "tablet", 800, 6.0, 2400, 650),
    ("BR", "mobile", 1900, 4.2, 5700, 1500),
    ("CO", "tablet", 450, 5.5, 1350, 380),
    ("ES", "desktop", 1100, 7.8, 4400, 900),
]
ANOMALIES = [
    ("SES-abc001", "USR-00123", "high_time_on_page", 4.2, 8200.0),
    ("SES-abc002", "USR-00456", "rapid_clicks", 3.8, 145.0),
    ("SES-abc003", "USR-00789", "high_time_on_page", 5.1, 12400.0),
    ("SES-abc004", "USR-01234", "unusual_navigation", 3.2, 89.0),
    ("SES-abc005", "USR-01567", "rapid_clicks", 4.7, 210.0),
]


@pytest.fixture(scope="module")
def page_metrics(spark):
    return spark.createDataFrame([(D, *r) for r in PAGES], schemas.PAGE_METRICS)


@pytest.fixture(scope="module")
def session_summary(spark):
    rows = [(D, c, d, n, float(t), v, u) for c, d, n, t, v, u in SESSIONS]
    return spark.createDataFrame(rows, schemas.SESSION_SUMMARY)


@pytest.fixture(scope="module")
def anomaly_rows(spark):
    return spark.createDataFrame([(D, *r, "text") for r in ANOMALIES], schemas.ANOMALIES)


def test_pages_top_bounce(page_metrics):
    got = serve.pages_top(page_metrics, "bounce_rate", DAY, 3).collect()
    assert [(r["rank"], r.page_url, r.bounce_rate, r.bounce_rate_pct) for r in got] == [
        (1, "/checkout", 0.6, "60.0%"), (2, "/cart", 0.45, "45.0%"), (3, "/search", 0.41, "41.0%")
    ]


def test_pages_top_time(page_metrics):
    got = serve.pages_top(page_metrics, "time_on_page", DAY, "3").collect()
    assert [(r.page_url, r.avg_time_on_page_seconds) for r in got] == [
        ("/checkout", 210.1), ("/product/PROD-0003", 145.0), ("/product/PROD-0001", 120.5)
    ]
    assert serve.pages_top(page_metrics, "time_on_page", DAY).count() == 10


def test_pages_top_lenient(page_metrics):
    got = serve.pages_top(page_metrics, "z", DAY, 3, strict=False)
    assert got.columns == ["date", "page_url", "page_type", "avg_time_on_page", "bounce_rate", "total_sessions"]
    assert [r.page_url for r in got.collect()] == ["/checkout", "/product/PROD-0003", "/product/PROD-0001"]
    assert serve.pages_top(page_metrics, strict=False).first().page_url == "/checkout"


@pytest.mark.parametrize(
    "args",
    [
        ("bounce_rate", DAY, 0), ("bounce_rate", DAY, 101), ("bounce_rate", DAY, "x"), ("z", DAY, 3), (None, DAY, 3),
        ("bounce_rate", "20-05-2026", 3), ("bounce_rate", "2026-13-01", 3), ("bounce_rate", None, 3), ("bounce_rate", "", 3),
    ],
)
def test_pages_top_rejects(page_metrics, args):
    with pytest.raises(ValueError):
        serve.pages_top(page_metrics, *args)


@pytest.mark.parametrize("other", ["2026-05-21", "2026-5-20"])
def test_other_days_are_empty(page_metrics, session_summary, anomaly_rows, other):
    assert serve.pages_top(page_metrics, "bounce_rate", other).count() == 0
    assert serve.sessions_summary(session_summary, other).count() == 0
    assert serve.anomalies(anomaly_rows, other).count() == 0
    assert serve.anomalies(anomaly_rows, "nonsense", strict=False).count() == 0


def test_unknown_values_stay_unknown(spark):
    df = spark.createDataFrame([(D, "/a", None, None, None, 1), (D, "/b", "t", 1.0, 0.5, 1)], schemas.PAGE_METRICS)
    got = serve.pages_top(df, "bounce_rate", DAY).collect()
    assert [(r.page_url, r.bounce_rate) for r in got] == [("/b", 0.5), ("/a", None)]


def test_sessions_summary(session_summary):
    got = serve.sessions_summary(session_summary, DAY).collect()
    assert len(got) == 10
    assert (got[0].country, got[0].device_type, got[0].total_sessions) == ("CO", "mobile", 3200)


def test_sessions_summary_country(session_summary):
    got = serve.sessions_summary(session_summary, DAY, country="co", totals=True).collect()
    total, *rows = got
    assert [(r.device_type, r.total_sessions, r.pageviews_per_session) for r in rows] == [
        ("mobile", 3200, 3.06), ("desktop", 1800, 4.0), ("tablet", 450, 3.0)
    ]
    assert total.is_total and (total.total_sessions, total.total_pageviews, total.unique_users) == (5450, 18350, 3880)


def test_sessions_summary_totals(session_summary):
    total = serve.sessions_summary(session_summary, DAY, totals=True).first()
    assert (total.total_sessions, total.total_pageviews, total.unique_users) == (18150, 61250, 13730)


def test_sessions_summary_device(session_summary):
    with pytest.raises(ValueError):
        serve.sessions_summary(session_summary, DAY, device="Mobile")
    assert serve.sessions_summary(session_summary, DAY, device="mobile").count() == 4
    assert serve.sessions_summary(session_summary, device="Mobile", strict=False).count() == 4


def test_no_sessions_gives_zero_ratio(spark):
    df = spark.createDataFrame([(D, "CO", "mobile", 0, 1.0, 5, 1)], schemas.SESSION_SUMMARY)
    assert serve.sessions_summary(df, DAY).first().pageviews_per_session == 0


def test_anomalies(anomaly_rows):
    got = serve.anomalies(anomaly_rows, DAY).collect()
    assert [(r.session_id[-3:], r.severity) for r in got] == [
        ("003", "high"), ("005", "high"), ("001", "high"), ("002", "medium"), ("004", "medium")
    ]
    assert [r.z_score for r in serve.anomalies(anomaly_rows, strict=False).collect()] == [5.1, 4.7, 4.2, 3.8, 3.2]
    counts = {(r.anomaly_type, r.severity): r.total_anomalies for r in serve.anomaly_counts(anomaly_rows).collect()}
    assert counts == {
        ("high_time_on_page", "high"): 2, ("rapid_clicks", "high"): 1, ("rapid_clicks", "medium"): 1,
        ("unusual_navigation", "medium"): 1,
    }


def test_insert_or_ignore(spark, page_metrics):
    again = spark.createDataFrame(
        [(D, "/home", "x", 0.0, 0.0, 0), (D, "/new", "b", 2.0, 0.0, 2), (D, "/new", "a", 1.0, 0.0, 1)], schemas.PAGE_METRICS
    )
    merged = tables.insert_or_ignore(page_metrics, again, schemas.PAGE_METRICS_KEY, ["page_type"])
    assert merged.count() == 11
    assert merged.where("page_url = '/home'").first().total_sessions == 1200
    assert merged.where("page_url = '/new'").first().page_type == "a"


def test_stored_tables(spark, tmp_path, page_metrics):
    path = str(tmp_path / "page_metrics")
    stored.write_fact(page_metrics, path)
    other = spark.createDataFrame([(date(2026, 5, 21), "/home", "home", 1.0, 0.0, 1)], schemas.PAGE_METRICS)
    stored.write_fact(other, path)
    stored.write_fact(other, path)
    back = stored.read_fact(spark, path)
    assert back.count() == 11
    stored.append_new(page_metrics.limit(3).unionByName(
        spark.createDataFrame([(D, "/late", "t", 1.0, 0.0, 1)], schemas.PAGE_METRICS)), path, list(schemas.PAGE_METRICS_KEY))
    back = stored.read_fact(spark, path, schemas.PAGE_METRICS)
    assert back.count() == 12
    plan = serve.pages_top(back, "bounce_rate", DAY)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan


def test_enrich(spark):
    events = spark.createDataFrame([("e1", "u1", None), ("e2", "u2", "AR"), ("e3", None, None)],
                                   "id string, user_id string, country string")
    users = spark.createDataFrame([("u1", "CO", "mobile"), ("u2", "MX", "tablet")], schemas.USER_CATALOG)
    got = {r.id: (r.country, r.device_type)
           for r in tables.enrich(events, users, "user_id", ["country", "device_type"]).collect()}
    assert got == {"e1": ("CO", "mobile"), "e2": ("AR", "tablet"), "e3": (None, None)}


def test_enrich_by_shuffle_spreads_rows_without_key(spark):
    events = spark.range(4000).selectExpr(
        "id", "case when id % 3 = 0 then 'hot' when id % 3 = 1 then concat('u', id % 50) end as user_id"
    )
    users = spark.createDataFrame([("hot", "CO", "mobile")] + [(f"u{i}", "MX", "tablet") for i in range(40)],
                                  schemas.USER_CATALOG)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        joined = tables.enrich(events, users, "user_id", ["country"])
        assert "SortMergeJoin" in joined._jdf.queryExecution().executedPlan().toString()
        got = {r.id: r.country for r in joined.collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
    want = {i: "CO" if i % 3 == 0 else "MX" if i % 3 == 1 and i % 50 < 40 else None for i in range(4000)}
    assert got == want
