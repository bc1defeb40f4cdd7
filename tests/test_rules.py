"""One line per branch of the record validation."""

import json

import pytest
from pyspark.sql import functions as F

from clickfacts.functions import rules
from clickfacts.operators import quality

BASE = {
    "event_type": "page_view",
    "user_id": "USR-00001",
    "session_id": "SES-1",
    "page_url": "/home",
    "page_type": "home",
    "timestamp": "2026-05-20T10:00:00Z",
    "time_on_page_seconds": 90,
    "referrer": "google",
    "device_type": "mobile",
    "country": "CO",
}
OTHERS = {
    "click": {
        "event_type": "click", "user_id": "U", "session_id": "S", "element_id": "el", "element_type": "link",
        "page_url": "/", "timestamp": "2026-05-20", "x_position": 7680, "y_position": 4320,
    },
    "search": {
        "event_type": "search", "user_id": "U", "session_id": "S", "query": "q", "results_count": 10000,
        "timestamp": "2026-05-20",
    },
    "product_view": {
        "event_type": "product_view", "user_id": "U", "session_id": "S", "product_id": "P", "category": "books",
        "price": 9.99, "timestamp": "2026-05-20", "time_on_page_seconds": 0,
    },
    "cart_event": {
        "event_type": "cart_event", "user_id": "U", "session_id": "S", "product_id": "P", "action": "add",
        "timestamp": "2026-05-20",
    },
}
DROP = object()


def line(base=BASE, **changes):
    return json.dumps({k: v for k, v in {**base, **changes}.items() if v is not DROP})


def page(**changes):
    return line(BASE, **changes)


TIME = "time_on_page_seconds"
CASES = [
    (page(), []),
    ("{bad", ["INVALID_JSON"]),
    (page() + " x", ["INVALID_JSON"]),
    (page() + page(), ["INVALID_JSON"]),
    (page() + "," + page(), ["INVALID_JSON"]),
    (page() + "],[1", ["INVALID_JSON"]),
    ("", ["INVALID_JSON"]),
    ('{"user_id":"U"}', ["MISSING_EVENT_TYPE:event_type"]),
    ('{"event_type":""}', ["MISSING_EVENT_TYPE:event_type"]),
    ('{"event_type":0}', ["MISSING_EVENT_TYPE:event_type"]),
    ('{"event_type":0.0}', ["MISSING_EVENT_TYPE:event_type"]),
    ('{"event_type":false}', ["MISSING_EVENT_TYPE:event_type"]),
    ('{"event_type":null}', ["MISSING_EVENT_TYPE:event_type"]),
    ('{"event_type":[]}', ["MISSING_EVENT_TYPE:event_type"]),
    ('{"event_type":{}}', ["MISSING_EVENT_TYPE:event_type"]),
    ("{}", ["MISSING_EVENT_TYPE:event_type"]),
    (page(event_type="purchase"), ["UNKNOWN_EVENT_TYPE:event_type"]),
    ('{"event_type":5}', ["UNKNOWN_EVENT_TYPE:event_type"]),
    ('{"event_type":true}', ["UNKNOWN_EVENT_TYPE:event_type"]),
    (page(event_type=["page_view"]), "fatal"),
    (page(event_type={"a": 1}), "fatal"),
    (page(country=DROP), ["REQUIRED:country"]),
    (page(country=""), ["REQUIRED:country"]),
    (page(country=" "), []),
    (page(country=0), []),
    (page(country=False), []),
    (page(country=[]), []),
    (page(country={}), []),
    (page(**{TIME: "90"}), [f"TYPE:{TIME}"]),
    (page(**{TIME: "-5"}), [f"TYPE:{TIME}", f"RANGE:{TIME}"]),
    (page(**{TIME: " 7 "}), [f"TYPE:{TIME}"]),
    (page(**{TIME: "inf"}), [f"TYPE:{TIME}", f"RANGE:{TIME}"]),
    (page(**{TIME: "nan"}), [f"TYPE:{TIME}", f"RANGE:{TIME}"]),
    (page(**{TIME: "9e9"}), [f"TYPE:{TIME}", f"RANGE:{TIME}"]),
    (page(**{TIME: "-5d"}), [f"TYPE:{TIME}"]),
    (page(**{TIME: "abc"}), [f"TYPE:{TIME}"]),
    (page(**{TIME: [1]}), [f"TYPE:{TIME}"]),
    (page(**{TIME: {"a": 1}}), [f"TYPE:{TIME}"]),
    (page(**{TIME: True}), []),
    (page(**{TIME: 0}), []),
    (page(**{TIME: 86400}), []),
    (page(**{TIME: 86400.5}), [f"RANGE:{TIME}"]),
    (page(**{TIME: -0.1}), [f"RANGE:{TIME}"]),
    (page(**{TIME: 1e300}), [f"RANGE:{TIME}"]),
    (page(**{TIME: None}), [f"REQUIRED:{TIME}"]),
    (page(**{TIME: ""}), [f"REQUIRED:{TIME}", f"TYPE:{TIME}"]),
    (page(page_type=DROP), ["REQUIRED:page_type"]),
    (page(page_type=None), ["REQUIRED:page_type", "ENUM:page_type"]),
    (page(page_type=""), ["REQUIRED:page_type", "ENUM:page_type"]),
    (page(page_type="HOME"), ["ENUM:page_type"]),
    (page(page_type=["home"]), ["ENUM:page_type"]),
    (page(device_type="tv", page_type="x"), ["ENUM:page_type", "ENUM:device_type"]),
    (page(timestamp="2026-13-01T00:00:00Z"), ["TIMESTAMP:timestamp"]),
    (page(timestamp="2026-02-30"), ["TIMESTAMP:timestamp"]),
    (page(timestamp="2026"), ["TIMESTAMP:timestamp"]),
    (page(timestamp="10:00:00"), ["TIMESTAMP:timestamp"]),
    (page(timestamp=" 2026-05-20"), ["TIMESTAMP:timestamp"]),
    (page(timestamp=""), ["REQUIRED:timestamp"]),
    (page(timestamp=DROP), ["REQUIRED:timestamp"]),
    (page(timestamp=None), ["REQUIRED:timestamp"]),
    (page(timestamp="2026-05-20"), []),
    (page(timestamp="2026-05-20 10:00"), []),
    (page(timestamp="2026-05-20T10:00:00.123456+02:00"), []),
    (page(timestamp=1716200000), "fatal"),
    (page(timestamp=0.00001), "fatal"),
    (page(timestamp=True), "fatal"),
    (page(timestamp=[1]), "fatal"),
    (page(timestamp=0), []),
    (page(timestamp=[]), []),
    ("[1]", "fatal"),
    ("5", "fatal"),
    ('"text"', "fatal"),
    ("null", "fatal"),
    ("[" + page() + "]", "fatal"),
    (page(extra={"a": [1, {"b": "}"}]}, note="a}b"), []),
    ("\t " + page() + "  ", []),
    ('{"event_type":"search",' + page(event_type=DROP)[1:], [
        "REQUIRED:query", "REQUIRED:results_count",
    ]),
    (page()[:-1] + ',"country":"MX"}', []),
    (page()[:-1] + ',"country":""}', ["REQUIRED:country"]),
    (page(**{TIME: float("nan")}), [f"RANGE:{TIME}"]),
    (page(**{TIME: float("-inf")}), [f"RANGE:{TIME}"]),
    (page(**{TIME: "Infinity"}), [f"TYPE:{TIME}", f"RANGE:{TIME}"]),
    (page(score=float("nan"), more=[1, float("inf"), {"a": float("-inf")}]), []),
    (page(note="a, NaN, b: Infinity ]", NaN=float("nan")), []),
    (page(country=float("nan")), []),
    (page(page_type=float("inf")), ["ENUM:page_type"]),
    (page(timestamp=float("nan")), "fatal"),
    (page(event_type=float("nan")), ["UNKNOWN_EVENT_TYPE:event_type"]),
    (page(score="@").replace('"@"', "+Infinity"), ["INVALID_JSON"]),
    (page(score="@").replace('"@"', "NaNs"), ["INVALID_JSON"]),
    (page(score="@").replace('"@"', "nan"), ["INVALID_JSON"]),
    (page(score=float("nan")) + " NaN", ["INVALID_JSON"]),
    ("NaN", "fatal"),
    (" [Infinity]", "fatal"),
    (
        page(country=DROP, page_type="x", timestamp="zz", **{TIME: -1}),
        ["REQUIRED:country", f"RANGE:{TIME}", "ENUM:page_type", "TIMESTAMP:timestamp"],
    ),
    *[(line(base), []) for base in OTHERS.values()],
    *[
        (line(base, **{field: DROP}), [f"REQUIRED:{field}"])
        for base in [BASE, *OTHERS.values()]
        for field in base
        if field != "event_type"
    ],
    (line(OTHERS["click"], x_position=7681, y_position=-1), ["RANGE:x_position", "RANGE:y_position"]),
    (line(OTHERS["click"], x_position="1", y_position="1"), ["TYPE:x_position", "TYPE:y_position"]),
    (line(OTHERS["search"], results_count=10001), ["RANGE:results_count"]),
    (line(OTHERS["product_view"], price=100000.01), ["RANGE:price"]),
    (line(OTHERS["cart_event"], action="ADD"), ["ENUM:action"]),
    (line(OTHERS["cart_event"], action="remove"), []),
]


@pytest.fixture(scope="module")
def outcomes(spark):
    df = spark.createDataFrame([(i, text) for i, (text, _) in enumerate(CASES)], "id int, line string")
    codes = F.transform("errors", lambda e: F.concat_ws(":", e["code"], e["field"]))
    rows = quality.validate(df).select("id", "status", codes.alias("codes"), "errors.message").collect()
    return {r.id: r for r in rows}


@pytest.mark.parametrize("i", range(len(CASES)))
def test_case(outcomes, i):
    text, want = CASES[i]
    got = outcomes[i]
    assert (got.status if got.status == "fatal" else got.codes) == want, text
    assert got.status == ("fatal" if want == "fatal" else "invalid" if want else "valid")


def test_messages(outcomes):
    def messages(text):
        return outcomes[[c[0] for c in CASES].index(text)].message

    assert messages(page(page_type=None)) == [
        "missing or empty field: page_type",
        "invalid value for page_type: 'None' not in "
        "['home', 'category', 'product', 'cart', 'checkout', 'search', 'other']",
    ]
    assert messages(page(**{TIME: "-5"})) == [
        f"wrong type for {TIME}: expected (<class 'int'>, <class 'float'>), got <class 'str'>",
        f"out of range {TIME}: -5.0 not in [0, 86400]",
    ]
    assert messages(page(**{TIME: [1]}))[0].endswith("got <class 'list'>")
    assert messages(page(timestamp="2026")) == ["invalid timestamp format: 2026"]
    assert messages('{"event_type":true}') == ["unknown event_type: True"]


def test_unreadable_bytes_fail_the_file(spark):
    df = spark.range(1).select(F.expr("cast(unhex('FF7B7D') as string)").alias("line"))
    assert quality.validate(df).first().status == "fatal"


def test_filters_do_not_repeat_the_parsing(spark):
    lines = spark.createDataFrame([(page(),)], "line string")
    found = quality.validate(lines).where(quality.is_invalid()).select("errors")
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parseJson") <= 5


ISO_TEXTS = [
    "20260520T100000Z", "2026-05-20T10:00:00,5Z", "2026-W21-3", "2026W213", "2026-W21", "2026-05-20T10", "20260520", "2026-05-20 1000",
    "2026-05-20T10:00:00.123456789", "2026-05-20T10:00+0530", "2026-05-20T10:00:00-05", "2026-W54-1", "2026-W00-1", "2020-W53-7",
    "2026-05-20T24:00", "2026-05-20T10:60", "2026-13-01", "20260230", "2026-05-20T1000:00", "2026-05-20T", "2026-05", "0000-01-01",
    "2026-05-20T10:00:61", "2026-05-20T10:00+24:00", "2026-W21-8",
]


def test_iso_forms_equal_the_standard_parser(spark):
    from datetime import datetime

    def valid(text):
        try:
            datetime.fromisoformat(text.replace("Z", "+00:00"))
            return True
        except ValueError:
            return False

    df = spark.createDataFrame([(t, t.replace("Z", "+00:00")) for t in ISO_TEXTS], "t string, z string")
    z = F.col("z")
    got = df.select("t", (z.rlike(rules.ISO_TEXT) & rules._real_date(z) & rules._real_time(z)).alias("ok")).collect()
    # Midnight as 24:00 is valid in newer parsers only.
    assert {r.t: r.ok for r in got if "24:00" not in r.t} == {t: valid(t) for t in ISO_TEXTS if "24:00" not in t}


def test_number_texts_equal_the_standard_ones(spark):
    numbers = [0.0, -1.0, 90.5, 1e7, 12345678.25, 1e15, 123456789012345.6, 1e16, 1.5e20, 1e100, -2.5e-7, 1e-4, 0.00012, 0.001, 1e-5, 100000.01, 86400.5]
    df = spark.createDataFrame([(n,) for n in numbers], "n double")
    got = {r.n: r.t for r in df.select("n", rules.number_text(F.col("n")).alias("t")).collect()}
    assert got == {n: repr(n) for n in numbers}
    texts = [page(**{TIME: 10000000}), page(**{TIME: "1_000_000"})]
    lines = spark.createDataFrame(list(enumerate(texts)), "i int, line string")
    found = {r.i: r.message for r in quality.validate(lines).select("i", "errors.message").collect()}
    assert found[0] == [f"out of range {TIME}: 10000000.0 not in [0, 86400]"]
    assert f"out of range {TIME}: 1000000.0 not in [0, 86400]" in found[1]
