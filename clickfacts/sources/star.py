"""Adapter from a star schema (events, customer, nation, part, orders, lineitem) to clickstream records.

Every row of the source table becomes records of the raw zone. Blemishes that a real feed shows (padding, mixed
case, missing or unreadable values, repeated deliveries, broken lines) are derived from the row's own id, so the
expected result of every query can be computed from the source tables alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickfacts.sources.raw import raw_partitions

# Which raw event type a source event stands for, and the vocabularies of the records.
KINDS = {
    "view": "page_view",
    "click": "click",
    "signup": "search",
    "purchase": "product_view",
    "error": "cart_event",
}
PAGE_TYPES = ("home", "category", "product", "cart", "checkout", "search", "other")
DEVICES = ("mobile", "desktop", "tablet")
#: Rows of a task that makes or checks lines, at most about.
TASK_ROWS = 20_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fact_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table to derive records from; dealt over ``spark.clickfacts.tasks`` tasks where that is set.

    Tables that are one small file are read by one task otherwise.
    """
    df, tasks = table(spark, sf_dir, name), spark.conf.get("spark.clickfacts.tasks", None)
    return df.repartition(int(tasks)) if tasks else df


def dealt(df: DataFrame, rows: int = TASK_ROWS) -> DataFrame:
    """A table before work that is long for every row: dealt over one task for each ``rows`` rows.

    By size alone, many short rows would be few tasks. A table that ``fact_table`` has dealt stays as it is.
    """
    if df.sparkSession.conf.get("spark.clickfacts.tasks", None):
        return df
    return df.repartition(max(1, -(-df.count() // rows)))


def _pick(values: tuple[str, ...], index: str) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (F.expr(index) + 1).cast("int"))


def _base(events: DataFrame) -> DataFrame:
    return events.select(
        "event_id",
        F.col("ts").cast("timestamp").alias("ts"),
        F.to_date("ts").alias("date"),
        F.expr("concat('SES-', user_id, '-', date_format(ts, 'yyyyMMdd'))").alias("session_id"),
        F.expr("concat('USR-', user_id)").alias("user_id"),
        F.col("event_type").alias("source_type"),
        F.get_json_object("props", "$.k").alias("k"),
        F.expr("cast(value as decimal(18, 2))").alias("value"),
        _pick(DEVICES, "user_id % 3").alias("device"),
        F.expr("concat('N', user_id % 25)").alias("country"),
    )


def raw_page_views(events: DataFrame) -> DataFrame:
    """All events as page views of the raw zone, each delivered twice with a different time."""
    seconds = """
        case when copy = 1 then if(event_id % 2 = 0, '1', null)
             when event_id % 20 = 3 then null
             when event_id % 20 = 5 then 'abc'
             when event_id % 20 = 7 then '-12.5'
             when event_id % 1000 = 11 then '100000'
             else cast(value as string) end"""
    page_type = """
        case when event_id % 50 = 7 then null
             when event_id % 4 = 1 then upper(source_type)
             when event_id % 4 = 2 then concat(' ', source_type, '  ')
             when event_id % 4 = 3 then initcap(source_type)
             else source_type end"""
    copies = _base(events).withColumn("copy", F.explode(F.array(F.lit(0), F.lit(1))))
    return copies.select(
        F.lit("page_view").alias("event_type"),
        F.expr("if(event_id % 40 = 9, null, user_id)").alias("user_id"),
        F.expr("if(event_id % 40 = 19, null, session_id)").alias("session_id"),
        F.concat(F.lit("/"), "source_type", F.lit("/"), "k").alias("page_url"),
        F.expr(page_type).alias("page_type"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("timestamp"),
        F.expr(seconds).alias("time_on_page_seconds"),
        F.lit("direct").alias("referrer"),
        F.expr("if(event_id % 2 = 0, upper(device), concat(' ', device))").alias("device_type"),
        F.expr("if(event_id % 2 = 0, lower(country), concat(country, ' '))").alias("country"),
        "date",
    )


def typed_events(events: DataFrame) -> dict[str, DataFrame]:
    """Well-formed records of all five event types, one per source event."""
    base = _base(events).withColumn("timestamp", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))
    kind = {raw: base.where(F.col("source_type") == source) for source, raw in KINDS.items()}

    def record(name: str, **fields: Column) -> DataFrame:
        common = [F.lit(name).alias("event_type"), "user_id", "session_id"]
        return kind[name].select(*common, *[c.alias(f) for f, c in fields.items()], "timestamp", "date")

    number = F.col("k").cast("bigint")
    return {
        "page_view": record(
            "page_view",
            page_url=F.concat(F.lit("/p/"), "k"),
            page_type=_pick(PAGE_TYPES, "cast(k as bigint) % 7"),
            time_on_page_seconds=F.col("value"),
            referrer=F.lit("direct"),
            device_type=F.col("device"),
            country=F.col("country"),
        ),
        "click": record(
            "click",
            element_id=F.concat(F.lit("el-"), "k"),
            element_type=F.lit("button"),
            page_url=F.concat(F.lit("/p/"), "k"),
            x_position=number,
            y_position=number * 2,
        ),
        "search": record("search", query=F.concat(F.lit("find "), "k"), results_count=number),
        "product_view": record(
            "product_view",
            product_id=F.concat(F.lit("PROD-"), "k"),
            category=F.lit(None).cast("string"),
            price=F.lit(None).cast("double"),
            time_on_page_seconds=F.col("value"),
        ),
        "cart_event": record(
            "cart_event",
            product_id=F.concat(F.lit("PROD-"), "k"),
            action=F.when(number % 4 == 0, "remove").otherwise("add"),
        ),
    }


def users(customer: DataFrame, nation: DataFrame) -> DataFrame:
    """User catalog: one row per customer."""
    return customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.expr("concat('USR-', c_custkey)").alias("user_id"),
        F.col("n_name").alias("country"),
        _pick(DEVICES, "c_custkey % 3").alias("device_type"),
    )


def products(part: DataFrame) -> DataFrame:
    """Product catalog: one row per part."""
    return part.select(
        F.expr("concat('PROD-', p_partkey)").alias("product_id"),
        F.col("p_name").alias("name"),
        F.col("p_type").alias("category"),
        F.col("p_retailprice").alias("price"),
    )


def _order_lines(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    lines = lineitem.join(orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    return lines.withColumn("copy", F.explode(F.array(F.lit(0), F.lit(1))))


def raw_product_views(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    """Every order line as a product view of the session that placed the order, delivered twice."""
    return _order_lines(lineitem, orders).select(
        F.lit("product_view").alias("event_type"),
        F.expr("concat('USR-', o_custkey)").alias("user_id"),
        F.expr("concat('ORD-', l_orderkey)").alias("session_id"),
        F.expr("if((l_orderkey + l_partkey) % 29 = 0, null, concat('PROD-', l_partkey))").alias("product_id"),
        F.expr("concat('cat-', l_returnflag)").alias("category"),
        F.expr("if(l_linenumber = 3, 'n/a', cast(cast(l_extendedprice as decimal(18, 2)) as string))").alias("price"),
        F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("timestamp"),
        F.expr(
            "case when copy = 0 then cast(l_quantity as string) when l_linenumber % 2 = 0 then '0.5' end"
        ).alias("time_on_page_seconds"),
        F.to_date("l_shipdate").alias("date"),
    )


def raw_cart_events(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    """Every order line as a cart event, delivered twice, once without a user."""
    actions = ("add", "ADD", " remove ", "Remove", "purchase")
    return _order_lines(lineitem, orders).select(
        F.lit("cart_event").alias("event_type"),
        F.expr("if(copy = 1, null, concat('USR-', o_custkey))").alias("user_id"),
        F.expr("concat('ORD-', l_orderkey)").alias("session_id"),
        F.expr("concat('PROD-', l_partkey)").alias("product_id"),
        _pick(actions, "l_linenumber % 5").alias("action"),
        F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("timestamp"),
        F.to_date("l_shipdate").alias("date"),
    )


def _text_field(name: str, value: str) -> str:
    return f"""concat('"{name}":"', {value}, '"')"""


def raw_lines(events: DataFrame) -> DataFrame:
    """Every event as a raw JSON line; ``fault = event_id % 24`` says what is wrong with it, if anything.

    Every 997th line is a JSON array, which no consumer can process as an event.
    """
    base = _base(events).withColumn("fault", F.expr("event_id % 24")).withColumn(
        "kind", F.create_map(*[F.lit(x) for pair in KINDS.items() for x in pair])[F.col("source_type")]
    )
    number = """case when fault = 7 then '"90"' when fault in (8, 13) then '-1' when fault = 9 then '"-5"'
                     when fault = 16 then 'true' else cast(cast(value as int) as string) end"""
    enum = """case when fault = 10 then '"{upper}"' when fault = 12 then 'null' when fault = 13 then '"x"'
                   else '"{good}"' end"""
    stamp = """case when fault = 11 then '2026-13-01T00:00:00Z' when fault = 13 then 'zz'
                    when fault = 15 then date_format(ts, 'yyyy-MM-dd')
                    else date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'") end"""

    def only(kind: str, *parts: str) -> str:
        return f"case when kind = '{kind}' then concat_ws(',', {', '.join(parts)}) end"

    fields = [
        """concat('"id":', event_id)""",
        """case when fault = 5 then '"event_type":"purchase"'
                when fault <> 6 then concat('"event_type":"', kind, '"') end""",
        f"case when fault <> 3 then {_text_field('user_id', 'user_id')} end",
        _text_field("session_id", "if(fault = 4, '', session_id)"),
        _text_field("timestamp", stamp),
        only(
            "page_view",
            _text_field("page_url", "concat('/p/', k)"),
            f"concat('\"page_type\":', {enum.format(upper='HOME', good='home')})",
            f"concat('\"time_on_page_seconds\":', {number})",
            _text_field("referrer", "'direct'"),
            _text_field("device_type", "device"),
            f"case when fault <> 13 then {_text_field('country', 'country')} end",
        ),
        only(
            "click",
            _text_field("element_id", "concat('el-', k)"),
            _text_field("element_type", "'button'"),
            _text_field("page_url", "concat('/p/', k)"),
            f"concat('\"x_position\":', {number})",
            "concat('\"y_position\":', k)",
        ),
        only("search", _text_field("query", "concat('find ', k)"), f"concat('\"results_count\":', {number})"),
        only(
            "product_view",
            _text_field("product_id", "concat('PROD-', k)"),
            _text_field("category", "'books'"),
            f"concat('\"price\":', {number})",
            "concat('\"time_on_page_seconds\":', k)",
        ),
        only(
            "cart_event",
            _text_field("product_id", "concat('PROD-', k)"),
            f"concat('\"action\":', {enum.format(upper='ADD', good='add')})",
        ),
        """case when fault = 17 then '"extra":{"a":[1,2]}' when fault = 18 then '"note":"a}b"' end""",
    ]
    whole = F.expr("concat('{', concat_ws(',', " + ", ".join(fields) + "), '}')")
    line = F.expr(
        """case when event_id % 997 = 5 then concat('[', event_id, ']')
                when fault = 1 then substring(whole, 1, cast(length(whole) / 2 as int))
                when fault = 2 then concat(whole, ' x')
                when fault = 14 then concat('  ', whole, '  ')
                else whole end"""
    )
    return base.withColumn("whole", whole).select("event_id", "kind", "ts", "date", "fault", line.alias("line"))


def raw_files(events: DataFrame, day: Column | None = None) -> DataFrame:
    """Lines of the raw zone with their partition columns; every tenth line is followed by a blank one."""
    blank = F.when(F.col("event_id") % 10 == 0, F.array(F.col("line"), F.lit("   "))).otherwise(F.array("line"))
    return raw_lines(events).select(
        F.col("kind").alias("event_type"),
        *raw_partitions(F.col("ts") if day is None else day),
        "event_id",
        F.posexplode(blank).alias("part", "value"),
    )


def clicks(events: DataFrame) -> DataFrame:
    """All events as clicks: day, session, user and time."""
    return _base(events).select("date", "session_id", "user_id", F.col("ts").alias("timestamp"))
