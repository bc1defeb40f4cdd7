"""Compiles the event contract into Column expressions over a parsed JSON value.

Rules that several event types share become one check guarded by the event type, so one row evaluates each
field once whatever its type, and the rule table needs no join.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import lru_cache
from graphlib import TopologicalSorter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickfacts import schemas

ERRORS_TYPE = "array<struct<code:string,field:string,message:string>>"

# Fixed value: how the expected type is written in a type error.
NUMBER_SHOWN = "(<class 'int'>, <class 'float'>)"
# Text that converts to a float the way a JSON consumer would convert it.
# Single underscores between digits separate groups of them.
_DIGITS = r"\d(_?\d)*"
FLOAT_TEXT = rf"(?i)^\s*[+-]?({_DIGITS}\.?({_DIGITS})?(e[+-]?{_DIGITS})?|\.{_DIGITS}(e[+-]?{_DIGITS})?|inf(inity)?|nan)\s*$"
# ISO 8601 in extended and basic form: a calendar or week date, optional time with a point or comma before the
# fraction, optional zone.
ISO_TEXT = (
    r"^(\d{4}-\d{2}-\d{2}|\d{8}|\d{4}-?W\d{2}(-?[1-7])?)"
    r"([T ]\d{2}(:?\d{2}(:?\d{2}([.,]\d+)?)?)?([+-]\d{2}(:?\d{2}(:?\d{2})?)?)?)?$"
)


# Fixed value: the words for numbers that are not finite; the field parser shows such a number in quotes.
NON_FINITE = ("NaN", "Infinity", "-Infinity")
_BARE = r"(?<![^:,\[\s])(NaN|-?Infinity)(?![^,\]}\s])"

VALUE = "_value"
KIND = "_kind"
_FIELDS = "_fields"
_ARRAY = "_array"


def with_value(df: DataFrame, line: str) -> DataFrame:
    """Adds the line parsed as exactly one JSON value (NULL when it is not one), its fields as text, and the event type.

    Text fields come from one pass over the line; the value keeps the JSON types and is asked only where they matter.

    The parser stops after the first value, so trailing text must be ruled out. An object whose first ``}`` is the
    last character of the line cannot be followed by anything. Other lines are parsed inside an array and inside an
    object instead: text after the value breaks at least one of the two wrappings, and a second array element shows
    a bare comma.

    Numbers that are not finite are no JSON for the parser. In lines that name one they stand as ``null`` while the line
    is parsed; their text, which only they have beside a ``null`` type, says what they are.
    """
    given = F.col(line)
    named = F.contains(given, F.lit("NaN")) | F.contains(given, F.lit("Infinity"))
    text = F.when(named, F.regexp_replace(given, _BARE, "null")).otherwise(given)
    flat = F.startswith(text, F.lit("{")) & (F.instr(text, "}") == F.length(text))
    in_array = F.try_parse_json(F.concat(F.lit("["), text, F.lit("]")))
    in_object = F.try_parse_json(F.concat(F.lit('{"v":'), text, F.lit("}")))
    alone = in_object.isNotNull() & F.try_variant_get(F.col(_ARRAY), "$[1]", "variant").isNull()
    value = F.when(flat, F.try_parse_json(text)).when(alone, F.try_variant_get(F.col(_ARRAY), "$[0]", "variant"))
    names = merged_order(schemas.REQUIRED_FIELDS.values())
    fields = F.from_json(given, T.StructType([T.StructField(n, T.StringType()) for n in names]))
    kind = F.when(
        F.col(VALUE).isNotNull() & F.startswith(text, F.lit("{")) & _text("event_type").isin(*schemas.EVENT_TYPES),
        _text("event_type"),
    )
    valued = df.withColumn(_ARRAY, F.when(~flat, in_array)).withColumn(VALUE, value).drop(_ARRAY)
    return valued.withColumn(_FIELDS, fields).withColumn(KIND, kind)


def _text(name: str) -> Column:
    """Field as text: NULL when absent or JSON null."""
    return F.col(f"{_FIELDS}.{name}")


def _type(name: str) -> Column:
    """JSON type name of a field, NULL when absent. Dearer than ``_text``; only evaluated for doubtful values."""
    return F.expr(f"schema_of_variant(try_variant_get({VALUE}, '$.{name}', 'variant'))")


def merged_order(orders: Iterable[Iterable[str]]) -> list[str]:
    """One field order that agrees with the order inside every event type."""
    graph: dict[str, set[str]] = {}
    for names in orders:
        before: str | None = None
        for name in names:
            graph.setdefault(name, set()).update({before} if before else ())
            before = name
    return list(TopologicalSorter(graph).static_order())


def by_field(table: Mapping[str, Mapping[str, object]]) -> dict[str, dict[object, list[str]]]:
    """``{event_type: {field: rule}}`` regrouped to ``{field: {rule: [event types]}}`` in merged order."""
    grouped: dict[str, dict[object, list[str]]] = {}
    for name in merged_order(table.values()):
        for kind, rules in table.items():
            if name in rules:
                grouped.setdefault(name, {}).setdefault(rules[name], []).append(kind)
    return grouped


def _is(name: str, *kinds: str) -> Column:
    """The field exists and its JSON type is one of ``kinds`` (STRING, ARRAY, OBJECT, ...)."""
    kind = f"schema_of_variant(try_variant_get({VALUE}, '$.{name}', 'variant'))"
    return F.expr(f"coalesce({kind} RLIKE '^({'|'.join(kinds)})', false)")


def _kind_in(kinds: Iterable[str]) -> Column:
    return F.expr(f"{KIND} IN ({', '.join(repr(k) for k in kinds)})")


def _non_finite(name: str) -> Column:
    """Whether the field is a bare NaN or infinity."""
    quoted = [f'"{n}"' for n in NON_FINITE]
    return F.coalesce(_text(name).isin(*quoted), F.lit(False)) & ~_is(name, "STRING")


def _number(name: str) -> Column:
    """Float value the way a dynamic consumer converts it: numbers, booleans and numeric text."""
    grouped = F.replace(_text(name), F.lit("_"), F.lit(""))
    grouped = F.when(_non_finite(name), F.replace(grouped, F.lit('"'), F.lit(""))).otherwise(grouped)
    return F.coalesce(F.expr(f"try_variant_get({VALUE}, '$.{name}', 'double')"), grouped.try_cast("double"))


def number_text(number: Column) -> Column:
    """A double as a dynamic consumer prints it: digits up to sixteen places before the point, else an exponent."""
    size, text = F.abs(number), number.cast("string")
    plain = F.regexp_replace(text.try_cast("decimal(38,21)").cast("string"), r"0+$", "")
    plain = F.when(F.endswith(plain, F.lit(".")), F.concat(plain, F.lit("0"))).otherwise(plain)
    mantissa = F.regexp_replace(F.split(text, "E")[0], r"\.0$", "")
    exponent = F.try_element_at(F.split(text, "E"), F.lit(2)).try_cast("int")
    power = F.concat(F.when(exponent < 0, "e-").otherwise("e+"), F.lpad(F.abs(exponent).cast("string"), 2, "0"))
    power = F.when(F.abs(exponent) > 99, F.concat(F.when(exponent < 0, "e-").otherwise("e+"), F.abs(exponent).cast("string"))).otherwise(power)
    return (
        F.when((size >= 1e-4) & (size < 1e16) & ~((size >= 1e-3) & (size < 1e7)), plain)
        .when(exponent.isNotNull(), F.concat(mantissa, power))
        .when(size == float("inf"), F.when(number > 0, "inf").otherwise("-inf"))
        .when(F.isnan(number), "nan")
        .otherwise(text)
    )


def _shown(name: str) -> Column:
    """Value as it appears in an error text."""
    kind, text = _type(name), _text(name)
    return F.when(_non_finite(name), number_text(_number(name))).when(kind == "VOID", "None").when(kind == "BOOLEAN", F.initcap(text)).otherwise(F.coalesce(text, kind))


def _type_shown(name: str) -> Column:
    return F.when(_is(name, "STRING"), "str").when(_is(name, "ARRAY"), "list").otherwise("dict")


def _error(when: Column, code: str, name: str | None, *message: Column | str) -> Column:
    """One-element error array where the condition holds, else an empty one."""
    text = message[0] if len(message) == 1 else F.concat(*[m if isinstance(m, Column) else F.lit(m) for m in message])
    text = text if isinstance(text, Column) else F.lit(text)
    field = F.expr(f"cast({'null' if name is None else repr(name)} as string)")
    entry = F.struct(F.lit(code).alias("code"), field.alias("field"), text.alias("message"))
    return F.when(when, F.array(entry)).otherwise(F.array())


def required_checks() -> list[Column]:
    grouped = by_field({k: dict.fromkeys(names, True) for k, names in schemas.REQUIRED_FIELDS.items()})
    checks = []
    for name, rules in grouped.items():
        blank = F.coalesce(_text(name), F.lit("")) == ""
        checks.append(_error(_kind_in(rules[True]) & blank, "REQUIRED", name, f"missing or empty field: {name}"))
    return checks


def type_checks() -> list[Column]:
    checks = []
    for name, rules in by_field(schemas.NUMERIC_BOUNDS).items():
        kinds = [k for group in rules.values() for k in group]
        wrong = _is(name, "STRING", "ARRAY", "OBJECT")
        checks.append(
            _error(
                _kind_in(kinds) & wrong, "TYPE", name, f"wrong type for {name}: expected {NUMBER_SHOWN}, got <class '",
                _type_shown(name), "'>",
            )
        )
    return checks


def range_checks() -> list[Column]:
    checks = []
    for name, rules in by_field(schemas.NUMERIC_BOUNDS).items():
        number = _number(name)
        readable = ~_is(name, "STRING") | _text(name).rlike(FLOAT_TEXT)
        for (low, high), kinds in rules.items():
            outside = F.coalesce(~number.between(low, high), F.lit(False)) & readable
            checks.append(
                _error(
                    _kind_in(kinds) & outside, "RANGE", name,
                    f"out of range {name}: ", number_text(number), f" not in [{low}, {high}]",
                )
            )
    return checks


def enum_checks() -> list[Column]:
    checks = []
    for name, rules in by_field(schemas.ALLOWED_VALUES).items():
        for allowed, kinds in rules.items():
            # No allowed word reads like a JSON number or boolean, so equal text means an equal string.
            listed = F.coalesce(_text(name).isin(*allowed), F.lit(False))
            shown = ", ".join(f"'{a}'" for a in allowed)
            checks.append(
                _error(
                    _kind_in(kinds) & ~listed & _type(name).isNotNull(), "ENUM", name,
                    f"invalid value for {name}: '", _shown(name), f"' not in [{shown}]",
                )
            )
    return checks


def _real_date(iso: Column) -> Column:
    """Whether the date part of an ISO text is a day: of its month, or of a week its year has."""
    digits = F.regexp_replace(F.regexp_extract(iso, r"^(\d{4}-\d{2}-\d{2}|\d{8})", 1), "-", "")
    week = r"^(\d{4})-?W(\d{2})"
    year, number = (F.regexp_extract(iso, week, i).try_cast("int") for i in (1, 2))
    # The 28th of December is in the last week of its year.
    weeks = F.weekofyear(F.try_to_date(F.concat(F.regexp_extract(iso, week, 1), F.lit("1228")), "yyyyMMdd"))
    by_week = (year > 0) & (number >= 1) & (number <= weeks)
    by_day = F.try_to_date(digits, "yyyyMMdd").isNotNull() & ~F.startswith(digits, F.lit("0000"))
    return F.when(iso.rlike(week), F.coalesce(by_week, F.lit(False))).otherwise(by_day)


def _real_time(iso: Column) -> Column:
    """Whether the time and zone of an ISO text, where given, are on the clock and of one form."""
    time = F.regexp_extract(iso, r"[T ](\d.*)$", 1)
    clock = F.regexp_extract(time, r"^([^+-]*)", 1)
    zone = F.regexp_extract(time, r"([+-].*)$", 1)

    def below(text: Column, pattern: str, end: int) -> Column:
        return F.coalesce(F.nullif(F.regexp_extract(text, pattern, 1), F.lit("")).try_cast("int") < end, F.lit(True))

    one_form = clock.rlike(r"^(\d{2}|\d{2}:\d{2}|\d{4}|\d{2}:\d{2}:\d{2}([.,]\d+)?|\d{6}([.,]\d+)?)?$")
    return (
        one_form
        & below(clock, r"^(\d{2})", 24)
        & below(clock, r"^\d{2}:?(\d{2})", 60)
        & below(clock, r"^\d{2}:?\d{2}:?(\d{2})", 60)
        & below(zone, r"^[+-](\d{2})", 24)
        & below(zone, r"^[+-]\d{2}:?(\d{2})", 60)
    )


def timestamp_checks() -> list[Column]:
    text = _text("timestamp")
    zoned = F.replace(text, F.lit("Z"), F.lit("+00:00"))
    iso = zoned.rlike(ISO_TEXT) & _real_date(zoned) & _real_time(zoned)
    bad = ~F.coalesce(iso, F.lit(False)) & F.coalesce(text != "", F.lit(False)) & _is("timestamp", "STRING")
    return [_error(bad, "TIMESTAMP", "timestamp", "invalid timestamp format: ", text)]


def truthy(name: str) -> Column:
    """Dynamic-language truth of a field: absent, null, "", 0, false, [] and {} are false."""
    kind, text = _type(name), _text(name)
    return (
        F.when(_non_finite(name), F.lit(True))
        .when(kind.isNull() | (kind == "VOID"), F.lit(False))
        .when(kind == "STRING", text != "")
        .when(kind == "BOOLEAN", text == "true")
        .when(_is(name, "ARRAY"), F.try_variant_get(F.col(VALUE), f"$.{name}[0]", "variant").isNotNull())
        .when(_is(name, "OBJECT"), kind != "OBJECT<>")
        .otherwise(F.coalesce(_number(name) != 0, F.lit(True)))
    )


def record_errors() -> Column:
    """All errors of a record in reporting order: required, types, ranges, enums, timestamp."""
    checks = required_checks() + type_checks() + range_checks() + enum_checks() + timestamp_checks()
    return (
        F.when(F.col(KIND).isNotNull(), F.concat(*checks))
        .when(F.col(VALUE).isNull(), _error(F.lit(True), "INVALID_JSON", None, "invalid JSON"))
        .when(
            ~truthy("event_type"),
            _error(F.lit(True), "MISSING_EVENT_TYPE", "event_type", "missing field: event_type"),
        )
        .otherwise(
            _error(F.lit(True), "UNKNOWN_EVENT_TYPE", "event_type", "unknown event_type: ", _shown("event_type"))
        )
    )


def record_fatal() -> Column:
    """True for a record that makes its whole file fail instead of being reported.

    That is a root that is no object, an event type that is a non-empty list or object, and a non-text timestamp on
    a record that gets as far as the timestamp check.
    """
    root = F.schema_of_variant(F.col(VALUE))
    return (
        F.when(F.col(VALUE).isNull(), F.lit(False))
        .when(
            F.col(KIND).isNotNull(),
            ~_is("timestamp", "STRING") & _type("timestamp").isNotNull() & truthy("timestamp"),
        )
        .otherwise(
            ~F.startswith(root, F.lit("OBJECT")) | (_is("event_type", "ARRAY", "OBJECT") & truthy("event_type"))
        )
    )


@lru_cache(maxsize=2)
def compiled(application_id: str) -> tuple[Column, Column]:
    """``record_errors`` and ``record_fatal`` of an application, built once: many small expressions are slow to build.

    They name columns without binding them, so every frame and micro-batch can use the same ones.
    """
    return record_errors(), record_fatal()
