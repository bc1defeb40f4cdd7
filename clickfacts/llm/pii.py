"""Format-preserving pseudonyms: validated personal data is permuted within its own format.

A value is read as a number below the size of its format (the product of the radices of its free places) and goes
through a keyed Feistel network with cycle-walking, a permutation of exactly these numbers. So the pseudonym is valid
where the value was (check digits, octets, calendar days), two different values never meet in one pseudonym, and equal
values stay equal in all documents, whatever their separators. A date keeps one pseudonym in all its written forms.

Kinds, in order of precedence where spans touch: secrets (assignments of hexadecimal values to password, token, key or
secret; access keys), e-mail addresses (local part), IBANs (mod 97), dates with four digits of the year, card numbers
(Luhn), social security numbers (no area, group or serial that is never given), IPv6 and IPv4 addresses, telephone
numbers (with a country or trunk prefix, or grouped in threes and four). Left as they are, since nothing tells them from
other numbers: digits in a row without a prefix or check digit, dates with two digits of the year. A candidate that fails its validation may have taken in a token behind the value (a card's security
code, the currency behind an IBAN): it is tried again with each shorter end at a blank or another mark between its groups,
longest first, and then as the other kinds. What is valid in no way stays as it is.
"""

from __future__ import annotations

import calendar
import hashlib
import ipaddress
import re
from collections.abc import Callable, Iterator
from datetime import date, timedelta
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from clickfacts.llm.common import appended, chunks

ROUNDS = 8
_DIGITS, _HEX, _ALNUM = "0123456789", "0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
_LOWER = "abcdefghijklmnopqrstuvwxyz"
#: Dates are permuted among the days of these years, each among those of its kind.
FIRST_DAY, LAST_DAY = date(1900, 1, 1), date(2099, 12, 31)
KINDS = ("secret", "email", "iban", "card", "ip", "phone", "date", "ssn", "ipv6")


def permute(value: int, size: int, key: bytes) -> int:
    """The image of ``value`` under a keyed permutation of ``range(size)``: balanced Feistel, walked back into range."""
    if size < 2:
        return value
    half = max(1, ((size - 1).bit_length() + 1) // 2)
    mask, width = (1 << half) - 1, (half + 7) // 8
    while True:
        left, right = value >> half, value & mask
        for i in range(ROUNDS):
            seed = bytes([i]) + right.to_bytes(width, "big")
            mixed = hashlib.blake2b(seed, key=key, digest_size=width + 8).digest()
            left, right = right, left ^ (int.from_bytes(mixed, "big") & mask)
        value = left << half | right
        if value < size:
            return value


def _in_alphabets(text: str, alphabets: list[str], key: bytes) -> str:
    """``text`` permuted among all texts whose i-th character is in the i-th alphabet."""
    number, size = 0, 1
    for c, alphabet in zip(text, alphabets, strict=True):
        number = number * len(alphabet) + alphabet.index(c)
        size *= len(alphabet)
    number = permute(number, size, key + str(len(text)).encode())
    out = []
    for alphabet in reversed(alphabets):
        number, place = divmod(number, len(alphabet))
        out.append(alphabet[place])
    return "".join(reversed(out))


def luhn_digit(payload: str) -> str:
    """The digit that completes ``payload`` to a number with a valid Luhn sum."""
    total = 0
    for i, c in enumerate(reversed(payload)):
        d = int(c)
        total += d if i % 2 else d * 2 - 9 * (d > 4)
    return str(-total % 10)


def _like(pattern: str, digits: str) -> str:
    """``pattern`` with its digits replaced in order."""
    fresh = iter(digits)
    return "".join(next(fresh) if c.isdigit() else c for c in pattern)


def _card(found: str, key: bytes) -> str | None:
    digits = re.sub(r"\D", "", found)
    if not 13 <= len(digits) <= 19 or luhn_digit(digits[:-1]) != digits[-1] or len(set(digits)) == 1:
        return None
    # The first digit tells the network and stays.
    payload = digits[0] + _in_alphabets(digits[1:-1], [_DIGITS] * (len(digits) - 2), key)
    return _like(found, payload + luhn_digit(payload))


def _ip(found: str, key: bytes) -> str | None:
    octets = found.split(".")
    if any(len(o) > 3 or int(o) > 255 or (o[0] == "0" and len(o) > 1) for o in octets):
        return None
    number = 0
    for o in octets:
        number = number << 8 | int(o)
    number = permute(number, 1 << 32, key)
    return ".".join(str(number >> s & 255) for s in (24, 16, 8, 0))


def _phone(found: str, key: bytes) -> str | None:
    digits = re.sub(r"\D", "", found)
    country = re.match(r"\+(\d{1,3})(?=\D)", found)
    keep = len(country[1]) if country else 0
    body = digits[keep:]
    if not 7 <= len(body) <= 14 or len(digits) > 15:
        return None
    # A leading zero marks a trunk prefix, with a second one an exit code; other numbers do not begin with one.
    heads = ["0" if c == "0" else "123456789" for c in body[: 2 if body[0] == "0" else 1]]
    return _like(found, digits[:keep] + _in_alphabets(body, heads + [_DIGITS] * (len(body) - len(heads)), key))


def _email(found: str, key: bytes) -> str | None:
    local, _, domain = found.partition("@")
    lower = local.lower()
    free = [(i, _LOWER if c in _LOWER else _DIGITS) for i, c in enumerate(lower) if c in _LOWER or c in _DIGITS]
    if not free or "." not in domain:
        return None
    skeleton = re.sub(r"[0-9]", "9", re.sub(r"[a-z]", "a", lower)) + "@" + domain.lower()
    fresh = _in_alphabets("".join(lower[i] for i, _ in free), [a for _, a in free], hashlib.blake2b(skeleton.encode(), key=key, digest_size=16).digest())
    out = list(local)
    for (i, _), c in zip(free, fresh, strict=True):
        out[i] = c.upper() if local[i].isupper() else c
    return "".join(out) + "@" + domain


def _iban(found: str, key: bytes) -> str | None:
    plain = re.sub(r"\s", "", found).upper()
    value = lambda s: int("".join(str(int(c, 36)) for c in s))
    if not 15 <= len(plain) <= 34 or value(plain[4:] + plain[:4]) % 97 != 1:
        return None
    body = _in_alphabets(plain[4:], [_DIGITS if c in _DIGITS else _ALNUM[:26] for c in plain[4:]], key + plain[:2].encode())
    check = 98 - value(body + plain[:2] + "00") % 97
    fresh = iter(f"{plain[:2]}{check:02d}{body}")
    return "".join(c if c.isspace() else next(fresh) for c in found)


def _secret(found: str, key: bytes) -> str | None:
    head = re.match(r"(?i)(AKIA|ASIA)|[\w-]+\s*[=:]\s*[\"']?", found)
    start, body = head.end(), found[head.end() :].rstrip("\"'")
    tail = found[start + len(body) :]
    if found[:4] in ("AKIA", "ASIA"):
        alphabets = [_ALNUM] * len(body)
    elif re.fullmatch(r"[0-9a-f]+", body):
        alphabets = [_HEX] * len(body)
    elif re.fullmatch(r"[0-9A-F]+", body):
        alphabets = [_HEX.upper()] * len(body)
    else:
        alphabets = [next((a for a in (_DIGITS, _LOWER, _LOWER.upper()) if c in a), c) for c in body]
    return found[:start] + _in_alphabets(body, alphabets, key) + tail


def _kind_of_day(month: int, day: int) -> tuple[bool, int]:
    """What a pseudonym has in common with its date: a month of one digit or not; a day of one digit, to 12 or above.

    So every written form stays readable as what it was: places of one digit stay such places, and a day above 12, which
    tells day and month apart, stays above 12.
    """
    return month > 9, (day > 9) + (day > 12)


@lru_cache(maxsize=1)
def _days() -> tuple[dict[tuple[bool, int], list[date]], dict[date, int]]:
    """The days of each kind in order, and the place of every day among those of its kind."""
    kinds: dict[tuple[bool, int], list[date]] = {}
    places = {}
    for i in range((LAST_DAY - FIRST_DAY).days + 1):
        day = FIRST_DAY + timedelta(i)
        own = kinds.setdefault(_kind_of_day(day.month, day.day), [])
        places[day] = len(own)
        own.append(day)
    return kinds, places


def _date(found: str, key: bytes) -> str | None:
    places = re.split(r"[-/.]", found)
    mark = found[len(places[0])]
    if len(places[0]) == 4:
        order = "ymd"
    else:
        # Slashes put the month first and other marks the day, unless the number there can only be the other one.
        swapped = int(places[0]) > 12 if mark == "/" else int(places[1]) > 12
        order = "mdy" if (mark == "/") != swapped else "dmy"
    year, month, day = (int(places[order.index(c)]) for c in "ymd")
    if not (FIRST_DAY.year <= year <= LAST_DAY.year and 1 <= month <= 12 and 1 <= day <= calendar.monthrange(year, month)[1]):
        return None
    kinds, numbers = _days()
    kind = _kind_of_day(month, day)
    own = kinds[kind]
    # One permutation for all written forms: a date keeps its pseudonym in each.
    new = own[permute(numbers[date(year, month, day)], len(own), key + bytes([kind[0], kind[1]]))]
    fresh = {"y": new.year, "m": new.month, "d": new.day}
    return mark.join(f"{fresh[c]:0{len(place)}d}" for c, place in zip(order, places, strict=True))


def _ssn(found: str, key: bytes) -> str | None:
    area, group, serial = (int(x) for x in found.split("-"))
    if area in (0, 666) or area > 899 or group == 0 or serial == 0:
        return None
    number = ((area - 1 - (area > 666)) * 99 + group - 1) * 9999 + serial - 1
    rest, serial = divmod(permute(number, 898 * 99 * 9999, key), 9999)
    area, group = divmod(rest, 99)
    return f"{area + 1 + (area >= 665):03d}-{group + 1:02d}-{serial + 1:04d}"


def _ipv6(found: str, key: bytes) -> str | None:
    try:
        address = ipaddress.IPv6Address(found)
    except ValueError:
        return None
    # All written forms of an address get one pseudonym, in the shortest form. The first group tells the scope and stays.
    scope, rest = divmod(int(address), 1 << 112)
    return str(ipaddress.IPv6Address(scope << 112 | permute(rest, 1 << 112, key + scope.to_bytes(2, "big"))))


_MAKERS: dict[str, Callable[[str, bytes], str | None]] = dict(
    zip(KINDS, (_secret, _email, _iban, _card, _ip, _phone, _date, _ssn, _ipv6), strict=True)
)
_FORMS = {
    "secret": r"""(?<![A-Za-z0-9])(?:AKIA|ASIA)[A-Z0-9]{16}(?![A-Za-z0-9])
        |(?i:\b(?:password|passwd|pwd|token|secret|api[_-]?key|access[_-]?key|auth)["']?\s*[=:]\s*["']?(?=[\w+/.-]*\d)[\w+/.-]{7,}[\w+/]["']?)""",
    "email": r"(?<![\w.%+-])[A-Za-z0-9][A-Za-z0-9._%+-]*@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?:\ ?[A-Z0-9]{4}){2,7}(?:\ ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "date": r"""(?<![\d.,/-])(?:\d{4}(?P<iso>[-/.])\d{2}(?P=iso)\d{2}
        |\d{1,2}(?P<mark>[-/.])\d{1,2}(?P=mark)\d{4})(?![\d/-]|[.]\d)""",
    "card": r"(?<![\w+-])\d(?:[ -]?\d){12,18}(?![\w-])",
    "ssn": r"(?<![\w.+-])\d{3}-\d{2}-\d{4}(?![\w-])",
    "ipv6": r"(?<![\w:.])(?=[0-9A-Fa-f]{0,3}\d)[0-9A-Fa-f]{3,4}(?::[0-9A-Fa-f]{0,4}){2,7}(?![\w:])",
    "ip": r"(?<![\w.])\d{1,3}(?:\.\d{1,3}){3}(?![\w]|\.\d)",
    "phone": r"""(?<![\w.])(?:\+\d{1,3}[ .-]?)(?:\(\d{1,4}\)[ .-]?)?\d{2,4}(?:[ .-]?\d{2,4}){1,4}(?![\w-])
        |(?<![\w.])\(\d{3}\)[ .-]?\d{3}[ .-]?\d{4}(?![\w-])
        |(?<![\w.-])\d{3}[.-]\d{3}[.-]\d{4}(?![\w.-])
        |(?<![\w.,+/-])0[1-9]\d{1,3}[ /-]\d{5,8}(?![\w-]|[.,]\d)""",
}
_PATTERN = re.compile("|".join(f"(?P<{kind}>{form})" for kind, form in _FORMS.items()), re.VERBOSE)
_PATTERNS = {kind: re.compile(form, re.VERBOSE) for kind, form in _FORMS.items()}
#: What a value of a kind may be grouped by: a candidate may have taken in the next token behind one of these.
_MARKS = {"iban": re.compile(" "), "card": re.compile(r"[ -]"), "phone": re.compile(r"[ .-]")}
_WORTH_A_LOOK = re.compile(r"[0-9@]")


class Pseudonyms:
    """The permutations under one key; each kind of data has a key of its own."""

    def __init__(self, key: str):
        self._keys = {k: hashlib.blake2b(k.encode(), key=key.encode()[:64], digest_size=16).digest() for k in KINDS}
        self._known = lru_cache(maxsize=50_000)(lambda kind, found: _MAKERS[kind](found, self._keys[kind]))

    def _longest(self, kind: str, text: str, begin: int) -> tuple[int, str | None]:
        """End and pseudonym of the longest valid value of a kind that begins here; it may end at any of its marks."""
        found = _PATTERNS[kind].match(text, begin)
        if not found:
            return begin, None
        ends = [m.start() for m in _MARKS[kind].finditer(text, begin + 1, found.end())] if kind in _MARKS else []
        for end in (found.end(), *reversed(ends)):
            if end == found.end() or _PATTERNS[kind].fullmatch(text, begin, end):
                fresh = self._known(kind, text[begin:end])
                if fresh is not None:
                    return end, fresh
        return begin, None

    def _other(self, text: str, begin: int) -> tuple[str, int, str | None]:
        """Kind, end and pseudonym of what begins where the first candidate is not valid.

        A shorter value yields to a longer one of its kind that begins at one of its tokens: numbers before a card
        and the card's first groups may be valid by chance.
        """
        for kind in _FORMS:
            end, fresh = self._longest(kind, text, begin)
            if fresh is None:
                continue
            marks = _MARKS[kind].finditer(text, begin + 1, end) if kind in _MARKS else ()
            size = lambda a, b: sum(c.isalnum() for c in text[a:b])
            if all(size(m.end(), self._longest(kind, text, m.end())[0]) <= size(begin, end) for m in marks):
                return kind, end, fresh
        return "", begin, None

    def replace(self, text: str) -> tuple[str, list[tuple[str, int, int]]]:
        """The text with pseudonyms, and kind, begin and end of each in the new text, in characters."""
        if not _WORTH_A_LOOK.search(text):
            return text, []
        pieces, spans, last, length, at = [], [], 0, 0, 0
        while found := _PATTERN.search(text, at):
            begin, kind, end = found.start(), found.lastgroup, found.end()
            fresh = self._known(kind, found[0])
            if fresh is None:
                kind, end, fresh = self._other(text, begin)
            if fresh is None:
                # Not valid in any way: a later candidate may begin behind its first character.
                at = begin + 1
                continue
            pieces += [text[last:begin], fresh]
            length += begin - last
            spans.append((kind, length, length + len(fresh)))
            length += len(fresh)
            at = last = end
        return "".join([*pieces, text[last:]]), spans


SPANS = T.StructField(
    "pii_spans",
    T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("begin", T.IntegerType()), T.StructField("end", T.IntegerType())])),
)
_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("begin", pa.int32()), ("end", pa.int32())]))


def pseudonymise(df: DataFrame, key: str, text: str = "text", spans: bool = True) -> DataFrame:
    """``df`` with personal data in ``text`` replaced, and with ``spans`` also ``pii_spans`` of the replacements.

    A null text stays null and an empty one empty, both without spans. An existing column ``pii_spans`` is replaced.
    """
    fields = [f for f in df.schema.fields if not (spans and f.name == "pii_spans")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = Pseudonyms(key)
        for part, texts in chunks(batches, text):
            done = [names.replace(t) for t in texts]
            nulls = part.column(part.schema.get_field_index(text)).is_null().to_pylist()
            fresh = [None if null else t for null, (t, _) in zip(nulls, done, strict=True)]
            kind = part.schema.field(text).type
            new = {text: pa.array(fresh, kind)}
            if spans:
                new["pii_spans"] = pa.array([[{"kind": k, "begin": b, "end": e} for k, b, e in s] for _, s in done], _SPANS)
            made = appended(part, new)
            yield made.select([f.name for f in fields] + ["pii_spans"] * spans)

    return df.mapInArrow(run, T.StructType([*fields, *([SPANS] if spans else [])]))
