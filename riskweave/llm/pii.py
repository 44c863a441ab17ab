"""Pseudonyms for personal numbers and dates that keep their format.

Values are found by pattern, validated (check digits, ranges, calendar), and permuted by a keyed
Feistel network within the set of valid values of their kind; a result outside that set is permuted
again until it is inside.  The permutation depends on the digits alone, not on separators or on the
document, so equal values stay equal everywhere and different values stay different.
"""

from __future__ import annotations

import datetime
import hashlib
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import LongType, MapType, StringType, StructField, StructType

from .common import slices

ROUNDS = 8


def feistel(value: int, size: int, key: bytes, tweak: str) -> int:
    """A keyed permutation of 0 .. size-1: an alternating Feistel network over two halves a * b
    that just hold ``size`` values, walked on until the value is below ``size``."""
    if size < 2:
        return value
    b = int(size**0.5)
    while b * b < size:
        b += 1
    while b > 1 and (b - 1) * (b - 1) >= size:
        b -= 1
    a = -(-size // b)
    while True:
        left, right = divmod(value, b)
        for r in range(ROUNDS):
            if r % 2 == 0:
                left = (left + _round(key, tweak, r, right)) % a
            else:
                right = (right + _round(key, tweak, r, left)) % b
        value = left * b + right
        if value < size:
            return value


def _round(key: bytes, tweak: str, r: int, half: int) -> int:
    found = hashlib.blake2b(f"{tweak}|{r}|{half}".encode(), key=key, digest_size=16)
    return int.from_bytes(found.digest(), "little")


def walk(value: int, size: int, key: bytes, tweak: str, valid: Callable[[int], bool]) -> int:
    """``feistel`` repeated until the result is valid; a permutation of the valid values."""
    value = feistel(value, size, key, tweak)
    while not valid(value):
        value = feistel(value, size, key, tweak)
    return value


def luhn_sum(digits: str) -> int:
    twice = [sum(divmod(2 * int(d), 10)) for d in digits[-2::-2]]
    return sum(map(int, digits[-1::-2])) + sum(twice)


def _refill(shape: str, new: str, kinds: str = "0-9") -> str:
    """``shape`` with its characters of these kinds replaced one by one by those of ``new``."""
    fresh = iter(new)
    return re.sub(f"[{kinds}]", lambda _: next(fresh), shape)


def _digits(text: str) -> str:
    return re.sub(r"[^0-9]", "", text)


def card(text: str, key: bytes) -> str | None:
    """13 to 19 digits with a right check digit; the first digit stays, the check digit is renewed."""
    digits = _digits(text)
    if not 13 <= len(digits) <= 19 or luhn_sum(digits) % 10 or len(set(digits)) == 1:
        return None
    n = len(digits) - 2
    body = digits[0] + f"{feistel(int(digits[1:-1]), 10**n, key, f'card{digits[0]}{n}'):0{n}d}"
    return _refill(text, body + str(-luhn_sum(body + "0") % 10))


# fixed values: international calling codes of one and two digits; all others have three
SHORT_CODES = {
    "1", "7", "20", "27", "30", "31", "32", "33", "34", "36", "39", "40", "41", "43", "44", "45", "46", "47", "48", "49",
    "51", "52", "53", "54", "55", "56", "57", "58", "60", "61", "62", "63", "64", "65", "66",
    "81", "82", "84", "86", "90", "91", "92", "93", "94", "95", "98",
}


def phone(text: str, key: bytes) -> str | None:
    """A country code (kept) and 6 to 12 more digits, 7 without a code; the pseudonym depends on the
    digits alone, not on what separates them."""
    digits, code = _digits(text), ""
    if text.startswith("+"):
        code = next((digits[:n] for n in (1, 2) if digits[:n] in SHORT_CODES), digits[:3])
    n = len(digits) - len(code)
    if not (6 if code else 7) <= n <= 12:
        return None
    return _refill(text, f"{code}{feistel(int(digits[len(code):]), 10**n, key, f'phone{code}{n}'):0{n}d}")


def social(text: str, key: bytes) -> str | None:
    """Area, group and serial number, each in its valid range."""
    def valid(value: int) -> bool:
        area, group, serial = value // 10**6, value // 10**4 % 100, value % 10**4
        return 0 < area < 900 and area != 666 and group > 0 and serial > 0

    value = int(_digits(text))
    return _refill(text, f"{walk(value, 10**9, key, 'social', valid):09d}") if valid(value) else None


def address(text: str, key: bytes) -> str | None:
    """An IPv4 address: four numbers up to 255 without leading zeros."""
    parts = text.split(".")
    if any(int(p) > 255 or str(int(p)) != p for p in parts):
        return None
    value = feistel(int.from_bytes(bytes(map(int, parts)), "big"), 1 << 32, key, "ipv4")
    return ".".join(map(str, value.to_bytes(4, "big")))


def account(text: str, key: bytes) -> str | None:
    """An IBAN with right check digits; country and letters stay, check digits are renewed."""
    plain = re.sub(r"[ -]", "", text).upper()

    def remainder(country: str, check: str, rest: str) -> int:
        return int("".join(str(int(c, 36)) for c in rest + country + check)) % 97

    country, check, rest = plain[:2], plain[2:4], plain[4:]
    if not 15 <= len(plain) <= 34 or remainder(country, check, rest) != 1:
        return None
    n = len(digits := _digits(rest))
    shape = re.sub(r"\d", "#", rest)
    rest = _refill(rest, f"{feistel(int(digits or 0), 10**n, key, f'iban{country}{shape}'):0{n}d}" if n else "")
    new = iter(f"{98 - remainder(country, '00', rest):02d}" + _digits(rest))
    return re.sub(r"\d", lambda _: next(new), text)


_FIRST = datetime.date(1900, 1, 1).toordinal()
_DAYS = datetime.date(2099, 12, 31).toordinal() - _FIRST + 1


def date(text: str, key: bytes) -> str | None:
    """A calendar date from 1900 to 2099, year first, or day or month first; one date written in
    several ways gets one pseudonym.  With slashes the month comes first where that is a date."""
    parts = re.split(r"([^0-9]+)", text)
    fields = parts[::2]
    if len(fields) != 3 or parts[1] != parts[3]:
        return None
    orders = [(0, 1, 2)] if len(fields[0]) == 4 else [(2, 0, 1), (2, 1, 0)] if "/" in text else [(2, 1, 0)]
    for y, m, d in orders:
        try:
            day = datetime.date(int(fields[y]), int(fields[m]), int(fields[d])).toordinal() - _FIRST
        except ValueError:
            continue
        if not 0 <= day < _DAYS:
            continue
        new = datetime.date.fromordinal(feistel(day, _DAYS, key, "date") + _FIRST)
        for place, value in ((y, f"{new.year:04d}"), (m, f"{new.month:02d}"), (d, f"{new.day:02d}")):
            fields[place] = value
        return parts[1].join(fields)
    return None


def email(text: str, key: bytes) -> str | None:
    """The part before @: digits and letters are permuted within their kind, the domain stays."""
    local, domain = text.rsplit("@", 1)
    shape = re.sub(r"[a-z]", "a", re.sub(r"[A-Z]", "A", re.sub(r"\d", "0", local)))
    value, size = 0, 1
    for c, s in zip(local, shape):
        if s in "0aA":
            base = 10 if s == "0" else 26
            value, size = value * base + ord(c) - ord(s), size * base
    value, out = feistel(value, size, key, "email" + shape), []
    for s in reversed(shape):
        if s in "0aA":
            value, digit = divmod(value, 10 if s == "0" else 26)
            s = chr(ord(s) + digit)
        out.append(s)
    return "".join(reversed(out)) + "@" + domain


def secret(text: str, key: bytes) -> str | None:
    """A hexadecimal key of 32, 40 or 64 characters with digits and letters."""
    if text.isdigit() or text.isalpha() or text not in (text.lower(), text.upper()):
        return None
    n = len(text)
    new = f"{feistel(int(text, 16), 16**n, key, f'hex{n}'):0{n}x}"
    return new if text == text.lower() else new.upper()


#: Kinds in the order in which they are tried at a place.
KINDS: list[tuple[str, str, Callable[[str, bytes], str | None]]] = [
    ("email", r"(?<![\w.%+-])[\w.%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}", email),
    ("secret", r"(?<![0-9A-Za-z])(?:[0-9A-Fa-f]{64}|[0-9A-Fa-f]{40}|[0-9A-Fa-f]{32})(?![0-9A-Za-z])", secret),
    ("account", r"(?<![0-9A-Za-z])[A-Z]{2}\d{2}(?: ?[0-9A-Z]{4}){2,7}(?: ?[0-9A-Z]{1,3})?(?![0-9A-Za-z])", account),
    ("card", r"(?<![\w.+])\d(?:[ -]?\d){12,18}(?!\w)", card),
    ("address", r"(?<![\w.])\d{1,3}(?:\.\d{1,3}){3}(?!\w|\.\d)", address),
    ("social", r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])", social),
    ("date", r"(?<![\w./-])(?:\d{4}([-./])\d{1,2}\1\d{1,2}|\d{1,2}([-./])\d{1,2}\2\d{4})(?:(?=T\d\d:)|(?![\w/-]|\.\d))", date),
    ("phone", r"(?<![\w+])(?:\+\d{1,3}[ .-]?\(\d{1,4}\)[ .-]?\d{3}[ .-]?\d{4}|\+\d{1,3}(?:[ .-]\d{2,5})?[ .-]\d{6,9}(?!\d)|\+\d{1,3}(?:[ .-]\d{2,4}){2,4}|\+\d{8,15}"
              r"|\(\d{3}\) ?\d{3}[ .-]\d{4}|\d{3}[.-]\d{3}[.-]\d{4})(?!\w)", phone),
]


def _pattern() -> re.Pattern:
    parts = []
    for name, pattern, _ in KINDS:
        pattern = pattern.replace(r"([-./])", f"(?P<{name}1>[-./])", 1).replace(r"\1", f"(?P={name}1)")
        pattern = pattern.replace(r"([-./])", f"(?P<{name}2>[-./])", 1).replace(r"\2", f"(?P={name}2)")
        parts.append(f"(?P<{name}>{pattern})")
    return re.compile("|".join(parts))


_FIND = _pattern()
_SINGLE = {name: re.compile(pattern) for name, pattern, _ in KINDS}
_MAKE = {name: make for name, _, make in KINDS}
#: Every kind has a digit or an @ in it; text is searched from the start of a word that holds one.
_NEAR = re.compile(r"[0-9@]")
_SPACE = re.compile(r"\s")
#: A value ends within the word that lies so far behind its first digit or @.
REACH = 96


#: The ways in which the digits of a card are put into groups.
_GROUPED = re.compile(r"\d{13,19}|\d{4}[ -]\d{6}[ -]\d{4,5}|\d{4}(?:[ -]\d{4}){2}[ -]\d{1,4}(?:[ -]\d{1,3})?")


def _readings(kind: str, text: str) -> Iterator[str]:
    """``text`` and, for cards, what is left when groups of digits behind it belong to something else."""
    yield text
    if kind == "card":
        for end in range(len(text) - 1, 12, -1):
            if text[end] in " -" and _GROUPED.fullmatch(text, 0, end):
                yield text[:end]


@lru_cache(maxsize=50_000)
def _pseudonym(kind: str, text: str, key: bytes) -> str | None:
    return _MAKE[kind](text, key)


def pseudonymize_text(text: str, key: bytes) -> tuple[str, dict[str, int]]:
    """The text with every valid value replaced, and the number of values by kind."""
    counts: dict[str, int] = {}
    out, done, at = [], 0, 0
    while near := _NEAR.search(text, at):
        start = near.start()
        while start > at and not text[start - 1].isspace():
            start -= 1
        behind = _SPACE.search(text, near.end() + REACH)
        found = _FIND.search(text, start, behind.start() if behind else len(text))
        if not found:
            word = _SPACE.search(text, near.end())
            at = word.start() if word else len(text)
            continue
        at = found.start()
        for kind, single in _SINGLE.items():  # the first kind whose check holds counts
            match = single.match(text, at)
            tried = ((old, _pseudonym(kind, old, key)) for old in _readings(kind, match.group())) if match else ()
            old, new = next((pair for pair in tried if pair[1] is not None), (None, None))
            if new is not None:
                out += [text[done:at], new]
                done = at = at + len(old)
                counts[kind] = counts.get(kind, 0) + 1
                break
        else:
            at += 1
            while at < len(text) and text[at].isalnum():
                at += 1
    return ("".join(out) + text[done:], counts) if out else (text, counts)


def pseudonymize(docs: DataFrame, key: bytes, text: str = "text") -> DataFrame:
    """``docs`` with personal values in the text replaced, and two more columns: ``n_replaced`` and
    ``replaced`` (number by kind); columns of these names are replaced.

    Null texts stay null and empty ones empty, with no values.  Other columns stay as they are.
    """
    docs = docs.drop("n_replaced", "replaced")
    place = docs.columns.index(text)
    schema = StructType(
        [StructField(f.name, StringType() if f.name == text else f.dataType) for f in docs.schema.fields]
        + [StructField("n_replaced", LongType()), StructField("replaced", MapType(StringType(), LongType()))]
    )
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [(None, {}) if t is None else pseudonymize_text(t, key) for t in batch.column(place).to_pylist()]
            arrays = list(batch.columns)
            arrays[place] = pa.array([t for t, _ in found], pa.string())
            arrays.append(pa.array([sum(c.values()) for _, c in found], pa.int64()))
            arrays.append(pa.array([list(c.items()) for _, c in found], pa.map_(pa.string(), pa.int64())))
            yield pa.RecordBatch.from_arrays(arrays, names)

    return docs.mapInArrow(run, schema)
