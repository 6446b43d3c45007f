"""PII: format-preserving Feistel pseudonyms.

Validated values (payment cards by Luhn, IBANs by their check digits, social-security
numbers by their numbering plan, phone numbers by their notation, IPv4 addresses, calendar
dates, e-mail names, access keys and hexadecimal secrets) are replaced by other valid values of the same
format.  A keyed Feistel network permutes each format's symbols: the two halves of a
value, as mixed-radix numbers, are added a keyed hash of the other half in turn, so the
map is one-to-one and equal values stay linked across documents without a table.  Values
outside a format's valid range are permuted again until valid (cycle walking), which
keeps the map one-to-one; check digits are computed anew.  A date keeps its notation, and
one day maps to one day in every notation.

One pass, no shuffle, no state: any worker gives the same answer.

Defined cases: NULL text stays NULL with no findings, empty text stays empty; identifiers
and repeated rows do not matter; other columns pass through inside ``row``.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import re
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starbuild.llm.common import packed

ROUNDS = 10

DIGITS, LOWER, UPPER, HEX = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789abcdef"
KEY_SYMBOLS = UPPER + DIGITS
FIRST_DAY, LAST_DAY = dt.date(1900, 1, 1).toordinal(), dt.date(2099, 12, 31).toordinal()

PATTERN = re.compile(
    r"(?P<email>[A-Za-z0-9][\w.+-]*@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+)"
    r"|(?P<access>\bAKIA[A-Z0-9]{16}\b)"
    r"|(?P<iban>\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b)"
    r"|(?P<secret>(?<=[='\"])[0-9A-Fa-f]{16,}\b)"
    r"|(?P<iso>(?<![\w.-])\d{4}-\d\d-\d\d(?![\w-]))"
    r"|(?P<day>(?<![\w./])\d\d?(?P<mark>[./])\d\d?(?P=mark)\d{4}(?![\w/]))"
    r"|(?P<ip>(?<![\w.])\d{1,3}(?:\.\d{1,3}){3}(?![\w]|\.\d))"
    r"|(?P<ssn>(?<![\w-])\d{3}-\d\d-\d{4}(?![\w-]))"
    r"|(?P<phone>(?<![\w+])(?:\+?1[ .-]?)?(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}(?![\w-]))"
    r"|(?P<card>(?<![\w-])(?:\d{13,19}|\d{4}[ -]\d{4}[ -]\d{4}[ -]\d{1,7}|\d{4}[ -]\d{6}[ -]\d{5})(?![\w-]))",
    re.ASCII,
)
#: What a value that looks like an IBAN and is none may be instead.
NO_IBAN = re.compile(re.sub(r"\|\(\?P<iban>.*?\\b\)(?=\|)", "", PATTERN.pattern), re.ASCII)
#: Length of an IBAN by country.
IBAN_LENGTH = {
    country: int(size)
    for size, countries in re.findall(
        r"(\d\d)((?: [A-Z]{2})+)",
        "15 NO 16 BE 18 DK FI FK FO GL NL SD 19 MK SI 20 AT BA EE KZ LT LU MN XK 21 CH HR LI LV 22 BG BH CR DE GB GE IE ME RS VA"
        " 23 AE GI IL IQ OM SO TL 24 AD CZ ES MD PK RO SA SE SK TN VG 25 LY PT ST 26 IS TR 27 BI DJ FR GR IT MC MR SM"
        " 28 AL AZ BY CY DO GT HU LB NI PL SV 29 BR EG PS QA UA 30 JO KW MU YE 31 MT SC 32 LC 33 RU",
    )
    for country in countries.split()
}
_MAYBE = re.compile(r"[0-9@]")


def permute(values: list[int], radices: list[int], key: bytes, tweak: str) -> list[int]:
    """A keyed permutation of the mixed-radix numbers with these radices."""
    middle = len(values) // 2

    def number(part: slice) -> tuple[int, int]:
        n = size = 0
        size = 1
        for v, r in zip(values[part], radices[part]):
            n, size = n * r + v, size * r
        return n, size

    (a, a_size), (b, b_size) = number(slice(0, middle)), number(slice(middle, None))
    label = f"{tweak}:{len(values)}:".encode()
    for turn in range(ROUNDS):
        other = a if turn % 2 else b
        drawn = hashlib.blake2b(label + f"{turn}:{other}".encode(), key=key[:64], digest_size=32).digest()
        if turn % 2:
            b = (b + int.from_bytes(drawn, "big")) % b_size
        else:
            a = (a + int.from_bytes(drawn, "big")) % a_size
    out = []
    for n, part in ((b, radices[middle:]), (a, radices[:middle])):
        for r in reversed(part):
            out.append(n % r)
            n //= r
    return out[::-1]


def walk(values: list[int], radices: list[int], key: bytes, tweak: str, valid: Callable[[list[int]], bool]) -> list[int]:
    """``permute`` until the result is valid; one-to-one on the valid values."""
    values = permute(values, radices, key, tweak)
    while not valid(values):
        values = permute(values, radices, key, tweak)
    return values


def _refilled(text: str, symbols: str) -> str:
    """``text`` with its letters and digits replaced, in order."""
    new = iter(symbols)
    return "".join(next(new) if c.isalnum() else c for c in text)


def _digits(text: str) -> list[int]:
    return [int(c) for c in text if c.isdigit()]


def luhn_digit(payload: list[int]) -> int:
    total = 0
    for i, d in enumerate(reversed(payload)):
        d *= 1 + (i % 2 == 0)
        total += d - 9 * (d > 9)
    return -total % 10


def _card(text: str, key: bytes) -> str | None:
    d = _digits(text)
    if luhn_digit(d[:-1]) != d[-1] or d[0] == 0:
        return None
    payload = [d[0], *permute(d[1:-1], [10] * (len(d) - 2), key, f"card{d[0]}")]
    return _refilled(text, "".join(map(str, [*payload, luhn_digit(payload)])))


def _iban_check(country: str, rest: str) -> int:
    return 98 - int("".join(str(int(c, 36)) for c in rest + country + "00")) % 97


def _iban(text: str, key: bytes) -> str | None:
    bare = text.replace(" ", "")
    country, rest = bare[:2], bare[4:]
    if not 15 <= len(bare) <= 34 or int(bare[2:4]) != _iban_check(country, rest):
        return None
    radices = [10 if c.isdigit() else 26 for c in rest]
    values = permute([int(c) if c.isdigit() else UPPER.index(c) for c in rest], radices, key, f"iban{country}")
    new = "".join(DIGITS[v] if r == 10 else UPPER[v] for v, r in zip(values, radices))
    return _refilled(text, f"{country}{_iban_check(country, new):02d}{new}")


def _iban_ends(text: str) -> list[int]:
    """Where an IBAN at the start of ``text`` may end: at its country's length, else the longest first."""
    ends = [m.end() for m in re.finditer(r"[A-Z0-9]\b", text)]
    size = IBAN_LENGTH.get(text[:2])
    return sorted(ends, key=lambda e: (len(text[:e].replace(" ", "")) != size, -e))


def _valid_ssn(d: list[int]) -> bool:
    area = d[0] * 100 + d[1] * 10 + d[2]
    return area not in (0, 666) and area < 900 and d[3:5] != [0, 0] and d[5:] != [0, 0, 0, 0]


def _ssn(text: str, key: bytes) -> str | None:
    d = _digits(text)
    return _refilled(text, "".join(map(str, walk(d, [10] * 9, key, "ssn", _valid_ssn)))) if _valid_ssn(d) else None


def _phone(text: str, key: bytes) -> str:
    """Any ten digits: whatever is written as a phone number counts as one."""
    d = _digits(text)
    new = permute(d[-10:], [10] * 10, key, "phone")
    return _refilled(text, "".join(map(str, d[:-10] + new)))


def _ip(text: str, key: bytes) -> str | None:
    parts = [int(p) for p in text.split(".")]
    if max(parts) > 255 or any(len(p) > 1 and p[0] == "0" for p in text.split(".")):
        return None
    return ".".join(map(str, permute(parts, [256] * 4, key, "ip")))


def _day(year: int, month: int, day: int, key: bytes) -> dt.date | None:
    try:
        at = dt.date(year, month, day).toordinal() - FIRST_DAY
    except ValueError:
        return None
    days = LAST_DAY - FIRST_DAY + 1
    if not 0 <= at < days:
        return None
    high, low = walk(list(divmod(at, 271)), [271, 271], key, "day", lambda v: v[0] * 271 + v[1] < days)
    return dt.date.fromordinal(FIRST_DAY + high * 271 + low)


def _iso(text: str, key: bytes) -> str | None:
    new = _day(*map(int, text.split("-")), key)
    return new and new.isoformat()


def _written_day(text: str, key: bytes) -> str | None:
    """Day first; month first where only that is a date."""
    mark = "." if "." in text else "/"
    a, b, year = text.split(mark)
    if new := _day(int(year), int(b), int(a), key):
        return f"{new.day:02d}{mark}{new.month:02d}{mark}{new.year:04d}"
    if new := _day(int(year), int(a), int(b), key):
        return f"{new.month:02d}{mark}{new.day:02d}{mark}{new.year:04d}"
    return None


def _classes(text: str) -> list[str]:
    return [DIGITS if c in DIGITS else LOWER if c in LOWER else UPPER for c in text if c.isascii() and c.isalnum()]


def _email(text: str, key: bytes) -> str | None:
    name, _, domain = text.rpartition("@")
    symbols = [c for c in name if c.isascii() and c.isalnum()]
    kinds = _classes(name)
    new = iter(permute([k.index(c) for c, k in zip(symbols, kinds)], [len(k) for k in kinds], key, f"email{domain.lower()}"))
    kind = iter(kinds)
    return "".join(next(kind)[next(new)] if c.isascii() and c.isalnum() else c for c in name) + "@" + domain


def _access(text: str, key: bytes) -> str:
    values = permute([KEY_SYMBOLS.index(c) for c in text[4:]], [36] * 16, key, "access")
    return text[:4] + "".join(KEY_SYMBOLS[v] for v in values)


def _secret(text: str, key: bytes) -> str:
    """Letters keep the case of their place; where a digit becomes one, the case of the nearest letter before it, else of the first."""
    new = permute([HEX.index(c) for c in text.lower()], [16] * len(text), key, "secret")
    upper = next((c.isupper() for c in text if c.isalpha()), False)
    out = []
    for c, v in zip(text, new):
        upper = c.isupper() if c.isalpha() else upper
        out.append(HEX[v].upper() if upper else HEX[v])
    return "".join(out)


_KINDS: dict[str, Callable[[str, bytes], str | None]] = {
    "email": _email,
    "access": _access,
    "iban": _iban,
    "secret": _secret,
    "iso": _iso,
    "day": _written_day,
    "ip": _ip,
    "ssn": _ssn,
    "phone": _phone,
    "card": _card,
}


def pseudonymised(text: str, key: bytes) -> tuple[str, int]:
    """The text with its private values replaced, and how many were."""
    if not _MAYBE.search(text):
        return text, 0
    out, found, at, seen = [], 0, 0, 0
    while match := PATTERN.search(text, seen):
        kind, start, end = match.lastgroup, match.start(), match.end()
        new = None
        if kind == "iban":
            for size in _iban_ends(match[0]):
                if new := _iban(match[0][:size], key):
                    end = start + size
                    break
            else:  # no IBAN: the other formats have their turn, here and inside of it
                match = NO_IBAN.match(text, start)
                kind, end = (match.lastgroup, match.end()) if match else (None, start + 1)
        if kind and kind != "iban":
            new = _KINDS[kind](match[0], key)
        if new is not None:
            out += text[at:start], new
            at, found = end, found + 1
        seen = end
    return "".join([*out, text[at:]]), found


def pseudonymise(docs: DataFrame, key: bytes, text_col: str = "text") -> DataFrame:
    """The rows as ``row`` with the new ``text`` and ``n_replaced``.

    Whoever has the ``key`` (up to 64 bytes count) can undo the replacement: keep it secret.
    """
    if not key:
        raise ValueError("pseudonyms need a secret key")

    @F.arrow_udf("struct<text string, found long>")
    def replaced(texts: pa.Array) -> pa.Array:
        done = [pseudonymised(t.as_py(), key) if t.is_valid else (None, 0) for t in texts]
        return pa.StructArray.from_arrays(
            [pa.array([t for t, _ in done], pa.string()), pa.array([n for _, n in done], pa.int64())], names=["text", "found"]
        )

    new = packed(docs, F.col(f"`{text_col}`").cast("string").alias("_text")).select("row", replaced("_text").alias("new"))
    return new.select("row", F.col("new.text").alias("text"), F.col("new.found").alias("n_replaced"))
