"""Format-preserving pseudonyms for personal data.

Values are found by pattern, validated (check digits, calendar, number plans) and permuted
within their own format by a keyed Feistel network: a card number becomes another card number
with a right check digit, a date another date, an address another address. The permutation
depends on the key, the kind and the value only, so equal values stay equal across documents
and layouts, different ones stay different, and whoever has the key can undo it.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Callable
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import DataFrame

from .frames import map_text

ROUNDS = 10
DIGITS = "0123456789"
LOWER = "abcdefghijklmnopqrstuvwxyz"
UPPER = LOWER.upper()
FIRST_DAY, LAST_DAY = dt.date(1900, 1, 1).toordinal(), dt.date(2099, 12, 31).toordinal()

_PATTERNS = {
    "email": r"(?<![\w.%+-])[A-Za-z0-9][\w.%+-]*@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}(?![\w-])",
    "secret": r"(?i:password|passwd|secret|token|api[_-]?key)\s*[=:]\s*[\"']?(?P<value>[A-Za-z0-9+/_.-]{8,})",
    "access": r"(?<![A-Za-z0-9])(?:AKIA|ASIA)[0-9A-Z]{16}(?![A-Za-z0-9])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "date": r"(?<![\w./-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}|[0-9]{1,2}\.[0-9]{1,2}\.[0-9]{4})(?![\w/-])",
    "ip": r"(?<![\w.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![\w])(?!\.[0-9])",
    "ssn": r"(?<![\w-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-])",
    "north": r"(?<![\w+])(?:\+1[ .-]?)?(?:\([0-9]{3}\) ?|[0-9]{3}[.-])[0-9]{3}[ .-][0-9]{4}(?![\w])",
    "phone": r"(?<![\w+])\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)[ .-]?)?[0-9]{1,4}(?:[ .-]?[0-9]{2,4}){1,4}(?![\w])",
    "card": r"(?<![\w-])(?:[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){2}[ -][0-9]{1,7}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})"
            r"(?![\w-])",
}
_ANY = re.compile("|".join(f"(?P<{k}>{p})" for k, p in _PATTERNS.items()))
_EACH = {k: re.compile(f"(?P<{k}>{p})") for k, p in _PATTERNS.items()}
#: Country codes of two digits; 1 and 7 have one, all others three.
_TWO_DIGIT_CODES = frozenset(map(int, (
    "20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 "
    "91 92 93 94 95 98").split()))
_HINT = re.compile(r"[0-9@=:]|A[KS]IA")


# ------------------------------------------------------------------ the permutation
class Feistel:
    """A keyed permutation of the tuples of a mixed radix."""

    def __init__(self, key: bytes):
        self.key = key

    def _round(self, kind: str, i: int, shape: tuple, value: int, size: int) -> int:
        text = f"{kind}|{i}|{shape}|{value}".encode()
        return int.from_bytes(blake2b(text, key=self.key, digest_size=32).digest(), "big") % size

    def permute(self, kind: str, digits: list[int], radix: list[int], back: bool = False) -> list[int]:
        """Another tuple of digits below the same radixes; ``back`` is the inverse."""
        if not digits:
            return []
        half = (len(digits) + 1) // 2
        a, b = _number(digits[:half], radix[:half]), _number(digits[half:], radix[half:])
        size_a, size_b = _size(radix[:half]), _size(radix[half:])
        shape = (size_a, size_b)
        for i in reversed(range(ROUNDS)) if back else range(ROUNDS):
            sign = -1 if back else 1
            if i % 2 == 0:
                a = (a + sign * self._round(kind, i, shape, b, size_a)) % size_a
            else:
                b = (b + sign * self._round(kind, i, shape, a, size_b)) % size_b
        return _digits(a, radix[:half]) + _digits(b, radix[half:])

    def walk(self, kind: str, digits: list[int], radix: list[int], valid: Callable[[list[int]], bool],
             back: bool = False) -> list[int]:
        """The permutation restricted to valid tuples: repeated until it meets one again."""
        while True:
            digits = self.permute(kind, digits, radix, back)
            if valid(digits):
                return digits


def _size(radix: list[int]) -> int:
    n = 1
    for r in radix:
        n *= r
    return n


def _number(digits: list[int], radix: list[int]) -> int:
    n = 0
    for d, r in zip(digits, radix):
        n = n * r + d
    return n


def _digits(n: int, radix: list[int]) -> list[int]:
    out = []
    for r in reversed(radix):
        n, d = divmod(n, r)
        out.append(d)
    return out[::-1]


# ------------------------------------------------------------------ kinds
def luhn(digits: list[int]) -> int:
    """The sum that is 0 modulo 10 for a valid number."""
    return sum(d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(reversed(digits))) % 10


def _pour(text: str, digits: list[int]) -> str:
    """``text`` with its digits replaced in order."""
    it = iter(digits)
    return "".join(str(next(it)) if c in DIGITS else c for c in text)


def _figures(text: str) -> list[int]:
    return [int(c) for c in text if c in DIGITS]


def _letters(f: Feistel, kind: str, text: str, back: bool) -> str:
    """Letters and digits permuted, each within its class; anything else stays."""
    places = [(i, cls) for i, c in enumerate(text) for cls in (DIGITS, LOWER, UPPER) if c in cls]
    out = f.permute(kind, [cls.index(text[i]) for i, cls in places], [len(cls) for _, cls in places], back)
    chars = list(text)
    for (i, cls), d in zip(places, out):
        chars[i] = cls[d]
    return "".join(chars)


def _email(f: Feistel, text: str, back: bool) -> str | None:
    local, _, domain = text.rpartition("@")
    name, _, top = domain.rpartition(".")
    # Letters are permuted in lower case and get their place's case back, so spellings of one
    # address stay linked.
    own = f"{local}@{name}"
    new = _letters(f, "email", own.lower(), back)
    return "".join(n.upper() if c.isupper() else n for c, n in zip(own, new)) + "." + top


def _iban(f: Feistel, text: str, back: bool) -> str | None:
    plain = text.replace(" ", "")
    as_number = lambda s: int("".join(str(int(c, 36)) for c in s))
    if not 15 <= len(plain) <= 34 or as_number(plain[4:] + plain[:4]) % 97 != 1:
        return None
    body = _letters(f, "iban" + plain[:2], plain[4:], back)
    check = 98 - as_number(body + plain[:2] + "00") % 97
    it = iter(plain[:2] + f"{check:02d}" + body)
    return "".join(" " if c == " " else next(it) for c in text)


def _date(f: Feistel, text: str, back: bool) -> str | None:
    parts = [int(x) for x in re.split(r"[/.-]", text)]
    order = "ymd" if "-" in text else "dmy"
    for o in (order, "mdy") if "/" in text else (order,):
        got = dict(zip(o, parts))
        try:
            day = dt.date(got["y"], got["m"], got["d"]).toordinal() - FIRST_DAY
        except ValueError:
            continue
        break
    else:
        return None
    span = LAST_DAY - FIRST_DAY + 1
    if not 0 <= day < span:
        return None
    # A date that only reads month first stays so; one that reads day first does too.
    month_first = o == "mdy"
    widths = [len(x) for x in re.split(r"[/.-]", text)]

    def at(n: int) -> dt.date:
        return dt.date.fromordinal(n + FIRST_DAY)

    def fits(d: list[int]) -> bool:
        n = d[0] * 271 + d[1]
        if n >= span:
            return False
        new = at(n)
        if month_first and new.day <= 12:
            return False
        shown = {"y": new.year, "m": new.month, "d": new.day}
        return all(len(str(shown[k])) == w if w < 2 else True for k, w in zip(o, widths))

    kind = "date" + (o + str(widths) if month_first or min(widths) < 2 else "")
    n = f.walk(kind, list(divmod(day, 271)), [271, 271], fits, back)
    new = at(n[0] * 271 + n[1])
    shown = {"y": new.year, "m": new.month, "d": new.day}
    mark = re.sub("[0-9]", "", text)[0]
    return mark.join(f"{shown[k]:0{w}d}" for k, w in zip(o, widths))


def _ip(f: Feistel, text: str, back: bool) -> str | None:
    parts = text.split(".")
    if any(int(p) > 255 or (len(p) > 1 and p[0] == "0") for p in parts):
        return None
    return ".".join(map(str, f.permute("ip", [int(p) for p in parts], [256] * 4, back)))


def _ssn(f: Feistel, text: str, back: bool) -> str | None:
    def fits(d: list[int]) -> bool:
        return d[0] not in (0, 666) and d[0] < 900 and d[1] > 0 and d[2] > 0

    got = [int(x) for x in text.split("-")]
    if not fits(got):
        return None
    a, b, c = f.walk("ssn", got, [1000, 100, 10000], fits, back)
    return f"{a:03d}-{b:02d}-{c:04d}"


def country_code(digits: list[int]) -> int:
    """How many of an international number's digits are its E.164 country code."""
    if digits[0] in (1, 7):
        return 1
    return 2 if digits[0] * 10 + digits[1] in _TWO_DIGIT_CODES else 3


def _phone(f: Feistel, text: str, back: bool) -> str | None:
    digits = _figures(text)
    # A trunk prefix written as "(0)" is no part of the number and stays.
    trunk = text.find("(0)")
    trunk = len(_figures(text[:trunk])) if trunk >= 0 and text.startswith("+") else None
    if trunk is not None:
        del digits[trunk]
    keep = country_code(digits) if text.startswith("+") else 0
    if not 8 <= len(digits) <= 15 or (not keep and len(digits) != 10):
        return None
    north = not keep or digits[0] == 1
    rest = digits[keep:]
    if north and len(rest) != 10:
        return None
    # Subscriber numbers whose first digit a number plan has, and all others among themselves.
    least = 2 if north else 1
    common = rest[0] >= least
    single = re.search(r"\([1-9]\)", text)
    single = len(_figures(text[:single.start()])) - keep if single else None

    def fits(d: list[int]) -> bool:
        # A digit alone in brackets does not become a trunk prefix.
        return (d[0] >= least) == common and (single is None or single < 0 or d[single] > 0)

    code = "1" if north else "".join(map(str, digits[:keep]))
    radix = [10 if common else least] + [10] * (len(rest) - 1)
    new = digits[:keep] + f.walk("phone" + code, rest, radix, fits, back)
    if trunk is not None:
        new.insert(trunk, 0)
    return _pour(text, new)


def _card(f: Feistel, text: str, back: bool) -> str | None:
    digits = _figures(text)
    if luhn(digits) or not any(digits):
        return None
    # The issuer's first digit stays, the check digit follows from the others.
    body = digits[:1] + f.permute(f"card{digits[0]}", digits[1:-1], [10] * (len(digits) - 2), back)
    return _pour(text, body + [-luhn(body + [0]) % 10])


def _access(f: Feistel, text: str, back: bool) -> str | None:
    pool = UPPER + DIGITS
    out = f.permute("access", [pool.index(c) for c in text[4:]], [36] * 16, back)
    return text[:4] + "".join(pool[d] for d in out)


def _secret(f: Feistel, text: str, back: bool) -> str | None:
    return _letters(f, "secret", text, back)


_KINDS = {"email": _email, "secret": _secret, "access": _access, "iban": _iban, "date": _date, "ip": _ip,
          "ssn": _ssn, "north": _phone, "phone": _phone, "card": _card}


def replace(text: str, feistel: Feistel, back: bool = False) -> tuple[str, list[str]]:
    """(text with pseudonyms, kinds of the values replaced, in order)."""
    if not _HINT.search(text):
        return text, []
    kinds: list[str] = []
    out, at = [], 0
    found = _ANY.search(text)
    while found:
        # What one pattern finds and its validation rejects may be valid as another kind.
        for kind, pattern in _EACH.items():
            m = pattern.match(text, found.start())
            if m:
                value = m["value"] if kind == "secret" else m[kind]
                new = _KINDS[kind](feistel, value, back)
                if new is not None:
                    kinds.append(kind)
                    out += [text[at:m.end() - len(value)], new]
                    at = m.end()
                    break
        found = _ANY.search(text, max(at, found.start() + 1))
    return "".join([*out, text[at:]]), kinds


def pseudonymise(docs: DataFrame, key: bytes, *, text_col: str = "text", count_col: str | None = "values",
                 kinds_col: str | None = None, back: bool = False) -> DataFrame:
    """``docs`` with the text's personal data replaced; ``count_col`` adds the number of values
    replaced in a text and ``kinds_col`` their kinds in order. ``back`` restores the text.

    A null text stays null (0 values), an empty one empty; a text without such values is
    returned unchanged, byte for byte; all rows and columns are kept (a column named like an
    added one is replaced); an empty table gives no rows; texts are read whole.
    """
    feistel = Feistel(key)

    def make():
        def one(part: pa.RecordBatch) -> pa.RecordBatch:
            texts, found = [], []
            for t in part.column(text_col).to_pylist():
                new, kinds = replace(t, feistel, back) if t else (t, [])
                texts.append(new)
                found.append(kinds)
            columns = [pa.array(texts, part.schema.field(text_col).type) if n == text_col else part.column(n)
                       for n in part.schema.names]
            names = list(part.schema.names)
            if count_col:
                columns, names = [*columns, pa.array([len(k) for k in found], pa.int64())], [*names, count_col]
            if kinds_col:
                columns, names = [*columns, pa.array(found, pa.list_(pa.string()))], [*names, kinds_col]
            return pa.RecordBatch.from_arrays(columns, names)
        return one

    rest = docs.drop(*[c for c in (count_col, kinds_col) if c])
    schema = [f"`{f.name}` {f.dataType.simpleString()}" for f in rest.schema.fields]
    if count_col:
        schema.append(f"`{count_col}` long")
    if kinds_col:
        schema.append(f"`{kinds_col}` array<string>")
    return map_text(rest, text_col, make, ", ".join(schema))
