"""Format-preserving pseudonyms: personal values are permuted by a keyed Feistel network within their format.

Card numbers (Luhn), IBANs (mod 97), US phone and social security numbers (their numbering
rules), IPv4 addresses, calendar dates and the local parts of e-mail addresses are found,
validated, and replaced by another valid value of the same format. A value is first brought to one
number (its digits, its day, its letters by class); that number is permuted and written back with
the separators of the place it stood at. So equal values get equal pseudonyms in all documents,
different values different ones, and nothing but the key is shared between tasks.

The network works on numbers below a * b: each round adds a keyed hash of one half to the other, and
results outside the format's range are permuted again until one lies inside (cycle walking),
which keeps it a bijection of the range.

Defined cases: a null text stays null and has no spans; values that fail validation stay as they are;
of overlapping finds the earlier one counts, and of those at one place the kind listed first; repeated
rows get the same text; other columns pass through untouched.
"""

from __future__ import annotations

import datetime
import hashlib
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

ROUNDS = 10
FIRST_DAY = datetime.date(1900, 1, 1).toordinal()
DAYS = datetime.date(2100, 1, 1).toordinal() - FIRST_DAY
LENGTHS_OF_IBAN = range(15, 35)


class Permutation:
    """A keyed bijection of the numbers below `size`, one for each kind."""

    def __init__(self, key: bytes, kind: str, size: int):
        self.size = size
        self.a = 1
        while self.a * self.a < size:  # a * b is the smallest such product with a a power of 2
            self.a *= 2
        self.b = -(-size // self.a)
        self.key = hashlib.blake2b(key, digest_size=32).digest()
        self.person = kind.encode()[:16]

    def _hash(self, turn: int, half: int) -> int:
        data = turn.to_bytes(1, "big") + half.to_bytes((half.bit_length() + 7) // 8 or 1, "big")
        width = min(64, (self.a.bit_length() + 7) // 8 + 8)
        return int.from_bytes(hashlib.blake2b(data, digest_size=width, key=self.key, person=self.person).digest(), "big")

    def _once(self, x: int, back: bool) -> int:
        left, right = divmod(x, self.b)
        turns = range(ROUNDS - 1, -1, -1) if back else range(ROUNDS)
        sign = -1 if back else 1
        for turn in turns:
            if turn % 2:
                right = (right + sign * self._hash(turn, left)) % self.b
            else:
                left = (left + sign * self._hash(turn, right)) % self.a
        return left * self.b + right

    def apply(self, x: int, fits: Callable[[int], bool] = lambda _: True, back: bool = False) -> int:
        """The number that x is sent to among those that fit; x itself must fit."""
        if self.size < 2:
            return x
        while True:
            x = self._once(x, back)
            if x < self.size and fits(x):
                return x


def luhn_digit(digits: str) -> int:
    """The check digit after these digits."""
    total = sum(d if i % 2 else sum(divmod(2 * d, 10)) for i, d in enumerate(map(int, reversed(digits))))
    return -total % 10


def _filled(shape: str, characters: str) -> str:
    """`shape` with its letters and digits replaced, in order, by the characters."""
    rest = iter(characters)
    return "".join(next(rest) if c.isalnum() else c for c in shape)


def _mixed(value: str) -> tuple[int, int]:
    """A string of ASCII letters and digits as a number in mixed radix, and how many such there are."""
    x, size = 0, 1
    for c in value:
        first, radix = (48, 10) if c.isdigit() else (97, 26) if c.islower() else (65, 26)
        x, size = x * radix + ord(c) - first, size * radix
    return x, size


def _unmixed(x: int, like: str) -> str:
    out = []
    for c in reversed(like):
        first, radix = (48, 10) if c.isdigit() else (97, 26) if c.islower() else (65, 26)
        x, d = divmod(x, radix)
        out.append(chr(first + d))
    return "".join(reversed(out))


class Pseudonyms:
    """Pseudonyms under one key; `back` gives the originals again."""

    def __init__(self, key: bytes, back: bool = False):
        self.key, self.back, self._made = key, back, {}

    def _permute(self, kind: str, x: int, size: int, fits=lambda _: True) -> int:
        if (kind, size) not in self._made:
            if len(self._made) > 4096:  # sizes follow the lengths of values; keep the table small
                self._made.clear()
            self._made[kind, size] = Permutation(self.key, kind, size)
        return self._made[kind, size].apply(x, fits, self.back)

    def email(self, found: str) -> str | None:
        local, _, domain = found.partition("@")
        kept = "".join(c for c in local if c.isascii() and c.isalnum())
        if not kept:
            return None
        x, size = _mixed(kept)
        return _filled(local, _unmixed(self._permute("email", x, size), kept)) + "@" + domain

    def iban(self, found: str) -> str | None:
        plain = found.replace(" ", "")
        if len(plain) not in LENGTHS_OF_IBAN or int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 != 1:
            return None
        x, size = _mixed(plain[4:])
        body = _unmixed(self._permute("iban" + plain[:2], x, size), plain[4:])
        check = 98 - int("".join(str(int(c, 36)) for c in body + plain[:2] + "00")) % 97
        return _filled(found, f"{plain[:2]}{check:02d}{body}")

    def ipv4(self, found: str) -> str | None:
        parts = [int(p) for p in found.split(".")]
        if max(parts) > 255:
            return None
        x = self._permute("ipv4", int.from_bytes(bytes(parts), "big"), 1 << 32)
        return ".".join(map(str, x.to_bytes(4, "big")))

    def date(self, found: str) -> str | None:
        parts = re.split(r"\D", found)
        order = (0, 1, 2) if len(parts[0]) == 4 else (2, 0, 1) if "/" in found else (2, 1, 0)
        try:
            day = datetime.date(*(int(parts[i]) for i in order)).toordinal() - FIRST_DAY
        except ValueError:
            return None
        if not 0 <= day < DAYS:
            return None
        new = datetime.date.fromordinal(FIRST_DAY + self._permute("date", day, DAYS))
        values = (new.year, new.month, new.day)
        digits = "".join(f"{values[order.index(i)]:0{4 if order[0] == i else 2}d}" for i in range(3))
        return _filled(found, digits)

    def card(self, found: str) -> str | None:
        digits = re.sub(r"\D", "", found)
        if luhn_digit(digits[:-1]) != int(digits[-1]):
            return None
        n = len(digits) - 1
        body = f"{self._permute('card', int(digits[:-1]), 10**n):0{n}d}"
        return _filled(found, body + str(luhn_digit(body)))

    def ssn(self, found: str) -> str | None:
        def fits(x: int) -> bool:
            area, group, serial = x // 1_000_000, x // 10_000 % 100, x % 10_000
            return 0 < area < 900 and area != 666 and group > 0 and serial > 0

        x = int(found.replace("-", ""))
        return _filled(found, f"{self._permute('ssn', x, 10**9, fits):09d}") if fits(x) else None

    def phone(self, found: str) -> str | None:
        def fits(x: int) -> bool:
            return x // 10**9 >= 2 and x // 10**6 % 10 >= 2

        digits = re.sub(r"\D", "", found)
        prefix, x = digits[:-10], int(digits[-10:])
        if prefix not in ("", "1") or x < 10**9:
            return None
        if not fits(x):  # written like a phone number, and permuted among the numbers that can't be one
            return _filled(found, f"{prefix}{self._permute('phone-odd', x, 10**10, lambda y: y >= 10**9 and not fits(y))}")
        return _filled(found, f"{prefix}{self._permute('phone', x, 10**10, fits)}")


# One expression per kind, tried in this order at each place.
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "iban": r"\b[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b",
    "ipv4": r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9]|\.[0-9])",
    "date": r"(?<![0-9.\-/])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}/[0-9]{2}/[0-9]{4}|[0-9]{2}\.[0-9]{2}\.[0-9]{4})(?![0-9]|[-/.][0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9]|-[0-9])",
    "card": r"(?<![0-9A-Za-z])(?:[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){2,3}[ -][0-9]{1,7}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{4,5})(?![0-9A-Za-z])",
    "phone": r"(?<![0-9A-Za-z])(?:\+?1[ .-]?)?(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9A-Za-z])",
}
# Every kind but e-mail starts with a digit, `+`, `(` or two capitals before digits; most texts hold none of it.
_ANY = re.compile("|".join(f"(?P<{k}>{p})" for k, p in PATTERNS.items() if k not in ("email", "iban")))
_EMAIL, _IBAN, _CARD = (re.compile(PATTERNS[k]) for k in ("email", "iban", "card"))
_DIGIT = re.compile("[0-9]")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]*\Z")


def _emails(text: str) -> Iterator[re.Match]:
    """From `@` to `@`, so that a text without one costs a search for a character only."""
    at, end = text.find("@"), 0
    while at >= 0:
        start = at
        while start > end and (text[start - 1].isalnum() or text[start - 1] in "._%+-") and text[start - 1].isascii():
            start -= 1
        m = _EMAIL.match(text, start) if start < at else None
        if m:
            yield m
            end = m.end()
        at = text.find("@", max(at + 1, end))


def _ibans(text: str, pseudonyms: Pseudonyms) -> Iterator[re.Match]:
    """The longest valid one at each place: a match may have taken words behind it, which are left off one by one."""
    at = 0
    while found := _IBAN.search(text, at):
        m, at = found, found.start() + 1
        while m and pseudonyms.iban(m.group()) is None:
            m = _IBAN.match(text, m.start(), max(m.start(), text.rfind(" ", m.start(), m.end())))
        if m:
            yield m
            at = m.end()


def _others(text: str, pseudonyms: Pseudonyms) -> Iterator[tuple[str, re.Match]]:
    """Valid values of the other kinds. A card may have taken a code or a date behind it: groups are left off one by one."""
    at = 0
    while m := _ANY.search(text, at):
        kind, found = m.lastgroup, m
        while found and getattr(pseudonyms, kind)(found.group()) is None:
            end = max(text.rfind(c, found.start(), found.end()) for c in " -") if kind == "card" else -1
            found = _CARD.match(text, m.start(), end) if end > 0 else None
        if found:
            yield kind, found
        # A value can begin inside of what was none; digits of one long number are not tried again.
        at = found.end() if found else m.end() if kind == "card" else m.start() + 1


def find(text: str, pseudonyms: Pseudonyms) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, pseudonym) of the valid values, in order and without overlap."""
    order = list(PATTERNS)
    found = [("email", m) for m in _emails(text)]
    if _DIGIT.search(text):
        found += [("iban", m) for m in _ibans(text, pseudonyms)]
        found += _others(text, pseudonyms)
    out: list[tuple[int, int, str, str]] = []
    for kind, m in sorted(found, key=lambda x: (x[1].start(), order.index(x[0]))):
        if out and m.start() < out[-1][1]:
            continue
        new = getattr(pseudonyms, kind)(m.group())
        if new is not None:
            out.append((m.start(), m.end(), kind, new))
    return out


def replaced(text: str, spans: list[tuple[int, int, str, str]]) -> str:
    parts, at = [], 0
    for start, end, _, new in spans:
        parts += [text[at:start], new]
        at = end
    return "".join([*parts, text[at:]])


_SPAN = [("kind", T.StringType()), ("start", T.LongType()), ("end", T.LongType())]
SPANS = T.ArrayType(T.StructType([T.StructField(*f) for f in _SPAN]))


def _batches(batches: Iterator[pa.RecordBatch], key: bytes, text: str, spans: str) -> Iterator[pa.RecordBatch]:
    pseudonyms = Pseudonyms(key)
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
    for batch in batches:
        for a in range(0, batch.num_rows, 256):
            part = batch.slice(a, 256)
            texts, found = [], []
            for t in part.column(text).to_pylist():
                hits = find(t, pseudonyms) if t else []
                texts.append(replaced(t, hits) if hits else t)
                found.append([{"kind": k, "start": s, "end": e} for s, e, k, _ in hits])
            names = part.schema.names
            columns = [pa.array(texts, pa.string()) if n == text else part.column(n) for n in names]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(found, kind)], [*names, spans])


def pseudonymize(docs: DataFrame, key: bytes, text: str = "text", spans: str = "spans") -> DataFrame:
    """The documents with pseudonyms in their text, and the spans of the values in the text before.

    One pass over the rows without a shuffle. `spans` must not be another column's name.
    """
    schema = T.StructType([*docs.schema.fields, T.StructField(spans, SPANS)])
    return docs.mapInArrow(lambda batches: _batches(batches, key, text, spans), schema)
