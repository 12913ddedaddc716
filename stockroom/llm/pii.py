"""Operator 6: format-preserving pseudonyms for personal data.

Method.  A number or date that passes its check is read as an integer of its
format's domain (Luhn numbers without their check digit, days of a calendar
range, addresses, phone digits, letters and digits of a mail name) and mapped
by a keyed Feistel permutation of that domain: ``ROUNDS`` rounds over two
halves with a keyed BLAKE2 round function, walking on while the image lies
outside the domain.  A permutation keeps different values different; the key
and the kind are its only other inputs, so equal values get equal pseudonyms
in all documents, whatever their punctuation.  Layout is kept, check digits
are made anew, dates stay dates.

Kinds: ``email``, ``iban`` (mod 97), ``date`` (ISO, d.m.y, d/m/y), ``ip``
(IPv4), ``ssn``, ``card`` (13 to 19 digits, Luhn) and ``phone``.  Digits of
the international prefix, an IBAN's country and a mail's last domain label
stay.  Of overlapping finds the leftmost, then the first kind of this list,
then the longest that passes its check counts: a match that fails is tried
again up to each of its spaces and hyphens, so what follows a number does not
hide it.

Defined cases.  Null and empty texts have no finds and stay as they are;
every row is handled alone, so nulls, ties and repeats in other columns do
not matter; other columns pass through ``pseudonymise``.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import math
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROUNDS = 8
KINDS = ["email", "iban", "date", "ip", "ssn", "card", "phone"]

PATTERNS = (
    r"(?P<email>(?<![A-Za-z0-9._%+-])[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,})"
    r"|(?P<iban>\b[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?\b)"
    r"|(?P<date>(?<![0-9./-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}\.[0-9]{2}\.[0-9]{4}|[0-9]{2}/[0-9]{2}/[0-9]{4})(?![0-9/-]))"
    r"|(?P<ip>(?<![0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9]|\.[0-9]))"
    r"|(?P<ssn>(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-]))"
    r"|(?P<card>(?<![A-Za-z0-9])[0-9](?:[\x20-]?[0-9]){12,18}(?![A-Za-z0-9]))"
    r"|(?P<phone>(?<![A-Za-z0-9])(?:\+[0-9]{1,3}[\x20.-]?)?(?:\([0-9]{2,4}\)|[0-9]{2,4})[\x20.-][0-9]{3,4}[\x20.-]?[0-9]{3,4}(?![A-Za-z0-9]))")
FIND = re.compile(PATTERNS, re.A)
FIND_KIND = {k: re.compile(p, re.A) for k, p in zip(KINDS, re.split(r"(?<=\))\|(?=\(\?P<)", PATTERNS))}
BREAK = re.compile(r"[\x20-]")
DAY0 = dt.date(1900, 1, 1).toordinal()
DAYS = dt.date(2100, 1, 1).toordinal() - DAY0


class Feistel:
    """Keyed permutations of range(n), one for each tweak."""

    def __init__(self, key: bytes):
        self.key = hashlib.blake2b(key, digest_size=32).digest()

    def __call__(self, x: int, n: int, tweak: str) -> int:
        if n < 2:
            return x
        a = math.isqrt(n - 1) + 1
        b = -(-n // a)
        while True:
            x = self._once(x, a, b, tweak)
            if x < n:
                return x

    def _once(self, x: int, a: int, b: int, tweak: str) -> int:
        left, right = divmod(x, b)             # left < a, right < b
        for r in range(ROUNDS):
            if r % 2:
                right = (right + self._round(left, r, tweak)) % b
            else:
                left = (left + self._round(right, r, tweak)) % a
        return left * b + right

    def _round(self, v: int, r: int, tweak: str) -> int:
        return int.from_bytes(hashlib.blake2b(f"{r}:{tweak}:{v}".encode(), key=self.key, digest_size=16).digest(), "big")

    def digits(self, s: str, tweak: str) -> str:
        return str(self(int(s), 10 ** len(s), f"{tweak}{len(s)}")).zfill(len(s)) if s else s


def luhn_digit(body: str) -> str:
    total = 0
    for i, c in enumerate(reversed(body)):
        d = int(c) * (2 - i % 2)
        total += d - 9 if d > 9 else d
    return str(-total % 10)


def relaid(layout: str, chars: str) -> str:
    """``chars`` in the places of the ASCII letters and digits of ``layout``."""
    it = iter(chars)
    return "".join(next(it) if c.isalnum() else c for c in layout)


def _iban_check(country: str, body: str) -> str:
    n = int("".join(str(int(c, 36)) for c in body + country + "00"))
    return f"{98 - n % 97:02d}"


class Pseudonyms:
    def __init__(self, key: bytes):
        self.permute = Feistel(key)
        self.of = lru_cache(100_000)(self._of)

    def _of(self, kind: str, s: str) -> str | None:
        """The pseudonym, or None if the value fails its check."""
        return getattr(self, "_" + kind)(s)

    def _classes(self, s: str, tweak: str) -> str:
        """Letters and digits permuted as one number of mixed radix."""
        radix = [10 if c.isdigit() else 26 for c in s]
        x = 0
        for c, r in zip(s, radix):
            x = x * r + (int(c) if r == 10 else ord(c.lower()) - 97)
        x = self.permute(x, math.prod(radix), tweak + "".join("d" if r == 10 else "l" for r in radix))
        out = []
        for c, r in zip(reversed(s), reversed(radix)):
            x, v = divmod(x, r)
            out.append(str(v) if r == 10 else (chr(65 + v) if c.isupper() else chr(97 + v)))
        return "".join(reversed(out))

    def _email(self, s: str) -> str:
        name, _, last = s.rpartition(".")
        low = "".join(c for c in name if c.isalnum())
        return relaid(name, self._classes(low, "email")) + "." + last

    def _iban(self, s: str) -> str | None:
        flat = s.replace(" ", "")
        if not 15 <= len(flat) <= 34 or _iban_check(flat[:2], flat[4:]) != flat[2:4]:
            return None
        body = self._classes(flat[4:], "iban" + flat[:2])
        return relaid(s, flat[:2] + _iban_check(flat[:2], body) + body)

    def _date(self, s: str) -> str | None:
        iso = s[4] == "-"
        y, m, d = (s[:4], s[5:7], s[8:]) if iso else (s[6:], s[3:5], s[:2])
        try:
            day = dt.date(int(y), int(m), int(d)).toordinal() - DAY0
        except ValueError:
            return None
        if not 0 <= day < DAYS:
            return None
        new = dt.date.fromordinal(DAY0 + self.permute(day, DAYS, "date"))
        return new.strftime("%Y-%m-%d") if iso else new.strftime(f"%d{s[2]}%m{s[2]}%Y")

    def _ip(self, s: str) -> str | None:
        part = [int(p) for p in s.split(".")]
        if max(part) > 255:
            return None
        x = self.permute(int.from_bytes(bytes(part), "big"), 1 << 32, "ip")
        return ".".join(str(p) for p in x.to_bytes(4, "big"))

    def _ssn(self, s: str) -> str | None:
        flat = s.replace("-", "")

        def valid(x: str) -> bool:
            return x[:3] not in ("000", "666") and x[0] != "9" and x[3:5] != "00" and x[5:] != "0000"
        if not valid(flat):
            return None
        while True:
            flat = self.permute.digits(flat, "ssn")
            if valid(flat):
                return relaid(s, flat)

    def _card(self, s: str) -> str | None:
        flat = "".join(c for c in s if c.isdigit())
        if luhn_digit(flat[:-1]) != flat[-1]:
            return None
        body = self.permute.digits(flat[:-1], "card")
        return relaid(s, body + luhn_digit(body))

    def _phone(self, s: str) -> str | None:
        head = re.match(r"\+[0-9]{1,3}(?=[\x20.(-])", s)
        rest = s[head.end():] if head else s
        flat = "".join(c for c in rest if c.isdigit())
        if not 7 <= len(flat) <= 12:
            return None
        return (head[0] if head else "") + relaid(rest, self.permute.digits(flat, "phone"))

    def _other(self, text: str, start: int) -> tuple[str | None, int, str | None]:
        """(kind, end, pseudonym) of the first kind with a find at ``start``
        that passes its check, the longest first."""
        for kind, pattern in FIND_KIND.items():
            if m := pattern.match(text, start):
                for end in [m.end(), *sorted((b.start() for b in BREAK.finditer(text, start, m.end())), reverse=True)]:
                    if pattern.fullmatch(text, start, end) and (new := self.of(kind, text[start:end])) is not None:
                        return kind, end, new
        return None, start, None

    def replace(self, text: str) -> tuple[str, list[tuple[str, int, int]]]:
        """(new text, [(kind, start, end) in the old text])."""
        out, at, found, pos = [], 0, [], 0
        while m := FIND.search(text, pos):
            kind, end, new = m.lastgroup, m.end(), self.of(m.lastgroup, m[0])
            if new is None:
                kind, end, new = self._other(text, m.start())
            if new is None:
                pos = m.start() + 1
                continue
            out += [text[at:m.start()], new]
            found.append((kind, m.start(), end))
            at = pos = end
        return ("".join(out) + text[at:], found) if found else (text, found)


def _replace(key: bytes, names: list[str]):
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
    digit = re.compile("[0-9@]")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pseudonyms = Pseudonyms(key)
        at = names.index("text")
        for batch in batches:
            texts, spans = [], []
            for t in batch.column(at):
                t = t.as_py()
                new, found = pseudonyms.replace(t) if t and digit.search(t) else (t, [])
                texts.append(new)
                spans.append([{"kind": k, "start": a, "end": b} for k, a, b in found])
            cols = [pa.array(texts, pa.string()) if i == at else batch.column(i) for i in range(len(names))]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(spans, kind)], names=[*names, "pii_spans"])
    return run


def pseudonymise(docs: DataFrame, key: bytes) -> DataFrame:
    """``docs`` with personal data in ``text`` replaced by pseudonyms, and
    ``pii_spans`` (kind, start, end in code points of the old text)."""
    base = docs.drop("pii_spans").withColumn("text", F.col("text").cast("string"))
    span = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()),
                         T.StructField("end", T.IntegerType())])
    schema = T.StructType(base.schema.fields + [T.StructField("pii_spans", T.ArrayType(span))])
    return base.mapInArrow(_replace(key, base.columns), schema)
