"""Format-preserving pseudonyms for personal numbers, dates and addresses.

Values are found by pattern and then validated: card numbers by the Luhn digit,
IBANs by their check number, IPv4 octets by range, social security numbers by
their areas, dates by the calendar (1900 to 2099), phone numbers by their count of
digits. A valid value is replaced by a keyed permutation within its own format:
separators, length, country, letter case and validity stay, check digits are
made anew. E-mail addresses keep their domain; the letters and digits before the
``@`` are permuted. Equal values get equal pseudonyms in every document, and
with the key the permutation can be undone.

The permutation of a set of n values walks one step along a cycle that a keyed
Feistel network lays through the set, so no value is replaced by itself.

Values are told apart from the left: a rejected candidate gives way to other kinds at its
place and then to values that start inside it. Undoing finds the values again by the same scan, so where
candidates overlap it can go wrong if a pseudonym makes valid one that was not.

Null texts stay null; texts without a value are unchanged; whole texts are
scanned. Repeated rows are treated each; an empty table gives an empty result;
all other columns of the input pass through untouched.
"""

from __future__ import annotations

import datetime
import hashlib
import re
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbline.llm.common import extended, fresh

ROUNDS = 8
_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("length", pa.int32())]))
_SPANS_DDL = "array<struct<kind:string,start:int,length:int>>"

# In the order in which they are tried at one place.
_KINDS = {
    "ip": r"(?<!\d\.)\d{1,3}(?:\.\d{1,3}){3}(?!\.?\d)",
    "iso": r"\d{4}-\d{2}-\d{2}(?![-\d])",
    "dotted": r"(?<!\d\.)\d{1,2}\.\d{1,2}\.\d{4}(?!\.?\d)",
    "slashed": r"\d{1,2}/\d{1,2}/\d{4}(?![/\d])",
    "ssn": r"\d{3}-\d{2}-\d{4}(?![-\d])",
    "phone": r"""(?:\+\d{1,3}[ .-]?)?\(\d{2,4}\)[ .-]?\d{3,4}[ .-]?\d{3,4}(?!\d)
      | \+\d{1,3}(?:[ .-]?\d{2,4}){3,4}(?!\d)
      | \d{3}[ .-]\d{3}[ .-]\d{4}(?![-\d])""",
    "card": r"\d{13,19}|\d{4}(?P<gap>[ -])\d{4}(?P=gap)\d{4}(?P=gap)\d{1,7}|\d{4}[ -]\d{6}[ -]\d{5}",
    "iban": r"[A-Z]{2}\d{2}(?:[ ]?[A-Z0-9]){11,30}",
}
# A time may follow an ISO date.
_AFTER = {kind: r"(?![A-Za-z0-9_])" for kind in _KINDS} | {"iso": r"(?![A-SU-Za-z0-9_]|T(?!\d))"}


def _pattern(kinds) -> re.Pattern:
    some = "|".join(f"(?P<{kind}>{_KINDS[kind]}){_AFTER[kind]}" for kind in kinds)
    return re.compile(rf"(?<![A-Za-z0-9_])(?:{some})", re.X | re.A)


_VALUE = _pattern(_KINDS)
# The kinds that are left to try at the place of a rejected candidate.
_OTHERS = {kind: _pattern(list(_KINDS)[i + 1:]) if i + 1 < len(_KINDS) else None for i, kind in enumerate(_KINDS)}
_CARD = _pattern(["card"])
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]{1,64}\Z")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}")

_FIRST_DAY, _LAST_DAY = datetime.date(1900, 1, 1).toordinal(), datetime.date(2099, 12, 31).toordinal()


class Permutation:
    """A keyed permutation of range(size) without fixed points; ``tweak`` tells kinds of values apart."""

    def __init__(self, key: bytes, tweak: str, size: int):
        self.size = size
        self.half = max(1, ((size - 1).bit_length() + 1) // 2)
        self.salt = hashlib.blake2b(f"{tweak}:{size}".encode(), digest_size=16).digest()
        self.key = hashlib.blake2b(key, digest_size=32).digest()

    def _mix(self, number: int, half: int) -> int:
        data = bytes([number]) + half.to_bytes((self.half + 7) // 8, "big")
        made = hashlib.blake2b(data, key=self.key, salt=self.salt, digest_size=32).digest()
        return int.from_bytes(made, "big") & (1 << self.half) - 1

    def _network(self, x: int, order) -> int:
        """The Feistel rounds; results outside the set are fed in again until one lies inside."""
        mask = (1 << self.half) - 1
        while True:
            left, right = x >> self.half, x & mask
            for number in order:
                left, right = right, left ^ self._mix(number, right)
            x = right << self.half | left
            if x < self.size:
                return x

    def step(self, x: int, back: bool = False) -> int:
        """The value's pseudonym, or with ``back`` the value of a pseudonym."""
        if self.size < 2:
            return x
        place = self._network(x, range(ROUNDS))
        return self._network((place + (-1 if back else 1)) % self.size, range(ROUNDS - 1, -1, -1))


def luhn_digit(payload: str) -> str:
    total = 0
    for i, d in enumerate(reversed(payload)):
        n = int(d) * (2 if i % 2 == 0 else 1)
        total += n - 9 if n > 9 else n
    return str(-total % 10)


def _iban_number(text: str) -> int:
    return int("".join(str(int(c, 36)) for c in text))


@lru_cache(maxsize=1)
def _late_days() -> tuple[list[int], dict[int, int]]:
    """Days after the 12th of their month: the dates that a month-first text shows beyond doubt."""
    days = [d for d in range(_FIRST_DAY, _LAST_DAY + 1) if datetime.date.fromordinal(d).day > 12]
    return days, {d: i for i, d in enumerate(days)}


class Pseudonyms:
    """Replacements under one key; ``back`` undoes them."""

    def __init__(self, key: bytes, back: bool = False):
        self.key, self.back = key, back
        self.permutations: dict[tuple, Permutation] = {}
        self.value = lru_cache(maxsize=50_000)(self._value)

    def _step(self, tweak: str, size: int, x: int) -> int:
        known = self.permutations.get((tweak, size))
        if known is None:
            known = Permutation(self.key, tweak, size)
            if len(self.permutations) < 10_000:
                self.permutations[tweak, size] = known
        return known.step(x, self.back)

    def _characters(self, tweak: str, text: str) -> str:
        """Permutes the letters and digits of ``text``; their classes, case and all else stay."""
        size, x = 1, 0
        for c in text:
            if c.isalnum():
                base = 10 if c.isdigit() else 26
                x, size = x * base + (int(c) if base == 10 else ord(c.lower()) - 97), size * base
        shape = "".join("9" if c.isdigit() else "a" if c.isalpha() else "" for c in text)
        x = self._step(f"{tweak}:{shape}", size, x)
        made = []
        for c in reversed(text):
            if c.isalnum():
                x, digit = divmod(x, 10 if c.isdigit() else 26)
                new = str(digit) if c.isdigit() else chr(97 + digit)
                made.append(new.upper() if c.isupper() else new)
            else:
                made.append(c)
        return "".join(reversed(made))

    @staticmethod
    def _fill(form: str, characters: str) -> str:
        """``form`` with its letters and digits replaced in order."""
        following = iter(characters)
        return "".join(next(following) if c.isalnum() else c for c in form)

    def _date(self, year: str, month: str, day: str, month_first: bool = False):
        try:
            number = datetime.date(int(year), int(month), int(day)).toordinal()
        except ValueError:
            return None
        if not _FIRST_DAY <= number <= _LAST_DAY:
            return None
        if month_first:
            days, place = _late_days()
            return datetime.date.fromordinal(days[self._step("late", len(days), place[number])])
        made = self._step("date", _LAST_DAY - _FIRST_DAY + 1, number - _FIRST_DAY)
        return datetime.date.fromordinal(_FIRST_DAY + made)

    def _value(self, kind: str, text: str) -> str | None:
        """The pseudonym, or None when the value is not valid."""
        digits = "".join(c for c in text if c.isdigit())
        if kind == "ip":
            octets = [int(o) for o in text.split(".")]
            if max(octets) > 255 or any(len(o) > 1 and o[0] == "0" for o in text.split(".")):
                return None
            made = self._step("ip", 1 << 32, int.from_bytes(bytes(octets), "big"))
            return ".".join(map(str, made.to_bytes(4, "big")))
        if kind == "iso":
            date = self._date(*text.split("-"))
            return date and date.isoformat()
        if kind in ("dotted", "slashed"):
            mark = "." if kind == "dotted" else "/"
            first, second, year = text.split(mark)
            date = self._date(year, second, first)
            width = 2 if len(first) == len(second) == 2 else 1
            if date:
                return f"{date.day:0{width}d}{mark}{date.month:0{width}d}{mark}{date.year}"
            date = kind == "slashed" and self._date(year, first, second, True)
            return f"{date.month:0{width}d}/{date.day:02d}/{date.year}" if date else None
        if kind == "ssn":
            if digits[:3] in ("000", "666") or digits[0] == "9" or digits[3:5] == "00" or digits[5:] == "0000":
                return None
            # Areas 1 to 899 without 666, groups 1 to 99, serials 1 to 9999.
            area = int(digits[:3]) - (2 if digits > "666" else 1)
            x = self._step("ssn", 898 * 99 * 9999, (area * 99 + int(digits[3:5]) - 1) * 9999 + int(digits[5:]) - 1)
            area, rest = divmod(x, 99 * 9999)
            area += 2 if area >= 665 else 1
            return f"{area:03d}-{rest // 9999 + 1:02d}-{rest % 9999 + 1:04d}"
        if kind == "phone":
            if not 7 <= len(digits) <= 15:
                return None
            code = re.match(r"\+\d{1,3}(?=[ .(-])", text)
            head = code.group() if code else ""
            own = "".join(c for c in text[len(head):] if c.isdigit())
            return head + self._fill(text[len(head):], self._characters("phone", own))
        if kind == "card":
            if luhn_digit(digits[:-1]) != digits[-1] or len(set(digits)) == 1:
                return None
            n = len(digits) - 1
            payload = f"{self._step('card', 10 ** n, int(digits[:-1])):0{n}d}"
            return self._fill(text, payload + luhn_digit(payload))
        if kind == "iban":
            plain = text.replace(" ", "")
            if len(plain) < 15 or _iban_number(plain[4:] + plain[:4]) % 97 != 1:
                return None
            body = self._characters("iban" + plain[:2], plain[4:])
            check = 98 - _iban_number(body + plain[:2] + "00") % 97
            return self._fill(text, f"{plain[:2]}{check:02d}{body}")
        return self._characters("email", text)

    def _accepted(self, text: str, m: re.Match) -> tuple | None:
        """(kind, start, end, pseudonym) of a candidate, or None when it is not valid."""
        kind, start, end, value = m.lastgroup, m.start(), m.end(), m.group()
        if kind == "phone":  # the last groups of a phone number may be the first of a card number
            for i in range(start + 1, end):
                card = _CARD.match(text, i)
                if card and card.end() > end and self.value("card", card.group()) is not None:
                    shorter = _OTHERS["ssn"].match(text, start, len(text[:i].rstrip(" .-")))
                    return self._accepted(text, shorter) if shorter and shorter.lastgroup == "phone" else None
        new = self.value(kind, value)
        while new is None and kind == "iban" and " " in value:  # capitals that follow are no part of it
            value = value.rpartition(" ")[0]
            new, end = self.value(kind, value), start + len(value)
        return None if new is None else (kind, start, end, new)

    def _values(self, text: str, at: int, limit: int):
        """The valid values that start from ``at`` to before ``limit``, in order. The search goes on behind
        an accepted value and one character after the start of a rejected candidate."""
        while (m := _VALUE.search(text, at)) and m.start() < limit:
            at = m.start() + 1
            while m:
                found = self._accepted(text, m)
                if found:
                    yield found
                    at = found[2]
                    break
                others = _OTHERS[m.lastgroup]
                m = others and others.match(text, m.start())

    def replace(self, text: str) -> tuple[str, list[tuple]]:
        """The text with its values replaced, and (kind, start, length) of each in the text given."""
        locals_ = []
        at = text.find("@")
        while at >= 0:
            domain, local = _DOMAIN.match(text, at), _LOCAL.search(text[max(0, at - 64):at])
            if domain and local:
                locals_.append((at - len(local.group()), at))
            at = text.find("@", at + 1)
        pieces, spans, done = [], [], 0

        def take(kind: str, start: int, end: int, new: str) -> None:
            nonlocal done
            pieces.extend((text[done:start], new))
            spans.append(("date" if kind in ("iso", "dotted", "slashed") else kind, start, end - start))
            done = end

        for start, at in [*locals_, (len(text), len(text))]:
            for kind, begin, end, new in self._values(text, done, start):
                take(kind, begin, end, new)
            start = max(start, done)  # what a value before it has left of a local part
            if start < at:
                take("email", start, at, self.value("email", text[start:at]))
        return ("".join([*pieces, text[done:]]) if pieces else text), spans


def pseudonymise(docs: DataFrame, key: bytes, spans: str | None = None, back: bool = False) -> DataFrame:
    """``docs`` with the values in ``text`` replaced; with ``spans``, a column of that name lists them
    as (kind, start, length) in characters of the text given."""
    at = docs.columns.index("text")
    added = spans or fresh(docs, "spans")

    def run(batches):
        own = Pseudonyms(key, back)
        for given in batches:
            made = [(None, None) if t is None else own.replace(t) for t in given.column(at).to_pylist()]
            columns = list(given.columns)
            columns[at] = pa.array([m[0] for m in made], pa.string())
            swapped = pa.RecordBatch.from_arrays(columns, names=given.schema.names)
            found = pa.array([m[1] and [dict(zip(("kind", "start", "length"), s, strict=True)) for s in m[1]] or []
                              for m in made], _SPANS)
            yield extended(pa.schema([*swapped.schema, (added, _SPANS)]), swapped, **{added: found})

    schema = docs.withColumn(added, F.lit(None).cast(_SPANS_DDL)).schema
    made = docs.mapInArrow(run, schema)
    return made if spans else made.drop(added)
