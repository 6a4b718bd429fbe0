"""Pseudonyms for personal data (operator 3): a keyed Feistel permutation within the format of each value.

A value found in a text is validated (checksums, calendar, ranges), turned into a number below the size of its format, permuted by a keyed Feistel
network with cycle walking, and written back in the same shape with its checksum made anew. The permutation is a
bijection, so equal values stay equal and different ones different in all documents, under any spelling of the separators, and who
has the key can undo it. Nothing is stored or exchanged.
"""

from __future__ import annotations

import datetime
import hashlib
import ipaddress
import re
from collections.abc import Callable, Iterator
from functools import lru_cache
from math import isqrt

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from mapjobs.llm.common import slices, texts

FIRST_DAY, LAST_DAY = datetime.date(1800, 1, 1).toordinal(), datetime.date(2199, 12, 31).toordinal()
ROUNDS = 10


class Feistel:
    """A keyed permutation of range(size) for any size. A number is a point (l, r) of a grid of a x b cells; the rounds add a keyed hash of one
    coordinate to the other in turn; points beyond ``size``, and those that ``valid`` refuses, are walked on from."""

    def __init__(self, key: bytes):
        self.key = key

    def _hash(self, tweak: bytes, turn: int, value: int, below: int) -> int:
        """A number far above ``below``, however long that is, so that its rest has no bias and every place of the value is hidden."""
        told = b"%d|%d|" % (turn, len(tweak)) + tweak + value.to_bytes(value.bit_length() // 8 + 1, "big")
        seed = hashlib.blake2b(told, key=self.key, digest_size=64).digest()
        n = below.bit_length() // 8 + 9
        return int.from_bytes(seed[:n] if n <= 64 else hashlib.shake_256(seed).digest(n), "big")

    def permuted(self, value: int, size: int, tweak: bytes, valid: Callable[[int], bool] = lambda x: True, back: bool = False) -> int:
        """``valid`` must hold for the value itself; it then holds for the result. back: the inverse."""
        if size < 2:
            return value
        a = isqrt(size - 1) + 1
        b = -(-size // a)
        sign = -1 if back else 1
        turns = range(ROUNDS - 1, -1, -1) if back else range(ROUNDS)
        while True:
            l, r = divmod(value, b)
            for turn in turns:
                if turn % 2:
                    r = (r + sign * self._hash(tweak, turn, l, b)) % b
                else:
                    l = (l + sign * self._hash(tweak, turn, r, a)) % a
            value = l * b + r
            if value < size and valid(value):
                return value


def luhn(digits: str) -> int:
    """The check digit that makes digits + it valid."""
    total = sum(sum(divmod(2 * int(d), 10)) if i % 2 == 0 else int(d) for i, d in enumerate(reversed(digits)))
    return -total % 10


def respelt(shape: str, digits: str) -> str:
    """shape with its digits replaced in order."""
    it = iter(digits)
    return "".join(next(it) if c.isdigit() else c for c in shape)


def _digits(s: str) -> str:
    return "".join(c for c in s if c.isdigit())


def card(f: Feistel, s: str, back: bool) -> str | None:
    """13 to 19 digits with a Luhn check digit; the first digit (the network) stays."""
    d = _digits(s)
    if not 13 <= len(d) <= 19 or int(d[-1]) != luhn(d[:-1]) or len(set(d)) == 1:
        return None
    n = len(d) - 2
    body = d[0] + str(f.permuted(int(d[1:-1]), 10**n, b"card%d%c" % (len(d), ord(d[0])), back=back)).zfill(n)
    return respelt(s, body + str(luhn(body)))


def phone(f: Feistel, s: str, back: bool) -> str | None:
    """+1 and ten digits (area and exchange codes that begin with 2 to 9 keep doing so), or + and 8 to 15 digits, of which the first two stay."""
    d = _digits(s)
    if d[0] == "1" and len(d) == 11:
        return respelt(s, "1" + _ten(f, d[1:], back))
    if not 8 <= len(d) <= 15 or d[0] == "0":
        return None
    n = len(d) - 2
    return respelt(s, d[:2] + str(f.permuted(int(d[2:]), 10**n, b"phone" + d[:2].encode() + b"%d" % n, back=back)).zfill(n))


def _ten(f: Feistel, d: str, back: bool) -> str:
    """The ten digits behind +1."""
    def kind(x: int) -> tuple[bool, bool]:
        t = str(x).zfill(10)
        return t[0] > "1", t[3] > "1"
    own = kind(int(d))
    return str(f.permuted(int(d), 10**10, b"phone1", lambda x: kind(x) == own, back)).zfill(10)


def national(f: Feistel, s: str, back: bool) -> str:
    """Ten digits of the +1 plan without +1, in groups of 3, 3 and 4: the same number as with it."""
    return respelt(s, _ten(f, _digits(s), back))


def _told(x: int) -> bool:
    """An IPv6 address whose text cannot be taken for words with colons between them."""
    s = str(ipaddress.IPv6Address(x))
    return len([g for g in s.split(":") if g]) > 2 and any(c.isdigit() for c in s)


def address6(f: Feistel, s: str, back: bool) -> str | None:
    """IPv6 in any spelling; the result is spelt in the standard way."""
    try:
        x = int(ipaddress.IPv6Address(s))
    except ValueError:
        return None
    return str(ipaddress.IPv6Address(f.permuted(x, 1 << 128, b"ipv6", _told, back))) if _told(x) else None


def address4(f: Feistel, s: str, back: bool) -> str | None:
    """IPv4: four numbers up to 255 without leading zeros."""
    parts = s.split(".")
    if any(int(p) > 255 or str(int(p)) != p for p in parts):
        return None
    x = f.permuted(int.from_bytes(bytes(map(int, parts)), "big"), 1 << 32, b"ipv4", back=back)
    return ".".join(map(str, x.to_bytes(4, "big")))


def social(f: Feistel, s: str, back: bool) -> str | None:
    """ddd-dd-dddd with an area other than 000, 666 and 9xx, and no group or serial of zeros."""
    def valid(x: int) -> bool:
        t = str(x).zfill(9)
        return t[:3] not in ("000", "666") and t[0] != "9" and t[3:5] != "00" and t[5:] != "0000"
    d = _digits(s)
    return respelt(s, str(f.permuted(int(d), 10**9, b"social", valid, back)).zfill(9)) if valid(int(d)) else None


def bank(f: Feistel, s: str, back: bool) -> str | None:
    """IBAN with valid mod-97 check digits, made anew; the country stays, letters stay letters."""
    code = s.replace(" ", "")
    rest = lambda c: int("".join(str(int(x, 36)) for x in c[4:] + c[:2] + c[2:4])) % 97
    if not 15 <= len(code) <= 34 or rest(code) != 1:
        return None
    body = _mixed(f, code[4:], b"iban" + code[:2].encode(), back)
    check = 98 - rest(code[:2] + "00" + body)
    it = iter(code[:2] + f"{check:02d}" + body)
    return "".join(" " if c == " " else next(it) for c in s)


def date(f: Feistel, s: str, back: bool) -> str | None:
    """Year-month-day, day.month.year or month/day/year (day/month/year where only that exists), 1800 to 2199, on the calendar. Widths of day and month stay where they can."""
    a, mark, b, c = re.match(r"(\d+)([-/.])(\d+)[-/.](\d+)$", s).groups()
    order = (0, 1, 2) if len(a) == 4 else (2, 1, 0) if mark != "/" or int(a) > 12 else (2, 0, 1)
    parts = [a, b, c]
    try:
        day = datetime.date(*(int(parts[i]) for i in order)).toordinal()
    except ValueError:
        return None
    if not FIRST_DAY <= day <= LAST_DAY:
        return None
    # where the first number decides between the two slash orders, it must go on doing so
    slash = mark == "/" and len(a) < 4
    clear = order == (2, 1, 0)
    valid = lambda x: not slash or (datetime.date.fromordinal(x + FIRST_DAY).day > 12 if clear else True)
    tweak = b"date/" if slash and clear else b"date"
    new = datetime.date.fromordinal(f.permuted(day - FIRST_DAY, LAST_DAY - FIRST_DAY + 1, tweak, valid, back) + FIRST_DAY)
    out = ["", "", ""]
    for i, v in zip(order, (new.year, new.month, new.day)):
        out[i] = str(v).zfill(len(parts[i]) if len(parts[i]) > 1 else 1)
    return mark.join(out)


def _mixed(f: Feistel, text: str, tweak: bytes, back: bool) -> str:
    """Digits, lower-case and upper-case ASCII letters permuted together, each within its kind."""
    kinds = ["0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"]
    of = [next((k for k in kinds if c in k), "") for c in text]
    size, value = 1, 0
    for c, k in zip(text, of):
        if k:
            size, value = size * len(k), value * len(k) + k.index(c)
    shape = "".join("0aA"[kinds.index(k)] if k else c for c, k in zip(text, of))
    value, out = f.permuted(value, size, tweak + shape.encode(), back=back), []
    for c, k in zip(reversed(text), reversed(of)):
        if k:
            value, i = divmod(value, len(k))
            c = k[i]
        out.append(c)
    return "".join(reversed(out))


def email(f: Feistel, s: str, back: bool) -> str | None:
    """The name before the @; the domain stays."""
    name, domain = s.rsplit("@", 1)
    return f"{_mixed(f, name, b'email' + domain.lower().encode(), back)}@{domain}"


KINDS = {"email": email, "iban": bank, "phone": phone, "date": date, "ipv4": address4, "ipv6": address6, "national": national, "social": social, "card": card}
#: One pass; every alternative begins where nothing of its own kind precedes, so that long runs are read once.
FOUND = re.compile(r"""
    (?P<email>(?<![\w.+%-])[\w.+%-]++@[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?(?:\.[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?)+)
  | (?P<iban>(?<!\w)[A-Z]{2}\d\d(?:[ ]?[A-Z0-9]){11,30}(?!\w))
  | (?P<phone>(?<!\w)\+\d(?:[ ().-]{0,3}\d){7,14}(?!\d))
  | (?P<ipv6>(?<![\w:.])[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{0,4}){2,7}(?![\w:]|\.\d))
  | (?<![\w.+-])(?:
      (?P<date>\d{4}-\d\d?-\d\d?(?![\w-])|\d{4}/\d\d?/\d\d?(?![\w/])|\d\d?\.\d\d?\.\d{4}(?!\w|\.\d)|\d\d?/\d\d?/\d{4}(?![\w/])|\d\d?-\d\d?-\d{4}(?![\w-]))
    | (?P<ipv4>\d{1,3}(?:\.\d{1,3}){3}(?!\w|\.\d))
    | (?P<social>\d{3}-\d\d-\d{4}(?![\w-]))
    | (?P<national>(?:\([2-9]\d\d\)[ ]?|[2-9]\d\d[.-])[2-9]\d\d[.-]\d{4}(?![\w-]|\.\d))
    | (?P<card>\d(?:[ -]?\d){12,18}(?!\d)))
""", re.X)
PHONE = re.compile(r"\+1[ .-]?\(?\d{3}\)?[ .-]?\d{3}[ .-]?\d{4}(?!\d)")


class Pseudonymiser:
    def __init__(self, key: bytes, most: int = 50_000):
        self.feistel, self.known = Feistel(key), lru_cache(most)(self._one)

    def _one(self, kind: str, value: str, back: bool) -> str | None:
        return KINDS[kind](self.feistel, value, back)

    def _spellings(self, kind: str, value: str) -> Iterator[str]:
        """The whole run first, then shorter ones that end before a separator, as a number can have others beside it."""
        yield value
        if kind == "phone" and (m := PHONE.match(value)):
            yield m[0]
        if kind in ("card", "phone", "iban"):
            for i in range(len(value) - 1, 7, -1):
                if value[i] in " -":
                    yield value[:i]

    def replace(self, text: str, back: bool = False) -> tuple[str, list[str]]:
        """(text with pseudonyms, kinds replaced)."""
        out, at, kinds = [], 0, []
        while m := FOUND.search(text, at):
            kind, end = m.lastgroup, m.end()
            tries = sorted(self._spellings(kind, m[0]), key=lambda s: not (kind == "phone" and PHONE.fullmatch(s)))
            for s in tries:
                new = self.known(kind, s, back)
                if new is not None:
                    out += [text[at:m.start()], new]
                    end = m.start() + len(s)
                    kinds.append(kind)
                    break
            else:
                end = m.start() + 1
                while end < len(text) and (text[end].isalnum()):
                    end += 1  # the rest of a refused run begins no value
                out.append(text[at:end])
            at = end
        out.append(text[at:])
        return "".join(out), kinds


def pseudonyms(docs: DataFrame, key: bytes, back: bool = False) -> DataFrame:
    """(doc_id, text, n_values, kinds) for every row of docs (doc_id, text); kinds maps each kind found to its number.

    back: undoes it with the same key. Null texts stay null with no values; empty texts stay empty. Row-wise, so repeated rows, ids and null ids are
    no matter; other columns are ignored. Invalid numbers (a failed checksum, a day that does not exist) stay as they are.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Pseudonymiser(key)
        for batch in slices(batches):
            there = batch.column("text").is_valid().to_pylist()
            got = [own.replace(t.decode("utf-8", "replace"), back) for t in texts(batch)]
            kinds = [sorted((k, g.count(k)) for k in set(g)) for _, g in got]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([t if ok else None for (t, _), ok in zip(got, there)], pa.string()), pa.array([len(g) for _, g in got], pa.int64()), pa.array(kinds, pa.map_(pa.string(), pa.int64()))], ["doc_id", "text", "n_values", "kinds"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, text string, n_values long, kinds map<string,bigint>")
