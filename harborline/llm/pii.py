"""Format-preserving pseudonyms for personal data.

Candidates are found in the whole text and validated: payment cards by Luhn's check digit,
bank accounts (IBAN) modulo 97, social security numbers by their ranges (without separators only after their
name), IPv4 addresses by their octets (a version number is none) and IPv6 addresses by their groups, phone numbers by their
length, their country or trunk prefix or the ranges of ten-digit numbers, dates by the calendar, e-mail addresses by
their shape, and secrets that follow a keyword or have a known form: access key ids, tokens with a prefix, bearer
tokens and private keys in PEM armour. A secret after a keyword has a digit and 12 characters or more; shorter ones and plain words stay. Of an account or phone number that does not validate
the beginnings up to a blank are tried, longest first, since a word or number may follow it; after a card or
account number that does not validate the search goes on at its next group. What does not validate stays as it is.

A valid value is numbered within its format, the number is permuted by a keyed Feistel
network with cycle walking, and the result is written back in the same layout: the
same separators, letter case, number of digits, and a valid check digit. The permutation
has no fixed point (it is a shift seen through the Feistel permutation), so no value is
its own pseudonym; one that is alone in its format, such as ``_@x.com``, stays and is not reported. It depends on the key, the kind and the value alone, so equal values
stay linked across documents, layouts and runs, and the key's owner can invert it.

Only the text passes through Python, inside the tasks that read it; nothing is shuffled.

Defined results: null texts stay null and have no spans; texts without personal data come
back byte for byte; an IPv6 address comes back in its shortest form; where candidates overlap, the kind that is named first above wins;
other columns, repeated rows and empty tables pass through unchanged. Slashed dates are read
month first if that is a date, else day first. Letters of an address outside
ASCII are replaced by ASCII ones, which is the only step that cannot be inverted.
"""

from __future__ import annotations

import datetime
import ipaddress
import re
from bisect import bisect_left
from collections.abc import Callable, Iterator
from functools import lru_cache
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harborline.llm.frames import packed

ROUNDS = 8
CHUNK = 512  # characters of a secret that are one number
DEMO_KEY = b"replace this key"
FIRST_DAY = datetime.date(1900, 1, 1).toordinal()
DAYS = datetime.date(2100, 1, 1).toordinal() - FIRST_DAY
MONTHS = ("january february march april may june july august september october november december").split()


class Permutation:
    """A keyed permutation without fixed points of the numbers under ``size``, one per kind and size."""

    def __init__(self, key: bytes, kind: str, size: int):
        self.key, self.size = key, size
        self.tweak = f"{kind}|{size}|".encode()
        self.half = max(1, ((size - 1).bit_length() + 1) // 2)
        self.mask = (1 << self.half) - 1
        self.shift = 1 + self._mixed(ROUNDS, 0, 1 << 62) % (size - 1) if size > 1 else 0

    def _mixed(self, turn: int, value: int, size: int | None = None) -> int:
        data = self.tweak + bytes([turn]) + value.to_bytes(self.half // 8 + 1, "big")
        need, out = (self.half + 7) // 8 if size is None else 8, b""
        while len(out) < need:
            out += blake2b(data + len(out).to_bytes(4, "big"), key=self.key).digest()
        return int.from_bytes(out[:need], "big")

    def _network(self, number: int, turns: range, back: bool) -> int:
        while True:
            left, right = number >> self.half, number & self.mask
            for turn in turns:
                if back:
                    left, right = right ^ (self._mixed(turn, left) & self.mask), left
                else:
                    left, right = right, left ^ (self._mixed(turn, right) & self.mask)
            number = left << self.half | right
            if number < self.size:  # cycle walking
                return number

    def __call__(self, number: int, back: bool = False) -> int:
        if self.size < 2:
            return number
        placed = self._network(number, range(ROUNDS), False)
        placed = (placed + (-self.shift if back else self.shift)) % self.size
        return self._network(placed, range(ROUNDS - 1, -1, -1), True)


def luhn(digits: str) -> int:
    """The check digit that completes ``digits``."""
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (2 if place % 2 == 0 else 1)
        total += value - 9 * (value > 9)
    return -total % 10


def _relaid(layout: str, digits: str, kept: str = "") -> str:
    """``digits`` in the places of the digits of ``layout``; characters in ``kept`` also take one."""
    following = iter(digits)
    return "".join(next(following) if c.isdigit() or c in kept else c for c in layout)


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _mixed_radix(text: str, permuted: Callable[[str, int, int], int], kind: str, hexadecimal: bool = False) -> str:
    """Permute the letters and digits of ``text`` together, each within its class; case stays."""
    low = text.lower()
    radix = [16 if hexadecimal and c in "0123456789abcdef" else 10 if "0" <= c <= "9" else 26 if c.isalpha() else 1
             for c in low]
    number, size = 0, 1
    for c, r in zip(low, radix):
        value = int(c, 16) if r == 16 else int(c) if r == 10 else (ord(c) - 97) % 26 if r == 26 else 0
        number, size = number * r + value, size * r
    shape = "".join({1: "-", 10: "9", 16: "f", 26: "a"}[r] for r in radix)
    number = permuted(f"{kind}|{shape}", size, number)
    out = []
    for c, r in zip(reversed(text), reversed(radix)):
        number, value = divmod(number, r)
        made = f"{value:x}" if r in (10, 16) else chr(97 + value) if r == 26 else c
        out.append(made.upper() if c.isupper() else made)
    return "".join(reversed(out))


def _email(found: re.Match, permuted) -> str | None:
    local, _, domain = found.group().rpartition("@")
    return _mixed_radix(local, permuted, "email|" + domain.lower()) + "@" + domain


def _iban(found: re.Match, permuted) -> str | None:
    layout = found.group()
    plain = layout.replace(" ", "")
    if not 15 <= len(plain) <= 34 or int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 != 1:
        return None
    body = _mixed_radix(plain[4:], permuted, "iban|" + plain[:2])
    rest = 98 - int("".join(str(int(c, 36)) for c in body + plain[:2] + "00")) % 97
    made = iter(f"{plain[:2]}{rest:02d}{body}")
    return "".join(c if c == " " else next(made) for c in layout)


def _chained(value: str, permuted, kind: str, hexadecimal: bool) -> str:
    """``_mixed_radix`` of ``CHUNK`` characters at a time, each under a digest of the whole value before it."""
    out, seen = [], blake2b(digest_size=8)
    for at in range(0, len(value), CHUNK):
        chunk = value[at:at + CHUNK]
        out.append(_mixed_radix(chunk, permuted, f"{kind}|{seen.hexdigest()}" if at else kind, hexadecimal))
        seen.update(chunk.lower().encode())
    return "".join(out)


def _secret(found: re.Match, permuted) -> str | None:
    value = found.group("value")
    if not any(c.isdigit() for c in value):
        return None
    plain = re.fullmatch(r"[0-9a-f]+|[0-9A-F]+", value) is not None
    made = _chained(value, permuted, "secret", hexadecimal=plain)
    return _named(found, made)


def _card(found: re.Match, permuted) -> str | None:
    digits = _digits(found.group())
    if not 13 <= len(digits) <= 19 or luhn(digits[:-1]) != int(digits[-1]) or not digits.strip("0"):
        return None
    number = permuted(f"card|{digits[0]}", 10 ** (len(digits) - 2), int(digits[1:-1]))
    body = f"{digits[0]}{number:0{len(digits) - 2}d}"
    return _relaid(found.group(), body + str(luhn(body)))


def _named(found: re.Match, made: str) -> str:
    """The match with ``made`` in place of its group ``value``."""
    return found.group()[:found.start("value") - found.start()] + made


def _prefixed(found: re.Match, permuted) -> str | None:
    """A secret with a known form; what precedes its value stays."""
    value = found.group("value")
    return _named(found, _chained(value, permuted, "secret", hexadecimal=False)) if _DIGIT.search(value) else None


def _pem(found: re.Match, permuted) -> str | None:
    made = _chained(found.group("value"), permuted, "pem", hexadecimal=False)
    return _named(found, made) + found.group("end")


def _named_ssn(found: re.Match, permuted) -> str | None:
    digits = found.group("value")
    made = _social(int(digits[:3]), int(digits[3:5]), int(digits[5:]), digits, permuted)
    return None if made is None else _named(found, made)


def _ssn(found: re.Match, permuted) -> str | None:
    return _social(*map(int, re.split("[ -]", found.group())), found.group(), permuted)


def _social(area: int, group: int, serial: int, layout: str, permuted) -> str | None:
    if area in (0, 666) or area >= 900 or not group or not serial:
        return None
    place = area - 1 - (area > 666)  # 898 areas
    number = permuted("ssn", 898 * 99 * 9999, (place * 99 + group - 1) * 9999 + serial - 1)
    rest, serial = divmod(number, 9999)
    place, group = divmod(rest, 99)
    area = place + 1 + (place >= 665)
    return _relaid(layout, f"{area:03d}{group + 1:02d}{serial + 1:04d}")


def _address(found: re.Match, permuted) -> str | None:
    octets = found.group().split(".")
    if _VERSION.search(found.string, max(0, found.start() - 12), found.start()):
        return None
    if any(int(o) > 255 or o != str(int(o)) for o in octets):
        return None
    number = permuted("ip", 1 << 32, int.from_bytes(bytes(map(int, octets)), "big"))
    return ".".join(map(str, number.to_bytes(4, "big")))


def _address6(found: re.Match, permuted) -> str | None:
    text = found.group()
    if text.count(":") < 3 or not _DIGIT.search(text):
        return None
    try:
        place = int(ipaddress.IPv6Address(text))
    except ValueError:
        return None
    # Addresses of so few groups that they would not be found again are left out of the numbers that are permuted.
    first = 1 << 112
    return str(ipaddress.IPv6Address(first + permuted("ip6", (1 << 128) - first, place - first))) if place >= first else None


def _ten(digits: str, permuted) -> str:
    """Ten digits with an area and an exchange from 200 up among such, others among others."""
    area, exchange, line = int(digits[:3]), int(digits[3:6]), int(digits[6:])
    if area >= 200 and exchange >= 200:
        place, line = divmod(permuted("phone|ten", 800 * 800 * 10_000, ((area - 200) * 800 + exchange - 200) * 10_000 + line), 10_000)
        return f"{200 + place // 800:03d}{200 + place % 800:03d}{line:04d}"
    place = area * 1000 + exchange if area < 200 else 200_000 + (area - 200) * 200 + exchange
    place, line = divmod(permuted("phone|other", 360_000 * 10_000, place * 10_000 + line), 10_000)
    area, exchange = divmod(place, 1000) if place < 200_000 else divmod(place - 200_000 + 200 * 200, 200)
    return f"{area:03d}{exchange:03d}{line:04d}"


def _date(found: re.Match, permuted) -> str | None:
    text = found.group()
    parts = {k: v for k, v in found.groupdict().items() if v is not None}
    tries = []
    if "iso_year" in parts:
        tries.append((parts["iso_year"], parts["iso_month"], parts["iso_day"], "ymd"))
    elif "one" in parts:
        if parts["mark"] == "/":
            tries.append((parts["year"], parts["one"], parts["two"], "mdy"))
        tries.append((parts["year"], parts["two"], parts["one"], "dmy"))
    else:
        month = next((i for i, m in enumerate(MONTHS, 1) if (parts.get("name") or parts["name2"]).lower() in (m, m[:3])), 0)
        order = "dMy" if "name" in parts else "Mdy"
        tries.append((parts.get("name_year") or parts["name2_year"], month, parts.get("name_day") or parts["name2_day"], order))
    for year, month, day, order in tries:
        try:
            place = datetime.date(int(year), int(month), int(day)).toordinal() - FIRST_DAY
        except ValueError:
            continue
        if not 0 <= place < DAYS:
            continue
        made = datetime.date.fromordinal(FIRST_DAY + permuted("date", DAYS, place))
        fields = {"y": f"{made.year}", "m": f"{made.month:02d}", "d": f"{made.day:02d}"}
        if "M" not in order:
            mark = parts.get("iso_mark") or parts["mark"]
            return mark.join(fields[c] for c in order)
        name = parts.get("name") or parts["name2"]
        month = MONTHS[made.month - 1][:None if len(name) > 3 or name.lower() == "may" else 3]
        month = month.upper() if name.isupper() else month.capitalize() if name[0].isupper() else month
        day, comma = str(made.day), "," if "," in text else ""
        return f"{day} {month}{comma} {made.year}" if order == "dMy" else f"{month} {day}{comma} {made.year}"
    return None


def _phone(found: re.Match, permuted) -> str | None:
    text = found.group()
    digits = _digits(text)
    country = found.group("country") or ""
    rest = digits[len(country):]
    if not 7 <= len(digits) <= 15 or len(rest) < 6:
        return None
    if not country and found.group("trunk"):
        country, rest = "0", digits[1:]
        if not 9 <= len(rest) <= 10:
            return None
    if not country:
        bracket = text.startswith("(")
        return _relaid(text, _ten(digits, permuted)) if bracket or min(digits[0], digits[3]) >= "2" else None
    number = permuted(f"phone|{country}", 10 ** len(rest), int(rest))
    return _relaid(text, f"{country}{number:0{len(rest)}d}")


_DIGIT = re.compile("[0-9]")
_VERSION = re.compile(r"(?i)\b(?:version|release|ver\.?|v\.?)[ :=]{0,2}$")
_NAMES = "|".join(f"{m}|{m[:3]}" for m in MONTHS)
KINDS: list[tuple[str, re.Pattern, Callable]] = [
    ("secret", re.compile(r"(?P<head>-----BEGIN (?:[A-Z]{2,10} )?PRIVATE KEY-----)(?P<value>[A-Za-z0-9+/=\s]+)"
                          r"(?P<end>-----END (?:[A-Z]{2,10} )?PRIVATE KEY-----)"), _pem),
    ("secret", re.compile(r"(?<![A-Za-z0-9_])(?:AKIA|ASIA)(?P<value>[A-Z0-9]{16})(?![A-Za-z0-9])"), _prefixed),
    ("secret", re.compile(r"(?<![A-Za-z0-9_])(?:gh[pousr]_|github_pat_|xox[abprs]-)(?P<value>[A-Za-z0-9_-]{16,})"), _prefixed),
    ("secret", re.compile(r"\b[Bb]earer (?P<value>[A-Za-z0-9+/_-]{20,}(?:[.=]+[A-Za-z0-9+/_-]+)*)"), _prefixed),
    ("card", re.compile(r"(?<![\w.+])(?:\d{13,19}|\d{4}([ -])\d{4}\1\d{4}\1\d{1,7}|\d{4}([ -])\d{6}\2\d{5})(?!\d)",
                        re.ASCII), _card),
    ("iban", re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?:(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?)(?![A-Za-z0-9])"), _iban),
    ("ssn", re.compile(r"(?<![\w-])\d{3}([ -])\d{2}\1\d{4}(?![\w-])", re.ASCII), _ssn),
    ("ssn", re.compile(r"(?i)\b(?:ssn|social security(?: (?:number|no\.?))?)[ :=#]{1,4}(?P<value>\d{9})(?![\w-])", re.ASCII),
     _named_ssn),
    ("ip", re.compile(r"(?<![\w:.])[0-9A-Fa-f:]{6,39}(?![\w:])", re.ASCII), _address6),
    ("ip", re.compile(r"(?<![\w.])\d{1,3}(?:\.\d{1,3}){3}(?!\.?\d)(?![A-Za-z_])", re.ASCII), _address),
    ("phone", re.compile(r"(?<![\w.])(?:\+(?P<country>\d{1,3})(?:[ .-]?\(\d{1,4}\))?(?:[ .-]?\d{2,4}){2,5}"
                         r"|(?P<trunk>0)[1-9]?\d{1,3}[ -]\d{3,4}[ -]\d{3,4}"
                         r"|(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4})(?!\w)", re.ASCII), _phone),
    ("date", re.compile(rf"(?<![\w./-])(?:(?P<iso_year>\d{{4}})(?P<iso_mark>[-/.])(?P<iso_month>\d\d)(?P=iso_mark)(?P<iso_day>\d\d)"
                        rf"|(?P<one>\d{{1,2}})(?P<mark>[/.-])(?P<two>\d{{1,2}})(?P=mark)(?P<year>\d{{4}})"
                        rf"|(?P<name_day>\d{{1,2}}) (?P<name>{_NAMES}),? (?P<name_year>\d{{4}})"
                        rf"|(?P<name2>{_NAMES}) (?P<name2_day>\d{{1,2}}),? (?P<name2_year>\d{{4}}))(?![\w/-])",
                        re.ASCII | re.IGNORECASE), _date),
    ("email", re.compile(r"(?<![^\s<>()\[\],;:\"'=|])[^\s@<>()\[\],;:\"'=|]{1,64}@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}(?![A-Za-z0-9])"),
     _email),
    ("secret", re.compile(r"(?i)\b(?:token|secret|password|passwd|api[_-]?key|access[_-]?key)\b[\"']?\s{0,4}[=:]\s{0,4}[\"']?"
                          r"(?P<value>(?=[A-Za-z0-9+/_.=-]{12})[A-Za-z0-9+/_-]+(?:[.=]+[A-Za-z0-9+/_-]+)*)"), _secret),
]
SHORTENED = ("iban", "phone")  # kinds of several groups that may take in a word or number that follows
RESUMED = ("card", "iban")  # kinds that may begin at a later group, after a word or number like a first one
_SIGN = re.compile("[0-9@]")


@lru_cache(maxsize=200_000)
def _permuted(key: bytes, kind: str, size: int, number: int) -> int:
    return Permutation(key, kind, size)(number)


def pseudonymised_text(text: str, key: bytes) -> tuple[str, list[tuple[str, int, int]]]:
    """The text with pseudonyms, and kind, start and end of each in the original text."""
    if not _SIGN.search(text):
        return text, []

    def permuted(kind: str, size: int, number: int) -> int:
        return _permuted(key, kind, size, number)

    taken: list[tuple[int, int, str, str]] = []  # sorted and apart from each other
    for kind, pattern, make in KINDS:
        more, at = [], 0
        while found := pattern.search(text, at):
            start, end = found.span()
            place = bisect_left(taken, (start,))
            if place and taken[place - 1][1] > start:
                at = taken[place - 1][1]
                continue
            limit = taken[place][0] if place < len(taken) else len(text)
            at = end
            if kind == "secret" and end > limit:
                found = pattern.match(text, start, limit)
                if found is None:
                    continue
                end = found.end()
            blanks = [i for i in range(end - 1, start, -1) if text[i] == " "] if kind in SHORTENED else []
            for stop in [end, *blanks]:
                part = found if stop == end else pattern.fullmatch(text, start, stop)
                made = make(part, permuted) if part and stop <= limit else None
                if made is not None and made == part.group():
                    break  # alone in its format
                if made is not None:
                    more.append((start, stop, kind, made))
                    at = stop
                    break
            else:
                if kind in RESUMED:
                    at = next((i for i in range(start + 1, end) if text[i] in " -"), end)
        taken = sorted(taken + more)
    out, at = [], 0
    for start, end, _, made in taken:
        out += [text[at:start], made]
        at = end
    return "".join(out) + text[at:], [(kind, start, end) for start, end, kind, _ in taken]


SPANS = T.ArrayType(T.StructType().add("kind", "string").add("start", "integer").add("end", "integer"))


def pseudonymised(docs: DataFrame, key: bytes = DEMO_KEY, text_column: str = "text", out: str = "pseudonymised",
                  spans: str = "spans") -> DataFrame:
    """Add the text with pseudonyms, and the spans (kind, start, end) it replaces, to all columns."""
    span_type = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, found = [], []
            for value in batch.column("_text"):
                text = value.as_py()
                made, where = (None, []) if text is None else pseudonymised_text(text, key)
                texts.append(made)
                found.append([{"kind": k, "start": s, "end": e} for k, s, e in where])
            yield pa.RecordBatch.from_arrays(
                [batch.column("_row"), pa.array(texts, pa.string()), pa.array(found, span_type)],
                names=["_row", "_made", "_spans"])

    rows = packed(docs, _text=F.col(text_column).cast("string"))
    schema = T.StructType([rows.schema["_row"]]).add("_made", "string").add("_spans", SPANS)
    return rows.mapInArrow(run, schema).select("_row.*", F.col("_made").alias(out), F.col("_spans").alias(spans))
