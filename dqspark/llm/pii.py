"""Format-preserving pseudonyms for personal data.

Values found in a text are validated (Luhn for cards, mod 97 for IBANs, octets
for IPv4, issued ranges for SSNs, the calendar for dates) and then permuted
within their own format by a keyed Feistel network: the value becomes a number
below the size of its format's domain, the network permutes a product of two
ranges that covers the domain, and numbers outside it are permuted again until
they fall inside (cycle walking).  Check digits are made anew, separators and
letter case stay.  The permutation depends on the key and the kind alone, so a
value has the same pseudonym in every document, different values have
different ones, and the holder of the key can invert it.  A date has one
pseudonym in all its notations: days up to the 12th are permuted among
themselves and so are the others, so that 03/04/2020 and 25/12/2020 are read in
the same order afterwards.

The key is the caller's.  ``session_key`` is what the registered query and the
pipeline use: the text of ``spark.dqspark.pii.secret``, or else a random key
drawn for the session, whose pseudonyms nobody can invert after it.

Kinds: card, iban, ssn, phone, ip, date (1900-2099), email (letters and digits
of the local part), secret (letters and digits after ``password=`` and the
like, and of well-known token prefixes).  Everything else stays as it is,
byte for byte.

Defined results: a null text stays null, an empty one empty, with no values;
rows are independent, so repeated rows get equal results; an empty table gives
an empty result; other columns are kept by ``pseudonymise``.
"""

from __future__ import annotations

import datetime
import hashlib
import re
import secrets
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dqspark.llm.common import prepare

ROUNDS = 8
KEY_NAME = "spark.dqspark.pii.secret"      # a name that Spark redacts where it shows settings
FIRST_DAY = datetime.date(1900, 1, 1).toordinal()
DAYS = datetime.date(2100, 1, 1).toordinal() - FIRST_DAY


class Feistel:
    """A keyed permutation of 0 .. size - 1 for any size."""

    def __init__(self, key: bytes, kind: str, size: int):
        self.size = size
        self.b = max(1, int(size ** 0.5) if size < 1 << 52 else 1 << ((size - 1).bit_length() // 2))
        self.a = -(-size // self.b)
        self.person = hashlib.blake2b(f"{kind}:{size}".encode(), key=key[:64], digest_size=32).digest()

    def _round(self, i: int, x: int, size: int) -> int:
        raw = x.to_bytes((x.bit_length() + 7) // 8 or 1, "big")
        return int.from_bytes(hashlib.blake2b(bytes([i]) + raw, key=self.person, digest_size=32).digest(), "big") % size

    def _once(self, x: int) -> int:
        left, right = divmod(x, self.b)
        for i in range(0, ROUNDS, 2):
            left = (left + self._round(i, right, self.a)) % self.a
            right = (right + self._round(i + 1, left, self.b)) % self.b
        return left * self.b + right

    def _back(self, x: int) -> int:
        left, right = divmod(x, self.b)
        for i in reversed(range(0, ROUNDS, 2)):
            right = (right - self._round(i + 1, left, self.b)) % self.b
            left = (left - self._round(i, right, self.a)) % self.a
        return left * self.b + right

    def apply(self, x: int) -> int:
        x = self._once(x)
        while x >= self.size:
            x = self._once(x)
        return x

    def invert(self, x: int) -> int:
        x = self._back(x)
        while x >= self.size:
            x = self._back(x)
        return x


def _radix(c: str) -> tuple[int, int]:
    """First code and size of the class of a character that is permuted within its class."""
    if "0" <= c <= "9":
        return 48, 10
    return (97, 26) if "a" <= c <= "z" else (65, 26)


def permute_characters(text: str, kind: str, key: bytes, invert: bool = False) -> str:
    """Permute the ASCII letters and digits of ``text`` within their classes; the rest stays."""
    at = [i for i, c in enumerate(text) if c.isascii() and c.isalnum()]
    if not at:
        return text
    shape = "".join("9" if text[i].isdigit() else "a" if text[i].islower() else "A" for i in at)
    number, size = 0, 1
    for i in at:
        base, radix = _radix(text[i])
        number, size = number * radix + ord(text[i]) - base, size * radix
    f = Feistel(key, f"{kind}/{shape}", size)
    number = f.invert(number) if invert else f.apply(number)
    out = list(text)
    for i in reversed(at):
        base, radix = _radix(text[i])
        number, digit = divmod(number, radix)
        out[i] = chr(base + digit)
    return "".join(out)


def luhn_digit(payload: str) -> str:
    total = 0
    for i, c in enumerate(reversed(payload)):
        d = int(c) * (2 if i % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return str(-total % 10)


def _refill(template: str, digits: str) -> str:
    """``template`` with its digits replaced in order."""
    it = iter(digits)
    return "".join(next(it) if c.isdigit() else c for c in template)


def _digits(s: str) -> str:
    return "".join(c for c in s if c.isdigit())


def _card(s: str, key: bytes, invert: bool) -> str | None:
    d = _digits(s)
    if not 13 <= len(d) <= 19 or len(set(d)) == 1 or luhn_digit(d[:-1]) != d[-1]:
        return None
    body = d[0] + permute_characters(d[1:-1], "card" + d[0], key, invert)
    return _refill(s, body + luhn_digit(body))


def _iban_check(country: str, rest: str) -> str:
    number = "".join(str(int(c, 36)) for c in rest + country + "00")
    return f"{98 - int(number) % 97:02d}"


def _iban(s: str, key: bytes, invert: bool) -> str | None:
    plain = s.replace(" ", "")
    country, check, rest = plain[:2], plain[2:4], plain[4:]
    if _iban_check(country, rest) != check:
        return None
    rest = permute_characters(rest, "iban" + country, key, invert)
    it = iter(country + _iban_check(country, rest) + rest)
    return "".join(c if c == " " else next(it) for c in s)


def _ssn_number(s: str) -> int | None:
    area, group, serial = int(s[:3]), int(s[4:6]), int(s[7:])
    if area in (0, 666) or area >= 900 or group == 0 or serial == 0:
        return None
    return ((area - 1 - (area > 666)) * 99 + group - 1) * 9999 + serial - 1


def _ssn(s: str, key: bytes, invert: bool) -> str | None:
    number = _ssn_number(s)
    if number is None:
        return None
    f = Feistel(key, "ssn", 898 * 99 * 9999)
    number, serial = divmod(f.invert(number) if invert else f.apply(number), 9999)
    area, group = divmod(number, 99)
    return f"{area + 1 + (area >= 665):03d}-{group + 1:02d}-{serial + 1:04d}"


def _phone(s: str, key: bytes, invert: bool) -> str | None:
    d = _digits(s)
    if not 10 <= len(d) <= 15:
        return None
    return _refill(s, d[:-10] + permute_characters(d[-10:], "phone" + d[:-10], key, invert))


def _ip(s: str, key: bytes, invert: bool) -> str | None:
    parts = [int(x) for x in s.split(".")]
    if max(parts) > 255 or any(len(x) > 1 and x[0] == "0" for x in s.split(".")):
        return None
    f, number = Feistel(key, "ip", 1 << 32), int.from_bytes(bytes(parts), "big")
    number = f.invert(number) if invert else f.apply(number)
    return ".".join(map(str, number.to_bytes(4, "big")))


_SLASHES = re.compile(r"(\d{2})/(\d{2})/(\d{4})")
# pattern and places of year, month and day: month first where that is a date, else day first
_DATES = ((re.compile(r"(\d{4})-(\d{2})-(\d{2})"), (0, 1, 2)), (re.compile(r"(\d{4})/(\d{2})/(\d{2})"), (0, 1, 2)),
          (_SLASHES, (2, 0, 1)), (_SLASHES, (2, 1, 0)), (re.compile(r"(\d{2})\.(\d{2})\.(\d{4})"), (2, 1, 0)))
MONTHS = 12


def _date(s: str, key: bytes, invert: bool) -> str | None:
    for pattern, (y, m, d) in _DATES:
        found = pattern.fullmatch(s)
        if not found:
            continue
        parts = [int(x) for x in found.groups()]
        try:
            day = datetime.date(parts[y], parts[m], parts[d])
        except ValueError:
            continue
        number = day.toordinal() - FIRST_DAY
        if not 0 <= number < DAYS:
            continue
        month_like = day.day <= MONTHS      # a day that may be read as a month stays one, all others never become one
        f = Feistel(key, f"date{month_like}", DAYS)
        while True:         # cycle walking within the days of the same class
            number = f.invert(number) if invert else f.apply(number)
            new = datetime.date.fromordinal(FIRST_DAY + number)
            if (new.day <= MONTHS) == month_like:
                break
        parts[y], parts[m], parts[d] = new.year, new.month, new.day
        return _refill(s, "".join(f"{x:0{len(g)}d}" for x, g in zip(parts, found.groups(), strict=True)))
    return None


def _email(s: str, key: bytes, invert: bool) -> str:
    local, at, domain = s.rpartition("@")
    return permute_characters(local, "email@" + domain.lower(), key, invert) + at + domain


def _secret(s: str, key: bytes, invert: bool) -> str:
    named = _NAMED.match(s) or _TOKEN_PREFIX.match(s)
    head = named.group(0) if named else ""
    body = s[len(head):]
    if re.fullmatch(r"[0-9a-f]{8,}", body):         # hexadecimal stays hexadecimal
        f = Feistel(key, "hex", 16 ** len(body))
        return head + f"{(f.invert if invert else f.apply)(int(body, 16)):0{len(body)}x}"
    return head + permute_characters(body, "secret" + head.lower(), key, invert)


_NAME = r"(?:password|passwd|pwd|secret|token|api[_-]?key|access[_-]?key|auth)"
_NAMED = re.compile(rf"(?i){_NAME}\s?[=:]\s?[\"']?")
_TOKEN_PREFIX = re.compile(r"AKIA|ASIA|ghp_|gho_|ghs_|sk-|sk_live_|xox[bp]-|AIza")

KINDS: tuple[tuple[str, str, Callable[[str, bytes, bool], str | None]], ...] = (
    ("email", r"[A-Za-z0-9][A-Za-z0-9._%+-]*@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}", _email),
    ("secret", rf"(?i:\b{_NAME}\s?[=:]\s?[\"']?[A-Za-z0-9_\-+/]{{6,}})"
               r"|\b(?:(?:AKIA|ASIA)[A-Z0-9]{12,}|gh[pos]_[A-Za-z0-9]{20,}|sk[-_](?:live_)?[A-Za-z0-9]{16,}"
               r"|xox[bp]-[A-Za-z0-9-]{10,}|AIza[A-Za-z0-9_-]{30,})", _secret),
    ("iban", r"\b[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b", _iban),
    ("date", r"(?<![\d./-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{4}/[0-9]{2}/[0-9]{2}|[0-9]{2}/[0-9]{2}/[0-9]{4}"
             r"|[0-9]{2}\.[0-9]{2}\.[0-9]{4})(?![\d/-])", _date),
    ("ip", r"(?<![\d.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?!\.?\d)", _ip),
    ("ssn", r"(?<![\d-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\d-])", _ssn),
    ("card", r"(?<![\d-])[0-9](?:[ -]?[0-9]){12,18}(?![\d-])", _card),
    ("phone", r"(?<![\w+])\+[0-9]{1,3}[ .-]?(?:\([0-9]{2,4}\)|[0-9]{2,4})(?:[ .-]?[0-9]{2,4}){2,4}(?!\d)"
              r"|(?<![\w(])\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}(?!\d)"
              r"|(?<![\w.-])[0-9]{3}[.-][0-9]{3}[.-][0-9]{4}(?![\d-])", _phone),
)
_FOUND = re.compile("|".join(f"(?P<{name}>{pattern})" for name, pattern, _ in KINDS))
_MAKE = {name: make for name, _, make in KINDS}
_MAY = re.compile(r"[0-9@=:]|sk[-_]|gh[pos]_|AKIA|ASIA|AIza|xox")


def replace(text: str, key: bytes, invert: bool = False) -> tuple[str, dict[str, int]]:
    """The text with pseudonyms, and how many values of each kind were replaced."""
    counts: dict[str, int] = {}
    if not _MAY.search(text):
        return text, counts
    out, at = [], 0
    pos = 0
    while found := _FOUND.search(text, pos):
        kind, value = found.lastgroup, found.group(0)
        new = _MAKE[kind](value, key, invert)
        if new is None:             # not valid: look again one place further, for other kinds too
            pos = found.start() + 1
            new = _other(text, found, key, invert)
            if new is None:
                continue
            kind, value, new = new
        out += [text[at:found.start()], new]
        at = pos = found.start() + len(value)
        counts[kind] = counts.get(kind, 0) + 1
    out.append(text[at:])
    return "".join(out), counts


_EACH = [(name, re.compile(pattern)) for name, pattern, _ in KINDS]


def _other(text: str, failed: re.Match, key: bytes, invert: bool) -> tuple[str, str, str] | None:
    """A valid value of another kind at the same place."""
    for name, pattern in _EACH:
        if name != failed.lastgroup and (found := pattern.match(text, failed.start())):
            new = _MAKE[name](found.group(0), key, invert)
            if new is not None:
                return name, found.group(0), new
    return None


def session_key(spark: SparkSession) -> bytes:
    """The key set for the session; a random one is set where there is none."""
    if not spark.conf.get(KEY_NAME, ""):
        spark.conf.set(KEY_NAME, secrets.token_hex(32))
    return spark.conf.get(KEY_NAME).encode()


def pseudonymise(docs: DataFrame, key: bytes) -> DataFrame:
    """``docs`` with pseudonyms in ``text`` (all columns kept) and the number of values in ``pii_values``."""
    prepare(docs.sparkSession)
    rest = [c for c in docs.columns if c != "pii_values"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, values = [], []
            for text in batch.column("text").to_pylist():
                new, counts = (None, {}) if text is None else replace(text, key)
                texts.append(new)
                values.append(sum(counts.values()))
            at = batch.schema.get_field_index("text")
            columns = list(batch.columns)
            columns[at] = pa.array(texts, batch.schema.field(at).type)
            yield pa.RecordBatch.from_arrays([*columns, pa.array(values, pa.int32())],
                                             names=[*batch.schema.names, "pii_values"])
    slim = docs.select(*rest)
    return slim.mapInArrow(run, type(slim.schema)(list(slim.schema.fields)).add("pii_values", "integer"))


def pseudonyms(docs: DataFrame, key: bytes) -> DataFrame:
    """doc_id, text with pseudonyms, number of values and digest of every document."""
    return pseudonymise(docs.select("doc_id", "text"), key).select(
        "doc_id", "text", "pii_values", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("text_sha256"))
