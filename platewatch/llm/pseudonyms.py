"""Format-preserving pseudonyms for personal data in texts.

Each kind of value has a pattern, a validity rule and a numbering of its valid values.  A valid
value's number goes through a keyed Feistel permutation of all numbers of its format and
is written back in the same shape, so pseudonyms are valid values too, equal values get equal
pseudonyms in all documents, and numbers that fail the rule stay as they are.
"""

import datetime
import ipaddress
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from platewatch.llm.common import free_name
from platewatch.llm.feistel import permute

KEY = b"change me per corpus"

_PATTERN = re.compile(
    r"""
    (?P<email>(?<![\w.+-])[A-Za-z0-9][\w.+-]*@[\w-]+(?:\.[\w-]+)*\.[A-Za-z]{2,})
  | (?P<secret>(?:token|secret|password|passwd|api[_-]?key)["']?\s*[=:]\s*["']?[0-9a-f]{16,}(?![0-9A-Za-z]))
  | (?P<iban>(?<![0-9A-Za-z])[A-Z]{2}\d{2}(?:\x20?[A-Z0-9]){11,30}(?![0-9A-Za-z]))
  | (?P<phone>(?<![\w+])\+1[\x20.-]?(?:\(\d{3}\)|\d{3})[\x20.-]?\d{3}[\x20.-]?\d{4}(?!\d)
      | (?<![\w+])\+(?!1[\x20.(-])\d{1,3}[\x20.-]?(?:\(\d{1,4}\)|\d{1,4})(?:[\x20.-]?\d{2,4}){2,6}(?!\d|\.\d)
      | (?<![\w(])\(\d{3}\)[\x20.-]?\d{3}[\x20.-]\d{4}(?!\d)
      | (?<![\w.+-])[2-9]\d\d(?P<mark>[.-])\d{3}(?P=mark)\d{4}(?![\w-]|\.\d))
  | (?P<date>(?<![\w.-])(?:\d{4}-\d{2}-\d{2}|\d{1,2}/\d{1,2}/\d{4}|\d{1,2}\.\d{1,2}\.\d{4})(?![\w-]|\.\d))
  | (?P<ssn>(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-]))
  | (?P<ip>(?<![\w.])\d{1,3}(?:\.\d{1,3}){3}(?!\w|\.\d))
  | (?P<ipv6>(?<![\w:.])(?:[0-9A-Fa-f]{0,4}:){2,7}[0-9A-Fa-f]{0,4}(?![\w:]|\.\d))
  | (?P<card>(?<![\w.-])(?:\d{13,19}|\d{4}(?:(?:\x20\d{4}){2}\x20\d{1,7}|(?:-\d{4}){2}-\d{1,7}|\x20\d{6}\x20\d{5}|-\d{6}-\d{5}))(?![\w-]))
    """,
    re.VERBOSE,
)
# Characters of an IBAN by country, as registered.
IBAN_LENGTHS = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22, "BR": 29, "BY": 28, "CH": 21,
    "CR": 22, "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "DO": 28, "EE": 20, "EG": 29, "ES": 24, "FI": 18, "FO": 18, "FR": 27,
    "GB": 22, "GE": 22, "GI": 23, "GL": 18, "GR": 27, "GT": 28, "HR": 21, "HU": 28, "IE": 22, "IL": 23, "IQ": 23, "IS": 26,
    "IT": 27, "JO": 30, "KW": 30, "KZ": 20, "LB": 28, "LC": 32, "LI": 21, "LT": 20, "LU": 20, "LV": 21, "LY": 25, "MC": 27,
    "MD": 24, "ME": 22, "MK": 19, "MR": 27, "MT": 31, "MU": 30, "NL": 18, "NO": 15, "PK": 24, "PL": 28, "PS": 29, "PT": 25,
    "QA": 29, "RO": 24, "RS": 22, "SA": 24, "SC": 31, "SE": 24, "SI": 19, "SK": 24, "SM": 27, "ST": 25, "SV": 28, "TL": 23,
    "TN": 24, "TR": 26, "UA": 29, "VA": 22, "VG": 24, "XK": 20,
}
_TRIGGER = re.compile(r"[0-9@]")
_FIRST_DAY = datetime.date(1900, 1, 1).toordinal()
_DAYS = datetime.date(2100, 1, 1).toordinal() - _FIRST_DAY
_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))


def luhn_digit(payload: str) -> str:
    """The check digit that makes the number valid."""
    doubled = (int(d) * (2 if i % 2 == 0 else 1) for i, d in enumerate(reversed(payload)))
    return str(-sum(d - 9 if d > 9 else d for d in doubled) % 10)


def _iban_check(country: str, account: str) -> str:
    number = int("".join(str(int(c, 36)) for c in account + country + "00"))
    return f"{98 - number % 97:02d}"


def _refill(shape: str, characters: str) -> str:
    """The characters put in place of the letters and digits of a shape, separators kept."""
    feed = iter(characters)
    return "".join(next(feed) if c.isalnum() else c for c in shape)


def _scramble(text: str, key: bytes, kind: str) -> str:
    """Permute ASCII letters among letters of their case and digits among digits; the rest stays."""
    bases = [(10, 48) if c.isdigit() else (26, 97) if c.islower() else (26, 65) if c.isupper() else None
             for c in text if c.isascii() and c.isalnum()]
    plain = [c for c in text if c.isascii() and c.isalnum()]
    number, size = 0, 1
    for (base, first), c in zip(bases, plain):
        number, size = number * base + ord(c) - first, size * base
    # The pattern of letters and digits is part of the format, so equal formats share one permutation.
    tweak = (kind + "".join("d" if b == (10, 48) else "l" if b[1] == 97 else "u" for b in bases)).encode()
    number = permute(number, size, key, tweak)
    made = []
    for base, first in reversed(bases):
        number, digit = divmod(number, base)
        made.append(chr(first + digit))
    feed = iter(reversed(made))
    return "".join(next(feed) if c.isascii() and c.isalnum() else c for c in text)


def _card(value, key):
    digits = re.sub(r"\D", "", value)
    if luhn_digit(digits[:-1]) != digits[-1] or set(digits) == {"0"}:
        return None
    payload = _scramble(digits[:-1], key, "card")
    return _refill(value, payload + luhn_digit(payload))


def _iban(value, key):
    joined = value.replace(" ", "")
    country, account = joined[:2], joined[4:]
    if len(joined) != IBAN_LENGTHS.get(country, len(joined)) or _iban_check(country, account) != joined[2:4]:
        return None
    account = _scramble(account, key, f"iban{country}")
    return _refill(value, country + _iban_check(country, account) + account)


def _ssn(value, key):
    area, group, serial = map(int, value.split("-"))
    if area in (0, 666) or area >= 900 or not group or not serial:
        return None
    place = area - 1 - (area > 666)
    number = permute((place * 99 + group - 1) * 9999 + serial - 1, 898 * 99 * 9999, key, b"ssn")
    number, serial = divmod(number, 9999)
    place, group = divmod(number, 99)
    area = place + 1 + (place >= 665)
    return f"{area:03d}-{group + 1:02d}-{serial + 1:04d}"


def _phone(value, key):
    if not 8 <= sum(c.isdigit() for c in value) <= 15:
        return None
    if value[0].isdigit():
        # Without a country code the first digit is 2 to 9.
        digits = re.sub(r"\D", "", value)
        number = permute(int(digits) - 2 * 10**9, 8 * 10**9, key, b"phone10")
        return _refill(value, str(number + 2 * 10**9))
    # The country code stays.
    head = re.match(r"\+\d{1,3}(?=[\x20.-]|\()[\x20.-]?|\+\d|", value)[0]
    return head + _scramble(value[len(head) :], key, "phone")


def _ip(value, key):
    parts = [int(p) for p in value.split(".")]
    if max(parts) > 255 or any(len(p) > 1 and p[0] == "0" for p in value.split(".")):
        return None
    number = permute(int.from_bytes(bytes(parts), "big"), 1 << 32, key, b"ip")
    return ".".join(map(str, number.to_bytes(4, "big")))


def _ipv6(value, key):
    try:
        number = int(ipaddress.IPv6Address(value))
    except ValueError:
        return None
    # The unspecified and the local address, and words such as abc::def, say nothing about anybody.
    if number < 2 or not re.search(r"[0-9]", value):
        return None
    return str(ipaddress.IPv6Address(permute(number, 1 << 128, key, b"ipv6")))


def _date(value, key):
    mark = next(c for c in value if not c.isdigit())
    parts = [int(p) for p in value.split(mark)]
    orders = [(0, 1, 2)] if mark == "-" else [(2, 1, 0), (2, 0, 1)]  # day first where both are possible
    for order in orders:
        try:
            day = datetime.date(*(parts[i] for i in order)).toordinal() - _FIRST_DAY
        except ValueError:
            continue
        if not 0 <= day < _DAYS:
            return None
        made = datetime.date.fromordinal(permute(day, _DAYS, key, b"date") + _FIRST_DAY)
        fields = dict(zip(order, (f"{made.year:04d}", f"{made.month:02d}", f"{made.day:02d}")))
        return mark.join(fields[i] for i in range(3))
    return None


def _email(value, key):
    local, _, domain = value.rpartition("@")
    return f"{_scramble(local, key, 'email')}@{domain}"


def _secret(value, key):
    plain = re.search(r"[0-9a-f]{16,}$", value)[0]
    number = permute(int(plain, 16), 16 ** len(plain), key, b"secret")
    return value[: -len(plain)] + f"{number:0{len(plain)}x}"


_KINDS = {"email": _email, "secret": _secret, "iban": _iban, "phone": _phone, "date": _date, "ssn": _ssn, "ip": _ip, "ipv6": _ipv6, "card": _card}
# Kinds made of groups: what follows after a space or mark may belong to the text.
_GROUPED = ("iban", "phone")


def _ends(kind: str, value: str):
    """The value, then what is left of one of a grouped kind without its last groups."""
    yield value
    if kind in _GROUPED:
        for match in reversed(list(re.finditer(r"(?<=[0-9A-Z])[\x20.-]", value))):
            yield value[: match.start()]


def pseudonymise(text: str | None, key: bytes = KEY) -> tuple[str | None, list[dict]]:
    """The text with pseudonyms, and the kind and place (in the new text) of each."""
    if not text or not _TRIGGER.search(text):
        return text, []
    pieces, spans, done, size = [], [], 0, 0
    at = 0
    while match := _PATTERN.search(text, at):
        kind = next(k for k in _KINDS if match[k] is not None)
        value, new = next(((v, made) for v in _ends(kind, match[0]) if (made := _KINDS[kind](v, key))), (None, None))
        if new is None:
            # What fails one rule may begin another value further on, but not inside the same digits.
            at = re.compile(r"[0-9]*").match(text, match.start() + 1).end()
            continue
        pieces += [text[done : match.start()], new]
        size += match.start() - done
        spans.append({"kind": kind, "start": size, "end": size + len(new)})
        size += len(new)
        done = at = match.start() + len(value)
    return "".join([*pieces, text[done:]]), spans


def with_pseudonyms(docs: DataFrame, text: str = "text", key: bytes = KEY) -> DataFrame:
    """All rows with the text column replaced, and a column spans (kind, start, end in code points).

    Null texts stay null and have no spans.  A taken name ``spans`` gets a trailing underscore.
    """
    made, spans = free_name(docs, "_made"), free_name(docs, "spans")
    return docs.withColumn(made, _column(F.col(text), key)).withColumns(
        {text: F.col(f"{made}.text"), spans: F.col(f"{made}.spans")}
    ).drop(made)


def _column(text: Column, key: bytes) -> Column:
    kind = pa.struct([("text", pa.string()), ("spans", _SPANS)])

    @F.arrow_udf("struct<text:string,spans:array<struct<kind:string,start:int,end:int>>>")
    def made(texts: pa.Array) -> pa.Array:
        found = [pseudonymise(t, key) for t in texts.to_pylist()]
        return pa.array([{"text": t, "spans": s} for t, s in found], kind)

    return made(text)
