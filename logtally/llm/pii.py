"""Personal data: regular expressions propose spans, checksum validators
confirm them, nearby context words adjust the score.

Kinds, in order: email, ip (parts to 255), card (12 to 19 digits, Luhn), phone
(international, 9 to 15 digits); these base spans always stay. Added by the
method: iban (as many characters as its country has, mod-97), local_phone (a
grouped national number, which only counts when context words lift its score to
the threshold), national_id (numbers with check characters of Spain, France and
Germany, the digits-only German one with context) and secret (the value given to a
name like token, password or api_key: 16 characters or more, of several kinds, whose
letters are as mixed as those of random ones).

Matches of one kind are leftmost and do not overlap; a match that fails its
validator is dropped and not tried again in a shorter form. Offsets are code
points, the end exclusive. A null or empty text has no spans; the scan is linear
in the text for each kind, so very long texts are read whole.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logtally.session import ship_package

# Fixed patterns.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
# The look-behind spares restarts inside a digit run, where no new match can begin.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}")
# Characters of an IBAN by country.
IBAN_LENGTHS = {c[:2]: int(c[2:]) for c in """AD24 AE23 AL28 AT20 AZ28 BA20 BE16 BG22 BH22 BR29 BY28 CH21 CR22 CY28 CZ24 DE22 DK18
DO28 EE20 EG29 ES24 FI18 FO18 FR27 GB22 GE22 GI23 GL18 GR27 GT28 HR21 HU28 IE22 IL23 IQ23 IS26 IT27 JO30 KW30 KZ20 LB28 LC32 LI21
LT20 LU20 LV21 LY25 MC27 MD24 ME22 MK19 MR27 MT31 MU30 NL18 NO15 PK24 PL28 PS29 PT25 QA29 RO24 RS22 SA24 SC31 SE24 SI19 SK24 SM27
ST25 SV28 TL23 TN24 TR26 UA29 VA22 VG24 XK20""".split()}
# Spain: eight digits (a foreigner's first one a letter) and a letter by their rest of 23.
_SPAIN = re.compile(r"(?<![A-Za-z0-9])[XYZ0-9][0-9]{7}-?[A-Z](?![A-Za-z0-9])")
SPAIN_LETTERS = "TRWAGMYFPDXBNJZSQVHLCKE"
# France: sex, year, month, place (Corsica 2A, 2B), number, and a key of two digits; blanks between.
_FRANCE = re.compile(r"(?<![A-Za-z0-9])[12]\x20?[0-9]{2}\x20?(?:0[1-9]|1[0-2]|[2-9][0-9])\x20?(?:[0-9]{2}|2[AB])\x20?[0-9]{3}\x20?[0-9]{3}\x20?[0-9]{2}(?![A-Za-z0-9])")
# Germany: a tax number of eleven digits, in groups or not.
_GERMANY = re.compile(r"(?<![A-Za-z0-9+.,-])[1-9][0-9](?:\x20[0-9]{3}){3}(?![\x20-]?[0-9A-Za-z])|(?<![A-Za-z0-9+.,-])[1-9][0-9]{10}(?![0-9A-Za-z])")
# A name of a secret, up to what is given to it; a value in quotes, or up to the next blank.
_SECRET = re.compile(r"""(?<![A-Za-z])(?:[A-Za-z0-9]{1,20}[_-]){0,3}(?:api[_-]?key|apikey|secret|token|passwd|password|pwd|access[_-]?key|private[_-]?key|bearer)
(?:[_-][A-Za-z0-9]{1,20}){0,2}["']?\s{0,4}(?:=>|:=|=|:|\s)\s{0,4}["']?([A-Za-z0-9_+/=.~!@#$%^&*-]{16,})""".replace("\n", ""), re.IGNORECASE)
_SECRET_END = re.compile(r"[^A-Za-z0-9/=]+$")
_LOCAL_PHONE = re.compile(r"(?<![0-9+()./-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[-.\x20])[0-9]{3}[-.\x20][0-9]{4}(?![0-9./-])")
_DIGIT = re.compile(r"[0-9]")

KINDS = ("email", "ip", "card", "phone", "iban", "local_phone", "national_id", "secret")
BASE = KINDS[:4]
# Scores before context; words that raise and lower them, and by how much.
SCORES = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.7, "iban": 0.9, "local_phone": 0.4, "national_id": 0.5, "secret": 0.8}
# Bits per character that the characters of a secret must be worth.
ENTROPY = 2.75
CONTEXT = {
    "email": ("email", "e-mail", "mail", "contact"),
    "ip": ("ip", "address", "host", "server", "login"),
    "card": ("card", "visa", "mastercard", "credit", "payment"),
    "phone": ("phone", "tel", "call", "mobile", "fax"),
    "iban": ("iban", "bank", "account", "transfer"),
    "local_phone": ("phone", "tel", "call", "mobile", "fax"),
    "national_id": ("dni", "nie", "nif", "nir", "insee", "sécu", "steuer-id", "steuer", "identifikationsnummer", "steuernummer", "idnr",
                    "id", "tax", "identity", "security"),
    "secret": ("key", "secret", "token", "password", "login"),
}
AGAINST = ("version", "isbn", "serial", "example", "sku")
RAISED, LOWERED, WINDOW, THRESHOLD = 0.3, 0.2, 40, 0.6
_WORD = re.compile(r"[a-zé][a-zé-]*")


class Span(NamedTuple):
    kind: str
    start: int
    end: int
    score: float


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def mod97(iban: str) -> bool:
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97 == 1


def iban_end(text: str, start: int, stop: int) -> int | None:
    """Where the IBAN that begins at ``start`` ends: at its country's length, before no letter or digit."""
    wanted, n = IBAN_LENGTHS.get(text[start:start + 2]), 0
    for k in range(start, stop) if wanted else ():
        n += text[k] != " "
        if n == wanted:
            return None if text[k + 1:k + 2].isalnum() or not mod97(text[start:k + 1].replace(" ", "")) else k + 1
    return None


def spain_id(s: str) -> bool:
    return SPAIN_LETTERS[int(str("XYZ".find(s[0])) + s[1:8] if s[0] in "XYZ" else s[:8]) % 23] == s[-1]


def france_id(s: str) -> bool:
    s = s.replace(" ", "")
    body = int(s[:13].replace("2A", "19").replace("2B", "18") if s[5:7] in ("2A", "2B") else s[:13])
    return 97 - body % 97 == int(s[13:])


def germany_id(s: str) -> bool:
    s = s.replace(" ", "")
    rest = 10
    for c in s[:10]:
        rest = ((int(c) + rest) % 10 or 10) * 2 % 11
    return (11 - rest) % 10 == int(s[10]) and max(map(s[:10].count, s[:10])) in (2, 3)


def entropy(s: str) -> float:
    """Bits per character by how often each of its characters is there."""
    return -sum(n / len(s) * math.log2(n / len(s)) for n in map(s.count, set(s)))


def _secret(text: str, start: int, end: int) -> int | None:
    """The end of a secret: several kinds of characters, no repetition; else None."""
    if text[end:end + 1] not in ("'", '"'):
        end -= len(m[0]) if (m := _SECRET_END.search(text, start, end)) else 0
    value = text[start:end]
    kinds = sum(any(f(c) for c in value) for f in (str.isdigit, str.islower, str.isupper))
    return end if len(value) >= 16 and kinds >= 2 and any(map(str.isdigit, value)) and entropy(value) >= ENTROPY else None


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """What one leftmost pattern finds, from each ``@`` outwards: the local part
    is the run of its characters before the ``@``, cut by the match before."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        end = 0
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            end = free = m.end()
            yield start, end
        at = text.find("@", max(at + 1, end))


def _all(pattern: re.Pattern, text: str) -> Iterator[tuple[int, int]]:
    return (m.span() for m in pattern.finditer(text))


def _digits(s: str) -> str:
    return "".join(_DIGIT.findall(s))


def _proposed(text: str) -> Iterator[tuple[str, int, int]]:
    """Spans that their validators confirm."""
    if "@" in text:
        for a, b in _emails(text):
            yield "email", a, b
    if not _DIGIT.search(text):
        return
    for m in _SECRET.finditer(text):
        if (b := _secret(text, m.start(1), m.end(1))) is not None:
            yield "secret", m.start(1), b
    for a, b in _all(_IP, text):
        if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in text[a:b].split(".")):
            yield "ip", a, b
    for a, b in _all(_CARD, text):
        if 12 <= b - a and 12 <= len(d := _digits(text[a:b])) <= 19 and luhn(d):
            yield "card", a, b
    if "+" in text:
        for a, b in _all(_PHONE, text):
            if 9 <= len(_digits(text[a:b])) <= 15:
                yield "phone", a, b
    for a, b in _all(_IBAN, text):
        if (end := iban_end(text, a, b)) is not None:
            yield "iban", a, end
    for pattern, confirms in ((_SPAIN, spain_id), (_FRANCE, france_id), (_GERMANY, germany_id)):
        for a, b in _all(pattern, text):
            if confirms(text[a:b]):
                yield "national_id", a, b
    for a, b in _all(_LOCAL_PHONE, text):
        yield "local_phone", a, b


def score(kind: str, text: str, start: int, end: int) -> float:
    near = set(_WORD.findall(f"{text[max(0, start - WINDOW):start]} {text[end:end + WINDOW]}".lower()))
    if kind == "national_id" and not text[start:end].replace(" ", "").isdigit():
        value = RAISED                              # a check letter tells more than a check digit
    else:
        value = 0.0
    value += SCORES[kind] + RAISED * (not near.isdisjoint(CONTEXT[kind])) - LOWERED * (not near.isdisjoint(AGAINST))
    return round(min(1.0, max(0.0, value)), 3)


def find_spans(text: str | None) -> list[Span]:
    """Spans of a text by start, then kind."""
    found = [Span(kind, a, b, score(kind, text, a, b)) for kind, a, b in _proposed(text or "")]
    return sorted((s for s in found if s.kind in BASE or s.score >= THRESHOLD),
                  key=lambda s: (s.start, KINDS.index(s.kind)))


def joined(spans: list[Span]) -> str:
    return ",".join(f"{s.kind}:{s.start}:{s.end}" for s in spans)


_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [find_spans(t) for t in batch.column(1).to_pylist()]
        base = [[s for s in f if s.kind in BASE] for f in found]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([[s._asdict() for s in f] for f in found], pa.list_(_SPAN)),
             *(pa.array([sum(s.kind == k for s in b) for b in base], pa.int64()) for k in BASE),
             pa.array([hashlib.sha256(joined(b).encode()).hexdigest() for b in base], pa.string()),
             pa.array([joined(f) for f in found], pa.string())],
            names=["id", "found", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"])


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: the found spans with scores, counts of the base kinds, the
    digest of the base spans, and all spans as text. Map-only."""
    ship_package(docs.sparkSession)
    out = docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(
        _batches, "id long, found array<struct<kind: string, start: long, `end`: long, score: double>>, n_email long, "
                  "n_ip long, n_card long, n_phone long, base_sha256 string, spans string")
    return out.withColumnRenamed("id", id_col)
