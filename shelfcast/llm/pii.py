"""Personal data: patterns propose spans, checksums confirm them, context words set the score.

Patterns find runs that look like an address, a number or an account. Validators then decide: octets of
an IP address, the Luhn digit of a card, the mod-97 rest of an IBAN, the number of digits of a phone.
The score of a span starts from its kind, and words nearby that name such data raise it. The kinds of the
base set stay whatever their score; of the other kinds, those below ``MIN_SCORE`` go.
"""

from __future__ import annotations

import hashlib
import re

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from shelfcast.llm.common import text_batches

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "iban", "ssn")
# Percent before and after context words are seen, and those words.
SCORE = {"email": 90, "ip": 60, "card": 80, "phone": 60, "iban": 90, "ssn": 30}
RAISE = 35
MIN_SCORE = 50
NEAR = 40
CONTEXT = {
    "email": ("email", "mail", "contact"),
    "ip": ("ip", "address", "server", "host"),
    "card": ("card", "visa", "mastercard", "credit", "payment"),
    "phone": ("phone", "tel", "call", "mobile", "fax"),
    "iban": ("iban", "account", "bank"),
    "ssn": ("ssn", "social", "security"),
}

# The lookbehinds and possessive repeats only spare the engine restarts within a run that has failed.
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
NOT_DIGITS = re.compile(r"[^0-9]+")
WORD = re.compile(r"[a-z]+")


def emails(text: str):
    """Leftmost matches, found from their ``@``: the local part is the run before it."""
    floor = at = 0
    while (at := text.find("@", at)) >= 0:
        start = at
        while start > floor and text[start - 1] in LOCAL:
            start -= 1
        match = DOMAIN.match(text, at + 1) if start < at else None
        if match:
            yield start, match.end()
            floor = at = match.end()
        else:
            at += 1
            floor = at  # an @ belongs to no local part


def ibans(text: str):
    """Spans whose checksum holds: of each run the longest that ends at one of its spaces or its end."""
    at = 0
    while match := IBAN.search(text, at):
        start, end = match.span()
        while end > start and not mod97(text[start:end]):
            end = text.rfind(" ", start, end)
        if end > start:
            yield start, end
        at = max(end, start + 1)


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def mod97(iban: str) -> bool:
    code = iban.replace(" ", "")
    return 15 <= len(code) <= 34 and int("".join(str(int(c, 36)) for c in code[4:] + code[:4])) % 97 == 1


def octets(ip: str) -> bool:
    return all(len(p) <= 3 and int(p) <= 255 for p in (x.lstrip("0") or "0" for x in ip.split(".")))


def social(number: str) -> bool:
    return number[:3] not in ("000", "666") and number[0] != "9" and number[4:6] != "00" and number[7:] != "0000"


def candidates(text: str):
    """(kind, start, end) of the spans that pattern and validator agree on, by kind, then start."""
    if "@" in text:
        yield from (("email", a, b) for a, b in emails(text))
    yield from (("ip", *m.span()) for m in IP.finditer(text) if octets(m[0]))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 13 and 13 <= len(digits := NOT_DIGITS.sub("", m[0])) <= 19 and luhn(digits):
            yield "card", *m.span()
    if "+" in text:
        yield from (("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= len(NOT_DIGITS.sub("", m[0])) <= 15)
    yield from (("iban", *span) for span in ibans(text))
    yield from (("ssn", *m.span()) for m in SSN.finditer(text) if social(m[0]))


def score(text: str, kind: str, start: int, end: int) -> int:
    nearby = text[max(0, start - NEAR) : start] + " " + text[end : end + NEAR]
    named = any(w in CONTEXT[kind] for w in WORD.findall(nearby.lower()))
    return min(100, SCORE[kind] + RAISE * named)


def find(text: str | None) -> list[tuple[str, int, int, int]]:
    """(kind, start, end, score) in code points, end exclusive, by kind, then start."""
    spans = [(k, a, b, score(text, k, a, b)) for k, a, b in candidates(text or "")]
    return [s for s in spans if s[0] in BASE or s[3] >= MIN_SCORE]


SPAN = StructType(
    [StructField("kind", StringType()), *(StructField(n, IntegerType()) for n in ("start", "end", "score"))]
)


@F.pandas_udf(StructType([StructField("spans", ArrayType(SPAN))]))
def _find(texts: pd.Series) -> pd.DataFrame:
    names = ("kind", "start", "end", "score")
    return pd.DataFrame({"spans": [[dict(zip(names, s)) for s in find(t)] for t in texts]})


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The spans of every row: (id, pii array of kind, start, end, score).

    Offsets are code points of the whole text, however long. Null and empty texts have no spans. Repeated rows are
    scanned each; columns other than the two named are not read; an empty table gives an empty result.
    """
    text_batches(docs.sparkSession)
    return docs.select(
        F.col(f"`{id_col}`").alias(id_col), _find(F.col(f"`{text_col}`"))["spans"].alias("pii")
    )


def redact(text: str | None) -> str | None:
    """The text with each span replaced by its kind in angle brackets; overlapping spans as one."""
    if text is None:
        return None
    out, at = [], 0
    for start, end, kind in sorted((a, b, k) for k, a, b, _ in find(text)):
        if start >= at:
            out += [text[at:start], f"<{kind}>"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def _is(kind: str):
    return lambda s: s["kind"] == kind


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts, the hash of the base spans and all spans as a string."""
    pii = F.col("pii")
    joined = lambda spans: F.concat_ws(
        ",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    )
    base = F.filter(pii, lambda s: s["kind"].isin(*BASE))
    return found.select(
        id_col,
        *(F.size(F.filter(pii, _is(k))).cast("long").alias(f"n_{k}") for k in BASE),
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(pii).alias("spans"),
        F.concat_ws(",", F.transform(pii, lambda s: s["score"].cast("string"))).alias("scores"),
    )


def base_digest(text: str | None) -> str:
    """The hash of one text's base spans, as ``digest`` gives it."""
    spans = (f"{k}:{a}:{b}" for k, a, b, _ in find(text) if k in BASE)
    return hashlib.sha256(",".join(spans).encode()).hexdigest()
