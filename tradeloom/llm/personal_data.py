"""Personal data: regular expressions propose spans, checksums confirm them, nearby context words adjust a score.

Base kinds (email, ip, card, phone) are always reported. Further kinds (iban, secret) need a score of ``ACCEPT``: a passed
checksum or a typical form gives most of it, context words before the span the rest. Offsets are code points, end exclusive.

Null text counts as empty. Rows are treated one by one: repeated rows get equal results, a null doc_id is carried, an empty
table gives no rows and columns other than the two named are never read. Every search is linear in the text.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

# The base kinds and their patterns.
BASE_KINDS = ["email", "ip", "card", "phone"]
MORE_KINDS = ["iban", "secret"]
AT = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
SECRET = re.compile(r"(?<![A-Za-z0-9])[0-9a-f]{32,64}(?![A-Za-z0-9])")
CONTEXT = {
    "email": ["mail", "contact", "write"], "ip": ["ip", "address", "host", "server"], "card": ["card", "visa", "payment", "credit"],
    "phone": ["phone", "tel", "call", "mobile", "fax"], "iban": ["iban", "account", "bank", "konto", "transfer"],
    "secret": ["token", "secret", "key", "password", "api"]}

SCORES = {"email": 0.9, "ip": 0.6, "card": 0.7, "phone": 0.7, "iban": 0.7, "secret": 0.4}  # before context is seen
CONTEXT_CHARS, CONTEXT_GAIN, ACCEPT = 40, 0.3, 0.6

Span = tuple[str, int, int, float]


def luhn(digits: str) -> bool:
    total = 0
    for i, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + i % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def mod97(iban: str) -> bool:
    compact = iban.replace(" ", "")
    turned = compact[4:] + compact[:4]
    return 15 <= len(compact) <= 34 and int("".join(str(int(c, 36)) for c in turned)) % 97 == 1


def _emails(text: str) -> Iterator[tuple[int, int]]:
    end = 0  # of the match before; a local part is the longest run before its @
    for at in AT.finditer(text):
        start = at.start()
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        if start < at.start():
            end = at.end()
            yield start, end


def _digits(text: str) -> str:
    return re.sub("[^0-9]", "", text)


def _proposed(text: str) -> Iterator[tuple[str, int, int]]:
    if "@" in text:
        for start, end in _emails(text):
            yield "email", start, end
    for m in IP.finditer(text):
        if all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255 for part in m[0].split(".")):
            yield "ip", m.start(), m.end()
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 12 and 12 <= len(digits := _digits(m[0])) <= 19 and luhn(digits):
            yield "card", m.start(), m.end()
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= len(_digits(m[0])) <= 15:
                yield "phone", m.start(), m.end()
    for m in IBAN.finditer(text):
        if mod97(m[0]):
            yield "iban", m.start(), m.end()
    for m in SECRET.finditer(text):
        yield "secret", m.start(), m.end()


def find_spans(text: str) -> list[Span]:
    """(kind, start, end, score) of a text by start, then kind; base kinds always, others from ``ACCEPT`` on."""
    found = []
    for kind, start, end in _proposed(text):
        near = text[max(0, start - CONTEXT_CHARS):start].lower()
        score = min(1.0, SCORES[kind] + CONTEXT_GAIN * any(word in near for word in CONTEXT[kind]))
        if kind in BASE_KINDS or score >= ACCEPT:
            found.append((kind, start, end, round(score, 3)))
    order = {kind: i for i, kind in enumerate(BASE_KINDS + MORE_KINDS)}
    return sorted(found, key=lambda span: (span[1], order[span[0]]))


def joined(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end, _ in spans)


def redacted(text: str, spans: list[Span]) -> str:
    """The text with a tag in place of every span; spans that overlap become one tag of the first kind."""
    parts, at = [], 0
    for kind, start, end, _ in spans:
        if start >= at:
            parts += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, end)
    return "".join([*parts, text[at:]])


def spans_of(text: Column) -> Column:
    """An array of (kind, start, end, score)."""
    @F.pandas_udf("array<struct<kind:string,start:int,end:int,score:double>>")
    def find(texts: pd.Series) -> pd.Series:
        return pd.Series([[dict(zip(("kind", "start", "end", "score"), span)) for span in find_spans(t or "")] for t in texts])

    return find(text)


def redacted_text(text: Column) -> Column:
    """The text with its spans replaced; null stays null."""
    @F.pandas_udf("string")
    def replace(texts: pd.Series) -> pd.Series:
        return pd.Series([None if t is None else redacted(t, find_spans(t)) for t in texts], dtype=object)

    return replace(text)


def digest(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Key, counts of the base kinds, the digest of the base spans and all spans with their scores as strings."""
    key_type = docs.schema[key].dataType.simpleString()

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for key_value, value in zip(batch[key], batch[text]):
                spans = find_spans(value or "")
                base = [span for span in spans if span[0] in BASE_KINDS]
                counts = [sum(span[0] == kind for span in base) for kind in BASE_KINDS]
                rows.append((key_value, *counts, hashlib.sha256(joined(base).encode()).hexdigest(), joined(spans),
                             ",".join(str(span[3]) for span in spans)))
            yield pd.DataFrame(rows, columns=[key, *(f"n_{kind}" for kind in BASE_KINDS), "base_sha256", "spans", "scores"])

    schema = f"`{key}` {key_type}, " + ", ".join(f"n_{kind} bigint" for kind in BASE_KINDS) + ", base_sha256 string, spans string, scores string"
    return docs.select(key, text).mapInPandas(scan, schema)
