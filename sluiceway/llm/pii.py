"""PII: patterns propose spans, checksums confirm them, context words adjust the score.

Each kind has a proposal (a pattern), a check of the proposal (Luhn for cards,
mod 97 for IBANs, ranges and digit counts for the rest) and words that raise or
lower the score when they stand near the span. The four base kinds are kept
whenever their check passes; further spans are kept if their score reaches
``THRESHOLD``. ``ssn`` and ``local_phone`` have no proof of their own in their form, so
they are also dropped where they overlap a base span; an IBAN that passed mod 97 stays
beside the base spans inside it (say, a run of its digits that passes Luhn), and
``redact`` merges overlapping spans into one.

Rows are independent, so the work is one pass over the documents without a shuffle.
Defined results: a null text is an empty text; empty texts have no spans; very long
texts are searched whole (runs of digits are scanned once); a null id gives a row with a
null id; repeated rows each give their own row; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import slices, texts

#: Kinds in the order of the results.
BASE_KINDS = ("email", "ip", "card", "phone")
MORE_KINDS = ("iban", "ssn", "local_phone")
KINDS = BASE_KINDS + MORE_KINDS

#: An added span is kept from this score on.
THRESHOLD = 0.6
#: Characters on either side in which context words count.
NEAR = 48

#: The score of a span whose check passed, before context.
PRIOR = {"email": 0.95, "ip": 0.7, "card": 0.8, "phone": 0.75, "iban": 0.85, "ssn": 0.4, "local_phone": 0.4}

#: Words that speak for a kind.
SPEAKS_FOR = {
    "email": ("email", "e-mail", "mail", "contact", "correo", "courriel"),
    "ip": ("ip", "address", "host", "server", "login", "adresse"),
    "card": ("card", "visa", "credit", "debit", "karte", "carte", "tarjeta", "payment"),
    "phone": ("phone", "call", "tel", "mobile", "fax", "telefon", "teléfono", "téléphone"),
    "iban": ("iban", "account", "bank", "konto", "compte", "cuenta"),
    "ssn": ("ssn", "social", "security"),
    "local_phone": ("phone", "call", "tel", "mobile", "fax", "telefon", "teléfono", "téléphone"),
}
#: Words that speak against any kind.
SPEAKS_AGAINST = ("version", "release", "isbn", "issn", "serial", "token", "sha", "md5", "invoice", "order")

# Possessive runs: a run of digits is scanned once, however long it is.
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
_SSN = re.compile(r"(?<![0-9-])([0-9]{3})-([0-9]{2})-([0-9]{4})(?![0-9-])")
_LOCAL_PHONE = re.compile(r"(?<![0-9+])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9])")
_DIGIT = re.compile(r"[0-9]")
_CONTEXT_WORD = re.compile(r"[^\W\d_][\w-]*")


@dataclass(frozen=True)
class Span:
    kind: str
    start: int
    end: int
    score: float


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = ord(digit) - 48
        if place % 2:
            value = value * 2 - 9 * (value > 4)
        total += value
    return total % 10 == 0


def mod97(iban: str) -> bool:
    turned = iban[4:] + iban[:4]
    return int("".join(str(int(c, 36)) for c in turned)) % 97 == 1


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping matches of the address pattern.

    A local part is a run of its characters right before the ``@``, so looking from
    each ``@`` outwards finds the same matches without trying every start.
    """
    done = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        found = _DOMAIN.match(text, at) if start < at else None
        if found:
            done = found.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _part_ok(part: str) -> bool:
    significant = part.lstrip("0")
    return len(significant) <= 3 and int(significant or 0) <= 255


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """The base kinds' spans: kind, start, end, by kind as listed, then start."""
    found = [("email", s, e) for s, e in _emails(text)] if "@" in text else []
    if not _DIGIT.search(text):
        return found
    if "." in text:
        for m in _IP.finditer(text):
            if all(_part_ok(p) for p in m.group().split(".")):
                found.append(("ip", m.start(), m.end()))
    for m in _CARD.finditer(text):
        if 13 <= m.end() - m.start() <= 40:
            digits = _digits(m.group())
            if 13 <= len(digits) <= 19 and luhn(digits):
                found.append(("card", m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_digits(m.group())) <= 15:
                found.append(("phone", m.start(), m.end()))
    return found


def _proposed(text: str) -> Iterator[tuple[str, int, int]]:
    """The further kinds' checked proposals."""
    for m in _IBAN.finditer(text):
        # Words in capitals may follow: the longest beginning that passes counts.
        end = m.end()
        while end - m.start() >= 15:
            bare = text[m.start() : end].replace(" ", "")
            if 15 <= len(bare) <= 34 and mod97(bare):
                yield "iban", m.start(), end
                break
            end = text.rfind(" ", m.start(), end)
            if end < 0:
                break
    for m in _SSN.finditer(text):
        area, group, serial = m.groups()
        if area not in ("000", "666") and area < "900" and group != "00" and serial != "0000":
            yield "ssn", m.start(), m.end()
    for m in _LOCAL_PHONE.finditer(text):
        yield "local_phone", m.start(), m.end()


def context_score(text: str, kind: str, start: int, end: int) -> float:
    """The kind's prior, up by 0.25 for a word that speaks for it nearby, down by 0.3 for one against."""
    near = text[max(0, start - NEAR) : start] + " " + text[end : end + NEAR]
    words = set(_CONTEXT_WORD.findall(near.lower()))
    score = PRIOR[kind]
    if words.intersection(SPEAKS_FOR[kind]):
        score += 0.25
    if words.intersection(SPEAKS_AGAINST):
        score -= 0.3
    return round(min(1.0, max(0.0, score)), 3)


def _merged(intervals) -> list[tuple[int, int]]:
    """Disjoint intervals over the same places, in order."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(intervals):
        if out and start < out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((start, end))
    return out


def find_spans(text: str | None) -> list[Span]:
    """All spans of a text, by kind as listed, then start."""
    if not text:
        return []
    spans = [Span(k, s, e, context_score(text, k, s, e)) for k, s, e in base_spans(text)]
    if not _DIGIT.search(text):
        return spans
    taken = _merged((s.start, s.end) for s in spans)
    ends = [e for _, e in taken]
    more = []
    for kind, start, end in _proposed(text):
        at = bisect_right(ends, start)
        # An IBAN has passed its own checksum and stays beside base spans inside it; the
        # others have no proof in their form and yield to a base span.
        if kind != "iban" and at < len(taken) and taken[at][0] < end:
            continue
        score = context_score(text, kind, start, end)
        if score >= THRESHOLD:
            more.append(Span(kind, start, end, score))
    more.sort(key=lambda s: (KINDS.index(s.kind), s.start))
    return spans + more


def redact(text: str, spans: list[Span]) -> str:
    """The text with each span replaced by its kind; overlapping spans become one."""
    if not spans:
        return text
    out, done = [], 0
    merged: list[list] = []
    for s in sorted(spans, key=lambda s: (s.start, -s.end)):
        if merged and s.start < merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], s.end)
        else:
            merged.append([s.start, s.end, s.kind])
    for start, end, kind in merged:
        out += [text[done:start], f"<{kind.upper()}>"]
        done = end
    return "".join(out) + text[done:]


def joined(spans) -> str:
    return ",".join(f"{s.kind}:{s.start}:{s.end}" for s in spans)


FOUND = "array<struct<kind:string,start:long,end:long,score:double>>"
_FOUND = pa.list_(
    pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])
)


def detect(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``spans`` (all, with scores), their text form and the digest of the base spans."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1000):
            rows = [find_spans(t) for t in batch.column("text").to_pylist()]
            base = [[s for s in spans if s.kind in BASE_KINDS] for spans in rows]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([[vars(s) for s in spans] for spans in rows], _FOUND),
                    pa.array([joined(spans) for spans in rows], pa.string()),
                    pa.array(
                        [hashlib.sha256(joined(spans).encode()).hexdigest() for spans in base],
                        pa.string(),
                    ),
                ],
                names=["doc_id", "found", "spans", "base_sha256"],
            )

    schema = f"doc_id long, found {FOUND}, spans string, base_sha256 string"
    return texts(docs, id_col, text_col).mapInArrow(run, schema)


def redacted(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with all spans in ``text_col`` replaced by their kinds; a null text stays null."""
    place = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1000):
            new = [t if t is None else redact(t, find_spans(t)) for t in batch.column(place).to_pylist()]
            arrays = list(batch.columns)
            arrays[place] = pa.array(new, pa.string())
            yield pa.RecordBatch.from_arrays(arrays, names=batch.schema.names)

    return docs.mapInArrow(run, docs.schema)
