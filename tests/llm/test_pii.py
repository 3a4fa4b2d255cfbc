from __future__ import annotations

import hashlib
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sluiceway.llm import catalogue, pii

# The contract's patterns, as they are written there.
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_spans(text):
    found = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == "ip":
                ok = all(int(p) <= 255 for p in m.group().split("."))
            elif kind == "card":
                total = sum(
                    sum(divmod(2 * int(d), 10)) if k % 2 else int(d) for k, d in enumerate(reversed(digits))
                )
                ok = 13 <= len(digits) <= 19 and total % 10 == 0
            else:
                ok = kind == "email" or 9 <= len(digits) <= 15
            if ok:
                found.append((kind, m.start(), m.end()))
    return found


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="a1.@-+_() 2549é\n", max_size=60))
def test_base_spans_are_those_of_the_plain_patterns(text):
    assert pii.base_spans(text) == plain_spans(text)


@pytest.mark.parametrize(
    "text",
    [
        "a@b@c.de x", "1.2.3.4.5.6.7.8", "a@b.c_d@e.f", "0001.2.3.255", "1.2.3.256 1.2.3.4", "+1 (988) 555-2485",
        "4111 1111 1111 1111", "4111-1111-1111-1112", "@b.c", "x@y", "+123", "é a@é.b", "1" * 5000, "1." * 3000,
    ],
)
def test_base_spans_of_hard_cases(text):
    assert pii.base_spans(text) == plain_spans(text)


def test_checksums():
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")
    assert pii.mod97("DE89370400440532013000") and not pii.mod97("DE89370400440532013001")


def test_added_spans_need_proof_or_context():
    found = {s.kind for s in pii.find_spans("pay to IBAN DE89 3704 0044 0532 0130 00 TODAY")}
    assert found == {"iban"}
    assert not pii.find_spans("DE89370400440532013001")
    assert [s.kind for s in pii.find_spans("SSN 123-45-6789")] == ["ssn"]
    assert not pii.find_spans("part 123-45-6789")
    assert [s.kind for s in pii.find_spans("call (906) 555-7738 now")] == ["local_phone"]
    # a base span's number is not proposed again
    assert [s.kind for s in pii.find_spans("call +1 (906) 555-7738")] == ["phone"]


def test_context_moves_the_score():
    near = pii.find_spans("visa card 4111111111111111")[0].score
    alone = pii.find_spans("x 4111111111111111")[0].score
    against = pii.find_spans("serial 4111111111111111")[0].score
    assert near > alone > against


def test_redaction():
    text = "mail a@b.co or 10.0.0.1."
    assert pii.redact(text, pii.find_spans(text)) == "mail <EMAIL> or <IP>."


def test_detect_and_redacted_of_odd_rows(spark, docs, clashing):
    rows = docs((1, None), (1, ""), (None, "a@b.co"), (2, "a@b.co"), (2, "a@b.co"), (3, "é" * 50_000 + " a@b.co"))
    found = {(r.doc_id, r.spans) for r in pii.detect(clashing(rows)).collect()}
    assert found == {(1, ""), (None, "email:0:6"), (2, "email:0:6"), (3, "email:50001:50007")}
    assert pii.detect(rows).count() == 6
    clean = pii.redacted(clashing(rows))
    assert clean.columns == clashing(rows).columns
    assert clean.where("text IS NULL").count() == 1 and clean.where("text LIKE '%<EMAIL>'").count() == 4
    assert pii.detect(rows.limit(0)).count() == 0


def test_query_against_plain_patterns(spark, sf):
    got = {r.doc_id: r for r in catalogue.op2_pii(spark, sf).collect()}
    rows = spark.read.parquet(f"{sf}/documents.parquet").collect()
    assert len(got) == len(rows)
    for row in rows:
        spans = plain_spans(row.text or "")
        joined = ",".join(f"{k}:{s}:{e}" for k, s, e in spans)
        mine = got[row.doc_id]
        assert mine.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert mine.spans.startswith(joined)
        assert [mine.n_email, mine.n_ip, mine.n_card, mine.n_phone] == [
            sum(k == kind for k, _, _ in spans) for kind in PLAIN
        ]


def test_checked_ibans_of_five_countries_are_all_found():
    """Random valid IBANs beside 'iban' and 'bank': none is lost to a base span inside it."""
    import random

    rng = random.Random(11)
    shapes = {"GB": "AAAA" + "9" * 14, "DE": "9" * 18, "FR": "9" * 23, "ES": "9" * 20, "NL": "AAAA" + "9" * 10}

    def valid(country, shape):
        bban = "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ") if c == "A" else rng.choice("0123456789") for c in shape)
        number = int("".join(str(int(c, 36)) for c in bban + country + "00"))
        return f"{country}{98 - number % 97:02d}{bban}"

    for _ in range(600):
        country, shape = rng.choice(sorted(shapes.items()))
        iban = valid(country, shape)
        assert pii.mod97(iban)
        spaced = " ".join(iban[i : i + 4] for i in range(0, len(iban), 4)) if rng.random() < 0.5 else iban
        text = f"iban for the bank transfer: {spaced} thanks"
        start = text.index(spaced)
        assert ("iban", start, start + len(spaced)) in {(s.kind, s.start, s.end) for s in pii.find_spans(text)}, text
