"""Spans of personal data against a plain reading of the stated patterns, on odd and random texts."""

import random
import re

import pytest

from chorale.llm.pii import BASE, KINDS, scan_pii

# The patterns and rules as stated, without the operator's guards.
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(number):
    total = 0
    for i, c in enumerate(reversed(number)):
        v = int(c) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def holds(kind, match):
    digits = re.sub("[^0-9]", "", match)
    return {
        "email": lambda: True,
        "ip": lambda: all(int(p) <= 255 for p in match.split(".")),
        "card": lambda: 14 <= len(digits) <= 19 and luhn(digits),
        "phone": lambda: 10 <= len(digits) <= 15,
    }[kind]()


def plain(text):
    found = [(m.start(), KINDS.index(k), k, m.end()) for k, p in PLAIN.items() for m in re.finditer(p, text or "") if holds(k, m[0])]
    return [(k, s, e) for s, _, k, e in sorted(found)]


def scanned(spark, texts, base=True):
    rows = [(i, t, "clash", "x") for i, t in enumerate(texts)]
    frame = scan_pii(spark.createDataFrame(rows, "doc_id long, text string, pii string, kind string"))
    assert frame.columns == ["doc_id", "text", "kind", "pii"]
    out = {r.doc_id: [(s.kind, s.start, s.end, s.score) for s in r.pii if not base or s.kind in BASE] for r in frame.collect()}
    return [out[i] for i in range(len(texts))]


CASES = [
    None,
    "",
    "mail a@b.c+d@e.fr or %x@y-z.co.uk. and a_b@c_d@e.f",
    "1.2.3.4.5.6.7.8 999.1.2.3.4 0255.000.0001.9 256.1.1.1 1.2.3 00000000000000000000255.1.1.1",
    "4111 1111 1111 1111, 4111-1111-1111-1112, 4111--1111 1111 1111 11, 30569309025904 " + "4" * 25,
    "+33 (0)1.23.45.67.89- call +1-800 +4 9 +12345678901234567 ++49 170 1234567",
    "é😀 a@b.fr é😀 10.0.0.1 +49 170 1234567",
    "a" * 50_000 + " x@y.z " + "1 " * 20_000 + "@" + ".9" * 9_000,
    "9" * 30_000 + "@q.r",
]


def test_base_spans_equal_the_stated_patterns(spark):
    rng = random.Random(5)
    pieces = ["a", "@", ".", "1", "12", "255", "4111111111111111", " ", "-", "+", "(", ")", "_", "%", "é", "😀", "\n", "b.fr"]
    texts = CASES + ["".join(rng.choice(pieces) for _ in range(rng.randint(1, 60))) for _ in range(1500)]
    got = scanned(spark, texts)
    for text, spans in zip(texts, got):
        assert [s[:3] for s in spans] == plain(text), text
    assert {s[0] for spans in got for s in spans} == set(BASE)


@pytest.mark.parametrize(
    "text, kinds",
    [
        ("iban DE89 3704 0044 0532 0130 00.", ["iban"]),
        ("GB82WEST12345698765432", ["iban"]),
        ("GB83WEST12345698765432", []),
        ("serial part GB82WEST12345698765432", []),
        ("bank account, serial part GB82WEST12345698765432", ["iban"]),
        ("her social security number is 219-09-9999", ["ssn"]),
        ("see 219-09-9999", []),
        ("ssn 666-09-9999, 000-12-3456, 219-00-9999, 219-09-0000", []),
        ("ssn for the order 219-09-9999", []),
    ],
)
def test_further_kinds_need_their_check_or_their_words(spark, text, kinds):
    assert [s[0] for s in scanned(spark, [text], base=False)[0]] == kinds


def test_words_nearby_move_the_score(spark):
    alone, told, doubted, far = scanned(
        spark, ["4111111111111111", "credit 4111111111111111", "order 4111111111111111", "credit" + " " * 50 + "4111111111111111"]
    )
    assert [x[0][3] for x in (alone, told, doubted, far)] == [0.8, 1.0, 0.5, 0.8]


def test_empty_table_and_repeated_rows(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert scan_pii(empty).collect() == []
    twice = spark.createDataFrame([(None, "a@b.c"), (None, "a@b.c")], "doc_id long, text string")
    assert [len(r.pii) for r in scan_pii(twice).collect()] == [1, 1]
