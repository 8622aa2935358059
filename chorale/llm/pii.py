"""Personal data in text: patterns propose spans, check digits confirm them, words nearby adjust their score.

Every step is a column expression and nothing is shuffled. Patterns are searched only where a cheap test allows a
match. Each proposed span gets a score: what its pattern is worth, more if its check digits hold (Luhn for cards,
modulo 97 for IBANs), more again if a word of its kind stands within ``AROUND`` characters before it or after it, less
if a word stands there that speaks against it (order and version numbers, page counts). The four base kinds are
reported whenever their rule holds, whatever their score; the further kinds, IBANs and social security numbers, need
``LEAST``.

The base patterns are written so that a long run of one character class costs time in proportion to its length:
quantifiers that cannot give anything back are possessive, and a match starts where a run starts or where the last
match ended. What they match is unchanged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chorale.llm.secrets import _found

# The patterns of the task, kinds in their stated order; further kinds follow.
BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "iban", "ssn")
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"(?:\G|(?<![0-9]))(?=(?:[0-9][\x20-]?){13}[0-9])[0-9]++(?:[\x20-][0-9]++)*+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
#: Country, check digits and 11 to 30 further characters, at once or in groups of four.
IBAN = r"\b[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?:\x20[A-Z0-9]{4}){2,7}(?:\x20[A-Z0-9]{1,3})?)\b"
#: Area, group and serial number; areas 000, 666 and 900 to 999 and zero groups are never given out.
SSN, NO_SSN = r"\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b", "^(000|666|9)|-00-|-0000$"

CARD_DIGITS, PHONE_DIGITS, BYTE = (14, 19), (10, 15), 255
#: Characters looked at on each side, words for and against each kind, and what they are worth.
AROUND = 40
FOR = {
    "email": "mail|contact|address|write|adresse|correo",
    "ip": r"\bip\b|host|server|address|adresse",
    "card": "card|credit|visa|payment|karte|carte|tarjeta",
    "phone": r"phone|\btel\b|call|mobile|telef|téléphone",
    "iban": "iban|bank|account|konto|compte|cuenta",
    "ssn": r"ssn|social|security|insurance|sécurité sociale",
}
AGAINST = {
    "ip": "version|release|section",
    "card": "order|invoice|tracking|isbn",
    "phone": "order|invoice|isbn",
    "iban": "serial|part",
    "ssn": "order|part|serial|isbn",
}
#: Worth of the pattern alone, of check digits that hold, of words for it, and of words against it.
PATTERN = {"email": 0.9, "ip": 0.6, "card": 0.3, "phone": 0.5, "iban": 0.2, "ssn": 0.3}
CHECKED, FAVOUR, DOUBT, LEAST = 0.5, 0.3, 0.3, 0.5
SPAN = "struct<kind:string,start:int,end:int,score:double>"


def digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits passes Luhn's check: every second digit from the right doubled, the sum ending in 0."""
    values = F.transform(F.filter(F.split(F.reverse(number), ""), lambda c: c != ""), lambda c: c.cast("int"))
    doubled = F.transform(values, lambda v, i: F.when(i % 2 == 0, v).when(v > 4, v * 2 - 9).otherwise(v * 2))
    return F.aggregate(doubled, F.lit(0), lambda s, v: s + v) % 10 == 0


def mod97(iban: Column) -> Column:
    """Whether the remainder by 97 is 1, of the number with its first four characters last and A to Z as 10 to 35."""
    plain = F.regexp_replace(iban, " ", "")
    turned = F.concat(F.substring(plain, F.lit(5), F.length(plain)), F.substring(plain, 1, 4))
    values = F.transform(F.filter(F.split(turned, ""), lambda c: c != ""), lambda c: F.conv(c, 36, 10).cast("int"))
    left = F.aggregate(values, F.lit(0), lambda r, v: (r * F.when(v > 9, F.lit(100)).otherwise(F.lit(10)) + v) % 97)
    return left == 1


def _byte(part: Column) -> Column:
    """Whether a string of digits, however long, is at most 255."""
    plain = F.ltrim(part, F.lit("0"))
    return (F.length(plain) <= 3) & (F.coalesce(plain.try_cast("int"), F.lit(0)) <= BYTE)


def _between(n: Column, bounds: tuple[int, int]) -> Column:
    return (n >= bounds[0]) & (n <= bounds[1])


#: Per kind: pattern, cheap test of the text, rule that a match must meet, check digits (if the kind has them).
def _rules() -> dict[str, tuple]:
    return {
        "email": (EMAIL, lambda t: t.contains("@"), None, False),
        "ip": (IP, lambda t: t.rlike(r"[0-9]\.[0-9]++\.[0-9]"), lambda m: F.forall(F.split(m, r"\."), _byte), False),
        "card": (CARD, lambda t: t.rlike(CARD), lambda m: _between(F.length(digits(m)), CARD_DIGITS) & luhn(digits(m)), True),
        "phone": (PHONE, lambda t: t.contains("+"), lambda m: _between(F.length(digits(m)), PHONE_DIGITS), False),
        "iban": (IBAN, lambda t: t.rlike(r"\b[A-Z]{2}[0-9]{2}"), mod97, True),
        "ssn": (SSN, lambda t: t.rlike(r"[0-9]-[0-9]{2}-[0-9]"), lambda m: ~m.rlike(NO_SSN), False),
    }


def _spans(text: Column, kind: str) -> Column:
    """Spans of one kind with their scores; matches that fail the kind's rule are dropped without another try."""
    pattern, test, rule, checked = _rules()[kind]

    def scored(m: Column) -> Column:
        before = F.substring(text, F.greatest(m["start"] - AROUND, F.lit(0)) + 1, F.least(m["start"], F.lit(AROUND)))
        near = F.lower(F.concat(before, F.lit(" "), F.substring(text, m["end"] + 1, F.lit(AROUND))))
        score = F.lit(PATTERN[kind] + (CHECKED if checked else 0.0)) + F.when(near.rlike(FOR[kind]), FAVOUR).otherwise(0.0)
        if kind in AGAINST:
            score = score - F.when(near.rlike(AGAINST[kind]), DOUBT).otherwise(0.0)
        score = F.greatest(F.least(F.round(score, 2), F.lit(1.0)), F.lit(0.0))
        return F.struct(F.lit(kind).alias("kind"), m["start"].alias("start"), m["end"].alias("end"), score.alias("score"))

    found = _found(text, pattern)
    if rule is not None:
        found = F.filter(found, lambda m: rule(m["match"]))
    spans = F.transform(found, scored)
    if kind not in BASE:
        spans = F.filter(spans, lambda s: s["score"] >= LEAST)
    return F.when(test(text), spans).otherwise(F.expr(f"cast(array() as array<{SPAN}>)"))


def scan_pii(documents: DataFrame, *, text: str = "text", out: str = "pii") -> DataFrame:
    """``documents`` with an array of spans (``kind``, ``start``, ``end``, ``score``) by start and kind.

    Offsets are code points, ends exclusive. Null and empty texts have no spans. Kinds are searched independently, so
    spans of different kinds may overlap: a phone number can hold a card number. A column named ``out`` is replaced;
    other columns, repeated rows and empty tables pass unchanged.
    """
    taken = [F.col(f"`{c}`") for c in documents.columns if c.lower() != out.lower()]
    whole = F.coalesce(F.col(text), F.lit(""))
    order = F.create_map(*[x for i, kind in enumerate(KINDS) for x in (F.lit(kind), F.lit(i))])
    placed = F.transform(
        F.concat(*[_spans(whole, kind) for kind in KINDS]),
        lambda s: F.struct(s["start"].alias("start"), order[s["kind"]].alias("rank"), s.alias("span")),
    )
    return documents.select(*taken, F.transform(F.array_sort(placed), lambda s: s["span"]).alias(out))
