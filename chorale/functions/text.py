"""Text rules as Spark column expressions.

Everything here but counted n-grams is a JVM-side expression: no Python runs per row, so a scan
followed by :func:`normalize_text` stays one stage without a shuffle.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from chorale.functions.grams import gram_tables

# Character classes. Java's \w and \s are ASCII-only, so the
# Unicode meaning is spelled out. The same strings are valid in RE2.
WORD = r"[\p{L}\p{N}_]"
SPACE = r"[\s\x1c-\x1f\x85\p{Z}]"
NON_SPACE = r"[^\s\x1c-\x1f\x85\p{Z}]"
# No word character before. The bold A, itself a letter, makes Java step back
# by whole code points; without one it would look at half a surrogate pair.
WORD_START = r"(?<![\p{L}\p{N}_𝐀])"
WORD_END = f"(?!{WORD})"

# The cleaning patterns.
HTTP_URL = "https?://" + NON_SPACE + "+"
WWW_URL = "www" + NON_SPACE + "+"
MENTION = "@" + WORD + "+"
MENTION_TOKEN = "@USER"
REPEATED_MARK = r"([!?.])\1+"
CURLY_QUOTES = "’‘“”"
STRAIGHT_QUOTES = "''\"\""

# Unicode Emoji=Yes code points without ASCII digits, '#', '*'
# and single regional indicators. Hexadecimal ranges.
EMOJI_RANGES = """
A9 AE 203C 2049 2122 2139 2194-2199 21A9-21AA 231A-231B 2328 23CF 23E9-23F3 23F8-23FA 24C2 25AA-25AB 25B6 25C0
25FB-25FE 2600-2604 260E 2611 2614-2615 2618 261D 2620 2622-2623 2626 262A 262E-262F 2638-263A 2640 2642 2648-2653
265F-2660 2663 2665-2666 2668 267B 267E-267F 2692-2697 2699 269B-269C 26A0-26A1 26A7 26AA-26AB 26B0-26B1 26BD-26BE
26C4-26C5 26C8 26CE-26CF 26D1 26D3-26D4 26E9-26EA 26F0-26F5 26F7-26FA 26FD 2702 2705 2708-270D 270F 2712 2714 2716
271D 2721 2728 2733-2734 2744 2747 274C 274E 2753-2755 2757 2763-2764 2795-2797 27A1 27B0 27BF 2934-2935 2B05-2B07
2B1B-2B1C 2B50 2B55 3030 303D 3297 3299 1F004 1F0CF 1F170-1F171 1F17E-1F17F 1F18E 1F191-1F19A 1F201-1F202 1F21A
1F22F 1F232-1F23A 1F250-1F251 1F300-1F321 1F324-1F393 1F396-1F397 1F399-1F39B 1F39E-1F3F0 1F3F3-1F3F5 1F3F7-1F4FD
1F4FF-1F53D 1F549-1F54E 1F550-1F567 1F56F-1F570 1F573-1F57A 1F587 1F58A-1F58D 1F590 1F595-1F596 1F5A4-1F5A5 1F5A8
1F5B1-1F5B2 1F5BC 1F5C2-1F5C4 1F5D1-1F5D3 1F5DC-1F5DE 1F5E1 1F5E3 1F5E8 1F5EF 1F5F3 1F5FA-1F64F 1F680-1F6C5
1F6CB-1F6D2 1F6D5-1F6D9 1F6DC-1F6E5 1F6E9 1F6EB-1F6EC 1F6F0 1F6F3-1F6FC 1F7E0-1F7EB 1F7F0 1F90C-1F93A 1F93C-1F945
1F947-1F9FF 1FA70-1FA7C 1FA80-1FAC6 1FAC8 1FACC-1FADD 1FADF-1FAEB 1FAEF-1FAFA
"""


def _emoji_points() -> list[int]:
    points: list[int] = []
    for item in EMOJI_RANGES.split():
        first, _, last = item.partition("-")
        points.extend(range(int(first, 16), int(last or first, 16) + 1))
    return points


def emoji_class() -> str:
    """The emoji ranges as one regex class, in a syntax Java and RE2 share."""
    ends = (r.split("-") for r in EMOJI_RANGES.split())
    return "[" + "".join("-".join(rf"\x{{{e}}}" for e in pair) for pair in ends) + "]"


@lru_cache(maxsize=1)
def _accent_tables() -> tuple[dict[str, str], dict[str, str]]:
    """Accent folding derived from the Unicode database of this interpreter.

    Returns ``(short, long)``: characters that fold to one character or to
    nothing, and the few (outside Hangul, which follows an arithmetic rule)
    whose folding is longer.
    """
    short, long = {}, {}
    for point in range(0x110000):
        if 0xD800 <= point <= 0xDFFF or 0xAC00 <= point <= 0xD7A3:
            continue
        char = chr(point)
        if not (unicodedata.combining(char) or unicodedata.decomposition(char)):
            continue
        parts = unicodedata.normalize("NFD", char)
        folded = "".join(p for p in parts if unicodedata.combining(p) == 0)
        if folded != char:
            (short if len(folded) < 2 else long)[char] = folded
    return short, long


def _translate(col: Column, table: dict[str, str]) -> Column:
    """``translate`` by a table of single characters; an empty value drops its key."""
    kept = [k for k, v in table.items() if v]
    dropped = [k for k, v in table.items() if not v]
    return F.translate(col, "".join(kept + dropped), "".join(table[k] for k in kept))


def _fold_long_forms(col: Column) -> Column:
    """Character-wise folding for text with Hangul syllables or two-part vowels."""
    table = F.create_map(*[F.lit(x) for pair in _accent_tables()[1].items() for x in pair])
    leads = F.lit("".join(map(chr, range(0x1100, 0x1113))))
    vowels = F.lit("".join(map(chr, range(0x1161, 0x1176))))
    tails = F.lit("".join(map(chr, range(0x11A8, 0x11C3))))

    def one(c: Column) -> Column:
        s = F.ascii(c) - 0xAC00
        lead = F.substring(leads, F.floor(s / 588).cast("int") + 1, 1)
        vowel = F.substring(vowels, F.floor((s % 588) / 28).cast("int") + 1, 1)
        tail = F.when(s % 28 > 0, F.substring(tails, s % 28, 1)).otherwise("")
        return F.when(c.between("가", "힣"), F.concat(lead, vowel, tail)).otherwise(
            F.coalesce(F.try_element_at(table, c), c)
        )

    return F.array_join(F.transform(F.split(col, ""), one), "")


def _fold_characters(col: Column, table: dict[str, str]) -> Column:
    """Apply a short-form table; rows with long forms also go character by character."""
    short = _translate(col, table)
    # The outer range rejects most characters in one comparison.
    members = "가-힣" + "".join(_accent_tables()[1])
    long_forms = rf"[\x{{9CB}}-\x{{1FFFF}}&&[{members}]]"
    return F.when(short.rlike(long_forms), _fold_long_forms(short)).otherwise(short)


def strip_accents(col: Column) -> Column:
    """Canonical decomposition without combining marks."""
    return _fold_characters(col, _accent_tables()[0])


@lru_cache(maxsize=1)
def _cleaning_table() -> dict[str, str]:
    """Quotes, accents and emoji in one table.

    Folding quotes early or late is the same, since no pattern in between
    tells curly from straight; accents and emoji are neighbouring steps.
    """
    emoji = {chr(p) for p in _emoji_points()}
    table = dict(zip(CURLY_QUOTES, STRAIGHT_QUOTES)) | _accent_tables()[0]
    return {k: "" if v in emoji else v for k, v in table.items()} | dict.fromkeys(emoji, "")


def normalize_text(col: Column | str) -> Column:
    """The full cleaning rule; the order of the steps is part of the contract."""
    t = F.lower(F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit("")))
    t = F.regexp_replace(t, HTTP_URL, "")
    t = F.regexp_replace(t, WWW_URL, "")
    t = F.regexp_replace(t, MENTION, MENTION_TOKEN)
    t = _fold_characters(t, _cleaning_table())
    t = F.regexp_replace(t, REPEATED_MARK, "$1")
    return F.trim(F.regexp_replace(t, SPACE + "+", " "))


def words(col: Column | str) -> Column:
    """Whitespace-separated words as an array; empty text gives an empty array."""
    return F.regexp_extract_all(col, F.lit(NON_SPACE + "+"), F.lit(0))


def word_count(col: Column | str) -> Column:
    return F.regexp_count(col, F.lit(NON_SPACE + "+"))


def is_blank(col: Column | str) -> Column:
    """True for text without any non-whitespace character; NULL counts as blank."""
    c = F.col(col) if isinstance(col, str) else col
    return ~F.coalesce(c, F.lit("")).rlike(NON_SPACE)


def spaced_line(col: Column | str) -> Column:
    """The words joined by single spaces, with a space at either end."""
    c = F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(c, SPACE + "+", " ")), F.lit(" "))


def char_ngrams(line: Column | str, n_min: int = 1, n_max: int = 4, counted: bool = False) -> Column:
    """Character n-grams inside word bounds, with repeats, of a :func:`spaced_line`.

    ``counted``: each n-gram once, as the lists ``terms`` and ``counts`` of a struct, made in Arrow batches. A text
    repeats its n-grams, so this is several times less to write down and needs no search for equal ones.

    Each word gets one space on either side. In a spaced line an n-gram of
    length two or more is a window whose only spaces are at its ends, and one
    look-ahead regex per length lists them all. Only the single space needs
    counting apart: neighbouring words share it here. Project the line to a
    column first, so that it is built once for all lengths.
    """
    if not 1 <= n_min <= n_max:
        raise ValueError(f"bad n-gram range: ({n_min}, {n_max})")
    line = F.col(line) if isinstance(line, str) else line
    if counted:

        @F.arrow_udf("struct<terms:array<string>,counts:array<long>>")
        def tables(lines: pa.Array) -> pa.Array:
            return gram_tables(lines, n_min, n_max)

        return tables.asNondeterministic()(line)  # made once, whatever is read from it

    def windows(n: int) -> str:
        forms = [f"[^ ]{{{n}}}", f" [^ ]{{{n - 1}}}", f"[^ ]{{{n - 1}}} "]
        if n > 2:
            forms.append(f" [^ ]{{{n - 2}}} ")
        # Consuming one character keeps the search on whole code points.
        return "(?=(" + "|".join(forms) + "))(?s:.)"

    parts = []
    if n_min == 1:
        spaces = F.regexp_count(line, F.lit("[^ ]+")) * 2
        parts.append(F.array_repeat(F.lit(" "), spaces))
        parts.append(F.regexp_extract_all(line, F.lit("[^ ]"), F.lit(0)))
    if n_min > 3:  # words shorter than the smallest length count once, whole
        parts.append(
            F.regexp_extract_all(line, F.lit(f"(?=( [^ ]{{1,{n_min - 3}}} )) "), F.lit(1))
        )
    for n in range(max(2, n_min), n_max + 1):
        parts.append(F.regexp_extract_all(line, F.lit(windows(n)), F.lit(1)))
    return F.concat(*parts)
