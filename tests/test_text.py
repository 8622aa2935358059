import random
import unicodedata

import pytest
from pyspark.sql import functions as F

from chorale.functions.text import (
    _emoji_points,
    char_ngrams,
    normalize_text,
    spaced_line,
    strip_accents,
    word_count,
    words,
)


def frame(spark, values):
    return spark.createDataFrame(list(enumerate(values)), "id int, text string")


def values(df, col):
    return [r[0] for r in df.orderBy("id").select(col).collect()]


CLEANED = {
    None: "",
    "": "",
    "Élève @Jean_D1! Voir https://t.co/A?x=1 ok": "eleve @USER! voir ok",
    "awwwwesome awww www.lemonde.fr": "a awww",
    "Quoi ??? Non!!! bien...": "quoi ? non! bien.",
    "!?!?": "!?!?",
    "L’ami dit “oui” et ‘non’": "l'ami dit \"oui\" et 'non'",
    "œuvre": "œuvre",
    "wwwhttp://x y": "www y",
    "a😀b ©x": "ab x",
    "❤️ !😀!": "️ !",
    "a  b\x85c\x1cd\n e ": "a b c d e",
    "…… ....": "…… .",
    "@é x": "@USER x",
    "@é x": "@USER x",
    "@éa x": "@USERa x",
    "Ångström @ seul": "angstrom @ seul",
    "한글": unicodedata.normalize("NFD", "한글"),
    "@ஔ x": "@USER x",
}


def test_cleaning_cases(spark):
    assert values(frame(spark, CLEANED), normalize_text("text")) == list(CLEANED.values())


def test_accents_follow_the_unicode_database_on_every_code_point(spark):
    points = [p for p in range(1, 0x110000) if not 0xD800 <= p <= 0xDFFF]
    df = spark.createDataFrame([(p, chr(p)) for p in points], "p int, c string")
    folded = df.select("p", strip_accents(F.col("c")).alias("f")).where("f <> c or f = ''").collect()
    found = {r.p: r.f for r in folded}
    for p in points:
        parts = unicodedata.normalize("NFD", chr(p))
        kept = "".join(x for x in parts if unicodedata.combining(x) == 0)
        assert found.get(p, chr(p)) == kept


def test_every_listed_emoji_is_dropped_and_joiners_stay(spark):
    points = _emoji_points()
    assert len(points) == 1409
    text = "a".join(map(chr, points))
    # The circled M has a lower-case form, which is no emoji.
    assert values(frame(spark, [text]), normalize_text("text")) == ["a" * 32 + "ⓜ" + "a" * (len(points) - 33)]
    flags_and_joiners = "x\U0001f1eb\U0001f1f7‍y"
    assert values(frame(spark, [flags_and_joiners]), normalize_text("text")) == [flags_and_joiners]


def test_words_split_on_unicode_whitespace(spark):
    texts = ["", "  ", "a", " a b c\td ", "é\x1fè"]
    df = frame(spark, texts)
    assert values(df, words("text")) == [t.split() for t in texts]
    assert values(df, word_count("text")) == [len(t.split()) for t in texts]


def windows(text, low, high):
    """All n-grams by slicing padded words; a word shorter than ``low`` counts once."""
    out = []
    for word in text.split():
        padded = f" {word} "
        if len(padded) < low:
            out.append(padded)
        for n in range(low, min(high, len(padded)) + 1):
            out += [padded[i : i + n] for i in range(len(padded) - n + 1)]
    return sorted(out)


@pytest.mark.parametrize("low,high", [(1, 4), (1, 1), (2, 3), (3, 3), (4, 6), (6, 7)])
def test_ngrams_equal_slices_of_padded_words(spark, low, high):
    rng = random.Random(low * 10 + high)
    texts = ["", "a", "a bc", "été 😀 x"] + [
        "".join(rng.choice("ab é \n") for _ in range(rng.randint(0, 30))) for _ in range(60)
    ]
    got = values(frame(spark, texts), char_ngrams(spaced_line("text"), low, high))
    assert [sorted(g) for g in got] == [windows(t, low, high) for t in texts]


def test_bad_ngram_range():
    with pytest.raises(ValueError):
        char_ngrams("text", 3, 2)
