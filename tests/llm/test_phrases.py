"""Phrases against a plain count of all word sequences, and the parts of the vertical partitioning."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from chorale.llm import phrases
from chorale.llm.phrases import collocations

SCHEMA = "doc_id long, text string, lang string, rank string, f string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, g, "clash", "clash") for i, (t, g) in enumerate(rows)], SCHEMA)


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def plain(rows, least, top):
    n, counts = Counter(), Counter()
    for text, lang in rows:
        for piece in re.split("[.,;:!?\x0a-\x0d]", lowered(text)):
            found = [w for w in re.split("[ \t]+", piece) if w]
            n[lang or "und"] += len(found)
            for d in range(1, 5):
                counts.update((lang or "und", tuple(found[i : i + d])) for i in range(len(found) - d + 1))
    listed = {k: a for k, a in counts.items() if len(k[1]) > 1 and a >= least}
    contained = set()
    for (lang, long), a in listed.items():
        for d in range(2, len(long)):
            for s in range(len(long) - d + 1):
                if 100 * a >= 80 * counts[lang, long[s : s + d]]:
                    contained.add((lang, long[s : s + d]))
    best = {}
    for (lang, p), a in listed.items():
        if (lang, p) not in contained:
            cuts = [(2_000_000 * a // (counts[lang, p[:k]] + counts[lang, p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            row = (-score, -a, " ".join(p).encode(), counts[lang, p[:k]], counts[lang, p[k:]])
            best.setdefault(lang, []).append(row)
    out = []
    for lang, found in best.items():
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], start=1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def corpus(seed=9):
    rng = random.Random(seed)
    words = ["the", "The", "of", "é", "É", "𝒳", "x\x00y", "a b", "und", "|"] + [f"w{k}" for k in range(25)]
    rows = []
    for _ in range(150):
        tokens = [words[min(len(words) - 1, int(rng.expovariate(0.15)))] for _ in range(rng.randint(0, 80))]
        text = "".join(t + rng.choice([" ", "  ", "\t", " ", ". ", "\n", ",", "\x0b"]) for t in tokens)
        rows.append((text, rng.choice(["fr", "fr", "de", None, "und"])))
    rows += [(None, "fr"), ("", None), ("...", "es"), ("the of " * 9_000, "fr"), rows[3], rows[3]]
    return rows + [("one very common line of the corpus", "de")] * 60


# a small budget lists prefixes of every depth and makes many groups; the large one makes one group
@pytest.mark.parametrize("budget, batch", [(2_000_000, 1 << 20), (400, 700), (40, 5_000)])
def test_phrases_equal_plain_counts(spark, monkeypatch, budget, batch):
    monkeypatch.setattr(phrases, "BATCH", batch)
    monkeypatch.setattr(phrases, "DISTINCT", 20)
    monkeypatch.setattr(phrases, "COMMON", 50)
    rows = corpus()
    got = collocations(frame(spark, rows).repartition(3), least=6, top=150, budget=budget).collect()
    assert sorted(map(tuple, got)) == plain(rows, 6, 150)
    assert {r.lang for r in got} >= {"fr", "de", "und"}


def test_a_map_full_of_wrong_answers_changes_nothing(spark, monkeypatch):
    monkeypatch.setattr(phrases, "BITS", 64)
    rows = corpus(2)
    got = collocations(frame(spark, rows), least=5, top=90).collect()
    assert sorted(map(tuple, got)) == plain(rows, 5, 90)


def test_words_are_cut_as_stated():
    assert phrases.words("A.b  C\tÉ!".encode()) == [b"a", b"\xff", b"b", b"", b"c", "É".encode(), b"\xff", b"", b"\xff"]


def test_heavy_prefixes_are_all_listed(spark):
    rows = [("a b c d", "fr")] * 500 + [(f"a x{k}", "fr") for k in range(300)]
    texts = phrases._texts(frame(spark, rows))
    common = spark.sparkContext.broadcast(np.full(phrases.BITS >> 6, -1, np.int64).view(np.uint64))
    listed = phrases._heavy_prefixes(texts, common, 2_600, 400)
    assert set(listed) == {("fr", p) for p in ("a", "a b", "a b c", "b", "b c", "b c d", "c", "c d", "d")}


def test_no_rows_and_no_candidates(spark):
    assert collocations(frame(spark, [])).collect() == []
    assert collocations(frame(spark, [(None, None), ("one two", "fr")])).collect() == []
    assert collocations(frame(spark, [("one", "fr")] * 40)).collect() == []
