import random
import re

import pytest
from pyspark.sql import functions as F

from chorale.operators import labeling
from chorale.operators.lexicon import (
    AXES,
    DEMO_TERMS,
    LABEL_RANKS,
    LEXICON_SCHEMA,
    demo_lexicon,
    lexicon_frame,
    read_lexicon,
    weigh_terms,
)

POLARITY, TONE, TARGET = AXES


def label(spark, texts, terms=None, **kwargs):
    lexicon = demo_lexicon(spark) if terms is None else lexicon_frame(spark, terms)
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    rows = labeling.label_corpus(df, lexicon, **kwargs).orderBy("id").collect()
    return [(r.polarite, r.ton, r.target) for r in rows]


def test_repeated_spellings_add_weight(spark):
    rows = weigh_terms(lexicon_frame(spark, {"Politique": ["cortège", "cortege", " ", "urne"]})).collect()
    assert {r.term: r.weight for r in rows} == {"cortege": 2, "urne": 1}


def scores_of(spark, pairs, axis):
    ranks = LABEL_RANKS[axis.family]
    entries = [
        (axis.family, name, list(ranks).index(name), ranks[name], score) for name, score in pairs.items()
    ]
    return spark.createDataFrame([(entries,)], f"scores {labeling._SCORE_TYPE}")


@pytest.mark.parametrize(
    "pairs,expected",
    [
        ({}, "Autres"),
        ({"Question": 1, "Argumentatif": 1}, "Question"),
        ({"Informatif": 1, "Ironique": 1}, "Ironique"),
        ({"Question": 2, "Argumentatif": 2}, "Argumentatif;Question"),
        ({"Question": 5, "Ironique": 2}, "Question"),
        ({"Question": 4, "Ironique": 2, "Informatif": 3}, "Question;Informatif"),
        ({"Ironique": 2, "Informatif": 2, "Question": 2}, "Question;Informatif"),
        ({"Ironique": 1, "Informatif": 2}, "Informatif"),
    ],
)
def test_tone_choice(spark, pairs, expected):
    df = scores_of(spark, pairs, TONE)
    assert ";".join(df.select(labeling.top_labels(F.col("scores"), TONE)).first()[0]) == expected


@pytest.mark.parametrize(
    "axis,pairs,expected",
    [
        (POLARITY, {}, "Neutre"),
        (POLARITY, {"Favorable": 1, "Défavorable": 1}, "Défavorable"),
        (POLARITY, {"Favorable": 2, "Défavorable": 1}, "Favorable"),
        (TARGET, {}, "Autre"),
        (TARGET, {"International": 2, "Politique": 2}, "International"),
        (TARGET, {"Education": 2, "Sécurité": 2}, "Sécurité"),
        (TARGET, {"Politique": 2, "Education": 2}, "Education"),
    ],
)
def test_single_choice(spark, axis, pairs, expected):
    df = scores_of(spark, pairs, axis)
    assert df.select(labeling.best_label(F.col("scores"), axis)).first()[0] == expected


def test_texts(spark):
    texts = [None, "", "a-t-on idée", "ravissant", "cortège", "talus", "Bel EFFORT", "@talus", "ravi pénible", "12.5", "112.5"]
    assert label(spark, texts) == [
        ("Neutre", "Autres", "Autre"),
        ("Neutre", "Autres", "Autre"),
        ("Neutre", "Question", "Autre"),
        ("Neutre", "Autres", "Autre"),
        ("Neutre", "Autres", "Politique"),
        ("Neutre", "Autres", "Sécurité"),
        ("Favorable", "Autres", "Autre"),
        ("Neutre", "Autres", "Autre"),
        ("Défavorable", "Autres", "Autre"),
        ("Neutre", "Autres", "Politique"),
        ("Neutre", "Autres", "Autre"),
    ]


def brute_force(text, terms):
    """Score of one term list on cleaned text, one pattern at a time."""
    total = 0
    for term in terms:
        bounded = any(c.isalnum() for c in term)
        pattern = re.escape(term)
        total += len(re.findall(rf"(?<!\w){pattern}(?!\w)" if bounded else pattern, text))
    return total


TRICKY = {
    "Favorable": ["a", "a b", "a-b", "b a b", "c", "aa"],
    "Défavorable": ["?", "!", "b", "a b c", "b_c"],
    "Question": ["a.b", "ab", "a", "a", "?!"],
    "Politique": ["c a", "c c", "#a", "a'", "1", "b 1", "..", "ha ha"],
}


@pytest.mark.parametrize("terms,joined", [(TRICKY, False), (TRICKY, True), (DEMO_TERMS, False), (DEMO_TERMS, True)])
def test_scores_equal_one_pattern_per_term(spark, terms, joined):
    rng = random.Random(7)
    pool = sorted({t for v in terms.values() for t in v}) + list("abc1_ ?!.-'#é😀𝐀") + [" ", " "]
    texts = ["".join(rng.choice(pool) + rng.choice(["", " "]) for _ in range(rng.randint(0, 14))) for _ in range(400)]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    lexicon = lexicon_frame(spark, terms)
    scored = labeling.score_corpus(df, lexicon, inline_terms=0 if joined else 10_000)
    got = {(r.id, r.label): r.score for r in labeling.score_rows(scored).collect()}
    from chorale.functions.text import normalize_text

    clean = {r.id: r.c for r in df.select("id", normalize_text("text").alias("c")).collect()}
    entries = lexicon.select("label", normalize_text("term").alias("t")).where("t <> ''").collect()
    by_label = {}
    for e in entries:
        by_label.setdefault(e.label, []).append(e.t)
    expected = {
        (i, name): n for i, c in clean.items() for name, ts in by_label.items() if (n := brute_force(c, ts))
    }
    assert got == expected


def test_both_plans_agree_on_odd_terms_and_repeated_ids(spark):
    terms = {"Favorable": ["ha ha", "#lol", "merci"], "Question": ["..", "rien"], "Politique": ["a.b"]}
    texts = ["", None, "rien", "merci", "ha ha ha", "#lol #LOL", "a.b.b .. x", "rien"]
    assert label(spark, texts, terms, inline_terms=0) == label(spark, texts, terms)
    repeated = spark.createDataFrame([(1, "rien"), (1, "merci"), (1, "rien")], "id long, text string")
    lexicon = lexicon_frame(spark, terms)
    for limit in (0, 10):
        scored = labeling.score_rows(labeling.score_corpus(repeated, lexicon, inline_terms=limit))
        assert sorted((r.label, r.score) for r in scored.collect()) == [("Favorable", 1), ("Question", 1), ("Question", 1)]


def test_a_filter_on_a_label_does_not_repeat_the_rule(spark):
    df = labeling.label_corpus(spark.createDataFrame([(1, "ravi")], "id long, text string"), demo_lexicon(spark))

    def translations(frame):
        return frame._jdf.queryExecution().optimizedPlan().toString().count("regexp_extract_all")

    assert translations(df.where("polarite = 'Favorable'")) == translations(df)
    assert df.where("polarite = 'Favorable'").count() == 1


def test_labelling_is_a_projection_without_a_shuffle(spark, tmp_path):
    spark.range(10).selectExpr("id", "'merci ?' AS text").write.parquet(str(tmp_path / "t"))
    df = labeling.label_corpus(spark.read.parquet(str(tmp_path / "t")), demo_lexicon(spark))
    assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()


def test_existing_columns_stay(spark):
    df = spark.createDataFrame([(1, "ravi", "x", "")], "id long, text string, extra string, ton string")
    row = labeling.label_corpus(df, demo_lexicon(spark)).first()
    assert (row.extra, row.text, row.polarite, row.ton) == ("x", "ravi", "Favorable", "Autres")


def test_distribution_counts_joined_tones(spark):
    df = spark.createDataFrame(
        [("Neutre", "A;B", "Autre"), ("Neutre", "A", "Autre"), ("Favorable", "A;B", "Autre")],
        "polarite string, ton string, target string",
    )
    got = {(r.axis, r.label): (r["count"], r.total, round(r.percentage, 4)) for r in labeling.label_distribution(df).collect()}
    assert got == {
        ("polarite", "Neutre"): (2, 3, 66.6667),
        ("polarite", "Favorable"): (1, 3, 33.3333),
        ("ton", "A;B"): (2, 3, 66.6667),
        ("ton", "A"): (1, 3, 33.3333),
        ("target", "Autre"): (3, 3, 100.0),
    }


def test_lexicon_file(spark, tmp_path):
    path = str(tmp_path / "lexicon")
    shuffled = demo_lexicon(spark).select("term", "priority", "label", "family", "label_pos")
    shuffled.write.option("header", True).option("escape", '"').csv(path)
    again = read_lexicon(spark, path)
    assert again.schema.fieldNames() == LEXICON_SCHEMA.fieldNames()
    assert sorted(again.collect()) == sorted(demo_lexicon(spark).collect())


def test_equal_spans_leave_a_block_once(spark, monkeypatch):
    texts = ["a b, c a b"] * 300 + ["b-c a", "", "?", "c"]
    clean = spark.createDataFrame(list(enumerate(texts)), "_row long, _clean string").coalesce(1)
    index = labeling._first_words(spark.createDataFrame([("a b",), ("b-c a",)], "term string"))
    for words, blocks in ((1_000_000, 1), (100, 16)):
        monkeypatch.setattr(labeling, "BLOCK_WORDS", words)
        monkeypatch.setattr(labeling, "small_batches", lambda s: s.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "20"))
        rows = labeling._spans(clean, index, 3).collect()
        assert len(rows) <= 9 * blocks
        counted = {}
        for r in rows:
            for at, n in zip(r.rows, r.times):
                counted[at, r.term] = counted.get((at, r.term), 0) + n
        assert {t: n for (at, t), n in counted.items() if at == 7} == {
            "a": 2, "b": 2, "a b": 2, "b, c": 1, "a b, c": 1, "b, c a": 1
        }
        assert {t: n for (at, t), n in counted.items() if at == 300} == {"b": 1, "a": 1, "b-c": 1, "b-c a": 1}
        assert sum(counted.values()) == 9 * 300 + 4


def test_any_number_of_odd_terms_is_counted_beside_a_joined_lexicon(spark, monkeypatch):
    terms = {"Favorable": ["#lol", "c++", "..", "ha ha", "a b a"], "Question": ["?", "_", "a'", "#lol"], "Politique": ["b c"]}
    texts = ["#lol c++ ha ha ha ha .. x_y", "a b a b a b a ? a' _", "ha ha, ha ha ha b c", "#lol #lol"]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    lexicon = lexicon_frame(spark, terms)

    def scored(limit):
        return sorted(map(tuple, labeling.score_rows(labeling.score_corpus(df, lexicon, inline_terms=limit)).collect()))

    expected = scored(100)
    assert (0, "polarite", "Favorable", 5) in expected and (1, "polarite", "Favorable", 2) in expected
    for counted in (1, 2, 1_000):
        monkeypatch.setattr(labeling, "COUNTED_TERMS", counted)
        assert scored(0) == expected


def test_a_large_lexicon_has_the_pairs_of_equal_words(spark, tmp_path):
    from chorale.plans.catalog import label_scores_large

    spark.createDataFrame([(1, 0, "the the cat, them the")], "conv_id long, turn int, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    texts = [(1, "the the the"), (2, "them the dog"), (3, "cat, them"), (4, None)]
    spark.createDataFrame(texts, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {(r.id, r.family): r.score for r in label_scores_large(spark, str(tmp_path)).collect()}
    # of odd length: "the", "cat", "the the"; of even length: "them", "them the", "the cat"
    assert got == {(1, "target"): 4, (2, "polarite"): 2, (2, "target"): 1, (3, "polarite"): 1, (3, "target"): 1}
