"""Keyword lexicons: an input table, cleaned with the same rule as the text."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chorale.functions.text import normalize_text
from chorale.sources.checks import require_columns
from chorale.sources.files import read_csv

LEXICON_SCHEMA = T.StructType(
    [
        T.StructField("family", T.StringType(), False),
        T.StructField("label", T.StringType(), False),
        T.StructField("label_pos", T.IntegerType(), False),
        T.StructField("priority", T.IntegerType(), False),
        T.StructField("term", T.StringType(), True),
    ]
)


@dataclass(frozen=True)
class Axis:
    """How one family of labels turns scores into a decision."""

    family: str
    default: str
    labels_kept: int = 1  # more than one makes the axis multi-label
    min_score: int = 1
    min_ratio: float = 1.0

    @property
    def multi(self) -> bool:
        return self.labels_kept > 1


# The three axes, their labels in lexicon order with the rank
# that settles ties, their defaults and the multi-label thresholds.
AXES = (
    Axis("polarite", "Neutre"),
    Axis("ton", "Autres", labels_kept=2, min_score=2, min_ratio=0.5),
    Axis("target", "Autre"),
)
LABEL_RANKS = {
    "polarite": {"Favorable": 1, "Défavorable": 0},
    "ton": {"Question": 1, "Argumentatif": 0, "Ironique": 3, "Informatif": 2},
    "target": {"Politique": 3, "Sécurité": 1, "Education": 2, "International": 0},
}

# Made up for demonstrations and tests: everyday words, a spelling that repeats after accent folding, a term under two
# labels of one axis and of two axes, terms inside longer ones, hyphens, apostrophes, a number and one-character symbols.
# Production lists are data: read them with ``read_lexicon``.
DEMO_TERMS = {
    "Favorable": ["chouette", "ravi", "épatant", "vivement", "bel effort", "quel régal", "j'approuve"],
    "Défavorable": ["pénible", "décevant", "mal fichu", "quel gâchis", "ras-la-casquette", "j'en peux plus"],
    "Question": ["¿", "lequel", "d'où", "à quand", "a-t-on", "a-t-on idée", "se peut-il"],
    "Argumentatif": ["d'abord", "ensuite", "étant donné", "de ce fait", "il s'avère", "à mes yeux", "mémo"],
    "Ironique": ["héhé", "oh joie", "tu parles", "c'est malin", "quelle aubaine"],
    "Informatif": ["%", "mémo", "bulletin", "relevé", "tableau", "à noter", "bon à noter"],
    "Politique": ["urne", "pétition", "cortège", "cortege", "12.5", "quartier", "conseil de quartier", "élu local"],
    "Sécurité": ["casque", "alarme", "extincteur", "garde", "poste de garde", "sous-brigadier", "talus"],
    "Education": ["cartable", "préau", "dictée", "tableau", "cahier de textes", "talus"],
    "International": ["escale", "douane", "passeport", "horaire", "fuseau horaire", "ligne d'horizon"],
}


def lexicon_frame(
    spark: SparkSession,
    terms: dict[str, list[str]],
    ranks: dict[str, dict[str, int]] = LABEL_RANKS,
) -> DataFrame:
    """A lexicon table from ``{label: terms}``; label order is the order of ``ranks``."""
    rows = [
        (family, label, pos, rank, term)
        for family, labels in ranks.items()
        for pos, (label, rank) in enumerate(labels.items())
        for term in terms.get(label, [])
    ]
    return spark.createDataFrame(rows, LEXICON_SCHEMA)


def demo_lexicon(spark: SparkSession) -> DataFrame:
    return lexicon_frame(spark, DEMO_TERMS)


def read_lexicon(spark: SparkSession, path: str) -> DataFrame:
    """A lexicon stored as CSV, its columns found by name."""
    return read_csv(spark, path, LEXICON_SCHEMA)


def weigh_terms(lexicon: DataFrame) -> DataFrame:
    """Clean the terms, drop empty ones and count repeats as a weight.

    Two spellings that clean to the same term both count, so the weight is the
    number of entries a term stands for under its label.
    """
    require_columns(lexicon, LEXICON_SCHEMA.fieldNames(), "lexicon")
    return (
        lexicon.withColumn("term", normalize_text("term"))
        .where(F.col("term") != "")
        .groupBy("family", "label", "label_pos", "priority", "term")
        .agg(F.count("*").alias("weight"))
    )
