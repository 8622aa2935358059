"""Inputs of the registered queries, read from the driver tables.

The documents are invented prose that rarely holds a lexicon term, so each one
is followed by a phrase picked by its id. The phrases touch every rule: links,
mentions, accents, emoji, repeated marks, ties and thresholds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chorale.session import spread

PHRASES = (
    "Bel effort @Équipe_1, CHOUETTE ! Quel régal pour tous 😀",
    "Lequel ??? A-t-on idée de l'horaire ¿ Voir https://t.co/Ab?x=1 vite",
    "Quel gâchis... c’est pénible, PÉNIBLE !!!",
    "L'élu local dit non : cortège demain, cortège partout",
    "d'abord le relevé, ensuite le bulletin",
    "héhé quelle aubaine, hehe",
    "La douane et l’escale à la ligne d’HORIZON ! Passeport signé",
    "talus 2024 : préau et cartable en fête ❤️",
    "awwwwesome awww www.lemonde.fr épatant",
    "“Ravi” mais quel gâchis",
    "Lequel ¿ À quand ¿ étant donné ensuite de ce fait",
    "lequel et ensuite",
    "relevé et oh joie",
    "casque, alarme, escale, douane",
    "a-t-on tu parles que j'approuve ¿ 5 %",
    "%¿%¿ ... ok",
    "ravissant aux urnes, quartiers, horaires",
    "poste de garde pour un sous-brigadier, conseil de quartier muet",
    "J’en peux plus, ras-la-casquette, c'est mal fichu",
    "bon à noter: 12 %, bulletin, mémo ! d'abord nous",
    "",
    "12.5 à l’urne du conseil de quartier; 112.5 non",
    "a-t-on ravi ¿ a-t-on idée chouette ¿ c'est malin héhé",
    "@ préau_@dictée @cartable x@y.fr cahier de textes",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _phrase(id_col: str) -> Column:
    return F.element_at(F.array(*map(F.lit, PHRASES)), (F.col(id_col) % len(PHRASES)).cast("int") + 1)


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``id, text``: every document with its phrase."""
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return docs.select(
        F.col("doc_id").alias("id"), F.concat_ws(" ", "text", _phrase("doc_id")).alias("text")
    )


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``id, text`` of the documents as they are."""
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return docs.withColumnRenamed("doc_id", "id")


def turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversation turns with one number as id."""
    rows = spread(table(spark, sf_dir, "conversations").select("conv_id", "turn", "text"))
    return rows.select(
        (F.col("conv_id") * 100_000 + F.col("turn")).alias("id"), "text"
    )


def messages_sql() -> str:
    """The text of ``messages`` in SQL, for the oracles."""
    quoted = ", ".join("'" + p.replace("'", "''") + "'" for p in PHRASES)
    return (
        f"SELECT doc_id AS id, concat_ws(' ', text, ([{quoted}])[(doc_id % {len(PHRASES)}) + 1]) AS text "
        "FROM documents"
    )


TURNS_SQL = "SELECT conv_id * 100000 + turn AS id, text FROM conversations"
DOCUMENTS_SQL = "SELECT doc_id AS id, text FROM documents"
