"""From raw documents to token ids: each stage works on all rows that the one before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chorale.llm.common import materialize, table
from chorale.llm.minhash import flagged, near_duplicates
from chorale.llm.mixing import mix_sources
from chorale.llm.secrets import redact, scan_secrets
from chorale.llm.sentencepiece import encode
from chorale.llm.toxicity import THRESHOLD, fit_toxicity, held_out, score_toxicity

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the toxicity threshold, by a model of the labels outside the held-out quarter."""
    labels = table(spark, sf_dir, "labels").where(~held_out(F.col("doc_id")))
    return score_toxicity(docs, fit_toxicity(docs, labels)).where(F.col("toxicity.score") < THRESHOLD).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group, that of the smallest id; documents without words all stay."""
    # ids may be null or repeat: rows are grouped by a number of their own, stored so that it stays the same
    numbered = materialize(docs.select(*COLUMNS).withColumn("row", F.monotonically_increasing_id()), "numbered-documents")
    grouped = near_duplicates(numbered, doc_id="row").select(F.col("doc_id").alias("row"), "component_id")
    grouped = materialize(grouped, "document-groups")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("first")
    kept = grouped.join(numbered.select("row", "doc_id"), "row").groupBy("component_id").agg(first).select("first.row")
    # the rows left out are few, and a bit map tells most others apart from them, so that few texts are moved
    dropped = grouped.join(kept, "row", "left_anti").select("row", F.xxhash64("row").alias("key"))
    dropped = materialize(dropped, "dropped-documents")
    told = flagged(numbered.withColumn("key", F.xxhash64("row")), dropped, "key")
    asked = told.where("likely").join(dropped.select("row"), "row", "left_anti")
    return told.where("NOT likely").select(*COLUMNS).unionByName(asked.select(*COLUMNS))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with a mark in place of every secret."""
    found = scan_secrets(docs.select(*COLUMNS))
    masked = found.withColumn("masked", redact(F.col("text"), F.col("secrets")))
    length = F.when(F.size("secrets") > 0, F.length("masked").cast("long")).otherwise(F.col("n_chars"))
    return masked.select("doc_id", F.col("masked").alias("text"), "lang", "source", length.alias("n_chars"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """As many copies of each document as its source's share asks for."""
    mixed = mix_sources(docs.select(*COLUMNS))
    return mixed.withColumn("copy", F.explode(F.array_repeat(F.lit(1), F.col("mix.copies")))).select(*COLUMNS)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document."""
    return encode(docs.select(*COLUMNS)).select("doc_id", "lang", "source", "ids", F.size("ids").cast("long").alias("n_ids"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near duplicates", drop_near_duplicates),
    ("secret scans", mask_secrets),
    ("mixing", mix),
    ("sentencepiece", tokenize),
]

#: Learned scores, signatures and segmentation have no SQL form; tests compare the stages with plain versions of them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
