"""Scoring of messages as they arrive.

Labelling and prediction decide each message within its row, so a stream runs
the batch operators unchanged, without state, and Spark's file sink gives
exactly-once output. Only the running distribution keeps state: one counter
per axis and label.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from chorale.operators.labeling import TermMatcher, decide, score_inline
from chorale.operators.learning import MessageClassifier
from chorale.operators.lexicon import AXES
from chorale.operators.scoring import assemble_predictions
from chorale.operators.tfidf import TfidfModel


def read_messages(
    spark: SparkSession,
    path: str,
    schema: str,
    file_format: str = "json",
    files_per_trigger: int = 1_000,
    partitions: int | None = None,
) -> DataFrame:
    """New files below ``path`` as a stream.

    ``partitions`` rebalances a feed of few files over that many tasks; leave
    it out where a batch holds more files than the cluster has cores.
    """
    stream = (
        spark.readStream.schema(schema)
        .format(file_format)
        .option("maxFilesPerTrigger", files_per_trigger)
        .load(path)
    )
    return stream.repartition(partitions) if partitions else stream


def label_messages(stream: DataFrame, matcher: TermMatcher, text_col: str = "text") -> DataFrame:
    """Lexicon labels for every message."""
    return decide(score_inline(stream, matcher, text_col))


def predict_messages(stream: DataFrame, tfidf: TfidfModel, classifier: MessageClassifier) -> DataFrame:
    """Model predictions for every message."""
    scored = classifier.score(tfidf.features(stream))
    return assemble_predictions(scored, classifier.class_arrays())


def write_available(stream: DataFrame, out: str, checkpoint: str, file_format: str = "parquet") -> StreamingQuery:
    """Append everything available to files, then stop; a rerun takes up only new input."""
    return (
        stream.writeStream.format(file_format)
        .option("checkpointLocation", checkpoint)
        .option("path", out)
        .trigger(availableNow=True)
        .outputMode("append")
        .start()
    )


def running_distribution(labelled: DataFrame) -> DataFrame:
    """Label counts so far, per axis; the state has one row per label."""
    pairs = F.array(
        *[F.struct(F.lit(a.family).alias("axis"), F.col(a.family).alias("label")) for a in AXES]
    )
    return labelled.select(F.inline(pairs)).groupBy("axis", "label").agg(F.count("*").alias("count"))


def write_running(
    counts: DataFrame, checkpoint: str, publish: Callable[[DataFrame, int], None]
) -> StreamingQuery:
    """Publish the full counts after every batch; ``publish`` must overwrite."""
    return (
        counts.writeStream.outputMode("complete")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(publish)
        .start()
    )
