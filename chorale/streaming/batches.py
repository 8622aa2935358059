"""Streams whose results and counts are stored by batch.

Spark may run a batch again after a failure. Everything a batch writes goes below ``batch=<id>`` and overwrites what an
earlier run of the same batch left there, so a replay changes nothing. The counts of a batch are made from its stored
rows; running counts are their sum, made when they are read. Nothing is kept as streaming state.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from chorale.operators.labeling import percentages
from chorale.operators.lexicon import AXES

COUNTS = "axis STRING, label STRING, count LONG"


def label_counts(labelled: DataFrame) -> DataFrame:
    """Rows of every label; the tones of a message count as one joined label."""
    pairs = F.array(*[F.struct(F.lit(a.family).alias("axis"), F.col(a.family).alias("label")) for a in AXES])
    return labelled.select(F.inline(pairs)).groupBy("axis", "label").agg(F.count("*").alias("count"))


def prediction_counts(predictions: DataFrame) -> DataFrame:
    """Rows of every predicted label; tones count one by one."""
    single = [F.struct(F.lit(a).alias("axis"), F.col(f"{a}Pred").alias("label")) for a in ("polarite", "target")]
    tones = F.transform("tonPred", lambda t: F.struct(F.lit("ton").alias("axis"), t.alias("label")))
    stacked = predictions.select(F.inline(F.concat(F.array(*single), tones)))
    return stacked.groupBy("axis", "label").agg(F.count("*").alias("count"))


def write_batch(rows: DataFrame, batch_id: int, out: str, count: Callable[[DataFrame], DataFrame]) -> None:
    """Store one batch and its counts, in place of what the same batch stored before."""
    part = f"batch={batch_id}"
    rows.write.mode("overwrite").parquet(f"{out}/rows/{part}")
    stored = rows.sparkSession.read.schema(rows.schema).parquet(f"{out}/rows/{part}")
    count(stored).coalesce(1).write.mode("overwrite").parquet(f"{out}/counts/{part}")


def write_batches(
    stream: DataFrame, out: str, checkpoint: str, count: Callable[[DataFrame], DataFrame]
) -> StreamingQuery:
    """Store everything available batch by batch, then stop; a rerun takes up only new input."""
    return (
        stream.writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(lambda rows, batch_id: write_batch(rows, batch_id, out, count))
        .start()
    )


def read_batches(spark: SparkSession, out: str, schema: str | T.StructType) -> DataFrame:
    """The stored rows of all batches, with ``batch``."""
    whole = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    return spark.read.schema(T.StructType([*whole.fields, T.StructField("batch", T.LongType())])).parquet(f"{out}/rows")


def running_counts(spark: SparkSession, out: str, until: int | None = None) -> DataFrame:
    """``axis, label, count, total, percentage`` over all batches, or those up to ``until``."""
    stored = spark.read.schema(f"{COUNTS}, batch LONG").parquet(f"{out}/counts")
    if until is not None:
        stored = stored.where(F.col("batch") <= until)
    return percentages(stored.groupBy("axis", "label").agg(F.sum("count").alias("count")), ["axis"])
