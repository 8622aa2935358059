"""Input checks: of schemas, before any job starts; of rows, while they are first written; of contents, by fingerprint."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def require_columns(df: DataFrame, columns: Iterable[str], what: str) -> DataFrame:
    """Raise ``ValueError`` unless every column is present; returns ``df``."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{what}: missing columns {missing}; available: {df.columns}")
    return df


def digest(*parts: object) -> str:
    return hashlib.sha256("\n".join(map(str, parts)).encode()).hexdigest()


def content_fingerprint(df: DataFrame) -> str:
    """A digest of names, types and rows, whatever their order: one pass, one row of sums a task."""
    names = [F.col(f"`{c}`") for c in df.columns]
    sums = [F.sum(F.xxhash64(F.lit(salt), *names).cast("decimal(38,0)")) for salt in ("a", "b")]
    return digest(df.schema.simpleString(), *df.agg(F.count("*"), *sums).first())


def audited_write(
    df: DataFrame, path: str, id_col: str = "id", text_col: str = "text", labels: dict[str, list[str]] | None = None
) -> DataFrame:
    """Write ``df`` as Parquet and return its audit: one row, counted while the rows were written.

    ``rows``, ``null_ids``, ``null_texts``, ``empty_texts`` (nothing but white space), and ``bad_<column>`` for each
    column of ``labels``: non-empty values, or entries of a ``;`` list, that are none of the given labels.
    ``distinct_ids`` is an estimate with a standard error of 1 %: an exact one would need a pass of its own.
    """
    require_columns(df, [id_col, text_col, *(labels or {})], "audit")

    def bad(column: str, known: list[str]) -> Column:
        given = F.filter(F.transform(F.split(column, ";"), F.trim), lambda x: x != "")
        return F.count_if(F.size(F.array_except(given, F.array(*map(F.lit, known)))) > 0).alias(f"bad_{column}")

    seen = Observation()
    watched = df.observe(
        seen,
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col(id_col).isNull()).alias("null_ids"),
        F.count_if(F.col(text_col).isNull()).alias("null_texts"),
        F.count_if(F.trim(text_col) == "").alias("empty_texts"),
        F.approx_count_distinct(id_col, 0.01).alias("distinct_ids"),
        *[bad(c, known) for c, known in (labels or {}).items()],
    )
    watched.write.mode("overwrite").parquet(path)
    found = seen.get
    return df.sparkSession.createDataFrame([tuple(found.values())], ", ".join(f"`{k}` long" for k in found))
