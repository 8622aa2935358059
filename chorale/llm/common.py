"""Small helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chorale.session import materialize, scratch_path, small_batches

__all__ = ["connected_components", "materialize", "scratch_path", "small_batches", "table"]

def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _star(edges: DataFrame, larger: bool) -> DataFrame:
    """One step of the alternating-star rule: hang neighbours on the smallest node around.

    ``larger``: of every node, hang its larger neighbours (both directions are
    looked at); else hang its smaller ones, itself included.
    """
    a, b = F.col("a"), F.col("b")
    if larger:
        sides = edges.select("a", "b").unionByName(edges.select(b.alias("a"), a.alias("b")))
    else:
        sides = edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"))
    smallest = sides.groupBy("a").agg(F.min("b").alias("m"))
    smallest = smallest.select("a", F.least("a", "m").alias("m"))
    hung = sides.join(smallest, "a").where(b > a if larger else b != F.col("m"))
    hung = hung.select(b.alias("a"), F.col("m").alias("b"))
    if not larger:
        hung = hung.unionByName(smallest.select("a", F.col("m").alias("b")))
    return hung.where(a != b).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """``node``, ``component`` (its smallest node) of every node on an edge (``a``, ``b``).

    Alternates large-star and small-star steps; the number of rounds grows with
    the logarithm of the component size. Each round is written to the shared
    folder, so a lost executor costs at most one round, and nothing but a
    checksum reaches the driver. Null ends and loops are dropped. Nodes may be
    of any orderable type. An empty table gives an empty result.
    """
    now = edges.select("a", "b").where("a IS NOT NULL AND b IS NOT NULL AND a != b").distinct()
    now, seen = materialize(now, "edges"), None
    while True:
        now = materialize(_star(_star(now, True), False), "stars")
        sums = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if sums == seen:
            break
        seen = sums
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)


def unclashed(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """``df`` without the columns that an operator is about to write."""
    taken = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])
