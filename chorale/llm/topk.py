"""Exact top-k by inner product: a KD-tree per shard, searched best box first.

Vectors become whole numbers, so scores are exact and ties are real. Rows are dealt into shards of a few thousand. In
each shard a KD-tree is built by median splits along the widest side, every node with the tight bounding box of its
rows. A query walks the tree by the largest score that a box allows and stops when that falls below its kth best.

Queries come in blocks: a block of queries visits every shard, and carries the kth best score that it already knows.
These come from a first pass in which each block visits one shard only; any k rows of the table bound the kth best of
the whole from below. The second pass then opens only boxes that can still matter, and reports at most k rows per query
and shard.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chorale.llm.common import materialize, small_batches

#: Rows of a shard, queries of a block, rows of a tree's leaf.
SHARD, BLOCK, LEAF = 8_192, 4_096, 64
SCALE = 256
#: Sums below this are exact in double precision.
EXACT = 2.0**52


class KDTree:
    """Median splits of integer vectors, with the tight box of every node."""

    def __init__(self, vectors: np.ndarray, ids: np.ndarray) -> None:
        order, nodes = np.arange(len(ids)), [(0, len(ids))]
        low, high, children = [], [], []
        at = 0
        while at < len(nodes):
            start, stop = nodes[at]
            own = vectors[order[start:stop]]
            low.append(own.min(axis=0))
            high.append(own.max(axis=0))
            side = int(np.argmax(high[-1] - low[-1]))
            if stop - start > LEAF and high[-1][side] > low[-1][side]:
                middle = (stop - start) // 2
                split = np.argpartition(own[:, side], middle, kind="introselect")
                order[start:stop] = order[start:stop][split]
                children.append(len(nodes))
                nodes += [(start, start + middle), (start + middle, stop)]
            else:
                children.append(-1)  # a leaf, or nothing but equal rows
            at += 1
        self.vectors, self.ids, self.nodes, self.children = vectors[order], ids[order], nodes, children
        self.low, self.high = np.array(low), np.array(high)

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """The largest inner product that each node's box allows, for each query."""
        return np.maximum(queries, 0) @ self.high.T + np.minimum(queries, 0) @ self.low.T

    def search(self, query: np.ndarray, bounds: np.ndarray, own: int, k: int, least: float) -> list[tuple[int, int]]:
        """The best k (score, id), other than id ``own``, with scores of at least ``least``; ties to the smaller id."""
        best: list[tuple[int, int]] = []  # a heap of (score, -id): its head is the worst kept
        front = [(-bounds[0], 0)]
        while front and -front[0][0] >= least:
            node = heapq.heappop(front)[1]
            child = self.children[node]
            if child >= 0:
                for c in (child, child + 1):
                    if bounds[c] >= least:
                        heapq.heappush(front, (-bounds[c], c))
                continue
            start, stop = self.nodes[node]
            scores = self.vectors[start:stop] @ query
            for i in np.flatnonzero(scores >= least):
                row = int(self.ids[start + i])
                if row == own:
                    continue
                entry = (int(scores[i]), -row)
                if len(best) < k:
                    heapq.heappush(best, entry)
                elif entry > best[0]:
                    heapq.heapreplace(best, entry)
            if len(best) == k:
                least = max(least, best[0][0])
        return [(s, -i) for s, i in best]


def whole_numbers(vector: Column) -> Column:
    """Components as ``floor(256 * x)``; null for vectors that are null, empty or hold null or non-finite components."""
    doubles = F.transform(vector, lambda x: x.cast("double"))
    finite = F.forall(doubles, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when((F.size(doubles) > 0) & finite, F.transform(doubles, lambda x: F.floor(SCALE * x)))


def _matrix(column: pd.Series) -> np.ndarray:
    """Rows as doubles where no sum of products can leave the exact range, else as 64-bit whole numbers."""
    out = np.stack(column.to_list()).astype(np.int64)
    peak = float(np.abs(out).max(initial=0))
    return out.astype(np.float64) if peak * peak * out.shape[1] < EXACT else out


def _search(rows: pd.DataFrame, queries: pd.DataFrame, k: int) -> pd.DataFrame:
    """Best k of one shard for one block of queries; both sides hold vectors of one length."""
    vectors, asked = _matrix(rows["vector"]), _matrix(queries["vector"])
    if vectors.dtype != asked.dtype:
        vectors, asked = vectors.astype(np.int64), asked.astype(np.int64)
    tree = KDTree(vectors, rows["id"].to_numpy(np.int64))
    bounds = tree.bounds(asked)
    out = []
    least = queries["least"].to_numpy(np.float64)
    for i, query_id in enumerate(queries["id"].to_numpy(np.int64)):
        out += [(query_id, s, r) for s, r in tree.search(asked[i], bounds[i], query_id, k, least[i])]
    return pd.DataFrame(out, columns=["query_id", "score", "vec_id"])


def top_k(vectors: DataFrame, is_query: Column, k: int, *, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id``, ``score``: the k rows of highest inner product for each query row.

    Vectors that are null, empty, or hold null or non-finite components take no part, nor do null ids. A query meets
    the vectors of its own length, except those with its own id; a repeated id stands for the equal rows that carry
    it, once. Fewer than k candidates are all returned. Scores must fit 64 bits. An empty table gives an empty result.
    """
    small_batches(vectors.sparkSession)
    rows = vectors.select(F.col(vec_id).cast("long").alias("id"), whole_numbers(F.col(vector)).alias("vector"), is_query.alias("asked"))
    rows = materialize(rows.where("id IS NOT NULL AND vector IS NOT NULL").withColumn("width", F.size("vector")).distinct(), "whole-vectors")
    sizes = {r["width"]: (max(1, -(-r["n"] // SHARD)), max(1, -(-r["q"] // BLOCK))) for r in rows.groupBy("width").agg(
        F.count("*").alias("n"), F.sum(F.col("asked").cast("int")).alias("q")).collect()}
    if not sizes:
        return rows.select(F.col("id").alias("query_id"), F.lit(1).alias("rank"), F.col("id").alias("vec_id"), F.col("id").alias("score"))
    # vectors come in few lengths; their numbers of shards and blocks travel as a map
    count = lambda i: F.create_map(*[F.lit(x) for w, s in sizes.items() for x in (w, s[i])])[F.col("width")]
    shards, blocks = count(0), count(1)
    stored = rows.select("id", "vector", "width", F.pmod(F.xxhash64("id"), shards).alias("shard"), shards.alias("shards"), blocks.alias("blocks"))
    queries = rows.where("asked").select("id", "vector", "width", F.pmod(F.xxhash64("id", F.lit(1)), blocks).alias("block"), shards.alias("shards"))
    meeting = ["width", "shard", "block"]

    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return pd.DataFrame({"query_id": [], "score": [], "vec_id": []}, dtype=np.int64)
        return _search(left, right, k)

    def visit(asked: DataFrame, blocks_of_shard: Column) -> DataFrame:
        """Query rows name a shard; each of a shard's blocks of queries meets all its rows."""
        left = stored.withColumn("block", F.explode(blocks_of_shard))
        # both sides stem from one table: fresh names keep their columns apart
        left, right = (side.select(*[F.col(c).alias(c) for c in side.columns]) for side in (left.drop("shards", "blocks"), asked))
        return left.groupBy(*meeting).cogroup(right.groupBy(*meeting)).applyInPandas(search, "query_id long, score long, vec_id long")

    none = F.lit(float("-inf"))
    first = queries.select("id", "vector", "width", "block", F.pmod("block", "shards").alias("shard"), none.alias("least"))
    own = F.when(F.col("shard") < F.col("blocks"), F.sequence("shard", F.col("blocks") - 1, F.col("shards").cast("long")))
    known = visit(first, own).groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").alias("least")).where(F.col("n") >= k)
    known = materialize(known.select(F.col("query_id").alias("id"), F.col("least").cast("double").alias("least")), "kth-scores")
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.col("shards").cast("long") - 1))
    second = queries.join(known, "id", "left").select("id", "vector", "width", "block", every.alias("shard"), F.coalesce("least", none).alias("least"))
    found = visit(second, F.sequence(F.lit(0).cast("long"), F.col("blocks").cast("long") - 1))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.distinct().withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
