"""Near-duplicate vectors by NN-descent over cosine similarity.

1. Equal vectors form a class, represented once.
2. First lists: classes are sorted by the signs of random projections, several times over, and compared inside windows
   of the sorted order. Ranges of the order are cut by Spark, so no key gathers.
3. Descent: two neighbours of one vector may be neighbours of each other. Each round brings the vectors of a list
   together at its owner, compares them, and keeps the best for both. Rounds end when few lists change.
4. A list whose every entry reaches the threshold is saturated and grows to ``LONG`` entries.
5. Audit: vectors picked by hash are compared with all vectors, more of them until enough have few links. Recall is
   the mean share of linked classes found, of vectors with few links apart from those with many. Below
   ``LEAST_RECALL`` new sort orders are drawn and the descent goes on; the draws allowed grow with the number of bits
   of an order, and so with the table. If they do not suffice, the run fails.
6. Pairs at or above the threshold are links. Where a list of a component is still full, the component is dense: its
   vectors are compared in blocks that only count, so counts are exact however many copies there are; no pairs are
   written.
7. Full lists cannot show links from one dense component to another. The blocks of all dense components are balls
   around their means; two blocks of different components meet unless the balls are too far apart for a link. Meetings
   count links and join their components.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chorale.llm.common import connected_components, materialize, small_batches

#: Entries of a list, and of a saturated one.
SHORT, LONG = 10, 40
#: Sort orders drawn at a time, rows of a window, entries that a row takes from one window.
ORDERS, WINDOW, TAKEN = 6, 64, 6
#: Rounds of descent after each draw, the share of changed lists that ends them, draws at most for each bit of an order.
ROUNDS, SETTLED, DRAWS = 3, 0.01, 4
#: Vectors of the first audit and of the last, vectors with few links that it asks for, the recall it asks for.
AUDITED, MOST_AUDITED, LINKED, LEAST_RECALL = 256, 4_096, 64, 0.99
#: Vectors of a counting block.
BLOCK = 512
#: Balls compared at a time, and what rounding adds to an angle at the most.
BALLS, SLACK = 1_024, 1e-6
BATCH = 1_000


def usable(vector: Column) -> Column:
    """The vector in double precision; null if null, empty, zero or with null or non-finite components."""
    doubles = F.transform(vector, lambda x: x.cast("double"))
    finite = F.forall(doubles, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when((F.size(doubles) > 0) & finite & F.exists(doubles, lambda x: x != 0), doubles)


def _units(packed) -> np.ndarray:
    """Unit vectors of packed doubles of one width; scaled first, so that squares stay in range."""
    x = np.frombuffer(b"".join(packed), np.float64).reshape(len(packed), -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _orders(bits: int, seeds: list[int]):
    """Places of each vector in the sort orders of the given seeds."""

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for width, part in pdf.groupby(pdf["vector"].map(len)):
                units = _units(part["vector"])
                for seed in seeds:
                    planes = np.random.default_rng([seed, width]).standard_normal((width // 8, bits + 1))
                    signs = units @ planes
                    code = (signs[:, :bits] > 0) @ (1 << np.arange(bits, dtype=np.int64))
                    yield pd.DataFrame({"seed": seed, "width": width, "code": code, "along": signs[:, bits], "node": part["node"], "vector": part["vector"]})

    return place


def _windows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The most similar rows of each window of the sorted order, both ways."""
    for pdf in batches:
        out = []
        for _, part in pdf.groupby(["seed", "width"], sort=False):
            units, node = _units(part["vector"]), part["node"].to_numpy()
            for at in range(0, len(node), WINDOW):
                rows, others = units[at : at + WINDOW], units[at : at + WINDOW + WINDOW // 2]
                similar = rows @ others.T
                np.fill_diagonal(similar, -2)
                k = min(TAKEN, similar.shape[1] - 1)
                if k < 1:
                    continue
                best = np.argpartition(-similar, k - 1, axis=1)[:, :k]
                a = np.repeat(node[at : at + len(rows)], k)
                b, s = node[at + best.ravel()], np.take_along_axis(similar, best, 1).ravel()
                out.append(pd.DataFrame({"a": np.concatenate([a, b]), "b": np.concatenate([b, a]), "similar": np.concatenate([s, s])}))
        yield pd.concat(out) if out else pd.DataFrame({"a": [], "b": [], "similar": []})


def _local_joins(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Pairs inside one owner's list that improve a list at either end."""
    for pdf in batches:
        left, right, found = [], [], []
        for members in pdf["members"]:
            node = np.array([m["node"] for m in members], np.int64)
            worst = np.array([m["worst"] for m in members])
            units = _units([m["vector"] for m in members])
            similar = units @ units.T
            better = similar > worst[:, None]
            np.fill_diagonal(better, False)
            i, j = np.nonzero(better)
            left.append(node[i])
            right.append(node[j])
            found.append(similar[i, j])
        if left:
            yield pd.DataFrame({"a": np.concatenate(left), "b": np.concatenate(right), "similar": np.concatenate(found)})


def _counts(threshold: float):
    """Copies linked to each member, from one pair of blocks of a component."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for i, j, members in zip(pdf["i"], pdf["j"], pdf["members"], strict=True):
                node = np.array([m["node"] for m in members], np.int64)
                copies = np.array([m["copies"] for m in members], np.int64)
                block = np.array([m["block"] for m in members])
                units = _units([m["vector"] for m in members])
                near = units @ units.T >= threshold
                np.fill_diagonal(near, False)
                if i != j:
                    near &= block[:, None] != block[None, :]
                yield pd.DataFrame({"node": node, "links": near.astype(np.int64) @ copies, "classes": near.sum(axis=1)})

    return count


def _lists(pairs: DataFrame, threshold: float) -> DataFrame:
    """Best entries of every node: ``SHORT`` of them, or up to ``LONG`` where that many reach the threshold."""
    once = pairs.groupBy("a", "b").agg(F.max("similar").alias("similar"))
    entries = F.sort_array(F.collect_list(F.struct("similar", "b")), asc=False)
    grouped = once.groupBy(F.col("a").alias("node")).agg(entries.alias("entries"))
    full = F.coalesce(F.try_element_at("entries", F.lit(SHORT))["similar"] >= threshold, F.lit(False))
    return grouped.select("node", F.slice("entries", 1, F.when(full, F.lit(LONG)).otherwise(F.lit(SHORT))).alias("entries"))


def _flat(lists: DataFrame) -> DataFrame:
    return lists.select(F.col("node").alias("a"), F.explode("entries").alias("e")).select("a", F.col("e.b").alias("b"), F.col("e.similar").alias("similar"))


def _draw(nodes: DataFrame, bits: int, seeds: list[int]) -> DataFrame:
    placed = nodes.select("node", "vector").mapInPandas(_orders(bits, seeds), "seed int, width int, code long, along double, node long, vector binary")
    order = ["seed", "width", "code", "along", "node"]
    return placed.repartitionByRange(*order).sortWithinPartitions(*order).mapInPandas(_windows, "a long, b long, similar double")


def _descend(lists: DataFrame, nodes: DataFrame, threshold: float) -> DataFrame:
    """One round: lists improved by comparing the members of each list, its owner included."""
    size = F.size("entries")
    room = (size < SHORT) | ((F.element_at("entries", -1)["similar"] >= threshold) & (size < LONG))
    worst = F.when(room, F.lit(-1.0)).otherwise(F.element_at("entries", -1)["similar"])
    known = nodes.join(lists, "node", "left").select("node", "vector", F.coalesce(F.when(F.col("entries").isNotNull(), worst), F.lit(-1.0)).alias("worst"))
    flat = _flat(lists)
    owned = flat.select(F.col("a").alias("owner"), F.col("b").alias("node")).unionByName(lists.select(F.col("node").alias("owner"), "node"))
    met = owned.join(known, "node").groupBy("owner").agg(F.collect_list(F.struct("node", "worst", "vector")).alias("members"))
    found = met.select("members").mapInPandas(_local_joins, "a long, b long, similar double")
    return _lists(flat.unionByName(found), threshold)


def _audit(nodes: DataFrame, threshold: float) -> DataFrame:
    """``node``, ``expected``: classes linked to each vector of a sample, by brute force.

    The sample is doubled until ``LINKED`` of its vectors have links, but fewer than a list holds, or it has
    ``MOST_AUDITED`` vectors or all.
    """
    size = AUDITED
    while True:
        audited = materialize(_linked(nodes, threshold, size), "audit")
        row = audited.agg(F.count("*").alias("all"), F.count_if(F.col("expected").between(1, LONG - 1)).alias("few")).first()
        if row["few"] >= LINKED or size >= MOST_AUDITED or row["all"] < size:
            return audited
        size *= 2


def _linked(nodes: DataFrame, threshold: float, size: int) -> DataFrame:
    sample = nodes.orderBy(F.xxhash64("node", F.lit(7))).limit(size).select("node", "vector").collect()
    asked: dict[int, tuple[list[int], np.ndarray]] = {}
    for width in {len(r["vector"]) for r in sample}:
        own = [r for r in sample if len(r["vector"]) == width]
        asked[width] = [r["node"] for r in own], _units([r["vector"] for r in own])

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for width, part in pdf.groupby(pdf["vector"].map(len)):
                if width in asked:
                    ids, units = asked[width]
                    near = _units(part["vector"]) @ units.T >= threshold
                    near &= part["node"].to_numpy()[:, None] != np.array(ids)[None, :]
                    yield pd.DataFrame({"node": ids, "expected": near.sum(axis=0)})

    return nodes.mapInPandas(count, "node long, expected long").groupBy("node").agg(F.sum("expected").alias("expected"))


def _recall(audited: DataFrame, links: DataFrame) -> tuple[float, int]:
    """The lower of the mean shares of linked classes found, of audited vectors with few links and with many; how many have links."""
    share = F.least(F.coalesce("classes", F.lit(0)) / F.col("expected"), F.lit(1.0))
    shares = audited.where("expected > 0").join(links, "node", "left").groupBy(F.col("expected") >= LONG)
    means = shares.agg(F.avg(share).alias("recall"), F.count("*").alias("n")).collect()
    return min((r["recall"] for r in means), default=1.0), sum(r["n"] for r in means)


def _balls(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The mean direction of each block, and the widest angle to it."""
    for pdf in batches:
        centres, radii = [], []
        for vectors in pdf["vectors"]:
            units = _units(vectors)
            centre = units.mean(axis=0)
            length = np.sqrt(centre @ centre)
            centre = centre / length if length > 1e-9 else units[0]
            centres.append(centre.tobytes())
            radii.append(float(np.arccos(np.clip(units @ centre, -1, 1)).max()))
        yield pd.DataFrame({"component": pdf["component"], "block": pdf["block"], "width": [len(c) for c in centres], "centre": centres, "radius": radii})


def _meetings(threshold: float):
    """Blocks of different components that are close enough for a link, from one pair of chunks of balls."""

    def meet(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for i, j, balls in zip(pdf["i"], pdf["j"], pdf["balls"], strict=True):
                component, block, chunk = (np.array([b[c] for b in balls], np.int64) for c in ("component", "block", "chunk"))
                radius = np.array([b["radius"] for b in balls])
                centres = np.frombuffer(b"".join(b["centre"] for b in balls), np.float64).reshape(len(balls), -1)
                angle = np.arccos(np.clip(centres @ centres.T, -1, 1))
                close = angle <= radius[:, None] + radius[None, :] + np.arccos(min(1.0, max(-1.0, threshold))) + SLACK
                close &= component[:, None] < component[None, :]
                if i != j:
                    close &= chunk[:, None] != chunk[None, :]
                a, b = np.nonzero(close)
                yield pd.DataFrame({"component": component[a], "block": block[a], "other": component[b], "other_block": block[b]})

    return meet


def _crossed(threshold: float):
    """Copies linked to each member across two blocks of different components."""

    def cross(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for component, other, members in zip(pdf["component"], pdf["other"], pdf["members"], strict=True):
                node = np.array([m["node"] for m in members], np.int64)
                copies = np.array([m["copies"] for m in members], np.int64)
                side = np.array([m["side"] for m in members])
                units = _units([m["vector"] for m in members])
                near = (units @ units.T >= threshold) & (side[:, None] != side[None, :])
                links = near.astype(np.int64) @ copies
                hit = links > 0
                yield pd.DataFrame({"component": component, "other": other, "node": node[hit], "links": links[hit], "classes": near.sum(axis=1)[hit]})

    return cross


def _blocks(lists: DataFrame, nodes: DataFrame, components: DataFrame, threshold: float) -> DataFrame:
    """The members of dense components, dealt into blocks."""
    full = lists.where((F.size("entries") >= LONG) & (F.element_at("entries", -1)["similar"] >= threshold)).select("node")
    dense = components.join(full, "node").select("component").distinct()
    inside = components.join(dense, "component")
    sizes = inside.groupBy("component").agg(F.count("*").alias("n"))
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    inside = inside.join(sizes, "component").select("component", "node", F.pmod(F.xxhash64("node"), blocks).cast("int").alias("block"), blocks.alias("blocks"))
    return inside.join(nodes.select("node", "copies", "vector"), "node")


def _cross_links(members: DataFrame, threshold: float) -> DataFrame:
    """``component``, ``other``, ``node``, ``links``, ``classes``: copies and classes in the other dense component linked to each node."""
    balls = members.groupBy("component", "block").agg(F.collect_list("vector").alias("vectors"))
    balls = balls.mapInPandas(_balls, "component long, block int, width int, centre binary, radius double")
    balls = materialize(balls, "dense-balls")
    chunks = max(1, -(-balls.count() // BALLS))
    dealt = balls.withColumn("chunk", F.pmod(F.xxhash64("component", "block"), F.lit(chunks)).cast("int"))
    dealt = dealt.withColumn("beside", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))
    dealt = dealt.groupBy("width", F.least("chunk", "beside").alias("i"), F.greatest("chunk", "beside").alias("j"))
    dealt = dealt.agg(F.collect_list(F.struct("component", "block", "chunk", "centre", "radius")).alias("balls")).drop("width")
    pairs = materialize(dealt.mapInPandas(_meetings(threshold), "component long, block int, other long, other_block int"), "dense-meetings")
    key = ["component", "block", "other", "other_block"]
    own = members.select(F.col("component").alias("c"), F.col("block").alias("b"), "node", "copies", "vector")
    sides = [
        pairs.join(own, (F.col(c) == F.col("c")) & (F.col(b) == F.col("b"))).select(*key, F.struct("node", "copies", F.lit(side).alias("side"), "vector").alias("m"))
        for side, (c, b) in enumerate([("component", "block"), ("other", "other_block")])
    ]
    met = sides[0].unionByName(sides[1]).groupBy(*key).agg(F.collect_list("m").alias("members")).select("component", "other", "members")
    return met.mapInPandas(_crossed(threshold), "component long, other long, node long, links long, classes long")


def _link_counts(edges: DataFrame, members: DataFrame, nodes: DataFrame, crossed: DataFrame, threshold: float) -> DataFrame:
    """``node``, ``links``, ``classes``: copies and number of other classes linked to each class on an edge."""
    copies = nodes.select("node", "copies")
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    listed = both.join(copies.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node"))
    listed = listed.agg(F.sum("copies").alias("links"), F.count("*").alias("classes"))

    inside = members.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    meeting = inside.groupBy("component", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
    meeting = meeting.agg(F.collect_list(F.struct("node", "copies", "block", "vector")).alias("members")).drop("component")
    counted = meeting.mapInPandas(_counts(threshold), "node long, links long, classes long")
    counted = counted.unionByName(crossed.select("node", "links", "classes")).groupBy("node")
    counted = counted.agg(F.sum("links").alias("counted"), F.sum("classes").alias("met"))
    return listed.join(counted, "node", "left").select("node", F.coalesce("counted", "links").alias("links"), F.coalesce("met", "classes").alias("classes"))


def _joined(components: DataFrame, crossed: DataFrame) -> DataFrame:
    """``components`` with those that links cross made one."""
    across = crossed.select(F.col("component").alias("a"), F.col("other").alias("b")).distinct()
    roots = connected_components(across).select(F.col("node").alias("component"), F.col("component").alias("root"))
    return components.join(roots, "component", "left").select("node", F.coalesce("root", "component").alias("component"))


def near_vectors(vectors: DataFrame, threshold: float = 0.9, *, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id``, ``kept`` for every row of ``vectors``.

    Links join vectors of cosine ``threshold`` or more, found by NN-descent (recall is audited, and a run
    that stays below it raises; no pair below the threshold is linked). Vectors that are null, empty, zero or hold null or non-finite components link with nothing,
    and vectors of different lengths never link. Rows of equal vectors link with each other; repeated ids are fine.
    An empty table gives an empty result.
    """
    spark: SparkSession = vectors.sparkSession
    small_batches(spark, BATCH)
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), usable(F.col(vector)).alias("vector"))
    rows = materialize(rows, "vectors")
    classes = rows.where("vector IS NOT NULL").groupBy("vector").agg(F.min("vec_id").alias("first"), F.count("*").alias("copies"))
    # classes are numbered by a hash of the vector, as ids may repeat or be null
    classes = classes.select(F.xxhash64("vector").alias("node"), "vector", "first", "copies")

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pdf.assign(vector=[np.asarray(v, np.float64).tobytes() for v in pdf["vector"]])

    nodes = materialize(classes.mapInPandas(pack, "node long, vector binary, first long, copies long"), "vector-classes")
    total = nodes.count()
    bits = max(1, min(30, (max(total, 1) // 32).bit_length()))
    audited = _audit(nodes, threshold)

    lists, draw = None, 0
    while True:
        fresh = _draw(nodes, bits, list(range(draw * ORDERS, (draw + 1) * ORDERS)))
        lists = materialize(_lists(fresh if lists is None else _flat(lists).unionByName(fresh), threshold), "lists")
        for _ in range(ROUNDS):
            better = materialize(_descend(lists, nodes, threshold), "lists")
            changed = better.join(lists.select("node", F.hash("entries").alias("old")), "node", "left").where(~F.hash("entries").eqNullSafe(F.col("old"))).count()
            lists = better
            if changed <= SETTLED * total:
                break
        near = _flat(lists).where(F.col("similar") >= threshold)
        edges = materialize(near.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "near-pairs")
        components = materialize(connected_components(edges), "listed-components")
        members = materialize(_blocks(lists, nodes, components, threshold), "dense-members")
        crossed = materialize(_cross_links(members, threshold), "crossed-links")
        components = materialize(_joined(components, crossed), "vector-components")
        links = materialize(_link_counts(edges, members, nodes, crossed, threshold), "links")
        draw += 1
        recall, linked = _recall(audited, links)
        if recall >= LEAST_RECALL:
            break
        if draw >= DRAWS * bits:
            raise RuntimeError(f"near-vector recall is {recall:.4f} over {linked} audited vectors after {draw} draws, below {LEAST_RECALL}")

    named = components.join(nodes.select("node", "first"), "node")
    smallest = named.groupBy("component").agg(F.min("first").alias("smallest"))
    named = named.join(smallest, "component").select("node", "smallest")
    state = nodes.join(named, "node", "left").join(links, "node", "left").select(
        "node", F.coalesce("smallest", "first").alias("smallest"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links")
    )
    out = rows.select("vec_id", F.when(F.col("vector").isNotNull(), F.xxhash64("vector")).alias("node")).join(state, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("vec_id")).otherwise(F.col("smallest"))
    out = out.select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
