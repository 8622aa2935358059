"""A prefix trie of conversations, peeled from its deepest level upwards.

A conversation is a path of fixed-width records, one a turn: 128 bits of the SHA-256 of role and text, and the text's
length in bytes. Cutting the last record strips the last turn, and equal paths are equal conversations.

Peeling starts with the conversations grouped by whole path, so copies are one row from the start. At depth d the
conversations that end there join the surviving nodes, all are grouped by path, and each group is a node with all its
totals: members, children, leaves and saved tokens. Its last turn is stripped, and it goes on as a child to depth
d - 1. A step is one aggregate with map-side combine, so a node with many children, the root above all, is no hot task.

Below some depth paths share little. There a task takes whole subtrees: the depth is the smallest power of two at
which no subtree has more than ``SUBTREE`` records, so a task's share is bounded and the number of steps over the
cluster is the depth down to which large groups of conversations agree, not the length of the longest one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chorale.llm.common import materialize

#: Characters of a record: 32 of the digest and 10 of the length.
DIGEST, LENGTH = 32, 10
RECORD = DIGEST + LENGTH
#: Records that a task peels at once, ids in one stretch of a node's list of ends, and rows of a broadcast side.
SUBTREE, STRETCH, WIDE = 4_096, 4_096, 10_000

NODE = "key string, parent_key string, conv_id long, depth long, n_convs long, n_children long, n_leaves long, saved_tokens long"
_CARRIED = "path string, conv_id long, n_convs long, children long, n_leaves long, saved_tokens long"


def _key(path: Column) -> Column:
    return F.sha2(path, 256)


def _cut(path: Column, depth: Column | int) -> Column:
    return F.substring(path, F.lit(1), (depth if isinstance(depth, Column) else F.lit(depth)) * RECORD)


def paths(conversations: DataFrame) -> DataFrame:
    """``conv_id`` (long), ``path``: every conversation as one string of records.

    Turns are ordered by ``turn``, null first, then role and digest, so repeated turn numbers have a fixed order. Null
    role or text counts as empty. Rows without ``conv_id`` take no part. Other columns are ignored. Texts do not move:
    only their records are shuffled.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.substring(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256), 1, DIGEST)
    record = F.concat(digest, F.lpad(F.octet_length(text).cast("string"), LENGTH, "0"))
    turns = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long"), F.struct(F.col("turn").cast("long"), role.alias("role"), record.alias("record")).alias("turn")
    )
    ordered = F.transform(F.sort_array(F.collect_list("turn")), lambda t: t["record"])
    return turns.groupBy("conv_id").agg(F.array_join(ordered, "").alias("path"))


def rebuild(told: DataFrame, family: int = 5, heads: int = 9) -> DataFrame:
    """Paths where conversation c takes its first h turns from c - c % ``family``, and the rest from itself.

    h is crc32 of the decimal id, modulo ``heads``; a missing family head gives no turns, a shorter one all it has.
    """
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads).cast("int")
    first = told.select(F.col("conv_id").alias("head"), _cut(F.col("path"), heads - 1).alias("opening"))
    own = told.withColumns({"head": F.expr(f"conv_id - conv_id % {family}"), "h": h})
    rest = F.expr(f"substring(path, h * {RECORD} + 1)")
    opening = _cut(F.coalesce("opening", F.lit("")), F.col("h"))
    return own.join(first, "head", "left").select("conv_id", F.concat(opening, rest).alias("path"))


def _ends(told: DataFrame) -> DataFrame:
    """``key``, ``ends_sha256`` of every node at which conversations end.

    A node's ids are joined in stretches of ids first; its stretches then run through the hash one by one, in order,
    so that memory stays bounded for a path that a third of all conversations share.
    """
    stretch = F.floor(F.col("conv_id") / STRETCH)
    lists = told.groupBy(_key(F.col("path")).alias("key"), stretch.alias("stretch")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("ids")
    )

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None
        for batch in batches:
            keys, sums = [], []
            for key, ids in zip(batch.column("key").to_pylist(), batch.column("ids").to_pylist()):
                if key == now:
                    state.update(b",")
                else:
                    if now is not None:
                        keys.append(now)
                        sums.append(state.hexdigest())
                    now, state = key, hashlib.sha256()
                state.update(ids.encode())
            yield pa.RecordBatch.from_pydict({"key": pa.array(keys, pa.string()), "ends_sha256": pa.array(sums, pa.string())})
        if now is not None:
            yield pa.RecordBatch.from_pydict({"key": [now], "ends_sha256": [state.hexdigest()]})

    ordered = lists.repartition("key").sortWithinPartitions("key", "stretch").select("key", "ids")
    return ordered.mapInArrow(hashed, "key string, ends_sha256 string")


def _peel(ended: list[tuple], top: int) -> list[tuple]:
    """Whole subtrees below ``top``, peeled in one task: rows of ``path`` and the columns of ``NODE``.

    ``ended`` holds (path, smallest id, members) of distinct paths. A node has no ``path``; what reaches ``top`` has a
    ``path`` and no depth.
    """
    by_depth: dict[int, list] = {}
    for path, conv, n in ended:
        # the running hash gives the key of every prefix in one pass
        state = hashlib.sha256(path[: top * RECORD].encode())
        keys = [state.hexdigest()]
        for at in range(top * RECORD, len(path), RECORD):
            state.update(path[at : at + RECORD].encode())
            keys.append(state.hexdigest())
        by_depth.setdefault(len(keys) - 1 + top, []).append((path, keys, conv, n))
    rows, survivors, depth = [], {}, max(by_depth, default=top)
    while depth > top:
        # by key: path, its keys, smallest id, members, children, leaves, saved tokens
        for path, keys, conv, n in by_depth.get(depth, ()):
            kept = survivors.setdefault(keys[depth - top], [path, keys, conv, 0, 0, 0, 0])
            kept[2], kept[3] = min(kept[2], conv), kept[3] + n
        above: dict[str, list] = {}
        for key, (path, keys, conv, n, children, leaves, saved) in survivors.items():
            leaves = leaves if children else 1
            saved += (n - 1) * int(path[depth * RECORD - LENGTH : depth * RECORD])
            parent = keys[depth - 1 - top]
            rows.append((None, key, parent, conv, depth, n, children, leaves, saved))
            kept = above.setdefault(parent, [path, keys, conv, 0, 0, 0, 0])
            kept[2] = min(kept[2], conv)
            for i, more in enumerate((n, 1, leaves, saved), start=3):
                kept[i] += more
        survivors, depth = above, depth - 1
    for path, _, conv, n, children, leaves, saved in survivors.values():
        rows.append((path[: top * RECORD], None, None, conv, None, n, children, leaves, saved))
    return rows


def _subtrees(ended: DataFrame, top: int) -> DataFrame:
    """All nodes deeper than ``top``, and (as rows with a ``path`` and no depth) what their level passes up to it."""
    types = [pa.string(), pa.string(), pa.string()] + [pa.int64()] * 6
    names = _names(f"path string, {NODE}")

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows) if rows else [()] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)], names=names)

    def peeled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # rows come sorted by path; the last subtree of a batch waits for its other rows
        waiting: list[tuple] = []
        for batch in batches:
            waiting += zip(*[batch.column(c).to_pylist() for c in ("path", "conv_id", "n_convs")])
            last = waiting[-1][0][: top * RECORD] if waiting else ""
            whole = [row for row in waiting if not row[0].startswith(last)]
            waiting = [row for row in waiting if row[0].startswith(last)]
            yield batch_of(_peel(whole, top))
        yield batch_of(_peel(waiting, top))

    deep = ended.where(F.length("path") > top * RECORD).select("path", "conv_id", "n_convs")
    placed = deep.repartition(_cut(F.col("path"), top)).sortWithinPartitions("path")
    return placed.mapInArrow(peeled, f"path string, {NODE}")


def _subtree_depth(ended: DataFrame) -> int:
    """The smallest power of two at which no subtree has more than ``SUBTREE`` records."""
    depth = 1
    while True:
        deep = ended.where(F.length("path") > depth * RECORD)
        sizes = deep.groupBy(_cut(F.col("path"), depth)).agg(F.sum(F.length("path") / RECORD - depth).alias("n"))
        if (sizes.agg(F.max("n")).first()[0] or 0) <= SUBTREE:
            return depth
        depth *= 2


def prefix_trie(told: DataFrame) -> DataFrame:
    """All nodes of the trie over ``conv_id``, ``path`` (as ``paths`` makes them; ids are distinct).

    Per node: ``conv_id`` (smallest member), ``depth``, ``parent_conv_id`` (null at the root), ``n_convs``,
    ``n_children``, ``n_leaves``, ``saved_tokens`` and ``ends_sha256``. An empty table has no nodes, not even a root;
    conversations without turns end at the root. Very long conversations cost their path, 42 characters a turn.
    """
    told = materialize(told.select("conv_id", "path"), "trie-paths")
    ended = told.groupBy("path").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"))
    ended = materialize(ended, "trie-ends")
    depth = _subtree_depth(ended)
    below = materialize(_subtrees(ended, depth), "trie-subtrees")
    levels = [below.where("depth IS NOT NULL").drop("path")]
    carried = below.where("depth IS NULL").select(
        "path", "conv_id", "n_convs", F.col("n_children").alias("children"), "n_leaves", "saved_tokens"
    )
    zero = F.lit(0).cast("long")
    while depth >= 0:
        here = ended.where(F.length("path") == depth * RECORD)
        here = here.select("path", "conv_id", "n_convs", zero.alias("children"), zero.alias("n_leaves"), zero.alias("saved_tokens"))
        grouped = carried.unionByName(here).groupBy("path").agg(
            F.min("conv_id").alias("conv_id"),
            *[F.sum(c).alias(c) for c in ("n_convs", "children", "n_leaves", "saved_tokens")],
        )
        length = F.substring("path", depth * RECORD - LENGTH + 1, LENGTH).cast("long") if depth else zero
        level = grouped.withColumns(
            {
                "n_leaves": F.when(F.col("children") > 0, F.col("n_leaves")).otherwise(F.lit(1)).cast("long"),
                "saved_tokens": F.col("saved_tokens") + (F.col("n_convs") - 1) * length,
            }
        )
        level = materialize(level.select(*_names(_CARRIED)), f"trie-level-{depth}")
        above = _cut(F.col("path"), depth - 1) if depth else F.lit("")
        levels.append(
            level.select(
                _key(F.col("path")).alias("key"),
                (_key(above) if depth else F.lit(None).cast("string")).alias("parent_key"),
                "conv_id",
                F.lit(depth).cast("long").alias("depth"),
                "n_convs",
                F.col("children").alias("n_children"),
                "n_leaves",
                "saved_tokens",
            )
        )
        # a level's nodes go on without their last turn, each as one child
        carried = level.select(
            above.alias("path"), "conv_id", "n_convs", F.lit(1).cast("long").alias("children"), "n_leaves", "saved_tokens"
        )
        depth -= 1
    nodes = materialize(reduce(DataFrame.unionByName, levels), "trie-nodes")
    nodes = nodes.join(_ends(told), "key", "left")
    nodes = nodes.withColumn("ends_sha256", F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)))
    return _parents(materialize(nodes, "trie-hashed")).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"
    )


def _names(schema: str) -> list[str]:
    return [part.split()[0] for part in schema.split(", ")]


def _parents(nodes: DataFrame) -> DataFrame:
    """Add ``parent_conv_id``. The parents of many children, at most ``WIDE`` of them, are broadcast; others are joined."""
    wide = F.greatest(F.lit(64), F.floor(F.lit(nodes.count()) / WIDE))
    parents = nodes.where("n_children > 0").select(F.col("key").alias("parent_key"), F.col("conv_id").alias("of"), "n_children")
    many = parents.where(F.col("n_children") > wide).select("parent_key", F.col("of").alias("wide"))
    few = parents.where(F.col("n_children") <= wide).select("parent_key", "of")
    marked = nodes.join(F.broadcast(many), "parent_key", "left")
    found = marked.where("wide IS NOT NULL OR parent_key IS NULL").withColumn("parent_conv_id", F.col("wide"))
    rest = marked.where("wide IS NULL AND parent_key IS NOT NULL").join(few, "parent_key").withColumn("parent_conv_id", F.col("of"))
    return found.unionByName(rest.select(*found.columns))
