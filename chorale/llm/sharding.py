"""Shards of near-equal bytes by a minimax contiguous partition.

Rows with equal texts form an atomic group; groups stand in the order of the text's hash. Of all ways to cut that
order into so many runs, the one with the smallest largest run is found by binary search over the capacity: a capacity
is feasible if filling shards greedily in order uses no more than the shards there are.

The order is held on the driver as a bounded list of pieces, each a range of hashes with its bytes and its number of
groups. Taking pieces as fluid gives a capacity below which nothing fits, taking them as atoms one that surely fits.
Only pieces in which a cut can fall between these two are split further, by one aggregate over the table of groups,
until those hold single groups. Then both capacities agree and the cuts are exact. Pieces stay some thousands in
number whatever the corpus; three rounds resolve a billion groups.

Any cut that keeps the capacity is optimal, so cuts are laid nearest to equal shares within it.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chorale.llm.common import materialize

#: Ranges of the first list, and parts that a piece is split into.
FIRST, PARTS = 1 << 12, 1 << 6
#: Bytes that a row counts besides its text; rows of one numbering task.
OVERHEAD, BIN_ROWS = 8, 20_000
#: Hashes are taken as whole numbers from 0 to 2 ** 62.
SPACE = 1 << 62

Piece = tuple[int, int, int, int]  # first hash, end of range, bytes, groups


def _place(text: Column) -> Column:
    return F.pmod(F.shiftright(F.xxhash64(F.coalesce(text, F.lit(""))), 1), F.lit(SPACE)).cast("long")


def _pieces(groups: DataFrame, ranges: list[tuple[int, int]], parts: int) -> list[Piece]:
    """Non-empty parts of the given hash ranges, in order. At most ``parts`` rows per range reach the driver."""
    spark = groups.sparkSession
    table = spark.createDataFrame([(a, b, max(1, -(-(b - a) // parts))) for a, b in ranges], "a long, b long, width long")
    if len(ranges) == 1:
        a, b = ranges[0]
        width = max(1, -(-(b - a) // parts))
        inside = groups.where((F.col("place") >= a) & (F.col("place") < b)).select("*", F.lit(a).alias("a"), F.lit(b).alias("b"), F.lit(width).alias("width"))
    else:
        # pieces are cells of one grid, so the range of a group is found by its cell
        cell = SPACE // FIRST
        table = table.withColumn("cell", F.explode(F.sequence(F.floor(F.col("a") / cell), F.floor((F.col("b") - 1) / cell))))
        inside = groups.withColumn("cell", F.floor(F.col("place") / cell)).join(F.broadcast(table), "cell").where("place >= a AND place < b")
    part = F.floor((F.col("place") - F.col("a")) / F.col("width")).cast("long")
    sums = inside.groupBy("a", "b", "width", part.alias("part")).agg(F.sum("bytes").alias("bytes"), F.count("*").alias("groups"), F.min("place").alias("low"))
    out = []
    for r in sums.collect():
        start = r["a"] + r["part"] * r["width"]
        single = r["groups"] == 1
        out.append((r["low"] if single else start, r["low"] + 1 if single else min(start + r["width"], r["b"]), r["bytes"], r["groups"]))
    return sorted(out)


def greedy_cuts(ends: list[int], capacity: int, shards: int) -> list[int] | None:
    """Numbers of atoms in front of each cut when shards are filled in order; None if that takes too many.

    ``ends``: running sums of the atoms' sizes.
    """
    cuts, at, done = [], 0, 0
    for _ in range(shards):
        reached = bisect_right(ends, done + capacity)
        if reached == at and at < len(ends):
            return None
        at = reached
        done = ends[at - 1] if at else 0
        cuts.append(at)
    return cuts if at == len(ends) else None


def smallest_capacity(sizes: list[int], shards: int) -> int:
    """The least capacity with which greedy filling of ordered atoms needs no more than ``shards``."""
    ends, total = [], 0
    for s in sizes:
        total += s
        ends.append(total)
    low, high = max([-(-total // shards), *sizes, 0]), total
    while low < high:
        middle = (low + high) // 2
        if greedy_cuts(ends, middle, shards) is None:
            low = middle + 1
        else:
            high = middle
    return low


def _open_pieces(pieces: list[Piece], shards: int) -> list[int]:
    """Numbers of pieces of several groups in which a cut of the best partition may fall."""
    total = sum(p[2] for p in pieces)
    sizes = [p[2] for p in pieces]
    fits = smallest_capacity(sizes, shards)
    least = max([-(-total // shards), *[p[2] for p in pieces if p[3] == 1], 0])
    if fits <= least:
        return []
    ends, running = [], 0
    for s in sizes:
        running += s
        ends.append(running)
    out: set[int] = set()
    near = far = 0
    for _ in range(shards):
        # with any capacity between the two the cut lies between these offsets: the near one loses a whole piece
        far = min(total, far + fits)
        at = bisect_right(ends, near + least)
        near = ends[at - 1] if at else 0
        first, last = bisect_right(ends, near), bisect_left(ends, far)
        out.update(i for i in range(first, min(last, len(pieces) - 1) + 1) if pieces[i][3] > 1)
    return sorted(out)


def cut_places(groups: DataFrame, shards: int) -> tuple[list[int], int]:
    """Hashes at which the shards after the first begin, and the smallest capacity.

    ``groups``: ``place`` (unique) and ``bytes``.
    """
    pieces = _pieces(groups, [(0, SPACE)], FIRST)
    while inner := _open_pieces(pieces, shards):
        ranges = [(pieces[i][0], pieces[i][1]) for i in inner]
        fresh = _pieces(groups, ranges, PARTS)
        chosen = set(inner)
        pieces = sorted([p for i, p in enumerate(pieces) if i not in chosen] + fresh)
    sizes = [p[2] for p in pieces]
    capacity = smallest_capacity(sizes, shards)
    ends, total = [], 0
    for s in sizes:
        total += s
        ends.append(total)
    # filling from the back gives the earliest offset at which each cut may lie
    starts, earliest, at = [0, *ends[:-1]], [], total
    for _ in range(shards):
        earliest.append(at)
        i = bisect_left(starts, at - capacity) if starts else 0
        at = starts[i] if i < len(starts) and starts[i] < at else at
        at = max(at, 0)
    earliest = earliest[::-1]  # earliest[k]: end of shard k at the least
    cuts, done = [], 0
    for k in range(shards - 1):
        ideal = done + (total - done) / (shards - k)
        low, high = max(earliest[k], done), done + capacity
        options = [e for e in (done, *ends[max(0, bisect_left(ends, ideal) - 1) : bisect_left(ends, ideal) + 1]) if low <= e <= high]
        i = bisect_right(ends, high)
        options += [ends[i - 1]] if i and ends[i - 1] >= low else []
        j = bisect_left(ends, low)
        options += [ends[j]] if j < len(ends) and ends[j] <= high else []
        done = min(options or [done], key=lambda e: abs(e - ideal))
        nxt = bisect_right(ends, done)
        cuts.append(pieces[nxt][0] if nxt < len(pieces) else SPACE)
    return cuts, capacity


def shard_by_bytes(
    documents: DataFrame, shards: int, *, doc_id: str = "doc_id", text: str = "text", keep: list[str] | None = None
) -> DataFrame:
    """``documents`` (all columns, or those of ``keep``) with ``size`` (UTF-8 bytes and 8), ``shard`` and ``slot`` (from 0, without gaps in a shard).

    Rows of equal text go to one shard; null and empty texts count as one text. Repeated rows get slots of their own.
    Columns of these names are replaced. The corpus moves once, to number the rows.
    """
    taken = {"size", "shard", "slot"}
    size = F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + OVERHEAD
    kept = F.struct(*[F.col(f"`{c}`") for c in (keep or documents.columns) if c.lower() not in taken]).alias("kept")
    rows = documents.select(kept, size.alias("size"), _place(F.col(text)).alias("place"), F.xxhash64(doc_id, text).alias("spread"))
    groups = materialize(rows.groupBy("place").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows")), "groups")
    cuts, _ = cut_places(groups, shards)
    shard = F.size(F.filter(F.array(*[F.lit(c).cast("long") for c in cuts]), lambda c: c <= F.col("place"))) if cuts else F.lit(0)
    # a shard's rows are numbered bin by bin; bins are dealt by a hash of the row, so that copies spread too
    total = groups.agg(F.sum("rows")).first()[0] or 0
    bins = max(64, -(-total // BIN_ROWS))
    rows = rows.withColumns({"shard": shard.cast("int"), "bin": F.pmod("spread", F.lit(bins))})
    counts = rows.groupBy("shard", "bin").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("shard").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1))
    counts = counts.select(F.col("shard").alias("s"), F.col("bin").alias("b"), F.coalesce(before, F.lit(0)).alias("before"))
    within = F.row_number().over(Window.partitionBy("shard", "bin").orderBy("spread", "place")) - 1
    numbered = rows.withColumn("within", within).join(counts, (F.col("shard") == F.col("s")) & (F.col("bin") == F.col("b")))
    return numbered.select("kept.*", "size", "shard", (F.col("within") + F.col("before")).cast("long").alias("slot"))
