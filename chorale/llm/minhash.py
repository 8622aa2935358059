"""Near-duplicate documents: MinHash bands, sequential Bayesian verification, exact confirmation.

A document is the set of its distinct five-word shingles. Equal sets form a class, represented once, so exact copies
cost nothing further. Classes that share a band of their MinHash signature are candidates. A candidate pair is
compared in batches of signature positions; after each batch the posterior of its similarity (uniform prior, binomial
matches) decides: below ``MISS`` probability of reaching the threshold it is dropped. Survivors are confirmed on full
shingle sets.

Buckets may hold a third of all classes, so no bucket is paired up whole. First each member meets the bucket's
smallest member; that ties copies of one text together. Only buckets that still hold several components are searched
further, in blocks of bounded size, and only across components: pairs inside one cannot change the result. A block is
met twice: first with short signatures, which name the members that have a survivor at all, then with the full sets of
those. There survivors are confirmed on the spot, and a block writes a spanning forest of its links: fewer rows than
members, also for a group whose pairs all come near the threshold and stay below it.

What moves is kept small. Pairs are compared on the low byte of each position: unequal positions agree once in 256, so
more pairs survive, never fewer, and all are confirmed. Members are dealt to buckets once; signatures, texts and sets
move only for classes that still have a partner.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator
from hashlib import blake2b

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chorale.llm.common import connected_components, materialize, small_batches

SHINGLE = 5
#: Similarity threshold in hundredths; bands of so many signature positions each.
PERCENT, BANDS, ROWS = 75, 32, 4
#: Signature positions compared between two decisions, and the chance a true pair is dropped at one.
BATCH, MISS = 16, 1e-6
#: Members of a bucket, and their shingles, compared in one piece.
BLOCK, BLOCK_ITEMS = 512, 2_000_000
#: Signatures and shingles handled at once, for bounded memory on long texts.
PIECE = 8_192
HASHES = BANDS * ROWS
#: Bits (a power of two) of the map of needed rows; rows beside it stay where they are.
TEXT_BITS = 1 << 24
#: Classes that a task remembers, so that copies of a text carry its signature once.
SEEN = 100_000


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijective finalizer of 64-bit values (splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_SEEDS = _mix(np.arange(1, 2 * HASHES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_FACTORS, _OFFSETS = _SEEDS[:HASHES] | np.uint64(1), _SEEDS[HASHES:]


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's five-word shingles; of all words, if fewer; empty without words."""
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return np.empty(0, np.uint64)
    hashed = np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found))
    width = min(SHINGLE, len(found))
    total = np.full(len(found) - width + 1, width, np.uint64)
    for k in range(width):
        total = _mix(total + hashed[k : len(found) - width + 1 + k])
    return np.unique(total)


def signature(shingled: np.ndarray) -> np.ndarray:
    """The minimum of each hash function over a non-empty set, as 32-bit values."""
    least = np.full(HASHES, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingled), PIECE // 16):
        part = shingled[None, at : at + PIECE // 16] * _FACTORS[:, None] + _OFFSETS[:, None]
        least = np.minimum(least, part.min(axis=1))
    return (least >> np.uint64(32)).astype(np.uint32)


def _band_keys(sign: np.ndarray) -> np.ndarray:
    words = sign.reshape(BANDS, ROWS).astype(np.uint64)
    key = np.arange(1, BANDS + 1, dtype=np.uint64)
    for k in range(ROWS):
        key = _mix(key * np.uint64(0x9E3779B97F4A7C15) + words[:, k])
    return key.view(np.int64)


def least_matches(percent: int = PERCENT, miss: float = MISS) -> list[int]:
    """Matches needed after each batch: fewer, and the posterior of reaching the threshold is below ``miss``.

    With a uniform prior the posterior after m of n matches is Beta(m + 1, n - m + 1); its upper tail at t is the
    probability of at most m successes in n + 1 trials of chance t.
    """
    t, needed = percent / 100, []
    for n in range(BATCH, HASHES + 1, BATCH):
        tail, m = 0.0, -1
        while tail < miss and m < n:
            m += 1
            tail += math.comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
        needed.append(m)
    return needed


NEEDED = least_matches()


def surviving(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Positions of the signature pairs (rows of two arrays) that no batch rules out."""
    alive = np.arange(len(left))
    matches = np.zeros(len(left), np.int64)
    for batch, needed in enumerate(NEEDED):
        part = slice(batch * BATCH, (batch + 1) * BATCH)
        matches = matches + (left[alive, part] == right[alive, part]).sum(axis=1)
        keep = matches >= needed
        alive, matches = alive[keep], matches[keep]
    return alive


def _signs(column: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.uint8).reshape(-1, HASHES)


def _describe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Class and set size of each document, with signature (low bytes) and band keys the first time a class is met.

    Empty documents have no class.
    """
    seen: set[int] = set()
    for pdf in batches:
        rows = []
        for doc_id, text_hash, text in zip(pdf["doc_id"], pdf["text_hash"], pdf["text"], strict=True):
            s = shingles(text)
            if not len(s):
                rows.append((doc_id, text_hash, None, 0, None, None))
                continue
            node = int.from_bytes(blake2b(s.tobytes(), digest_size=8).digest(), "little", signed=True)
            if node in seen:
                rows.append((doc_id, text_hash, node, len(s), None, None))
                continue
            if len(seen) == SEEN:
                seen.clear()
            seen.add(node)
            sign = signature(s)
            rows.append((doc_id, text_hash, node, len(s), sign.astype(np.uint8).tobytes(), _band_keys(sign)))
        out = pd.DataFrame(rows, columns=["doc_id", "text_hash", "node", "n_shingles", "sign", "bands"], dtype=object)
        # whole numbers beside missing ones must not pass through floats, which round 64 bits
        yield out.astype({"text_hash": "int64", "node": "Int64", "n_shingles": "int64"})


def _compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        if len(pdf):
            yield pdf[["a", "b"]].iloc[surviving(_signs(pdf["sign_a"]), _signs(pdf["sign_b"]))]


class _Block:
    """Members of a block of a bucket and of a block of its rest, and the pairs that no batch rules out."""

    def __init__(self, members: Iterable[dict]):
        self.node = np.array([m["node"] for m in members], np.int64)
        self.group = [m["component"] for m in members]
        self.rest = np.array([m["place"]["rest"] for m in members], bool)
        self.size = np.array([m["n_shingles"] for m in members], np.int64)
        self.sign = _signs([m["sign"] for m in members])
        self.marks = np.array([m["marks"] for m in members], np.int32)
        self.band = members[0]["number"]

    def partners(self, k: int, apart: Callable[[int], bool]) -> np.ndarray:
        """Survivors beside member ``k`` of the rest among those ``apart`` from it, most alike first.

        A pair is looked at in the first band that it shares.
        """
        size = self.size
        near = ~self.rest & (100 * np.minimum(size, size[k]) >= PERCENT * np.maximum(size, size[k]))
        others = np.flatnonzero(near & ((self.marks == self.marks[k]).argmax(axis=1) == self.band))
        others = others[[apart(x) for x in others]] if len(others) else others
        kept = others[surviving(np.broadcast_to(self.sign[k], (len(others), HASHES)), self.sign[others])]
        return kept[np.argsort(-(self.sign[kept] == self.sign[k]).sum(axis=1), kind="stable")]


def _alive(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Members that survive beside one of another component: one row each, however many pairs there are."""
    for pdf in batches:
        out = []
        for members in pdf["members"]:
            block = _Block(members)
            found = set()
            for k in np.flatnonzero(block.rest):
                others = block.partners(k, lambda x, k=k: block.group[x] != block.group[k])
                if len(others):
                    found.update((int(k), *others.tolist()))
            for x in sorted(found):
                m = members[x]
                out.append((m["band"], m["number"], m["node"], m["n_shingles"], m["component"], m["place"]))
        yield pd.DataFrame(out, columns=["band", "number", "node", "n_shingles", "component", "place"])


def _across(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Confirmed links between components, from a block of a bucket and a block of its rest: a spanning forest of them.

    Pairs whose components are joined already, by links of this block, are passed over, so there are fewer links than
    members however many pairs come near the threshold.
    """
    for pdf in batches:
        out = []
        for members in pdf["members"]:
            block = _Block(members)
            node, size, group = block.node, block.size, block.group
            items = [np.asarray(m["items"]) for m in members]
            above = {g: g for g in group}

            def top(g: int) -> int:
                while above[g] != g:
                    above[g] = g = above[above[g]]
                return g

            for k in np.flatnonzero(block.rest):
                for x in block.partners(k, lambda x, k=k: top(group[x]) != top(group[k])):
                    one, other = top(group[k]), top(group[x])
                    if one != other:
                        common = len(np.intersect1d(items[k], items[x], assume_unique=True))
                        if 100 * common >= PERCENT * (size[k] + size[x] - common):
                            above[one] = other
                            out.append((int(min(node[k], node[x])), int(max(node[k], node[x]))))
        yield pd.DataFrame(out, columns=["a", "b"])


def _sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        rows = []
        for text in pdf["text"]:
            s = shingles(text)
            node = int.from_bytes(blake2b(s.tobytes(), digest_size=8).digest(), "little", signed=True)
            rows.append((node, s.view(np.int64)))
        yield pd.DataFrame(rows, columns=["node", "items"])


def flagged(rows: DataFrame, needed: DataFrame, key: str) -> DataFrame:
    """``rows`` with ``likely``: whether ``key``, a hash, may be among those of ``needed``.

    Read off a bit map of fixed size, so some are flagged by mistake, but none of ``needed`` is missed.
    """
    place = F.col(key).bitwiseAND(TEXT_BITS - 1)
    bits = needed.where(F.col(key).isNotNull()).select(F.shiftright(place, 6).alias("at"), place.bitwiseAND(63).cast("int").alias("bit"))
    bits = bits.groupBy("at").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits"))
    found = rows.join(F.broadcast(bits), F.shiftright(place, 6) == F.col("at"), "left")
    likely = F.coalesce(F.bit_get("bits", place.bitwiseAND(63).cast("int")) == 1, F.lit(False))
    return found.select(*rows.columns, likely.alias("likely"))


def _likely(rows: DataFrame, needed: DataFrame, key: str = "text_hash") -> DataFrame:
    """The rows whose ``key`` may be among those of ``needed``."""
    return flagged(rows, needed, key).where("likely").drop("likely")


def _shingle_sets(needed: DataFrame, documents: DataFrame, classes: DataFrame) -> DataFrame:
    """``node``, ``items``: the full shingle sets of the classes in ``needed``, one row each."""
    # a class is read from one document; a wrong hit of the key only adds a set that no pair asks for
    key = F.xxhash64("doc_id", "text_hash").alias("key")
    source = materialize(classes.join(needed.select("node").distinct(), "node").select(key).distinct(), "needed-texts")
    likely = _likely(documents.select(key, "text"), source, "key")  # so that few other texts are moved
    texts = likely.join(source, "key", "left_semi").dropDuplicates(["key", "text"])
    return texts.select("text").mapInPandas(_sets, "node long, items array<long>")


def _confirm(pairs: DataFrame, documents: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs (``a``, ``b``) whose full shingle sets reach the threshold."""
    needed = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node")))
    sets = materialize(_shingle_sets(needed, documents, classes), "shingle-sets")
    left = sets.select(F.col("node").alias("a"), F.col("items").alias("x"))
    right = sets.select(F.col("node").alias("b"), F.col("items").alias("y"))
    both = pairs.join(left, "a").join(right, "b")
    common = F.size(F.array_intersect("x", "y"))
    return both.where(100 * common >= PERCENT * (F.size("x") + F.size("y") - common)).select("a", "b")


def near_duplicates(documents: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``text_hash``, ``n_shingles``, ``component_id``, ``kept`` for every row of ``documents``.

    ``component_id`` is the smallest id reachable over links of similarity 0.75 or more. Texts without words and null
    texts have no shingles and link with nothing. Repeated rows and ids are fine: equal texts share a class whatever
    their ids. Null ids are never the smallest; a group of nothing else has a null component and keeps all its rows.
    """
    small_batches(documents.sparkSession, 1_000)
    source = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    source = source.withColumn("text_hash", F.xxhash64("text"))
    # ids go through Python as strings, since pandas holds whole numbers with nulls as floats
    rows = source.withColumn("doc_id", F.col("doc_id").cast("string")).mapInPandas(
        _describe, "doc_id string, text_hash long, node long, n_shingles long, sign binary, bands array<long>"
    )
    rows = materialize(rows.withColumn("doc_id", F.col("doc_id").cast("long")), "signatures")
    # min of a struct skips no null id, so the id is taken apart: any row of the class will do for its text
    picked = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")).alias("pick")
    classes = rows.where("node IS NOT NULL").groupBy("node").agg(picked)
    classes = materialize(classes.select("node", "pick.doc_id", "pick.text_hash"), "classes")

    # members are dealt by band once: stored first, and with the same columns on both sides, so that the shuffle is reused
    members = rows.where("bands IS NOT NULL").select("node", F.posexplode("bands").alias("number", "band"))
    members = materialize(members, "members").repartition("band")
    buckets = members.groupBy("band", "number").agg(F.min("node").alias("leader"), F.max("node").alias("last"))
    members = members.join(buckets.where("leader != last").select("band", "leader"), "band")
    members = materialize(members.dropDuplicates(["band", "node"]), "buckets")
    needed = materialize(members.select("node").distinct(), "needed-signatures")
    # a band key is told by 31 of its bits where two members of one bucket are compared
    marks = F.transform("bands", lambda b: b.bitwiseAND(0x7FFFFFFF).cast("int")).alias("marks")
    signs = _likely(rows.where("bands IS NOT NULL").select("node", "n_shingles", "sign", marks), needed, "node")
    signs = materialize(signs.join(needed, "node", "left_semi").dropDuplicates(["node"]), "needed-signs")

    def signed(pairs: DataFrame) -> DataFrame:
        pairs = pairs.join(signs.select(F.col("node").alias("a"), F.col("sign").alias("sign_a")), "a")
        return pairs.join(signs.select(F.col("node").alias("b"), F.col("sign").alias("sign_b")), "b")

    stars = members.where("node != leader").select(F.col("leader").alias("a"), F.col("node").alias("b")).distinct()
    stars = materialize(signed(stars).mapInPandas(_compare, "a long, b long"), "leader-pairs")
    links = materialize(_confirm(stars, source, classes), "leader-links")

    found = connected_components(links)
    placed = members.join(signs.select("node", "n_shingles"), "node").join(found, "node", "left")
    placed = placed.select("band", "number", "node", "n_shingles", F.coalesce("component", "node").alias("component"))
    by_component = placed.groupBy("band", "component").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("items"))
    mixed = by_component.groupBy("band").agg(
        F.max(F.struct("n", "items", "component")).alias("big"), F.sum("n").alias("n"), F.sum("items").alias("items"), F.count("*").alias("components")
    )
    # a block is bounded in members and in shingles
    blocks = lambda n, items: F.greatest(F.ceil(n / BLOCK), F.ceil(items / BLOCK_ITEMS)).cast("int")
    mixed = mixed.where("components > 1").select(
        "band",
        F.col("big.component").alias("big"),
        blocks(F.col("n"), F.col("items")).alias("all_blocks"),
        blocks(F.col("n") - F.col("big.n"), F.col("items") - F.col("big.items")).alias("rest_blocks"),
    )
    placed = placed.join(mixed, "band")
    # all members meet those outside the bucket's largest component: (block of all, block of the rest)
    own_all, own_rest = (F.pmod(F.xxhash64("node", F.lit(c)), f"{c}_blocks").cast("int") for c in ("all", "rest"))
    place = lambda i, j, rest: F.struct(i.alias("i"), j.alias("j"), F.lit(rest).alias("rest"))
    places = F.transform(F.sequence(F.lit(0), F.col("rest_blocks") - 1), lambda j: place(own_all, j, False))
    as_rest = F.transform(F.sequence(F.lit(0), F.col("all_blocks") - 1), lambda i: place(i, own_rest, True))
    places = F.when(F.col("component") == F.col("big"), places).otherwise(F.concat(places, as_rest))
    placed = materialize(placed.select("band", "number", "node", "n_shingles", "component", F.explode(places).alias("place")), "places")

    def met(members: DataFrame) -> DataFrame:
        columns = F.struct(*members.columns)
        return members.groupBy("band", "place.i", "place.j").agg(F.collect_list(columns).alias("members")).select("members")

    place_type = "struct<i: int, j: int, rest: boolean>"
    alive = met(placed.join(signs.drop("n_shingles"), "node")).mapInPandas(
        _alive, f"band long, number int, node long, n_shingles long, component long, place {place_type}"
    )
    alive = materialize(alive, "members-alive")
    sets = _shingle_sets(alive, source, classes)
    meeting = met(alive.join(signs.drop("n_shingles"), "node").join(sets, "node"))
    links = links.unionByName(materialize(meeting.mapInPandas(_across, "a long, b long").distinct(), "block-links"))

    found = connected_components(links).join(classes.select("node", "doc_id"), "node")
    smallest = found.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    found = found.join(smallest, "component").select("node", "component_id")
    alone = classes.join(found, "node", "left").select("node", F.coalesce("component_id", "doc_id").alias("component_id"))
    component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id")
    out = rows.select("doc_id", "text_hash", "node", "n_shingles").join(alone, "node", "left")
    out = out.select("doc_id", "text_hash", "n_shingles", component)
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
