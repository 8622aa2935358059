"""Phrase collocations, counted in suffix subtrees that are built group by group.

A suffix is a position of a text with up to four words from there to the end of its piece. All suffixes together form
a tree whose node counts are the frequencies of phrases. It is cut up vertically, by first words:

1. *Words* are counted. Those under ``least`` can stand in no candidate, so they end pieces from here on. A bit map of
   fixed size tells them apart while texts are read; it may take a rare word for a common one, never the reverse.
2. *Prefixes* that start more suffixes than a task should hold (``BUDGET`` / 4) are told by one scan: a batch reports
   a prefix that it holds more often than its share of half that bound, so none is missed and the list is short. A
   suffix belongs to the shortest of its prefixes that is not on the list. A prefix of four words has one leaf only.
3. *Groups*: prefixes are dealt to groups that hold half of ``BUDGET`` suffixes on average. A batch of texts sorts its
   suffixes, merges equal ones, and sends each group its share as one row of arrays.
4. *Subtrees*: a group sorts its suffixes; the nodes of depth d are the stretches with equal first d words, and their
   counts are sums over the leaves below. Prefixes on the list lie in several groups, so their counts are summed.

The nodes of ``least`` and more are a table; scores, containment and ranks are joins and aggregates over it.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from chorale.llm.common import materialize

#: Words of a phrase, and suffixes of a group.
DEPTH, BUDGET = 4, 2_000_000
#: Words of a batch of suffixes, distinct words of a batch of counts, bits of the map of common words (a power of two).
BATCH, DISTINCT, BITS = 1 << 20, 500_000, 1 << 26
#: Phrases of a broadcast table of the most frequent ones, a depth.
COMMON = 50_000
#: Every text byte that splits pieces becomes a line feed, every other separator a blank; A to Z become small.
_BREAKS, _BLANKS = b".,;:!?\n\x0b\x0c\r", b" \t"
_TABLE = bytes(10 if b in _BREAKS else 32 if b in _BLANKS else b + 32 if 65 <= b <= 90 else b for b in range(256))
#: A byte that no valid text holds marks the end of a piece.
_END = b"\xff"


def words(text: bytes) -> list[bytes]:
    """The words of a text in lower case; ``_END`` stands between pieces and at the end."""
    return text.translate(_TABLE).replace(b"\n", b" \xff ").split(b" ") + [_END]


def _hash(lang: bytes, word: bytes) -> int:
    return xxhash.xxh64_intdigest(word, xxhash.xxh64_intdigest(lang, 42))


class _Texts:
    """Batches of texts of one language as arrays of word numbers: 0 ends a piece, others point into ``vocabulary``."""

    def __init__(self, common: np.ndarray | None):
        self.common, self.numbers, self.vocabulary, self.ids, self.size = common, {}, [b""], [], 0
        self.numbers = {_END: 0, b"": -1}

    def add(self, lang: bytes, text: bytes) -> None:
        found = words(text)
        numbers = self.numbers
        for word in set(found).difference(numbers):
            h = _hash(lang, word) % BITS
            if self.common is None or int(self.common[h >> 6]) >> (h & 63) & 1:
                numbers[word] = len(self.vocabulary)
                self.vocabulary.append(word)
            else:
                numbers[word] = 0
        ids = np.fromiter((numbers[w] for w in found), np.int64, len(found))
        self.ids.append(ids[ids >= 0])
        self.size += len(self.ids[-1])

    def suffixes(self) -> np.ndarray:
        """One row of ``DEPTH`` numbers for every word, 0 behind the end of its piece."""
        ids = np.concatenate([*self.ids, np.zeros(DEPTH, np.int64)])
        columns, alive = [], np.ones(len(ids) - DEPTH, bool)
        for k in range(DEPTH):
            column = np.where(alive, ids[k : k + len(alive)], 0)
            alive &= column > 0
            columns.append(column)
        return np.stack(columns, 1)[columns[0] > 0]


def _stretches(rows: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The distinct rows in lexical order, and their summed counts."""
    if not len(rows):
        return rows, np.zeros(0, np.int64)
    base = int(rows.max()) + 1
    first, second = rows[:, 0] * base + rows[:, 1], rows[:, 2] * base + rows[:, 3]
    order = np.lexsort((second, first))
    first, second = first[order], second[order]
    starts = np.flatnonzero(np.concatenate([[True], (first[1:] != first[:-1]) | (second[1:] != second[:-1])]))
    sums = np.diff(np.append(starts, len(order))) if counts is None else np.add.reduceat(counts[order], starts)
    return rows[order[starts]], sums


def _per_language(batches: Iterable[pa.RecordBatch], common: np.ndarray | None) -> Iterator[tuple[bytes, _Texts]]:
    """Texts gathered by language up to ``BATCH`` words, whatever the rows of an Arrow batch."""
    open_texts: dict[bytes, _Texts] = {}
    for batch in batches:
        texts = batch.column("text").cast(pa.binary()).to_pylist()
        for lang, text in zip(batch.column("lang").cast(pa.binary()).to_pylist(), texts):
            gathered = open_texts.setdefault(lang, _Texts(common))
            gathered.add(lang, text)
            if gathered.size >= BATCH:
                yield lang, open_texts.pop(lang)
    yield from open_texts.items()


def _texts(documents: DataFrame) -> DataFrame:
    return documents.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))


def word_counts(texts: DataFrame) -> DataFrame:
    """``lang``, ``word``, ``f`` of every word of ``lang``, ``text``."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[bytes, Counter] = {}

        def rows() -> Iterator[pa.RecordBatch]:
            for lang, found in counts.items():
                arrays = [pa.array([lang] * len(found), pa.binary()), pa.array(list(found), pa.binary())]
                arrays = [a.cast(pa.string()) for a in arrays] + [pa.array(list(found.values()), pa.int64())]
                yield pa.RecordBatch.from_arrays(arrays, names=["lang", "word", "f"])
            counts.clear()

        for batch in batches:
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            for lang, text in zip(batch.column("lang").cast(pa.binary()).to_pylist(), texts):
                found = counts.setdefault(lang, Counter())
                found.update(words(text))
                del found[_END], found[b""]
            if sum(map(len, counts.values())) >= DISTINCT:
                yield from rows()
        yield from rows()

    partial = texts.mapInArrow(counted, "lang string, word string, f long")
    return partial.groupBy("lang", "word").agg(F.sum("f").alias("f"))


def _common_words(counts: DataFrame, least: int) -> np.ndarray:
    """A map of ``BITS`` bits with the places of all words of ``least`` and more; its size does not grow with the words."""
    place = F.xxhash64("lang", "word").bitwiseAND(BITS - 1)
    places = counts.where(F.col("f") >= least).select(F.shiftright(place, 6).alias("at"), place.bitwiseAND(63).cast("int").alias("bit"))
    blocks = places.groupBy("at").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits")).toArrow()
    common = np.zeros(BITS >> 6, np.int64)
    common[blocks.column("at").to_numpy()] = blocks.column("bits").to_numpy()
    return common.view(np.uint64)


def _heavy_prefixes(texts: DataFrame, common, total: int, bound: int) -> list[tuple[str, str]]:
    """Language and words of every prefix that may start more than ``bound`` suffixes.

    At most 2 * ``total`` / ``bound`` a depth are listed, since listed counts are true occurrences.
    """

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, gathered in _per_language(batches, common.value):
            rows, counts = _stretches(gathered.suffixes())
            share = bound / 2 * gathered.size / total
            phrases, sums = [], []
            for d in range(1, DEPTH):
                starts = _nodes(rows, d)
                n = np.add.reduceat(counts, starts) if len(starts) else counts
                for at in np.flatnonzero((n > share) & (rows[starts, d - 1] > 0)):
                    phrases.append(b" ".join(gathered.vocabulary[w] for w in rows[starts[at], :d]))
                    sums.append(int(n[at]))
            arrays = [pa.array([lang] * len(phrases), pa.binary()).cast(pa.string()), pa.array(phrases, pa.binary()).cast(pa.string())]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(sums, pa.int64())], names=["lang", "phrase", "f"])

    listed = texts.mapInArrow(found, "lang string, phrase string, f long").groupBy("lang", "phrase").agg(F.sum("f").alias("f"))
    return [(r.lang, r.phrase) for r in listed.where(F.col("f") > bound // 2).select("lang", "phrase").collect()]


def _nodes(rows: np.ndarray, depth: int) -> np.ndarray:
    """Starts of the stretches of sorted rows that agree in their first ``depth`` words."""
    if not len(rows):
        return np.zeros(0, np.int64)
    return np.flatnonzero(np.concatenate([[True], (rows[1:, :depth] != rows[:-1, :depth]).any(1)]))


def _key_depths(rows: np.ndarray, vocabulary: list[bytes], heavy: list[bytes]) -> np.ndarray:
    """How many words of each row make its key: the shortest prefix that is not listed as heavy."""
    numbers = {w: i for i, w in enumerate(vocabulary) if i}
    depths, base = np.ones(len(rows), np.int64), len(vocabulary)
    for d in range(1, DEPTH):
        listed = [[numbers.get(w, -1) for w in phrase.split(b" ")] for phrase in heavy if phrase.count(b" ") == d - 1]
        listed = [p for p in listed if -1 not in p]
        if listed:
            packed, wanted = rows[:, 0], np.array([p[0] for p in listed])
            for k in range(1, d):
                # numbers of pairs stay small: they are places in the list of what occurs
                seen, packed = np.unique(packed * base + rows[:, k], return_inverse=True)
                wanted = wanted * base + np.array([p[k] for p in listed])
                at = np.minimum(np.searchsorted(seen, wanted), len(seen) - 1)
                keep = seen[at] == wanted
                wanted, listed = at[keep], [p for p, k_ in zip(listed, keep) if k_]
            depths[np.isin(packed, wanted) & (depths == d)] = d + 1
    return depths


def _shares(texts: DataFrame, common, heavy: dict[bytes, list[bytes]], groups: int) -> DataFrame:
    """``group``, ``lang``, ``vocabulary`` and arrays of merged suffixes: a row for each batch and group."""

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, gathered in _per_language(batches, common.value):
            rows, counts = _stretches(gathered.suffixes())
            vocabulary = gathered.vocabulary
            depths = _key_depths(rows, vocabulary, heavy.get(lang, []))
            hashes = np.array([0] + [_hash(lang, w) for w in vocabulary[1:]], np.uint64)
            key = np.zeros(len(rows), np.uint64)
            for k in range(DEPTH):
                mixed = (key * np.uint64(0x9E3779B97F4A7C15)) ^ hashes[rows[:, k]]
                key = np.where(depths > k, mixed ^ (mixed >> np.uint64(29)), key)
            group = (key % np.uint64(groups)).astype(np.int64)
            order = np.argsort(group, kind="stable")
            ends = np.searchsorted(group[order], np.arange(groups + 1))
            out: dict[str, list] = {n: [] for n in ("group", "lang", "vocabulary", "width", "rows", "counts", "depths")}
            for g in np.unique(group):
                at = order[ends[g] : ends[g + 1]]
                used, local = np.unique(rows[at], return_inverse=True)
                if used[0] != 0:  # 0 keeps its meaning
                    used, local = np.insert(used, 0, 0), local + 1
                kind = np.min_scalar_type(len(used))
                out["group"].append(int(g))
                out["lang"].append(lang)
                out["vocabulary"].append(b" ".join(vocabulary[w] for w in used[1:]))
                out["width"].append(kind.itemsize)
                # columns one after the other, in sorted order: the shuffle's compression thrives on it
                out["rows"].append(local.reshape(len(at), DEPTH).T.astype(kind).tobytes())
                out["counts"].append(counts[at].astype(np.uint32).tobytes())
                out["depths"].append(depths[at].astype(np.uint8).tobytes())
            kinds = {"group": pa.int64(), "width": pa.int64()}
            yield pa.RecordBatch.from_pydict({n: pa.array(v, kinds.get(n, pa.binary())) for n, v in out.items()})

    schema = "group long, lang binary, vocabulary binary, width long, rows binary, counts binary, depths binary"
    return texts.mapInArrow(dealt, schema)


def _subtree(shares: pd.DataFrame, least: int) -> pd.DataFrame:
    """Phrases and counts of one group's subtrees: those of ``least`` and more, and parts of counts of listed prefixes."""
    out = []
    for lang, rows_of in shares.groupby("lang", sort=False):
        numbers: dict[bytes, int] = {}
        parts, counts, depths = [], [], []
        for vocabulary, width, rows, n, d in zip(*[rows_of[c] for c in ("vocabulary", "width", "rows", "counts", "depths")]):
            local = np.array([0] + [numbers.setdefault(w, len(numbers) + 1) for w in vocabulary.split(b" ")], np.int64)
            parts.append(local[np.frombuffer(rows, f"u{width}").reshape(DEPTH, -1).T])
            counts.append(np.frombuffer(n, np.uint32).astype(np.int64))
            depths.append(np.frombuffer(d, np.uint8))
        rows, counts, depths = np.concatenate(parts), np.concatenate(counts), np.concatenate(depths)
        # equal suffixes have one key, so its depth may ride along as the lowest digit of the last word
        rows[:, DEPTH - 1] = rows[:, DEPTH - 1] * (DEPTH + 1) + depths
        rows, counts = _stretches(rows, counts)
        rows[:, DEPTH - 1], depths = np.divmod(rows[:, DEPTH - 1], DEPTH + 1)
        names = [b"", *numbers]
        for d in range(1, DEPTH + 1):
            starts = _nodes(rows, d)
            totals = np.add.reduceat(counts, starts)
            kept = np.flatnonzero((rows[starts, d - 1] > 0) & ((totals >= least) | (depths[starts] > d)))
            phrases = [b" ".join(names[w] for w in rows[s, :d]).decode() for s in starts[kept]]
            out.append(pd.DataFrame({"lang": lang.decode(), "phrase": phrases, "depth": d, "f": totals[kept]}))
    return pd.concat(out)


def phrase_counts(texts: DataFrame, counts: DataFrame, total: int, least: int, budget: int = BUDGET) -> DataFrame:
    """``lang``, ``phrase``, ``depth``, ``f`` of all phrases of 1 to ``DEPTH`` words that occur ``least`` times or more.

    ``texts`` has ``lang`` and ``text``, ``counts`` the words of them, ``total`` their number.
    """
    spark = texts.sparkSession
    common = spark.sparkContext.broadcast(_common_words(counts, least))
    bound = max(budget // 4, 1)
    heavy: dict[bytes, list[bytes]] = {}
    if not counts.where(F.col("f") > bound).isEmpty():
        for lang, phrase in _heavy_prefixes(texts, common, total, bound):
            heavy.setdefault(lang.encode(), []).append(phrase.encode())
    groups = max(2 * total // budget, 1)
    shares = _shares(texts, common, heavy, groups)
    nodes = shares.groupBy("group").applyInPandas(
        lambda pdf: _subtree(pdf, least), "lang string, phrase string, depth int, f long"
    )
    summed = nodes.groupBy("lang", "phrase", "depth").agg(F.sum("f").alias("f"))
    return summed.where(F.col("f") >= least)


def _looked_up(cuts: DataFrame, counts: DataFrame, total: int, part: str, out: str) -> DataFrame:
    """``cuts`` with the count of its phrase ``part``.

    A part can stand in many candidates only if it is frequent. The phrases that occur more than ``total`` /
    ``COMMON`` times, at most ``COMMON`` of each depth, are broadcast; the others are joined by shuffling.
    """
    keyed = counts.select("lang", F.col("phrase").alias(part), F.col("f").alias(out))
    frequent = F.col(out) * COMMON > total
    first = cuts.join(F.broadcast(keyed.where(frequent)), ["lang", part], "left")
    rest = first.where(F.col(out).isNull()).drop(out).join(keyed.where(~frequent), ["lang", part])
    return first.where(F.col(out).isNotNull()).unionByName(rest)


def _joined(words_: Column, start: int | Column, length: int | Column) -> Column:
    return F.array_join(F.slice(words_, start, length), " ")


def score_phrases(counts: DataFrame, total: int, containment: int = 80) -> DataFrame:
    """``lang``, ``phrase``, ``a``, ``l``, ``r``, ``score`` of the candidates that no longer one contains too often.

    ``counts`` is as ``phrase_counts`` makes it: parts of a candidate occur at least as often, so all are in it.
    """
    listed = counts.withColumns({"a": F.col("f"), "words": F.split("phrase", " ")}).where("depth > 1")
    ks = F.sequence(F.lit(1), F.col("depth") - 1)
    cuts = listed.select(
        "lang",
        "phrase",
        "a",
        F.inline(
            F.transform(
                ks,
                lambda k: F.struct(
                    k.alias("k"),
                    _joined(F.col("words"), F.lit(1), k).alias("first"),
                    _joined(F.col("words"), k + 1, F.col("depth") - k).alias("rest"),
                ),
            )
        ),
    )
    cuts = _looked_up(_looked_up(cuts, counts, total, "first", "l"), counts, total, "rest", "r")
    score = F.expr("(cast(a AS decimal(20, 0)) * 2000000BD) div cast(l + r AS decimal(20, 0))")
    lowest = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut")
    scored = cuts.groupBy("lang", "phrase", "a").agg(lowest).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    inner = F.flatten(
        F.transform(
            F.sequence(F.lit(2), F.col("depth") - 1),
            lambda n: F.transform(F.sequence(F.lit(1), F.col("depth") - n + 1), lambda s: _joined(F.col("words"), s, n)),
        )
    )
    longer = listed.where("depth > 2").select("lang", F.explode(inner).alias("phrase"), "a")
    longest = longer.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = scored.join(longest, ["lang", "phrase"], "left")
    return kept.where(f"longer IS NULL OR 100 * longer < {containment} * a").drop("longer")


def collocations(documents: DataFrame, *, least: int = 30, top: int = 2_000, budget: int = BUDGET) -> DataFrame:
    """The ``top`` phrases of each language by score: ``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score``.

    Null ``lang`` counts as ``und``, null ``text`` as empty; repeated rows count each time, texts are read whole, and
    other columns are ignored. Ties in score and count go by the phrase in UTF-8 byte order. An empty table, and a
    language without candidates, gives no rows. ``budget`` is the number of suffixes a task may hold; it bounds the
    prefixes listed on the driver (8 * words / ``budget`` a depth), so raise it with the corpus.
    """
    texts = _texts(documents)
    counts = materialize(word_counts(texts), "phrase-words")
    sizes = counts.groupBy("lang").agg(F.sum("f").alias("n"))
    total = sizes.agg(F.sum("n")).first()[0] or 0
    if not total:
        return _empty(documents.sparkSession)
    found = materialize(phrase_counts(texts, counts, total, least, budget), "phrase-counts")
    scored = score_phrases(found, total)
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = scored.withColumn("rank", F.row_number().over(best).cast("long")).where(F.col("rank") <= top)
    return ranked.join(F.broadcast(sizes), "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def _empty(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], "lang string, rank long, phrase string, a long, l long, r long, n long, score long")
