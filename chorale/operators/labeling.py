"""Weak labelling by weighted keyword lexicons.

Two plans give the same scores for every lexicon:

* **inline** (the default, and the only one on a stream): the lexicon becomes
  one look-ahead regex shaped as a prefix tree. Each row finds its own matches
  and decides its own labels, so labelling is a pure projection: no explode, no
  join, no shuffle.
* **joined**, for a lexicon above ``INLINE_TERMS``: a word of a text is looked up
  in an index of the first words of all terms, a bit map of fixed size that is
  part of the plan. Only the spans that start at such a word leave the row, and
  each of them once for a block of some ``BLOCK_WORDS`` words, with the rows that
  hold it and how often; they are joined to the lexicon table, which is broadcast
  only up to ``BROADCAST_TERMS`` counted terms and shuffled beyond that. Symbols
  and other terms that do not begin and end with a word are counted in the row as
  in the inline plan, ``COUNTED_TERMS`` of them at a time.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from chorale.functions.text import WORD, WORD_END, WORD_START, normalize_text
from chorale.operators.lexicon import AXES, Axis, weigh_terms
from chorale.session import materialize, small_batches
from chorale.sources.checks import require_columns

INLINE_TERMS = 5_000
BROADCAST_TERMS = 200_000
#: Bits of the index of first words (a power of two), and terms counted in the row by one plan beside a joined lexicon.
INDEX_BITS = 1 << 18
COUNTED_TERMS = 1_000
#: Words of a block, whose equal spans leave it as one row.
BLOCK_WORDS = 1_000_000

_SCORE_TYPE = (
    "array<struct<family:string,label:string,label_pos:int,priority:int,score:bigint>>"
)


def _is_symbol(term: str) -> bool:
    return not any(ch.isalnum() for ch in term)


def _is_word_char(ch: str) -> bool:
    return ch.isalnum() or ch == "_"


def _overlaps_itself(term: str) -> bool:
    """Whether two matches of the term can share characters."""
    return any(
        term.startswith(term[i:]) and not _is_word_char(term[i - 1]) for i in range(1, len(term))
    )


def _quote(text: str) -> str:
    return "".join(c if _is_word_char(c) else rf"\x{{{ord(c):x}}}" for c in text)


def _prefix_tree_regex(terms: list[str]) -> str:
    """One alternation for all terms, longest first, each closed by a word bound."""
    by_head: dict[str, list[str]] = defaultdict(list)
    for term in terms:
        by_head[term[:1]].append(term[1:])
    ends_here = by_head.pop("", None) is not None
    branches = []
    for head, tails in by_head.items():
        while len(tails) > 0 and all(tails) and len({t[0] for t in tails}) == 1:
            head, tails = head + tails[0][0], [t[1:] for t in tails]
        branches.append(_quote(head) + _prefix_tree_regex(tails))
    if ends_here:
        branches.append(WORD_END)
    return branches[0] if len(branches) == 1 else "(?:" + "|".join(branches) + ")"


def _occurrences(found: Column, terms: list[str]) -> Column:
    return F.size(F.filter(found, lambda m: m.isin(terms)))


@dataclass(frozen=True)
class TermMatcher:
    """Expressions that count weighted lexicon terms in a cleaned text column."""

    labels: list[Row]  # distinct (family, label, label_pos, priority)
    bounded: dict[str, dict[str, int]]  # label key -> matched term -> weight it adds
    counted: dict[str, dict[str, int]]  # label key -> term counted on its own -> weight
    pattern: str | None

    @staticmethod
    def _key(row: Row) -> str:
        return f"{row.family}\x00{row.label}"

    @classmethod
    def from_rows(cls, rows: list[Row]) -> TermMatcher:
        plain = sorted(
            {r.term for r in rows if not _is_symbol(r.term) and not _overlaps_itself(r.term)}
        )
        known = set(plain)
        # At one position only the longest term is reported; the shorter ones
        # it starts with, up to a word bound, are matches as well.
        implied = {
            t: [
                t[:i]
                for i in range(1, len(t) + 1)
                if t[:i] in known and (i == len(t) or not _is_word_char(t[i]))
            ]
            for t in plain
        }
        weights: dict[str, dict[str, int]] = defaultdict(dict)
        for r in rows:
            weights[cls._key(r)][r.term] = r.weight
        bounded, counted = {}, {}
        for key, own in weights.items():
            added = {t: sum(own.get(s, 0) for s in implied[t]) for t in plain}
            bounded[key] = {t: w for t, w in added.items() if w}
            counted[key] = {t: w for t, w in own.items() if t not in known}
        labels = sorted({(r.family, r.label, r.label_pos, r.priority) for r in rows})
        fields = Row("family", "label", "label_pos", "priority")
        pattern = f"{WORD_START}(?=({_prefix_tree_regex(plain)}))" if plain else None
        return cls([fields(*x) for x in labels], bounded, counted, pattern)

    def find(self, text: Column) -> Column:
        """Longest term at every position where one starts."""
        if self.pattern is None:
            return F.array().cast("array<string>")
        return F.regexp_extract_all(text, F.lit(self.pattern), F.lit(1))

    def scores(self, text: Column, found: Column) -> Column:
        """The positive label scores of a row."""
        if not self.labels:
            return F.array().cast(_SCORE_TYPE)
        return F.filter(
            F.array(
                *[
                    F.struct(
                        F.lit(row.family).alias("family"),
                        F.lit(row.label).alias("label"),
                        F.lit(row.label_pos).alias("label_pos"),
                        F.lit(row.priority).alias("priority"),
                        self._score(self._key(row), text, found).alias("score"),
                    )
                    for row in self.labels
                ]
            ),
            lambda s: s["score"] > 0,
        )

    def _score(self, key: str, text: Column, found: Column) -> Column:
        parts = [F.lit(0).cast("bigint")]
        by_weight: dict[int, list[str]] = defaultdict(list)
        for term, weight in self.bounded[key].items():
            by_weight[weight].append(term)
        for weight, terms in by_weight.items():
            parts.append(_occurrences(found, terms).cast("bigint") * weight)
        for term, weight in self.counted[key].items():
            pattern = _quote(term)
            if not _is_symbol(term):
                pattern = f"{WORD_START}{pattern}{WORD_END}"
            parts.append(F.regexp_count(text, F.lit(pattern)).cast("bigint") * weight)
        return reduce(Column.__add__, parts)


def score_inline(df: DataFrame, matcher: TermMatcher, text_col: str = "text") -> DataFrame:
    """Add ``scores``: positive label scores of each row, within the row."""
    return (
        df.withColumn("_clean", normalize_text(text_col))
        .withColumn("_found", matcher.find(F.col("_clean")))
        .withColumn("scores", matcher.scores(F.col("_clean"), F.col("_found")))
        .drop("_clean", "_found")
    )


def _spannable(term: Column) -> Column:
    """Terms found as spans of words: no symbols, with a word at both ends."""
    return term.rlike(f"^{WORD}(.*{WORD})?$") & term.rlike(r"[\p{L}\p{N}]")


def _place(word: Column | str) -> Column:
    return F.xxhash64(word).bitwiseAND(INDEX_BITS - 1)


def _first_words(terms: DataFrame) -> np.ndarray:
    """The index of the words that terms start with; its size does not grow with the lexicon."""
    first = _place(F.regexp_extract("term", f"^{WORD}+", 0))
    bits = terms.select(F.shiftright(first, 6).alias("at"), first.bitwiseAND(63).cast("int").alias("bit"))
    blocks = bits.groupBy("at").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits")).collect()
    index = np.zeros(INDEX_BITS >> 6, np.int64)
    for block in blocks:
        index[block["at"]] = block["bits"]
    return index


def _known(words: Column, index: np.ndarray) -> Column:
    """Per word, whether the index holds it; a wrong hit of the map costs a row, no more."""
    bits = F.lit(index)

    def known(word: Column) -> Column:
        place = _place(word)
        return F.bit_get(bits[F.shiftright(place, 6).cast("int")], place.bitwiseAND(63).cast("int")) == 1

    return F.transform(words, known)


def _apart(heads: np.ndarray, key: np.ndarray, n: int, words: int) -> np.ndarray:
    """Which spans of ``n`` words count: from the left, none that shares a word with an equal one that counts."""
    at = np.full(words, -1, np.int64)
    at[heads] = key
    close = [heads[at[heads + d] == key] + d for d in range(1, n)]
    counts = np.ones(len(heads), bool)
    # spans that share words with an equal one to their left, and that one
    met = np.unique(np.concatenate([x for d, c in enumerate(close, 1) for x in (c, c - d)] or [heads[:0]]))
    ends: dict[int, int] = {}
    for i, code in zip(met.tolist(), at[met].tolist()):
        if i < ends.get(code, 0):
            at[i] = -1
        else:
            ends[code] = i + n
    counts[np.searchsorted(heads, met)] = at[met] >= 0
    return counts


def _block_spans(batches: list[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    """The distinct spans of up to ``words`` words of a block, with the rows that hold them and how often."""
    table = pa.Table.from_batches(batches)
    count = pc.list_value_length(table.column("words")).to_numpy()
    row = np.repeat(np.arange(len(count)), count)
    rows = table.column("_row").to_numpy()
    place = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    left = np.repeat(count, count) - place  # words from here to the end of the row

    def coded(column: str) -> tuple[np.ndarray, pa.Array]:
        codes = pc.list_flatten(table.column(column)).combine_chunks().dictionary_encode()
        return codes.indices.to_numpy(), codes.dictionary.cast(pa.large_string())

    word, word_texts = coded("words")
    gap, gap_texts = coded("gaps")  # gap i stands after word i; one a word
    heads = np.flatnonzero(pc.list_flatten(table.column("known")).to_numpy())
    key, texts = word[heads].astype(np.int64), word_texts
    for n in range(words):
        if n:
            longer = left[heads] > n
            heads, key = heads[longer], key[longer]
            # both codes lie below the number of words, so that a pair of them fits
            tails, tail = np.unique(gap[heads + n - 1].astype(np.int64) * len(word_texts) + word[heads + n], return_inverse=True)
            pairs, key = np.unique(key * max(len(tails), 1) + tail, return_inverse=True)
            first, last = np.divmod(pairs, max(len(tails), 1))
            between, after = np.divmod(tails[last], len(word_texts))
            parts = (texts.take(pa.array(first)), gap_texts.take(pa.array(between)), word_texts.take(pa.array(after)))
            texts = pc.binary_join_element_wise(*parts, pa.scalar("", pa.large_string()))
        if not len(heads):
            return
        counts = _apart(heads, key, n + 1, len(row))
        held, times = np.unique((key * len(count) + row[heads])[counts], return_counts=True)
        span, holder = np.divmod(held, len(count))
        spans, starts = np.unique(span, return_index=True)
        offsets = pa.array(np.append(starts, len(held)), pa.int32())
        out = {
            "term": texts.take(pa.array(spans)).cast(pa.string()),
            "rows": pa.ListArray.from_arrays(offsets, pa.array(rows[holder], pa.int64())),
            "times": pa.ListArray.from_arrays(offsets, pa.array(times, pa.int64())),
        }
        yield from pa.table(out).to_batches(max_chunksize=10_000)


def _spans(clean: DataFrame, index: np.ndarray, words: int) -> DataFrame:
    """``term``, ``rows``, ``times``: spans of up to ``words`` words that start at a word of the index, once a block."""
    split = clean.select("_row", "_clean", F.regexp_extract_all("_clean", F.lit(f"{WORD}+"), F.lit(0)).alias("words"))
    # what stands before the first word is left out
    gaps = F.slice(F.split("_clean", f"{WORD}+", -1), 2, F.size("words"))
    split = split.where(F.size("words") > 0).select("_row", "words", gaps.alias("gaps"), _known(F.col("words"), index).alias("known"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += pc.sum(pc.list_value_length(batch.column("words"))).as_py() or 0
            if size >= BLOCK_WORDS:
                yield from _block_spans(held, words)
                held, size = [], 0
        if size:
            yield from _block_spans(held, words)

    small_batches(clean.sparkSession)
    return split.mapInArrow(cut, "term string, rows array<long>, times array<long>")


def score_joined(df: DataFrame, terms: DataFrame, text_col: str = "text") -> DataFrame:
    """Add ``scores`` by joining text spans to the weighted terms.

    ``terms`` is stored, as it is read several times. Rows are told apart by a
    number of their own, given when the corpus is written to the shared folder;
    ids may repeat. Terms that are no spans of words are counted in the row,
    ``COUNTED_TERMS`` of them in a pass.
    """
    spanned = terms.where(_spannable(F.col("term")))
    shape = spanned.agg(F.count("*").alias("n"), F.max(F.regexp_count("term", F.lit(WORD + "+"))).alias("words")).first()
    rows = df.withColumns({"_row": F.monotonically_increasing_id(), "_clean": normalize_text(text_col)})
    rows = materialize(rows, "corpus")  # cleaned once, read several times
    clean = rows.select("_row", "_clean").where(F.col("_clean") != "")
    label = ["family", "label", "label_pos", "priority"]
    hits = []
    others = terms.where(~_spannable(F.col("term"))).orderBy("term").toLocalIterator()
    while (part := list(islice(others, COUNTED_TERMS))) or not (hits or shape.n):
        matcher = TermMatcher.from_rows(part)
        counted = clean.withColumn("scores", matcher.scores(F.col("_clean"), matcher.find(F.col("_clean"))))
        counted = counted.select("_row", F.inline("scores")).withColumnRenamed("score", "weight")
        hits.append(materialize(counted, "counted-terms") if len(part) == COUNTED_TERMS else counted)
    if shape.n:
        found = _spans(clean, _first_words(spanned), shape.words)
        found = found.join(F.broadcast(spanned) if shape.n <= BROADCAST_TERMS else spanned, "term")
        found = found.select(*label, "weight", F.inline(F.arrays_zip(F.col("rows").alias("_row"), F.col("times").alias("times"))))
        hits.append(found.select("_row", *label, (F.col("weight") * F.col("times")).alias("weight")))
    scores = reduce(DataFrame.unionByName, hits).groupBy("_row", *label).agg(F.sum("weight").alias("score")).groupBy("_row")
    scores = scores.agg(F.collect_list(F.struct(*label, "score")).alias("scores"))
    return rows.join(scores, "_row", "left").drop("_row", "_clean").withColumn(
        "scores", F.coalesce("scores", F.array()).cast(_SCORE_TYPE)
    )


def best_label(scores: Column, axis: Axis) -> Column:
    """Highest score wins, ties by priority, the axis default when nothing scored."""
    ranked = F.transform(
        F.filter(scores, lambda s: s["family"] == axis.family),
        lambda s: F.struct(s["score"], (-s["priority"]).alias("p"), s["label"]),
    )
    return F.coalesce(F.array_max(ranked)["label"], F.lit(axis.default))


def top_labels(scores: Column, axis: Axis) -> Column:
    """Up to ``axis.labels_kept`` labels as an array.

    Labels need the minimum score and the minimum share of the best score.
    When none qualifies, the first best label in lexicon order stands alone.
    """
    own = F.filter(scores, lambda s: s["family"] == axis.family)
    best = F.array_max(F.transform(own, lambda s: s["score"]))
    kept = F.filter(
        own, lambda s: (s["score"] >= axis.min_score) & (s["score"] >= best * axis.min_ratio)
    )
    ordered = F.array_sort(
        F.transform(
            kept, lambda s: F.struct((-s["score"]).alias("s"), s["priority"], s["label"])
        )
    )
    fallback = F.array_max(
        F.transform(own, lambda s: F.struct(s["score"], (-s["label_pos"]).alias("p"), s["label"]))
    )["label"]
    return (
        F.when(F.size(own) == 0, F.array(F.lit(axis.default)))
        .when(F.size(kept) == 0, F.array(fallback))
        .otherwise(
            F.slice(F.transform(ordered, lambda s: s["label"]), 1, axis.labels_kept)
        )
    )


def decide(df: DataFrame, axes: tuple[Axis, ...] = AXES) -> DataFrame:
    """Replace ``scores`` by one label column per axis; multi-label as ``a;b``.

    The labels leave a row as one generated struct, so that a filter on them
    stays above the rule instead of repeating it.
    """
    scores = F.col("scores")
    labels = [
        (F.array_join(top_labels(scores, axis), ";") if axis.multi else best_label(scores, axis)).alias(axis.family)
        for axis in axes
    ]
    names = [axis.family for axis in axes]
    kept = [c for c in df.columns if c != "scores"]
    decided = df.select(*[c for c in kept if c not in names], F.inline(F.array(F.struct(*labels))))
    return decided.select(*kept, *[n for n in names if n not in kept])


def build_matcher(lexicon: DataFrame) -> TermMatcher:
    """A matcher of all terms of a lexicon, whatever their number."""
    return TermMatcher.from_rows(weigh_terms(lexicon).collect())


def score_corpus(df: DataFrame, lexicon: DataFrame, text_col: str = "text", inline_terms: int = INLINE_TERMS) -> DataFrame:
    """Add ``scores``, by the inline plan or, above ``inline_terms``, the joined one; both score alike."""
    require_columns(df, [text_col], "corpus")
    terms = materialize(weigh_terms(lexicon), "lexicon")
    rows = terms.limit(inline_terms + 1).collect()
    if len(rows) <= inline_terms:
        return score_inline(df, TermMatcher.from_rows(rows), text_col)
    return score_joined(df, terms, text_col)


def label_corpus(
    df: DataFrame,
    lexicon: DataFrame,
    text_col: str = "text",
    axes: tuple[Axis, ...] = AXES,
    inline_terms: int = INLINE_TERMS,
) -> DataFrame:
    """Fill the label columns of a corpus, adding them where absent; other columns stay."""
    return decide(score_corpus(df, lexicon, text_col, inline_terms), axes)


def score_rows(scored: DataFrame, id_col: str = "id") -> DataFrame:
    """The score map in long form: one row per message and label.

    The outer form keeps Catalyst from adding a filter on the size of
    ``scores``, which it would push down and compute a second time.
    """
    return (
        scored.select(id_col, F.inline_outer("scores"))
        .where(F.col("label").isNotNull())
        .select(id_col, "family", "label", "score")
    )


def label_distribution(labelled: DataFrame, axes: tuple[Axis, ...] = AXES) -> DataFrame:
    """Count and percentage of every value per axis.

    Multi-label values count as the joined string. Only the few distinct
    values reach the window.
    """
    stacked = labelled.select(
        F.explode(
            F.array(
                *[F.struct(F.lit(a.family).alias("axis"), F.col(a.family).alias("label")) for a in axes]
            )
        ).alias("_s")
    ).select("_s.*")
    return percentages(stacked.groupBy("axis", "label").agg(F.count("*").alias("count")), ["axis"])


def percentages(counts: DataFrame, per: list[str]) -> DataFrame:
    """Add ``total`` and ``percentage`` to a table of counts."""
    total = F.sum("count").over(Window.partitionBy(*per))
    return counts.withColumn("total", total).withColumn(
        "percentage", F.col("count") / F.col("total") * 100
    )
