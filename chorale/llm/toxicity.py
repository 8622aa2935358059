"""Toxic passages: maximum-scoring segments over token log-odds.

1. Document frequencies of words in toxic and clean training documents give log-odds under an informative
   Dirichlet prior (every word's prior mass is proportional to its frequency over both classes). A word counts as
   evidence only beyond ``Z`` posterior standard deviations, and by that lower bound, so that rare words stay silent.
2. Every other word costs a small constant. One linear scan finds all maximal scoring segments of a document,
   however long: the toxic passages.
3. Scores of segments are turned into extreme-value terms (Karlin and Altschul): ``lambda`` solves
   ``sum p * exp(lambda * s) = 1`` over clean words, a segment of score S in n words is worth ``lambda * S - ln n``,
   and the best r segments together ``sum - r ln n + ln r!``. A monotone fit on the training documents turns
   the document's best value into a probability.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chorale.llm.common import materialize, small_batches, unclashed

WORD = re.compile(r"[^\W\d_]+")
#: Labelled documents that the classifier is fitted on at most. This bounds the model as well: it holds no other words
#: than theirs, and of these only such as occur often enough to be evidence.
MAX_LABELLED = 200_000
PRIOR, Z, DRIFT, FLOOR = 0.1, 3.0, -0.05, -1.0
#: Log-odds that a word must exceed: a language or topic that is merely more often toxic stays silent.
MARGIN = 0.6
#: Width of the calibration's bins and the range they cover; values beyond fall into the outermost.
BIN, LOW, HIGH = 0.25, -12.0, 60.0
SEGMENTS = "array<struct<start:int,end:int,score:double,value:double>>"
RESULT = f"score double, words int, segments {SEGMENTS}"
THRESHOLD = 0.3


def words(text: str) -> list[str]:
    return WORD.findall(text.lower())


def maximal_segments(scores: list[tuple[int, float]], drift: float) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first, last position, score), by position.

    ``scores`` are the positions that do not score ``drift``, ascending. The
    rule is Ruzzo and Tompa's: disjoint candidates, each merged leftwards while
    that raises its score. A candidate remembers the nearest one before it with
    a lower sum in front, so looking back skips what cannot merge and the scan
    stays linear.
    """
    found: list[tuple[int, int, float, float, int]] = []  # first, last, sum before, sum through, candidate to look at next
    total, at = 0.0, 0
    for position, score in scores:
        before = total + drift * (position - at)
        total, at = before + score, position + 1
        if score <= 0:
            continue
        first, left, j = position, before, len(found) - 1
        while True:
            while j >= 0 and found[j][2] >= left:
                j = found[j][4]
            if j < 0 or found[j][3] >= total:
                break
            first, left, _, after = found[j][0], found[j][2], found[j][3], found[j][4]
            del found[j:]
            j = after
        found.append((first, position, left, total, j))
    return [(a, b, right - left) for a, b, left, right, _ in found]


@dataclass(frozen=True)
class ToxicityModel:
    """Word weights, the extreme-value rate, the cost of a silent word and the calibration table."""

    weights: dict[str, float]
    rate: float
    drift: float = DRIFT
    edges: tuple[float, ...] = ()
    levels: tuple[float, ...] = ()

    def examine(self, text: str | None) -> tuple[float, int, list[tuple[int, int, float, float]]]:
        """Best extreme-value term, words, passages (code points, score, term) of one text."""
        text = text or ""
        found = words(text)
        n = len(found)
        if not any(self.weights.get(w, 0) > 0 for w in set(found)):
            return -math.inf, n, []
        marks = [m.span() for m in WORD.finditer(text)]
        scored = [(i, s) for i, (a, b) in enumerate(marks) if (s := self.weights.get(text[a:b].lower())) is not None]
        length = math.log(max(n, 1))
        segments = [(a, b, s, self.rate * s - length) for a, b, s in maximal_segments(scored, self.drift)]
        best, total = -math.inf, 0.0
        for r, (*_, value) in enumerate(sorted(segments, key=lambda x: -x[3]), 1):
            total += value
            best = max(best, total + math.lgamma(r + 1))
            if value < -length:
                break
        return best, n, [(marks[a][0], marks[b][1], s, v) for a, b, s, v in segments]

    def probability(self, value: float) -> float:
        """The calibrated score; a hundredth of it orders values inside one level."""
        inner = 0.0 if value == -math.inf else 1 / (1 + math.exp(-max(-30.0, min(30.0, value / 4))))
        level = self.levels[bisect_right(self.edges, value) - 1] if self.levels else 0.0
        return 0.99 * level + 0.01 * inner


def _bin(value: float) -> int:
    return -1 if value == -math.inf else int((min(max(value, LOW), HIGH) - LOW) / BIN)


def _isotonic(table: list[tuple[int, int, int]]) -> tuple[tuple[float, ...], tuple[float, ...]]:
    """Monotone positive rates by bin (bin, positives, rows): pooled adjacent violators, half a row of prior."""
    blocks: list[list[float]] = []
    for b, positives, rows in sorted(table):
        blocks.append([b, positives, rows])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            last = blocks.pop()
            blocks[-1][1] += last[1]
            blocks[-1][2] += last[2]
    edges = tuple(-math.inf if b < 0 else LOW + BIN * b for b, *_ in blocks)
    return (-math.inf, *edges[1:]), tuple((p + 0.05) / (n + 0.5) for _, p, n in blocks)


def fit_toxicity(documents: DataFrame, labels: DataFrame, *, text: str = "text") -> ToxicityModel:
    """Fit on the documents that have a row in ``labels`` (``doc_id``, ``toxic``).

    At most ``MAX_LABELLED`` labelled ids are used, those of the lowest hash; an
    id labelled twice counts as toxic if one label does. Null ids and labels are
    left out. Without both classes the model has no words and scores all alike.
    """
    small_batches(documents.sparkSession)
    known = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(MAX_LABELLED)
    train = documents.select("doc_id", F.col(text).alias("text")).join(F.broadcast(known), "doc_id")
    train = train.select("text", F.col("toxic").cast("int").alias("toxic"))

    def count(batches):
        for pdf in batches:
            toxic: dict[str, int] = {}
            clean: dict[str, int] = {}
            for text_, mark in zip(pdf["text"], pdf["toxic"], strict=True):
                into = toxic if mark else clean
                for w in set(words(text_ or "")):
                    into[w] = into.get(w, 0) + 1
            rows = [(w, toxic.get(w, 0), clean.get(w, 0)) for w in toxic.keys() | clean.keys()]
            yield pd.DataFrame(rows, columns=["word", "toxic", "clean"])

    counts = train.mapInPandas(count, "word string, toxic long, clean long")
    counts = counts.groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    counts = materialize(counts, "word-counts")
    n_toxic, n_clean = counts.agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in ("toxic", "clean")]).first()
    if not n_toxic or not n_clean:
        return ToxicityModel({}, 1.0)
    # shares of a class's words, not of its documents: long documents hold more words of every kind
    prior = PRIOR * (F.col("toxic") + F.col("clean"))
    mass = 1 + PRIOR
    odds = F.log((F.col("toxic") + prior) / (n_toxic * mass)) - F.log((F.col("clean") + prior) / (n_clean * mass))
    sd = F.sqrt(1 / (F.col("toxic") + prior) + 1 / (F.col("clean") + prior))
    bound = F.when(odds > 0, F.greatest(odds - Z * sd - MARGIN, F.lit(0))).otherwise(F.least(odds + Z * sd + MARGIN, F.lit(0)))
    heavy = counts.select("word", bound.alias("w"), ((F.col("clean") + prior) / (n_clean * mass)).alias("p"))
    heavy = heavy.where("w != 0").orderBy("word").collect()
    weights = {r["word"]: max(FLOOR, r["w"]) for r in heavy}
    gain = sum(r["p"] * max(0.0, weights[r["word"]]) for r in heavy)
    drift = min(DRIFT, -2 * gain)  # clean text must lose on average, or segments would never end
    silent = 1 - sum(r["p"] for r in heavy)
    low, high = 1e-6, 20.0
    for _ in range(80):
        rate = (low + high) / 2
        moved = sum(r["p"] * math.exp(min(700.0, rate * weights[r["word"]])) for r in heavy)
        low, high = (rate, high) if moved + silent * math.exp(rate * drift) < 1 else (low, rate)
    model = ToxicityModel(weights, rate, drift)

    def place(batches):
        for pdf in batches:
            rows = [(_bin(model.examine(t)[0]), int(m)) for t, m in zip(pdf["text"], pdf["toxic"], strict=True)]
            yield pd.DataFrame(rows, columns=["bin", "toxic"])

    bins = train.mapInPandas(place, "bin int, toxic int").groupBy("bin").agg(F.sum("toxic"), F.count("*")).collect()
    return ToxicityModel(weights, rate, drift, *_isotonic([tuple(r) for r in bins]))


def toxicity(text: Column, model: ToxicityModel) -> Column:
    """A struct of ``score`` (0 to 1), ``words`` and ``segments`` for a text; null counts as empty."""

    @F.pandas_udf(RESULT)
    def examine(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for t in texts:
            value, n, segments = model.examine(t)
            rows.append((model.probability(value), n, [{"start": a, "end": b, "score": s, "value": v} for a, b, s, v in segments]))
        return pd.DataFrame(rows, columns=["score", "words", "segments"])

    return examine(text)


def score_toxicity(documents: DataFrame, model: ToxicityModel, *, text: str = "text") -> DataFrame:
    """``documents`` with ``toxicity`` added (a column of that name is replaced)."""
    small_batches(documents.sparkSession)
    return unclashed(documents, ["toxicity"]).withColumn("toxicity", toxicity(F.col(text), model))


def held_out(doc_id: Column) -> Column:
    """True for ids whose crc32 leaves 2 when divided by 4; a null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))
