"""SentencePiece encoding and decoding of texts of any length by a max-plus parallel scan.

The best segmentation of a text maximises a sum of piece scores: a shortest path, so a product of matrices over
(max, +). A text longer than ``CHUNK`` characters is cut into chunks that any task may take. A path crosses a chunk's
border inside some piece; how far that piece reaches into the next chunk is the border's state.

1. Each chunk yields its transfer matrix: the best score from every entry state to every exit state.
2. The matrices of a text are combined by an associative scan, which gives the exact best score of reaching each
   chunk in each state.
3. With these scores each chunk says which entry state its best path to each exit state comes from; following these
   maps from the end fixes one exit state per chunk.
4. Each chunk is traced back on its own from its exit state, and the pieces are strung together.

Where the vocabulary allows no piece across two characters, every path must pass between them. In vocabularies that
mark word starts this holds in front of each mark, so stretches between such cuts are solved once and remembered.

Scores are whole numbers, so results do not depend on chunking. Of equal paths the one whose last piece is longest is
taken, then the one before it, and so on, as the reference implementation of unigram models does. Characters outside
the vocabulary become bytes.

The public vocabulary at hand was made for byte-pair merging and scores pieces by rank alone. It is read here as a
unigram model under Zipf's law: a piece of rank r scores ``-round(1000 * ln(r + 2))``.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chorale.llm.common import materialize, small_batches, unclashed

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
#: Characters of a chunk; longer texts are split. Stretches that a worker remembers.
CHUNK, REMEMBERED = 16_384, 150_000
MARK = "▁"
SCALE, PENALTY = 1000, 10
NEVER = -(1 << 60)
#: Longest stretch that is solved together with others and remembered, and how many are solved together.
WIDE, TOGETHER = 48, 20_000
STRETCHES = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")


class Memory:
    """Ids of the stretches a worker has solved, one run of a flat array each.

    When there is no room left, those asked for again since the last clearing stay, if they fill at most half of it.
    """

    def __init__(self) -> None:
        self.place: dict[str, int] = {}
        self.flat, self.sizes, self.begins = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.again = np.zeros(0, bool)

    def spell(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids at these places in a row, and how many each has."""
        sizes = self.sizes[places]
        shift = self.begins[places] - (np.cumsum(sizes) - sizes)
        return self.flat[np.repeat(shift, sizes) + np.arange(int(sizes.sum()))], sizes

    def make_room(self, asked: set[str], new: int) -> None:
        """See to it that ``new`` more fit; what is asked for now stays."""
        if len(self.place) + new <= REMEMBERED:
            return
        names = list(self.place)
        stay = self.again if int(self.again.sum()) <= REMEMBERED // 2 else np.zeros(len(names), bool)
        stay = np.flatnonzero(stay | np.fromiter((s in asked for s in names), bool, len(names)))
        flat, sizes = self.spell(stay)
        self.place, self.flat, self.sizes = {}, flat[:0], sizes[:0]
        self.add([names[i] for i in stay.tolist()], flat, sizes)

    def add(self, stretches: list[str], flat: np.ndarray, sizes: np.ndarray) -> None:
        before = len(self.place)
        self.place.update(zip(stretches, range(before, before + len(stretches)), strict=True))
        self.flat = np.concatenate([self.flat, flat.astype(np.int32)])
        self.sizes = np.concatenate([self.sizes, sizes])
        self.begins = np.cumsum(self.sizes) - self.sizes
        self.again = np.concatenate([self.again[:before], np.zeros(len(stretches), bool)])


@dataclass
class Vocabulary:
    """Pieces of a model with whole-number scores."""

    pieces: list[str]
    scores: dict[str, int]
    ids: dict[str, int]
    byte_ids: list[int]
    reach: int = 1
    cuts: bool = False
    unknown: int = 0
    #: Every start of a piece, with the piece's score or, of a mere start, None.
    starts: dict[str, int | None] = field(default_factory=dict)
    memory: Memory = field(default_factory=lambda: Memory())
    texts: list[str] = field(default_factory=list)

    def __post_init__(self) -> None:
        for piece, score in self.scores.items():
            for n in range(1, len(piece)):
                self.starts.setdefault(piece[:n], None)
            self.starts[piece] = score
        first = self.byte_ids[0]
        self.texts = [p.replace(MARK, " ") for p in self.pieces]
        self.texts[first : first + 128] = map(chr, range(128))

    @classmethod
    def load(cls, path: str = MODEL) -> Vocabulary:
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [model.id_to_piece(i) for i in range(model.vocab_size())]
        plain = [i for i in range(len(pieces)) if not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i) or model.is_byte(i))]
        scores = {pieces[i]: -round(SCALE * math.log(rank + 2)) for rank, i in enumerate(plain)}
        return cls(
            pieces,
            scores,
            {pieces[i]: i for i in plain},
            [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)],
            max(map(len, scores)),
            not any(b == MARK != a for p in scores for a, b in zip(p, p[1:], strict=False)),
            min(scores.values()) - PENALTY,
        )

    def __getstate__(self) -> dict:
        return self.__dict__ | {"memory": Memory()}

    def paths(self, text: str, entry: list[int], stop: int) -> tuple[list[int], list[int]]:
        """Best score and last start of every position, from ``entry`` scores, by pieces that start before ``stop``."""
        best = (entry + [NEVER] * (stop + self.reach))[: stop + self.reach + 1]
        came = [-1] * len(best)
        starts, n = self.starts, len(text)
        for p in range(min(stop, n)):
            here = best[p]
            if here <= NEVER // 2:
                continue
            q = p + 1
            score = starts.get(text[p:q], NEVER)
            if score is None or score == NEVER:  # no piece of this one character: it becomes bytes
                if here + self.unknown > best[q]:
                    best[q], came[q] = here + self.unknown, p
                if score is not None:
                    continue
            while score != NEVER:
                if score is not None and here + score > best[q]:
                    best[q], came[q] = here + score, p
                q += 1
                if q > n:
                    break
                score = starts.get(text[p:q], NEVER)
        return best, came

    def trace(self, text: str, came: list[int], at: int) -> tuple[list[int], int]:
        """Ids of the path that ends at ``at``, and where it starts."""
        out: list[list[int]] = []
        while came[at] >= 0:
            piece = text[came[at] : at]
            own = self.ids.get(piece)
            out.append([own] if own is not None else [self.byte_ids[b] for b in piece.encode("utf-8", "replace")])
            at = came[at]
        return [i for part in reversed(out) for i in part], at

    def solve(self, stretches: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Distinct stretches in the order solved, their ids in a row, and how many each has.

        All but very long ones advance together, one character at a time.
        """
        lengths = np.fromiter(map(len, stretches), np.int64, len(stretches))
        order = [stretches[i] for i in np.argsort(-lengths, kind="stable").tolist()]
        alone = [s for s in order if len(s) > WIDE or "\0" in s]
        rest = [s for s in order if len(s) <= WIDE and "\0" not in s]
        names, flats, counts = [], [], []
        for at in range(0, len(rest), TOGETHER):
            part = rest[at : at + TOGETHER]
            flat, sizes, odd = self._solve_together(part)
            alone += [part[i] for i in np.flatnonzero(odd).tolist()]
            names += [part[i] for i in np.flatnonzero(~odd).tolist()] if odd.any() else part
            flats.append(flat)
            counts.append(sizes[~odd])
        for s in alone:
            own = self.trace(s, self.paths(s, [0], len(s))[1], len(s))[0]
            names.append(s)
            flats.append(np.array(own, np.int64))
            counts.append(np.array([len(own)], np.int64))
        return names, np.concatenate(flats), np.concatenate(counts)

    def _solve_together(self, stretches: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids in a row, their number, and which stretches are left out: those with a character that becomes several bytes.

        ``stretches``: longest first, so that those still going on at a position stand in front. Arrays run along the
        stretches, one for each position. A stretch ends in zeros, which no piece holds.
        """
        n, wide = len(stretches), len(stretches[0])
        chars = np.ascontiguousarray(np.array(stretches, f"<U{wide}").view(np.uint32).reshape(n, wide).T).astype(np.int64)
        best = np.full((wide + 1, n), NEVER, np.int64)
        best[0] = 0
        came = np.zeros((wide + 1, n), np.int64)
        piece = np.zeros((wide + 1, n), np.int64)
        keys, scores, ids, grows, roots = self.trie
        for p in range(wide):
            code = chars[p][: int(np.count_nonzero(chars[p]))]
            m, here = len(code), best[p]
            at = roots[np.minimum(code, len(roots) - 1)]
            score, own = scores[at], ids[at]
            lone = score == NEVER  # no piece of this one character: it becomes bytes
            score[lone], own[lone] = self.unknown, np.where(code[lone] < 128, self.byte_ids[0] + code[lone], -1)
            total = here[:m] + score
            better = total > best[p + 1, :m]
            for table, value in ((best, total), (came, p), (piece, own)):
                np.copyto(table[p + 1, :m], value, where=better)
            rows = np.flatnonzero(grows[at])
            at = at[rows]
            for q in range(p + 2, min(p + self.reach, wide) + 1):
                if not len(rows):
                    break
                wanted = ((at + 1) << 21) | chars[q - 1][rows]
                at = np.searchsorted(keys, wanted)
                on = np.flatnonzero(keys[at] == wanted)
                rows, at = rows[on], at[on]
                score = scores[at]
                total = here[rows] + score
                better = np.flatnonzero((score > NEVER) & (total > best[q][rows]))
                to = rows[better]
                best[q, to], came[q, to], piece[q, to] = total[better], p, ids[at[better]]
                on = grows[at]
                rows, at = rows[on], at[on]
        at = np.count_nonzero(chars, axis=0)
        rows, steps = np.arange(n), []
        sizes, odd = np.zeros(n, np.int64), np.zeros(n, bool)
        while len(rows):
            own = piece[at, rows]
            sizes[rows] += 1
            odd[rows[own < 0]] = True
            steps.append((rows, own))
            at = came[at, rows]
            on = at > 0
            rows, at = rows[on], at[on]
        sizes[odd] = 0
        ends = np.cumsum(sizes)
        flat = np.empty(int(ends[-1]), np.int64)
        for k, (rows, own) in enumerate(steps):
            on = ~odd[rows]
            flat[ends[rows[on]] - 1 - k] = own[on]
        return flat, sizes, odd

    @cached_property
    def trie(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Sorted keys (node, character), score and id of the piece that ends there, and whether a piece goes on there.

        A node is its key's place + 1. The last array gives each character's place below the root. The place behind
        all keys stands for no piece.
        """
        level, found = {"": 0}, []
        by_length: dict[int, list[str]] = {}
        for start in self.starts:
            by_length.setdefault(len(start), []).append(start)
        # nodes get numbers that grow with depth, so keys of one depth follow those of the one before
        place = 0
        for n in sorted(by_length):
            own = sorted((level[s[:-1]] << 21 | ord(s[-1]), s) for s in by_length[n])
            level = {}
            for key, s in own:
                found.append((key, self.starts[s], self.ids.get(s, -1)))
                place += 1
                level[s] = place
        none = len(found)
        found.append((np.iinfo(np.int64).max, None, -1))
        keys = np.array([k for k, *_ in found], np.int64)
        grows = np.zeros(len(keys), bool)
        above = keys[:none] >> 21
        grows[above[above > 0] - 1] = True
        first = keys[:none][above == 0]
        roots = np.full(int(first.max(initial=0)) + 2, none, np.int64)
        roots[first] = np.arange(len(first))
        scores = np.array([NEVER if s is None else s for _, s, _ in found], np.int64)
        return keys, scores, np.array([i for *_, i in found], np.int64), grows, roots

    @cached_property
    def worth(self) -> np.ndarray:
        """Score of each id; of a character's bytes the first one has it."""
        out = np.zeros(len(self.pieces), np.int64)
        for piece, i in self.ids.items():
            out[i] = self.scores[piece]
        for b, i in enumerate(self.byte_ids):
            out[i] = 0 if 128 <= b < 192 else self.unknown
        return out

    def spelled(self, stretches: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of these stretches in a row, and how many each has. What is solved is remembered."""
        asked, memory = set(stretches), self.memory
        new = asked.difference(memory.place)
        if new:
            memory.make_room(asked, len(new))
            memory.add(*self.solve(list(new)))
        places = np.fromiter(map(memory.place.__getitem__, stretches), np.int64, len(stretches))
        memory.again[places[places < len(memory.place) - len(new)]] = True
        return memory.spell(places)

    def encode(self, text: str | None) -> list[int]:
        """Ids of a whole text in one piece."""
        return self.encode_all([text])[0].tolist()

    def encode_all(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of whole texts in a row, and how many each has."""
        cut = [(STRETCHES.findall(normalize(t)) if self.cuts else [normalize(t)]) if t else [] for t in texts]
        flat, sizes = self.spelled(list(chain.from_iterable(cut)))
        ends = np.cumsum([0, *map(len, cut)])
        sums = np.concatenate([[0], np.cumsum(sizes)])[ends]
        return flat, np.diff(sums)

    def decode_all(self, lists: pa.ListArray) -> pa.Array:
        """The texts of lists of ids; null and empty lists give the empty text."""
        flat = lists.flatten()
        sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy()
        offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
        joined = pc.binary_join(pa.ListArray.from_arrays(offsets, self.spellings.take(flat)), "")
        joined = pc.replace_substring_regex(joined, r"\A ", "", max_replacements=1)
        ids, first = flat.to_numpy(), self.byte_ids[0]
        odd = np.flatnonzero((ids >= first + 128) & (ids < first + 256))
        if not len(odd):
            return joined
        rows = np.unique(np.searchsorted(offsets, odd, "right") - 1)
        out = joined.to_pylist()
        for i in rows.tolist():
            out[i] = self.decode(ids[offsets[i] : offsets[i + 1]])
        return pa.array(out, pa.string())

    @cached_property
    def spellings(self) -> pa.Array:
        return pa.array(self.texts, pa.string())

    def decode(self, ids) -> str:
        """The text of ids; bytes that form no character become the replacement character."""
        texts, first = self.texts, self.byte_ids[0]
        ids = np.asarray(ids, np.int64)
        if not ((ids >= first + 128) & (ids < first + 256)).any():  # all bytes are characters of their own
            return "".join([texts[i] for i in ids.tolist()]).removeprefix(" ")
        out, pending = [], bytearray()
        for i in ids.tolist():
            if first <= i < first + 256:
                pending.append(i - first)
                continue
            if pending:
                out.append(pending.decode("utf-8", "replace"))
                pending.clear()
            out.append(texts[i])
        out.append(pending.decode("utf-8", "replace"))
        return "".join(out).removeprefix(" ")

    def _ends(self, chunk: str, size: int) -> tuple[int, int]:
        """First and last cut of a chunk of ``size`` characters (the rest of ``chunk`` is looked ahead); -1 without one."""
        if not self.cuts:
            return -1, -1
        found = re.search(f"[^{MARK}]{MARK}", chunk[: size + 1])
        if not found:
            return -1, -1
        first, last = found.start() + 1, size
        while last > first and not (chunk[last : last + 1] == MARK != chunk[last - 1]):
            last -= 1
        return first, last

    def inner(self, chunk: str, size: int) -> list[str]:
        """The stretches between the first and the last cut of a chunk."""
        first, last = self._ends(chunk, size)
        return STRETCHES.findall(chunk[first:last]) if first >= 0 else []

    def transfer(self, chunk: str, size: int) -> tuple[np.ndarray, str, str, np.ndarray]:
        """The chunk's matrix: best score from each entry state (row) to each exit state (column).

        Also what the states leave open: the text before the first cut, the
        text from the last cut on, and the ids in between, which all paths
        share. Without a cut the first text is the whole chunk.
        """
        out = np.full((self.reach, self.reach), NEVER, np.int64)
        first, last = self._ends(chunk, size)
        if first < 0:
            for i in range(self.reach):
                best, _ = self.paths(chunk, [NEVER] * i + [0], size)
                out[i] = best[size : size + self.reach] if i < size else out[i]
                if i >= size:
                    out[i, i - size] = 0
            return out, chunk, "", np.zeros(0, np.int32)
        parts = self.inner(chunk, size)
        ids, _ = self.spelled(parts)
        middle = int(self.worth[ids].sum())
        tail = np.array(self.paths(chunk[last:], [0], size - last)[0][size - last : size - last + self.reach])
        for i in range(min(first, self.reach - 1) + 1):
            head = self.paths(chunk[:first], [NEVER] * i + [0], first)[0][first]
            if head > NEVER // 2:
                out[i] = np.where(tail > NEVER // 2, tail + head + middle, NEVER)
        return out, chunk[:first], chunk[last:], ids

    def entries(self, head: str, closed: bool, size: int, reached: list[int]) -> list[int]:
        """For each exit state, the entry state that its best path comes from, given the score of each entry state.

        ``closed``: the head ends at a cut, so all exit states share its path.
        """
        stop = len(head) if closed else size
        _, came = self.paths(head, reached[: stop + 1] if closed else reached, stop)
        if closed:
            return [self.trace(head, came, stop)[1]] * self.reach
        return [self.trace(head, came, size + j)[1] for j in range(self.reach)]

    def spell(self, head: str, tail: str, closed: bool, size: int, reached: list[int], ahead: int, leave: int) -> tuple[list[int], list[int]]:
        """Ids of the pieces that start in the chunk on the best path to exit state ``leave``, up to its first cut and from its last.

        ``ahead``: characters of the tail that belong to the next chunk.
        """
        stop = len(head) if closed else size
        _, came = self.paths(head, reached[: stop + 1] if closed else reached, stop)
        if not closed:
            return self.trace(head, came, size + leave)[0], []
        before = self.trace(head, came, stop)[0]
        own = len(tail) - ahead
        _, came = self.paths(tail, [0], own)
        return before, self.trace(tail, came, own + leave)[0]


def normalize(text: str) -> str:
    """A mark in front and for every space, nothing else: the model's own rule."""
    return MARK + text.replace(" ", MARK)


def compose(matrices: np.ndarray) -> np.ndarray:
    """Inclusive products over (max, +) of a stack of matrices by an associative scan in doubling steps."""
    out, step = matrices.copy(), 1
    while step < len(out):
        for at in range(len(out) - 1, step - 1, -1):
            product = (out[at - step][:, :, None] + out[at][None, :, :]).max(axis=1)
            out[at] = np.maximum(product, NEVER)
        step *= 2
    return out


def _encode_long(texts: DataFrame, vocabulary: Vocabulary, length: int) -> DataFrame:
    """``text_hash``, ``n``, ``ids`` of distinct texts longer than a chunk."""
    reach = vocabulary.reach

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for text_hash, n, text in zip(pdf["text_hash"], pdf["n"], pdf["text"], strict=True):
                text = normalize(text)
                for k, at in enumerate(range(0, len(text), length)):
                    size = min(length, len(text) - at)
                    yield pd.DataFrame({"text_hash": [text_hash], "n": [n], "k": [k], "size": [size], "chunk": [text[at : at + size + reach]]})

    key = "text_hash long, n long"
    chunks = texts.mapInPandas(cut, f"{key}, k int, size int, chunk string").repartition("text_hash", "n", "k")

    def transfer(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            vocabulary.spelled([s for c, size in zip(pdf["chunk"], pdf["size"], strict=True) for s in vocabulary.inner(c, size)])
            for chunk, size in zip(pdf["chunk"], pdf["size"], strict=True):
                matrix, head, tail, middle = vocabulary.transfer(chunk, size)
                rows.append((matrix.ravel(), head, tail, middle, tail != "" or len(head) < len(chunk), len(chunk) - size))
            own = pd.DataFrame(rows, columns=["matrix", "head", "tail", "middle", "closed", "ahead"], index=pdf.index)
            yield pd.concat([pdf[["text_hash", "n", "k", "size"]], own], axis=1)

    solved = chunks.mapInPandas(
        transfer, f"{key}, k int, size int, matrix array<long>, head string, tail string, middle array<int>, closed boolean, ahead int"
    )
    solved = materialize(solved, "chunks")

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for text_hash, n, parts in zip(pdf["text_hash"], pdf["n"], pdf["parts"], strict=True):
                products = compose(np.stack([p["matrix"] for p in parts]).reshape(-1, reach, reach))
                start = np.full(reach, NEVER, np.int64)
                start[0] = 0
                reached = [start, *products[:-1, 0, :]]
                yield pd.DataFrame({"text_hash": text_hash, "n": n, "k": [p["k"] for p in parts], "reached": reached})

    def parts(rows: DataFrame, value: str) -> DataFrame:
        return rows.groupBy("text_hash", "n").agg(F.sort_array(F.collect_list(F.struct("k", value))).alias("parts"))

    reached = parts(solved, "matrix").mapInPandas(scan, f"{key}, k int, reached array<long>")
    reached = materialize(reached, "reached")
    ends = solved.drop("matrix", "middle").join(reached, ["text_hash", "n", "k"])

    def come(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            own = zip(pdf["head"], pdf["closed"], pdf["size"], pdf["reached"], strict=True)
            yield pdf[["text_hash", "n", "k"]].assign(entry=[vocabulary.entries(h, c, s, r.tolist()) for h, c, s, r in own])

    def follow(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for text_hash, n, own in zip(pdf["text_hash"], pdf["n"], pdf["parts"], strict=True):
                leaves, leave = [], 0
                for p in reversed(own):
                    leaves.append(leave)
                    leave = int(p["entry"][leave])
                yield pd.DataFrame({"text_hash": text_hash, "n": n, "k": [p["k"] for p in own], "leave": leaves[::-1]})

    came = ends.drop("tail").mapInPandas(come, f"{key}, k int, entry array<int>")
    leaves = materialize(parts(came, "entry").mapInPandas(follow, f"{key}, k int, leave int"), "leaves")

    def spell(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [
                vocabulary.spell(r.head, r.tail, r.closed, r.size, r.reached.tolist(), r.ahead, r.leave) for r in pdf.itertuples(index=False)
            ]
            yield pdf[["text_hash", "n", "k"]].assign(before=[b for b, _ in rows], after=[a for _, a in rows])

    edges = ends.join(leaves, ["text_hash", "n", "k"]).mapInPandas(spell, f"{key}, k int, before array<int>, after array<int>")
    # what lies between a chunk's cuts is the bulk: it moves once, to its text
    at = lambda place, ids: F.struct((F.col("k") * 3 + place).alias("k"), F.col(ids).alias("ids"))
    spelled = edges.select("text_hash", "n", F.inline(F.array(at(0, "before"), at(2, "after"))))
    spelled = spelled.unionByName(solved.select("text_hash", "n", at(1, "middle").alias("p")).select("text_hash", "n", "p.*"))
    whole = parts(spelled, "ids")
    return materialize(whole.select("text_hash", "n", F.flatten("parts.ids").alias("ids")), "long-ids")


def encode(documents: DataFrame, vocabulary: Vocabulary | None = None, *, text: str = "text", out: str = "ids", chunk: int | None = None) -> DataFrame:
    """``documents`` with the ids of each text added (a column of that name is replaced).

    Null and empty texts have no ids. Equal long texts are encoded once.
    """
    vocabulary = vocabulary or Vocabulary.load()
    small_batches(documents.sparkSession, 250)
    chunk = chunk or CHUNK
    source = unclashed(documents, [out])
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields]
    place = source.columns.index(text)

    def short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat, sizes = vocabulary.encode_all(batch.column(place).to_pylist())
            offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.ListArray.from_arrays(offsets, flat)], [*batch.schema.names, out])

    length = F.coalesce(F.length(text), F.lit(0))
    encoded = source.where(length < chunk).mapInArrow(short, ", ".join([*fields, f"`{out}` array<int>"]))
    keyed = source.where(length >= chunk).withColumns({"__text_hash": F.xxhash64(text), "__n_chars": F.length(text).cast("long")})
    texts = keyed.groupBy(F.col("__text_hash").alias("text_hash"), F.col("__n_chars").alias("n")).agg(F.first(text).alias("text"))
    long = _encode_long(texts, vocabulary, chunk).select(F.col("text_hash").alias("__text_hash"), F.col("n").alias("__n_chars"), F.col("ids").alias(out))
    return encoded.unionByName(keyed.join(long, ["__text_hash", "__n_chars"]).drop("__text_hash", "__n_chars"))


def decode(encoded: DataFrame, vocabulary: Vocabulary | None = None, *, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``encoded`` with the text of each list of ids added; null ids give the empty text."""
    vocabulary = vocabulary or Vocabulary.load()
    small_batches(encoded.sparkSession, 250)

    @F.arrow_udf("string")
    def spell(column: pa.Array) -> pa.Array:
        return vocabulary.decode_all(column)

    return unclashed(encoded, [out]).withColumn(out, spell(F.col(f"`{ids}`")))
