"""Piece ids against the public library, whole texts against chunked ones, exact round trips."""

import random
import struct

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece

from chorale.llm import sentencepiece as module
from chorale.llm.sentencepiece import MODEL, Vocabulary, compose, decode, encode, normalize

TEXTS = [
    None,
    "",
    " ",
    "a",
    "Hello  world, grüße   an alle 😀😀 ",
    "   leading\n\tand\x00 odd 𝔘𝔫𝔦𝔠𝔬𝔡𝔢 characters",
    "x" * 300,
    "aaaa bbbb " * 60,
    " " * 130,
    "<s> <unk> </s> <0x41>",
]


@pytest.fixture(scope="module")
def vocabulary():
    return Vocabulary.load()


def unigram_model(vocabulary) -> bytes:
    """The public model with this package's scores, marked as a unigram model (protocol buffer fields 1, 2.3)."""

    def varint(n):
        out = bytearray()
        while n > 127:
            out.append(n & 127 | 128)
            n >>= 7
        return bytes([*out, n])

    def fields(data):
        at = 0
        while at < len(data):
            tag = shift = 0
            while True:
                tag |= (data[at] & 127) << shift
                shift, at = shift + 7, at + 1
                if data[at - 1] < 128:
                    break
            start = at
            if tag & 7 == 0:
                while data[at] > 127:
                    at += 1
                at += 1
                yield tag, data[start:at]
            elif tag & 7 == 5:
                at += 4
                yield tag, data[start:at]
            else:
                size = shift = 0
                while True:
                    size |= (data[at] & 127) << shift
                    shift, at = shift + 7, at + 1
                    if data[at - 1] < 128:
                        break
                at += size
                yield tag, data[at - size : at]

    def joined(parts):
        return b"".join(varint(t) + (varint(len(v)) if t & 7 == 2 else b"") + v for t, v in parts)

    out = []
    for tag, value in fields(open(MODEL, "rb").read()):
        own = list(fields(value)) if tag in (10, 18) else []
        if tag == 10:
            piece = next(v for t, v in own if t == 10).decode()
            score = struct.pack("<f", float(vocabulary.scores.get(piece, 0)))
            value = joined([(t, score if t == 21 else v) for t, v in own])
        elif tag == 18:
            value = joined([(t, v) for t, v in own if t != 24] + [(24, b"\x01")])
        out.append((tag, value))
    return joined(out)


def test_ids_equal_the_library(vocabulary):
    library = sentencepiece.SentencePieceProcessor(model_proto=unigram_model(vocabulary))
    rng = random.Random(3)
    texts = [t for t in TEXTS if t]
    texts += ["".join(rng.choice("abthe in\n é1.ß😀") for _ in range(rng.randint(1, 80))) for _ in range(300)]
    for text in texts:
        assert library.normalize(text) == normalize(text)
        assert vocabulary.encode(text) == library.encode(text), text


def test_best_score_by_brute_force(vocabulary):
    def best(text):
        if not text:
            return 0
        tries = []
        for n in range(1, len(text) + 1):
            score = vocabulary.scores.get(text[:n], vocabulary.unknown if n == 1 else None)
            if score is not None:
                tries.append(score + best(text[n:]))
        return max(tries)

    for text in ("hello", "the in", "𝔘ab", "   a"):
        whole = normalize(text)
        assert vocabulary.paths(whole, [0], len(whole))[0][len(whole)] == best(whole)


def test_scan_is_associative(vocabulary):
    rng = np.random.default_rng(1)
    stack = rng.integers(-50, 0, (7, 3, 3))
    out, product = compose(stack), stack[0]
    for k in range(1, 7):
        product = (product[:, :, None] + stack[k][None]).max(axis=1)
        assert (out[k] == product).all()


def test_memory_keeps_what_is_asked_again(vocabulary, monkeypatch):
    monkeypatch.setattr(module, "REMEMBERED", 40)
    fresh, rng = Vocabulary.load(), random.Random(9)
    for _ in range(30):
        texts = ["common " * 3 + "".join(rng.choice("abthe 😀") for _ in range(rng.randint(0, 60))) for _ in range(3)]
        flat, sizes = fresh.encode_all([*texts, None, ""])
        assert [flat[e - n : e].tolist() for n, e in zip(sizes, np.cumsum(sizes), strict=True)] == [vocabulary.encode(t) for t in [*texts, "", ""]]
        assert f"{module.MARK}common" in fresh.memory.place
    assert len(fresh.memory.place) < 300  # never more than the bound and one batch


def test_lists_decode_together(vocabulary):
    texts = ["plain text", "", "  two", "é😀 of bytes", "\n first", " "]
    lists = pa.array([[1], None, *map(vocabulary.encode, texts)], pa.list_(pa.int32()))
    for part in (lists, lists[2:], lists[:2], lists[:0]):
        assert vocabulary.decode_all(part).to_pylist() == [vocabulary.decode(x or ()) for x in part.to_pylist()]
    assert vocabulary.decode_all(lists[2:]).to_pylist() == texts


def test_chunks_equal_the_whole_and_round_trip(spark, vocabulary):
    rng = random.Random(5)
    texts = TEXTS + ["".join(rng.choice("abthe  in😀é") for _ in range(rng.randint(20, 400))) for _ in range(25)]
    rows = [(i, t, "x") for i, t in enumerate(texts)] + [(None, "twice " * 20, None)] * 2
    frame = spark.createDataFrame(rows, "doc_id long, text string, ids string")  # a clashing column
    for chunk in (17, 23):
        for row in decode(encode(frame, vocabulary, chunk=chunk), vocabulary).collect():
            assert row.ids == vocabulary.encode(row.text)
            assert row.decoded == (row.text or "")
    assert decode(encode(frame, vocabulary, chunk=17), vocabulary).count() == len(rows)
    assert encode(frame.limit(0), vocabulary).collect() == []


def test_without_cuts_the_matrices_do_all_the_work(spark, vocabulary):
    uncut = Vocabulary.load()
    uncut.cuts = False
    texts = ["".join(random.Random(i).choice("abthe in") for _ in range(150)) for i in range(5)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for row in encode(frame, uncut, chunk=20).collect():
        assert row.ids == vocabulary.encode(row.text)
