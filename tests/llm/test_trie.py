"""The prefix trie against a plain recursive version, on conversations with odd rows."""

import hashlib
import math
import random
import zlib

import pytest

from chorale.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string, path string, depth long, n_convs long"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "clash", 7, 7) for r in rows], SCHEMA)


def ordered(rows):
    """Turns (role, text) of each conversation, as the docstring of ``paths`` orders them."""
    found = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            found.setdefault(conv, []).append((turn is not None, turn or 0, role, digest, text))
    return {c: [(t[2], t[4]) for t in sorted(turns)] for c, turns in found.items()}


def rebuilt(told):
    out = {}
    for c, turns in told.items():
        h = zlib.crc32(str(c).encode()) % 9
        head = c - int(math.fmod(c, 5))  # as in SQL, towards zero
        out[c] = told.get(head, [])[:h] + turns[h:]
    return out


def plain(told):
    """Every node with its totals, by looking at all pairs of prefixes."""
    members = {}
    for c, turns in told.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), set()).add(c)
    rows = []
    for path, inside in members.items():
        below = [p for p in members if p[: len(path)] == path]
        children = [p for p in below if len(p) == len(path) + 1]
        leaves = [p for p in below if not any(len(q) == len(p) + 1 and q[: len(p)] == p for q in below)]
        saved = sum((len(members[p]) - 1) * len(p[-1][1].encode()) for p in below if p)
        ends = ",".join(str(c) for c in sorted(inside) if len(told[c]) == len(path))
        parent = min(members[path[:-1]]) if path else None
        digest = hashlib.sha256(ends.encode()).hexdigest()
        rows.append((min(inside), len(path), parent, len(inside), len(children), len(leaves), saved, digest))
    return sorted(rows, key=repr)


def got(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


def conversations(seed=4):
    rng = random.Random(seed)
    texts = ["", None, "ja", "héllo", "x" * 3000, "b\nc"]
    rows = []
    for c in [*range(0, 40), 1_000_003, -4]:
        for t in range(rng.randint(1, 12)):
            rows.append((c, t, rng.choice(["user", None, "a"]), texts[min(len(texts) - 1, int(rng.expovariate(0.7)))]))
    rows += [(50 + k, t, "user", f"same {t}") for k in range(30) for t in range(14)]  # copies
    rows += [rows[0], (3, None, "user", "first"), (3, None, None, "first"), (None, 0, "user", "no id"), (4, 2, "user", "tie"), (4, 2, "user", "eit")]
    # role and text must not run into each other
    return rows + [(60_000, 0, "a", "bc"), (60_001, 0, "ab", "c"), (60_002, 0, "a\nb", "c"), (60_003, 0, "a", "b\nc")]


@pytest.mark.parametrize("subtree", [4_096, 20])
def test_trie_equals_plain_version(spark, monkeypatch, subtree):
    monkeypatch.setattr(trie, "SUBTREE", subtree)
    monkeypatch.setattr(trie, "STRETCH", 7)
    monkeypatch.setattr(trie, "WIDE", 3)
    rows = conversations()
    told = rebuilt(ordered(rows))
    assert got(trie.prefix_trie(trie.rebuild(trie.paths(frame(spark, rows))))) == plain(told)


def test_one_batch_or_many_give_the_same_subtrees(spark):
    rows = [(c, t, "user", f"{(c % 3, t)}") for c in range(60) for t in range(1 + c % 6)]
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    try:
        spark.conf.set(name, "2")
        assert got(trie.prefix_trie(trie.paths(frame(spark, rows)))) == plain(ordered(rows))
    finally:
        spark.conf.set(name, before)


def test_no_rows_no_nodes_and_turnless_conversations_end_at_the_root(spark):
    assert got(trie.prefix_trie(trie.rebuild(trie.paths(frame(spark, []))))) == []
    # 11 takes its first turns from 10, which does not exist, and drops its own
    single = next(c for c in range(11, 1000) if c % 5 and zlib.crc32(str(c).encode()) % 9 >= 2)
    rows = [(single, 0, "user", "a"), (single, 1, "user", "b")]
    digest = hashlib.sha256(str(single).encode()).hexdigest()
    assert got(trie.prefix_trie(trie.rebuild(trie.paths(frame(spark, rows))))) == [(single, 0, None, 1, 0, 1, 0, digest)]
