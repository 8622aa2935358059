"""Exact top-k and near-duplicate vectors against brute force, with odd rows and dense groups."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from chorale.llm import neighbours, topk
from chorale.llm.neighbours import near_vectors
from chorale.llm.topk import KDTree, top_k

ODD = [None, [], [1.0, None], [1.0, float("nan")], [float("inf"), 1.0]]
SCHEMA = "vec_id long, embedding array<double>, score string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "clash") for i, v in rows], SCHEMA)


def test_tree_bounds_hold_and_search_is_exact():
    rng = np.random.default_rng(2)
    vectors = rng.integers(-40, 40, (700, 6)).astype(float)
    tree = KDTree(vectors, np.arange(700))
    asked = rng.integers(-40, 40, (20, 6)).astype(float)
    bounds = tree.bounds(asked)
    for node, (start, stop) in enumerate(tree.nodes):
        assert (asked @ tree.vectors[start:stop].T <= bounds[:, node, None]).all()
    for i, q in enumerate(asked):
        expected = sorted(((-int(s), n) for n, s in enumerate(vectors @ q) if n != 3))[:4]
        assert sorted((-s, n) for s, n in tree.search(q, bounds[i], 3, 4, -math.inf)) == expected


@pytest.mark.parametrize("scale", [1.0, 1e5])
def test_top_k_equals_brute_force(spark, monkeypatch, scale):
    monkeypatch.setattr(topk, "SHARD", 40)
    monkeypatch.setattr(topk, "BLOCK", 4)
    rng = np.random.default_rng(5)
    vectors = np.round(rng.standard_normal((230, 4)), 1) * scale  # rounding makes ties
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)] + [(1000 + i, v) for i, v in enumerate(ODD)]
    rows += [(2000, [1.0, 2.0]), (2010, [3.0, 1.0]), rows[10], (None, [1.0] * 4)]
    got = {(r.query_id, r.rank): (r.vec_id, r.score) for r in top_k(frame(spark, rows), F.col("vec_id") % 10 == 0, 5).collect()}
    whole = np.floor(256 * vectors).astype(np.int64)
    expected = {}
    for q in range(0, 230, 10):
        best = sorted((-int(whole[q] @ whole[c]), c) for c in range(230) if c != q)[:5]
        expected |= {(q, n): (c, -s) for n, (s, c) in enumerate(best, 1)}
    expected |= {(2000, 1): (2010, 256 * 256 * 5), (2010, 1): (2000, 256 * 256 * 5)}
    assert got == expected
    assert top_k(frame(spark, rows).limit(0), F.lit(True), 5).collect() == []


def test_near_vectors_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "LONG", 16)
    monkeypatch.setattr(neighbours, "BLOCK", 32)
    rng = np.random.default_rng(9)
    centre = rng.standard_normal(16)
    dense = centre + 0.08 * rng.standard_normal((150, 16))  # far more neighbours than a list holds
    loose = rng.standard_normal((120, 16))
    pairs = loose[:30] * 3 + 0.05 * rng.standard_normal((30, 16))
    vectors = np.concatenate([dense, loose, pairs])
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    rows += [(500, vectors[0].tolist()), (501, vectors[0].tolist()), (502, [0.0] * 16), (503, [1.0, 2.0]), (504, [1.0, 2.1])]
    rows += [(600 + i, v) for i, v in enumerate(ODD)]
    usable = [(i, np.array(v)) for i, v in rows if i < 502]
    unit = np.array([v / np.linalg.norm(v) for _, v in usable])
    near = unit @ unit.T >= 0.9
    np.fill_diagonal(near, False)
    ids = [i for i, _ in usable]
    root = {i: i for i, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in zip(*np.nonzero(near), strict=True):
        x, y = find(ids[a]), find(ids[b])
        root[max(x, y)] = min(x, y)
    root[504] = 503
    links = {i: 0 for i, _ in rows} | dict(zip(ids, near.sum(axis=1).tolist(), strict=True)) | {503: 1, 504: 1}
    for row in near_vectors(frame(spark, rows)).collect():
        assert (row.n_links, row.component_id) == (links[row.vec_id], find(row.vec_id)), row
        assert row.kept == (row.vec_id == row.component_id)
    assert near_vectors(frame(spark, rows).limit(0)).collect() == []


def brute(rows):
    """Links and the smallest id of the component of every row, all vectors of one width."""
    unit = np.array([v / np.linalg.norm(v) for _, v in rows])
    near = unit @ unit.T >= 0.9
    np.fill_diagonal(near, False)
    group = np.array([i for i, _ in rows])
    while True:
        least = np.where(near, group[None, :], group[:, None]).min(axis=1)
        least = np.minimum(least, group)
        if (least == group).all():
            return {i: (int(n), int(g)) for (i, _), n, g in zip(rows, near.sum(axis=1), group, strict=True)}
        group = least


def test_dense_groups_linked_to_each_other_are_one(spark):
    rng = np.random.default_rng(3)
    first = np.zeros(32)
    first[0] = 1
    second = np.zeros(32)
    second[:2] = 0.93, math.sqrt(1 - 0.93**2)
    apart = np.zeros(32)
    apart[2] = 1
    noise = 0.02 * rng.standard_normal((3, 90, 32))
    vectors = np.concatenate([c + n for c, n in zip((first, second, apart), noise, strict=True)])
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    expected = brute(rows)
    assert len({g for _, g in expected.values()}) == 2 and expected[0][0] > 120
    assert {r.vec_id: (r.n_links, r.component_id) for r in near_vectors(frame(spark, rows)).collect()} == expected


def test_audit_weighs_every_vector_alike(spark, monkeypatch):
    audited = spark.createDataFrame([(1, 1000), (2, 1), (3, 2), (4, 0)], "node long, expected long")
    links = spark.createDataFrame([(1, 9000, 1000), (3, 1, 1)], "node long, links long, classes long")
    assert neighbours._recall(audited, links) == (0.25, 3)  # of 2 and 3, none and half
    assert neighbours._recall(audited.where("node = 4"), links) == (1.0, 0)
    rng = np.random.default_rng(1)
    loose = rng.standard_normal((60, 16))
    rows = [(i, v.tolist()) for i, v in enumerate(np.concatenate([loose, loose[:30] + 0.05 * rng.standard_normal((30, 16))]))]
    # orders that find nothing: the loss must be told, not accepted
    monkeypatch.setattr(neighbours, "_draw", lambda nodes, bits, seeds: spark.createDataFrame([], "a long, b long, similar double"))
    monkeypatch.setattr(neighbours, "DRAWS", 1)
    with pytest.raises(RuntimeError, match="recall is 0.0000"):
        near_vectors(frame(spark, rows))
