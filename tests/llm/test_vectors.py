"""Vector operators on small tables, against brute force."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewatch.llm import near_vectors, topk
from tidewatch.llm.components import components

SCHEMA = "vec_id bigint, embedding array<float>, label int, score double, component_id string, id int"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v and [None if x is None else float(x) for x in v], 1, 0.5, "x", 9) for i, v in rows], SCHEMA)


def awkward(rng, n):
    """Unit-like vectors with copies, near copies, chains, null and unusable ones, repeated and null ids."""
    base = [[float(np.float32(rng.gauss(0, 1))) for _ in range(6)] for _ in range(n)]
    rows = list(enumerate(base))
    for k in range(n):
        near = [float(np.float32(x + rng.gauss(0, 0.25))) for x in base[k % 7]]
        rows.append((100 + k, near))
    rows += [(300, base[0]), (301, base[0]), (302, [2 * x for x in base[1]]), (2, base[3]), (None, base[4])]
    rows += [(400, None), (401, []), (402, [0.0] * 6), (403, [1.0, None, 0, 0, 0, 0]), (404, [math.nan] * 6), (405, [math.inf, 0, 0, 0, 0, 0]), (406, base[2][:3])]
    return rows


def usable(v):
    return v and None not in v and all(map(math.isfinite, v))


@pytest.mark.parametrize("tile", [7])
def test_near_vectors_equal_brute_force(spark, monkeypatch, tile):
    monkeypatch.setattr(near_vectors, "TILE", tile)
    rows = awkward(random.Random(8), 60)
    filled = [np.array([*v, *[0.0] * (6 - len(v))]) if usable(v) and any(v) else None for _, v in rows]
    n = len(rows)
    linked = [[False] * n for _ in range(n)]
    for i in range(n):
        for j in range(n):
            a, b = filled[i], filled[j]
            if i != j and a is not None and b is not None:
                linked[i][j] = a @ b / (np.linalg.norm(a) * np.linalg.norm(b)) >= 0.9
    root = list(range(n))
    for _ in range(n):
        for i in range(n):
            for j in range(n):
                if linked[i][j]:
                    root[i] = root[j] = min(root[i], root[j])
    expected = []
    for i, (vec_id, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(n) if root[j] == root[i] and rows[j][0] is not None]
        smallest = min(ids) if ids else None
        expected.append((vec_id, int(sum(linked[i])), smallest, vec_id == smallest))
    got = near_vectors.near_duplicates(vectors(spark, rows)).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, expected))
    assert max(e[1] for e in expected) > 3


def test_nothing_to_compare(spark):
    assert near_vectors.near_duplicates(vectors(spark, [])).collect() == []
    got = near_vectors.near_duplicates(vectors(spark, [(1, None), (2, [0.0])])).collect()
    assert sorted(map(tuple, got)) == [(1, 0, 1, True), (2, 0, 2, True)]
    assert topk.top_k(vectors(spark, []), F.lit(True)).collect() == []
    assert topk.top_k(vectors(spark, [(1, None)]), F.lit(True)).collect() == []
    assert topk.top_k(vectors(spark, [(1, [1.0])]), F.lit(True)).collect() == []


def test_bounds_never_lose_a_pair():
    rng = np.random.default_rng(3)
    a = rng.standard_normal((300, 40)) * np.geomspace(1, 0.05, 40)
    b = np.concatenate((a[:50] + 0.05 * rng.standard_normal((50, 40)), rng.standard_normal((200, 40))))
    unit = lambda x: x / np.linalg.norm(x, axis=1, keepdims=True)
    i, j = near_vectors.linked_pairs(unit(a), unit(b), a, b, 0.8)
    assert set(zip(i.tolist(), j.tolist())) == set(zip(*map(np.ndarray.tolist, np.nonzero(unit(a) @ unit(b).T >= 0.8))))


def test_components_of_chains_and_stars(spark):
    rng = random.Random(9)
    links = [(i, i + 1) for i in range(0, 40)] + [(100, k) for k in range(101, 160)] + [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(40)]
    root = {x: x for e in links for x in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    linked = {x for a, b in links if a != b for x in (a, b)}
    assert got == {x: find(x) for x in linked}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []


@pytest.mark.parametrize("chunk", [5])
def test_top_k_equals_brute_force(spark, monkeypatch, chunk):
    monkeypatch.setattr(topk, "CHUNK", chunk)
    rng = random.Random(10)
    rows = [r for r in awkward(rng, 80) if r[0] != 2] + [(500 + k, [0.5, 0.25, 0.0, 0.0, 0.0, -0.125]) for k in range(25)] + [(600, [100.0, -3.0, 0, 0, 0, 0]), (605, [])]
    whole = [(i, [math.floor(1024 * x) for x in v] + [0] * (6 - len(v))) for i, v in rows if (v == [] or usable(v)) and i is not None]
    expected = []
    for q, v in whole:
        if q % 5 == 0:
            scored = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in whole if i != q)[:10]
            expected += [(q, k, i, -s) for k, (s, i) in enumerate(scored, 1)]
    got = topk.top_k(vectors(spark, rows), F.col("id") % 5 == 0).collect()
    assert sorted(map(tuple, got)) == sorted(expected)


def test_the_first_round_alone_is_not_trusted(spark, monkeypatch):
    """With tiny first rounds the second one has to find what the bounds leave open."""
    monkeypatch.setattr(topk, "PER_PIVOT", 20)
    rng = random.Random(11)
    rows = [(i, [rng.gauss(0, 1) for _ in range(5)]) for i in range(400)]
    rows = [(i, [float(np.float32(x)) for x in v]) for i, v in rows]
    whole = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows]
    got = sorted(map(tuple, topk.top_k(vectors(spark, rows), F.col("id") % 40 == 0, k=3).collect()))
    expected = []
    for q, v in whole[::40]:
        scored = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in whole if i != q)[:3]
        expected += [(q, k, i, -s) for k, (s, i) in enumerate(scored, 1)]
    assert got == sorted(expected)


def test_empty_vectors_score_zero(spark):
    below = topk.top_k(vectors(spark, [(1, []), (2, [-1.0, -1.0]), (3, [1.0, 2.0])]), F.col("id") == 3).collect()
    assert sorted(map(tuple, below)) == [(3, 1, 1, 0), (3, 2, 2, -3 * 1024 * 1024)]
    alone = topk.top_k(vectors(spark, [(1, []), (2, []), (3, None)]), F.lit(True)).collect()
    assert sorted(map(tuple, alone)) == [(1, 1, 2, 0), (2, 1, 1, 0)]


def test_chunks_reach_only_the_blocks_that_visit_them(spark, monkeypatch):
    """Many blocks of queries and chunks: the answers stay those of brute force."""
    monkeypatch.setattr(topk, "CHUNK", 8)
    rng = random.Random(12)
    rows = [(i, [float(np.float32(rng.gauss(0, 1))) for _ in range(4)]) for i in range(120)]
    whole = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows]
    got = topk.top_k(vectors(spark, rows), F.col("id") % 3 == 0, k=4).collect()
    expected = []
    for q, v in whole[::3]:
        scored = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in whole if i != q)[:4]
        expected += [(q, k, i, -s) for k, (s, i) in enumerate(scored, 1)]
    assert sorted(map(tuple, got)) == sorted(expected)


def test_scores_too_large_are_refused(spark):
    with pytest.raises(Exception, match="too large"):
        topk.top_k(vectors(spark, [(0, [3e6]), (1, [1.0])]), F.lit(True)).collect()


def test_copies_are_cut_by_id_not_by_row(spark):
    same, low = [1.0, 0.5], [0.25, 0.25]
    rows = [(100, same), (100, same)] + [(i, same) for i in range(101, 111)] + [(i, low) for i in range(1, 5)] + [(50, same)] * 12
    whole = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows]
    expected = []
    for q in (50, 100, 110):
        v = dict(whole)[q]
        scored = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in whole if i != q)[:10]
        expected += [(q, k, i, -s) for k, (s, i) in enumerate(scored, 1)]
    got = topk.top_k(vectors(spark, rows), F.col("id").isin(50, 100, 110)).collect()
    assert sorted(map(tuple, got)) == sorted(expected)
