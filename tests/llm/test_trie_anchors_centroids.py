"""The prefix trie, block anchors and integer centroids on small tables, against brute force."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tests.llm.conftest import prose
from tidewatch.llm import anchors, centroids, prefix_trie

# --- prefix trie


def brute_nodes(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).digest()
            own[c].append((turn is not None, turn or 0, role, digest, text))
    turns = {c: [(t[2], t[4]) for t in sorted(v)] for c, v in own.items()}
    built = {}
    for c in turns:
        h = zlib.crc32(str(c).encode()) % 9
        built[c] = turns.get(c - c % 5, [])[:h] + turns[c][h:]
    members = defaultdict(list)
    for c, path in built.items():
        for d in range(len(path) + 1):
            members[tuple(path[:d])].append(c)
    kids = Counter(p[:-1] for p in members if p)
    out = []
    for p, cs in members.items():
        below = [q for q in members if q[: len(p)] == p]
        ends = ",".join(str(c) for c in sorted(cs) if len(built[c]) == len(p))
        out.append((
            min(cs), len(p), min(members[p[:-1]]) if p else None, len(cs), kids[p], sum(not kids[q] for q in below),
            sum((len(members[q]) - 1) * len(q[-1][1].encode()) for q in below if q), hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(out, key=repr)


def found_nodes(spark, rows, **small):
    table = spark.createDataFrame([(*r, 7, "x") for r in rows], "conv_id bigint, turn bigint, role string, text string, depth int, fa string")
    return sorted((tuple(r) for r in prefix_trie.prefix_trie(table, **small).collect()), key=repr)


def conversations(seed, n, share):
    """Conversations that follow each other's first turns, with nulls, ties and repeated rows."""
    rng, rows = random.Random(seed), []
    paths = [[]]
    for c in rng.sample(range(3 * n), n):
        path = list(rng.choice(paths)) if rng.random() < share else []
        path += [(rng.choice(["user", "assistant", None, ""]), rng.choice([None, "", "é", prose(rng, rng.randrange(5))])) for _ in range(rng.randrange(5))]
        paths.append(path)
        rows += [(c, None if i == 0 and rng.random() < 0.3 else i, *t) for i, t in enumerate(path)]
        if rows and rng.random() < 0.2:
            rows.append(rows[-1])
    return [*rows, (None, 1, "user", "left out")]


def test_trie_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "PIECE", 3)
    monkeypatch.setattr(prefix_trie, "SPAN", 2)
    monkeypatch.setattr(prefix_trie, "CHUNK", 4)
    for seed, n, share in ((1, 60, 0.8), (2, 40, 0.2)):
        rows = conversations(seed, n, share)
        assert found_nodes(spark, rows) == brute_nodes(rows)


def test_trie_of_hot_conversations(spark):
    """One conversation of many turns, one first turn for all, and many equal conversations."""
    rows = [(1, i, "user", f"turn {i}") for i in range(300)]
    rows += [(c, 0, "user", "same") for c in range(5, 400, 5)] + [(c, 1, "bot", "x" * (c % 3)) for c in range(5, 400, 5)]
    assert found_nodes(spark, rows) == brute_nodes(rows)


def test_trie_of_nothing(spark):
    assert found_nodes(spark, []) == []
    assert found_nodes(spark, [(None, 1, "user", "a")]) == []
    # Three own turns fewer than h, and no conversation to take the first ones from: the root alone.
    lonely = next(c for c in range(1, 99) if zlib.crc32(str(c).encode()) % 9 > 3 and c % 5)
    rows = [(lonely, i, "user", "a") for i in range(3)]
    assert found_nodes(spark, rows) == brute_nodes(rows) and len(brute_nodes(rows)) == 1


def test_fat_binary_search_finds_exit_nodes():
    """Handles stand at two-fattest depths, few probes reach a path's end, and splits keep both true."""
    rng, trie, paths = random.Random(5), prefix_trie.ZFastTrie(), set()
    for _ in range(300):
        path = [rng.choice("ab") for _ in range(rng.randrange(1, 40))]
        keys = ["".join(path[:d]).encode() for d in range(len(path) + 1)]
        node = trie.insert(0, keys)
        assert trie.end[node] == len(path) and trie.key(node, len(path)) == keys[-1]
        paths.add(keys[-1])
    for node, (start, end) in enumerate(zip(trie.start, trie.end)):
        at = prefix_trie.fattest(start, end)
        assert start < at <= end and all(at & -at >= d & -d for d in range(start + 1, end + 1))
        assert trie.handles[trie.key(node, at)] == node
    assert len(trie.handles) == len(trie.end) == len(trie.edges)
    assert {trie.key(n, e) for n, e in enumerate(trie.end)} >= paths
    for path in paths:
        probes = []
        trie.handles, kept = type("Counted", (dict,), {"get": lambda d, *a: probes.append(a) or dict.get(d, *a)})(trie.handles), trie.handles
        keys = [path[:d] for d in range(len(path) + 1)]
        node, depth, _ = trie.exit_node(0, keys)
        assert depth == len(path) and trie.key(node, depth) == path and len(probes) <= len(path).bit_length() + 1
        trie.handles = kept


# --- block anchors


def brute_cut(texts, window):
    words = [[w for w in (t or "").encode().split()] for t in texts]
    seen = Counter(tuple(ws[i : i + window]) for ws in words for i in range(len(ws) - window + 1))
    out = []
    for ws in words:
        gone = {k for i in range(len(ws) - window + 1) if seen[tuple(ws[i : i + window])] > 1 for k in range(i, i + window)}
        out.append((len(ws), len(gone), b" ".join(w for k, w in enumerate(ws) if k not in gone).decode(), len([k for k in gone if k - 1 not in gone])))
    return out


def check_cut(documents, texts, window, block, ids=None):
    frame = documents(list(zip(ids or range(len(texts)), texts))).drop("key").withColumnRenamed("size", "n")
    got = anchors.remove_repeats(frame, window=window, block=block)
    assert got.columns[: len(frame.columns)] == frame.columns
    rows = sorted((r.text is None, r.text or "", r.n_words, r.n_removed, r.kept, len(r.spans)) for r in got.collect())
    assert rows == sorted((t is None, t or "", *e) for t, e in zip(texts, brute_cut(texts, window)))


@pytest.mark.parametrize(("window", "block"), [(35, 18), (5, 3), (1, 1)])
def test_anchors_equal_brute_force(spark, documents, monkeypatch, window, block):
    monkeypatch.setattr(anchors, "UNIT", 300)
    rng = random.Random(window)
    shared = [prose(rng, n) for n in (window - 1, window, window + 1, 3 * window)]
    texts = [None, "", " \t\n\x0b\x0c\r ", "a" * 5000, "x " * 90, "a\x1cb c d " * 50, "é\x85ü " * 40, "ab ba " * window]
    for _ in range(60):
        parts = [prose(rng, rng.randrange(2 * window)) for _ in range(3)]
        texts.append(rng.choice([" ", "\n", "\t\r"]).join([parts[0], rng.choice(shared), parts[1], rng.choice([*shared, ""]), parts[2]]))
    texts += [texts[20]] * 5
    check_cut(documents, texts, window, block, [None, 1, 1, *range(len(texts) - 3)])


def test_words_are_the_same_in_steps_of_any_size(monkeypatch):
    texts = [b"", b" a bc\td" * 40, b"x" * 300 + b" y", "é\u2003ü".encode() * 30, b"a" * 100]
    whole, bounds = anchors.words_of(texts, 2)
    monkeypatch.setattr(anchors, "STEP", 50)
    steps, same = anchors.words_of(texts, 2)
    assert (whole == steps).all() and bounds.tolist() == same.tolist() and bounds[-1] == sum(len(t.split()) for t in texts)


def test_anchors_refuse_and_take_nothing(spark, documents):
    assert anchors.remove_repeats(documents([])).collect() == []
    with pytest.raises(ValueError, match="kept"):
        anchors.remove_repeats(spark.createDataFrame([("a", 1)], "text string, kept int"))
    with pytest.raises(ValueError, match="whole block"):
        anchors.remove_repeats(documents([]), window=35, block=19)


# --- integer centroids


def brute_clusters(rows, k, rounds, width, scale=64):
    kept = [(i, [math.floor(scale * int(x)) if abs(x) > 1e15 else math.floor(scale * x) for x in v]) for i, v in rows
            if v is not None and len(v) == width and all(x is not None and math.isfinite(x) for x in v)]
    first = sorted((hashlib.sha256(f"1:{i}".encode()).hexdigest(), np.array(v, object).tolist()) for i, v in kept if i is not None)
    cents = [v for _, v in first[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(cents))

    for _ in range(rounds):
        groups = defaultdict(list)
        for _, v in kept:
            groups[nearest(v)[1]].append(v)
        cents = [[sum(col) // len(groups[n]) for col in zip(*groups[n])] if n in groups else c for n, c in enumerate(cents)]
    final = [(i, *nearest(v)) for i, v in kept]
    sums = Counter()
    for _, d, n in final:
        sums[n] += d
    fits = lambda x: x if x < 1 << 63 else None
    broken = {n for _, d, n in final if d >= 1 << 63}
    return sorted(
        ((i, n, fits(d), None if n in broken else fits(sums[n]), None if broken else fits(sum(sums.values())), tuple(map(str, cents[n]))) for i, d, n in final), key=repr
    )


def found_clusters(spark, rows, **options):
    table = spark.createDataFrame([(i, v, 1, "x", 2) for i, v in rows], "vec_id bigint, embedding array<double>, cluster int, y string, id int")
    return sorted(((*tuple(r)[:5], tuple(r.centroid)) for r in centroids.cluster(table, **options).collect()), key=repr)


def test_clusters_equal_brute_force(spark):
    rng = random.Random(9)
    middles = [[rng.gauss(0, 1) for _ in range(8)] for _ in range(4)]
    rows = [(i, [x + rng.gauss(0, 0.2) for x in rng.choice(middles)]) for i in range(200)]
    rows += [(200 + i, rows[3][1]) for i in range(40)] + [(5, [0.5] * 8), (5, [0.5] * 8), (None, [0.1] * 8), (300, None), (301, []), (302, [1.0] * 7), (303, [None] + [1.0] * 7),
             (304, [float("nan")] * 8), (305, [float("inf")] * 8), (306, [-0.0] * 8), (307, [0.0] * 8)]
    for k, rounds in ((6, 3), (3, 0), (1, 2)):
        assert found_clusters(spark, rows, clusters=k, rounds=rounds, width=8) == brute_clusters(rows, k, rounds, 8)


def test_clusters_of_large_components_and_few_vectors(spark):
    rows = [(1, [2.0**40, 1.0]), (2, [-(2.0**40), 3.0]), (3, [1.5, 2.5]), (4, [2.0**900, 0.0])]
    assert found_clusters(spark, rows, clusters=2, rounds=2, width=2) == brute_clusters(rows, 2, 2, 2)
    assert found_clusters(spark, rows[:3], clusters=16, rounds=1, width=2) == brute_clusters(rows[:3], 16, 1, 2)
    assert found_clusters(spark, [], width=2) == found_clusters(spark, [(None, [1.0, 2.0])], width=2) == []


def test_bounds_leave_few_centroids():
    rng = np.random.default_rng(2)
    middles = rng.integers(-200, 200, (16, 64))
    rows = middles[rng.integers(0, 16, 500)] + rng.integers(-20, 20, (500, 64))
    rotation = centroids.Rotation.fit(rows.astype(float), 12)
    best, least, computed = centroids.Nearest(middles.tolist(), rotation).block(rows, rotation.project(rows.astype(float)))
    every = ((rows[:, None, :] - middles[None]) ** 2).sum(axis=2)
    assert (best == every.argmin(axis=1)).all() and (least == every.min(axis=1)).all() and computed < 2 * len(rows)
