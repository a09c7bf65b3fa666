"""Near duplicates and repeated strings on small tables, against brute force."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from tests.llm.conftest import prose
from tidewatch.llm import minhash, repeats


def shingles(text):
    words = re.findall(r"\w+", (text or "").lower())
    return Counter(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else Counter()


def brute_classes(rows):
    """Class id by row number."""
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            shared, total = sum((sets[i] & sets[j]).values()), sum((sets[i] | sets[j]).values())
            if (rows[i][1] or "") == (rows[j][1] or "") or (total and shared >= 0.8 * total):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    out = []
    for i in range(len(rows)):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        out.append(min(ids) if ids else None)
    return out


def near_copies(rng):
    rows = []
    for k in range(12):
        base = prose(rng, rng.choice([3, 5, 8, 40, 120, 300])).split()
        for _ in range(rng.choice([1, 2, 9])):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 4])):
                copy[rng.randrange(len(copy))] = prose(rng, 1)
            rows.append(" ".join(copy))
    chain = prose(rng, 150).split()
    for _ in range(12):  # each links with the one before, far ones do not
        chain = chain[4:] + prose(rng, 4).split()
        rows.append(" ".join(chain))
    rows += [None, "", "", "!!!", "???", "!!!", "der " * 60, "der " * 64, "der " * 200, "One two", "one, TWO", prose(rng, 20_000)]
    numbered = list(enumerate(rows))
    rng.shuffle(numbered)
    return numbered + [numbered[0], numbered[1], (None, numbered[2][1]), (3, "another text of the third id")]


@pytest.mark.parametrize("block", [3])
def test_near_duplicates_equal_brute_force(spark, documents, monkeypatch, block):
    monkeypatch.setattr(minhash, "BLOCK", block)
    rows = near_copies(random.Random(12))
    expected = [(i, c, i == c) for (i, _), c in zip(rows, brute_classes(rows))]
    got = minhash.near_duplicates(documents(rows)).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, expected))


def test_one_row_of_each_class_stays(spark, documents):
    rows = near_copies(random.Random(13))
    classes = brute_classes(rows)
    df = documents(rows)
    kept = minhash.without_near_duplicates(df)
    assert kept.columns == df.columns
    left = kept.collect()
    assert len(left) == len(set(classes))
    by_row = {(i, t): c for (i, t), c in zip(rows, classes)}
    assert {by_row[(r.doc_id, r.text)] for r in left} == set(classes)


def test_one_text_of_a_class_stays_also_under_one_id(spark, documents):
    """Near copies under one repeated id, and near copies without ids."""
    rng = random.Random(23)
    one, two = prose(rng, 100).split(), prose(rng, 100).split()
    rows = [(7, " ".join([*one, extra])) for extra in ("x", "y", "z")] + [(None, " ".join([*two, extra])) for extra in ("x", "y")]
    df = documents(rows)
    assert sorted(map(repr, [r.doc_id for r in minhash.without_near_duplicates(df).collect()])) == ["7", "None"]
    kept = [r for r in minhash.near_duplicates(df).collect() if r.kept]
    assert sorted(map(repr, [r.class_id for r in kept])) == ["7", "None"]


def test_thresholds_the_bands_are_not_made_for_are_refused(documents):
    for run in (minhash.near_duplicates, minhash.without_near_duplicates):
        with pytest.raises(ValueError, match="0.6"):
            run(documents([(1, "a text")]), 0.6)


def test_no_documents(documents):
    assert minhash.near_duplicates(documents([])).collect() == []
    assert repeats.remove_repeats(documents([])).collect() == []


def test_links_across_blocks_are_found(spark, documents, monkeypatch):
    """With every text its bucket's wrong centre, the later comparison has to find the links."""
    monkeypatch.setattr(minhash, "BLOCK", 2)
    monkeypatch.setattr(minhash, "likely", lambda pairs, nodes, threshold: pairs.where("false"))
    rng = random.Random(14)
    base = prose(rng, 100).split()
    rows = [(k, " ".join(base[:k] + ["new"] + base[k:])) for k in range(0, 90, 10)] + [(500, prose(rng, 100))]
    got = {r.doc_id: r.class_id for r in minhash.near_duplicates(documents(rows)).collect()}
    assert got == {i: c for (i, _), c in zip(rows, brute_classes(rows))}


def test_signatures_are_unbiased():
    rng = np.random.default_rng(15)
    value, weight = rng.integers(0, 1 << 62, 200).astype(np.uint64), rng.integers(1, 12, 200)
    other = weight.copy()
    other[:90] = rng.integers(1, 12, 90)
    other[190:] = 0
    true = np.minimum(weight, other).sum() / np.maximum(weight, other).sum()
    kept = other > 0
    agree = []
    for _ in range(150):
        salt = np.uint64(rng.integers(1 << 60))
        owner = np.concatenate((np.zeros(200, int), np.ones(kept.sum(), int)))
        found = minhash.signatures(owner, np.concatenate((value, value[kept])) ^ salt, np.concatenate((weight, other[kept])), 2)
        agree.append((found[0] == found[1]).mean())
    assert abs(np.mean(agree) - true) < 4 * np.sqrt(true * (1 - true) / (150 * minhash.REGISTERS))


def brute_removed(texts):
    size = repeats.LENGTH
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[k : k + size] for d in data for k in range(len(d) - size + 1))
    out = []
    for d in data:
        gone = np.zeros(len(d), bool)
        for k in range(len(d) - size + 1):
            if seen[d[k : k + size]] > 1:
                gone[k : k + size] = True
        out.append((len(d), int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum()), bytes(np.frombuffer(d, np.uint8)[~gone])))
    return out


def repetitive(rng):
    passage, line = prose(rng, 90), prose(rng, 38)
    texts = [prose(rng, 60) + passage + prose(rng, 40) for _ in range(8)] + [passage, passage[:199], passage[3:203], passage[:200]]
    texts += [prose(rng, 20) + line + prose(rng, 25) for _ in range(15)]
    base = prose(rng, 300)
    for _ in range(8):
        at = rng.randrange(len(base) - 1)
        texts.append(base[:at] + "Xé日"[rng.randrange(3)] + base[at + 1 :])
    texts += ["a" * 700, "ab" * 300, "", None, None, "short", "é" * 150, "日本" * 60, base, base, "abc" * 66 + "ab", "abc" * 66 + "ac"]
    texts += [line[:150] + prose(rng, 30), "a" * 199, "x" + "b" * 200, "y" + "b" * 200]
    return texts


@pytest.mark.parametrize("full, hot", [(2, 3), (2000, 10_000)])
def test_removed_bytes_equal_brute_force(spark, documents, monkeypatch, full, hot):
    monkeypatch.setattr(repeats, "FULL", full)
    monkeypatch.setattr(repeats, "HOT", hot)
    texts = repetitive(random.Random(16))
    rows = list(enumerate(texts)) + [(5, texts[5]), (None, prose(random.Random(2), 80))]
    expected = Counter(((i,), *e) for (i, _), e in zip(rows, brute_removed([t for _, t in rows])))
    got = repeats.remove_repeats(documents(rows))
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars", "score", "key", "size", "n_bytes", "spans", "kept"]
    assert Counter(((r.doc_id,), r.n_bytes, len(r.spans), bytes(r.kept)) for r in got.collect()) == expected


def test_own_columns_of_any_name_stay(spark):
    rows = [(i, t, [i], f"own {i}", b"k", 0) for i, t in enumerate(["x" * 250, "y" * 10, None])]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, marks array<bigint>, _text string, _key binary, Kept int")
    got = repeats.remove_repeats(df)
    assert got.columns == ["doc_id", "text", "marks", "_text", "_key", "n_bytes", "spans", "kept"]
    assert {(r.doc_id, r.marks[0], r._text, bytes(r._key), len(r.kept)) for r in got.collect()} == {
        (0, 0, "own 0", b"k", 0), (1, 1, "own 1", b"k", 10), (2, 2, "own 2", b"k", 0)
    }


def test_suffix_array_orders_windows():
    rng = random.Random(24)
    data = (prose(rng, 300) + "a" * 450 + prose(rng, 50) * 3 + "ab" * 150).encode()
    starts = np.array(sorted(rng.sample(range(len(data) - repeats.LENGTH + 1), 700)))
    order, rank = repeats.suffix_array(np.frombuffer(data, np.uint8), starts)
    windows = [data[s : s + repeats.LENGTH] for s in starts[order]]
    assert sorted(order) == list(range(700)) and windows == sorted(windows)
    assert [a == b for a, b in zip(rank[1:], rank)] == [a == b for a, b in zip(windows[1:], windows)]


def test_blocks_hold_whole_contexts(monkeypatch):
    monkeypatch.setattr(repeats, "PLACES", 4)
    context = np.array([1, 1, 2, 3, 3, 3, 4])
    assert list(repeats.blocks(context, np.array([4, 4, 9, 3, 3, 3, 7]))) == [(0, 2), (2, 3), (3, 7)]


def test_whole_characters_leave_text(spark, documents):
    texts = repetitive(random.Random(17))
    exact = brute_removed(texts)
    for row in repeats.remove_repeats(documents(list(enumerate(texts))), whole_characters=True).collect():
        kept = bytes(row.kept).decode()
        assert len(bytes(row.kept)) <= len(exact[row.doc_id][2])
        assert len(exact[row.doc_id][2]) - len(bytes(row.kept)) <= 6 * (len(row.spans) + exact[row.doc_id][1])
        assert kept == (row.text or "") or row.spans


def test_every_window_has_one_phrase_of_its_own_bytes():
    rng = random.Random(18)
    data = np.frombuffer((prose(rng, 400) + "z" * 500 + prose(rng, 100)).encode(), np.uint8)
    shifted = np.concatenate((np.frombuffer(b"front matter ", np.uint8), data))
    one, two = (repeats.parse(d, np.array([0]), np.array([len(d)])) for d in (data, shifted))

    def owners(found):
        return {w: a for _, a, lo, hi, *_ in zip(*found) for w in range(lo, hi + 1)}

    first, second = owners(one), owners(two)
    assert sorted(first) == list(range(len(data) - repeats.LENGTH + 1))
    assert all(second[w + 13] == a + 13 for w, a in first.items())
    assert all(repeats.NEAR <= a - w <= repeats.FAR for w, a in first.items())


def test_long_texts_are_parsed_in_pieces(monkeypatch):
    monkeypatch.setattr(repeats, "PIECE", 300)
    text = prose(random.Random(19), 400)
    windows = []
    for batch in repeats.pieces_of([text, "", "short"]):
        for i, offset, part in batch:
            windows += [(i, offset + k) for k in range(len(part) - repeats.LENGTH + 1)]
            assert text.encode()[offset : offset + len(part)] == part or i
    assert sorted(windows) == [(0, k) for k in range(len(text) - repeats.LENGTH + 1)]
