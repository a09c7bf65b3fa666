"""Sharding, BPE, packing and URL lists on small tables, against brute force."""

import datetime as dt
import random
import zlib
from array import array

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tests.llm.conftest import prose
from tidewatch.llm import bpe, packing, sharding, url_lists

AWKWARD = [None, "", " ", "\n\t", "a" * 5000, "ab" * 800 + "!!!???" * 40, "Don't we'll <|endoftext|>X<|startoftext|>", "ΟΔΟΣ Σ İ ﬁ é é", "日本語 한국어   \x1c"]


def test_shards_follow_prefix_sums(spark, documents):
    rng = random.Random(3)
    rows = [(rng.choice([None, 5, *range(60)]), rng.choice([None, "", "same", prose(rng, rng.randrange(90))])) for _ in range(300)]
    got = sharding.shard_by_bytes(documents(rows), 7).collect()
    sized = sorted(
        ((i is not None, i or 0, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())), i) for i, t in rows
    )
    total, start, seen, expected = sum(k[2] for k, _ in sized), 0, {}, []
    for (_, _, size, crc), i in sized:
        shard = (2 * start + size) * 7 // (2 * total)
        slot = seen[shard] = seen.get(shard, -1) + 1
        expected.append((i, size, crc, "bytes", shard, slot, None))
        start += size
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, expected))
    per_shard = {}
    for row in got:
        per_shard[row.shard] = per_shard.get(row.shard, 0) + row.size
    assert max(per_shard.values()) - min(per_shard.values()) <= max(r.size for r in got)


def test_shards_of_nothing(documents):
    assert sharding.shard_by_bytes(documents([])).collect() == []


def test_bpe_equals_the_library(spark, documents):
    rng = random.Random(4)
    letters = [chr(c) for c in [*range(0x20, 0x250), *range(0x370, 0x400), 0x2028, 0x85, 0xA0, 0x3000, 0x1F600, 0x301]]
    texts = AWKWARD + ["".join(rng.choice(letters) for _ in range(rng.randrange(60))) for _ in range(300)] + ["again", "again"]
    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    encoded = bpe.encode(documents(list(enumerate(texts))), path)
    assert encoded.columns == ["doc_id", "text", "lang", "source", "n_chars", "score", "key", "size", "ids", "decoded"]
    rows = {r.doc_id: r for r in bpe.decode(encoded.withColumnRenamed("decoded", "once"), path).collect()}
    assert len(rows) == len(texts)
    for i, text in enumerate(texts):
        ids = library.encode(text or "", add_special_tokens=False).ids
        assert list(array("I", rows[i].ids)) == ids
        assert rows[i].once == rows[i].decoded == library.decode(ids, skip_special_tokens=False)
    assert bpe.encode(documents([]), path).collect() == []


def test_a_join_of_lower_rank_goes_first():
    """Pairs are joined in the order a word alone would take, also when a join makes a pair of lower rank."""
    model = bpe.Model.__new__(bpe.Model)
    names = ["a", "b", "c", "ab", "bc", "abc", "abcc"]
    vocab = {n: i for i, n in enumerate(names)}
    merges = [("b", "c"), ("a", "bc"), ("abc", "c"), ("a", "b"), ("ab", "c")]
    model.joins = [(vocab[x], vocab[y], vocab[x + y]) for x, y in merges]
    model.ranks = {x << 32 | y: r for r, (x, y, _) in enumerate(model.joins)}
    model.first = model.last = [vocab.get(chr(b), 0) for b in range(256)]

    def alone(word):
        out = [vocab[c] for c in word]
        while True:
            found = [(model.ranks[x << 32 | y], i) for i, (x, y) in enumerate(zip(out, out[1:])) if x << 32 | y in model.ranks]
            if not found:
                return out
            _, i = min(found)
            out[i : i + 2] = [model.joins[min(found)[0]][2]]

    rng = random.Random(5)
    words = {"".join(rng.choice("abc") for _ in range(rng.randrange(1, 14))) for _ in range(400)}
    assert dict(model.encode_words(words)) == {w: alone(w) for w in words}


def test_packing_covers_every_id_once(spark, documents):
    rng = random.Random(6)
    rows = list(enumerate(AWKWARD + [prose(rng, rng.randrange(400)) for _ in range(120)] + ["same text"] * 30)) + [(3, "repeated id"), (None, "no id")]
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    pieces = packing.pack(documents(rows), ranks, public_tokenizers.PATTERN, {"<|endoftext|>": 50256}, window=64).collect()
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = [(i, np.array([*library.encode(t or "", add_special_tokens=False).ids, 0], np.uint32)) for i, t in rows]
    expected, by_id = {}, {}
    for i, own in ids:
        expected[i] = expected.get(i, 0) + len(own)
    for p in pieces:
        by_id[p.doc_id] = by_id.get(p.doc_id, 0) + p.length
        if p.doc_id != 3:
            own = next(o for i, o in ids if i == p.doc_id)
            assert p.doc_tokens == len(own)
            assert p.ids_crc32 == zlib.crc32(own[p.start : p.start + p.length].tobytes())
    assert by_id == expected
    sequences = {}
    for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset)):
        assert p.offset == sequences.get(p.sequence_id, 0)
        sequences[p.sequence_id] = p.offset + p.length
    assert sum(64 - n for n in sequences.values()) < 64 and max(sequences.values()) <= 64
    assert packing.pack(documents([]), ranks, public_tokenizers.PATTERN).collect() == []


def test_a_window_is_filled_with_its_seeds_neighbours():
    items = [np.array(x) for x in ([1, 2, 3], [7, 8, 9], [1, 2, 4], [7, 8, 5], [1, 3, 6])]
    index = packing.Index(items, np.ones(10), 3.0)
    order = [piece[0] for piece in packing.fill(items, index, 9)]
    assert set(order[:3]) == {0, 2, 4} and set(order[3:]) == {1, 3}


def ids_of(text):
    return np.array([*LIBRARY.encode(text or "", add_special_tokens=False).ids, 0], np.uint32)


LIBRARY = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def test_neighbours_are_the_best_of_the_whole_corpus(spark, documents, monkeypatch):
    """Every search over small shards gives what BM25 over all unused documents gives, long ones taken whole."""
    monkeypatch.setattr(packing, "SHARD_ROWS", 16)
    rng = random.Random(24)
    rows = list(enumerate([None, "", *[prose(rng, rng.choice([3, 12, 40, 150])) for _ in range(90)], *["same text"] * 5]))
    texts = {i: ids_of(t) for i, t in rows}
    held = {i: np.unique(t, return_counts=True) for i, t in texts.items()}
    n, mean = len(rows), np.mean([len(t) for t in texts.values()])
    df = {}
    for terms, _ in held.values():
        for t in terms.tolist():
            df[t] = df.get(t, 0) + 1

    def bm25(seed, item):
        mine, score = set(held[seed][0].tolist()), 0.0
        for t, c in zip(*map(np.ndarray.tolist, held[item])):
            if t in mine and t != packing.END:
                idf = np.log1p((n - df[t] + 0.5) / (df[t] + 0.5))
                score += idf * c * 2.2 / (c + 1.2 * (0.25 + 0.75 * len(texts[item]) / mean))
        return score

    searches, search, make = [], packing.Corpus.search, packing.Corpus.__init__

    def kept(self, own, *args):
        make(self, own, *args)
        self.names = {r.number: r.doc_id for r in own.select("number", "doc_id").collect()}

    def checked(self, seeds, targets, unused):
        found = search(self, seeds, targets, unused)
        searches.append(self.near is None)
        free = [x for x in np.flatnonzero(unused).tolist()]
        for k, seed in enumerate(seeds.tolist()):
            own = found[found["asker"] == k]
            scores = {x: bm25(self.names[seed], self.names[x]) for x in free if x != seed}
            assert np.allclose(own["score"], [scores[x] for x in own["item"].tolist()], rtol=1e-4)
            assert (np.diff(own["score"]) <= 0).all()
            others = [s for x, s in scores.items() if x not in set(own["item"].tolist())]
            if own["size"].sum() < targets[k]:
                assert not any(others)
            elif targets[k]:
                assert max(others, default=0) <= own["score"][-1] * (1 + 1e-4)
        return found

    monkeypatch.setattr(packing.Corpus, "__init__", kept)
    monkeypatch.setattr(packing.Corpus, "search", checked)
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    pieces = packing.pack(documents(rows), path, public_tokenizers.PATTERN, {"<|endoftext|>": 50256}, window=64).collect()
    assert True in searches and False in searches
    ends = {}
    for p in sorted(pieces, key=lambda p: (p.doc_id, p.start)):
        assert p.start == ends.get(p.doc_id, 0)
        ends[p.doc_id] = p.start + p.length
        assert p.ids_crc32 == zlib.crc32(texts[p.doc_id][p.start : p.start + p.length].tobytes())
    assert ends == {i: len(t) for i, t in texts.items()}
    filled = {}
    for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset)):
        assert p.offset == filled.get(p.sequence_id, 0)
        filled[p.sequence_id] = p.offset + p.length
    assert sum(64 - f for f in filled.values()) < 64 and max(filled.values()) <= 64


def test_long_texts_are_matched_by_all_of_their_ids(documents):
    tail, other = "an river stone " * 30, "some tall building " * 30
    rows = [(0, "zebra quartz violin " * 40 + tail)] + [(i, "an river stone " * 2) for i in range(1, 9)] + [(9, "zebra quartz violin " * 50 + other)]
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    pieces = packing.pack(documents(rows), path, public_tokenizers.PATTERN, window=64).collect()
    last = {i: [p for p in pieces if p.doc_id == i and p.start == p.doc_tokens // 64 * 64] for i in (0, 9)}
    assert last[0][0].sequence_id == last[9][0].sequence_id


def test_every_id_of_a_seed_counts_and_every_neighbour_comes_first():
    idf = np.full(60, 5.0)
    idf[30] = 0.1
    items = [np.arange(1, 31), np.array([50]), np.array([30])]
    order = [p[0] for p in packing.fill(items, packing.Index(items, idf, 10.0), 31)]
    assert order == [0, 2, 1]
    items = [np.array([1, 2])] + [np.array([9, 9])] * 50 + [np.array([1, 3])] * 100
    order = [p[0] for p in packing.fill(items, packing.Index(items, idf, 2.0), 202)]
    assert set(order[:101]) == {0, *range(51, 151)}


def day(n):
    return dt.datetime(2024, 1, 1) + dt.timedelta(days=n)


def test_url_lists_as_of_the_fetch(spark):
    entry = "list string, verdict string, scope string, pattern string, action string, at timestamp"
    entries = spark.createDataFrame([
        ("spam", "block", "domain", "bad.com", "add", day(10)), ("spam", "block", "domain", "bad.com", "add", day(12)),
        ("spam", "block", "domain", "bad.com", "remove", day(20)), ("spam", "block", "domain", "bad.com", "remove", day(25)),
        ("spam", "block", "domain", "bad.com", "add", day(30)), ("ok", "allow", "prefix", "a.bad.com/news", "add", day(0)),
        ("z", "block", "host", "x.org", "add", day(5)), ("z", "block", "host", "x.org", "remove", day(5)),
        ("b", "block", "host", "tie.org", "add", day(0)), ("a", "allow", "host", "tie.org", "add", day(0)),
        (None, "block", "host", "y.org", "add", day(0)), ("q", "block", "host", "y.org", "add", None), ("q", "block", "odd", "y.org", "add", day(0)),
    ], entry)
    spans = {(r.pattern, r.valid_from, r.valid_to) for r in url_lists.validity(entries).collect()}
    assert spans == {("bad.com", day(10), day(20)), ("bad.com", day(30), None), ("a.bad.com/news", day(0), None), ("tie.org", day(0), None)}
    cases = [
        (1, "http://bad.com/", day(9), "none", 0), (2, "https://bad.com", day(10), "block", 1), (3, "http://A.Bad.com:80/x?q#f", day(19), "block", 1),
        (4, "http://a.bad.com/news/1", day(15), "allow", 2), (5, "http://a.bad.com/newsroom", day(15), "block", 1), (6, "http://bad.com", day(20), "none", 0),
        (7, "http://u:p@bad.com./", day(31), "block", 1), (8, None, day(1), "none", 0), (9, "no address", day(1), "none", 0), (10, "http://bad.com", None, "none", 0),
        (11, "http://x.org/", day(6), "none", 0), (12, "http://tie.org/", day(6), "allow", 2), (13, "http://notbad.com/", day(15), "none", 0),
        (2, "https://bad.com", day(10), "block", 1), (14, "http://y.org", day(3), "none", 0),
    ]
    captures = spark.createDataFrame([(i, u, t, "clash") for i, u, t, _, _ in cases], "page_id int, url string, fetched_at timestamp, verdict string")
    got = sorted((r.page_id, r.verdict, r.n_active) for r in url_lists.judge(captures, entries).collect())
    assert got == sorted((i, v, n) for i, _, _, v, n in cases)
    assert url_lists.judge(captures.where("false"), entries).collect() == []
    assert {r.verdict for r in url_lists.judge(captures, entries.where("false")).collect()} == {"none"}


def test_a_top_level_domain_lists_all_hosts_below_it(spark):
    entries = spark.createDataFrame([("t", "block", "domain", "zip", "add", day(0))], "list string, verdict string, scope string, pattern string, action string, at timestamp")
    captures = spark.createDataFrame([(i, u, day(1)) for i, u in enumerate(["http://a.b.zip/x", "http://b.zip", "http://zip/", "http://zip.org", "http://azip"])], "page_id int, url string, fetched_at timestamp")
    got = {r.page_id: (r.verdict, r.n_active) for r in url_lists.judge(captures, entries).collect()}
    assert got == {0: ("block", 1), 1: ("block", 1), 2: ("block", 1), 3: ("none", 0), 4: ("none", 0)}


@pytest.mark.parametrize("name", ["op8_url_lists_asof", "op10_byte_shards"])
def test_native_plans(spark, sf_dir, name):
    from tidewatch.llm import queries

    plan = queries.QUERIES[name](spark, sf_dir)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def test_a_seed_that_asks_again_is_answered_from_its_list(spark, documents, monkeypatch):
    """What a search of the shards found is kept, so a window that lost its neighbours to older ones does not search them all again."""
    monkeypatch.setattr(packing, "SHARD_ROWS", 16)
    rng = random.Random(25)
    rows = [(i, prose(rng, rng.choice([3, 12, 20]))) for i in range(400)]
    looked, answered, search, best = [], [], packing.Corpus.search, packing.Corpus.ask

    def asked(self, seeds, targets, unused):
        looked.extend(seeds.tolist())
        return best(self, seeds, targets, unused)

    def searched(self, seeds, targets, unused):
        if self.near is None and unused.sum():
            answered.extend(seeds.tolist())
        return search(self, seeds, targets, unused)

    monkeypatch.setattr(packing.Corpus, "ask", asked)
    monkeypatch.setattr(packing.Corpus, "search", searched)
    pieces = packing.pack(documents(rows), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, window=64).collect()
    assert sum(p.length for p in pieces) == sum(len(ids_of(t)) for _, t in rows)
    assert set(looked) == set(answered) and len(looked) < len(answered)


def test_shards_are_written_again_without_used_documents(spark, documents, monkeypatch):
    """No search reads more than about twice the documents that are still unused, and none of these goes missing."""
    monkeypatch.setattr(packing, "SHARD_ROWS", 16)
    rng = random.Random(27)
    rows = [(i, prose(rng, rng.choice([3, 12, 20]))) for i in range(400)]
    read, ask = [], packing.Corpus.ask

    def asked(self, seeds, targets, unused):
        found = ask(self, seeds, targets, unused)
        held = np.concatenate([np.frombuffer(r.numbers, np.int64) for r in self.shards.collect()])
        assert set(np.flatnonzero(unused).tolist()) <= set(held.tolist()) and len(set(held.tolist())) == len(held)
        read.append((len(held), int(unused.sum())))
        return found

    monkeypatch.setattr(packing.Corpus, "ask", asked)
    pieces = packing.pack(documents(rows), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, window=64).collect()
    assert sum(p.length for p in pieces) == sum(len(ids_of(t)) for _, t in rows)
    assert read and all(held <= 2 * unused for held, unused in read) and read[-1][0] < 200
