"""Classifiers on made-up texts and on the given tables' held-out rows."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.conftest import prose
from tidewatch.llm import quality, queries, toxicity


def labelled(spark, labels, column):
    return spark.createDataFrame(labels, f"doc_id bigint, {column} int")


def corpus(rng, n, odd):
    """Half the texts hold a word of ``odd`` somewhere."""
    rows = []
    for i in range(n):
        words = prose(rng, rng.randrange(20, 80)).split()
        if i % 2:
            words.insert(rng.randrange(len(words)), rng.choice(odd))
        rows.append((i, " ".join(words)))
    return rows


AWKWARD = [(900, None), (901, ""), (902, "   \n"), (903, "word " * 30_000), (904, "x" * 50_000), (None, "no id"), (905, "same"), (905, "same"), (906, "!?")]


def test_ftrl_learns_words_and_endings(spark, documents):
    rng = random.Random(20)
    rows = corpus(rng, 400, ["vermin", "swinehund", "swineherd", "swinely"])
    docs = documents(rows + AWKWARD)
    sample = toxicity.labelled_sample(docs, labelled(spark, [(i, i % 2) for i, _ in rows[:300]] + [(5, 0), (905, 0), (None, 1)], "toxic"), "toxic", 6000)
    model = toxicity.fit(spark, sample)
    assert 0 < len(model.places) < 1 << 12
    scored = toxicity.score(docs, model)
    assert scored.columns == ["doc_id", "text", "lang", "source", "n_chars", "key", "size", "score"]
    got = scored.collect()
    assert len(got) == len(rows) + len(AWKWARD) and all(0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.doc_id is not None and 300 <= r.doc_id < 400]
    assert all((r.score >= 0.7) == (r.doc_id % 2 == 1) for r in held)
    assert len({r.score for r in got if r.doc_id in (900, 901, 902)}) == 1
    again = toxicity.fit(spark, sample)
    assert np.array_equal(again.weights, model.weights)


def test_contradicting_labels_and_bounded_samples(spark, documents):
    docs = documents([(i, f"text {i}") for i in range(20)] + [(7, "another text"), (8, "text 8")])
    labels = labelled(spark, [(i, i % 2) for i in range(20)] + [(3, 0), (3, 1), (50, 1), (None, 0)], "toxic")
    ids = {r.doc_id for r in toxicity.labelled_sample(docs, labels, "toxic", 100).collect()}
    assert ids == set(range(20)) - {3, 7}
    assert toxicity.labelled_sample(docs, labels, "toxic", 5).count() <= 5


def test_weights_follow_the_plain_recursion():
    """Vectorised steps equal FTRL-proximal coordinate by coordinate."""
    options = toxicity.Ftrl(bits=10, skips=(1,), stems=(), epochs=2, l1=0.3)
    texts, labels = ["a b c", "b c d", "a a d", "c"], [1, 0, 1, 0]
    model = toxicity.learn(texts, labels, options)
    z, squares, features = {}, {}, toxicity.Features(10, (1,), ())

    def weight(k):
        l1 = 0 if k == 1024 else options.l1
        own = z.get(k, 0.0)
        if abs(own) <= l1:
            return 0.0
        return -(own - np.sign(own) * l1) / ((options.beta + squares.get(k, 0.0) ** 0.5) / options.alpha + options.l2)

    for _ in range(2):
        for text, y in zip(texts, labels):
            keys = [*set(features.of([text])[0].tolist()), 1024]
            before = {k: weight(k) for k in keys}
            g = 1 / (1 + np.exp(-sum(before.values()))) - y
            for k in keys:
                n = squares.get(k, 0.0)
                z[k] = z.get(k, 0.0) + g - ((n + g * g) ** 0.5 - n**0.5) / options.alpha * before[k]
                squares[k] = n + g * g
    dense = np.zeros(1024)
    dense[model.places] = model.weights
    assert np.allclose(dense, [weight(k) for k in range(1024)]) and np.isclose(model.bias, weight(1024))


def test_votes_are_weighted_cosines(spark, documents):
    rng = random.Random(21)
    rows = corpus(rng, 300, ["Der Der Der Der", "ZZ!! YY!! XX!!", "aa### bb### cc$$$"])
    labels = labelled(spark, [(i, 1 - i % 2) for i, _ in rows[:200]], "quality")
    docs = documents(rows + AWKWARD)
    options = quality.Options()
    voters = quality.fit(docs, quality.labelled_sample(docs, labels, options), options)
    got = quality.score(docs, voters).collect()
    assert len(got) == len(rows) + len(AWKWARD) and all(0 <= r.score <= 1 for r in got)
    terms = quality.Terms(options)
    for r in [r for r in got if r.doc_id is not None and r.doc_id % 37 == 0 and r.doc_id < 300]:
        own = quality.unit(quality.weighted(terms.counts([r.text]), voters.idf) @ voters.basis)[0]
        cosines = [(float(own @ v), y) for v, y in zip(voters.vectors, voters.labels)]
        best = sorted(cosines, key=lambda c: -c[0])[: options.neighbours]
        assert abs(r.score - sum(max(c, 0) * y for c, y in best) / sum(max(c, 0) for c, _ in best)) < 1e-3
    held = [r for r in got if r.doc_id is not None and 200 <= r.doc_id < 300]
    assert sum((r.score >= 0.5) == (r.doc_id % 2 == 0) for r in held) >= 90
    assert {r.score for r in got if r.doc_id in (900, 901, 902)} == {voters.labels.mean()}


def test_term_weights_count_every_document(spark, documents):
    docs = documents([(i, "common" if i % 4 else "common rare") for i in range(40)])
    idf = quality.term_weights(docs, quality.Options())
    terms = quality.Terms(quality.Options())
    common, rare = (int(np.flatnonzero(terms.counts([w])[0][512:])[0]) + 512 for w in ("common", "rare"))
    assert np.isclose(idf[common], 1) and np.isclose(idf[rare], 1 + np.log(41 / 11))


def test_nothing_to_learn_from(spark, documents):
    docs, none = documents([(1, "a"), (2, None)]), labelled(spark, [], "toxic")
    assert toxicity.fit(spark, toxicity.labelled_sample(docs, none, "toxic", 10)) is None
    assert {r.score for r in toxicity.score(docs, None).collect()} == {0.0}
    options = quality.Options()
    assert quality.fit(docs, quality.labelled_sample(docs, labelled(spark, [], "quality"), options), options) is None
    assert {r.score for r in quality.score(docs, None).collect()} == {1.0}
    assert toxicity.score(documents([]), None).collect() == [] and quality.score(documents([]), None).collect() == []


@pytest.mark.parametrize("name, column, modulus, rest, scale, least", [
    ("op1_knn_quality", "quality", 5, 0, "sf0.01", 0.93), ("op6_ftrl_toxicity", "toxic", 3, 1, "sf0.1", 0.93),
])
def test_held_out_accuracy(spark, name, column, modulus, rest, scale, least):
    folder = f"/root/testdata/{scale}"
    truth = {r.doc_id: r[column] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = queries.QUERIES[name](spark, folder).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % modulus == rest) for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id in truth]
    assert sum(r.predicted == truth[r.doc_id] for r in held) / len(held) >= least


def test_toxicity_lists_features_of_few_texts_at_once(spark, documents, monkeypatch):
    """Scores do not depend on how many texts' features are listed at once; that number bounds what a worker holds."""
    rng = random.Random(26)
    rows = corpus(rng, 300, ["zork", "zorking"])
    model = toxicity.fit(spark, toxicity.labelled_sample(documents(rows), labelled(spark, [(i, i % 2) for i, _ in rows[:200]], "toxic"), "toxic", 200))
    texts, features = [t for _, t in rows], toxicity.Features(model.bits, model.skips, model.stems)
    whole = model.pairs(features, texts, 0)
    assert len(whole) and (np.concatenate([model.pairs(features, texts[k : k + 7], k) for k in range(0, len(texts), 7)]) == whole).all()
    listed, of = [], toxicity.Features.of
    monkeypatch.setattr(toxicity.Features, "of", lambda self, texts: listed.append(len(texts)) or of(self, texts))
    batch = pa.RecordBatch.from_pydict({"_text": [t for _ in range(4) for t in texts]})
    score = next(toxicity.score_batches([batch], model, [], "_text"))
    assert max(listed) <= toxicity.LISTED and score.num_rows == toxicity.DOCUMENTS_PER_BATCH


def test_toxicity_rows_take_four_bytes_a_place(monkeypatch):
    """What training holds of every text, for all its epochs."""
    kinds, make = set(), np.append
    monkeypatch.setattr(toxicity.np, "append", lambda *a: kinds.add((made := make(*a)).dtype) or made)
    toxicity.learn(["good word", "bad word"], [0, 1], toxicity.Ftrl(bits=10, epochs=1))
    assert kinds == {np.dtype(np.int32)}
