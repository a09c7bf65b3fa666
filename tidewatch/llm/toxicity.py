"""Toxicity scores by FTRL-proximal logistic regression over hashed word n-grams and skip-grams."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidewatch.llm.common import private, text_of

WORD = re.compile(r"\w+")
MIX = np.uint64(0x9E3779B97F4A7C15)
DOCUMENTS_PER_BATCH = 512
#: Documents whose features are listed at once.
LISTED = 64
CACHED_WORDS = 150_000


@dataclass(frozen=True)
class Ftrl:
    """Parameters of the learner.

    ``sample``: at most so many labelled rows are learnt from, those of the smallest hash of their id.
    ``bits``: the feature space has 2**bits places. ``alpha`` and ``beta`` set each coordinate's rate,
    alpha / (beta + sqrt(sum of its squared gradients)); ``l1`` sets small weights to zero, ``l2`` shrinks.
    ``skips``: distances of the word pairs, 1 being the plain bigram. ``stems``: numbers of leading letters that
    count as a word's stem, for languages that put endings on a word.
    """

    sample: int = 6000
    bits: int = 20
    alpha: float = 1.0
    beta: float = 1.0
    l1: float = 6.0
    l2: float = 0.1
    epochs: int = 8
    skips: tuple[int, ...] = (1, 2, 3)
    stems: tuple[int, ...] = (4, 5)


class Features:
    """Hashed features of texts: each word, its stems (leading letters), and pairs of words at the given distances."""

    def __init__(self, bits: int, skips: tuple[int, ...], stems: tuple[int, ...]):
        self.shift, self.skips, self.stems = np.uint64(64 - bits), skips, stems
        self.rows: dict[str, int] = {}
        self.codes = np.zeros((1024, 1 + len(stems)), np.uint64)

    def row_of(self, word: str) -> int:
        row = self.rows[word] = len(self.rows)
        if row >= len(self.codes):
            self.codes = np.concatenate((self.codes, np.zeros_like(self.codes)))
        self.codes[row, 0] = xxhash.xxh64_intdigest(word)
        for k, n in enumerate(self.stems, 1):
            self.codes[row, k] = xxhash.xxh64_intdigest(word[:n], n) if len(word) > n else 0
        return row

    def of(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Places of all features, text by text, and the number of each text's features.

        A text's words and pairs are taken for its whole length; no pair reaches into the next text.
        """
        if len(self.rows) > CACHED_WORDS:
            self.rows = {}
        rows, row_of = self.rows, self.row_of
        listed = [[rows[w] if w in rows else row_of(w) for w in WORD.findall(t.lower())] for t in texts]
        sizes = np.fromiter(map(len, listed), np.int64, len(listed))
        words = self.codes[np.fromiter(chain.from_iterable(listed), np.int64, int(sizes.sum()))]
        owner = np.repeat(np.arange(len(texts)), sizes)
        codes = words[:, 0]
        found, owners = [codes * MIX], [owner]
        for k in range(1, words.shape[1]):
            longer = words[:, k] != 0
            found.append(words[longer, k] * MIX)
            owners.append(owner[longer])
        for d in self.skips:
            same = owner[d:] == owner[:-d]
            pair = codes[:-d] * np.uint64(0xC2B2AE3D27D4EB4F) + codes[d:] * np.uint64(0x165667B19E3779F9) + np.uint64(d)
            found.append(((pair ^ (pair >> np.uint64(29))) * MIX)[same])
            owners.append(owner[d:][same])
        places = (np.concatenate(found) >> self.shift).astype(np.int32)
        whose = np.concatenate(owners)
        order = np.argsort(whose, kind="stable")
        return places[order], np.bincount(whose, minlength=len(texts))


@dataclass
class Model:
    """Nonzero weights and their places, which is what is broadcast; at most 2**bits of them."""

    bits: int
    skips: tuple[int, ...]
    stems: tuple[int, ...]
    places: np.ndarray
    weights: np.ndarray
    bias: float
    dense: np.ndarray | None = field(default=None, repr=False)

    def all_weights(self) -> np.ndarray:
        if self.dense is None:
            self.dense = np.zeros(1 << self.bits)
            self.dense[self.places] = self.weights
        return self.dense

    def pairs(self, features: Features, texts: list[str], first: int) -> np.ndarray:
        """Text (numbered from ``first``) and place as one number, in order. Only places with a weight matter; a place counts once per text."""
        places, sizes = features.of(texts)
        used = np.flatnonzero(self.all_weights()[places])
        return np.unique((np.repeat(np.arange(first, first + len(sizes)), sizes)[used] << self.bits) | places[used])

    def score(self, places: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        total = sums(self.all_weights()[places], sizes)
        return 1 / (1 + np.exp(-np.clip(self.bias + total, -35, 35)))


def sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    ends = np.cumsum(sizes)
    running = np.concatenate(([0.0], np.cumsum(values)))
    return running[ends] - running[ends - sizes]


def learn(texts: list[str], labels: list[int], options: Ftrl) -> Model:
    """FTRL-proximal over the rows in the given order, ``epochs`` times. A feature counts once per text."""
    features = Features(options.bits, options.skips, options.stems)
    n = 1 << options.bits
    z, squares = np.zeros(n + 1), np.zeros(n + 1)
    rows = []
    for text in texts:
        places, _ = features.of([text])
        # Place n is the bias, which L1 leaves alone.
        rows.append(np.append(np.unique(places), np.int32(n)))
    l1 = np.full(n + 1, options.l1)
    l1[n] = 0.0

    def weights(at) -> np.ndarray:
        own = z[at]
        rate = (options.beta + np.sqrt(squares[at])) / options.alpha + options.l2
        return np.where(np.abs(own) <= l1[at], 0.0, -(own - np.sign(own) * l1[at]) / rate)

    for _ in range(options.epochs):
        for at, label in zip(rows, labels):
            w = weights(at)
            gradient = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - label
            if abs(gradient) < 1e-4:
                continue
            step = (np.sqrt(squares[at] + gradient**2) - np.sqrt(squares[at])) / options.alpha
            z[at] += gradient - step * w
            squares[at] += gradient**2
    final = weights(np.arange(n + 1))
    used = np.flatnonzero(final[:n])
    return Model(options.bits, options.skips, options.stems, used.astype(np.int32), final[used], float(final[n]))


def labelled_sample(documents: DataFrame, labels: DataFrame, label: str, most: int) -> DataFrame:
    """At most ``most`` labelled documents, ``text`` and ``label``, by the smallest hash of their id.

    An id whose label rows or texts differ is left out. ``labels`` holds only rows that may be learnt from.
    """
    chosen = (
        labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.min(label).alias("label"), F.max(label).alias("_other"))
        .where("label = _other")
        .orderBy(F.xxhash64(F.col("doc_id").cast("string")), "doc_id")
        .limit(most)
        .select("doc_id", "label")
    )
    texts = documents.select("doc_id", text_of().alias("text")).join(F.broadcast(chosen), "doc_id")
    # Rows of one id share a label; one text stands for the id, so copies of a row weigh no more than the row.
    return texts.groupBy("doc_id").agg(F.min("text").alias("text"), F.max("text").alias("_other"), F.first("label").alias("label")).where(
        "text = _other"
    ).select("doc_id", "text", "label")


def fit(spark: SparkSession, sample: DataFrame, options: Ftrl = Ftrl()) -> Model | None:
    """Learns in one task from the sample, whose size ``options.sample`` bounds. None when no row or only one
    label is there."""

    def train(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted(
            (xxhash.xxh64_intdigest(str(i), 1), i, t, y)
            for b in batches
            for i, t, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist())
        )
        if len({r[3] for r in rows}) < 2:
            return
        m = learn([r[2] for r in rows], [int(r[3]) for r in rows], options)
        yield pa.RecordBatch.from_pydict({"places": [m.places.tobytes()], "weights": [m.weights.tobytes()], "bias": [m.bias]})

    rows = sample.select("doc_id", "text", "label").coalesce(1).mapInArrow(train, "places binary, weights binary, bias double").collect()
    if not rows:
        return None
    m = rows[0]
    return Model(options.bits, options.skips, options.stems, np.frombuffer(m.places, np.int32), np.frombuffer(m.weights, np.float64), m.bias)


def score_batches(batches: Iterable[pa.RecordBatch], model: Model, kept: list[str], text: str) -> Iterator[pa.RecordBatch]:
    """The columns ``kept`` and ``score`` of the column ``text``."""
    features = Features(model.bits, model.skips, model.stems)
    for batch in batches:
        for at in range(0, batch.num_rows, DOCUMENTS_PER_BATCH):
            part = batch.slice(at, DOCUMENTS_PER_BATCH)
            texts = part.column(text)
            pairs = np.concatenate([model.pairs(features, texts.slice(k, LISTED).to_pylist(), k) for k in range(0, len(texts), LISTED)])
            got = model.score(pairs & ((1 << model.bits) - 1), np.bincount(pairs >> model.bits, minlength=len(texts)))
            yield pa.RecordBatch.from_arrays([*[part.column(c) for c in kept], pa.array(got, pa.float64())], [*kept, "score"])


def score(documents: DataFrame, model: Model | None, text_column: str = "text") -> DataFrame:
    """Adds ``score`` from 0 to 1, higher the likelier toxic, of the whole text.

    The weights of all features of a text add up, each occurrence of a feature counting once per text. A null
    or empty text has the bias alone. Without a model (nothing to learn from) every score is 0. Rows, repeated
    ones too, and columns stay; a column ``score`` is replaced. One pass without a shuffle.
    """
    kept, own_text = [c for c in documents.columns if c.lower() != "score"], private(documents, "text")
    if model is None:
        return documents.select(*kept, F.lit(0.0).alias("score"))
    shared = documents.sparkSession.sparkContext.broadcast(model)
    schema = documents.select(*kept, F.lit(0.0).alias("score")).schema

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from score_batches(batches, shared.value, kept, own_text)

    return documents.select(*kept, text_of(text_column).alias(own_text)).mapInArrow(run, schema)
