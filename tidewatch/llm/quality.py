"""Quality scores by nearest-neighbour voting over latent-semantic vectors."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from tidewatch.llm.common import private, text_of

DOCUMENTS_PER_BATCH = 512
CACHED_TOKENS = 150_000
#: Runs of letters, digits and marks that make a token's shape.
RUNS = ((re.compile(r"[^\W\d_]+"), None), (re.compile(r"\d+"), "0"), (re.compile(r"([^\w\s])\1+"), r"\1\1"))


@dataclass(frozen=True)
class Options:
    """``per_label``: at most so many labelled rows of each label are voters, those of the smallest hash of
    their id. ``terms``: places of the hashed terms, the first ``marks`` of them for shapes and repeats.
    ``rank``: latent dimensions. ``neighbours``: votes per document. ``looks_back``: a token equal to one
    of so many before it counts as a repeat."""

    per_label: int = 2000
    terms: int = 4096
    marks: int = 512
    rank: int = 64
    neighbours: int = 7
    looks_back: int = 4


def shape_of(token: str) -> str:
    """A token with its letters as ``A``, ``Aa`` or ``a``, digits as ``0`` and repeated marks as two."""

    def letters(run: re.Match) -> str:
        text = run.group()
        return ("A" if len(text) > 1 else "I") if text.isupper() else "Aa" if text[0].isupper() else "a"

    token = RUNS[0][0].sub(letters, token)
    return RUNS[2][0].sub(RUNS[2][1], RUNS[1][0].sub(RUNS[1][1], token))


class Terms:
    """Counts of hashed terms: each token's letters in lower case, its shape, and whether it repeats."""

    def __init__(self, options: Options):
        self.o = options
        self.rows: dict[str, int] = {}
        self.places = np.zeros((1024, 2), np.int32)

    def row_of(self, token: str) -> int:
        row = self.rows[token] = len(self.rows)
        if row >= len(self.places):
            self.places = np.concatenate((self.places, np.zeros_like(self.places)))
        o = self.o
        word = "".join(filter(str.isalnum, token.lower())) or token
        marks = o.marks - o.looks_back
        self.places[row] = o.marks + xxhash.xxh64_intdigest(word) % (o.terms - o.marks), xxhash.xxh64_intdigest(shape_of(token)) % marks
        return row

    def counts(self, texts: list[str]) -> np.ndarray:
        """One row of counts per text, over the whole text."""
        o = self.o
        if len(self.rows) > CACHED_TOKENS:
            self.rows = {}
        rows, row_of = self.rows, self.row_of
        listed = [[rows[t] if t in rows else row_of(t) for t in text.split()] for text in texts]
        sizes = np.fromiter(map(len, listed), np.int64, len(listed))
        tokens = np.fromiter(chain.from_iterable(listed), np.int64, int(sizes.sum()))
        owner = np.repeat(np.arange(len(texts)) * o.terms, sizes)
        cells = [owner + self.places[tokens, 0], owner + self.places[tokens, 1]]
        for back in range(1, o.looks_back + 1):
            same = (tokens[back:] == tokens[:-back]) & (owner[back:] == owner[:-back])
            cells.append(owner[back:][same] + (o.marks - back))
        return np.bincount(np.concatenate(cells), minlength=len(texts) * o.terms).reshape(len(texts), o.terms)


def weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    rows = np.log1p(counts).astype(np.float32) * idf
    norms = np.linalg.norm(rows, axis=1, keepdims=True)
    return np.divide(rows, norms, out=np.zeros_like(rows), where=norms > 0)


def unit(rows: np.ndarray) -> np.ndarray:
    norms = np.linalg.norm(rows, axis=1, keepdims=True)
    return np.divide(rows, norms, out=np.zeros_like(rows), where=norms > 0)


@dataclass
class Voters:
    """Broadcast: term weights, the basis of the latent space and the voters in it. Its size follows from
    :class:`Options` alone: about 2 MB."""

    options: Options
    idf: np.ndarray
    basis: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray

    def score(self, rows: np.ndarray) -> np.ndarray:
        """Share of label 1 among each row's nearest voters, weighted by their cosine. A row like none of
        them gets the voters' mean."""
        cosines = unit(rows @ self.basis) @ self.vectors.T
        k = min(self.options.neighbours, cosines.shape[1])
        near = np.argpartition(cosines, -k, axis=1)[:, -k:]
        weights = np.maximum(np.take_along_axis(cosines, near, 1), 0).astype(np.float64)
        total = weights.sum(1)
        votes = (weights * self.labels[near]).sum(1)
        return np.divide(votes, total, out=np.full(len(rows), self.labels.mean()), where=total > 1e-9)


def term_weights(documents: DataFrame, options: Options) -> np.ndarray:
    """Inverse document frequency of every term place over all documents; one number per place reaches the driver."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, seen, n = Terms(options), np.zeros(options.terms, np.int64), 0
        for batch in batches:
            for at in range(0, batch.num_rows, DOCUMENTS_PER_BATCH):
                counts = terms.counts(batch.column(0).slice(at, DOCUMENTS_PER_BATCH).to_pylist())
                seen += (counts > 0).sum(0)
                n += len(counts)
        if n:
            yield pa.RecordBatch.from_pydict({"seen": pa.array([[n, *seen]], pa.list_(pa.int64()))})

    parts = documents.select(text_of().alias("text")).mapInArrow(run, "seen array<bigint>")
    found = parts.select(F.posexplode("seen").alias("place", "n")).groupBy("place").agg(F.sum("n").alias("n")).collect()
    seen = np.zeros(options.terms + 1)
    for row in found:
        seen[row.place] = row.n
    return np.log((1 + seen[0]) / (1 + seen[1:])).astype(np.float32) + 1


def latent_basis(rows: np.ndarray, rank: int) -> np.ndarray:
    """Leading right singular vectors by randomised subspace iteration."""
    rng = np.random.default_rng(7)
    own = min(rank, *rows.shape)
    q = np.linalg.qr(rows @ rng.standard_normal((rows.shape[1], min(own + 16, *rows.shape))).astype(np.float32))[0]
    for _ in range(4):
        q = np.linalg.qr(rows @ np.linalg.qr(rows.T @ q)[0])[0]
    return np.ascontiguousarray(np.linalg.svd(q.T @ rows, full_matrices=False)[2][:own].T)


def labelled_sample(documents: DataFrame, labels: DataFrame, options: Options) -> DataFrame:
    """The voters' ``doc_id``, ``text`` and ``label``: at most ``per_label`` of each label. An id whose label
    rows or texts differ is left out."""
    sure = (
        labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.min("quality").alias("label"), F.max("quality").alias("_other"))
        .where("label = _other")
    )
    # A limit for each label keeps its best rows in every task; a window would gather a label in one.
    by_hash = [F.xxhash64(F.col("doc_id").cast("string")), F.col("doc_id")]
    poor, good = (sure.where(F.col("label") == y).orderBy(*by_hash).limit(options.per_label) for y in (0, 1))
    chosen = poor.unionByName(good).select("doc_id", "label")
    texts = documents.select("doc_id", text_of().alias("text")).join(F.broadcast(chosen), "doc_id")
    own = texts.groupBy("doc_id").agg(F.min("text").alias("text"), F.max("text").alias("_other"), F.first("label").alias("label"))
    return own.where("text = _other").select("doc_id", "text", "label")


def fit(documents: DataFrame, sample: DataFrame, options: Options = Options()) -> Voters | None:
    """The latent space and its voters, from a sample that ``per_label`` bounds; term weights come from all
    documents. None without labelled rows."""
    idf = term_weights(documents, options)

    def build(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted(r for b in batches for r in zip(*(b.column(i).to_pylist() for i in range(3))))
        if not rows:
            return
        terms = Terms(options)
        cut = [weighted(terms.counts([r[1] for r in rows[i : i + 256]]), idf) for i in range(0, len(rows), 256)]
        matrix = np.concatenate(cut)
        basis = latent_basis(matrix, options.rank)
        vectors = unit(matrix @ basis)
        yield pa.RecordBatch.from_pydict({
            "basis": [basis.tobytes()], "vectors": [vectors.tobytes()], "labels": [np.array([r[2] for r in rows], np.float64).tobytes()],
        })

    found = sample.select("doc_id", "text", "label").coalesce(1).mapInArrow(build, "basis binary, vectors binary, labels binary").collect()
    if not found:
        return None
    labels = np.frombuffer(found[0].labels, np.float64)
    basis = np.frombuffer(found[0].basis, np.float32).reshape(options.terms, -1)
    return Voters(options, idf, basis, np.frombuffer(found[0].vectors, np.float32).reshape(len(labels), -1), labels)


def score(documents: DataFrame, voters: Voters | None, text_column: str = "text") -> DataFrame:
    """Adds ``score`` from 0 to 1, higher the likelier good, of the whole text.

    Each block of documents is multiplied with all voters, so the cosines are exact. A null, empty or blank
    text is like no voter and gets the voters' mean label; without voters every score is 1, as nothing speaks
    against a document. Rows, repeated ones too, and columns stay; a column ``score`` is replaced.
    One pass without a shuffle.
    """
    kept, own_text = [c for c in documents.columns if c.lower() != "score"], private(documents, "text")
    if voters is None:
        return documents.select(*kept, F.lit(1.0).alias("score"))
    shared = documents.sparkSession.sparkContext.broadcast(voters)
    schema = documents.select(*kept, F.lit(0.0).alias("score")).schema

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        terms = Terms(own.options)
        for batch in batches:
            for at in range(0, batch.num_rows, DOCUMENTS_PER_BATCH):
                part = batch.slice(at, DOCUMENTS_PER_BATCH)
                rows = weighted(terms.counts(part.column(own_text).to_pylist()), own.idf)
                got = np.clip(own.score(rows), 0.0, 1.0)
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in kept], pa.array(got, pa.float64())], [*kept, "score"])

    return documents.select(*kept, text_of(text_column).alias(own_text)).mapInArrow(run, schema)
