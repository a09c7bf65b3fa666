"""BPE encoding and decoding with an index from each pair to all its positions."""

from __future__ import annotations

import heapq
import json
import unicodedata
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from tidewatch.llm.common import struct, text_of

# Words whose codes a worker keeps; beyond it the cache starts anew, which costs time only.
CACHED_WORDS = 300_000
DOCUMENTS_PER_BATCH = 256


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte: itself where it prints, else one from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(shown)]
    table = {b: chr(b) for b in shown} | {b: chr(0x100 + i) for i, b in enumerate(rest)}
    return [table[b] for b in range(256)]


class Model:
    """A word-level BPE tokenizer file: NFC and lower case, words found by a pattern, bytes as characters,
    an end-of-word mark, and added tokens taken from the text as they stand."""

    def __init__(self, definition: str):
        spec = json.loads(definition)
        model = spec["model"]
        self.end = model["end_of_word_suffix"] or ""
        self.vocab: dict[str, int] = model["vocab"]
        self.names = {i: t for t, i in self.vocab.items()}
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.names |= {i: t for t, i in self.added.items()}
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.words = regex.compile(split["pattern"]["Regex"]).findall
        self.parts = regex.compile("(" + "|".join(map(regex.escape, self.added)) + ")").split if self.added else lambda t: [t]
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        #: What each rank joins, and the rank of each pair.
        self.joins = [(self.vocab[a], self.vocab[b], self.vocab[a + b]) for a, b in merges]
        self.ranks = {a << 32 | b: r for r, (a, b, _) in reversed(list(enumerate(self.joins)))}
        alphabet = byte_alphabet()
        self.first = [self.vocab[c] for c in alphabet]
        self.last = [self.vocab[c + self.end] for c in alphabet]
        self.codes: dict[str, tuple[bytes, str]] = {}

    def encode_words(self, words: Iterable[str]) -> Iterator[tuple[str, list[int]]]:
        """Codes of distinct words, all merged together.

        Every pair that some rank joins maps to all its positions. Ranks with positions wait in a heap and
        are applied in ascending order; a join drops the two pairs it breaks (they are seen to be stale when
        their turn comes) and adds the two it makes to their lists. Words share nothing, so this gives each
        word the joins it would get alone. A join that makes a pair of lower rank puts what is left of its
        own list back and lets that one go first.
        """
        ranks, joins = self.ranks, self.joins
        symbols: list[int] = []
        after: list[int] = []
        before: list[int] = []
        starts: list[tuple[str, int]] = []
        index: dict[int, list[int]] = {}
        for word in words:
            data = word.encode()
            at = len(symbols)
            starts.append((word, at))
            own = [self.first[b] for b in data]
            own[-1] = self.last[data[-1]]
            symbols += own
            before.append(-1)
            before.extend(range(at, at + len(own) - 1))
            after.extend(range(at + 1, at + len(own)))
            after.append(-1)
            for i in range(len(own) - 1):
                rank = ranks.get(own[i] << 32 | own[i + 1])
                if rank is not None:
                    index.setdefault(rank, []).append(at + i)
        heap = list(index)
        heapq.heapify(heap)
        while heap:
            rank = heapq.heappop(heap)
            places = index.pop(rank, None)
            if places is None:
                continue
            left, right, joined = joins[rank]
            if len(places) > 1:
                places.sort()
            for k, i in enumerate(places):
                j = after[i]
                if j < 0 or symbols[i] != left or symbols[j] != right:
                    continue
                symbols[i], symbols[j] = joined, -1
                n, p = after[j], before[i]
                after[i] = n
                lowest = rank
                if n >= 0:
                    before[n] = i
                    new = ranks.get(joined << 32 | symbols[n])
                    if new is not None:
                        if new in index:
                            index[new].append(i)
                        else:
                            index[new] = [i]
                            heapq.heappush(heap, new)
                        lowest = min(lowest, new)
                if p >= 0:
                    new = ranks.get(symbols[p] << 32 | joined)
                    if new is not None:
                        if new in index:
                            index[new].append(p)
                        else:
                            index[new] = [p]
                            heapq.heappush(heap, new)
                        lowest = min(lowest, new)
                if lowest < rank and k + 1 < len(places):
                    index.setdefault(rank, []).extend(places[k + 1 :])
                    heapq.heappush(heap, rank)
                    break
        for word, at in starts:
            codes = []
            while at >= 0:
                codes.append(symbols[at])
                at = after[at]
            yield word, codes

    def pieces(self, text: str) -> list[str]:
        """Words and added tokens of a text in order."""
        found: list[str] = []
        for i, part in enumerate(self.parts(text)):
            if i % 2:
                found.append(part)
            elif part:
                part = part if part.isascii() else unicodedata.normalize("NFC", part)
                # By character: no letter's lower case depends on its neighbours.
                part = part.lower() if "Σ" not in part else "".join(c.lower() for c in part)
                found += self.words(part)
        return found

    def encode_batch(self, texts: list[str]) -> Iterator[tuple[bytes, str]]:
        """Ids (little-endian unsigned 32-bit) and their decoded text, for each text."""
        if len(self.codes) > CACHED_WORDS:
            self.codes = {}
        if not self.codes:
            self.codes |= {t: (array("I", [i]).tobytes(), t) for t, i in self.added.items()}
        cut = [self.pieces(t) for t in texts]
        new = {w for words in cut for w in words if w not in self.codes}
        for word, ids in self.encode_words(new):
            self.codes[word] = array("I", ids).tobytes(), self.decode(ids)
        for words in cut:
            known = [self.codes[w] for w in words]
            yield b"".join([k[0] for k in known]), " ".join([k[1] for k in known])

    def decode(self, ids: Iterable[int]) -> str:
        """The tokens' texts with a blank between, as the file names no decoder."""
        return " ".join([self.names[i] for i in ids])


@lru_cache(maxsize=2)
def model_of(definition: str) -> Model:
    return Model(definition)


def encode(documents: DataFrame, tokenizer_path: str, text_column: str = "text") -> DataFrame:
    """Adds ``ids`` (binary: little-endian unsigned 32-bit codes) and ``decoded`` (the text these ids decode to).

    A null text counts as empty; an empty text has no ids and decodes to the empty text. Rows stay as they
    are, repeated ones included, and columns of the names ``ids`` and ``decoded`` are replaced. Added tokens
    written out in a text become their id.

    One pass without a shuffle. The tokenizer file (bounded by its vocabulary) is broadcast. Every Arrow
    batch is one set of words for :meth:`Model.encode_words`; a word costs its work once per batch, and a
    worker remembers at most ``CACHED_WORDS`` words.
    """
    with open(tokenizer_path, encoding="utf-8") as file:
        definition = documents.sparkSession.sparkContext.broadcast(file.read())
    kept = [c for c in documents.columns if c not in ("ids", "decoded", "_text")]
    rows = documents.select(*kept, text_of(text_column).alias("_text"))
    schema = documents.select(*kept, F.lit(b"").alias("ids"), F.lit("").alias("decoded")).schema

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = model_of(definition.value)
        for batch in batches:
            for at in range(0, batch.num_rows, DOCUMENTS_PER_BATCH):
                part = batch.slice(at, DOCUMENTS_PER_BATCH)
                found = list(model.encode_batch(part.column("_text").to_pylist()))
                arrays = [part.column(c) for c in kept]
                arrays += [pa.array([f[0] for f in found], pa.binary()), pa.array([f[1] for f in found], pa.string())]
                yield pa.RecordBatch.from_arrays(arrays, [*kept, "ids", "decoded"])

    return rows.mapInArrow(run, schema)


def decode(encoded: DataFrame, tokenizer_path: str, ids_column: str = "ids") -> DataFrame:
    """Adds ``decoded`` for a column of ids as :func:`encode` makes it; null ids give null."""
    with open(tokenizer_path, encoding="utf-8") as file:
        definition = encoded.sparkSession.sparkContext.broadcast(file.read())
    kept = [c for c in encoded.columns if c != "decoded"]
    schema = struct("decoded string")
    for field in reversed(encoded.select(*kept).schema.fields):
        schema.fields.insert(0, field)
    schema.names = [f.name for f in schema.fields]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = model_of(definition.value)
        for batch in batches:
            texts = [None if v is None else model.decode(array("I", v)) for v in batch.column(ids_column).to_pylist()]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], pa.array(texts, pa.string())], [*kept, "decoded"])

    return encoded.select(*kept).mapInArrow(run, schema)
