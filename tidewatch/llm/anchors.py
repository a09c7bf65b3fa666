"""Repeated word windows by fixed-block anchors."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from tidewatch.llm.common import struct, table

#: Bytes of text that are hashed, and deduplicated before a shuffle, at a time. A longer text is a unit of its own.
UNIT = 4 << 20
#: Bytes of text whose window hashes meet in one group.
BUCKET = 16 << 20
#: Bytes that are hashed in one step.
STEP = 1 << 20
#: Longer words are hashed by a cryptographic digest, shorter ones by a polynomial.
LONG_WORD = 64

SEPARATOR = np.zeros(256, bool)
SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
_RANDOM = np.random.default_rng(20_240_117)
LETTERS = _RANDOM.integers(0, 1 << 63, (2, 256), np.uint64) * np.uint64(2) + np.uint64(1)
BASES = [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F]
KEY_BITS = 38
#: Bytes of a window's hash, with one bit for a flag.
WINDOW_BYTES = 12


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Powers:
    """Powers of an odd number and of its inverse, modulo 2 to the 64."""

    def __init__(self, base: int) -> None:
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            self.up, self.down = (np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, b, np.uint64)])) for b in (self.base, self.inverse))
        return self.up, self.down


POWERS = [Powers(b) for b in BASES]


def sums_between(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, powers: Powers) -> np.ndarray:
    """The polynomial of ``values[start:end]`` for each pair."""
    up, down = powers.to(len(values))
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[: len(values)], out=total[1:])
    return (total[ends] - total[starts]) * down[starts]


def pieces_of(text: bytes) -> Iterator[bytes]:
    """``text`` in steps that end at a separator."""
    at = 0
    while at < len(text):
        end = at + STEP
        while end < len(text) and not SEPARATOR[text[end]]:
            end += 1
        yield text[at:end]
        at = end


def hashes_of(buffer: bytes, lanes: int) -> np.ndarray:
    """One column per word of ``buffer``, one row per lane."""
    letters = np.frombuffer(buffer, np.uint8)
    inside = np.zeros(len(letters) + 2, np.int8)
    inside[1:-1] = ~SEPARATOR[letters]
    edges = np.diff(inside)
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    out = np.stack([mixed(sums_between(LETTERS[k][letters], starts, ends, POWERS[k]) + (ends - starts).astype(np.uint64)) for k in range(lanes)])
    for i in np.flatnonzero(ends - starts > LONG_WORD):
        digest = hashlib.blake2b(buffer[starts[i] : ends[i]], digest_size=16).digest()
        out[:, i] = np.frombuffer(digest, np.uint64)[:lanes]
    return out


def words_of(texts: list[bytes], lanes: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, and where each text's words begin (with the end of the last)."""
    found, counts, waiting, size = [], [], [], 0

    def flush() -> None:
        nonlocal waiting, size
        if waiting:
            found.append(hashes_of(b"\n".join(waiting), lanes))
            waiting, size = [], 0

    for text in texts:
        counts.append(len(text.split()))
        for piece in pieces_of(text):
            waiting.append(piece)
            size += len(piece)
            if size >= STEP:
                flush()
    flush()
    hashes = np.concatenate(found, axis=1) if found else np.zeros((lanes, 0), np.uint64)
    return hashes, np.concatenate([[0], np.cumsum(counts, dtype=np.int64)]).astype(np.int64)


def gram_hashes(words: np.ndarray, length: int, lane: int) -> np.ndarray:
    starts = np.arange(max(len(words) - length + 1, 0))
    return mixed(sums_between(words, starts, starts + length, POWERS[lane]))


def positions(bounds: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Where windows of ``length`` words that stay in their text begin, and how far that is from the text's start."""
    sizes = np.diff(bounds)
    windows = np.maximum(sizes - length + 1, 0)
    within = np.arange(windows.sum()) - np.repeat(np.cumsum(windows) - windows, windows)
    return within + np.repeat(bounds[:-1], windows), within


def bucket_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)


def keys_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """What identifies a block: its bucket and the low bits of its hash. Buckets hold about the same at every size of
    the corpus, so the chance of a false anchor, which only costs work, stays the same as well."""
    return (bucket_of(hashes, buckets) << np.uint64(KEY_BITS)) | (hashes & np.uint64((1 << KEY_BITS) - 1))


def texts_in(rows: pa.RecordBatch | pa.Table, name: str) -> list[bytes]:
    return [t or b"" for t in rows.column(name).cast(pa.binary()).to_pylist()]


def deal(documents: DataFrame, text_column: str) -> DataFrame:
    """Adds ``_unit``, a number shared by consecutive rows of at most ``UNIT`` bytes of text, and ``_bytes``."""

    most = UNIT

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, left = TaskContext.get().partitionId() << 33, most
        for batch in batches:
            units, sizes = [], [len(t) for t in texts_in(batch, text_column)]
            for size in sizes:
                left -= size
                if left < 0:
                    unit, left = unit + 1, most - size
                units.append(unit)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(units, pa.int64()), pa.array(sizes, pa.int64())], [*batch.schema.names, "_unit", "_bytes"])

    return documents.mapInArrow(run, StructType([*documents.schema, *struct("_unit bigint, _bytes bigint")]))


def per_bucket(unit: int, buckets: np.ndarray, packed: np.ndarray) -> Iterator[tuple[int, int, bytes]]:
    """Rows ``(bucket, unit, bytes)`` from rows of bytes in order of their buckets."""
    cuts = np.flatnonzero(np.diff(buckets)) + 1
    for start, end in zip([0, *cuts.tolist()], [*cuts.tolist(), len(buckets)]):
        if end > start:
            yield int(buckets[start]), unit, packed[start:end].tobytes()


PACKED = "bucket bigint, unit bigint, packed binary"


def packed_rows(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [(), (), ()]
    return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.binary())], ["bucket", "unit", "packed"])


def probes(units: DataFrame, text_column: str, block: int, buckets: int) -> DataFrame:
    """Every rolling window of ``block`` words, once per unit: its key, whether it is one of the non-overlapping
    reference blocks of a text of the unit, and whether the unit holds it more than once."""

    def of_unit(unit: int, texts: list[bytes]) -> Iterator[tuple[int, int, bytes]]:
        words, bounds = words_of(texts, 1)
        at, within = positions(bounds, block)
        if not len(at):
            return
        hashes = gram_hashes(words[0], block, 0)[at]
        distinct, counts = np.unique(hashes, return_counts=True)
        indexed = np.zeros(len(distinct), bool)
        indexed[np.searchsorted(distinct, hashes[within % block == 0])] = True
        value = (keys_of(distinct, buckets) & np.uint64((1 << KEY_BITS) - 1)) << np.uint64(2)
        value |= (indexed.astype(np.uint64) << np.uint64(1)) | (counts > 1).astype(np.uint64)
        yield from per_bucket(unit, bucket_of(distinct, buckets), value.view(np.uint8).reshape(-1, 8)[:, :5])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, numbers = texts_in(batch, text_column), batch.column("_unit").to_pylist()
            start = 0
            for end in range(1, len(numbers) + 1):
                if end == len(numbers) or numbers[end] != numbers[start]:
                    yield packed_rows(list(of_unit(numbers[start], texts[start:end])))
                    start = end

    return units.select("_unit", text_column).mapInArrow(run, PACKED)


def answers(packed: DataFrame, find: Callable[[pa.Table], list[tuple[int, int, bytes]]]) -> DataFrame:
    """What ``find`` answers to the units of each bucket."""
    return packed.groupBy("bucket").applyInArrow(lambda rows: pa.Table.from_batches([packed_rows(find(rows))]), PACKED)


def by_entry(rows: pa.Table, width: int) -> tuple[np.ndarray, np.ndarray]:
    """All entries of a bucket as rows of bytes, and the row of the table each is from."""
    packed = rows.column("packed").to_pylist()
    entries = np.frombuffer(b"".join(packed), np.uint8).reshape(-1, width)
    return entries, np.repeat(np.arange(len(packed)), [len(p) // width for p in packed])


def anchors_in(rows: pa.Table) -> list[tuple[int, int, bytes]]:
    """The keys of the bucket that are a reference block of some text and stand at two places at least, for the units
    that hold them: the keys' low bits, five bytes each."""
    entries, owner = by_entry(rows, 5)
    key = wide(entries) >> np.uint64(2)
    _, group, counts = np.unique(key, return_inverse=True, return_counts=True)
    indexed = np.bincount(group, (entries[:, 0] & 2).astype(np.float64)) > 0
    several = (counts > 1) | (np.bincount(group, (entries[:, 0] & 1).astype(np.float64)) > 0)
    at = np.flatnonzero((indexed & several)[group])
    low = narrow(key[at])
    bucket, units, out = rows.column("bucket")[0].as_py(), rows.column("unit").to_pylist(), []
    cuts = np.searchsorted(owner[at], np.arange(len(units) + 1))
    for i, unit in enumerate(units):
        if cuts[i] < cuts[i + 1]:
            out.append((bucket, unit, low[cuts[i] : cuts[i + 1]].tobytes()))
    return out


def wide(entries: np.ndarray) -> np.ndarray:
    """Rows of five bytes as numbers."""
    value = np.zeros((len(entries), 8), np.uint8)
    value[:, :5] = entries
    return value.reshape(-1).view(np.uint64)


def narrow(values: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(values).view(np.uint8).reshape(-1, 8)[:, :5]


def keys_in(answered: pa.Table) -> np.ndarray:
    """The keys of a unit's anchors, sorted, from the answers of the buckets."""
    keys = [
        (np.uint64(bucket) << np.uint64(KEY_BITS)) | wide(np.frombuffer(packed, np.uint8).reshape(-1, 5))
        for bucket, packed in zip(answered.column("bucket").to_pylist(), answered.column("packed").to_pylist())
    ]
    return np.unique(np.concatenate(keys)) if keys else np.zeros(0, np.uint64)


def grouped(both: np.ndarray) -> tuple[np.ndarray, int]:
    """A number per row, the same for equal rows, and how many there are."""
    order = np.lexsort((both[:, 1], both[:, 0]))
    new = np.zeros(len(order), np.int64)
    new[1:] = (both[order[1:]] != both[order[:-1]]).any(axis=1)
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(new)
    return group, int(new.sum()) + 1 if len(order) else 0


def repeated_in(rows: pa.Table) -> list[tuple[int, int, bytes]]:
    """Which of each unit's windows of the bucket stand at two places at least: a bit for each, in the unit's order."""
    entries, owner = by_entry(rows, WINDOW_BYTES)
    value = np.zeros((len(entries), 16), np.uint8)
    value[:, :WINDOW_BYTES] = entries
    both = value.view(np.uint64)
    flag = both[:, 1] & np.uint64(1)
    both[:, 1] >>= np.uint64(1)
    group, _ = grouped(both)
    several = ((np.bincount(group) > 1) | (np.bincount(group, flag.astype(np.float64)) > 0))[group]
    bucket, cuts = rows.column("bucket")[0].as_py(), np.searchsorted(owner, np.arange(len(rows) + 1))
    return [
        (bucket, unit, np.packbits(several[cuts[i] : cuts[i + 1]]).tobytes()) for i, unit in enumerate(rows.column("unit").to_pylist())
    ]


class Candidates:
    """The windows of a unit that an anchor hit extends to."""

    def __init__(self, texts: list[bytes], anchors: np.ndarray, window: int, block: int, buckets: int) -> None:
        words, self.bounds = words_of(texts, 2 if len(anchors) else 1)
        self.at, _ = positions(self.bounds, window)
        if not len(anchors) or not len(self.at):
            self.at = self.at[:0]
            return
        keys = keys_of(gram_hashes(words[0], block, 0), buckets)
        hits = np.zeros(len(keys) + 1, np.int64)
        np.cumsum(anchors[np.minimum(np.searchsorted(anchors, keys), len(anchors) - 1)] == keys, out=hits[1:])
        # A window's blocks begin at its first word to its last but block - 1; all of them lie in its text.
        self.at = self.at[hits[self.at + window - block + 1] > hits[self.at]]
        both = np.stack([gram_hashes(words[k], window, k)[self.at] for k in (0, 1)], axis=1)
        both[:, 1] &= np.uint64((1 << (8 * WINDOW_BYTES - 65)) - 1)
        self.group, n = grouped(both)
        self.distinct = np.empty((n, 2), np.uint64)
        self.distinct[self.group] = both
        self.bucket = bucket_of(self.distinct[:, 0], buckets)

    def packed(self) -> np.ndarray:
        """The distinct windows in order: their hash, and a bit for those that the unit holds more than once."""
        value = self.distinct.copy()
        value[:, 1] = (value[:, 1] << np.uint64(1)) | (np.bincount(self.group, minlength=len(value)) > 1).astype(np.uint64)
        return value.view(np.uint8).reshape(-1, 16)[:, :WINDOW_BYTES]

    def repeated(self, bits: dict[int, bytes]) -> np.ndarray:
        """Where the windows begin for which their bucket has set a bit."""
        if not len(self.at):
            return self.at
        marks = np.zeros(len(self.distinct), bool)
        for bucket, packed in bits.items():
            own = slice(*np.searchsorted(self.bucket, [np.uint64(bucket), np.uint64(bucket + 1)]))
            marks[own] = np.unpackbits(np.frombuffer(packed, np.uint8), count=own.stop - own.start).astype(bool)
        return self.at[marks[self.group]]


def remove_repeats(documents: DataFrame, text_column: str = "text", window: int = 35, block: int = 18) -> DataFrame:
    """Removes each word that a window of ``window`` words covers whose word sequence also starts anywhere else, in the
    same document or another.

    ``documents`` with ``n_words``, ``n_removed``, ``kept`` (the words left, joined by one space) and ``spans`` (the
    removed runs: ``start`` and ``end`` in words). Words are runs of bytes other than 0x20 and 0x09 to 0x0D. Windows
    are judged on the input: all occurrences of a repeated window go, overlapping ones too.

    A null text and one without words have no words, nothing removed and an empty ``kept``. Repeated rows repeat each
    other's windows, whatever their ids, null ones too. An empty table gives an empty result. All columns are kept;
    one that has the name of a result column, or is called ``_unit`` or ``_bytes``, is an error.

    Every text is cut into non-overlapping reference blocks of ``block`` words, and every rolling window of that
    length probes them. As ``window >= 2 * block - 1``, a repeated window holds a whole reference block of any text
    it stands in, and that block's words stand in all its occurrences: so every occurrence holds an anchor, a block
    that is indexed and stands twice. Hits extend to the windows around them; those that stand twice join to
    maximal repeats. No pairs of occurrences are made: a group of copies costs what it holds.

    Texts are dealt into units; a unit sends each distinct hash once to its bucket, and buckets, about ``BUCKET`` bytes
    of text each at every size, answer the units. So a passage in a third of all rows reaches its bucket once per
    unit. Windows are told apart by their bucket and 95 bits of hash, blocks by
    fewer, as a false anchor changes nothing.
    """
    if not 1 <= block <= (window + 1) // 2:
        raise ValueError("a window must hold a whole block wherever it begins: window >= 2 * block - 1")
    clashes = {"n_words", "n_removed", "kept", "spans", "_unit", "_bytes"} & {c.lower() for c in documents.columns}
    if clashes:
        raise ValueError(f"columns of these names would be lost: {sorted(clashes)}")
    spark = documents.sparkSession
    units = table(deal(documents, text_column), "anchor-units", "zstd")
    size = units.agg(F.sum("_bytes")).first()[0] or 0
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // BUCKET))

    def candidates(rows: pa.Table, answered: pa.Table) -> pa.Table:
        found = Candidates(texts_in(rows, text_column), keys_in(answered), window, block, buckets)
        spread = per_bucket(rows.column("_unit")[0].as_py(), found.bucket, found.packed()) if len(found.at) else []
        return pa.Table.from_batches([packed_rows(list(spread))])

    added = struct("n_words bigint, n_removed bigint, kept string, spans array<struct<start:bigint,end:bigint>>")
    schema = StructType([*documents.schema, *added])

    def cut(rows: pa.Table, answered: pa.Table) -> pa.Table:
        texts = texts_in(rows, text_column)
        of_windows = answered.column("windows")
        bits = answered.filter(of_windows)
        found = Candidates(texts, keys_in(answered.filter(pc.invert(of_windows))), window, block, buckets)
        at = found.repeated(dict(zip(bits.column("bucket").to_pylist(), bits.column("packed").to_pylist())))
        bounds = found.bounds
        change = np.zeros(bounds[-1] + 1, np.int64)
        change[at] += 1
        change[at + window] -= 1
        gone = np.cumsum(change[:-1]) > 0
        removed = np.concatenate([[0], np.cumsum(gone)])
        n_words, n_removed = np.diff(bounds), removed[bounds[1:]] - removed[bounds[:-1]]
        kept, spans = [], []
        for text, start, end, n in zip(texts, bounds[:-1].tolist(), bounds[1:].tolist(), n_removed.tolist()):
            own = text.split()
            mask = gone[start:end]
            kept.append(b" ".join(compress(own, (~mask).tolist()) if n else own))
            edges = np.diff(np.concatenate([[0], mask.view(np.int8), [0]])) if n else np.zeros(0, np.int8)
            spans.append([{"start": s, "end": e} for s, e in zip(np.flatnonzero(edges == 1).tolist(), np.flatnonzero(edges == -1).tolist())])
        out = rows.drop_columns(["_unit"])
        for name, values in (("n_words", pa.array(n_words)), ("n_removed", pa.array(n_removed)), ("kept", pa.array(kept, pa.binary()).cast(pa.string())),
                             ("spans", pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))))):
            out = out.append_column(name, values)
        return out

    def with_answers(rows: DataFrame, found: DataFrame, fn: Callable, result: StructType | str) -> DataFrame:
        return rows.groupBy("_unit").cogroup(found.withColumnRenamed("unit", "_unit").groupBy("_unit")).applyInArrow(fn, result)

    found = table(answers(probes(units, text_column, block, buckets), anchors_in), "anchor-blocks")
    spread = with_answers(units.select("_unit", text_column), found, candidates, PACKED)
    twice = table(answers(spread, repeated_in), "anchor-repeats")
    both = found.withColumn("windows", F.lit(False)).unionByName(twice.withColumn("windows", F.lit(True)))
    return with_answers(units.drop("_bytes"), both, cut, schema)
