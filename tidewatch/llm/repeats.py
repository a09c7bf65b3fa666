"""Removal of repeated byte strings by prefix-free parsing."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidewatch.llm.common import drop_table, private, table, text_key, text_of

#: Repeated strings of this many bytes go.
LENGTH = 200
#: A trigger is a string of GRAM bytes with at least MARGIN bytes of its window on either side.
GRAM, MARGIN = 12, 34
REACH = LENGTH - 2 * MARGIN - GRAM + 1
NEAR, FAR = MARGIN, MARGIN + REACH - 1
#: Documents are parsed in pieces of about so many bytes.
PIECE = 1 << 20
#: Phrases sorted in one group. A context with more than FULL phrases is cut into narrower slices first.
GROUP, FULL = 20_000, 2_000
#: The rows of a context that stands more often than this in the corpus are joined and counted apart from the others.
HOT = 10_000
#: Widths of the slices, in windows: a slice of one window is one string, so no context stays full.
SLICES = (11, 1)
#: Suffixes sorted at once, as a power of two: a rank, the rank behind it and a place fit 64 bits.
PLACES = 20

_random = np.random.default_rng(20)
CODES = _random.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
STEP = int(_random.integers(1 << 62, 1 << 63)) | 1
BACK = pow(STEP, -1, 1 << 64)
MIX = np.uint64(0x9E3779B97F4A7C15)


def mixed(z: np.ndarray) -> np.ndarray:
    z = (z ^ (z >> np.uint64(32))) * MIX
    z = (z ^ (z >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return z ^ (z >> np.uint64(32))


class Rolling:
    """Rolling hashes of all substrings of some bytes, from prefix sums modulo 2**64."""

    powers = np.ones(1, np.uint64)
    inverse = np.ones(1, np.uint64)

    def __init__(self, data: np.ndarray):
        n = len(data) + 1
        if len(Rolling.powers) < n:
            size = max(n, 2 * len(Rolling.powers))
            for name, base in (("powers", STEP), ("inverse", BACK)):
                run = np.full(size, base, np.uint64)
                run[0] = 1
                setattr(Rolling, name, np.cumprod(run, dtype=np.uint64))
        self.sums = np.zeros(n, np.uint64)
        np.cumsum(CODES[data] * Rolling.powers[: n - 1], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.sums[end] - self.sums[start]) * Rolling.inverse[start] + (end - start).astype(np.uint64))


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest of every ``width`` neighbours, from running minima of blocks in both directions."""
    n = len(values)
    whole = -(-n // width) * width
    padded = np.full(whole, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).reshape(-1)
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


def parse(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """Phrases of the pieces of ``data``: piece, trigger, first and last window, hash of the trigger's context and
    of the phrase.

    A window is a string of LENGTH bytes. Its trigger is the GRAM bytes of the smallest rolling hash inside it
    (of equal ones the last), at least MARGIN bytes from both ends; it depends on the window's bytes alone, so
    equal windows have their triggers at the same place. The windows of one trigger are neighbours, and the bytes
    they cover are the trigger's phrase: every window lies whole in exactly one phrase.
    """
    empty = np.zeros(0, np.int64)
    if len(data) < LENGTH:
        return (empty,) * 4 + (empty.astype(np.uint64),) * 2
    rolling = Rolling(data)
    place = np.arange(len(data) - GRAM + 1)
    grams = rolling.of(place, place + GRAM)
    ranked = (grams & np.uint64(0xFFFFFFFF00000000)) | (np.uint64(0xFFFFFFFF) - place.astype(np.uint64))
    least = sliding_least(ranked, REACH)[MARGIN : len(data) - LENGTH + 1 + MARGIN]
    trigger = (np.uint64(0xFFFFFFFF) - (least & np.uint64(0xFFFFFFFF))).astype(np.int64)
    counts = np.maximum(ends - starts - LENGTH + 1, 0)
    piece = np.repeat(np.arange(len(starts)), counts)
    window = np.arange(len(piece)) - np.repeat(np.cumsum(counts) - counts, counts) + starts[piece]
    if not len(window):
        return (empty,) * 4 + (empty.astype(np.uint64),) * 2
    at = trigger[window]
    new = np.ones(len(at), bool)
    new[1:] = (at[1:] != at[:-1]) | (piece[1:] != piece[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(at)) - 1
    own, lo, hi = at[first], window[first], window[last]
    context = rolling.of(own - MARGIN, own + GRAM + MARGIN)
    phrase = mixed(rolling.of(lo, hi + LENGTH) + (own - lo).astype(np.uint64) * MIX)
    return piece[first], own, lo, hi, context, phrase


def pieces_of(texts: list[str]) -> Iterator[list[tuple[int, int, bytes]]]:
    """Batches of (text number, offset, bytes) of about PIECE bytes; a long text's pieces share LENGTH - 1 bytes."""
    batch, size = [], 0
    for i, text in enumerate(texts):
        data = text.encode()
        for offset in range(0, max(1, len(data) - LENGTH + 1), PIECE):
            part = data[offset : offset + PIECE + LENGTH - 1]
            batch.append((i, offset, part))
            size += len(part)
            if size >= PIECE:
                yield batch
                batch, size = [], 0
    if batch:
        yield batch


def occurrences(documents: DataFrame) -> DataFrame:
    """The parse: one row per phrase of each document, with ``context``, ``phrase``, the text's key in two numbers
    and ``at``, which holds the trigger's place and its distances to the last and first window."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                keys = np.frombuffer(b"".join(part.column("key").to_pylist()), np.int64).reshape(-1, 2)
                for group in pieces_of(part.column("text").to_pylist()):
                    data = np.frombuffer(b"".join(g[2] for g in group), np.uint8)
                    ends = np.cumsum([len(g[2]) for g in group])
                    starts = ends - [len(g[2]) for g in group]
                    piece, own, lo, hi, context, phrase = parse(data, starts, ends)
                    owner = np.array([g[0] for g in group])[piece]
                    place = own - starts[piece] + np.array([g[1] for g in group])[piece]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(context.view(np.int64)), pa.array(phrase.view(np.int64)), pa.array(keys[owner, 0]), pa.array(keys[owner, 1]),
                         pa.array(place << 16 | (own - hi) << 8 | (own - lo))],
                        ["context", "phrase", "k1", "k2", "at"],
                    )

    keyed = documents.select(text_key().alias("key"), text_of().alias("text"))
    return keyed.mapInArrow(run, "context bigint, phrase bigint, k1 bigint, k2 bigint, at bigint")


def phrase_bytes(documents: DataFrame, entries: DataFrame) -> DataFrame:
    """``entries`` (``context``, ``phrase``, ``k1``, ``k2``, ``at``, ``n``, ``m``) with their ``bytes``."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                rows = batch.slice(at, 64).to_pylist()
                out = {k: [] for k in ("context", "phrase", "at", "n", "m", "bytes")}
                for row in rows:
                    data = row["text"].encode()
                    for e in row["entries"]:
                        place, near, far = e["at"] >> 16, e["at"] >> 8 & 255, e["at"] & 255
                        for k in ("context", "phrase", "at", "n", "m"):
                            out[k].append(e[k])
                        out["bytes"].append(data[place - far : place - near + LENGTH])
                yield pa.RecordBatch.from_pydict({
                    **{k: pa.array(out[k], pa.int64()) for k in ("context", "phrase", "at", "n", "m")},
                    "bytes": pa.array(out["bytes"], pa.binary()),
                })

    whole = documents.select(text_key().alias("key"), F.xxhash64("doc_id").alias("rid"), text_of().alias("text"))
    # One row stands for each text: of equal texts the row of the smallest hashed id.
    first = whole.groupBy("key").agg(F.min("rid").alias("rid"))
    # A text has at most one entry per byte, so its list is no larger than a few times the text.
    listed = entries.groupBy("k1", "k2").agg(F.collect_list(F.struct("context", "phrase", "at", "n", "m")).alias("entries"))
    listed = listed.select(F.unhex(F.concat(little_endian_hex("k1"), little_endian_hex("k2"))).alias("key"), "entries")
    wanted = first.join(listed, "key").select("key", "rid", "entries")
    return whole.join(wanted, ["key", "rid"]).select("text", "entries").mapInArrow(
        run, "context bigint, phrase bigint, at bigint, n bigint, m bigint, bytes binary"
    )


def ranked(keys: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in the order of their keys, and the rank of each key in that order (equal keys have one rank)."""
    packed = np.sort(keys << np.uint64(PLACES) | place)
    keys = packed >> np.uint64(PLACES)
    return (packed & np.uint64((1 << PLACES) - 1)).astype(np.int64), np.cumsum(np.concatenate(([0], keys[1:] != keys[:-1]))).astype(np.uint64)


def suffix_array(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The suffixes of ``data`` at ``starts`` (indices into it) in the order of their first LENGTH bytes, and their
    ranks there: suffixes whose common prefix (LCP) reaches LENGTH are neighbours and have one rank.

    Prefix doubling over all places: the order by some bytes and that of the places behind them give the order by
    twice as many.
    """
    n, known = len(data), 5
    place = np.arange(n, dtype=np.uint64)
    padded = np.concatenate((data, np.zeros(known, np.uint8))).astype(np.uint64)
    keys = np.zeros(n, np.uint64)
    for k in range(known):
        keys = keys << np.uint64(8) | padded[k : k + n]
    rank = np.zeros(n, np.uint64)
    while True:
        order, found = ranked(keys, place)
        rank[order] = found
        step = min(known, LENGTH - known)
        behind = np.zeros(n, np.uint64)
        behind[: n - step] = rank[step:] + np.uint64(1)
        keys = rank << np.uint64(PLACES + 1) | behind
        known += step
        if known == LENGTH:
            return ranked(keys[starts], place[: len(starts)])


def repeated_windows(at: np.ndarray, n: np.ndarray, phrases: list[bytes]) -> np.ndarray:
    """Which windows of these phrases, of which the parse holds ``n`` each, occur more than once: a row per phrase,
    a column per distance of the trigger from the window's start.

    One suffix array holds the concatenated phrases. Only suffixes with LENGTH bytes left of their phrase are
    windows; each counts as often as the parse holds its phrase.
    """
    far = at & 255
    size = np.fromiter(map(len, phrases), np.int64, len(phrases))
    windows = size - LENGTH + 1
    owner = np.repeat(np.arange(len(phrases)), windows)
    step = np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows)
    order, rank = suffix_array(np.frombuffer(b"".join(phrases), np.uint8), (np.cumsum(size) - size)[owner] + step)
    rank = rank.astype(np.int64)
    again = order[np.bincount(rank, weights=n[owner[order]])[rank] > 1]
    found = np.zeros((len(phrases), REACH), bool)
    found[owner[again], far[owner[again]] - step[again] - NEAR] = True
    return found


def blocks(context: np.ndarray, size: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of whole contexts (sorted) of at most 2 ** PLACES bytes; FULL phrases of one context fit."""
    ends = np.append(np.flatnonzero(context[1:] != context[:-1]) + 1, len(context))
    before = np.concatenate(([0], np.cumsum(size)))
    start = last = 0
    for end in ends.tolist():
        if before[end] - before[start] > 1 << PLACES:
            yield start, last
            start = last
        last = end
    yield start, last


def by_suffix_arrays(phrases: DataFrame, total: int) -> DataFrame:
    """``context``, ``phrase`` and ``mask`` (a byte per window) of phrases with repeated windows, in groups of whole
    contexts: equal windows have equal contexts."""

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("context")
        context, at, n = (rows[c].to_numpy() for c in ("context", "at", "n"))
        data = rows["bytes"].to_pylist()
        hits, masks = [], []
        for start, end in blocks(context, np.fromiter(map(len, data), np.int64, len(data))):
            found = repeated_windows(at[start:end], n[start:end], data[start:end])
            own = np.flatnonzero(found.any(axis=1))
            hits.append(own + start)
            masks += [found[i].astype(np.uint8).tobytes() for i in own]
        hit = pa.array(np.concatenate(hits))
        return pa.table({"context": rows["context"].take(hit), "phrase": rows["phrase"].take(hit), "mask": pa.array(masks, pa.binary())})

    dealt = phrases.withColumn("deal", F.pmod(F.xxhash64("context"), F.lit(max(1, -(-total // GROUP)))))
    return dealt.groupBy("deal").applyInArrow(run, "context bigint, phrase bigint, mask binary")


def cut(phrases: DataFrame, width: int) -> DataFrame:
    """The phrases cut into slices of ``width`` neighbouring windows, each a smaller phrase with a longer context:
    the bytes that all windows of a slice hold. ``of_context`` and ``of_phrase`` name the phrase cut. A slice of
    one window is told by its hashes and has no ``bytes``."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                rows = batch.slice(start, 256)
                at, whole = rows.column("at").to_numpy(), rows.column("bytes").to_pylist()
                near, far = at >> 8 & 255, at & 255
                size = np.fromiter(map(len, whole), np.int64, len(whole))
                first, last = (near - NEAR) // width, (far - NEAR) // width
                count = last - first + 1
                owner = np.repeat(np.arange(len(whole)), count)
                slot = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count) + first[owner]
                low, high = NEAR + slot * width, NEAR + slot * width + width - 1
                near, far = np.maximum(near[owner], low), np.minimum(far[owner], high)
                trigger = (np.cumsum(size) - size + (at & 255))[owner]
                begin, end = trigger - far, trigger - near + LENGTH
                data = b"".join(whole)
                values = np.frombuffer(data, np.uint8)
                context = mixed(Rolling(values).of(trigger - low, trigger + LENGTH - high) + slot.astype(np.uint64) * MIX)
                phrase = mixed(Rolling(values ^ np.uint8(0x5A)).of(begin, end) + far.astype(np.uint64) * MIX)
                held = [b""] * len(owner) if width == 1 else [data[b:e] for b, e in zip(begin.tolist(), end.tolist())]
                own = pa.array(owner)
                yield pa.RecordBatch.from_arrays(
                    [rows.column("context").take(own), rows.column("phrase").take(own), rows.column("n").take(own), pa.array(context.view(np.int64)),
                     pa.array(phrase.view(np.int64)), pa.array(near << 8 | far), pa.array(held, pa.binary())],
                    ["of_context", "of_phrase", "n", "context", "phrase", "at", "bytes"],
                )

    return phrases.mapInArrow(
        run, "of_context bigint, of_phrase bigint, n bigint, context bigint, phrase bigint, at bigint, bytes binary"
    )


def repeated(phrases: DataFrame, widths: tuple[int, ...] = SLICES) -> DataFrame:
    """A table of ``context``, ``phrase`` and ``mask`` of the phrases (``context``, ``phrase``, ``at``, ``n``, ``m``,
    ``bytes``) with repeated windows. ``m`` is the number of their context's phrases: where it is over FULL, the
    phrases are cut into slices, which are phrases again, equal ones counted with map-side combine. A phrase has
    a row for each of its slices then."""
    few, crowd = phrases.where(F.col("m") <= FULL), phrases.where(F.col("m") > FULL)
    found = by_suffix_arrays(few, few.count())
    if crowd.isEmpty():
        return table(found, "repeat-masks")
    width, *narrower = widths
    slices = table(cut(crowd, width), "repeat-slices")
    own = ["context", "phrase"]
    distinct = table(slices.groupBy(*own).agg(F.sum("n").alias("n"), F.first("at").alias("at"), F.first("bytes").alias("bytes")), "repeat-sliced")
    if width == 1:
        o = F.col("at").bitwiseAND(255).cast("int")
        mask = F.concat(F.repeat(F.lit("00"), o - NEAR), F.lit("01"), F.repeat(F.lit("00"), F.lit(FAR) - o))
        inside = table(distinct.where("n > 1").select(*own, F.unhex(mask).alias("mask")), "repeat-windows")
    else:
        again = table(distinct.groupBy("context").agg(F.count("*").alias("m"), F.sum("n").alias("_n")).where("_n > 1").drop("_n"), "repeat-contexts")
        parts = table(distinct.join(again, "context"), "repeat-phrases")
        inside = repeated(parts, tuple(narrower))
        drop_table(again)
        drop_table(parts)
    named = slices.join(inside, own).select(F.col("of_context").alias("context"), F.col("of_phrase").alias("phrase"), "mask")
    masks = table(found.unionByName(named), "repeat-masks")
    for read in (slices, distinct, inside):
        drop_table(read)
    return masks


def with_spans(documents: DataFrame, marks_name: str) -> DataFrame:
    """``documents`` with a column of marks: for each phrase of the text that has repeated windows, its ``at`` and
    ``mask`` (null: all of them)."""
    parsed = table(occurrences(documents), "repeat-parse")
    shared = table(parsed.groupBy("context").agg(F.count("*").alias("_n")).where("_n > 1"), "repeat-contexts")
    hot = table(shared.where(F.col("_n") > HOT).select("context"), "repeat-hot-contexts")
    own = ["context", "phrase", "k1", "k2", "at"]
    # A join by context and an aggregate by more share one shuffle, which Spark can't split where a context is skewed.
    # Hot contexts are few (their table is small); their rows are counted by all columns, with map-side combine.
    crowded = table(parsed.join(hot, "context"), "repeat-crowded")
    others = parsed.join(hot, "context", "left_anti").join(shared.where(F.col("_n") <= HOT).select("context"), "context")
    counts = [rows.groupBy(*own).agg(F.count("*").alias("c")) for rows in (others, crowded)]
    suspects = table(counts[0].unionByName(counts[1]), "repeat-suspects")
    drop_table(parsed)
    counted = suspects.groupBy("context", "phrase").agg(F.sum("c").alias("n"), F.min(F.struct("k1", "k2", "at")).alias("loc"))
    dictionary = table(counted, "repeat-dictionary")
    # A table between: both sides of the join are then plain shuffles, of which Spark splits the skewed ones.
    many = table(dictionary.groupBy("context").agg(F.count("*").alias("m")).where("m > 1"), "repeat-contexts")
    entries = dictionary.join(many, "context").select("context", "phrase", "n", "m", "loc.*")
    phrases = table(phrase_bytes(documents, entries), "repeat-phrases")
    masks = repeated(phrases)
    drop_table(phrases)
    whole = dictionary.where("n > 1").select("context", "phrase", F.lit(None).cast("binary").alias("mask"))
    results = whole.unionByName(masks.join(whole.select("context", "phrase"), ["context", "phrase"], "left_anti"))
    marks = suspects.select(*own).join(results, ["context", "phrase"]).groupBy("k1", "k2").agg(F.collect_list(F.struct("at", "mask")).alias("marks"))
    by_text = table(marks, "repeat-marks")
    for read in (suspects, dictionary, shared, hot, crowded, many, masks):
        drop_table(read)
    key, found = private(documents, "key"), F.unhex(F.concat(little_endian_hex("k1"), little_endian_hex("k2")))
    return documents.withColumn(key, text_key()).join(by_text.select(found.alias(key), F.col("marks").alias(marks_name)), key, "left").drop(key)


def little_endian_hex(name: str) -> Column:
    """The eight bytes of a long, lowest first, in hexadecimal."""
    digits = F.lpad(F.hex(F.col(name)), 16, "0")
    return F.concat(*[F.substring(digits, i, 2) for i in range(15, 0, -2)])


def spans_of(size: int, marks: list[dict] | None) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of the maximal removed runs of a text of ``size`` bytes."""
    if not marks:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    edges = np.zeros(size + 1, np.int32)
    for m in marks:
        place, near, far = m["at"] >> 16, m["at"] >> 8 & 255, m["at"] & 255
        if m["mask"] is None:
            edges[place - far] += 1
            edges[place - near + LENGTH] -= 1
        else:
            starts = place - (np.flatnonzero(np.frombuffer(m["mask"], np.uint8)) + NEAR)
            np.add.at(edges, starts, 1)
            np.add.at(edges, starts + LENGTH, -1)
    covered = np.cumsum(edges[:-1]) > 0
    change = np.diff(np.concatenate(([0], covered.view(np.int8), [0])))
    return np.flatnonzero(change == 1), np.flatnonzero(change == -1)


def remove_repeats(documents: DataFrame, whole_characters: bool = False) -> DataFrame:
    """Removes each byte covered by a 200-byte string that starts at another place too, in the same document or
    another. Adds ``n_bytes``, ``spans`` (start and end of the maximal removed runs) and ``kept`` (the remaining
    bytes, joined).

    Texts are taken as UTF-8 bytes, a null text as empty; strings do not cross documents, may overlap, and are
    judged on the input. With ``whole_characters`` a character goes as soon as one of its bytes does, so that
    ``kept`` is text again. Rows stay, repeated ones too: a copy of a whole row repeats all its strings. Texts
    under 200 bytes stay as they are. Columns of the three names above are replaced; all others stay.

    Prefix-free parsing, spread over the cluster:

    1. Rolling-hash triggers cut every document into overlapping phrases such that each 200-byte string lies whole
       in exactly one phrase, at a place its own bytes decide (:func:`parse`).
    2. Equal phrases, counted with map-side combine, form the dictionary. A phrase whose trigger's context occurs
       once in the corpus is dropped here; one that occurs twice as a whole is repeated throughout.
    3. Only contexts with several different phrases are left, dealt to groups of whole contexts. Each block of a group
       concatenates its phrases into one suffix array; each suffix counts as often as the parse holds its phrase, and
       neighbours whose LCP reaches 200 are repeats (:func:`repeated_windows`). Phrases of a context with more than ``FULL`` of
       them are first cut into slices with longer contexts, down to single windows (:func:`repeated`).
    4. What is found for a phrase holds for all places of the parse where it stands.

    A window never leaves its phrase, so of the parse only the counts of its phrases enter the order of the dictionary.
    """
    kept_columns = [c for c in documents.columns if c.lower() not in ("n_bytes", "spans", "kept")]
    text_name, marks_name = private(documents, "text"), private(documents, "marks")
    marked = with_spans(documents.select(*kept_columns), marks_name).withColumn(text_name, text_of())
    schema = marked.select(
        *kept_columns, F.lit(0).cast("bigint").alias("n_bytes"),
        F.array(F.struct(F.lit(0).cast("bigint").alias("start"), F.lit(0).cast("bigint").alias("end"))).alias("spans"), F.lit(b"").alias("kept"),
    ).schema
    span_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                sizes, spans, left = [], [], []
                for text, marks in zip(part.column(text_name).to_pylist(), part.column(marks_name).to_pylist()):
                    data = text.encode()
                    starts, ends = spans_of(len(data), marks)
                    if whole_characters and len(starts):
                        starts, ends = to_characters(data, starts, ends)
                    sizes.append(len(data))
                    spans.append([{"start": s, "end": e} for s, e in zip(starts.tolist(), ends.tolist())])
                    edges = [0, *np.column_stack((starts, ends)).reshape(-1).tolist(), len(data)]
                    left.append(b"".join(data[edges[i] : edges[i + 1]] for i in range(0, len(edges), 2)))
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(c) for c in kept_columns], pa.array(sizes, pa.int64()), pa.array(spans, span_type), pa.array(left, pa.binary())],
                    [*kept_columns, "n_bytes", "spans", "kept"],
                )

    return marked.select(*kept_columns, text_name, marks_name).mapInArrow(run, schema)


def to_characters(data: bytes, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs widened to whole UTF-8 characters."""
    first = (np.frombuffer(data, np.uint8) & 0xC0) != 0x80
    edges = np.append(np.flatnonzero(first), len(data))
    starts = edges[np.searchsorted(edges, starts, "right") - 1]
    ends = edges[np.searchsorted(edges, ends, "left")]
    # Widened runs may touch.
    apart = starts[1:] > ends[:-1]
    return starts[np.concatenate(([True], apart))], ends[np.concatenate((apart, [True]))]
