"""Keyed state in event-time order: first arrivals and cooldowns that expire, sequences, profile look-ups.

A key's rows wait until the watermark has passed their slot of event time, and are then handed on in order, so a result
does not depend on the order of arrival within the watermark and equals that of the batch form. What waits lies in the
state in pieces of many rows, with one timer per key, so the calls to the state grow with the keys of a micro-batch and
not with their rows. Rows that come after their slot has been handed on are not dropped unseen: they leave the operator
marked ``late``.
"""

from __future__ import annotations

import json
from collections import deque
from collections.abc import Iterable, Iterator
from functools import reduce
from operator import and_

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Row, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidewatch.operators.scans import with_once
from tidewatch.streaming import processors
from tidewatch.streaming.processors import ROCKSDB, pieces

#: Width of a slot in milliseconds.
GRAIN = 1000


def slot_end(time: int) -> int:
    """The end (milliseconds) of the slot of a time in microseconds."""
    return (time // (GRAIN * 1000) + 1) * GRAIN


class InOrder(StatefulProcessor):
    """Hands on the rows of a key in order of ``(time, rank, tie)``, up to the last slot that the watermark has passed.
    ``kept`` are the columns a row keeps while it waits; ``out`` those of the result, of which a late row fills the ones
    it has."""

    def __init__(self, keys: list[str], kept: list[str], out: list[str]):
        self.keys, self.kept, self.out = keys, ["time", "rank", "tie", *kept], out

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "rows string")
        self.due = handle.getValueState("due", "at bigint")
        self.open(handle)

    def open(self, handle: StatefulProcessorHandle) -> None:
        """Further state."""

    def step(self, key, rows: Iterable[dict]) -> Iterator[dict]:
        """Results of rows, which come in order."""
        raise NotImplementedError

    def passed(self, key, end: int) -> tuple[list[dict], int | None]:
        """Results of the fact that everything before ``end`` (milliseconds) has been seen, and when there will be more
        without a further row."""
        return [], None

    def timer(self, end: int) -> None:
        self.handle.registerTimer(end)

    def row(self, key, values: dict, late: bool = False) -> Row:
        full = dict(zip(self.keys, key)) | values | {"late": late}
        return Row(**{c: full.get(c) for c in self.out})

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        border = timerValues.getCurrentWatermarkInMs() // GRAIN * GRAIN * 1000
        late, soonest = [], None

        def waiting():
            nonlocal soonest
            for r in rows:
                if r["time"] < border:
                    late.append(self.row(key, r.asDict(), True))
                else:
                    soonest = r["time"] if soonest is None else min(soonest, r["time"])
                    yield [r[c] for c in self.kept]

        for piece in pieces(waiting()):
            self.waiting.appendValue((piece,))
        if soonest is not None:
            end, known = slot_end(soonest), self.due.get()
            if known is None or end < known[0]:
                if known is not None:
                    self.handle.deleteTimer(known[0])
                self.timer(end)
                self.due.update((end,))
        return iter(late)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        end = timerValues.getCurrentWatermarkInMs() // GRAIN * GRAIN
        ready, later = [], []
        for (piece,) in self.waiting.get():
            for r in json.loads(piece):
                (ready if r[0] < end * 1000 else later).append(r)
        if later:
            self.waiting.put([(piece,) for piece in pieces(later)])
        else:
            self.waiting.clear()
        ready.sort(key=lambda r: r[:3])
        if ready:
            for r in self.step(key, (dict(zip(self.kept, r)) for r in ready)):
                yield self.row(key, r)
        out, until = self.passed(key, end)
        for r in out:
            yield self.row(key, r)
        ends = [slot_end(min(r[0] for r in later))] if later else []
        ends += [until] if until is not None else []
        if ends:
            self.timer(min(ends))
            self.due.update((min(ends),))
        else:
            self.due.clear()

    def close(self) -> None:
        pass


class Periods(InOrder):
    """Lets a row through that comes at least its ``ttl`` after the last one let through."""

    def open(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", "time bigint")

    def step(self, key, rows: Iterable[dict]) -> Iterator[dict]:
        before = last = (self.last.get() or (None,))[0]
        for r in rows:
            if last is None or r["time"] >= last + r["ttl"]:
                last = r["time"]
                yield r
        if last != before:
            self.last.update((last,))


class Queue:
    """A queue in the state, in pieces: ``ends`` holds the number of the first piece, how much of it is gone, and the
    number of the next piece. Only the pieces that something leaves are read."""

    def __init__(self, state, ends):
        self.state, self.ends = state, ends
        self.known = self.head, self.gone, self.tail = tuple(ends.get() or (0, 0, 0))
        self.front, self.new = None, deque()

    def first(self) -> list | None:
        while self.head < self.tail:
            if self.front is None:
                self.front = json.loads(self.state.getValue((self.head,))[0])
            if self.gone < len(self.front):
                return self.front[self.gone]
            self.state.removeKey((self.head,))
            self.head, self.gone, self.front = self.head + 1, 0, None
        return self.new[0] if self.new else None

    def leave(self) -> None:
        if self.head < self.tail:
            self.gone += 1
        else:
            self.new.popleft()

    def enter(self, item: list) -> None:
        self.new.append(item)

    def keep(self) -> None:
        for piece in pieces(self.new):
            self.state.updateValue((self.tail,), (piece,))
            self.tail += 1
        if (self.head, self.gone, self.tail) != self.known:
            self.ends.update((self.head, self.gone, self.tail))


class Sequence(InOrder):
    """Open first events in time order, as a queue. An answer closes all of them that it comes late enough for, and
    what has waited longer than ``most`` leaves, so every event enters and leaves the queue once."""

    def open(self, handle: StatefulProcessorHandle) -> None:
        self.queue = handle.getMapState("queue", "place bigint", "events string")
        self.ends = handle.getValueState("ends", "head bigint, gone bigint, tail bigint")

    @staticmethod
    def close_until(queue: Queue, gone, answered_at: int | None) -> Iterator[dict]:
        """Takes events off the head of the queue while ``gone`` says so."""
        while (event := queue.first()) is not None:
            time, tie, most, wanted = event
            if not gone(time, most):
                break
            queue.leave()
            if wanted == (answered_at is not None):
                yield {"time": time, "tie": tie, "second_time": answered_at}

    def step(self, key, rows: Iterable[dict]) -> Iterator[dict]:
        queue = Queue(self.queue, self.ends)
        for r in rows:
            # Seconds of an instant come before its firsts: an event does not answer itself.
            if r["is_second"]:
                yield from self.close_until(queue, lambda t, most: t + most < r["time"], None)  # noqa: B023
                yield from self.close_until(queue, lambda t, _: t + r["least"] <= r["time"], r["time"])  # noqa: B023
            if r["is_first"]:
                queue.enter([r["time"], r["tie"], r["most"], r["wanted"]])
        queue.keep()

    def passed(self, key, end: int) -> tuple[list[dict], int | None]:
        queue = Queue(self.queue, self.ends)
        out = list(self.close_until(queue, lambda t, most: t + most < end * 1000, None))
        oldest = queue.first()
        queue.keep()
        return out, slot_end(oldest[0] + oldest[2]) if oldest else None


class Held:
    """Entries of a map in the state, each read at most once and written back together."""

    def __init__(self, state):
        self.state, self.entries, self.changed = state, {}, {}

    def get(self, key: tuple) -> tuple | None:
        if key not in self.entries:
            self.entries[key] = tuple(self.state.getValue(key)) if self.state.containsKey(key) else None
        return self.entries[key]

    def put(self, key: tuple, value: tuple | None) -> None:
        self.entries[key] = self.changed[key] = value

    def keep(self) -> None:
        for key, value in self.changed.items():
            if value is not None:
                self.state.updateValue(key, value)
            elif self.state.containsKey(key):
                self.state.removeKey(key)


class ProfileLookup(InOrder):
    """A key's profile, written by ``is_write`` rows and read by the others: ``found`` holds the wanted fields that
    were written within ``ttl_ms``, by name."""

    def __init__(self, keys: list[str], out: list[str], wanted: list[str], ttl_ms: int):
        super().__init__(keys, ["is_write", "mode", "dataset", "fields"], out)
        self.wanted, self.ttl = [tuple(w.split(".", 1)) for w in wanted], ttl_ms * 1000

    def open(self, handle: StatefulProcessorHandle) -> None:
        self.values = handle.getMapState("values", "dataset string, field string", "value string, time bigint, number bigint")
        self.datasets = handle.getMapState("datasets", "dataset string", "number bigint, reset bigint")
        self.written = handle.getValueState("written", "number bigint, tie bigint")

    def handleInitialState(self, key, initialState, timerValues) -> None:
        for f in initialState["fields"]:
            self.values.updateValue((f["dataset"], f["field"]), (f["value"], f["t"], 0))

    def step(self, key, rows: Iterable[dict]) -> Iterator[dict]:
        values, datasets = Held(self.values), Held(self.datasets)
        before = number, last = tuple(self.written.get() or (0, None))
        for r in rows:
            if r["is_write"]:
                number, last = number + 1, r["tie"]
                if r["mode"] != "UPSERT":
                    # What was written before no longer counts; it needs no search.
                    datasets.put((r["dataset"],), (number, number))
                if r["mode"] != "DELETE":
                    for field, value in dict(r["fields"] or {}).items():
                        values.put((r["dataset"], field), (value, r["time"], number))
            else:
                found = ((f"{d}.{f}", self.value(values, datasets, d, f, r["time"])) for d, f in self.wanted)
                yield r | {"found": {name: v for name, v in found if v is not None}, "last_write": last}
        values.keep()
        datasets.keep()
        if (number, last) != before:
            self.written.update((number, last))

    def value(self, values: Held, datasets: Held, dataset: str, field: str, now: int) -> str | None:
        written = values.get((dataset, field))
        if written is None:
            return None
        value, time, number = written
        if now - time >= self.ttl:
            # Later rows only come later: the field has expired for good.
            values.put((dataset, field), None)
            return None
        return value if number >= (datasets.get((dataset,)) or (0, 0))[1] else None


# Processors travel to the workers whole, so the package need not be installed there.
def _ship() -> None:
    import sys

    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    cloudpickle.register_pickle_by_value(processors)


def with_clock(df: DataFrame, time: Column | str, record_time: Column | str | None = None, watermark: str = "1 minute") -> DataFrame:
    """Adds ``time`` (microseconds) with a watermark on it: the event's own time, else the record's where it is past the
    epoch, else now."""
    own, record = (F.col(c) if isinstance(c, str) else c for c in (time, record_time if record_time is not None else F.lit(None).cast("timestamp")))
    now = F.unix_micros(F.current_timestamp())
    known = F.coalesce(own, F.when(record > F.timestamp_micros(F.lit(0)), F.unix_micros(record)), now)
    return df.withColumn("time", known.cast("bigint")).withColumn("_clock", F.timestamp_micros("time")).withWatermark("_clock", watermark)


def _used(rows: DataFrame, keys: list[str], test: Column | None = None) -> DataFrame:
    """Rows with all keys that pass the test. Spark would move a plain filter below the watermark, which would then
    only follow the rows that are left."""
    known = reduce(and_, [F.col(k).isNotNull() for k in keys])
    return with_once(rows, _use=known if test is None else known & test).where("_use").drop("_use")


def _run(rows: DataFrame, keys: list[str], processor: InOrder, more: str, initial: DataFrame | None = None) -> DataFrame:
    _ship()
    rows.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    # Without the watermark's mark on a column Spark leaves late rows in, for the operator to see.
    rows = rows.drop("_clock")
    types = {f.name: f.dataType.simpleString() for f in rows.schema}
    schema = ", ".join(f"{k} {types[k]}" for k in keys) + f", {more}, late boolean"
    kept = initial.groupBy(*keys) if initial is not None else None
    return rows.groupBy(*keys).transformWithState(processor, schema, "Append", "EventTime", kept)


def periods(events: DataFrame, keys: list[str], tie: str, ttl: int | str) -> DataFrame:
    """First arrivals whose period expires, and cooldowns: of each key, the first row, then each first one at least
    ``ttl`` microseconds (a number, or a column, so that many rules share the operator) after the last let through.

    ``events`` come from :func:`with_clock`. Result: the keys, ``tie``, ``time``, ``late``; late rows have taken no part.
    Rows with a null key are left out.
    """
    length = F.col(ttl) if isinstance(ttl, str) else F.lit(ttl)
    rows = _used(events, keys).select(*keys, "time", F.lit(0).alias("rank"), F.col(tie).alias("tie"), length.cast("bigint").alias("ttl"), "_clock")
    return _run(rows, keys, Periods(keys, ["ttl"], [*keys, "tie", "time", "late"]), "tie bigint, time bigint").withColumnRenamed("tie", tie)


def sequences(
    events: DataFrame, keys: list[str], tie: str, first: Column, second: Column, least: Column | int, most: Column | int, followed: Column | bool,
) -> DataFrame:
    """First events (``first``) that are (``followed``), or are not, answered by a ``second`` event of the same keys
    between ``least`` and ``most`` microseconds later (one at least), with the earliest answer's ``second_time``.

    The parameters may be columns that are the same for all rows of a key, so that many rules share the operator, with
    the rule as a key. ``events`` come from :func:`with_clock`; a not-answered event leaves once the watermark has
    passed its window. Rows with a null key are left out. Late rows leave marked and take no part.
    """
    as_column = lambda c, kind: (c if isinstance(c, Column) else F.lit(c)).cast(kind)
    rows = (
        _used(events, keys, F.coalesce(first, F.lit(False)) | F.coalesce(second, F.lit(False)))
        .select(
            *keys, "time", F.col(tie).alias("tie"), F.coalesce(first, F.lit(False)).alias("is_first"), F.coalesce(second, F.lit(False)).alias("is_second"),
            F.greatest(as_column(least, "bigint"), F.lit(1).cast("bigint")).alias("least"), as_column(most, "bigint").alias("most"), as_column(followed, "boolean").alias("wanted"), "_clock",
        )
        .withColumn("rank", F.when(F.col("is_second"), 0).otherwise(1))
    )
    processor = Sequence(keys, ["is_first", "is_second", "least", "most", "wanted"], [*keys, "tie", "time", "second_time", "late"])
    return _run(rows, keys, processor, "tie bigint, time bigint, second_time bigint").withColumnRenamed("tie", tie)


def profile_lookup(
    events: DataFrame, writes: DataFrame, key: str, tie: str, wanted: list[str], ttl_ms: int, record_time: Column | None = None,
    watermark: str = "1 minute", initial: DataFrame | None = None,
) -> DataFrame:
    """Each event with the profile of its key as it was then: ``found`` maps the ``wanted`` names (``dataset.field``) to
    values written at or before the event and less than ``ttl_ms`` ago; ``last_write`` is the number of the key's last write.

    ``events``: ``key``, ``t`` (microseconds), ``tie``. ``writes``: ``key``, ``t``, ``tie``, ``mode`` (FULL_SNAPSHOT replaces
    the dataset's fields, UPSERT patches, DELETE removes them), ``dataset``, ``fields`` (map). Both may be streams.
    ``initial`` (``key``, ``dataset``, ``field``, ``value``, ``t``) is the profile to begin with, read once, when
    the query first starts. A write counts for events of its own instant. Late rows leave marked and take no part.
    """
    none = lambda kind: F.lit(None).cast(kind)
    asks = events.select(key, "t", tie, F.lit(1).alias("rank"), F.lit(False).alias("is_write"), none("string").alias("mode"), none("string").alias("dataset"), none("map<string,string>").alias("fields"))
    puts = writes.select(key, "t", tie, F.lit(0).alias("rank"), F.lit(True).alias("is_write"), "mode", "dataset", "fields")
    rows = _used(with_clock(asks.unionByName(puts), "t", record_time, watermark), [key]).withColumnRenamed(tie, "tie").drop("t")
    if initial is not None:
        initial = initial.groupBy(key).agg(F.collect_list(F.struct("dataset", "field", "value", F.col("t").cast("bigint").alias("t"))).alias("fields"))
    processor = ProfileLookup([key], [key, "tie", "time", "is_write", "found", "last_write", "late"], wanted, ttl_ms)
    found = _run(rows, [key], processor, "tie bigint, time bigint, is_write boolean, found map<string,string>, last_write bigint", initial)
    return found.withColumnRenamed("tie", tie)


def late_letters(rows: DataFrame, source: Column, tie: str) -> DataFrame:
    """Dead letters of late rows."""
    return rows.where("late").select(
        source.alias("source"), F.col(tie).alias("seq"), "time", F.lit("ERR_STREAM_LATE_EVENT").alias("error_code"),
        F.lit("the event came after the watermark had passed its time").alias("error_reason"),
    )
