"""Keyed state is used by the piece: the calls to it do not grow with a key's rows."""

import random

from pyspark.sql import Row

from tidewatch.streaming import ordered
from tidewatch.streaming.processors import Absence

SECOND = 1_000_000


class State:
    """List, map and value state of one key, which counts the calls."""

    def __init__(self, handle):
        self.handle, self.held = handle, None

    def __getattribute__(self, name):
        if name in ("handle", "held", "__class__"):
            return object.__getattribute__(self, name)
        self.handle.calls += 1
        return object.__getattribute__(self, name)

    def exists(self):
        return self.held is not None

    def get(self):
        return list(self.held or []) if isinstance(self.held, list) or self.held is None and self.handle.lists[id(self)] else self.held

    def put(self, values):
        self.held = list(values)

    update = put

    def appendValue(self, value):
        self.held = [*(self.held or []), value]

    def containsKey(self, key):
        return key in (self.held or {})

    def getValue(self, key):
        return (self.held or {}).get(key)

    def updateValue(self, key, value):
        self.held = {**(self.held or {}), key: value}

    def removeKey(self, key):
        del self.held[key]

    def clear(self):
        self.held = None


class Value(State):
    def update(self, value):
        self.held = value


class Handle:
    def __init__(self):
        self.calls, self.timers, self.lists = 0, set(), {}

    def state(self, kind, is_list=False):
        made = kind(self)
        self.lists[id(made)] = is_list
        return made

    def getListState(self, *_):
        return self.state(State, True)

    def getMapState(self, *_):
        return self.state(State)

    def getValueState(self, *_):
        return self.state(Value)

    def registerTimer(self, at):
        self.calls += 1
        self.timers.add(at)

    def deleteTimer(self, at):
        self.calls += 1
        self.timers.discard(at)


class Times:
    def __init__(self, watermark):
        self.getCurrentWatermarkInMs = lambda: watermark


class Expired:
    def __init__(self, at):
        self.getExpiryTimeInMs = lambda: at


def run(processor, batches):
    """Results of rows in micro-batches, each at its watermark, and the calls to the state and the timers."""
    handle, out = Handle(), []
    processor.init(handle)
    for rows, watermark in batches:
        if rows:
            out += processor.handleInputRows(("k",), iter(rows), Times(watermark))
        for at in sorted(t for t in handle.timers if t <= watermark):
            out += processor.handleExpiredTimer(("k",), Times(watermark), Expired(at))
            handle.timers.discard(at)
            handle.calls += 1
    return out, handle


def cut(rows, spread, parts):
    """Rows in micro-batches, each with a watermark that later rows do not miss."""
    size = -(-len(rows) // parts)
    batches = [rows[a : a + size] for a in range(0, len(rows), size)]
    marks = [0, *(max(0, min(r["time"] for later in batches[i:] for r in later) // 1000 - spread) for i in range(1, len(batches)))]
    return [*zip(batches, marks, strict=True), ([], 10**10)]


def moments(seed, n, span):
    rnd = random.Random(seed)
    return rnd, sorted(rnd.randrange(span) * SECOND // 4 for _ in range(n))


def test_periods_by_the_piece():
    rnd, times = moments(1, 6000, 80_000)
    rows = [Row(time=t, rank=0, tie=i, ttl=9 * SECOND) for i, t in enumerate(times)]
    want, last = [], None
    for r in rows:
        if last is None or r["time"] >= last + r["ttl"]:
            want.append(r["tie"])
            last = r["time"]
    rnd.shuffle(rows)
    got, handle = run(ordered.Periods(["k"], ["ttl"], ["k", "tie", "time", "late"]), [(rows, 0), ([], 10**10)])
    assert sorted(r["tie"] for r in got) == sorted(want) and not any(r["late"] for r in got)
    assert handle.calls < 40 and not handle.timers


def test_sequences_by_the_piece():
    for parts, most_calls in ((1, 60), (5, 260)):
        rnd, times = moments(2, 6000, 80_000)
        first = [rnd.random() < 0.7 for _ in times]
        rows = [Row(time=t, rank=int(f), tie=i, is_first=f, is_second=not f, least=1, most=9 * SECOND, wanted=False) for i, (t, f) in enumerate(zip(times, first, strict=True))]
        answers = [t for t, f in zip(times, first, strict=True) if not f]
        want = [i for i, (t, f) in enumerate(zip(times, first, strict=True)) if f and not any(t + 1 <= a <= t + 9 * SECOND for a in answers)]
        if parts == 1:
            rnd.shuffle(rows)
        got, handle = run(ordered.Sequence(["k"], ["is_first", "is_second", "least", "most", "wanted"], ["k", "tie", "time", "second_time", "late"]), cut(rows, 2000, parts))
        assert sorted(r["tie"] for r in got) == want and want
        assert handle.calls < most_calls and not handle.timers


def test_look_ups_by_the_piece():
    rows = [Row(time=i * SECOND, rank=int(i % 100 > 0), tie=i, is_write=i % 100 == 0, mode="UPSERT", dataset="d", fields={"a": str(i)} if i % 100 == 0 else None) for i in range(6000)]
    processor = ordered.ProfileLookup(["k"], ["k", "tie", "time", "is_write", "found", "last_write", "late"], ["d.a"], 50_000)
    got, handle = run(processor, [(rows, 0), ([], 10**10)])
    assert {r["tie"]: (r["found"], r["last_write"]) for r in got} == {
        i: ({"d.a": str(i // 100 * 100)} if i % 100 < 50 else {}, i // 100 * 100) for i in range(6000) if i % 100
    }
    assert handle.calls < 60


def test_absences_by_the_piece():
    for parts, most_calls in ((1, 40), (4, 120)):
        rnd, times = moments(3, 6000, 80_000)
        rows = [Row(event_id=i, time=t, is_first=i % 3 > 0, is_second=i % 3 == 0) for i, t in enumerate(times)]
        answers = [r["time"] for r in rows if r["is_second"]]
        want = [r["event_id"] for r in rows if r["is_first"] and not any(r["time"] + 1 <= a <= r["time"] + 9 * SECOND for a in answers)]
        if parts == 1:
            rnd.shuffle(rows)
        got, handle = run(Absence("k", 0, 9 * SECOND), cut(rows, 2000, parts))
        assert sorted(r["event_id"] for r in got) == want and want
        assert handle.calls < most_calls and not handle.timers
