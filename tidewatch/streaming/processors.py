"""Keyed state for what a stream cannot express with windows and joins."""

from __future__ import annotations

import json
from bisect import bisect_left
from itertools import islice
from typing import Iterable, Iterator

from pyspark.sql import Row
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

#: Rows of a key that share an entry of the state.
PIECE_ROWS = 1000


def pieces(rows: Iterable[list]) -> Iterator[str]:
    """Rows as JSON texts of ``PIECE_ROWS`` rows each. A call to the state costs far more than a row."""
    rows = iter(rows)
    while piece := list(islice(rows, PIECE_ROWS)):
        yield json.dumps(piece)


class FirstArrival(StatefulProcessor):
    """Lets the first event of a key through, then none until ``ttl_ms`` of processing time have passed.

    The rows of one micro-batch arrive together, so at most one of them passes: the earliest by
    ``order``. Only that one is held.
    """

    def __init__(self, order: list[str], columns: list[str], ttl_ms: int | None):
        self.order, self.columns, self.ttl_ms = order, columns, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", "yes boolean", self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        best = min(rows, key=lambda r: tuple(r[c] for c in self.order))
        if not self.seen.exists():
            self.seen.update((True,))
            yield Row(**{c: best[c] for c in self.columns})

    def close(self) -> None:
        pass


class Absence(StatefulProcessor):
    """First events not answered by a second one between ``least`` and ``most`` microseconds later.

    Input rows: ``event_id, time, is_first, is_second`` (microseconds). A first event is due at the end of its window; by
    then every answer inside it has been seen, in whatever order rows came. Answers are kept until no first event can need
    them. A key has one timer, for what is due next, and all that is due then is decided in one pass.
    """

    def __init__(self, key: str, least: int, most: int):
        # An answer comes later than its event, or an event both sides accept would answer itself.
        self.key, self.least, self.most = key, max(least, 1), most

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.rows = handle.getListState("rows", "rows string")
        self.next = handle.getValueState("next", "at bigint")

    def due(self, time: int) -> int:
        """When a first event of ``time`` is decided."""
        return (time + self.most) // 1000 + 1

    def until(self, time: int) -> int:
        """How long an answer of ``time`` is needed."""
        return (time + self.most - self.least) // 1000 + 1

    def ends(self, rows: Iterable[list]) -> Iterator[int]:
        for time, _, is_first, is_second in rows:
            if is_first:
                yield self.due(time)
            if is_second:
                yield self.until(time)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        soonest = None

        def waiting():
            nonlocal soonest
            for r in rows:
                row = [r["time"], r["event_id"], r["is_first"], r["is_second"]]
                soonest = min([*self.ends([row]), *([] if soonest is None else [soonest])])
                yield row

        for piece in pieces(waiting()):
            self.rows.appendValue((piece,))
        known = self.next.get()
        if soonest is not None and (known is None or soonest < known[0]):
            if known is not None:
                self.handle.deleteTimer(known[0])
            self.wake(soonest)
        return iter(())

    def wake(self, at: int) -> None:
        self.handle.registerTimer(at)
        self.next.update((at,))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        now = timerValues.getCurrentWatermarkInMs()
        rows = [r for (piece,) in self.rows.get() for r in json.loads(piece)]
        answers = sorted({time for time, _, _, is_second in rows if is_second})
        due = dict.fromkeys((time, event_id) for time, event_id, is_first, _ in rows if is_first and self.due(time) <= now)
        left = [[time, event_id, is_first and self.due(time) > now, is_second and self.until(time) > now] for time, event_id, is_first, is_second in rows]
        left = [r for r in left if r[2] or r[3]]
        if left:
            self.rows.put([(piece,) for piece in pieces(left)])
            self.wake(min(self.ends(left)))
        else:
            self.rows.clear()
            self.next.clear()
        for time, event_id in due:
            at = bisect_left(answers, time + self.least)
            if at == len(answers) or answers[at] > time + self.most:
                yield Row(**{self.key: key[0], "event_id": event_id, "time": time})

    def close(self) -> None:
        pass
