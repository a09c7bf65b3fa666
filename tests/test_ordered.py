"""State in event-time order on a stream, against plain walks over the same rows."""

import random

import pytest
from pyspark.sql import functions as F

from tests.test_streaming import sink
from tidewatch.streaming import ordered

SECOND = 1_000_000
SCHEMA = "k string, id bigint, t bigint, kind string, ttl bigint"


def shuffled(seed, n, span, files):
    """Rows in files; none comes more than 50 seconds after a later one."""
    rnd = random.Random(seed)
    rows = [(rnd.choice("xyz"), i, rnd.randrange(span) * SECOND // 4, rnd.choice("AABC"), rnd.choice([5, 9]) * SECOND) for i in range(n)]
    rows = [(k, i, t, kind, 7 * SECOND if k == "x" else 20 * SECOND) for k, i, t, kind, _ in rows]
    rows.sort(key=lambda r: r[2] + rnd.randrange(50 * SECOND))
    size = -(-n // files)
    return [rows[a : a + size] for a in range(0, n, size)]


def stream(spark, tmp_path, batches, operator, name="w", schema=SCHEMA, clock=None):
    """Feeds file after file, each run going on from the checkpoint of the last; returns the sink's rows."""
    folder = tmp_path / name
    source = str(folder / "in")
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
        events = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
        sink(operator(clock(events) if clock else ordered.with_clock(events, "t")), str(folder)).awaitTermination()
    return spark.read.parquet(f"{folder}/out").collect()


def everything(batches, schema_row=("end", -1, None, "-", 1)):
    """One more file, whose only row lies far beyond the others."""
    last = max(r[2] for b in batches for r in b) + 10_000 * SECOND
    k, i, _, kind, ttl = schema_row
    return [*batches, [(k, i, last, kind, ttl)]]


def test_periods_equal_the_fold_on_shuffled_input(spark, tmp_path):
    batches = shuffled(1, 160, 800, 4)
    got = stream(spark, tmp_path, everything(batches), lambda e: ordered.periods(e, ["k"], "id", "ttl"))
    want, last = set(), {}
    for k, i, t, _, ttl in sorted((r for b in batches for r in b), key=lambda r: (r[2], r[1])):
        if k not in last or t >= last[k] + ttl:
            want.add((k, i))
            last[k] = t
    assert {(r.k, r.id) for r in got} == want and not any(r.late for r in got)


@pytest.mark.parametrize("followed", [True, False])
def test_sequences_equal_brute_force_on_shuffled_input(spark, tmp_path, followed):
    batches = shuffled(2, 160, 800, 3)
    rows = [r for b in batches for r in b]
    least, most = 2 * SECOND, 9 * SECOND
    kinds = lambda e: ordered.sequences(e, ["k"], "id", F.col("kind") == "A", F.col("kind").isin("B"), least, most, followed)
    got = stream(spark, tmp_path, everything(batches), kinds)
    answers = {
        (a[0], a[1]): min((b[2] for b in rows if b[0] == a[0] and b[3] == "B" and a[2] + least <= b[2] <= a[2] + most), default=None)
        for a in rows if a[3] == "A"
    }
    want = {a: t for a, t in answers.items() if (t is not None) == followed}
    assert {(r.k, r.id): r.second_time for r in got} == want and len(got) == len(want)


def test_one_event_on_both_sides_does_not_answer_itself(spark, tmp_path):
    rows = [("x", 1, 0, "A", 1), ("x", 2, 0, "A", 1), ("x", 3, 2 * SECOND, "A", 1)]
    both = F.col("kind") == "A"
    got = stream(spark, tmp_path, everything([rows]), lambda e: ordered.sequences(e, ["k"], "id", both, both, 0, 3 * SECOND, True))
    assert {(r.id, r.second_time) for r in got} == {(1, 2 * SECOND), (2, 2 * SECOND)}


def test_a_hot_key_is_linear(spark, tmp_path):
    """Every first is looked at a constant number of times, however many are open."""
    looked = []

    class Map(dict):
        def containsKey(self, k):
            return k in self

        def getValue(self, k):
            looked.append(k)
            return self[k]

        updateValue, removeKey = dict.__setitem__, dict.__delitem__

    class Value:
        held = None
        exists = lambda self: self.held is not None
        get = lambda self: self.held

        def update(self, v):
            self.held = v

    s = ordered.Sequence(["k"], [], ["k"])
    s.queue, s.ends, s.timer = Map(), Value(), lambda end: None
    n = 20_000
    for i in range(n):
        second = i % 1000 == 999
        row = {"time": i * 1000, "rank": 0, "tie": i, "is_first": not second, "is_second": second, "least": 1, "most": 10**12, "wanted": True}
        list(s.step(("k",), [row]))
    assert len(looked) < 2 * n and not s.queue


def test_late_rows_are_seen(spark, tmp_path):
    batches = [[("x", 1, 100 * SECOND, "A", 1)], [("x", 2, 500 * SECOND, "A", 1)], [("x", 3, 90 * SECOND, "A", 1), ("x", 4, 450 * SECOND, "A", 1), ("new", 5, 1, "B", 1)]]
    got = stream(spark, tmp_path, everything(batches), lambda e: ordered.periods(e, ["k"], "id", 1))
    assert {r.id for r in got if r.late} == {3, 5} and {r.id for r in got if not r.late} == {1, 2, 4}
    table = spark.createDataFrame([r.asDict() for r in got])
    letters = ordered.late_letters(table, F.lit("PAY"), "id")
    assert {(r.source, r.seq, r.error_code) for r in letters.collect()} == {("PAY", 3, "ERR_STREAM_LATE_EVENT"), ("PAY", 5, "ERR_STREAM_LATE_EVENT")}


def test_the_clock_falls_back(spark):
    rows = spark.sql("select * from values (5L, timestamp_micros(7)), (null, timestamp_micros(7)), (null, timestamp_micros(0)), (null, null) as v(t, r)")
    found = [r.time for r in ordered.with_clock(rows, "t", "r").collect()]
    assert found[:2] == [5, 7] and found[2] == found[3] > 1_600_000_000 * SECOND


def test_profile_lookup_follows_writes(spark, tmp_path):
    hour = 3600 * SECOND
    schema = "k string, id bigint, t bigint, mode string, dataset string, fields map<string,string>"
    ask = lambda k, i, t: (k, i, t, None, None, None)
    rows = [
        ("x", 1, 1 * hour, "FULL_SNAPSHOT", "d", {"a": "1", "b": "2"}), ("x", 2, 2 * hour, "UPSERT", "d", {"b": "3"}), ("x", 3, 3 * hour, "FULL_SNAPSHOT", "d", {"c": "4"}),
        ("x", 4, 3 * hour, "UPSERT", "e", {"a": "9"}), ("x", 5, 4 * hour, "DELETE", "d", {}), ("x", 6, 39 * hour, "UPSERT", "d", {"a": "7"}),
        ask("x", 11, hour - 1), ask("x", 12, hour), ask("x", 13, 2 * hour + 1), ask("x", 14, 3 * hour), ask("x", 15, 5 * hour), ask("x", 16, 39 * hour - 1), ask("x", 17, 40 * hour),
        ask("y", 18, hour), ask("y", 19, 36 * hour), ask(None, 20, hour),
    ]
    random.Random(4).shuffle(rows)
    batches = [rows, [ask("end", 99, 10_000 * hour)]]
    initial = spark.createDataFrame([("y", "d", "a", "0", 1 * SECOND), ("x", "d", "c", "old", 0)], "k string, dataset string, field string, value string, t bigint")

    def operator(e):
        return ordered.profile_lookup(e.where("mode IS NULL"), e.where("mode IS NOT NULL"), "k", "id", ["d.a", "d.b", "d.c", "e.a"], 36 * 3600 * 1000, initial=initial)

    got = stream(spark, tmp_path, batches, operator, schema=schema, clock=lambda e: e)
    assert {r.id: (r.found, r.last_write) for r in got if r.id < 99} == {
        11: ({"d.c": "old"}, None), 12: ({"d.a": "1", "d.b": "2"}, 1), 13: ({"d.a": "1", "d.b": "3"}, 2), 14: ({"d.c": "4", "e.a": "9"}, 4), 15: ({"e.a": "9"}, 5),
        16: ({"e.a": "9"}, 5), 17: ({"d.a": "7"}, 6), 18: ({"d.a": "0"}, None), 19: ({"d.a": "0"}, None),
    }
