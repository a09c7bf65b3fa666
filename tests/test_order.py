import random

import pytest
from pyspark.sql import functions as F

from tidewatch.operators import profile, sequence
from tidewatch.operators.features import apply_corrections, latest_partition, latest_with_status
from tidewatch.operators.scans import asof, in_pieces, prior_max, with_once


def rows_of(n, seed=1, hot=0.4, span=2000):
    """Random events where one key holds a large part of the rows."""
    rnd = random.Random(seed)
    return [(i, "hot" if rnd.random() < hot else f"k{rnd.randrange(5)}", rnd.randrange(span), rnd.choice("AB")) for i in range(n)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "id bigint, k string, t bigint, kind string")


@pytest.mark.parametrize("cold_rows", [10_000, 30, 0])
@pytest.mark.parametrize("ttl", [7, 150, 5000])
def test_first_arrival_ttl_against_a_walk(spark, ttl, cold_rows):
    rows = rows_of(300)
    want, last = set(), {}
    for i, k, t, _ in sorted(rows, key=lambda r: (r[2], r[0])):
        if k not in last or t >= last[k] + ttl:
            want.add(i)
            last[k] = t
    got = sequence.first_arrival_ttl(frame(spark, rows), ["k"], "t", "id", ttl, cold_rows)
    assert {r.id for r in got.collect()} == want


def test_first_arrival_keeps_null_keys_out(spark):
    df = frame(spark, [(1, None, 5, "A"), (2, "k", 5, "A"), (3, "k", 4, "B")])
    assert [r.id for r in sequence.first_arrival(df, ["k"], F.struct("t", "id")).collect()] == [3]
    assert [r.id for r in sequence.first_arrival_ttl(df, ["k"], "t", "id", 10).collect()] == [3]


def test_cooldown(spark):
    hits = spark.createDataFrame(
        [(i, r, k, t * 1_000_000) for i, (r, k, t) in enumerate([("a", "x", 0), ("a", "x", 2), ("a", "x", 3), ("b", "x", 0), ("b", "x", 1), ("a", None, 0), ("a", None, 1)])],
        "id bigint, rule_id string, partition_key string, t bigint",
    )
    kept = sequence.cooldown(hits, {"a": 3, "b": 0}, "t", "id")
    assert sorted(r.id for r in kept.collect()) == [0, 2, 3, 4, 5, 6]


@pytest.mark.parametrize("slot", [1, 13, 100_000])
@pytest.mark.parametrize("least,most", [(0, 20), (5, 9), (0, 0)])
def test_sequences_against_brute_force(spark, slot, least, most):
    rows = rows_of(250, seed=2)
    a, b = [r for r in rows if r[3] == "A"], [r for r in rows if r[3] == "B"]
    answers = {x[0]: [y[2] for y in b if y[1] == x[1] and x[2] + max(least, 1) <= y[2] <= x[2] + most] for x in a}
    df = frame(spark, rows)
    sides = (df.where("kind = 'A'"), df.where("kind = 'B'"), ["k"], "t", least, most, slot)
    assert {r.id: r.second_time for r in sequence.followed_by(*sides).collect()} == {i: min(t) for i, t in answers.items() if t}
    assert {r.id for r in sequence.not_followed_by(*sides).collect()} == {i for i, t in answers.items() if not t}


@pytest.mark.parametrize("forward", [False, True])
@pytest.mark.parametrize("slot", [1, 17, 10_000])
def test_asof_against_brute_force(spark, forward, slot):
    left, right = rows_of(120, seed=5), rows_of(60, seed=6) + [(900, None, 5, "A")]
    left.append((901, None, 50, "A"))

    def best(k, t):
        near = [(y[2], y[0]) for y in right if k is not None and y[1] == k and (y[2] >= t if forward else y[2] <= t)]
        return (min(near) if forward else max(near))[1] if near else None

    got = asof(frame(spark, left), frame(spark, right), ["k"], "t", "t", F.col("id"), "found", slot, forward, tie=F.col("id"))
    assert {r.id: r.found for r in got.collect()} == {x[0]: best(x[1], x[2]) for x in left}


@pytest.mark.parametrize("forward", [False, True])
@pytest.mark.parametrize("piece_rows", [1, 6])
def test_asof_over_pieces_of_a_slot(spark, forward, piece_rows):
    """Cutting a slot changes no answer, with ties across and inside pieces and keys or times that are null."""
    left, right = rows_of(150, seed=7, span=300), rows_of(80, seed=8, span=300) + [(900, None, 5, "A"), (902, "hot", None, "A")]
    left += [(901, None, 50, "A"), (903, "hot", None, "A")]

    def best(k, t):
        if k is None or t is None:
            return None
        near = [(y[2], y[0]) for y in right if y[1] == k and y[2] is not None and (y[2] >= t if forward else y[2] <= t)]
        return (min(near) if forward else max(near))[1] if near else None

    got = asof(frame(spark, left), frame(spark, right), ["k"], "t", "t", F.col("id"), "found", 100_000, forward, F.col("id"), piece_rows)
    rows = got.collect()
    assert len(rows) == len(left) and {r.id: r.found for r in rows} == {x[0]: best(x[1], x[2]) for x in left}


def test_a_full_slot_is_cut_at_equal_depth(spark):
    """All rows of one key in one slot, most of them in a short burst: pieces of about equal size, in the order of time."""
    lines = spark.range(4000).selectExpr("'hot' k", "CASE WHEN id < 3000 THEN 500000 + id DIV 2 ELSE id * 200 END _t")
    lines = lines.unionByName(spark.range(5).selectExpr("'cold' k", "id _t"))
    got = in_pieces(lines, ["k"], 1_000_000, 100).groupBy("k", "_slot", "_piece").agg(F.count("*").alias("n"), F.min("_t").alias("a"), F.max("_t").alias("b")).collect()
    assert [(r._piece, r.n) for r in got if r.k == "cold"] == [(0, 5)]
    hot = sorted((r.a, r.b, r._piece, r.n) for r in got if r.k == "hot")
    # A fine part of this slot is 244 wide, so at most 488 rows of the burst stand in one.
    assert len(hot) > 8 and max(n for *_, n in hot) <= 100 + 488 and sum(n for *_, n in hot) == 4000
    assert all(x[1] < y[0] and x[2] < y[2] for x, y in zip(hot, hot[1:]))


@pytest.mark.parametrize("chunk", [1, 7, 1000])
@pytest.mark.parametrize("descending", [False, True])
def test_prior_max_against_brute_force(spark, chunk, descending):
    rows = rows_of(100, seed=9)
    got = prior_max(frame(spark, rows), ["k"], "id", F.when(F.col("kind") == "A", F.col("t")), "m", chunk, descending)
    before = lambda r: [y[2] for y in rows if y[1] == r[1] and y[3] == "A" and (y[0] > r[0] if descending else y[0] < r[0])]
    assert {r.id: r.m for r in got.collect()} == {r[0]: max(before(r), default=None) for r in rows}


def test_hot_key_is_spread(spark):
    df = spark.range(1000).selectExpr("id", "'hot' k", "id * 1000000 t", "'A' kind")
    plan = sequence.followed_by(df, df, ["k"], "t", 0, 5)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(k" in plan and "_slot" in plan[plan.index("hashpartitioning(k") :][:60]


def test_with_once_replaces_and_holds_filters_back(spark):
    df = with_once(spark.range(5).withColumn("x", F.lit(1)), x=F.col("id") + 1).where("x > 3")
    assert sorted(r.x for r in df.collect()) == [4, 5]


def batch_events(spark, rows):
    schema = "seq bigint, key_value string, dataset_name string, sync_mode string, batch_id string, snapshot_ms bigint, d string"
    return spark.createDataFrame(rows, schema).withColumn("data", F.try_parse_json("d"))


def test_profile_modes_and_split_deltas(spark):
    rows = [
        (1, "k", "d", "FULL_SNAPSHOT", "b1", 1, '{"a":1,"b":2}'), (2, "k", "d", "UPSERT", "b1", 1, '{"b":3,"c":null}'), (3, "k", "other", "UPSERT", "b1", 1, '{"z":9}'),
        (4, "k", "d", "FULL_SNAPSHOT", "b2", 2, '{"a":7}'), (5, "k", "d", "UPSERT", "b2", 2, '{"e":true}'), (6, "gone", "d", "UPSERT", "b2", 2, '{"a":1}'),
        (7, "gone", "d", "DELETE", "b2", 2, None), (8, "back", "d", "DELETE", "b2", 2, None), (9, "back", "d", "UPSERT", "b3", 3, '{"a":5}'), (10, "set", "d", "UPSERT", "b3", 3, "{}"),
    ]
    want = {("k", "d", "a", "7"), ("k", "d", "e", "true"), ("k", "other", "z", "9"), ("back", "d", "a", "5")}
    events = batch_events(spark, rows)
    pick = lambda p: {(r.key_value, r.dataset_name, r.field, r.value) for r in p.collect()}
    assert pick(profile.fold_profile(events)) == want
    halves = profile.profile_delta(events.where("seq % 2 = 0")).unionByName(profile.profile_delta(events.where("seq % 2 = 1")))
    assert pick(profile.profile_of(profile.merge_deltas(halves))) == want
    active = profile.active_batches(events)
    assert {r.dataset_name: r.active_batch_id for r in active.collect()} == {"d": "b3", "other": "b1"}
    assert pick(profile.guard_epoch(profile.fold_profile(events), active)) == {("k", "other", "z", "9"), ("back", "d", "a", "5")}
    assert pick(profile.current_profile(events)) == pick(profile.guard_epoch(profile.fold_profile(events), active))
    assert {r.key_value for r in profile.membership(events).where("dataset_name = 'd'").collect()} == {"k", "back", "set"}
    assert pick(profile.unexpired(profile.fold_profile(events), F.lit(4), 2)) == {("back", "d", "a", "5")}


def test_feature_helpers(spark):
    rows = spark.createDataFrame([("a", 1, 1), ("a", 2, 0), ("b", 1, 1)], "k string, at int, status int")
    assert [r.k for r in latest_with_status(rows, "k", ["at"], "status", 1).collect()] == ["b"]
    assert {r.k for r in latest_partition(rows, "at", F.lit(1)).collect()} == {"a", "b"}
    updates = spark.createDataFrame([("a", 1, 9), ("a", 2, None)], "k string, changed int, status int")
    merged = apply_corrections(rows.where("at = 1"), updates, "k", "changed")
    assert {(r.k, r.status, r.corrected) for r in merged.collect()} == {("a", 1, True), ("b", 1, False)}


def test_an_event_does_not_answer_itself(spark):
    df = spark.createDataFrame([(1, "k", 10), (2, "k", 14), (3, "q", 5)], "id int, k string, t bigint")
    assert {r.id for r in sequence.followed_by(df, df, ["k"], "t", 0, 5).collect()} == {1}
    assert {r.id for r in sequence.not_followed_by(df, df, ["k"], "t", 0, 5).collect()} == {2, 3}
