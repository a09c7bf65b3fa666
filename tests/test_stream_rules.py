"""Whole rules on a stream: equal to the batch form, late rows apart, and no rule that stops the query."""

import json
import random

import pytest
from pyspark.sql import functions as F

from tests.test_one_pass import tables
from tests.test_rules import c, rule
from tests.test_streaming import lines
from tidewatch.operators.evaluate import hits_of
from tidewatch.operators.match import events_of
from tidewatch.sources import records
from tidewatch.streaming import pipeline
from tidewatch.streaming.rules import rule_stream, stateful_hits

SECOND = 1_000_000
SCHEMA = "seq bigint, source string, payload string, t bigint"
MEMBER = {"op": "IN_DATASET", "dataset_id": "one", "fields": ["s"]}
PAIR = {"op": "IN_DATASET", "dataset_id": "two", "fields": ["s", "x"]}


def node(e):
    return {"type": "CONDITION", "expression": e}


def both(*nodes):
    return {"type": "AND", "children": list(nodes)}


def sequence(pattern, least, most, first=(), second=()):
    return {"type": "SEQUENCE", "pattern": pattern, "min_time": least, "max_time": most, "time_unit": "second", "join_keys": [{"left_field": "first.k", "right_field": "second.k"}],
            "first": {"source": "S", "filter": list(first)}, "second": {"source": "S", "filter": list(second)}}


RULES = [
    rule("plain", [[c("x", ">", 4)]]),
    rule("member", [[MEMBER]], tree={"type": "OR", "children": [node(PAIR), node(c("x", "<", 5))]}),
    rule("outside", [], tree=both(node({**MEMBER, "negate": True}), node(c("x", ">", 2)))),
    rule("twice", [], tree=both(node(MEMBER), node({**MEMBER, "fields": ["k"], "negate": True}))),
    rule("first", [[c("x", ">", 1)]], tree=both(node({"op": "IS_FIRST_ARRIVAL", "key_fields": ["k"], "ttl": "9s"}), node(c("s", "!=", "r")))),
    rule("listed_first", [[MEMBER]], tree=node({"op": "IS_FIRST_ARRIVAL", "key_fields": ["k", "s"], "ttl": "20s"})),
    rule("ever", [], tree=node({"op": "IS_FIRST_ARRIVAL", "key_fields": ["s"]})),
    rule("answered", [], tree=sequence("FOLLOWED_BY", 1, 6, [c("x", ">", 5)], [c("x", "<", 3)])),
    rule("open", [[c("x", ">", 0)]], tree=both(sequence("NOT_FOLLOWED_BY", 0, 4, [MEMBER], [{**MEMBER, "negate": True}]), node(c("x", "<", 8)))),
]


def run(spark, tmp_path, batches, rules, datasets):
    folder, source = str(tmp_path / "out"), str(tmp_path / "in")
    for rows in batches:
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(source)
        events = events_of(spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(source))
        rule_stream(events, rules, folder, "t", "seq", datasets).awaitTermination()
    return folder


def test_stream_equals_batch(spark, tmp_path):
    rnd = random.Random(8)
    rows, _, _, _, ds, _ = tables(spark, rnd, 150)
    lined = [(i, r["source"], json.dumps(r["payload"]), r["t"]) for i, r in enumerate(rows)]
    lined.sort(key=lambda r: r[3] + rnd.randrange(50 * SECOND))
    late = (900, "S", json.dumps({"k": "u1", "s": "p", "x": 6}), 1)
    batches = [lined[:60], lined[60:], [(901, "S", json.dumps({"x": 0}), 10_000 * SECOND)], [late], [(902, "S", json.dumps({"x": 0}), 20_000 * SECOND)]]
    folder = run(spark, tmp_path, batches, RULES, ds)
    got = sorted((r.rule_id, r.seq) for r in spark.read.parquet(f"{folder}/hits").collect() if r.seq < 900)
    whole = events_of(spark.createDataFrame(lined, SCHEMA))
    want = sorted((r.rule_id, r.seq) for r in hits_of(whole, RULES, "t", "seq", ds).collect())
    assert got == want and {r for r, _ in want} == {r["rule_id"] for r in RULES}
    letters = {(r.source, r.seq, r.error_code) for r in spark.read.parquet(f"{folder}/dlq").collect()}
    assert {(s, n) for s, n, _ in letters} == {(r, 900) for r in ("first", "listed_first", "ever", "answered", "open")}
    assert {r.rule_id: r.n for r in spark.read.parquet(f"{folder}/late").collect()} == dict.fromkeys(("first", "listed_first", "ever", "answered", "open"), 1)


def test_rules_that_need_two_orders_are_refused(spark, tmp_path):
    first = node({"op": "IS_FIRST_ARRIVAL", "key_fields": ["k"], "ttl": "9s"})
    spark.createDataFrame([(1, "S", "{}", 1)], SCHEMA).write.parquet(str(tmp_path / "in"))
    events = events_of(spark.readStream.schema(SCHEMA).parquet(str(tmp_path / "in")))
    for tree in (both(first, sequence("FOLLOWED_BY", 0, 1)), {"type": "OR", "children": [first, node(c("x", ">", 1))]}):
        with pytest.raises(ValueError, match="on a stream a rule is"):
            stateful_hits(events, [rule("r", [], tree=tree)], "t", "seq")


def test_a_mixed_catalogue_does_not_stop_the_matcher(spark, tmp_path):
    """A rule whose trigger asks a dataset takes no part in the stateless stream, and the others go on."""
    docs = [rule("plain", [[c("a", ">=", 1)]]), rule("by_trigger", [[{"op": "IN_DATASET", "dataset_id": "d", "fields": ["a"]}]]),
            rule("profile", [[{"expr": "prof.x + a", "op": ">", "value": 1}]])]
    table = spark.createDataFrame([(i, d["rule_id"], json.dumps(d), 1, True, "false", "c") for i, d in enumerate(docs)],
                                  "seq bigint, rule_id string, rule_json string, version bigint, enabled boolean, deleted string, op string")
    lines(spark, str(tmp_path / "in"), "t", [{"seq": 1, "a": 1}])
    shaped = lambda b: b.select(F.get_json_object("payload", "$.seq").cast("bigint").alias("seq"), F.lit("S").alias("source"), "payload")
    pipeline.rule_matching(records.stream_lines(spark, str(tmp_path / "in")), lambda s: table, str(tmp_path / "out"), shaped, {"prof"}).awaitTermination()
    assert [(r.seq, r.rule_id) for r in spark.read.parquet(str(tmp_path / "out/hits")).collect()] == [(1, "plain")]
