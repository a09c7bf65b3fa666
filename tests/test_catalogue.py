"""Catalogues folded from change streams, and the queries that follow them."""

import json
import random
import time

import pytest

from tidewatch.operators.rules import live_rules, parse_rules
from tidewatch.operators.schemas import Registry, read_schemas
from tidewatch.sources import records
from tidewatch.sources.changes import GONE
from tidewatch.streaming import pipeline
from tidewatch.streaming.catalogue import Catalogue, Supervisor, keep, latest, topic_settings

RULE = "seq bigint, rule_id string, rule_json string, version bigint, enabled boolean, deleted string, op string"
SCHEMA = "seq bigint, schema_id string, schema_payload string, __deleted string, __op string"


def turn(spark, rows, ddl, folder, fold, **more):
    """One more turn of a change stream."""
    spark.createDataFrame(rows, ddl).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    keep(spark.readStream.schema(ddl).parquet(f"{folder}/in"), fold, f"{folder}/kept", **more).awaitTermination()


def test_rules_in_turns_equal_one_fold(spark, tmp_path):
    rng = random.Random(11)
    log = [
        (i, f"r{rng.randrange(5)}", json.dumps({"n": i}), rng.randrange(4), rng.random() < 0.9, "true" if rng.random() < 0.15 else "false", "u")
        for i in range(60)
    ]
    live, walked = {}, []
    catalogue = Catalogue(spark, f"{tmp_path}/kept", spark.createDataFrame([], RULE))
    assert catalogue().collect() == [] and catalogue.version == -1
    for at in range(0, 60, 20):
        for seq, rule_id, _, version, enabled, deleted, _ in log[at : at + 20]:
            if rule_id in live and version <= live[rule_id][1]:
                continue
            live.pop(rule_id, None)
            if enabled and deleted == "false":
                live[rule_id] = (seq, version)
        turn(spark, log[at : at + 20], RULE, tmp_path, live_rules)
        walked.append({r.rule_id: (r.seq, r.version) for r in catalogue().collect()})
        assert walked[-1] == live


def test_only_a_changed_catalogue_is_built_again(spark, tmp_path):
    built = []
    catalogue = Catalogue(spark, f"{tmp_path}/kept", spark.createDataFrame([], SCHEMA), lambda df: built.append(1) or sorted((r.schema_id, r.schema_payload) for r in df.collect()))
    fold = latest(["schema_id"], "seq", GONE)
    steps = [
        ([(1, "a", "x", None, "c"), (2, "b", None, None, "c")], [("a", "x"), ("b", None)]),
        ([(3, "gone", "y", None, "d"), (4, None, None, None, "d")], [("a", "x"), ("b", None)]),  # nothing there to delete
        ([(5, "a", "z", None, "u"), (6, "b", "q", "TRUE", "u")], [("a", "z")]),
        ([(0, "a", "late", None, "u")], [("a", "z")]),
        ([(7, "a", None, None, "d")], []),
    ]
    versions, times = [], []
    for rows, want in steps:
        turn(spark, rows, SCHEMA, tmp_path, fold, retain=2)
        assert catalogue() == want and catalogue() == want
        versions.append(catalogue.version)
        times.append(len(built))
    assert versions == [0, 0, 2, 2, 4] and times == [2, 2, 3, 3, 4]
    # A snapshot for each of the two newest versions stays; one that repeats its predecessor does not.
    assert sorted(p.name for p in (tmp_path / "kept" / "versions").iterdir()) == ["epoch=2", "epoch=4"]


def test_a_replayed_epoch_changes_nothing(spark, tmp_path):
    """An epoch whose snapshot was written but not logged is done again; one that was logged is left alone."""
    fold = latest(["schema_id"], "seq", GONE)
    turn(spark, [(1, "a", "x", None, "c")], SCHEMA, tmp_path, fold)
    pipeline.write_epoch(spark.createDataFrame([(9, "half", "written", None, None)], SCHEMA), f"{tmp_path}/kept/versions", 1)
    turn(spark, [(2, "b", "y", None, "c")], SCHEMA, tmp_path, fold)
    catalogue = Catalogue(spark, f"{tmp_path}/kept", spark.createDataFrame([], SCHEMA))
    assert sorted(r.schema_id for r in catalogue().collect()) == ["a", "b"]
    for name in ("commits/1", "commits/.1.crc"):
        (tmp_path / "kept" / "checkpoint" / name).unlink()
    turn(spark, [(3, "c", "z", None, "c")], SCHEMA, tmp_path, fold)
    assert sorted(r.schema_id for r in catalogue().collect()) == ["a", "b", "c"] and catalogue.version == 2


def test_changes_take_effect_in_the_next_epoch(spark, tmp_path):
    """Rules and output layouts that change between the micro-batches of one matching query."""
    rule = lambda least: json.dumps({"rule_id": "big", "trigger_criteria": [{"source": "PAY", "key_field": "msisdn", "conditions": [[{"field": "amount", "op": ">", "value": least}]]}]})
    layout = "seq bigint, rule_id string, target string, source string"
    rules = Catalogue(spark, f"{tmp_path}/rules/kept", spark.createDataFrame([], RULE), parse_rules)
    layouts = Catalogue(spark, f"{tmp_path}/layouts/kept", spark.createDataFrame([], layout))
    parts = iter([[(1, 60), (2, 20)], [(3, 60), (4, 20)], [(5, 60)]])

    def events(rows):
        told = [(seq, "PAY", json.dumps({"msisdn": "0981234567", "amount": amount})) for seq, amount in rows]
        spark.createDataFrame(told, "seq bigint, source string, payload string").coalesce(1).write.mode("append").parquet(f"{tmp_path}/events")
        read = spark.readStream.schema("seq bigint, source string, payload string").parquet(f"{tmp_path}/events")
        pipeline.rule_matching(read, rules, f"{tmp_path}/out", layouts=layouts).awaitTermination()
        return {r.seq for r in spark.read.parquet(f"{tmp_path}/out/hits").collect()}, {
            r.seq: json.loads(r.value) for r in spark.read.parquet(f"{tmp_path}/out/output").collect()
        }

    turn(spark, [(1, "big", rule(50), 1, True, "false", "c")], RULE, tmp_path / "rules", live_rules)
    turn(spark, [(1, "*", "n", "event.amount")], layout, tmp_path / "layouts", latest(["rule_id", "target"], "seq"))
    assert events(next(parts)) == ({1}, {1: {"n": "60"}})
    turn(spark, [(2, "big", rule(10), 2, True, "false", "u")], RULE, tmp_path / "rules", live_rules)
    turn(spark, [(2, "*", "n", "=many")], layout, tmp_path / "layouts", latest(["rule_id", "target"], "seq"))
    assert events(next(parts)) == ({1, 3, 4}, {1: {"n": "60"}, 3: {"n": "many"}, 4: {"n": "many"}})
    turn(spark, [(3, "big", rule(10), 3, False, "false", "u")], RULE, tmp_path / "rules", live_rules)
    assert events(next(parts))[0] == {1, 3, 4}


def test_validation_follows_the_schema_catalogue(spark, tmp_path):
    table = "seq bigint, schema_id string, schema_payload string, __deleted string, __op string"
    payload = lambda required: json.dumps({"schema_type": "STREAM", "topic": "pay", "fields": {"amount": {"type": "NUMBER", "required": required}}})
    registry = Catalogue(spark, f"{tmp_path}/kept", spark.createDataFrame([], table), lambda df: Registry.of(read_schemas(df, "seq")))
    source, out = f"{tmp_path}/lines", f"{tmp_path}/out"
    counts = []
    for seq, required in ((1, True), (2, False)):
        turn(spark, [(seq, "pay_v1", payload(required), None, "u")], table, tmp_path, latest(["schema_id"], "seq", GONE))
        records.write_lines(spark.createDataFrame([("pay", json.dumps({"msisdn": "0981234567"}))], "topic string, payload string"), source)
        pipeline.stream_validation(records.stream_lines(spark, source), registry, out).awaitTermination()
        counts.append(tuple(spark.read.option("mergeSchema", "true").parquet(f"{out}/{part}").count() for part in ("valid", "dlq")))
    assert counts == [(0, 1), (1, 1)]


def test_the_supervisor_restarts_from_the_checkpoint(spark, tmp_path):
    """A changed topic list: the query goes on where it was, with the new topic's lines and without repeating any."""
    def send(topic, *payloads):
        records.write_lines(spark.createDataFrame([(topic, p) for p in payloads], "topic string, payload string").coalesce(1), f"{tmp_path}/in")

    def begin(name, topics):
        rows = records.stream_lines(spark, f"{tmp_path}/in", 10).where(f"topic IN ({', '.join(map(repr, topics))})")
        work = lambda batch, epoch: pipeline.write_epoch(batch.select("topic", "payload"), f"{tmp_path}/{name}/out", epoch)
        return pipeline.start(rows, work, f"{tmp_path}/{name}/checkpoint", processingTime="0 seconds")

    def seen(name, n):
        for _ in range(200):
            if (tmp_path / name / "out").exists():
                found = sorted(r.payload for r in spark.read.schema("topic string, payload string").parquet(f"{tmp_path}/{name}/out").collect())
                if len(found) >= n:
                    return found
            time.sleep(0.1)
        raise AssertionError("the query saw too little")

    topics = {"a": ("t1",)}
    guard = Supervisor(lambda: topics, begin)
    try:
        send("t1", "1")
        assert guard.step() == {"a": "started"} and seen("a", 1) == ["1"]
        assert guard.step() == {}
        topics = {"a": ("t1", "t2"), "b": ("t1",)}
        assert guard.step() == {"a": "restarted", "b": "started"}
        send("t2", "2")
        send("t1", "3")
        assert seen("a", 3) == ["1", "2", "3"] and seen("b", 2) == ["1", "3"]
        topics = {"a": ("t1", "t2")}
        assert guard.step() == {"b": "stopped"}
        guard.running["a"][1].stop()
        send("t2", "4")
        assert guard.step() == {"a": "resumed"} and seen("a", 4) == ["1", "2", "3", "4"]
    finally:
        guard.stop()
    assert guard.running == {}


def test_the_supervisor_gives_up_on_a_query_that_keeps_failing():
    class Failed:
        isActive, stops = False, 0

        def exception(self):
            return RuntimeError("broken")

        def stop(self):
            Failed.stops += 1

    guard = Supervisor(lambda: {"a": 1}, lambda name, settings: Failed(), attempts=3)
    assert [guard.step() for _ in range(3)] == [{"a": "started"}, {"a": "resumed"}, {"a": "resumed"}]
    with pytest.raises(RuntimeError, match="broken"):
        guard.step()
    assert guard.running == {} and Failed.stops == 1


def test_topic_settings(spark):
    clusters = spark.createDataFrame([(1, "s", "c1", "h:1", True, "SSL"), (2, "s", "c2", "h:2", True, None)], "id int, stream_id string, cluster_name string, bootstrap_servers string, enabled boolean, security_protocol string")
    topics = spark.createDataFrame([(1, "b", True), (1, "a", True)], "cluster_config_id int, topic_name string, enabled boolean")
    found = topic_settings(records.cluster_topics(clusters, topics))
    assert found == {"s-c1": ("h:1", ("a", "b"), (("kafka.security.protocol", "SSL"),))}
