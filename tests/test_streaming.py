import json

import pytest
from pyspark.sql import functions as F

from tests.test_validate import TRANSFER, TRIAL, envelope, schemas
from tidewatch.operators.schemas import Registry
from tidewatch.sources import records
from tidewatch.streaming import pipeline


def lines(spark, path, topic, payloads):
    df = spark.createDataFrame([(topic, p if isinstance(p, str) else json.dumps(p)) for p in payloads], "topic string, payload string")
    records.write_lines(df.coalesce(1), path)


def test_lines_round_trip(spark, tmp_path):
    lines(spark, str(tmp_path / "in"), "t1", ["a", "b"])
    lines(spark, str(tmp_path / "in"), "t2", ["c"])
    assert {(r.topic, r.payload) for r in records.read_lines(spark, str(tmp_path / "in")).collect()} == {("t1", "a"), ("t1", "b"), ("t2", "c")}
    (tmp_path / "flat").mkdir()
    (tmp_path / "flat" / "topic-x.jsonl").write_text('{"a":1}\n')
    assert records.read_lines(spark, str(tmp_path / "flat")).first()[:] == ("topic-x", None, '{"a":1}')


def test_kafka_options():
    listed = records.kafka_options("h:1", ["a", "b"], **{"kafka.security.protocol": "SASL_SSL"})
    assert (listed["subscribe"], listed["startingOffsets"], listed["kafka.security.protocol"]) == ("a,b", "earliest", "SASL_SSL")
    assert records.kafka_options("h:1", pattern="^x.*")["startingOffsets"] == "latest"
    with pytest.raises(ValueError):
        records.kafka_options("h:1")


def test_kafka_rows_become_records(spark):
    raw = spark.sql("select 't' topic, cast('k' as binary) key, cast(null as binary) value, timestamp '2024-01-01' timestamp")
    assert records.records(raw).first()[:3] == ("t", "k", "")


def test_cluster_topics(spark):
    clusters = spark.createDataFrame([(1, "s", "c1", "h:1", True), (2, "s", "c2", "h:2", True), (3, "s", "c3", "h:3", False)], "id int, stream_id string, cluster_name string, bootstrap_servers string, enabled boolean")
    topics = spark.createDataFrame([(1, "b", True), (1, "a", True), (1, "off", False), (3, "x", True)], "cluster_config_id int, topic_name string, enabled boolean")
    assert {r.cluster_name: r.topics for r in records.cluster_topics(clusters, topics).collect()} == {"c1": ["a", "b"], "c2": []}


def test_clusters_keep_their_security(spark):
    clusters = spark.createDataFrame([(1, "s", "c1", "h:1", True, " SASL_SSL ", "", None), (2, "s", "c2", "h:2", True, None, "PLAIN", "x y;")],
        "id int, stream_id string, cluster_name string, bootstrap_servers string, enabled boolean, security_protocol string, sasl_mechanism string, sasl_jaas_config string")
    topics = spark.createDataFrame([(1, " a ", True)], "cluster_config_id int, topic_name string, enabled boolean")
    found = {r.cluster_name: (r.topics, r.properties) for r in records.cluster_topics(clusters, topics).collect()}
    assert found == {"c1": (["a"], {"kafka.security.protocol": "SASL_SSL"}), "c2": ([], {"kafka.sasl.mechanism": "PLAIN", "kafka.sasl.jaas.config": "x y;"})}


def test_stream_validation_restarts_from_its_checkpoint(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    good, bad = {"msisdn": "0981234567", "transAmount": 1}, {"msisdn": "0981234567"}
    lines(spark, source, "pay-topic", [good, bad, "{"])
    registry = Registry.of(schemas(spark, TRANSFER))
    run = lambda: pipeline.stream_validation(records.stream_lines(spark, source), lambda s: registry, out).awaitTermination()
    run()
    lines(spark, source, "pay-topic", [good])
    run()
    valid = spark.read.parquet(f"{out}/valid")
    assert sorted((r.epoch, r.event_key) for r in valid.collect()) == [(0, "+84981234567"), (1, "+84981234567")]
    codes = [json.loads(r.value)["error_code"] for r in spark.read.parquet(f"{out}/dlq").collect()]
    assert sorted(codes) == ["ERR_STREAM_JSON_MALFORMED", "ERR_STREAM_VALIDATION_FAILED"]


def test_snapshot_marks_and_profile_cross_epochs(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    registry = Registry.of(schemas(spark, TRIAL))
    as_of = F.lit("2024-06-01").cast("timestamp")

    def numbered(batch):
        return batch.withColumn("seq", F.get_json_object("payload", "$.n").cast("bigint"))

    def run():
        pipeline.batch_validation(records.stream_lines(spark, source), lambda s: registry, out, as_of, numbered).awaitTermination()

    lines(spark, source, "batch_trial", [{**envelope(snapshot_time="2024-01-02T00:00:00Z"), "n": 1}])
    run()
    late = {**envelope(), "n": 2}
    patch = {**envelope(sync_mode="UPSERT", snapshot_time="2024-01-03T00:00:00Z", data={"x": 5}), "n": 3}
    lines(spark, source, "batch_trial", [late, patch])
    run()
    codes = [json.loads(r.value)["error_code"] for r in spark.read.parquet(f"{out}/dlq").collect()]
    assert codes == ["ERR_BATCH_STALE_SNAPSHOT"]
    want = {("sub_code", "VTM1"), ("x", "5")}
    assert {(r.field, r.value) for r in pipeline.live_profile(spark, out).collect()} == want
    pipeline.compact_deltas(spark, out, 2, str(tmp_path / "merged"))
    from tidewatch.operators.profile import profile_of

    assert {(r.field, r.value) for r in profile_of(spark.read.parquet(str(tmp_path / "merged"))).collect()} == want
    pipeline.compact_deltas(spark, out, 1, str(tmp_path / "first"))
    assert {(r.field, r.value) for r in pipeline.live_profile(spark, out, str(tmp_path / "first"), 1).collect()} == want


def test_rule_catalogue_is_read_per_epoch(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    versions = []

    def log(s):
        versions.append(1)
        doc = {"trigger_criteria": [{"source": "S", "conditions": [[{"field": "a", "op": ">=", "value": len(versions)}]]}]}
        stateful = {**doc, "condition_tree": {"type": "CONDITION", "expression": {"field": "a", "op": "IN_DATASET", "dataset_id": "d"}}}
        rows = [(1, "r", json.dumps(doc), 1, True, "false", "c"), (2, "s", json.dumps(stateful), 1, True, "false", "c")]
        return s.createDataFrame(rows, "seq bigint, rule_id string, rule_json string, version bigint, enabled boolean, deleted string, op string")

    shaped = lambda b: b.select(F.get_json_object("payload", "$.seq").cast("bigint").alias("seq"), F.lit("S").alias("source"), "payload")
    for batch in ([{"seq": 1, "a": 1}], [{"seq": 2, "a": 1}, {"seq": 3, "a": 2}]):
        lines(spark, source, "t", batch)
        pipeline.rule_matching(records.stream_lines(spark, source), log, out, shaped).awaitTermination()
    assert sorted((r.epoch, r.seq) for r in spark.read.parquet(f"{out}/hits").collect()) == [(0, 1), (1, 3)]


def sink(df, folder):
    return df.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start()


def test_first_arrival_state_survives_a_restart(spark, tmp_path):
    source, folder = str(tmp_path / "in"), str(tmp_path / "w")
    for rows in ([("a", 2), ("a", 1), ("b", 9)], [("a", 0), ("c", 3)]):
        spark.createDataFrame(rows, "k string, t bigint").coalesce(1).write.mode("append").parquet(source)
        events = spark.readStream.schema("k string, t bigint").parquet(source)
        sink(pipeline.first_arrivals(events, ["k"], ["t"]), folder).awaitTermination()
    assert {(r.k, r.t) for r in spark.read.parquet(f"{folder}/out").collect()} == {("a", 1), ("b", 9), ("c", 3)}


def test_absence_waits_for_late_answers(spark, tmp_path):
    source, folder = str(tmp_path / "in"), str(tmp_path / "w")
    second = 1_000_000
    schema = "k string, id bigint, t bigint, kind string"
    first_file = [("x", 1, 0, "A"), ("x", 3, 50 * second, "B"), ("y", 4, 0, "A"), ("z", 5, 0, "B"), ("z", 6, 10 * second, "A")]
    second_file = [("y", 7, 119 * second, "B"), ("w", 8, 600 * second, "A")]
    for rows in (first_file, second_file):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
    events = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source).withColumn("ts", F.timestamp_micros("t"))
    alerts = pipeline.absences(events, "k", "t", "id", F.col("kind") == "A", F.col("kind") == "B", 0, 120 * second)
    sink(alerts, folder).awaitTermination()
    assert {(r.k, r.event_id) for r in spark.read.parquet(f"{folder}/out").collect()} == {("z", 6)}


def test_registered_queries_have_matching_names():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.queries()) > 60


def test_flagship(spark):
    import __spark_entry__ as entry

    assert set(entry.entry(spark).columns) == {"seq", "rule_id"}
    assert entry.entry(spark).count() > 0
