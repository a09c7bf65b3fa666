"""Queries over the rule catalogue: source map, change log, rule tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewatch.operators import report
from tidewatch.operators.datasets import in_dataset, load_datasets
from tidewatch.operators.match import match_rules
from tidewatch.operators.rules import live_rules, rule_classes, rule_conditions, upsert_rules
from tidewatch.plans import fixtures as fx
from tidewatch.plans.registry import ctes, dataset_rows, events_sql, query, stream_events
from tidewatch.plans.validation import STREAM_CHECK, checked_stream
from tidewatch.sources.changes import rule_changes, schema_changes
from tidewatch.sources.records import cluster_topics

CLUSTERS = "SELECT n_nationkey AS id, 'stream_' || cast(n_regionkey AS string) AS stream_id, n_name AS cluster_name, 'broker-' || cast(n_nationkey AS string) || ':9092' AS bootstrap_servers, n_nationkey % 4 <> 0 AS enabled FROM nation"
TOPICS = "SELECT s_nationkey AS cluster_config_id, 'T-' || cast(s_suppkey % 20 AS string) AS topic_name, s_suppkey % 3 <> 0 AS enabled FROM supplier"


@query("source_map", f"""WITH c AS ({CLUSTERS}), t AS ({TOPICS})
SELECT stream_id, cluster_name, bootstrap_servers, coalesce(string_agg(DISTINCT topic_name, ',' ORDER BY topic_name), '') AS topics
FROM c LEFT JOIN t ON t.cluster_config_id = c.id AND t.enabled WHERE c.enabled GROUP BY ALL""")
def source_map(spark, sf_dir):
    found = cluster_topics(fx.view(spark, sf_dir, CLUSTERS), fx.view(spark, sf_dir, TOPICS))
    return found.drop("properties").withColumn("topics", F.array_join("topics", ","))


# The same clusters with security columns, some of them blank.
SECURED = f"SELECT *, CASE WHEN id % 2 = 0 THEN ' SASL_SSL ' ELSE '' END AS security_protocol, CASE WHEN id % 3 = 0 THEN 'GSSAPI' END AS sasl_mechanism FROM ({CLUSTERS}) x"


@query("source_map_security", f"""SELECT stream_id, cluster_name, CASE WHEN id % 2 = 0 THEN 'SASL_SSL' END AS protocol, CASE WHEN id % 3 = 0 THEN 'GSSAPI' END AS mechanism
FROM ({CLUSTERS}) c WHERE enabled""")
def source_map_security(spark, sf_dir):
    found = cluster_topics(fx.view(spark, sf_dir, SECURED), fx.view(spark, sf_dir, TOPICS))
    option = lambda name: F.try_element_at("properties", F.lit(f"kafka.{name}"))
    return found.select("stream_id", "cluster_name", option("security.protocol").alias("protocol"), option("sasl.mechanism").alias("mechanism"))


# A rule change log over the orders: one customer is one rule, each order a change to it.
CHANGES = """SELECT o_orderkey AS seq, 'r' || cast(o_custkey AS string) AS rule_id, 'rule ' || cast(o_custkey AS string) AS name,
  cast(1 + (o_orderkey * 7) % 6 AS bigint) AS version, o_orderkey % 11 <> 0 AS enabled,
  CASE WHEN o_orderkey % 13 = 0 THEN 'true' ELSE 'false' END AS deleted,
  CASE WHEN o_orderkey % 5 = 0 THEN 'd' WHEN o_orderkey % 7 = 0 THEN 'c' ELSE 'u' END AS op
FROM orders"""
_GONE = "(deleted = 'true' OR op = 'd' OR NOT enabled)"


@query("rule_log_current", f"""WITH RECURSIVE ch AS (SELECT *, row_number() OVER (PARTITION BY rule_id ORDER BY seq) AS rn FROM ({CHANGES}) x),
f AS (
  SELECT rule_id, rn, CASE WHEN NOT {_GONE} THEN version END AS live, CASE WHEN NOT {_GONE} THEN seq END AS live_seq FROM ch WHERE rn = 1
  UNION ALL
  SELECT c.rule_id, c.rn, CASE WHEN c.version <= f.live THEN f.live WHEN {_GONE} THEN NULL ELSE c.version END,
         CASE WHEN c.version <= f.live THEN f.live_seq WHEN {_GONE} THEN NULL ELSE c.seq END
  FROM f JOIN ch c ON c.rule_id = f.rule_id AND c.rn = f.rn + 1)
SELECT rule_id, live AS version, live_seq AS seq FROM (SELECT *, row_number() OVER (PARTITION BY rule_id ORDER BY rn DESC) AS last FROM f) y
WHERE last = 1 AND live IS NOT NULL""")
def rule_log_current(spark, sf_dir):
    # Small chunks, so that rules have changes on both sides of chunk borders.
    return live_rules(fx.view(spark, sf_dir, CHANGES), chunk_rows=1000).select("rule_id", "version", "seq")


@query("rule_upsert_latest", f"""WITH c AS ({CHANGES}) SELECT rule_id, version, seq FROM
(SELECT *, row_number() OVER (PARTITION BY rule_id, version ORDER BY seq DESC) AS rn FROM c) x WHERE rn = 1""")
def rule_upsert_latest(spark, sf_dir):
    changes = fx.view(spark, sf_dir, CHANGES)
    stored, incoming = changes.where("seq % 2 = 0"), changes.where("seq % 2 = 1")
    return upsert_rules(stored, incoming, "seq").select("rule_id", "version", "seq")


# Rule documents over the parts, in four shapes.
RULE_DOCS = """SELECT p_partkey AS k, 'R' || cast(p_partkey AS string) AS rule_id,
  '{"rule_id":"R' || cast(p_partkey AS string) || '","trigger_criteria":[{"source":"CPM",'
  || CASE WHEN p_partkey % 2 = 0 THEN '"schema_version":"v2"' ELSE '"version":"v3"' END
  || ',"key_field":"msisdn","conditions":' || CASE WHEN p_partkey % 5 = 0 THEN '[]' ELSE
     '[[{"field":"size","op":">=","value":' || cast(p_size AS string) || '},{"field":"brand","op":"IN","value":["' || p_brand || '","any"]}],'
     || '[{"fields":["a","b"],"op":"in_dataset","dataset_id":"d' || cast(p_partkey % 3 AS string) || '","dataset_version":"v1"}]]' END
  || '},{"source":"EVT","key_field":"id","conditions":[[{"field":"vip","op":"==","value":true}]]}]'
  || CASE p_partkey % 4
     WHEN 0 THEN ',"condition_tree":{"type":"SEQUENCE", "pattern":"NOT_FOLLOWED_BY"}'
     WHEN 1 THEN ',"condition_tree":{"type":"AND","children":[{"type":"CONDITION","expression":{"op":"' || CASE WHEN p_partkey % 3 = 0 THEN 'IS_FIRST_ARRIVAL' ELSE 'IN_DATASET' END || '","key_fields":["x"],"fields":["x"]}}]}'
     WHEN 2 THEN ',"condition_tree":{"type":"CONDITION","expression":{"field":"' || CASE WHEN p_partkey % 3 = 0 THEN 'sub_profile.status' ELSE 'CPM.v2.status' END || '","op":"==","value":1}}'
     ELSE '' END || '}' AS rule_json
FROM part"""

_FLAT = """WITH d AS (SELECT p_partkey AS k, 'R' || cast(p_partkey AS string) AS rule_id, p_size, p_brand,
  CASE WHEN p_partkey % 2 = 0 THEN 'v2' ELSE 'v3' END AS ver FROM part)
SELECT rule_id, 0 AS trigger_no, 'CPM' AS source, ver AS schema_version, 'msisdn' AS key_field, 0 AS group_no, 0 AS cond_no, 'size' AS fields, '>=' AS op, cast(p_size AS string) AS vals, CAST(NULL AS string) AS dataset_id FROM d WHERE k % 5 <> 0
UNION ALL SELECT rule_id, 0, 'CPM', ver, 'msisdn', 0, 1, 'brand', 'IN', p_brand || ',any', NULL FROM d WHERE k % 5 <> 0
UNION ALL SELECT rule_id, 0, 'CPM', ver, 'msisdn', 1, 0, 'a,b', 'IN_DATASET', NULL, 'd' || cast(k % 3 AS string) FROM d WHERE k % 5 <> 0
UNION ALL SELECT rule_id, 0, 'CPM', ver, 'msisdn', NULL, NULL, NULL, NULL, NULL, NULL FROM d WHERE k % 5 = 0
UNION ALL SELECT rule_id, 1, 'EVT', 'v1', 'id', 0, 0, 'vip', '==', 'true', NULL FROM d"""


@query("rule_conditions_flat", _FLAT)
def rule_conditions_flat(spark, sf_dir):
    flat = rule_conditions(fx.view(spark, sf_dir, RULE_DOCS).select("rule_id", "rule_json"))
    return flat.select(
        "rule_id", "trigger_no", "source", "schema_version", "key_field", "group_no", "cond_no",
        F.array_join("fields", ",").alias("fields"), "op", F.array_join("values", ",").alias("vals"), "dataset_id",
    )


@query("rule_class", """SELECT 'R' || cast(p_partkey AS string) AS rule_id, CASE WHEN p_partkey % 4 = 0 OR (p_partkey % 4 = 1 AND p_partkey % 3 = 0) THEN 'CEP'
  WHEN p_partkey % 4 = 1 OR (p_partkey % 4 = 2 AND p_partkey % 3 = 0) THEN 'STATEFUL' ELSE 'STATELESS' END AS rule_class FROM part""")
def rule_class_query(spark, sf_dir):
    return rule_classes(fx.view(spark, sf_dir, RULE_DOCS), ["sub_profile"])


@query("rule_class_routing", """SELECT 'R' || cast(p_partkey AS string) AS rule_id, CASE WHEN p_partkey % 4 = 0 OR (p_partkey % 4 = 1 AND p_partkey % 3 = 0) THEN 'CEP'
  WHEN p_partkey % 5 <> 0 OR p_partkey % 4 = 1 OR (p_partkey % 4 = 2 AND p_partkey % 3 = 0) THEN 'STATEFUL' ELSE 'STATELESS' END AS rule_class FROM part""")
def rule_class_routing(spark, sf_dir):
    return rule_classes(fx.view(spark, sf_dir, RULE_DOCS), ["sub_profile"], triggers=True)


@query("union_sources", """SELECT o_orderkey AS id, 'order' AS origin, o_orderstatus AS status, cast(NULL AS string) AS event_type FROM orders
UNION ALL SELECT event_id, 'event', NULL, event_type FROM events""")
def union_sources(spark, sf_dir):
    orders = fx.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.lit("order").alias("origin"), F.col("o_orderstatus").alias("status"))
    events = fx.table(spark, sf_dir, "events").select(F.col("event_id").alias("id"), F.lit("event").alias("origin"), "event_type")
    return report.union_sources(orders, events)


@query("metrics_by_window", events_sql("""SELECT (t // 3600000000) * 3600000000 AS window_us, count(*) AS events,
  count(*) FILTER (WHERE source = 'CDCN' AND json_extract_string(j, '$.status') = 'FAILED') AS triggered FROM e GROUP BY 1"""))
def metrics_by_window(spark, sf_dir):
    e = stream_events(spark, sf_dir).withColumn("at", F.timestamp_micros("t"))
    rule = {"rule_id": "failed", "trigger_criteria": [{"source": "CDCN", "conditions": [[{"field": "status", "op": "==", "value": "FAILED"}]]}]}
    rates = report.hit_rate(e.select("seq", "at"), match_rules(e, [rule]).select("seq", "at"), "at")
    return rates.select(F.unix_micros("window_start").alias("window_us"), "events", "triggered")


@query("metrics_errors", ctes("fx_stream", **STREAM_CHECK) + "SELECT (epoch_us(ts) // 3600000000) * 3600000000 AS window_us, coalesce(error_code, 'OK') AS outcome, count(*) AS events FROM v GROUP BY ALL")
def metrics_errors(spark, sf_dir):
    return report.metrics(checked_stream(spark, sf_dir), F.col("ts").cast("timestamp")).select(
        F.unix_micros("window_start").alias("window_us"), "outcome", "events"
    )


RULE_CHANGES = """SELECT n_nationkey AS seq, '{' || CASE WHEN n_nationkey % 6 = 5 THEN '' ELSE '"rule_id":"R' || cast(n_nationkey AS string) || '",' END
  || '"name":"' || n_name || '","rule_json":"{}"' || CASE WHEN n_nationkey % 3 = 0 THEN '' ELSE ',"version":' || cast(n_nationkey AS string) END
  || CASE WHEN n_nationkey % 4 = 0 THEN '' ELSE ',"enabled":true' END || CASE WHEN n_nationkey % 5 = 0 THEN ',"__deleted":"true"' ELSE '' END
  || ',"__op":"c"}' AS payload FROM nation"""


@query("rule_changes_parsed", """SELECT n_nationkey AS seq, CASE WHEN n_nationkey % 6 <> 5 THEN 'R' || n_nationkey END AS rule_id, n_name AS name, 0::BIGINT AS cooldown_seconds,
  CASE WHEN n_nationkey % 3 = 0 THEN 0 ELSE n_nationkey END::BIGINT AS version, n_nationkey % 4 <> 0 AS enabled,
  CASE WHEN n_nationkey % 5 = 0 THEN 'true' ELSE 'false' END AS deleted, 'c' AS op FROM nation""")
def rule_changes_parsed(spark, sf_dir):
    return rule_changes(fx.view(spark, sf_dir, RULE_CHANGES)).drop("rule_json")


SCHEMA_CHANGES = """SELECT p_partkey AS seq, '{"schema_id":"S' || cast(p_partkey % 37 AS string) || '","schema_payload":"v' || cast(p_partkey AS string) || '"'
  || CASE WHEN p_partkey % 11 = 0 THEN ',"__op":"d"' WHEN p_partkey % 13 = 0 THEN ',"__deleted":"TRUE"' ELSE '' END || '}' AS payload FROM part"""


@query("schema_changes_current", """SELECT seq, schema_id, 'v' || seq AS schema_payload FROM (
  SELECT max(p_partkey) AS seq, 'S' || (p_partkey % 37) AS schema_id FROM part GROUP BY 2) WHERE seq % 11 <> 0 AND seq % 13 <> 0""")
def schema_changes_current(spark, sf_dir):
    return schema_changes(fx.view(spark, sf_dir, SCHEMA_CHANGES))


DATASET_DOCUMENTS = """SELECT '{"dataset_id":"D' || cast(c_nationkey AS string) || '"' || CASE WHEN c_custkey % 2 = 0 THEN ',"dataset_version":"v2"' ELSE '' END
  || ',"fields":["a","b"],"values":[["' || c_mktsegment || '","' || cast(c_custkey % 5 AS string) || '"],["' || c_mktsegment || '","x"]]}' AS value FROM customer"""


@query("load_datasets_rows", """SELECT DISTINCT 'D' || c_nationkey AS dataset_id, CASE WHEN c_custkey % 2 = 0 THEN 'v2' ELSE 'v1' END AS dataset_version, c_mktsegment AS a,
  unnest([(c_custkey % 5)::VARCHAR, 'x']) AS b FROM customer""")
def load_datasets_rows(spark, sf_dir):
    rows = load_datasets(fx.view(spark, sf_dir, DATASET_DOCUMENTS))
    return rows.select("dataset_id", "dataset_version", F.col("tuple")[0].alias("a"), F.col("tuple")[1].alias("b"))


@query("in_dataset_arity_mixed", """SELECT event_id FROM events WHERE user_id % 2 = 0""")
def in_dataset_arity_mixed(spark, sf_dir):
    """One dataset of single values and of pairs: single values are members by the former alone."""
    events = fx.table(spark, sf_dir, "events").select("event_id", F.col("user_id").cast("string").alias("user"))
    ids = fx.table(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("u"), (F.col("user_id") % 2 == 0).alias("single"))
    tuples = F.when(F.col("single"), F.array("u")).otherwise(F.array("u", F.lit("x")))
    mixed = ids.select(F.lit("mixed").alias("dataset_id"), F.lit("v1").alias("dataset_version"), tuples.alias("tuple"))
    return in_dataset(events, [F.col("user")], mixed, "mixed").select("event_id")


@query("in_dataset_arity", """SELECT event_id FROM events WHERE false""")
def in_dataset_arity(spark, sf_dir):
    """Members of a set of pairs among single values: none, as tuples match by their length."""
    events = fx.table(spark, sf_dir, "events").select("event_id", F.col("user_id").cast("string").alias("user"))
    return in_dataset(events, [F.col("user")], dataset_rows(spark, sf_dir).where("dataset_id = 'user_type'"), "user_type").select("event_id")
