"""Queries that match events to rules and to datasets."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewatch.operators import report
from tidewatch.operators.datasets import in_dataset
from tidewatch.operators.match import FieldColumns, candidate_ids, candidates, candidates_complex, candidates_exact, events_of, match_rules, partition_key
from tidewatch.operators.rules import parse_rules, rule_conditions
from tidewatch.plans import fixtures as fx
from tidewatch.plans.registry import dataset_rows, events_sql, phone_sql, query, stream_events
from tidewatch.functions.values import field

AMOUNT = "try_cast(json_extract_string(j, '$.amount') AS double)"


def text_sql(path: str) -> str:
    return f"json_extract_string(j, '$.{path}')"


# One rule per nation: an exact, a mixed, a non-exact and an unconditional trigger in turn.
NATION_RULES = """SELECT n_nationkey AS k, 'N' || cast(n_nationkey AS string) AS rule_id, '{"trigger_criteria":[{"source":"'
  || CASE n_regionkey % 4 WHEN 0 THEN 'CPM' WHEN 1 THEN 'CDCN' WHEN 2 THEN 'TDH' ELSE 'EVT' END || '","schema_version":"v1","key_field":"msisdn","conditions":'
  || CASE n_nationkey % 4 WHEN 0 THEN '[[{"field":"device_session_id","op":"==","value":"S' || cast(n_nationkey AS string) || '"}]]'
     WHEN 1 THEN '[[{"field":"data.request.billCode","op":"IN","value":["B1","B' || cast(n_nationkey % 10 AS string) || '"]},{"field":"amount","op":">","value":' || cast(n_nationkey AS string) || '}]]'
     WHEN 2 THEN '[[{"field":"amount","op":"<","value":' || cast(n_nationkey AS string) || '}]]' ELSE '[]' END || '}]}' AS rule_json FROM nation"""
_RULES = """SELECT n_nationkey AS k, 'N' || cast(n_nationkey AS string) AS rule_id, CASE n_regionkey % 4 WHEN 0 THEN 'CPM' WHEN 1 THEN 'CDCN' WHEN 2 THEN 'TDH' ELSE 'EVT' END AS source FROM nation"""
_EXACT = f"""SELECT seq, rule_id FROM e JOIN ({_RULES}) r USING (source) WHERE (k % 4 = 0 AND {text_sql('device_session_id')} = 'S' || cast(k AS string))
  OR (k % 4 = 1 AND {text_sql('data.request.billCode')} IN ('B1', 'B' || cast(k % 10 AS string)))"""
_COMPLEX = f"SELECT seq, rule_id FROM e JOIN ({_RULES}) r USING (source) WHERE k % 4 IN (1, 2, 3)"


def nation_conditions(spark, sf_dir):
    return rule_conditions(fx.view(spark, sf_dir, NATION_RULES).select("rule_id", "rule_json"))


@query("candidates_exact", events_sql(_EXACT))
def candidates_exact_query(spark, sf_dir):
    return candidates_exact(stream_events(spark, sf_dir), nation_conditions(spark, sf_dir))


@query("candidates_complex", events_sql(_COMPLEX))
def candidates_complex_query(spark, sf_dir):
    return candidates_complex(stream_events(spark, sf_dir), nation_conditions(spark, sf_dir))


@query("candidates_all", events_sql(f"{_EXACT} UNION {_COMPLEX}"))
def candidates_all_query(spark, sf_dir):
    return candidates(stream_events(spark, sf_dir), nation_conditions(spark, sf_dir))


# One rule per nation with a condition that no text index decides as it stands.
COVER_RULES = """SELECT 'C' || cast(n_nationkey AS string) AS rule_id, '{"trigger_criteria":[{"source":"'
  || CASE n_regionkey % 4 WHEN 0 THEN 'CPM' WHEN 1 THEN 'CDCN' WHEN 2 THEN 'TDH' ELSE 'EVT' END || '","schema_version":"v1","key_field":"msisdn","conditions":[['
  || CASE n_nationkey % 8 WHEN 0 THEN '{"field":"device_session_id","op":"==","value":2,"function":"LENGTH"}'
     WHEN 1 THEN '{"field":"msisdn","op":"==","right_field":"data.request.msisdn"}'
     WHEN 2 THEN '{"expr":"eventId % 10","op":"==","value":' || cast(n_nationkey % 10 AS string) || '}'
     WHEN 3 THEN '{"field":"eventId","op":"IN","value":[' || cast(n_nationkey AS string) || ',' || cast(n_nationkey * 7 AS string) || '.0]}'
     WHEN 4 THEN '{"field":"amount","op":"==","value":12.5}'
     WHEN 5 THEN '{"field":"status","op":"==","value":"SUCCESS"},{"field":"device_session_id","op":"IN","value":["S1","S' || cast(n_nationkey AS string) || '"]}'
     WHEN 6 THEN '{"field":"CPM.v1.status","op":"==","value":"SUCCESS"}'
     ELSE '{"field":"eventType","op":"!=","value":"view"}' END || ']]}]}' AS rule_json FROM nation"""


@query("candidates_cover_hits", "SELECT event_id AS seq, 'none' AS rule_id FROM events WHERE false")
def candidates_cover_hits(spark, sf_dir):
    """Hits that are no candidates: none may be."""
    docs = fx.view(spark, sf_dir, COVER_RULES)
    events = candidate_ids(stream_events(spark, sf_dir), rule_conditions(docs))
    hits = match_rules(events, parse_rules(docs))
    return hits.where(~F.array_contains("candidates", F.col("rule_id"))).select("seq", "rule_id")


def cond(f, op, value=None, **more):
    return {"field": f, "op": op, "value": value, **more}


def node(f, op, value=None, **more):
    return {"type": "CONDITION", "expression": cond(f, op, value, **more)}


def rule(rule_id, source, conditions, tree=None, **more):
    trigger = {"source": source, "schema_version": "v1", "key_field": "msisdn", "conditions": conditions}
    return {"rule_id": rule_id, "trigger_criteria": [trigger], "condition_tree": tree, **more}


DNF_RULES = [
    rule("or_of_ands", "CPM", [[cond("amount", ">", 50), cond("status", "==", "SUCCESS")], [cond("device_session_id", "==", "S7")]]),
    rule("unconditional", "TDH", []),
    rule("in_list", "CDCN", [[cond("data.request.billCode", "IN", ["B1", "B3"])]]),
]


@query("match_trigger_dnf", events_sql(f"""SELECT seq, 'or_of_ands' AS rule_id FROM e WHERE source = 'CPM' AND (({AMOUNT} > 50 AND {text_sql('status')} = 'SUCCESS') OR {text_sql('device_session_id')} = 'S7')
UNION ALL SELECT seq, 'unconditional' FROM e WHERE source = 'TDH'
UNION ALL SELECT seq, 'in_list' FROM e WHERE source = 'CDCN' AND {text_sql('data.request.billCode')} IN ('B1', 'B3')"""))
def match_trigger_dnf(spark, sf_dir):
    return match_rules(stream_events(spark, sf_dir), DNF_RULES, trigger_only=True).select("seq", "rule_id")


TREE_RULES = [
    rule("big_purchase", "CPM", [], {"type": "AND", "children": [node("CPM.v1.amount", ">=", 40.13), node("status", "==", "SUCCESS")]}),
    rule("cheap_failure", "CDCN", [[cond("status", "==", "FAILED")]], {"type": "OR", "children": [
        node("amount", "<", 5), {"type": "AND", "children": [node("data.request.billCode", "IN", ["B0", "B9"]), node("device_session_id", "!=", "S1")]}]}),
    rule("no_tree", "EVT", [[cond("eventType", "==", "view"), cond("amount", "BETWEEN", [10, 20])]]),
    {"rule_id": "two_sources", "trigger_criteria": [
        {"source": "TDH", "version": "v1", "key_field": "msisdn", "conditions": []},
        {"source": "EVT", "version": "v1", "key_field": "msisdn", "conditions": [[cond("eventType", "==", "click")]]}],
     "condition_tree": {"type": "OR", "children": [node("TDH.v1.amount", ">", 60), node("EVT.v1.amount", ">", 80)]}},
]
MATCH_SQL = events_sql(f"""SELECT seq, 'big_purchase' AS rule_id FROM e WHERE source = 'CPM' AND {AMOUNT} >= 40.13 AND {text_sql('status')} = 'SUCCESS'
UNION ALL SELECT seq, 'cheap_failure' FROM e WHERE source = 'CDCN' AND {text_sql('status')} = 'FAILED' AND ({AMOUNT} < 5 OR ({text_sql('data.request.billCode')} IN ('B0', 'B9') AND {text_sql('device_session_id')} <> 'S1'))
UNION ALL SELECT seq, 'no_tree' FROM e WHERE source = 'EVT' AND {text_sql('eventType')} = 'view' AND {AMOUNT} BETWEEN 10 AND 20
UNION ALL SELECT seq, 'two_sources' FROM e WHERE (source = 'TDH' AND {AMOUNT} > 60) OR (source = 'EVT' AND {text_sql('eventType')} = 'click' AND {AMOUNT} > 80)""")


@query("match_rules", MATCH_SQL)
def match_rules_query(spark, sf_dir):
    return match_rules(stream_events(spark, sf_dir), TREE_RULES).select("seq", "rule_id")


_KEY = text_sql("msisdn")


@query("partition_key", events_sql(f"""SELECT seq, CASE source WHEN 'CPM' THEN coalesce({phone_sql(_KEY)}, {_KEY}) WHEN 'EVT' THEN {text_sql('device_session_id')}
  WHEN 'TDH' THEN coalesce({phone_sql(text_sql('data.request.msisdn'))}, {text_sql('data.request.msisdn')}) END AS partition_key FROM e"""))
def partition_key_query(spark, sf_dir):
    keys = {"CPM": "msisdn", "EVT": "device_session_id", "TDH": "data.request.msisdn"}
    r = {"rule_id": "keys", "trigger_criteria": [{"source": s, "key_field": k, "conditions": []} for s, k in keys.items()]}
    columns = FieldColumns([r])
    key = partition_key(r, columns)
    return columns.extract(stream_events(spark, sf_dir)).select("seq", key.alias("partition_key"))


def predicates(name, tests):
    """Registers a query with one rule per condition, over every source."""
    rules = [
        {"rule_id": rule_id, "trigger_criteria": [{"source": s, "conditions": [[c]]} for s in fx.STREAM_SOURCES]}
        for rule_id, c, _ in tests
    ]
    sql = events_sql(" UNION ALL ".join(f"SELECT seq, '{rule_id}' AS rule_id FROM e WHERE {test}" for rule_id, _, test in tests))

    @query(name, sql)
    def run(spark, sf_dir):
        return match_rules(stream_events(spark, sf_dir), rules).select("seq", "rule_id")


STATUS, EVENT_TYPE, BILL, SESSION = (text_sql(p) for p in ("status", "eventType", "data.request.billCode", "device_session_id"))
ID = f"cast({text_sql('eventId')} AS double)"
predicates("pred_compare", [
    ("eq", cond("eventId", "==", 77), f"{ID} = 77"), ("ne", cond("amount", "!=", 10.5), f"{AMOUNT} <> 10.5"),
    ("gt", cond("amount", ">", 100), f"{AMOUNT} > 100"), ("lt", cond("amount", "<", 1), f"{AMOUNT} < 1"),
    ("ge", cond("eventId", ">=", 500), f"{ID} >= 500"), ("le", cond("eventId", "<=", 500), f"{ID} <= 500"),
    ("text_eq", cond("status", "==", "UNKNOWN"), f"{STATUS} = 'UNKNOWN'"), ("text_ne", cond("data.request.billCode", "!=", "B1"), f"{BILL} <> 'B1'"),
])
predicates("pred_between", [
    ("ints", cond("eventId", "BETWEEN", [100, 200]), f"{ID} BETWEEN 100 AND 200"),
    ("floats", cond("amount", "BETWEEN", [1.5, 8.5]), f"{AMOUNT} BETWEEN 1.5 AND 8.5"),
])
predicates("pred_in", [
    ("in_text", cond("eventType", "IN", ["view", "click"]), f"{EVENT_TYPE} IN ('view', 'click')"),
    ("not_in_text", cond("data.request.billCode", "NOT IN", ["B1", "B2"]), f"{BILL} NOT IN ('B1', 'B2')"),
    ("in_int", cond("eventId", "IN", [1, 2, 3, 700]), f"{ID} IN (1, 2, 3, 700)"),
    ("not_in_int", cond("eventId", "NOT IN", [1, 2, 3]), f"{ID} NOT IN (1, 2, 3)"),
])
predicates("pred_string", [
    ("starts", cond("eventType", "STARTS_WITH", "pur"), f"starts_with({EVENT_TYPE}, 'pur')"),
    ("not_starts", cond("data.request.billCode", "NOT_STARTS_WITH", "B1"), f"NOT starts_with({BILL}, 'B1')"),
    ("contains", cond("eventType", "CONTAINS", "ie"), f"contains({EVENT_TYPE}, 'ie')"),
    ("not_contains", cond("eventType", "NOT_CONTAINS", "i"), f"NOT contains({EVENT_TYPE}, 'i')"),
    ("ends", cond("device_session_id", "ENDS_WITH", "7"), f"{SESSION} LIKE '%7'"),
    ("not_ends", cond("data.request.billCode", "NOT_ENDS_WITH", "3"), f"{BILL} NOT LIKE '%3'"),
])
predicates("pred_null", [
    ("missing", cond("data.request.billCode", "IS_NULL"), f"{BILL} IS NULL"), ("json_null", cond("msisdn", "IS_NULL"), f"{_KEY} IS NULL"),
    ("present", cond("amount", "IS_NOT_NULL"), f"{text_sql('amount')} IS NOT NULL"),
])
predicates("pred_length", [
    ("len_eq", cond("msisdn", "==", 10, function="LENGTH"), f"length({_KEY}) = 10"),
    ("len_gt", cond("msisdn", ">", 12, function="LENGTH"), f"length({_KEY}) > 12"),
    ("len_in", cond("device_session_id", "IN", [2], function="LENGTH"), f"length({SESSION}) = 2"),
])
predicates("pred_crossfield", [
    ("text_cross", cond("msisdn", "==", right_field="data.request.msisdn"), f"{_KEY} = {text_sql('data.request.msisdn')}"),
    ("number_cross", cond("amount", ">", right_field="eventId"), f"{AMOUNT} > {ID}"),
    ("text_cross_ne", cond("status", "!=", right_field="eventType"), f"{STATUS} <> {EVENT_TYPE}"),
])
predicates("pred_expr", [
    ("linear", {"expr": "(amount * 2 + eventId) / 4", "op": ">=", "value": 300.0}, f"({AMOUNT} * 2 + {ID}) / 4 >= 300"),
    ("modulo", {"expr": "eventId % 10", "op": "IN", "value": [1, 3, 5]}, f"{ID} % 10 IN (1, 3, 5)"),
    ("both_sides", {"expr": "amount - 5", "op": "<", "right_expr": "eventId * 0.001"}, f"{AMOUNT} - 5 < {ID} * 0.001"),
    ("by_zero", {"expr": "amount / (eventId - eventId)", "op": ">", "value": 0}, "false"),
    ("expr_field", {"expr": "eventId - 100", "op": "<", "right_field": "amount"}, f"{ID} - 100 < {AMOUNT}"),
    ("expr_between", {"expr": "eventId / 7", "op": "BETWEEN", "value": [10, 20]}, f"{ID} / 7 BETWEEN 10 AND 20"),
])

# Values that differ as texts, whole numbers or booleans and would be one as doubles.
TYPED = """SELECT c_custkey AS seq, 'TYP' AS source, '{"code":"' || CASE c_custkey % 3 WHEN 0 THEN '007' WHEN 1 THEN '7' ELSE '07' END
  || '","same":"7","account":"1234567890123456789' || cast(c_custkey % 4 AS string) || '","other":"12345678901234567891","big":'
  || cast(9007199254740990 + c_custkey % 5 AS string) || ',"flag":' || CASE c_custkey % 5 WHEN 0 THEN 'true' WHEN 1 THEN '1' WHEN 2 THEN '"yes"' WHEN 3 THEN '"true"' ELSE 'false' END
  || ',"n":"' || cast(c_custkey % 60 AS string) || '","m":' || cast(c_custkey % 7 AS string) || '}' AS payload FROM customer"""
TYPED_TESTS = [
    ("texts", cond("code", "==", right_field="same"), "c_custkey % 3 = 1"), ("texts_ne", cond("code", "!=", right_field="same"), "c_custkey % 3 <> 1"),
    ("accounts", cond("account", "==", right_field="other"), "c_custkey % 4 = 1"), ("long", cond("big", "==", 9007199254740993), "c_custkey % 5 = 3"),
    ("long_gt", cond("big", ">", 9007199254740992), "c_custkey % 5 > 2"), ("true", cond("flag", "==", True), "c_custkey % 5 IN (0, 3)"),
    ("false", cond("flag", "!=", True), "c_custkey % 5 = 4"), ("order", cond("n", ">", "9"), "c_custkey % 60 > 9"),
    ("text_number", cond("code", "==", right_field="m"), "c_custkey % 3 IN (0, 1, 2) AND c_custkey % 7 = 7"),
]


@query("pred_typed", " UNION ALL ".join(f"SELECT c_custkey AS seq, '{i}' AS rule_id FROM customer WHERE {t}" for i, _, t in TYPED_TESTS))
def pred_typed(spark, sf_dir):
    rules = [rule(i, "TYP", [[c]]) for i, c, _ in TYPED_TESTS]
    return match_rules(events_of(fx.view(spark, sf_dir, TYPED)), rules).select("seq", "rule_id")


TIMED = """SELECT o_orderkey AS seq, 'ORD' AS source, '{"created":"' || cast(cast(o_orderdate AS date) AS string) || 'T00:00:00Z","paid":"'
  || cast(cast(o_orderdate AS date) AS string) || CASE WHEN o_orderkey % 3 = 0 THEN 'T07:00:00+07:00' ELSE 'T05:00:00+00:00' END || '"}' AS payload FROM orders"""
TIME_TESTS = [
    ("after", cond("created", ">", "1996-01-01T00:00:00Z"), "o_orderdate > timestamp '1996-01-01'"),
    ("within", cond("created", "BETWEEN", ["1995-01-01T00:00:00Z", "1995-12-31T00:00:00Z"]), "o_orderdate BETWEEN timestamp '1995-01-01' AND timestamp '1995-12-31'"),
    ("same_instant", cond("created", "<", right_field="paid"), "o_orderkey % 3 <> 0"),
]


@query("pred_timestamp", " UNION ALL ".join(f"SELECT o_orderkey AS seq, '{i}' AS rule_id FROM (SELECT o_orderkey, date_trunc('day', o_orderdate) AS o_orderdate FROM orders) o WHERE {t}" for i, _, t in TIME_TESTS))
def pred_timestamp(spark, sf_dir):
    rules = [rule(i, "ORD", [[c]]) for i, c, _ in TIME_TESTS]
    return match_rules(events_of(fx.view(spark, sf_dir, TIMED)), rules).select("seq", "rule_id")


USER = "cast(user_id AS string)"


def _user_events(spark, sf_dir):
    return fx.table(spark, sf_dir, "events").select("event_id", F.col("user_id").cast("string").alias("user"), "event_type")


@query("in_dataset_single", "WITH d AS (" + fx.DATASETS + f") SELECT event_id FROM events e WHERE EXISTS (SELECT 1 FROM d WHERE dataset_id = 'vip' AND d.v1 = {USER})")
def in_dataset_single(spark, sf_dir):
    return in_dataset(_user_events(spark, sf_dir), [F.col("user")], dataset_rows(spark, sf_dir), "vip").select("event_id")


@query("in_dataset_tuple", "WITH d AS (" + fx.DATASETS + f") SELECT event_id FROM events e WHERE EXISTS (SELECT 1 FROM d WHERE dataset_id = 'user_type' AND dataset_version = 'v1' AND d.v1 = {USER} AND d.v2 = event_type)")
def in_dataset_tuple(spark, sf_dir):
    return in_dataset(_user_events(spark, sf_dir), [F.col("user"), F.col("event_type")], dataset_rows(spark, sf_dir), "user_type", "v1").select("event_id")


@query("not_in_dataset", "WITH d AS (" + fx.DATASETS + f") SELECT event_id FROM events e WHERE NOT EXISTS (SELECT 1 FROM d WHERE dataset_id = 'vip' AND d.v1 = {USER})")
def not_in_dataset(spark, sf_dir):
    return in_dataset(_user_events(spark, sf_dir), [F.col("user")], dataset_rows(spark, sf_dir), "vip", negate=True).select("event_id")


@query("output_mapping", events_sql(f"""SELECT seq, 'T1' AS layout, {text_sql('eventId')} AS a, {text_sql('device_session_id')} AS b FROM e WHERE source = 'CPM' AND {AMOUNT} >= 40.13 AND {text_sql('status')} = 'SUCCESS'
UNION ALL SELECT seq, 'default', cast(seq AS string), NULL FROM e WHERE source = 'EVT' AND {text_sql('eventType')} = 'view' AND {AMOUNT} BETWEEN 10 AND 20"""))
def output_mapping(spark, sf_dir):
    hits = match_rules(stream_events(spark, sf_dir), [TREE_RULES[0], TREE_RULES[2]])
    hits = hits.select("seq", "rule_id", field(F.col("event"), "eventId", "string").alias("event_id"), field(F.col("event"), "device_session_id", "string").alias("session"))
    layouts = {"big_purchase": {"layout": "'T1'", "a": "event_id", "b": "session"}}
    out = report.map_output(hits, layouts, {"layout": "'default'", "a": "cast(seq as string)"})
    return out.select("seq", F.from_json("value", "layout string, a string, b string").alias("o")).select("seq", "o.*")


# Whole numbers one apart above 2**53, which doubles can't tell apart, and a fraction.
TYPED_PAYLOADS = """SELECT event_id AS seq, ts, 'NUM' AS source, '{"n":' || cast(9007199254740992 + event_id % 3 AS string) || ',"m":9007199254740992,"q":"'
  || cast(event_id % 11 AS string) || '","f":' || cast(cast(value AS decimal(18,2)) AS string) || '}' AS payload FROM events"""
_X = lambda rule_id, left, op, **more: rule(rule_id, "NUM", [], {"type": "CONDITION", "expression": {"expr": left, "op": op, **more}})
TYPED_RULES = [
    _X("equal", "n - m", "==", value=0), _X("odd", "n % 2", "==", value=1), _X("no_fraction_mod", "f % 2", ">=", value=0), _X("text_mod", "q % 3", "IN", value=[1, 2]),
    _X("double_of_both", "2 * n", ">", right_expr="2 * m + 2"), _X("between", "n - m", "BETWEEN", value=[1, 2]), _X("large", "n + n + n", "==", value=27021597764222977 - 1),
    _X("half", "q / 2", ">", value=3), _X("mixed", "q % 4 * 0.5 + f", ">", value=60), rule("field_left", "NUM", [[cond("n", ">", right_expr="m + 1")]]),
]
_V = "cast(value AS decimal(18,2))::DOUBLE"


@query("pred_expr_typed", f"""WITH v AS (SELECT event_id AS seq, event_id % 3 AS r, event_id % 11 AS q, {_V} AS f FROM events)
SELECT seq, 'equal' AS rule_id FROM v WHERE r = 0 UNION ALL SELECT seq, 'odd' FROM v WHERE r = 1 UNION ALL SELECT seq, 'no_fraction_mod' FROM v WHERE f = floor(f) AND f % 2 >= 0
UNION ALL SELECT seq, 'text_mod' FROM v WHERE q % 3 IN (1, 2) UNION ALL SELECT seq, 'double_of_both' FROM v WHERE 2 * r > 2 UNION ALL SELECT seq, 'between' FROM v WHERE r IN (1, 2)
UNION ALL SELECT seq, 'large' FROM v WHERE 3 * (9007199254740992::HUGEINT + r) = 27021597764222976 UNION ALL SELECT seq, 'half' FROM v WHERE q / 2 > 3
UNION ALL SELECT seq, 'mixed' FROM v WHERE q % 4 * 0.5::DOUBLE + f > 60 UNION ALL SELECT seq, 'field_left' FROM v WHERE r > 1""")
def pred_expr_typed(spark, sf_dir):
    events = events_of(fx.view(spark, sf_dir, TYPED_PAYLOADS))
    return match_rules(events, TYPED_RULES).select("seq", "rule_id")


# Layouts as rows: one rule has its own, the others share the default.
LAYOUTS = """SELECT 'big_purchase' AS rule_id, 'layout' AS target, '=T1' AS source UNION ALL SELECT 'big_purchase', 'bill', 'event.data.request.billCode'
UNION ALL SELECT 'big_purchase', 'key', 'hit.partition_key' UNION ALL SELECT '*', 'layout', '=default' UNION ALL SELECT '*', 'rule', 'hit.rule_id' UNION ALL SELECT '*', 'bill', 'event.eventId'"""


@query("output_mapping_table", events_sql(f"""SELECT seq, 'T1' AS layout, {text_sql('data.request.billCode')} AS bill, coalesce({phone_sql(text_sql('msisdn'))}, {text_sql('msisdn')}) AS key, NULL AS rule
  FROM e WHERE source = 'CPM' AND {AMOUNT} >= 40.13 AND {text_sql('status')} = 'SUCCESS'
UNION ALL SELECT seq, 'default', {text_sql('eventId')}, NULL, 'no_tree' FROM e WHERE source = 'EVT' AND {text_sql('eventType')} = 'view' AND {AMOUNT} BETWEEN 10 AND 20"""))
def output_mapping_table(spark, sf_dir):
    rules = [TREE_RULES[0], TREE_RULES[2]]
    fields = FieldColumns(rules)
    key = partition_key(rules[0], fields)
    hits = fields.extract(match_rules(stream_events(spark, sf_dir), rules)).withColumn("partition_key", key)
    out = report.map_output_by_table(hits.select("seq", "rule_id", "payload", "partition_key"), fx.view(spark, sf_dir, LAYOUTS), ["rule_id", "partition_key"])
    return out.select("seq", *[F.try_element_at("output", F.lit(c)).alias(c) for c in ("layout", "bill", "key", "rule")])
