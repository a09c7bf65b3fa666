"""Catalogues of many rules, evaluated together: joins and scans do not grow with the rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewatch.functions.values import epoch_micros
from tidewatch.operators import profile
from tidewatch.operators.evaluate import evaluate_rule, evaluate_rules
from tidewatch.operators.match import events_of
from tidewatch.plans import fixtures as fx
from tidewatch.plans.business import BILL, PAYMENTS, PHONE, SESSION, SHARED_KEYS, STATUS, _GUARD_CTES, all_of, first_of, member
from tidewatch.plans.matching import AMOUNT, cond, node, rule, text_sql
from tidewatch.plans.registry import ctes, events_sql, phone_sql, query, spread, stream_events
from tidewatch.plans.sequences import greedy_sql
from tidewatch.plans.validation import valid_batch

MINUTE = 60_000_000
DATASETS_OF_PROFILE = {"active_promo", "daily_spending"}

# ------------------------------------------------ profile fields in a trigger and inside expressions

PROFILE_TRIGGER = rule(
    "profile_trigger", "CPM",
    [[cond("active_promo.sub_code", "IN", ["VTM1", "VTM2"]), cond("amount", ">", 10)], [cond("daily_spending.balance", "<", 0), cond("amount", "<=", 10)]],
)
PROFILE_EXPR = rule("profile_expr", "CPM", [], {"type": "CONDITION", "expression": {"expr": "daily_spending.balance - amount * 10", "op": ">", "right_expr": "amount * 20 + 500"}})
_SUB = "(SELECT value FROM g WHERE g.key_value = k.key_value AND dataset_name = 'active_promo' AND field = 'sub_code')"
_BALANCE = "(SELECT cast(value AS double) FROM g WHERE g.key_value = k.key_value AND dataset_name = 'daily_spending' AND field = 'balance')"


def _with_profile(spark, sf_dir, one):
    guarded = profile.current_profile(valid_batch(spark, sf_dir, SHARED_KEYS))
    events = events_of(fx.view(spark, sf_dir, PAYMENTS)).withColumn("t", epoch_micros(F.col("ts")))
    return evaluate_rule(events, one, "t", "seq", profile=guarded, profile_datasets=DATASETS_OF_PROFILE).select("seq", "partition_key", "rule_id")


@query("rules_profile_in_trigger", ctes(fx_batch=SHARED_KEYS, **_GUARD_CTES)
    + f"""SELECT seq, key_value AS partition_key, 'profile_trigger' AS rule_id FROM k WHERE (amount > 10 AND {_SUB} IN ('VTM1', 'VTM2')) OR (amount <= 10 AND {_BALANCE} < 0)""")
def rules_profile_in_trigger(spark, sf_dir):
    return _with_profile(spark, sf_dir, PROFILE_TRIGGER)


@query("rules_profile_in_expr", ctes(fx_batch=SHARED_KEYS, **_GUARD_CTES)
    + f"SELECT seq, key_value AS partition_key, 'profile_expr' AS rule_id FROM k WHERE {_BALANCE} - amount * 10 > amount * 20 + 500")
def rules_profile_in_expr(spark, sf_dir):
    return _with_profile(spark, sf_dir, PROFILE_EXPR)


# ------------------------------------------------ sequence and first arrival below AND and OR


def quiet(pattern, minutes, first, second):
    """A view event that is (not) followed by a click of the same session."""
    return {
        "type": "SEQUENCE", "pattern": pattern, "min_time": 0, "max_time": minutes, "time_unit": "minute",
        "join_keys": [{"left_field": "first.device_session_id", "right_field": "second.device_session_id"}],
        "first": {"source": "EVT", "filter": [cond("eventType", "==", "view"), *first]}, "second": {"source": "EVT", "filter": [cond("eventType", "==", "click"), *second]},
    }


ORDER_TREE = rule(
    "order_tree", "EVT", [[cond("eventType", "IN", ["view", "click"])]],
    {"type": "OR", "children": [
        all_of(node("amount", "<", 40), quiet("NOT_FOLLOWED_BY", 90, [], [])),
        all_of(node("amount", ">", 60), first_of("device_session_id", ttl="2d")),
    ]},
)
_VIEWS = f"SELECT seq, t, {SESSION} AS sid, {text_sql('eventType')} AS kind, {AMOUNT} AS amount FROM e WHERE source = 'EVT' AND {text_sql('eventType')} IN ('view', 'click')"


def answered(minutes, more="true"):
    return f"EXISTS (SELECT 1 FROM v b WHERE b.kind = 'click' AND b.sid = a.sid AND b.t BETWEEN a.t + 1 AND a.t + {minutes * MINUTE} AND {more})"


def _first_sql(source, where, key, ttl, columns="seq"):
    rows = f"SELECT seq, epoch_us(ts) AS t, {key} AS k, j FROM (SELECT *, payload AS j FROM fx_stream WHERE source = '{source}' AND json_valid(payload) AND json_type(payload) = 'OBJECT') x WHERE {where}"
    return greedy_sql(f"SELECT * FROM ({rows}) y WHERE k IS NOT NULL", ["k"], ttl, columns, ("fx_stream",), "seq")


_LARGE = _first_sql("EVT", f"{text_sql('eventType')} IN ('view', 'click') AND {AMOUNT} > 60", SESSION, 2 * 1440 * MINUTE)


@query("tree_order_leaves", f"""SELECT DISTINCT seq, 'order_tree' AS rule_id FROM (
  SELECT seq FROM ({_LARGE}) f UNION ALL
  SELECT seq FROM ({events_sql(f"SELECT seq FROM v a WHERE kind = 'view' AND amount < 40 AND NOT {answered(90)}", v=_VIEWS)}) s) x""")
def tree_order_leaves(spark, sf_dir):
    return evaluate_rule(stream_events(spark, sf_dir), ORDER_TREE, "t", "seq").select("seq", "rule_id")


# ------------------------------------------------ a mixed catalogue: every kind of state, own parameters per rule


def mixed_catalogue() -> list[dict]:
    """Rules of every kind, several of each with their own datasets, durations and silences."""
    rules = []
    for k in range(4):
        rules.append(rule(f"plain{k}", "CPM", [[cond("amount", ">", 20 + 10 * k)]], node("status", "==", "SUCCESS")))
        rules.append(rule(f"list{k}", "CDCN", [[cond("amount", ">", k)]], member("sessions" if k % 2 else "bills", "device_session_id" if k % 2 else "data.request.billCode", negate=k > 1)))
        rules.append(rule(f"first{k}", "TDH", [[cond("amount", ">", 5 * k)]], all_of(node("status", "==", "SUCCESS"), first_of("device_session_id", ttl=f"{k + 1}d"))))
        pattern = "FOLLOWED_BY" if k % 2 else "NOT_FOLLOWED_BY"
        rules.append(rule(f"seq{k}", "EVT", [], quiet(pattern, 30 * (k + 1), [cond("amount", ">", 10 * k)], [cond("amount", ">", 5)])))
        rules.append(rule(f"calm{k}", "CPM", [[cond("amount", ">", 30)]], cooldown_seconds=21_600 * (k + 1)))
    return rules


MIXED_LISTS = """SELECT DISTINCT 'sessions' AS dataset_id, 'v1' AS dataset_version, 'S' || cast(user_id % 50 AS string) AS v1 FROM events WHERE user_id % 50 % 4 = 1
UNION ALL SELECT DISTINCT 'bills', 'v1', 'B' || cast(event_id % 10 AS string) FROM events WHERE event_id % 10 IN (2, 6)"""


def mixed_sql() -> str:
    parts = []
    for k in range(4):
        parts.append(events_sql(f"SELECT seq, 'plain{k}' AS rule_id FROM e WHERE source = 'CPM' AND {AMOUNT} > {20 + 10 * k} AND {STATUS} = 'SUCCESS'"))
        of, listed = (SESSION, "sessions") if k % 2 else (BILL, "bills")
        parts.append(events_sql(f"SELECT seq, 'list{k}' AS rule_id FROM e WHERE source = 'CDCN' AND {AMOUNT} > {k} AND {of} IS NOT NULL AND ({of} IN (SELECT v1 FROM l WHERE dataset_id = '{listed}')) = {'false' if k > 1 else 'true'}", l=MIXED_LISTS))
        parts.append(_first_sql("TDH", f"{AMOUNT} > {5 * k} AND {STATUS} = 'SUCCESS'", SESSION, (k + 1) * 1440 * MINUTE, f"seq, 'first{k}' AS rule_id"))
        parts.append(events_sql(f"SELECT seq, 'seq{k}' AS rule_id FROM v a WHERE kind = 'view' AND amount > {10 * k} AND {'' if k % 2 else 'NOT '}{answered(30 * (k + 1), 'b.amount > 5')}", v=_VIEWS))
        parts.append(_first_sql("CPM", f"{AMOUNT} > 30", f"coalesce({phone_sql(PHONE)}, {PHONE})", 21_600_000_000 * (k + 1), f"seq, 'calm{k}' AS rule_id"))
        parts.append(events_sql(f"SELECT seq, 'calm{k}' AS rule_id FROM e WHERE source = 'CPM' AND {AMOUNT} > 30 AND {PHONE} IS NULL"))
    return " UNION ALL ".join(f"SELECT seq, rule_id FROM ({p}) x{i}" for i, p in enumerate(parts))


@query("catalogue_one_pass", mixed_sql())
def catalogue_one_pass(spark, sf_dir):
    lists = fx.view(spark, sf_dir, MIXED_LISTS).select("dataset_id", "dataset_version", F.array("v1").alias("tuple"))
    events = events_of(spread(fx.view(spark, sf_dir, fx.STREAM), "seq")).withColumn("t", epoch_micros(F.col("ts")))
    return evaluate_rules(events, mixed_catalogue(), "t", "seq", datasets=lists, columns=["seq"]).select("seq", "rule_id")
