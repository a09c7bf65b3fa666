"""End-to-end rules, composed from the operators, over the event and profile views."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewatch.functions.formats import classify_product
from tidewatch.functions.values import epoch_micros, field
from tidewatch.operators import profile
from tidewatch.operators.evaluate import evaluate_rule, evaluate_rules
from tidewatch.operators.match import events_of
from tidewatch.plans import fixtures as fx
from tidewatch.plans.matching import AMOUNT, TREE_RULES, cond, node, rule, text_sql
from tidewatch.plans.profiles import FOLD
from tidewatch.plans.registry import ctes, dataset_rows, events_sql, phone_sql, query, stream_events
from tidewatch.plans.sequences import SIX_HOURS, greedy_sql
from tidewatch.plans.validation import BATCH_CHECK, valid_batch

DAY = 86_400_000_000
STATUS, BILL, SESSION, PHONE = (text_sql(p) for p in ("status", "data.request.billCode", "device_session_id", "msisdn"))


def first_of(*keys, ttl):
    return {"type": "CONDITION", "expression": {"op": "IS_FIRST_ARRIVAL", "order_by": "processing_time", "key_fields": list(keys), "ttl": ttl}}


def member(dataset, *fields, negate=False):
    return {"type": "CONDITION", "expression": {"op": "IN_DATASET", "fields": list(fields), "dataset_id": dataset, "negate": negate}}


def all_of(*nodes):
    return {"type": "AND", "children": list(nodes)}


def trigger(source, conditions=(), key="msisdn"):
    return {"source": source, "schema_version": "v1", "key_field": key, "conditions": list(conditions)}


# ------------------------------------------------ first credit per (key, product), four sources

# Notices as JSON events: product classes by client code and message text.
NOTICES = """SELECT event_id AS seq, ts, CASE event_type WHEN 'purchase' THEN 'CPM' WHEN 'error' THEN 'EVT' WHEN 'signup' THEN 'TDH' ELSE 'NOTI' END AS source,
  '{"msisdn":"098' || lpad(cast(user_id AS string), 7, '0') || '","payment_type":"' || CASE WHEN event_id % 3 = 0 THEN 'DEBIT' ELSE 'CREDIT' END
  || '","error_code":"' || CASE WHEN event_id % 4 = 0 THEN 'FAILED' ELSE 'SUCCESS' END || '","client_code":"'
  || CASE event_id % 5 WHEN 0 THEN 'NAPAS' WHEN 1 THEN 'BIDV' WHEN 2 THEN 'XYZ' ELSE 'VTP' END || '","msg_content":"'
  || CASE event_id % 3 WHEN 0 THEN 'GD nhan tien' WHEN 1 THEN 'VTT VTP_REC_ 1' ELSE 'x QUATANGVOUCHER' END || '"}' AS payload FROM events"""
FIRST_CREDIT = {
    "rule_id": "first_credit",
    "trigger_criteria": [
        trigger("TDH"), trigger("EVT"), trigger("NOTI", [[cond("payment_type", "==", "CREDIT")]]), trigger("CPM", [[cond("error_code", "==", "SUCCESS")]]),
    ],
    "condition_tree": first_of("msisdn", "product", ttl="5d"),
}
_CLIENT, _MESSAGE = text_sql("client_code"), text_sql("msg_content")
_PRODUCT = f"""CASE WHEN {_CLIENT} IN ('NAPAS', 'BIDV') THEN 'nhan_tien' WHEN {_CLIENT} = 'VTP' THEN CASE WHEN starts_with({_MESSAGE}, 'GD nhan tien') THEN 'nhan_tien'
  WHEN contains({_MESSAGE}, 'VTT VTP_REC_') THEN 'nap_tien' ELSE 'tra_thuong' END END"""


@query("product_class", f"WITH n AS (SELECT seq, payload AS j FROM ({NOTICES}) x) SELECT seq, {_PRODUCT} AS product FROM n")
def product_class(spark, sf_dir):
    e = events_of(fx.view(spark, sf_dir, NOTICES))
    at = lambda name: field(F.col("event"), name, "string")
    return e.select("seq", classify_product(at("client_code"), at("msg_content")).alias("product"))


@query("biz_first_credit", greedy_sql(
    f"""SELECT * FROM (SELECT seq, source, epoch_us(ts) AS t, {text_sql('msisdn')} AS msisdn, {_PRODUCT} AS product, j FROM (SELECT *, payload AS j FROM ({NOTICES}) x) y) z
    WHERE product IS NOT NULL AND (source IN ('TDH', 'EVT') OR (source = 'NOTI' AND {text_sql('payment_type')} = 'CREDIT') OR (source = 'CPM' AND {text_sql('error_code')} = 'SUCCESS'))""",
    ["msisdn", "product"], 5 * DAY, f"seq, {phone_sql('msisdn')} AS partition_key, 'first_credit' AS rule_id", (), "seq"))
def biz_first_credit(spark, sf_dir):
    notices = fx.view(spark, sf_dir, NOTICES)
    doc = F.try_parse_json("payload")
    at = lambda name: F.try_variant_get(doc, f"$.{name}", "string")
    # The product joins the payload, as the source systems send it.
    fields = F.from_json("payload", "map<string,string>")
    product = classify_product(at("client_code"), at("msg_content"))
    with_product = notices.withColumn("payload", F.to_json(F.map_concat(fields, F.create_map(F.lit("product"), product))))
    events = events_of(with_product).withColumn("t", epoch_micros(F.col("ts")))
    return evaluate_rule(events, FIRST_CREDIT, "t", "seq").select("seq", "partition_key", "rule_id")


# ------------------------------------------------ drop-off within a window

DROP_OFF = rule(
    "drop_off", "EVT", [[cond("eventType", "IN", ["view", "click"])]],
    {"type": "SEQUENCE", "pattern": "NOT_FOLLOWED_BY", "min_time": 0, "max_time": 120, "time_unit": "minute",
     "join_keys": [{"left_field": "first.device_session_id", "right_field": "second.device_session_id"}],
     "first": {"source": "EVT", "filter": [cond("eventType", "==", "view")]},
     "second": {"source": "EVT", "filter": [cond("eventType", "==", "click")]}},
)
_EVT = f"SELECT seq, t, {SESSION} AS sid, {text_sql('eventType')} AS kind FROM e WHERE source = 'EVT'"


@query("biz_dropoff", events_sql(f"SELECT seq, 'drop_off' AS rule_id FROM v a WHERE kind = 'view' AND NOT EXISTS (SELECT 1 FROM v b WHERE b.kind = 'click' AND b.sid = a.sid AND b.t BETWEEN a.t + 1 AND a.t + {120 * 60_000_000})", v=_EVT))
def biz_dropoff(spark, sf_dir):
    return evaluate_rule(stream_events(spark, sf_dir), DROP_OFF, "t", "seq").select("seq", "rule_id")


# ------------------------------------------------ trial refund: cross field, tuple membership, first renewal

RENEWALS = """SELECT event_id AS seq, ts, 'PMT' AS source, '{"msisdn":"' || cast(user_id AS string) || '","channelId":"' || CASE WHEN event_id % 7 = 0 THEN 'APP' ELSE 'CPSUB' END
  || '","status":"' || CASE WHEN event_type = 'error' THEN 'LOI' ELSE 'THANH_CONG' END || '","serviceCode":"' || event_type || '","subCode":"'
  || CASE WHEN event_id % 4 = 0 THEN 'other' ELSE event_type END || '"}' AS payload FROM events"""
TRIAL_REFUND = rule(
    "trial_refund", "PMT", [[cond("channelId", "==", "CPSUB"), cond("status", "==", "THANH_CONG")]],
    all_of(node("serviceCode", "==", right_field="subCode"), member("user_type", "msisdn", "subCode"), first_of("msisdn", "subCode", ttl="10d")),
)


@query("biz_trial_refund", greedy_sql(
    f"""SELECT seq, t, u, s FROM (SELECT seq, epoch_us(ts) AS t, {text_sql('msisdn')} AS u, {text_sql('subCode')} AS s, j FROM (SELECT *, payload AS j FROM ({RENEWALS}) x) y) z
    WHERE {text_sql('channelId')} = 'CPSUB' AND {text_sql('status')} = 'THANH_CONG' AND {text_sql('serviceCode')} = s
      AND EXISTS (SELECT 1 FROM fx_datasets d WHERE d.dataset_id = 'user_type' AND d.v1 = u AND d.v2 = s)""",
    ["u", "s"], 10 * DAY, "seq, 'trial_refund' AS rule_id", ("fx_datasets",), "seq"))
def biz_trial_refund(spark, sf_dir):
    events = events_of(fx.view(spark, sf_dir, RENEWALS)).withColumn("t", epoch_micros(F.col("ts")))
    return evaluate_rule(events, TRIAL_REFUND, "t", "seq", datasets=dataset_rows(spark, sf_dir)).select("seq", "rule_id")


# ------------------------------------------------ promo purchase, gift, toll refund, VIP failures

PURCHASES = """SELECT event_id AS seq, ts, 'SUB_MNGT' AS source, '{"account":"' || cast(user_id AS string) || '","application_code":"sub-mngt","error_code":"'
  || CASE WHEN event_id % 6 = 0 THEN '01' ELSE '00' END || '","sub_code":"VTM' || cast(event_id % 7 AS string) || '","is_renew":"'
  || CASE event_id % 3 WHEN 0 THEN 'true' WHEN 1 THEN 'false' ELSE 'unknown' END || '"}' AS payload FROM events"""
PROMO = rule(
    "promo", "SUB_MNGT", [[cond("application_code", "==", "sub-mngt"), cond("error_code", "==", "00")]],
    all_of(
        node("sub_code", "IN", ["VTM1", "VTM2", "VTM3", "VTM4"]),
        {"type": "OR", "children": [node("is_renew", "==", "false"), node("is_renew", "==", "true")]},
        member("vip", "account"),
    ),
)


@query("biz_promo", ctes("fx_datasets", e=f"SELECT *, payload AS j FROM ({PURCHASES}) x") + f"""SELECT seq, 'promo' AS rule_id FROM e WHERE {text_sql('error_code')} = '00'
  AND {text_sql('sub_code')} IN ('VTM1', 'VTM2', 'VTM3', 'VTM4') AND {text_sql('is_renew')} IN ('true', 'false')
  AND EXISTS (SELECT 1 FROM fx_datasets d WHERE dataset_id = 'vip' AND d.v1 = {text_sql('account')})""")
def biz_promo(spark, sf_dir):
    events = events_of(fx.view(spark, sf_dir, PURCHASES)).withColumn("t", epoch_micros(F.col("ts")))
    return evaluate_rule(events, PROMO, "t", "seq", datasets=dataset_rows(spark, sf_dir)).select("seq", "rule_id")


GIFT = rule("gift", "CPM", [[cond("data.request.billCode", "IN", ["B1", "B5"])]], node("data.request.billCode", "!=", ""))


@query("biz_gift", events_sql(f"SELECT seq, coalesce({phone_sql(PHONE)}, {PHONE}) AS partition_key, 'gift' AS rule_id FROM e WHERE source = 'CPM' AND {BILL} IN ('B1', 'B5')"))
def biz_gift(spark, sf_dir):
    return evaluate_rules(stream_events(spark, sf_dir), [GIFT], "t", "seq").select("seq", "partition_key", "rule_id")


TOLL_REFUND = rule(
    "toll_refund", "CPM", [[cond("status", "==", "SUCCESS")]],
    all_of(
        node("amount", ">", 0),
        member("black_a", "device_session_id", negate=True),
        member("black_b", "device_session_id", negate=True),
        first_of("device_session_id", ttl="3d"),
    ),
)
BLACKLISTS = """SELECT DISTINCT 'black_a' AS dataset_id, 'v1' AS dataset_version, 'S' || cast(user_id % 50 AS string) AS v1 FROM events WHERE user_id % 50 % 10 = 3
UNION ALL SELECT DISTINCT 'black_b', 'v1', 'S' || cast(user_id % 50 AS string) FROM events WHERE user_id % 50 % 7 = 2"""


@query("biz_toll_refund", greedy_sql(
    f"""SELECT seq, t, sid FROM (SELECT seq, epoch_us(ts) AS t, {SESSION} AS sid, {AMOUNT} AS amount, {STATUS} AS status FROM (SELECT *, payload AS j FROM fx_stream
      WHERE source = 'CPM' AND json_valid(payload) AND json_type(payload) = 'OBJECT') x) y
    WHERE status = 'SUCCESS' AND amount > 0 AND sid NOT IN (SELECT v1 FROM ({BLACKLISTS}) b)""",
    ["sid"], 3 * DAY, "seq, 'toll_refund' AS rule_id", ("fx_stream",), "seq"))
def biz_toll_refund(spark, sf_dir):
    lists = fx.view(spark, sf_dir, BLACKLISTS).select("dataset_id", "dataset_version", F.array("v1").alias("tuple"))
    return evaluate_rule(stream_events(spark, sf_dir), TOLL_REFUND, "t", "seq", datasets=lists).select("seq", "rule_id")


FAILURES = {
    "rule_id": "vip_failures",
    "trigger_criteria": [
        trigger("CDCN", [[cond("msisdn", "IS_NOT_NULL"), cond("status", "!=", "SUCCESS")]]),
        trigger("CPM", [[cond("status", "!=", "SUCCESS")]]),
        trigger("TDH", [[cond("status", "!=", "SUCCESS")]]),
        trigger("EVT", [[cond("eventType", "==", "view"), cond("amount", ">", 60)]]),
    ],
    "condition_tree": all_of(member("vip_sessions", "device_session_id"), member("noise", "data.request.billCode", negate=True)),
}
VIP_LISTS = """SELECT DISTINCT 'vip_sessions' AS dataset_id, 'v1' AS dataset_version, 'S' || cast(user_id % 50 AS string) AS v1 FROM events WHERE user_id % 50 % 4 = 1
UNION ALL SELECT DISTINCT 'noise', 'v1', 'B' || cast(event_id % 10 AS string) FROM events WHERE event_id % 10 IN (2, 6)"""


@query("biz_vip_failures", events_sql(f"""SELECT seq, source, 'vip_failures' AS rule_id FROM e WHERE ((source = 'CDCN' AND {PHONE} IS NOT NULL AND {STATUS} <> 'SUCCESS') OR (source IN ('CPM', 'TDH') AND {STATUS} <> 'SUCCESS')
  OR (source = 'EVT' AND {text_sql('eventType')} = 'view' AND {AMOUNT} > 60)) AND {SESSION} IN (SELECT v1 FROM l WHERE dataset_id = 'vip_sessions')
  AND {BILL} IS NOT NULL AND {BILL} NOT IN (SELECT v1 FROM l WHERE dataset_id = 'noise')""", l=VIP_LISTS))
def biz_vip_failures(spark, sf_dir):
    lists = fx.view(spark, sf_dir, VIP_LISTS).select("dataset_id", "dataset_version", F.array("v1").alias("tuple"))
    return evaluate_rule(stream_events(spark, sf_dir), FAILURES, "t", "seq", datasets=lists).select("seq", "source", "rule_id")


# ------------------------------------------------ high value: event, two profile datasets, epoch guard

# The batch view with fewer entities, so that one entity is in several datasets of a batch.
SHARED_KEYS = fx.BATCH.replace("c_custkey % 150", "c_custkey % 15")
PAYMENTS = """SELECT event_id AS seq, ts, 'CPM' AS source, '{"msisdn":"098' || lpad(cast(user_id % 15 AS string), 7, '0') || '","amount":' || cast(cast(value AS decimal(18,2)) AS string) || '}' AS payload FROM events"""
HIGH_VALUE = rule(
    "high_value", "CPM", [],
    all_of(node("CPM.amount", ">=", 5.0), node("active_promo.sub_code", "IN", ["VTM1", "VTM2", "VTM3", "VTM4"]), node("daily_spending.balance", ">", 1000.0)),
)
_GUARDED = "SELECT p.* FROM p JOIN act USING (dataset_name) WHERE batch_id = active_batch_id"
_GUARD_CTES = dict(BATCH_CHECK, **FOLD, g=_GUARDED, e=f"SELECT *, payload AS j FROM ({PAYMENTS}) x", k=f"SELECT seq, {AMOUNT} AS amount, {phone_sql(PHONE)} AS key_value FROM e")


@query("biz_high_value", ctes(fx_batch=SHARED_KEYS, **_GUARD_CTES)
    + """SELECT seq, key_value AS partition_key FROM k WHERE amount >= 5 AND EXISTS (SELECT 1 FROM g WHERE g.key_value = k.key_value AND dataset_name = 'active_promo' AND field = 'sub_code' AND value IN ('VTM1', 'VTM2', 'VTM3', 'VTM4'))
  AND EXISTS (SELECT 1 FROM g WHERE g.key_value = k.key_value AND dataset_name = 'daily_spending' AND field = 'balance' AND cast(value AS double) > 1000)""")
def biz_high_value(spark, sf_dir):
    guarded = profile.current_profile(valid_batch(spark, sf_dir, SHARED_KEYS))
    events = events_of(fx.view(spark, sf_dir, PAYMENTS)).withColumn("t", epoch_micros(F.col("ts")))
    hits = evaluate_rule(events, HIGH_VALUE, "t", "seq", profile=guarded, profile_datasets={"active_promo", "daily_spending"})
    return hits.select("seq", "partition_key")


# ------------------------------------------------ a whole catalogue with cooldown

CATALOGUE = [{**TREE_RULES[0], "cooldown_seconds": 86_400}, TREE_RULES[1], DROP_OFF]
_BIG = f"SELECT seq, epoch_us(ts) AS t, {phone_sql(PHONE)} AS norm, {PHONE} AS raw FROM (SELECT *, payload AS j FROM fx_stream WHERE source = 'CPM' AND json_valid(payload) AND json_type(payload) = 'OBJECT') x WHERE {AMOUNT} >= 40.13 AND {STATUS} = 'SUCCESS'"
_WALK = greedy_sql(f"SELECT seq, t, coalesce(norm, raw) AS k FROM ({_BIG}) b WHERE raw IS NOT NULL", ["k"], DAY, "seq", ("fx_stream",), "seq")


@query("evaluate_catalogue", f"""SELECT seq, 'big_purchase' AS rule_id FROM ({_WALK}) w
UNION ALL (WITH fx_stream AS ({fx.STREAM}) SELECT seq, 'big_purchase' FROM ({_BIG}) b WHERE raw IS NULL)
UNION ALL ({events_sql(f"SELECT seq, 'cheap_failure' FROM e WHERE source = 'CDCN' AND {STATUS} = 'FAILED' AND ({AMOUNT} < 5 OR ({BILL} IN ('B0', 'B9') AND {SESSION} <> 'S1'))")})
UNION ALL ({events_sql(f"SELECT seq, 'drop_off' FROM v a WHERE kind = 'view' AND NOT EXISTS (SELECT 1 FROM v b WHERE b.kind = 'click' AND b.sid = a.sid AND b.t BETWEEN a.t + 1 AND a.t + {120 * 60_000_000})", v=_EVT)})""")
def evaluate_catalogue(spark, sf_dir):
    return evaluate_rules(stream_events(spark, sf_dir), CATALOGUE, "t", "seq").select("seq", "rule_id")
