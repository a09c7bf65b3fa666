"""Queries over entity profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewatch.functions.values import epoch_micros, text
from tidewatch.operators import profile
from tidewatch.plans import fixtures as fx
from tidewatch.plans.registry import ctes, query
from tidewatch.plans.validation import BATCH_CHECK, batch_sql, valid_batch

_VALUES = """SELECT seq, key_value, dataset_name, unnest(['sub_code', 'balance', 'segment']) AS field,
  unnest([json_extract_string(j, '$.data.sub_code'), json_extract_string(j, '$.data.balance'), json_extract_string(j, '$.data.segment')]) AS value, snapshot_ms AS at_ms
  FROM ok WHERE sync_mode <> 'DELETE'"""
FOLD = {
    "w": f"SELECT * FROM ({_VALUES}) x WHERE value IS NOT NULL",
    "r": "SELECT key_value, dataset_name, max(seq) FILTER (WHERE sync_mode IN ('FULL_SNAPSHOT', 'DELETE')) AS reset_seq FROM ok GROUP BY ALL",
    "m": "SELECT key_value, dataset_name, arg_max(batch_id, seq) AS batch_id, arg_max(snapshot_ms, seq) AS snapshot_ms FROM ok WHERE sync_mode <> 'DELETE' GROUP BY ALL",
    "p": """SELECT key_value, dataset_name, field, arg_max(value, seq) AS value, max(batch_id) AS batch_id, max(snapshot_ms) AS snapshot_ms, arg_max(at_ms, seq) AS field_ms
      FROM w JOIN r USING (key_value, dataset_name) JOIN m USING (key_value, dataset_name)
      WHERE reset_seq IS NULL OR seq >= reset_seq GROUP BY key_value, dataset_name, field""",
    "act": "SELECT dataset_name, arg_max(batch_id, struct_pack(a := snapshot_ms, b := seq)) AS active_batch_id FROM ok GROUP BY ALL",
}
# Numbers are compared as numbers: their text form differs between JSON readers.
SAME_VALUE = "CASE WHEN field = 'balance' THEN cast(cast(value AS decimal(18,2)) AS string) ELSE value END AS value"


def same_value():
    return F.when(F.col("field") == "balance", F.col("value").cast("decimal(18,2)").cast("string")).otherwise(F.col("value")).alias("value")


def folded(spark, sf_dir):
    return profile.fold_profile(valid_batch(spark, sf_dir))


@query("profile_fold", batch_sql(f"SELECT key_value, dataset_name, field, {SAME_VALUE}, batch_id, snapshot_ms FROM p", **FOLD))
def profile_fold(spark, sf_dir):
    return folded(spark, sf_dir).select("key_value", "dataset_name", "field", same_value(), "batch_id", "snapshot_ms")


TTL_AT = 1704164400000 + 20 * 86_400_000


@query("profile_ttl", batch_sql(f"SELECT key_value, dataset_name, field FROM p WHERE {TTL_AT} - field_ms < {profile.PROFILE_TTL_MS}", **FOLD))
def profile_ttl(spark, sf_dir):
    return profile.unexpired(folded(spark, sf_dir), F.lit(TTL_AT)).select("key_value", "dataset_name", "field")


@query("active_batch", batch_sql("SELECT dataset_name, active_batch_id FROM act", **FOLD))
def active_batch(spark, sf_dir):
    return profile.active_batches(valid_batch(spark, sf_dir))


@query("epoch_guard", batch_sql(f"SELECT key_value, dataset_name, field, {SAME_VALUE} FROM p JOIN act USING (dataset_name) WHERE batch_id = active_batch_id", **FOLD))
def epoch_guard(spark, sf_dir):
    return profile.current_profile(valid_batch(spark, sf_dir)).select("key_value", "dataset_name", "field", same_value())


# Events keyed like the batch side: its phones end in key % 150.
EVENT_KEYS = "SELECT event_id, ts, '+8498' || lpad(cast(user_id % 150 AS string), 7, '0') AS key_value, value FROM events"


@query("profile_enrich", batch_sql(
    "SELECT event_id, a.value AS sub_code, b.value AS segment FROM ev LEFT JOIN p a ON a.key_value = ev.key_value AND a.dataset_name = 'active_promo' AND a.field = 'sub_code' "
    "LEFT JOIN p b ON b.key_value = ev.key_value AND b.dataset_name = 'vip_list' AND b.field = 'segment'", ev=EVENT_KEYS, **FOLD))
def profile_enrich(spark, sf_dir):
    events = fx.view(spark, sf_dir, EVENT_KEYS)
    out, names = profile.enrich(events, "key_value", folded(spark, sf_dir), [("active_promo", "sub_code"), ("vip_list", "segment")])
    return out.select("event_id", F.col(names["active_promo.sub_code"]).alias("sub_code"), F.col(names["vip_list.segment"]).alias("segment"))


@query("profile_asof", batch_sql(
    """SELECT event_id, s.seq AS snapshot_seq, s.batch_id FROM ev LEFT JOIN (
      SELECT e.event_id AS eid, max(struct_pack(a := o.snapshot_ms, b := o.seq)) AS best FROM ev e JOIN ok o ON o.key_value = e.key_value AND o.snapshot_ms * 1000 <= epoch_us(e.ts) GROUP BY 1) x
      ON x.eid = ev.event_id LEFT JOIN ok s ON s.seq = x.best.b AND s.key_value = ev.key_value""", ev=EVENT_KEYS))
def profile_asof(spark, sf_dir):
    events = fx.view(spark, sf_dir, EVENT_KEYS).withColumn("t", epoch_micros(F.col("ts")))
    snaps = valid_batch(spark, sf_dir).select("seq", "key_value", "batch_id", (F.col("snapshot_ms") * 1000).alias("st"))
    out = profile.enrich_asof(events, "key_value", "t", snaps, "st", F.struct("seq", "batch_id"), "snap")
    return out.select("event_id", F.col("snap.seq").alias("snapshot_seq"), F.col("snap.batch_id").alias("batch_id"))
