"""Input views over the given tables, as one SQL text that both engines run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

STREAM = """
WITH p AS (
  SELECT event_id, ts, user_id, event_type, cast(value AS decimal(18,2)) AS amt,
         '98' || lpad(cast(user_id AS string), 7, '0') AS n
  FROM events),
q AS (
  SELECT *, CASE event_id % 7 WHEN 0 THEN '0' || n WHEN 1 THEN '84' || n WHEN 2 THEN '+84' || n
                  WHEN 3 THEN '0084' || n WHEN 4 THEN n
                  WHEN 5 THEN ' (0' || substr(n,1,2) || ') ' || substr(n,3,3) || '.' || substr(n,6,4)
                  ELSE CASE WHEN event_id % 5 = 0 THEN 'no number ' || cast(user_id AS string) ELSE '0' || n END
             END AS phone,
         CASE event_type WHEN 'purchase' THEN 'CPM' WHEN 'error' THEN 'CDCN'
                         WHEN 'signup' THEN 'TDH' ELSE 'EVT' END AS source
  FROM p),
j AS (
  SELECT *, '{"eventId":' || cast(event_id AS string)
      || CASE WHEN event_id % 73 = 0 THEN ',"msisdn":null' ELSE ',"msisdn":"' || phone || '"' END
      || ',"eventType":"' || event_type || '"'
      || CASE WHEN event_id % 83 = 0 THEN ''
              WHEN event_id % 79 = 0 THEN ',"amount":"twelve"'
              WHEN event_id % 71 = 0 THEN ',"amount":-' || cast(amt AS string)
              WHEN event_id % 61 = 0 THEN ',"amount":"' || cast(amt AS string) || '"'
              ELSE ',"amount":' || cast(amt AS string) END
      || ',"status":"' || CASE WHEN event_id % 59 = 0 THEN 'UNKNOWN' WHEN event_type = 'error' THEN 'FAILED' ELSE 'SUCCESS' END || '"'
      || ',"device_session_id":"S' || cast(user_id % 50 AS string) || '"'
      || ',"data":{"request":{"msisdn":"' || phone || '"' || CASE WHEN event_id % 53 = 0 THEN '' ELSE ',"billCode":"B' || cast(event_id % 10 AS string) || '"' END || '}}'
      || '}' AS body
  FROM q)
SELECT event_id AS seq, ts, user_id, 'T-' || source AS topic, source,
       CASE WHEN event_id % 97 = 0 THEN substr(body, 1, 31)
            WHEN event_id % 89 = 0 THEN '[1,2]'
            WHEN event_id % 67 = 0 THEN '   '
            ELSE body END AS payload
FROM j
"""

BATCH = """
WITH p AS (
  SELECT c_custkey AS k, c_mktsegment AS seg, cast(c_acctbal AS decimal(18,2)) AS bal,
         CASE c_custkey % 4 WHEN 0 THEN 'trial_registered' WHEN 1 THEN 'active_promo'
                            WHEN 2 THEN 'daily_spending' ELSE 'vip_list' END AS ds,
         CASE (c_custkey + cast(floor(c_custkey / 300.0) AS bigint)) % 3 WHEN 0 THEN 'FULL_SNAPSHOT' WHEN 1 THEN 'UPSERT' ELSE 'DELETE' END AS mode,
         '098' || lpad(cast(c_custkey % 150 AS string), 7, '0') AS phone,
         least(28, 1 + cast(floor(c_custkey / 60.0) AS bigint)) AS d
  FROM customer),
j AS (
  SELECT *, '{' || CASE WHEN k % 43 = 0 THEN '' ELSE '"dataset_name":"' || CASE WHEN k % 41 = 0 THEN 'unknown_ds' ELSE ds END || '",' END
      || CASE WHEN k % 47 = 0 THEN '' ELSE '"pipeline_id":"ETL_' || ds || '",' END
      || '"schema_version":"v1","batch_id":"B' || lpad(cast(d AS string), 2, '0') || '"'
      || ',"snapshot_time":"2024-01-' || lpad(cast(CASE WHEN k % 37 = 0 THEN 1 ELSE d END AS string), 2, '0') || 'T02:00:00+00:00"'
      || ',"sync_mode":"' || CASE WHEN k % 31 = 0 THEN 'INVALID' ELSE lower(mode) END || '"'
      || ',"key_field":"msisdn","key_value":"' || CASE WHEN k % 29 = 0 THEN 'key?' || cast(k AS string) ELSE phone END || '"'
      || CASE WHEN k % 23 = 0 THEN '' ELSE ',"data":{' ||
           CASE WHEN k % 17 = 0 THEN '' ELSE '"sub_code":"' || CASE WHEN k % 19 = 0 THEN 'BAD' ELSE 'VTM' || cast(1 + k % 4 AS string) END || '",' END
           || '"balance":' || cast(bal AS string) || ',"segment":"' || seg || '"}' END
      || '}' AS body
  FROM p)
SELECT k AS seq, 'batch_' || ds AS topic,
       CASE WHEN k % 53 = 0 THEN substr(body, 1, 40) ELSE body END AS payload
FROM j
"""

CLICKS = """
SELECT event_id, ts, user_id AS session_id,
       CASE event_type WHEN 'view' THEN 'CONTINUE' WHEN 'purchase' THEN 'RESULT' ELSE 'OTHER' END AS object_name
FROM events
"""

RULE_LOG = """
SELECT * FROM (VALUES
 (1,'r1',1,true ,'false','c','CPM','amount',     '>', '50'),
 (2,'r2',1,true ,'false','c','CDCN','status',    '==','FAILED'),
 (3,'r1',1,true ,'false','u','CPM','amount',     '>', '60'),
 (4,'r3',3,true ,'false','c','EVT','eventType',  '==','view'),
 (5,'r3',1,true ,'false','u','EVT','eventType',  '==','click'),
 (6,'r1',2,true ,'false','u','CPM','amount',     '>', '70'),
 (7,'r4',5,true ,'false','c','TDH','status',     '==','SUCCESS'),
 (8,'r4',6,true ,'false','d','TDH','status',     '==','SUCCESS'),
 (9,'r4',1,true ,'false','c','TDH','status',     '==','UNKNOWN'),
 (10,'r2',2,false,'false','u','CDCN','status',   '==','FAILED'),
 (11,'r5',1,true ,'true' ,'u','EVT','amount',    '>', '0'),
 (12,'ghost',1,true,'false','d','EVT','amount',  '>', '0')
) t(seq, rule_id, version, enabled, deleted, op, source, field, cond_op, cond_value)
"""

DATASETS = """
SELECT 'vip' AS dataset_id, 'v1' AS dataset_version, cast(user_id AS string) AS v1, cast(NULL AS string) AS v2
FROM (SELECT DISTINCT user_id FROM events WHERE user_id % 5 = 0) a
UNION ALL
SELECT 'user_type', 'v1', cast(user_id AS string), event_type
FROM (SELECT DISTINCT user_id, event_type FROM events WHERE user_id % 3 = 0) b
"""

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """Runs a view's text with each given table read in place."""
    for name in TABLES:
        sql = sql.replace(f"FROM {name}", f"FROM parquet.`{sf_dir}/{name}.parquet`")
    return spark.sql(sql)


# The schemas the two payload views are checked against.
STREAM_FIELDS = {
    "eventId": {"type": "LONG", "required": True},
    "msisdn": {"type": "STRING", "required": True, "nullable": False},
    "eventType": {"type": "STRING", "required": True},
    "amount": {"type": "DOUBLE", "required": True, "min": 0},
    "status": {"type": "STRING", "required": True, "allowed_values": ["SUCCESS", "FAILED"]},
    "device_session_id": {"type": "STRING", "required": True},
    "data.request.billCode": {"type": "STRING", "required": True},
}
BATCH_FIELDS = {
    "sub_code": {"type": "STRING", "required": True, "nullable": False, "allowed_values": ["VTM1", "VTM2", "VTM3", "VTM4"]},
    "balance": {"type": "DOUBLE"},
    "segment": {"type": "STRING"},
}
PHONE_KEY = {"key_type": "PHONE_E164", "auto_normalize": True, "allow_null": False, "default_country_code": "84"}
STREAM_SOURCES = ["TDH", "EVT", "CPM", "CDCN"]
BATCH_DATASETS = ["trial_registered", "active_promo", "daily_spending", "vip_list"]


def stream_schema_documents() -> list[dict]:
    return [
        {"schema_id": f"stream_{s}_v1", "schema_type": "STREAM", "source": s, "topic": f"T-{s}", "version": "v1",
         "key_definition": {**PHONE_KEY, "field": "msisdn"}, "fields": STREAM_FIELDS}
        for s in STREAM_SOURCES
    ]


def batch_schema_documents() -> list[dict]:
    return [
        {"schema_id": f"batch_{d}_v1", "schema_type": "BATCH", "dataset_name": d, "version": "v1", "ttl_seconds": 2592000,
         "key_definition": {**PHONE_KEY, "field": "msisdn"}, "allowed_sync_modes": ["FULL_SNAPSHOT", "UPSERT", "DELETE"],
         "fields": BATCH_FIELDS}
        for d in BATCH_DATASETS
    ]
