"""Queries over key normalisation and the two validators."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewatch.functions.keys import in_countries, is_valid_e164, normalize_key
from tidewatch.functions.values import field
from tidewatch.operators import report, validate
from tidewatch.operators.schemas import Registry, read_schemas
from tidewatch.plans import fixtures as fx
from tidewatch.plans.registry import SQL_EVENTS, ctes, events_sql, phone_sql, query, stream_events
from tidewatch.sources.documents import schema_table

AS_OF = "2024-02-01T00:00:00Z"


def as_of():
    return F.try_to_timestamp(F.lit(AS_OF))


def stream_registry(spark) -> Registry:
    return Registry.of(read_schemas(schema_table(spark, fx.stream_schema_documents()), "seq"))


def batch_registry(spark) -> Registry:
    return Registry.of(read_schemas(schema_table(spark, fx.batch_schema_documents()), "seq"))


RAW_PHONE = "json_extract_string(j, '$.data.request.msisdn')"


@query("normalize_keys", events_sql(f"SELECT seq, {RAW_PHONE} AS raw, {phone_sql(RAW_PHONE)} AS phone FROM e WHERE {phone_sql(RAW_PHONE)} IS NOT NULL"))
def normalize_keys(spark, sf_dir):
    e = stream_events(spark, sf_dir).select("seq", field(F.col("event"), "data.request.msisdn", "string").alias("raw"))
    return e.withColumn("phone", normalize_key(F.col("raw"))).where("phone is not null")


@query("normalize_key_rejects", events_sql(f"SELECT seq, {RAW_PHONE} AS raw, regexp_full_match({RAW_PHONE}, '\\+[1-9][0-9]{{6,14}}') AS valid_as_is FROM e WHERE {RAW_PHONE} IS NOT NULL AND {phone_sql(RAW_PHONE)} IS NULL"))
def normalize_key_rejects(spark, sf_dir):
    e = stream_events(spark, sf_dir).select("seq", field(F.col("event"), "data.request.msisdn", "string").alias("raw"))
    return e.where(F.col("raw").isNotNull() & normalize_key(F.col("raw")).isNull()).withColumn("valid_as_is", is_valid_e164(F.col("raw")))


_RAW = "coalesce(json_extract_string(j, '$.msisdn'), CASE WHEN json_type(j, '$.msisdn') = 'NULL' THEN 'null' END)"
_NUM = "json_type(j, '$.amount') IN ('BIGINT', 'UBIGINT', 'DOUBLE', 'HUGEINT')"
_TXT = "json_extract_string(j, '$.amount')"
STREAM_CHECK = {
    "e": SQL_EVENTS,
    "k": f"SELECT *, {_RAW} AS raw, {phone_sql(_RAW)} AS event_key FROM e",
    "c": f"""SELECT *, CASE WHEN trim(payload) = '' THEN 'ERR_STREAM_EMPTY_PAYLOAD' WHEN NOT json_valid(payload) THEN 'ERR_STREAM_JSON_MALFORMED'
      WHEN j IS NULL THEN 'ERR_STREAM_PAYLOAD_NOT_OBJECT' WHEN raw IS NOT NULL AND event_key IS NULL THEN 'ERR_STREAM_INVALID_KEY_FORMAT' END AS early,
      concat_ws(',', CASE WHEN json_type(j, '$.amount') IS NULL THEN 'ERR_MISSING_REQUIRED_FIELD:amount'
        WHEN NOT ({_NUM} OR try_cast({_TXT} AS double) IS NOT NULL) THEN 'ERR_TYPE_MISMATCH:amount'
        WHEN {_NUM} AND cast({_TXT} AS double) < 0 THEN 'ERR_OUT_OF_RANGE:amount' END,
        CASE WHEN json_extract_string(j, '$.status') NOT IN ('SUCCESS', 'FAILED') THEN 'ERR_ENUM_VIOLATION:status' END,
        CASE WHEN json_type(j, '$.data.request.billCode') IS NULL THEN 'ERR_MISSING_REQUIRED_FIELD:data.request.billCode' END) AS broken FROM k""",
    "v": "SELECT *, CASE WHEN early IS NULL THEN broken ELSE '' END AS errors, coalesce(early, CASE WHEN broken <> '' THEN 'ERR_STREAM_VALIDATION_FAILED' END) AS error_code FROM c",
}


def checked_stream(spark, sf_dir):
    return validate.check_stream(fx.view(spark, sf_dir, fx.STREAM), stream_registry(spark))


@query("stream_validate_ok", ctes("fx_stream", **STREAM_CHECK) + "SELECT seq, source, event_key, 'stream_' || source || '_v1' AS schema_id FROM v WHERE error_code IS NULL")
def stream_validate_ok(spark, sf_dir):
    return validate.valid(checked_stream(spark, sf_dir)).select("seq", "source", "event_key", "schema_id")


@query("stream_validate_rewritten", ctes("fx_stream", **STREAM_CHECK) + "SELECT seq, event_key AS msisdn, try_cast(json_extract_string(j, '$.amount') AS double) AS amount FROM v WHERE error_code IS NULL")
def stream_validate_rewritten(spark, sf_dir):
    """What the emitted event itself holds."""
    event = F.col("event")
    good = validate.valid(checked_stream(spark, sf_dir))
    return good.select("seq", field(event, "msisdn", "string").alias("msisdn"), field(event, "amount", "double").alias("amount"))


@query("stream_validate_key_defaults", ctes("fx_stream", **STREAM_CHECK) + "SELECT seq, event_key FROM v WHERE error_code IS NULL")
def stream_validate_key_defaults(spark, sf_dir):
    """Schemas without a key definition, whose checks of the key hold for its normalised form only."""
    key = {"type": "STRING", "regex_pattern": "[+]84[0-9]{9}", "min_length": 12, "max_length": 12}
    docs = [{**d, "fields": {**d["fields"], "msisdn": key}} for d in fx.stream_schema_documents()]
    for d in docs:
        d.pop("key_definition", None)
    schemas = Registry.of(read_schemas(schema_table(spark, docs), "seq"))
    return validate.valid(validate.check_stream(fx.view(spark, sf_dir, fx.STREAM), schemas)).select("seq", "event_key")


@query("stream_validate_errors", ctes("fx_stream", **STREAM_CHECK) + "SELECT seq, error_code, errors FROM v WHERE error_code IS NOT NULL")
def stream_validate_errors(spark, sf_dir):
    listed = F.concat_ws(",", F.transform("errors", lambda e: F.concat(e["code"], F.lit(":"), e["field"])))
    return validate.rejected(checked_stream(spark, sf_dir)).select("seq", "error_code", listed.alias("errors"))


_ENV = ["dataset_name", "pipeline_id", "batch_id", "snapshot_time", "sync_mode", "key_value"]
_MISSING = ", ".join(f"CASE WHEN json_extract_string(j, '$.{n}') IS NULL THEN '{n}' END" for n in _ENV)
BATCH_CHECK = {
    "b0": "SELECT *, CASE WHEN json_valid(payload) THEN payload END AS j FROM fx_batch",
    "b1": f"""SELECT seq, j, json_extract_string(j, '$.dataset_name') AS dataset_name, json_extract_string(j, '$.batch_id') AS batch_id,
      upper(json_extract_string(j, '$.sync_mode')) AS sync_mode, concat_ws(',', {_MISSING}) AS missing,
      {phone_sql("json_extract_string(j, '$.key_value')")} AS key_value,
      epoch_ms(try_cast(json_extract_string(j, '$.snapshot_time') AS timestamptz)) AS snapshot_ms FROM b0""",
    "b2": """SELECT *, CASE WHEN j IS NULL THEN 'ERR_BATCH_JSON_MALFORMED' WHEN missing <> '' THEN 'ERR_BATCH_MISSING_ENVELOPE'
      WHEN sync_mode NOT IN ('FULL_SNAPSHOT', 'UPSERT', 'DELETE') THEN 'ERR_BATCH_INVALID_SYNC_MODE'
      WHEN key_value IS NULL THEN 'ERR_BATCH_INVALID_KEY_FORMAT'
      WHEN dataset_name NOT IN ('trial_registered', 'active_promo', 'daily_spending', 'vip_list') THEN 'ERR_BATCH_SCHEMA_NOT_FOUND' END AS early FROM b1""",
    "b3": """SELECT *, max(CASE WHEN early IS NULL THEN snapshot_ms END) OVER (PARTITION BY dataset_name ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS mark FROM b2""",
    "b4": """SELECT *, coalesce(early, CASE WHEN snapshot_ms < mark THEN 'ERR_BATCH_STALE_SNAPSHOT'
        WHEN sync_mode <> 'DELETE' AND coalesce(json_type(j, '$.data'), '') <> 'OBJECT' THEN 'ERR_BATCH_MISSING_DATA'
        WHEN sync_mode <> 'DELETE' AND ((sync_mode = 'FULL_SNAPSHOT' AND json_type(j, '$.data.sub_code') IS NULL)
          OR coalesce(json_extract_string(j, '$.data.sub_code') NOT IN ('VTM1', 'VTM2', 'VTM3', 'VTM4'), false)) THEN 'ERR_BATCH_FIELD_CONSTRAINTS_VIOLATED' END) AS error_code FROM b3""",
    "ok": "SELECT * FROM b4 WHERE error_code IS NULL",
}


def batch_sql(body: str, **more: str) -> str:
    return ctes("fx_batch", **BATCH_CHECK, **more) + body


def checked_batch(spark, sf_dir, view=fx.BATCH, **options):
    return validate.check_batch(fx.view(spark, sf_dir, view), batch_registry(spark), as_of(), **options)


def valid_batch(spark, sf_dir, view=fx.BATCH):
    return validate.valid(checked_batch(spark, sf_dir, view))


@query("batch_validate_ok", batch_sql("SELECT seq, dataset_name, key_value, sync_mode, batch_id, snapshot_ms FROM ok"))
def batch_validate_ok(spark, sf_dir):
    return valid_batch(spark, sf_dir).select("seq", "dataset_name", "key_value", "sync_mode", "batch_id", "snapshot_ms")


_STAGE_SQL = "CASE " + " ".join(f"WHEN error_code = '{c}' THEN '{s}'" for c, s in validate.STAGES.items()) + " END"


@query("batch_validate_dlq_counts", batch_sql(f"SELECT error_code, {_STAGE_SQL} AS failed_stage, count(*) AS n FROM b4 WHERE error_code IS NOT NULL GROUP BY ALL"))
def batch_validate_dlq_counts(spark, sf_dir):
    return validate.rejected(checked_batch(spark, sf_dir)).groupBy("error_code", "failed_stage").agg(F.count("*").alias("n"))


@query("batch_dead_letters", batch_sql(f"""SELECT b4.seq, b4.error_code, {_STAGE_SQL} AS failed_stage,
  CASE WHEN error_code = 'ERR_BATCH_MISSING_ENVELOPE' THEN missing WHEN error_code = 'ERR_BATCH_INVALID_SYNC_MODE' THEN 'sync_mode'
    WHEN error_code = 'ERR_BATCH_INVALID_KEY_FORMAT' THEN 'key_value' WHEN error_code = 'ERR_BATCH_STALE_SNAPSHOT' THEN 'snapshot_time'
    WHEN error_code = 'ERR_BATCH_MISSING_DATA' THEN 'data'
    WHEN error_code = 'ERR_BATCH_FIELD_CONSTRAINTS_VIOLATED' AND json_type(j, '$.data.sub_code') IS NULL THEN 'ERR_MISSING_REQUIRED_FIELD: sub_code'
    WHEN error_code = 'ERR_BATCH_FIELD_CONSTRAINTS_VIOLATED' THEN 'ERR_ENUM_VIOLATION: sub_code' ELSE '' END AS failed_fields,
  topic AS source_topic, json_valid(payload) AS raw_is_json FROM b4 JOIN fx_batch USING (seq) WHERE error_code IS NOT NULL"""))
def batch_dead_letters(spark, sf_dir):
    bad = validate.rejected(checked_batch(spark, sf_dir))
    letter = F.from_json("value", "error_code string, failed_stage string, failed_fields array<string>, source_topic string, raw_payload variant")
    # The letter is read back from its JSON text, one per rejected row.
    letters = report.dead_letters(bad.withColumn("topic", F.concat_ws("#", "seq", "topic")), as_of()).select(letter.alias("l"))
    at = F.split("l.source_topic", "#", 2)
    return letters.select(
        at[0].cast("bigint").alias("seq"), "l.error_code", "l.failed_stage", F.array_join("l.failed_fields", ",").alias("failed_fields"),
        at[1].alias("source_topic"), F.startswith(F.schema_of_variant("l.raw_payload"), F.lit("OBJECT")).alias("raw_is_json"),
    )


@query("batch_anti_stale", batch_sql("SELECT seq, dataset_name, snapshot_ms FROM b4 WHERE error_code = 'ERR_BATCH_STALE_SNAPSHOT'"))
def batch_anti_stale(spark, sf_dir):
    # A small chunk, so that marks cross chunk borders.
    checked = checked_batch(spark, sf_dir, chunk_rows=500)
    return checked.where("error_code = 'ERR_BATCH_STALE_SNAPSHOT'").select("seq", "dataset_name", "snapshot_ms")


@query("nested_path_required", events_sql("SELECT seq, json_extract_string(j, '$.data.request.billCode') AS bill_code, json_type(j, '$.data.request.billCode') IS NULL AS is_missing FROM e WHERE j IS NOT NULL"))
def nested_path_required(spark, sf_dir):
    e = stream_events(spark, sf_dir)
    at = field(F.col("event"), "data.request.billCode")
    return e.select("seq", field(F.col("event"), "data.request.billCode", "string").alias("bill_code"), at.isNull().alias("is_missing"))


# Values of every named format, some broken, derived from the orders.
FORMAT_SQL = """SELECT o_orderkey AS seq,
  CASE WHEN o_orderkey % 7 = 0 THEN 'yesterday' ELSE '2024-01-' || lpad(cast(1 + o_orderkey % 28 AS string), 2, '0') || 'T10:00:00Z' END AS iso,
  CASE WHEN o_orderkey % 5 = 0 THEN '0' ELSE '+' END || '8498' || lpad(cast(o_custkey AS string), 7, '0') AS phone,
  lpad(cast(o_orderkey AS string), 8, CASE WHEN o_orderkey % 3 = 0 THEN 'g' ELSE '0' END) || '-0000-0000-0000-' || lpad(cast(o_custkey AS string), 12, '0') AS uuid,
  CASE WHEN o_orderkey % 4 = 0 THEN '2024-13-01' ELSE '2024-02-' || lpad(cast(1 + o_orderkey % 28 AS string), 2, '0') END AS day,
  CASE WHEN o_orderkey % 6 = 0 THEN '12.5' ELSE cast(1700000000000 + o_orderkey AS string) END AS ms
FROM orders"""
FORMAT_FIELDS = {"iso": "ISO-8601", "phone": "PHONE_E164", "uuid": "UUID", "day": "ISO_DATE", "ms": "EPOCH_MS"}


@query("format_check", f"WITH f AS ({FORMAT_SQL}) " + """SELECT seq, concat_ws(',', CASE WHEN try_cast(iso AS timestamptz) IS NULL THEN 'iso' END,
  CASE WHEN NOT regexp_full_match(phone, '\\+[1-9][0-9]{6,14}') THEN 'phone' END,
  CASE WHEN NOT regexp_full_match(uuid, '[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}') THEN 'uuid' END,
  CASE WHEN try_cast(day AS date) IS NULL THEN 'day' END, CASE WHEN NOT regexp_full_match(ms, '[0-9]{1,18}') THEN 'ms' END) AS bad_formats FROM f""")
def format_check(spark, sf_dir):
    doc = {"schema_id": "stream_FMT_v1", "schema_type": "STREAM", "source": "FMT", "topic": "FMT",
           "fields": {n: {"type": "STRING", "required": True, "format": f} for n, f in FORMAT_FIELDS.items()}}
    rows = fx.view(spark, sf_dir, FORMAT_SQL)
    df = rows.select("seq", F.lit("FMT").alias("topic"), F.to_json(F.struct(*FORMAT_FIELDS)).alias("payload"))
    checked = validate.check_stream(df, read_schemas(schema_table(spark, [doc])), check_format=True)
    return checked.select("seq", F.array_join(F.transform("errors", lambda e: e["field"]), ",").alias("bad_formats"))


@query("default_fill", batch_sql("""SELECT seq, CASE WHEN json_type(j, '$.data.sub_code') IS NULL THEN 'VTM1' END AS sub_code_default,
  CASE WHEN json_type(j, '$.data.arpu') IS NULL THEN '0.5' END AS arpu_default FROM ok WHERE sync_mode = 'UPSERT'"""))
def default_fill(spark, sf_dir):
    docs = [
        {**d, "fields": {**d["fields"], "sub_code": {**fx.BATCH_FIELDS["sub_code"], "default_value": "VTM1"}, "arpu": {"type": "DOUBLE", "default_value": 0.5}}}
        for d in fx.batch_schema_documents()
    ]
    schemas = Registry.of(read_schemas(schema_table(spark, docs), "seq"))
    good = validate.valid(validate.check_batch(fx.view(spark, sf_dir, fx.BATCH), schemas, as_of())).where("sync_mode = 'UPSERT'")
    filled = validate.with_defaults(good, schemas)
    return filled.select("seq", F.col("defaults")["sub_code"].alias("sub_code_default"), F.col("defaults")["arpu"].alias("arpu_default"))


COUNTRY_SQL = """SELECT c_custkey AS seq, '00' || CASE c_nationkey % 5 WHEN 0 THEN '84' WHEN 1 THEN '856' WHEN 2 THEN '1' WHEN 3 THEN '855' ELSE '44' END
  || lpad(cast(c_custkey AS string), 9, '2') AS raw FROM customer"""


@query("country_whitelist", f"WITH r AS ({COUNTRY_SQL}), n AS (SELECT seq, {phone_sql('raw')} AS phone FROM r) SELECT seq, phone, phone LIKE '+84%' OR phone LIKE '+856%' OR phone LIKE '+855%' AS allowed FROM n WHERE phone IS NOT NULL")
def country_whitelist(spark, sf_dir):
    rows = fx.view(spark, sf_dir, COUNTRY_SQL).select("seq", normalize_key(F.col("raw")).alias("phone")).where("phone is not null")
    return rows.withColumn("allowed", in_countries(F.col("phone"), ["84", "856", "855"]))
