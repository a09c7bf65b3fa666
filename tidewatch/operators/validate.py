"""Validation of stream events and batch envelopes against the schema catalogue.

Input rows carry ``topic`` and ``payload`` (text). Every row comes back with an
``error_code`` (null when valid) so the split into valid rows and dead letters is two filters.
"""

from __future__ import annotations

import json
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F

from tidewatch.functions.formats import matches_format
from tidewatch.functions.keys import in_countries, normalize_key
from tidewatch.functions.values import (
    field, is_object_text, snapshot_millis, text,
)
from tidewatch.operators.scans import CHUNK_ROWS, kept, prior_max, with_once
from tidewatch.operators.schemas import Registry

# The envelope fields that must be present, in report order, and the sync modes.
ENVELOPE = ["dataset_name", "pipeline_id", "batch_id", "snapshot_time", "sync_mode", "key_value"]
SYNC_MODES = ["FULL_SNAPSHOT", "UPSERT", "DELETE"]
# The stage each batch error belongs to.
STAGES = {
    "ERR_BATCH_EMPTY_PAYLOAD": "LEVEL_1_PROTOCOL",
    "ERR_BATCH_JSON_MALFORMED": "LEVEL_1_PROTOCOL",
    "ERR_BATCH_PAYLOAD_NOT_OBJECT": "LEVEL_1_PROTOCOL",
    "ERR_BATCH_MISSING_ENVELOPE": "LEVEL_1_PROTOCOL",
    "ERR_BATCH_INVALID_SYNC_MODE": "LEVEL_1_PROTOCOL",
    "ERR_BATCH_INVALID_KEY_FORMAT": "LEVEL_2_KEY_NORMALIZATION",
    "ERR_BATCH_SCHEMA_NOT_FOUND": "LEVEL_3_SCHEMA_LOOKUP",
    "ERR_BATCH_SYNC_MODE_NOT_ALLOWED": "LEVEL_3_SCHEMA_LOOKUP",
    "ERR_BATCH_INVALID_TIMESTAMP": "LEVEL_4_ANTI_STALE",
    "ERR_BATCH_STALE_SNAPSHOT": "LEVEL_4_ANTI_STALE",
    "ERR_BATCH_MISSING_DATA": "LEVEL_5_FIELD_CONSTRAINT",
    "ERR_BATCH_FIELD_CONSTRAINTS_VIOLATED": "LEVEL_5_FIELD_CONSTRAINT",
}
SECONDARY_PHONE = "custMobileNo"
ERRORS_TYPE = "array<struct<code:string,field:string>>"


def _whole_number(kind: Column, value: Column, as_type: str, low: float, high: float) -> Column:
    """A number inside the range (fractions allowed), or text holding a whole number that fits."""
    as_text = text(value)
    return (
        F.when(_is_number(kind), F.try_variant_get(value, "$", "double").between(low, high))
        .when(kind == "STRING", as_text.rlike(r"^[+-]?[0-9]+\z") & as_text.try_cast(as_type).isNotNull())
        .otherwise(False)
    )


def _is_number(kind: Column) -> Column:
    return ~(kind.isin("STRING", "BOOLEAN", "VOID") | kind.startswith("OBJECT") | kind.startswith("ARRAY"))


def _type_ok(wanted: str, kind: Column, value: Column) -> Column:
    if wanted in ("STRING", "TIMESTAMP"):
        return ~(kind.startswith("OBJECT") | kind.startswith("ARRAY"))
    if wanted in ("INT", "INTEGER"):
        return _whole_number(kind, value, "int", -2147483648, 2147483647)
    if wanted == "LONG":
        return _whole_number(kind, value, "bigint", -9.223372036854775808e18, 9.223372036854775807e18)
    if wanted in ("DOUBLE", "FLOAT"):
        return _is_number(kind) | ((kind == "STRING") & text(value).try_cast("double").isNotNull())
    if wanted == "BOOLEAN":
        return (kind == "BOOLEAN") | ((kind == "STRING") & F.lower(text(value)).isin("true", "false"))
    if wanted in ("OBJECT", "ARRAY"):
        return kind.startswith(wanted)
    return F.lit(True)


def _field_checks(rule: dict, value: Column, kind: Column, require: Column, check_format: bool) -> list[tuple[str, Column]]:
    """(code, broken) of every constraint of one field, in check order.

    ``kind`` is the value's JSON type, null when the field is missing. Broken is never null.
    """
    present = kind.isNotNull() & (kind != "VOID")
    wanted = (rule.get("type") or "STRING").upper()
    type_ok = _type_ok(wanted, kind, value)
    held = present & type_ok if wanted else present
    as_text, as_number = text(value), F.try_variant_get(value, "$", "double")
    checks = []

    def add(code: str, broken: Column) -> None:
        checks.append((code, F.coalesce(broken, F.lit(False))))

    if rule.get("required"):
        add("ERR_MISSING_REQUIRED_FIELD", kind.isNull() & require)
    if rule.get("nullable") is False:
        add("ERR_NULL_NOT_ALLOWED", kind == "VOID")
    add("ERR_TYPE_MISMATCH", present & ~type_ok)
    if rule.get("allowed_values"):
        add("ERR_ENUM_VIOLATION", held & ~F.coalesce(as_text, F.lit("")).isin([a for a in rule["allowed_values"] if a is not None]))
    if rule.get("min") is not None:
        add("ERR_OUT_OF_RANGE", held & _is_number(kind) & (as_number < rule["min"]))
    if rule.get("max") is not None:
        add("ERR_OUT_OF_RANGE", held & _is_number(kind) & (as_number > rule["max"]))
    if rule.get("min_length") is not None:
        add("ERR_STRING_TOO_SHORT", held & (kind == "STRING") & (F.length(as_text) < rule["min_length"]))
    if rule.get("max_length") is not None:
        add("ERR_STRING_TOO_LONG", held & (kind == "STRING") & (F.length(as_text) > rule["max_length"]))
    if rule.get("regex_pattern"):
        whole = r"\A(?:" + rule["regex_pattern"] + r")\z"
        add("ERR_PATTERN_MISMATCH", held & (kind == "STRING") & ~as_text.rlike(whole))
    if check_format and rule.get("format"):
        add("ERR_FORMAT_MISMATCH", held & ~matches_format(as_text, rule["format"]))
    return checks


def with_constraint_errors(
    df: DataFrame, registry: Registry, kind: str, data: str, applies: Column, require: Column, check_format: bool,
) -> DataFrame:
    """Adds ``errors``: every broken constraint of ``data`` as ``array<struct<code,field>>``.

    Three projections per distinct field list: the field values, their JSON types, the verdict.
    The error array is only built for rows that break something.
    """
    groups = [(ids, fields) for ids, fields in registry.groups(kind, "fields") if fields]
    values, kinds, verdicts = {}, {}, []
    none = F.array().cast(ERRORS_TYPE)
    for g, (ids, fields) in enumerate(groups):
        here = applies & F.col("schema_id").isin(ids)
        values[f"_v{g}"] = F.when(here, F.struct(*[field(F.col(data), n).alias(f"f{i}") for i, n in enumerate(fields)]))
        kinds[f"_k{g}"] = F.when(
            F.col(f"_v{g}").isNotNull(),
            F.struct(*[F.schema_of_variant(F.col(f"_v{g}")[f"f{i}"]).alias(f"f{i}") for i in range(len(fields))]),
        )
        checks = [
            (code, name, broken)
            for i, (name, rule) in enumerate(fields.items())
            for code, broken in _field_checks(rule, F.col(f"_v{g}")[f"f{i}"], F.col(f"_k{g}")[f"f{i}"], require, check_format)
        ]
        any_broken = reduce(or_, [broken for _, _, broken in checks])
        listed = F.concat(
            *[
                F.when(broken, F.array(F.struct(F.lit(code).alias("code"), F.lit(name).alias("field")))).otherwise(none)
                for code, name, broken in checks
            ]
        )
        verdicts.append(F.when(F.col(f"_k{g}").isNotNull() & any_broken, listed))
    df = df.withColumns(values).withColumns(kinds) if groups else df
    return df.withColumn("errors", F.coalesce(*verdicts, none)).drop(*values, *kinds)


def _has_text(col: str) -> Column:
    return F.length(F.btrim(F.coalesce(F.col(col), F.lit("")), F.lit(" \t\r\n\f"))) > 0


def check_stream(
    df: DataFrame, schemas: DataFrame, check_format: bool = False, check_country: bool = False,
) -> DataFrame:
    """Stream events with ``error_code``, ``errors``, ``schema_id``, the normalised ``event_key`` and
    ``secondary_key``, and the parsed payload as ``event``, in which both stand normalised. One pass, no shuffle.

    Keys are normalised before the field checks, which see the normalised form. A key definition, or an option of
    it, that a schema leaves out has its default: ``msisdn``, normalised, not null, country code 84."""
    reg = Registry.of(schemas)
    parsed = df.withColumn("event", F.when(_has_text("payload"), F.try_parse_json("payload")))
    event = F.col("event")
    found = parsed.withColumn(
        "schema_id", reg.stream_schema(F.col("topic"), field(event, "topic", "string"), field(event, "source", "string"))
    )
    per_key = lambda value: reg.per_schema("STREAM", "key_definition", F.col("schema_id"), value)
    # A JSON null reads as the text "null", which is no phone number.
    raw = per_key(lambda k: field(event, k.get("field") or "msisdn"))
    keyed = found.select(
        "*",
        raw.alias("_raw"),
        per_key(lambda k: F.lit(k.get("field") or "msisdn")).alias("_key_name"),
        per_key(lambda k: F.lit(k.get("auto_normalize") is not False)).alias("_auto"),
        per_key(lambda k: F.lit(bool(k.get("allow_null")))).alias("_allow_null"),
        per_key(lambda k: F.lit(k.get("default_country_code") or "84")).alias("_cc"),
    )
    keyed = keyed.withColumn("_raw_key", F.when(F.col("_raw").isNotNull(), F.coalesce(text(F.col("_raw")), F.lit("null"))))
    keyed = keyed.withColumn("_norm_key", normalize_key(F.col("_raw_key"), F.col("_cc")))

    bad_key = F.col("_raw_key").isNotNull() & F.col("_norm_key").isNull() & ~F.col("_allow_null")
    if check_country:
        bad_key = bad_key | ~per_key(lambda k: in_countries(F.col("_norm_key"), k.get("allowed_country_codes")))
    early = (
        F.when(~_has_text("payload"), "ERR_STREAM_EMPTY_PAYLOAD")
        .when(event.isNull(), "ERR_STREAM_JSON_MALFORMED")
        .when(~is_object_text(F.col("payload")), "ERR_STREAM_PAYLOAD_NOT_OBJECT")
        .when(F.col("schema_id").isNull(), "ERR_STREAM_SCHEMA_NOT_FOUND")
        .when(F.col("_auto") & bad_key, "ERR_STREAM_INVALID_KEY_FORMAT")
    )
    judged = keyed.withColumns({"_early": early, "_second": field(event, SECONDARY_PHONE, "string")})
    judged = judged.withColumn("_norm_second", normalize_key(F.col("_second"), F.col("_cc")))
    # Each key's normalised form where it has one that differs from what the payload holds.
    new_key = F.when(F.col("_norm_key") != F.col("_raw_key"), F.col("_norm_key"))
    new_second = F.when(F.col("_norm_second") != F.col("_second"), F.col("_norm_second"))
    parts = F.try_variant_get(event, "$", "map<string,variant>")
    rewritten = F.to_variant_object(F.transform_values(parts, lambda k, v: F.when(
        (k == F.col("_key_name")) & new_key.isNotNull(), new_key.cast("variant")
    ).when((k == F.lit(SECONDARY_PHONE)) & new_second.isNotNull(), new_second.cast("variant")).otherwise(v)))
    changes = F.col("_auto") & F.col("_early").isNull() & (new_key.isNotNull() | new_second.isNotNull())
    judged = with_once(judged, event=F.when(changes, rewritten).otherwise(event))
    judged = with_constraint_errors(
        judged, reg, "STREAM", "event", F.col("_early").isNull(), F.lit(True), check_format
    )
    second, clean_second = F.col("_second"), F.coalesce("_norm_second", "_second")
    return with_once(
        judged,
        errors=F.col("errors"),
        error_code=F.coalesce("_early", F.when(F.size("errors") > 0, "ERR_STREAM_VALIDATION_FAILED")),
        event_key=F.when(F.col("_auto"), F.coalesce("_norm_key", "_raw_key")).otherwise(F.col("_raw_key")),
        secondary_key=F.when(F.col("_auto"), clean_second).otherwise(second),
    ).drop("_raw", "_key_name", "_auto", "_allow_null", "_cc", "_raw_key", "_norm_key", "_early", "_second", "_norm_second")


def _envelope(df: DataFrame) -> DataFrame:
    """Envelope fields as columns, beside the parsed payload."""
    body = F.col("body")
    parsed = df.withColumn("body", F.when(_has_text("payload"), F.try_parse_json("payload")))
    return parsed.select(
        "*",
        *[field(body, name, "string").alias(name) for name in ENVELOPE if name != "sync_mode"],
        F.coalesce(field(body, "schema_version", "string"), F.lit("v1")).alias("schema_version"),
        F.upper(field(body, "sync_mode", "string")).alias("sync_mode"),
        field(body, "key_field", "string").alias("key_field"),
        field(body, "data").alias("data"),
    )


def check_batch(
    df: DataFrame, schemas: DataFrame, as_of: Column, order: str = "seq", strict: bool = False,
    check_format: bool = False, check_country: bool = False, country_from_schema: bool = False,
    chunk_rows: int = CHUNK_ROWS, marks: DataFrame | None = None,
) -> DataFrame:
    """Batch envelopes with ``error_code``, ``failed_stage``, ``failed_fields``, ``errors`` and the
    envelope columns; five levels, the first failure decides.

    ``order`` is the arrival sequence. ``as_of`` stands in for a snapshot time that does not parse,
    unless ``strict`` rejects it. ``marks`` (``dataset_name``, ``mark``) are the latest snapshots already
    seen, for input that comes in pieces. Each payload is parsed once and kept; one shuffle of the data, by dataset and arrival chunk.
    """
    reg = Registry.of(schemas)
    env = _envelope(df).withColumn(
        "_missing", F.array_compact(F.array(*[F.when(F.col(n).isNull(), F.lit(n)) for n in ENVELOPE]))
    )
    looked_up = env.withColumn("schema_id", reg.batch_schema(F.col("dataset_name"), F.col("schema_version")))
    per_key = lambda value: reg.per_schema("BATCH", "key_definition", F.col("schema_id"), value)
    code = per_key(lambda k: F.lit(k.get("default_country_code") or "84")) if country_from_schema else "84"
    keyed = looked_up.withColumn("_norm", normalize_key(F.col("key_value"), code))
    mode_ok = reg.per_schema(
        "BATCH", "allowed_sync_modes", F.col("schema_id"),
        lambda modes: F.col("sync_mode").isin([m.upper() for m in modes]) if modes else F.lit(True),
    )
    bad_key = F.col("_norm").isNull()
    if check_country:
        bad_key = bad_key | ~per_key(lambda k: in_countries(F.col("_norm"), k.get("allowed_country_codes")))

    first_levels = (
        F.when(~_has_text("payload"), "ERR_BATCH_EMPTY_PAYLOAD")
        .when(F.col("body").isNull(), "ERR_BATCH_JSON_MALFORMED")
        .when(~is_object_text(F.col("payload")), "ERR_BATCH_PAYLOAD_NOT_OBJECT")
        .when(F.size("_missing") > 0, "ERR_BATCH_MISSING_ENVELOPE")
        .when(~F.col("sync_mode").isin(SYNC_MODES), "ERR_BATCH_INVALID_SYNC_MODE")
        .when(bad_key, "ERR_BATCH_INVALID_KEY_FORMAT")
        .when(F.col("schema_id").isNull(), "ERR_BATCH_SCHEMA_NOT_FOUND")
        .when(~mode_ok, "ERR_BATCH_SYNC_MODE_NOT_ALLOWED")
    )
    if strict:
        first_levels = first_levels.when(snapshot_millis(F.col("snapshot_time")).isNull(), "ERR_BATCH_INVALID_TIMESTAMP")
    staged = keyed.withColumn("_early", first_levels).withColumn("snapshot_ms", snapshot_millis(F.col("snapshot_time"), as_of))

    # Rows rejected as stale lie below the running mark, so the mark is a plain running maximum.
    gated = prior_max(
        kept(staged), ["dataset_name"], order, F.when(F.col("_early").isNull(), F.col("snapshot_ms")), "_mark", chunk_rows, initial=marks
    )
    has_data = F.coalesce(F.startswith(F.schema_of_variant("data"), F.lit("OBJECT")), F.lit(False))
    not_delete = F.col("sync_mode") != "DELETE"
    gate = F.coalesce(
        F.col("_early"),
        F.when(F.col("snapshot_ms") < F.col("_mark"), "ERR_BATCH_STALE_SNAPSHOT"),
        F.when(not_delete & ~has_data, "ERR_BATCH_MISSING_DATA"),
    )
    judged = gated.withColumn("_gate", gate)
    judged = with_constraint_errors(
        judged, reg, "BATCH", "data", F.col("_gate").isNull() & not_delete,
        F.col("sync_mode") == "FULL_SNAPSHOT", check_format,
    )
    code_of = F.coalesce("_gate", F.when(F.size("errors") > 0, "ERR_BATCH_FIELD_CONSTRAINTS_VIOLATED"))
    judged = with_once(judged, errors=F.col("errors"), error_code=code_of)

    code_of = F.col("error_code")
    failed = (
        F.when(code_of == "ERR_BATCH_MISSING_ENVELOPE", F.col("_missing"))
        .when(code_of.isin("ERR_BATCH_INVALID_SYNC_MODE", "ERR_BATCH_SYNC_MODE_NOT_ALLOWED"), F.array(F.lit("sync_mode")))
        .when(code_of == "ERR_BATCH_INVALID_KEY_FORMAT", F.array(F.lit("key_value")))
        .when(code_of.isin("ERR_BATCH_STALE_SNAPSHOT", "ERR_BATCH_INVALID_TIMESTAMP"), F.array(F.lit("snapshot_time")))
        .when(code_of == "ERR_BATCH_MISSING_DATA", F.array(F.lit("data")))
        .otherwise(F.transform("errors", lambda e: F.concat(e["code"], F.lit(": "), e["field"])))
    )
    stage = F.coalesce(*[F.when(code_of == c, F.lit(s)) for c, s in STAGES.items()])
    return judged.select(
        *[c for c in judged.columns if not c.startswith("_") and c != "key_value"],
        failed.alias("failed_fields"),
        stage.alias("failed_stage"),
        F.when(code_of.isNull(), F.col("_norm")).otherwise(F.col("key_value")).alias("key_value"),
    )


def snapshot_marks(checked: DataFrame) -> DataFrame:
    """Latest snapshot seen per dataset: of every row that reached the anti-stale level."""
    reached = (F.col("failed_stage") == "LEVEL_5_FIELD_CONSTRAINT") | F.col("error_code").isNull()
    return checked.where(reached).groupBy("dataset_name").agg(F.max("snapshot_ms").alias("mark"))


def valid(checked: DataFrame) -> DataFrame:
    return checked.where("error_code is null")


def rejected(checked: DataFrame) -> DataFrame:
    return checked.where("error_code is not null")


def with_defaults(events: DataFrame, schemas: DataFrame, data: str = "data") -> DataFrame:
    """Adds ``defaults``: declared default values of the fields an UPSERT left out, by field name."""
    reg = Registry.of(schemas)

    def filled(fields: dict) -> Column:
        found = [
            F.when(field(F.col(data), name).isNull(), F.struct(F.lit(name).alias("k"), F.lit(_plain(rule["default_value"])).alias("v")))
            for name, rule in fields.items()
            if rule.get("default_value") is not None
        ]
        if not found:
            return F.create_map().cast("map<string,string>")
        return F.map_from_entries(F.array_compact(F.array(*found)))

    per_schema = reg.per_schema("BATCH", "fields", F.col("schema_id"), filled)
    return events.withColumn("defaults", F.when(F.col("sync_mode") == "UPSERT", per_schema))


def _plain(value) -> str:
    return value if isinstance(value, str) else json.dumps(value)
