import json

from pyspark.sql import functions as F

from tidewatch.operators import report, validate
from tidewatch.operators.schemas import Registry, read_schemas, schema_fields
from tidewatch.sources.documents import schema_table

KEY = {"field": "msisdn", "auto_normalize": True, "allow_null": False, "default_country_code": "84"}
TRANSFER = {
    "schema_id": "stream_PAY_v1", "schema_type": "STREAM", "source": "PAY", "topic": "pay-topic", "key_definition": KEY,
    "fields": {"transAmount": {"type": "LONG", "required": True, "nullable": False, "min": 0}, "custMobileNo": {"type": "STRING"}},
}
TRIAL = {
    "schema_id": "batch_trial_v1", "schema_type": "BATCH", "dataset_name": "trial", "version": "v1",
    "allowed_sync_modes": ["FULL_SNAPSHOT", "UPSERT"],
    "fields": {"sub_code": {"type": "STRING", "required": True, "nullable": False, "allowed_values": ["VTM1", "VTM2"]}},
}


def schemas(spark, *docs):
    return read_schemas(schema_table(spark, list(docs)), "seq")


def stream(spark, rows, *docs, **options):
    df = spark.createDataFrame([(i, t, p if isinstance(p, (str, type(None))) else json.dumps(p)) for i, (t, p) in enumerate(rows)], "seq int, topic string, payload string")
    return {r.seq: r for r in validate.check_stream(df, schemas(spark, *docs), **options).collect()}


def test_stream_levels(spark):
    got = stream(spark, [
        ("pay-topic", {"msisdn": "0981234567", "transAmount": 5, "custMobileNo": "098 123 4567"}),
        ("pay-topic", {"msisdn": "0981234567"}),
        ("pay-topic", "  "), ("pay-topic", None), ("pay-topic", "{bad"), ("pay-topic", "[1]"), ("other", {"a": 1}),
        ("pay-topic", {"msisdn": "junk", "transAmount": 5}),
        ("pay-topic", {"msisdn": None, "transAmount": 5}),
        ("pay-topic", {"transAmount": 5}),
        ("other", {"source": "pay", "transAmount": -1}),
        ("other", {"topic": "PAY-TOPIC", "transAmount": 1}),
        ("stream_PAY_v1", {"transAmount": "12"}), ("PAY ", {"transAmount": "1x"}),
    ], TRANSFER)
    codes = {i: r.error_code for i, r in got.items()}
    assert codes == {
        0: None, 1: "ERR_STREAM_VALIDATION_FAILED", 2: "ERR_STREAM_EMPTY_PAYLOAD", 3: "ERR_STREAM_EMPTY_PAYLOAD",
        4: "ERR_STREAM_JSON_MALFORMED", 5: "ERR_STREAM_PAYLOAD_NOT_OBJECT", 6: "ERR_STREAM_SCHEMA_NOT_FOUND",
        7: "ERR_STREAM_INVALID_KEY_FORMAT", 8: "ERR_STREAM_INVALID_KEY_FORMAT", 9: None,
        10: "ERR_STREAM_VALIDATION_FAILED", 11: None, 12: None, 13: "ERR_STREAM_VALIDATION_FAILED",
    }
    assert (got[0].event_key, got[0].secondary_key) == ("+84981234567", "+84981234567")
    assert [tuple(e) for e in got[1].errors] == [("ERR_MISSING_REQUIRED_FIELD", "transAmount")]
    assert [e.code for e in got[10].errors] == ["ERR_OUT_OF_RANGE"]
    assert [e.code for e in got[13].errors] == ["ERR_TYPE_MISMATCH"]


def test_checks_and_the_emitted_event_see_normalised_keys(spark):
    doc = {**TRANSFER, "fields": {**TRANSFER["fields"], "msisdn": {"type": "STRING", "regex_pattern": r"\+84\d{9}", "max_length": 12}}}
    del doc["key_definition"]
    got = stream(spark, [
        ("pay-topic", {"msisdn": "0377000111", "transAmount": 5, "custMobileNo": "0912222333", "more": {"a": [1]}}),
        ("pay-topic", {"msisdn": "BAD", "transAmount": 5}), ("pay-topic", {"msisdn": 377000111, "transAmount": 5}),
        ("pay-topic", {"custMobileNo": "what", "transAmount": 5}), ("pay-topic", {"msisdn": "+4915112345", "transAmount": 5}),
    ], doc)
    assert [got[i].error_code for i in range(5)] == [None, "ERR_STREAM_INVALID_KEY_FORMAT", None, None, "ERR_STREAM_VALIDATION_FAILED"]
    assert json.loads(got[0].event.toJson()) == {"msisdn": "+84377000111", "transAmount": 5, "custMobileNo": "+84912222333", "more": {"a": [1]}}
    assert json.loads(got[2].event.toJson())["msisdn"] == "+84377000111"
    assert json.loads(got[3].event.toJson()) == {"custMobileNo": "what", "transAmount": 5}


def test_allow_null_key_and_no_normalising(spark):
    lenient = {**TRANSFER, "key_definition": {**KEY, "allow_null": True}}
    plain = {**TRANSFER, "key_definition": {**KEY, "auto_normalize": False}}
    row = [("pay-topic", {"msisdn": "junk", "transAmount": 5})]
    assert stream(spark, row, lenient)[0].error_code is None
    assert stream(spark, row, plain)[0].event_key == "junk"


TYPE_CASES = [  # type, value, errors
    ("INT", 1, []), ("INT", 1.5, []), ("INT", 2147483648, ["ERR_TYPE_MISMATCH"]), ("INT", "12", []), ("INT", " 12 ", ["ERR_TYPE_MISMATCH"]),
    ("INT", "2147483648", ["ERR_TYPE_MISMATCH"]), ("INT", True, ["ERR_TYPE_MISMATCH"]), ("LONG", 2147483648, []), ("LONG", "x", ["ERR_TYPE_MISMATCH"]),
    ("DOUBLE", 1, []), ("DOUBLE", " 1.5 ", []), ("DOUBLE", "abc", ["ERR_TYPE_MISMATCH"]), ("FLOAT", [1], ["ERR_TYPE_MISMATCH"]),
    ("BOOLEAN", True, []), ("BOOLEAN", "FALSE", []), ("BOOLEAN", 1, ["ERR_TYPE_MISMATCH"]), ("OBJECT", {}, []), ("OBJECT", [], ["ERR_TYPE_MISMATCH"]),
    ("ARRAY", [], []), ("ARRAY", "[]", ["ERR_TYPE_MISMATCH"]), ("STRING", 5, []), ("STRING", {}, ["ERR_TYPE_MISMATCH"]), ("TIMESTAMP", "later", []),
    ("TIMESTAMP", [], ["ERR_TYPE_MISMATCH"]), ("SOMETHING", {}, []), ("STRING", None, []),
]


def test_types(spark):
    docs, rows = [], []
    for i, (kind, value, _) in enumerate(TYPE_CASES):
        docs.append({"schema_id": f"s{i}", "schema_type": "STREAM", "topic": f"t{i}", "fields": {"f": {"type": kind}}})
        rows.append((f"t{i}", {"f": value}))
    got = stream(spark, rows, *docs)
    assert {i: [e.code for e in r.errors] for i, r in got.items()} == {i: c[2] for i, c in enumerate(TYPE_CASES)}


def test_constraints(spark):
    doc = {"schema_id": "s", "schema_type": "STREAM", "topic": "t", "fields": {
        "n": {"type": "INT", "min": 1, "max": 5, "nullable": False}, "s": {"type": "STRING", "min_length": 2, "max_length": 3, "regex_pattern": "[a-z]+"},
        "e": {"type": "INT", "allowed_values": [0, 1]}, "broken": {"type": "STRING", "regex_pattern": "("}, "a.b": {"type": "STRING", "required": True},
        "u": {"type": "STRING", "format": "UUID"},
    }}
    rows = [
        ("t", {"n": 3, "s": "ab", "e": 1, "broken": "x", "a": {"b": "1"}}),
        ("t", {"n": 9, "s": "abcd", "e": 2, "a.b": "flat"}),
        ("t", {"n": "99", "s": "a1", "a": {}, "u": "no"}),
        ("t", {"n": None, "s": "a", "a.b": 1}),
    ]
    got = stream(spark, rows, doc, check_format=True)
    errors = {i: [(e.code, e.field) for e in r.errors] for i, r in got.items()}
    assert errors == {
        0: [],
        1: [("ERR_OUT_OF_RANGE", "n"), ("ERR_STRING_TOO_LONG", "s"), ("ERR_ENUM_VIOLATION", "e")],
        2: [("ERR_PATTERN_MISMATCH", "s"), ("ERR_MISSING_REQUIRED_FIELD", "a.b"), ("ERR_FORMAT_MISMATCH", "u")],
        3: [("ERR_NULL_NOT_ALLOWED", "n"), ("ERR_STRING_TOO_SHORT", "s")],
    }


def envelope(**changes):
    base = {"dataset_name": "trial", "pipeline_id": "p", "batch_id": "b", "snapshot_time": "2024-01-01T03:00:00+00:00",
            "sync_mode": "FULL_SNAPSHOT", "key_value": "0981234567", "data": {"sub_code": "VTM1"}}
    return {k: v for k, v in {**base, **changes}.items() if v != "absent"}


def batch(spark, payloads, *docs, **options):
    rows = [(i, "batch_trial", p if isinstance(p, str) else json.dumps(p)) for i, p in enumerate(payloads)]
    df = spark.createDataFrame(rows, "seq bigint, topic string, payload string")
    return validate.check_batch(df, schemas(spark, *(docs or [TRIAL])), F.lit("2024-06-01").cast("timestamp"), **options)


def test_batch_levels(spark):
    payloads = [
        envelope(), envelope(data={"sub_code": "BAD"}), envelope(snapshot_time="2024-01-01T01:00:00+00:00"),
        " ", "{", "[]", envelope(pipeline_id="absent", batch_id=None), envelope(sync_mode="weird"), envelope(key_value="junk"),
        envelope(dataset_name="nope"), envelope(sync_mode="delete"), envelope(data="absent"), envelope(data={}), envelope(sync_mode="upsert", data={}),
        envelope(schema_version="v9"), envelope(snapshot_time="not a time"), envelope(),
    ]
    rows = {r.seq: r for r in batch(spark, payloads, chunk_rows=4).collect()}
    assert {i: r.error_code for i, r in rows.items()} == {
        0: None, 1: "ERR_BATCH_FIELD_CONSTRAINTS_VIOLATED", 2: "ERR_BATCH_STALE_SNAPSHOT", 3: "ERR_BATCH_EMPTY_PAYLOAD", 4: "ERR_BATCH_JSON_MALFORMED",
        5: "ERR_BATCH_PAYLOAD_NOT_OBJECT", 6: "ERR_BATCH_MISSING_ENVELOPE", 7: "ERR_BATCH_INVALID_SYNC_MODE", 8: "ERR_BATCH_INVALID_KEY_FORMAT",
        9: "ERR_BATCH_SCHEMA_NOT_FOUND", 10: "ERR_BATCH_SYNC_MODE_NOT_ALLOWED", 11: "ERR_BATCH_MISSING_DATA", 12: "ERR_BATCH_FIELD_CONSTRAINTS_VIOLATED",
        13: None, 14: None, 15: None, 16: "ERR_BATCH_STALE_SNAPSHOT",
    }
    assert rows[0].key_value == "+84981234567"
    assert rows[6].failed_fields == ["pipeline_id", "batch_id"]
    assert rows[2].failed_stage == "LEVEL_4_ANTI_STALE"


def test_batch_strict_time_and_marks(spark):
    strict = batch(spark, [envelope(snapshot_time="not a time")], strict=True).first()
    assert strict.error_code == "ERR_BATCH_INVALID_TIMESTAMP"
    marks = spark.sql("select 'trial' dataset_name, unix_millis(timestamp '2024-01-02 00:00:00') mark")
    assert batch(spark, [envelope()], marks=marks).first().error_code == "ERR_BATCH_STALE_SNAPSHOT"


def test_version_falls_back_to_last_registration(spark):
    second = {**TRIAL, "schema_id": "batch_trial_v2", "version": "v2", "fields": {"sub_code": {"type": "STRING", "allowed_values": ["NEW"]}}}
    codes = [r.error_code for r in batch(spark, [envelope(schema_version="v1"), envelope(schema_version="v7")], TRIAL, second).orderBy("seq").collect()]
    assert codes == [None, "ERR_BATCH_FIELD_CONSTRAINTS_VIOLATED"]


def test_dead_letter_text(spark):
    bad = validate.rejected(batch(spark, ["{", envelope(key_value="junk")]))
    letters = [json.loads(r.value) for r in report.dead_letters(bad, F.lit("2024-01-01").cast("timestamp")).collect()]
    by_code = {x["error_code"]: x for x in letters}
    assert by_code["ERR_BATCH_JSON_MALFORMED"]["raw_payload"] == "{"
    assert by_code["ERR_BATCH_INVALID_KEY_FORMAT"]["raw_payload"]["key_value"] == "junk"
    assert by_code["ERR_BATCH_INVALID_KEY_FORMAT"]["source_topic"] == "batch_trial"


def test_registry_skips_bad_documents_and_explodes_fields(spark):
    table = schema_table(spark, [TRANSFER]).unionByName(spark.sql("select 9L seq, 'bad' schema_id, '{oops' schema_payload"))
    read = read_schemas(table, "seq")
    assert [s["schema_id"] for s in Registry.of(read).schemas] == ["stream_PAY_v1"]
    assert {r.field: r.required for r in schema_fields(read).collect()} == {"transAmount": True, "custMobileNo": False}


def test_verdicts_are_computed_once_above_the_generator(spark):
    df = spark.range(10).selectExpr("id seq", "'pay-topic' topic", "'{}' payload")
    plan = validate.valid(validate.check_stream(df, schemas(spark, TRANSFER)))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    assert plan.index("Filter") < plan.index("Generate")
