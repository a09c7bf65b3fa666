"""Queries run on Structured Streaming, each to the end of its input, with the rows its sink holds."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidewatch.functions.values import epoch_micros
from tidewatch.plans import catalogue as listed, fixtures as fx
from tidewatch.operators.match import FieldColumns, events_of, match_rules, partition_key
from tidewatch.operators.profile import PROFILE_TTL_MS
from tidewatch.plans.matching import AMOUNT, MATCH_SQL, TREE_RULES, cond, rule, text_sql
from tidewatch.plans.one_pass import MIXED_LISTS, _VIEWS, answered, mixed_catalogue
from tidewatch.plans.profiles import EVENT_KEYS, FOLD, SAME_VALUE, same_value
from tidewatch.plans.registry import ctes, events_sql, phone_sql, query, spread
from tidewatch.plans.sequences import SIX_HOURS, greedy_sql
from tidewatch.plans.validation import STREAM_CHECK, as_of, batch_registry, batch_sql, stream_registry, valid_batch
from tidewatch.operators.rules import live_rules, parse_rules
from tidewatch.plans.registry import ORACLES
from tidewatch.sources.changes import GONE, parsed_changes
from tidewatch.streaming import ordered, pipeline
from tidewatch.streaming.catalogue import Catalogue, keep, latest
from tidewatch.streaming.rules import rule_stream
from tidewatch.streaming.folders import new_folder


def stream_table(spark, sf_dir: str, name: str) -> DataFrame:
    """A given table as a stream. The pattern matches the one name, be it a file or a folder."""
    path = f"{sf_dir}/{name}.parquet"
    return spark.readStream.schema(spark.read.parquet(path).schema).parquet(f"{path[:-1]}[{path[-1]}]")


def view_of(table: str, sql: str):
    """The fixture view over a micro-batch of ``table``."""

    def prepare(batch: DataFrame) -> DataFrame:
        batch.createOrReplaceTempView(f"tidewatch_{table}")
        return batch.sparkSession.sql(sql.replace(f"FROM {table}", f"FROM tidewatch_{table}"))

    return prepare


def finish(running) -> None:
    """Waits until the input is used up; an error of the query is raised here."""
    running.awaitTermination()


@query("stream_validate_live", ctes("fx_stream", **STREAM_CHECK) + "SELECT seq, source, event_key FROM v WHERE error_code IS NULL")
def stream_validate_live(spark, sf_dir):
    folder = new_folder(spark, "validate")
    registry = stream_registry(spark)
    finish(pipeline.stream_validation(stream_table(spark, sf_dir, "events"), lambda _: registry, folder, view_of("events", fx.STREAM)))
    return spark.read.parquet(f"{folder}/valid").select("seq", "source", "event_key")


@query("stream_match_live", MATCH_SQL)
def stream_match_live(spark, sf_dir):
    import json

    rows = [(i, r["rule_id"], json.dumps(r), 1, True, "false", "c") for i, r in enumerate(TREE_RULES)]
    log = lambda s: s.createDataFrame(rows, "seq bigint, rule_id string, rule_json string, version bigint, enabled boolean, deleted string, op string")
    folder = new_folder(spark, "match")
    finish(pipeline.rule_matching(stream_table(spark, sf_dir, "events"), log, folder, view_of("events", fx.STREAM)))
    return spark.read.parquet(f"{folder}/hits").select("seq", "rule_id")


@query("stream_first_arrival_live", "SELECT event_id, user_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS rn FROM events) x WHERE rn = 1")
def stream_first_arrival_live(spark, sf_dir):
    events = stream_table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", epoch_micros(F.col("ts")).alias("t"))
    folder = new_folder(spark, "first")
    first = pipeline.first_arrivals(events, ["user_id", "event_type"], ["t", "event_id"])
    running = first.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/checkpoint")
    finish(running.trigger(availableNow=True).start())
    return spark.read.parquet(f"{folder}/out").select("event_id", "user_id", "event_type")


@query("stream_dropoff_live", f"""WITH c AS (SELECT event_id, user_id, event_type, epoch_us(ts) AS t FROM events)
SELECT event_id, user_id FROM c a WHERE event_type = 'view' AND (t + {SIX_HOURS}) // 1000 + 1 <= (SELECT max(t) // 1000 FROM c) - 60000
AND NOT EXISTS (SELECT 1 FROM c b WHERE b.event_type = 'purchase' AND b.user_id = a.user_id AND b.t BETWEEN a.t AND a.t + {SIX_HOURS})""")
def stream_dropoff_live(spark, sf_dir):
    events = stream_table(spark, sf_dir, "events").withColumn("t", epoch_micros(F.col("ts"))).withColumn("ts", F.timestamp_micros("t"))
    folder = new_folder(spark, "dropoff")
    alerts = pipeline.absences(events, "user_id", "t", "event_id", F.col("event_type") == "view", F.col("event_type") == "purchase", 0, SIX_HOURS)
    running = alerts.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/checkpoint")
    finish(running.trigger(availableNow=True).start())
    return spark.read.parquet(f"{folder}/out").select("event_id", "user_id")


@query("stream_profile_live", batch_sql(f"SELECT key_value, dataset_name, field, {SAME_VALUE} FROM p", **FOLD))
def stream_profile_live(spark, sf_dir):
    folder = new_folder(spark, "profile")
    registry = batch_registry(spark)
    finish(pipeline.batch_validation(stream_table(spark, sf_dir, "customer"), lambda _: registry, folder, as_of(), view_of("customer", fx.BATCH)))
    return pipeline.live_profile(spark, folder).select("key_value", "dataset_name", "field", same_value())


# ------------------------------------------------ state in event-time order

#: Rows whose slot the last watermark has passed, one minute behind the newest row.
_PASSED = "(t // 1000000 + 1) * 1000 <= (SELECT max(epoch_us(ts)) // 1000 - 60000 FROM events)"


def to_table(spark, rows: DataFrame, name: str) -> DataFrame:
    """Runs a query to the end of its input; the rows of its sink."""
    folder = new_folder(spark, name)
    running = rows.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/checkpoint")
    finish(running.trigger(availableNow=True).start())
    return spark.read.schema(rows.schema).parquet(f"{folder}/out")


def clicks(spark, sf_dir: str) -> DataFrame:
    events = stream_table(spark, sf_dir, "events").select("event_id", F.col("user_id").alias("session_id"), "event_type", epoch_micros(F.col("ts")).alias("t"))
    return ordered.with_clock(events, "t")


@query("stream_first_arrival_ttl_live", f"""SELECT event_id, session_id FROM ({greedy_sql("SELECT *, epoch_us(ts) AS t FROM fx_clicks", ["session_id"], SIX_HOURS, "event_id, session_id, t", ("fx_clicks",))}) a WHERE {_PASSED}""")
def stream_first_arrival_ttl_live(spark, sf_dir):
    found = to_table(spark, ordered.periods(clicks(spark, sf_dir), ["session_id"], "event_id", SIX_HOURS), "periods")
    return found.where("NOT late").select("event_id", "session_id")


CALM = [
    rule("calm_day", "CPM", [[cond("amount", ">", 30)]], cooldown_seconds=86_400),
    rule("calm_hours", "CPM", [[cond("status", "==", "SUCCESS")]], cooldown_seconds=7_200),
]


def _calm_sql(rule_id: str, test: str, seconds: int) -> str:
    key = f"coalesce({phone_sql(text_sql('msisdn'))}, {text_sql('msisdn')})"
    rows = f"SELECT seq, epoch_us(ts) AS t, {key} AS k, j FROM (SELECT *, payload AS j FROM fx_stream WHERE source = 'CPM' AND json_valid(payload) AND json_type(payload) = 'OBJECT') x WHERE {test}"
    walked = greedy_sql(f"SELECT * FROM ({rows}) y WHERE k IS NOT NULL", ["k"], seconds * 1_000_000, f"seq, t, '{rule_id}' AS rule_id", ("fx_stream",), "seq")
    return f"SELECT seq, rule_id FROM ({walked}) z WHERE (t // 1000000 + 1) * 1000 <= (SELECT max(epoch_us(ts)) // 1000 - 60000 FROM parsed)"


@query("stream_cooldown_live", ctes("fx_stream", parsed="SELECT * FROM fx_stream WHERE json_valid(payload) AND json_type(payload) = 'OBJECT'")
    + _calm_sql("calm_day", f"{AMOUNT} > 30", 86_400) + " UNION ALL " + _calm_sql("calm_hours", f"{text_sql('status')} = 'SUCCESS'", 7_200))
def stream_cooldown_live(spark, sf_dir):
    """Hits of two rules after their own silences, all in one stateful operator."""
    raw = stream_view(spark, sf_dir, "events", fx.STREAM)
    events = ordered.with_clock(events_of(raw).withColumn("t", epoch_micros(F.col("ts"))), "t")
    fields = FieldColumns(CALM)
    key = partition_key(CALM[0], fields)
    hits = fields.extract(match_rules(events, CALM)).withColumn("partition_key", key)
    silence = F.create_map(*[F.lit(x) for r in CALM for x in (r["rule_id"], r["cooldown_seconds"] * 1_000_000)])[F.col("rule_id")]
    kept = ordered.periods(hits.withColumn("silence", silence), ["rule_id", "partition_key"], "seq", "silence")
    return to_table(spark, kept, "cooldown").where("NOT late").select("seq", "rule_id")


def stream_view(spark, sf_dir: str, name: str, sql: str) -> DataFrame:
    """A fixture view over a given table as a stream."""
    stream_table(spark, sf_dir, name).createOrReplaceTempView(f"tidewatch_stream_{name}")
    return spark.sql(sql.replace(f"FROM {name}", f"FROM tidewatch_stream_{name}"))


_ANSWER_TIME = f"(SELECT min(b.t) FROM c b WHERE b.event_type = 'purchase' AND b.user_id = a0.user_id AND b.t BETWEEN a0.t + 1 AND a0.t + {SIX_HOURS})"
_LIVE_CLICKS = "WITH c AS (SELECT event_id, user_id, event_type, epoch_us(ts) AS t FROM events), a AS (SELECT *, " + _ANSWER_TIME + " AS second_us FROM c a0 WHERE event_type = 'view')\n"


def _live_sequence(spark, sf_dir, followed: bool) -> DataFrame:
    rows = ordered.sequences(clicks(spark, sf_dir), ["session_id"], "event_id", F.col("event_type") == "view", F.col("event_type") == "purchase", 0, SIX_HOURS, followed)
    return to_table(spark, rows, "sequence").where("NOT late")


@query("stream_followed_by_live", _LIVE_CLICKS + f"SELECT event_id, user_id AS session_id, second_us FROM (SELECT *, second_us AS t FROM (SELECT event_id, user_id, second_us FROM a) y) x WHERE second_us IS NOT NULL AND {_PASSED}")
def stream_followed_by_live(spark, sf_dir):
    return _live_sequence(spark, sf_dir, True).select("event_id", "session_id", F.col("second_time").alias("second_us"))


@query("stream_not_followed_by_live", _LIVE_CLICKS + f"SELECT event_id, session_id FROM (SELECT event_id, user_id AS session_id, t + {SIX_HOURS} AS t FROM a WHERE second_us IS NULL) x WHERE {_PASSED}")
def stream_not_followed_by_live(spark, sf_dir):
    return _live_sequence(spark, sf_dir, False).select("event_id", "session_id")


_AS_OF = """(SELECT max(struct_pack(m := o.snapshot_ms, n := o.seq, a := {what})) FROM ok o
  WHERE o.key_value = e.key_value AND o.snapshot_ms * 1000 <= e.t AND {test})"""
_WRITE = _AS_OF.format(what="json_extract_string(o.j, '$.data.sub_code')", test="o.dataset_name = 'active_promo' AND o.sync_mode <> 'DELETE' AND json_extract_string(o.j, '$.data.sub_code') IS NOT NULL")
_RESET = _AS_OF.format(what="'x'", test="o.dataset_name = 'active_promo' AND o.sync_mode <> 'UPSERT'")
_LAST = _AS_OF.format(what="'x'", test="true")


@query("stream_profile_lookup_live", batch_sql(f"""SELECT event_id, l.n AS last_write,
    CASE WHEN (r IS NULL OR w.m > r.m OR (w.m = r.m AND w.n >= r.n)) AND t - w.m * 1000 < {PROFILE_TTL_MS * 1000} THEN w.a END AS sub_code
  FROM (SELECT e.*, {_WRITE} AS w, {_RESET} AS r, {_LAST} AS l FROM (SELECT *, epoch_us(ts) AS t FROM ev) e) x WHERE {_PASSED}""", ev=EVENT_KEYS))
def stream_profile_lookup_live(spark, sf_dir):
    """Profile writes and events as two streams in one keyed operator."""
    events = stream_view(spark, sf_dir, "events", EVENT_KEYS).select("key_value", epoch_micros(F.col("ts")).alias("t"), "event_id")
    valid = valid_batch(spark, sf_dir).select("seq", "key_value", "snapshot_ms", "sync_mode", "dataset_name", "data")
    folder = new_folder(spark, "writes")
    valid.select(
        "key_value", (F.col("snapshot_ms") * 1000).alias("t"), F.col("seq").alias("event_id"), F.col("sync_mode").alias("mode"),
        F.col("dataset_name").alias("dataset"), F.from_json(F.to_json("data"), "map<string,string>").alias("fields"),
    ).write.parquet(f"{folder}/in")
    writes = spark.readStream.schema("key_value string, t bigint, event_id bigint, mode string, dataset string, fields map<string,string>").parquet(f"{folder}/in")
    found = to_table(spark, ordered.profile_lookup(events, writes, "key_value", "event_id", ["active_promo.sub_code"], PROFILE_TTL_MS), "lookup")
    return found.where("NOT late").select("event_id", "last_write", F.col("found")["active_promo.sub_code"].alias("sub_code"))


# ------------------------------------------------ a catalogue of every kind of rule on one stream


def _live_catalogue_sql() -> str:
    passed = "(t // 1000000 + 1) * 1000 <= (SELECT max(epoch_us(ts)) // 1000 - 60000 FROM parsed)"
    status, session = text_sql("status"), text_sql("device_session_id")
    parts = []
    for k in range(4):
        parts.append(events_sql(f"SELECT seq, 'plain{k}' AS rule_id FROM e WHERE source = 'CPM' AND {AMOUNT} > {20 + 10 * k} AND {status} = 'SUCCESS'"))
        of, listed = (session, "sessions") if k % 2 else (text_sql("data.request.billCode"), "bills")
        parts.append(events_sql(f"SELECT seq, 'list{k}' AS rule_id FROM e WHERE source = 'CDCN' AND {AMOUNT} > {k} AND {of} IS NOT NULL AND ({of} IN (SELECT v1 FROM l WHERE dataset_id = '{listed}')) = {'false' if k > 1 else 'true'}", l=MIXED_LISTS))
        rows = f"SELECT seq, epoch_us(ts) AS t, {session} AS k, j FROM (SELECT *, payload AS j FROM fx_stream WHERE source = 'TDH' AND json_valid(payload) AND json_type(payload) = 'OBJECT') x WHERE {AMOUNT} > {5 * k} AND {status} = 'SUCCESS'"
        walked = greedy_sql(f"SELECT * FROM ({rows}) y WHERE k IS NOT NULL", ["k"], (k + 1) * 86_400_000_000, "seq, t", ("fx_stream",), "seq")
        parts.append(f"SELECT seq, 'first{k}' AS rule_id FROM ({walked}) z WHERE {passed}")
        second = answered(30 * (k + 1), "b.amount > 5").replace("EXISTS (SELECT 1", "(SELECT min(b.t)")
        asked = f"SELECT seq, t AS t0, {second} AS answer FROM v a WHERE kind = 'view' AND sid IS NOT NULL AND amount > {10 * k}"
        due = "t0 + " + str(30 * (k + 1) * 60_000_000)
        parts.append(events_sql(f"SELECT seq, 'seq{k}' AS rule_id FROM (SELECT seq, {'answer' if k % 2 else due} AS t, answer FROM q) z WHERE answer IS {'NOT ' if k % 2 else ''}NULL AND {passed}", v=_VIEWS, q=asked, parsed="SELECT * FROM e"))
    return ctes("fx_stream", parsed="SELECT * FROM fx_stream WHERE json_valid(payload) AND json_type(payload) = 'OBJECT'") + " UNION ALL ".join(
        f"SELECT seq, rule_id FROM ({p}) x{i}" for i, p in enumerate(parts))


@query("stream_catalogue_live", _live_catalogue_sql())
def stream_catalogue_live(spark, sf_dir):
    """Stateless rules, memberships, first arrivals and sequences, each kind in one operator for all its rules."""
    rules = [r for r in mixed_catalogue() if not r["rule_id"].startswith("calm")]
    lists = fx.view(spark, sf_dir, MIXED_LISTS).select("dataset_id", "dataset_version", F.array("v1").alias("tuple"))
    events = events_of(spread(stream_view(spark, sf_dir, "events", fx.STREAM), "seq")).withColumn("t", epoch_micros(F.col("ts")))
    folder = new_folder(spark, "catalogue")
    finish(rule_stream(events, rules, folder, "t", "seq", lists))
    return spark.read.parquet(f"{folder}/hits").select("seq", "rule_id")


# ------------------------------------------------ catalogues kept by change streams


def in_turns(spark, changes: DataFrame, name: str, fold, turns: int = 4) -> Catalogue:
    """The catalogue after its change stream came in turns, each a query of its own from the same checkpoint."""
    folder = new_folder(spark, name)
    newest = changes.agg(F.max("seq")).first()[0] or 0
    for turn in range(turns):
        part = changes.where(F.floor((F.col("seq") - 1) * turns / (newest + 1)).between(turn if turn else -1, turn))
        part.write.mode("append").parquet(f"{folder}/changes")
        finish(keep(spark.readStream.schema(changes.schema).parquet(f"{folder}/changes"), fold, f"{folder}/catalogue"))
    return Catalogue(spark, f"{folder}/catalogue", changes.where("false"))


@query("stream_rule_catalogue_live", ORACLES["rule_log_current"])
def stream_rule_catalogue_live(spark, sf_dir):
    return in_turns(spark, fx.view(spark, sf_dir, listed.CHANGES), "rules", live_rules)().select("rule_id", "version", "seq")


@query("stream_schema_catalogue_live", ORACLES["schema_changes_current"])
def stream_schema_catalogue_live(spark, sf_dir):
    changes = parsed_changes(fx.view(spark, sf_dir, listed.SCHEMA_CHANGES), "schema_id string, schema_payload string")
    return in_turns(spark, changes, "schemas", latest(["schema_id"], "seq", GONE))().select("seq", "schema_id", "schema_payload")


@query("stream_match_catalogue_live", MATCH_SQL)
def stream_match_catalogue_live(spark, sf_dir):
    import json

    # The first version of each rule hits nothing; the catalogue that the events meet holds the second.
    never = {"conditions": [[cond("amount", "<", 0), cond("amount", ">", 0)]]}
    blocked = [{**r, "trigger_criteria": [{**t, **never} for t in r["trigger_criteria"]]} for r in TREE_RULES]
    rows = [(1 + i, r["rule_id"], json.dumps(r), 1 + i // len(TREE_RULES), True, "false", "c") for i, r in enumerate([*blocked, *TREE_RULES])]
    changes = spark.createDataFrame(rows, "seq bigint, rule_id string, rule_json string, version bigint, enabled boolean, deleted string, op string")
    kept = in_turns(spark, changes, "rules", live_rules, 2)
    rules = Catalogue(spark, kept.folder, changes.where("false"), parse_rules)
    folder = new_folder(spark, "match")
    finish(pipeline.rule_matching(stream_table(spark, sf_dir, "events"), rules, folder, view_of("events", fx.STREAM)))
    return spark.read.parquet(f"{folder}/hits").select("seq", "rule_id")
