"""Queries over event order: first arrival, cooldown, followed-by, not-followed-by."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewatch.functions.values import epoch_micros
from tidewatch.operators import sequence
from tidewatch.operators.match import match_rules
from tidewatch.plans import fixtures as fx
from tidewatch.plans.matching import TREE_RULES, AMOUNT, text_sql
from tidewatch.plans.registry import ctes, events_sql, query, stream_events

HOUR = sequence.HOUR
SIX_HOURS = 6 * HOUR
CLICK_TIME = "c0 AS (SELECT *, epoch_us(ts) AS t FROM fx_clicks)"


def clicks(spark, sf_dir):
    return fx.view(spark, sf_dir, fx.CLICKS).withColumn("t", epoch_micros(F.col("ts")))


@query("first_arrival", ctes("fx_clicks") + "SELECT event_id, session_id FROM (SELECT *, row_number() OVER (PARTITION BY session_id, object_name ORDER BY ts, event_id) AS rn FROM fx_clicks) x WHERE rn = 1")
def first_arrival(spark, sf_dir):
    return sequence.first_arrival(clicks(spark, sf_dir), ["session_id", "object_name"], F.struct("t", "event_id")).select("event_id", "session_id")


def greedy_sql(rows: str, keys: list[str], ttl: int, columns: str, views: tuple = (), tie: str = "event_id") -> str:
    """Accepted rows of ``rows`` (needs t and the tie column) walked one accepted row at a time."""
    part = ", ".join(keys)
    same = " AND ".join(f"r.{k} = a.{k}" for k in keys)
    return ctes(*views, recursive=True, r=rows, a=f"""
  SELECT * FROM (SELECT r.*, row_number() OVER (PARTITION BY {part} ORDER BY t, {tie}) AS rn FROM r) x WHERE rn = 1
  UNION ALL
  SELECT * FROM (SELECT r.*, row_number() OVER (PARTITION BY {', '.join('r.' + k for k in keys)} ORDER BY r.t, r.{tie}) AS rn
    FROM a JOIN r ON {same} AND r.t >= a.t + {ttl}) y WHERE rn = 1""") + f"SELECT {columns} FROM a"


@query("first_arrival_ttl", greedy_sql("SELECT *, epoch_us(ts) AS t FROM fx_clicks", ["session_id"], SIX_HOURS, "event_id, session_id", ("fx_clicks",)))
def first_arrival_ttl(spark, sf_dir):
    kept = sequence.first_arrival_ttl(clicks(spark, sf_dir), ["session_id"], "t", "event_id", SIX_HOURS)
    return kept.select("event_id", "session_id")


@query("cooldown", greedy_sql(
    f"SELECT seq, t, {text_sql('device_session_id')} AS k, 'big_purchase' AS rule_id FROM (SELECT seq, epoch_us(ts) AS t, source, payload AS j FROM fx_stream WHERE json_valid(payload) AND json_type(payload) = 'OBJECT') e "
    f"WHERE source = 'CPM' AND {AMOUNT} >= 40.13 AND {text_sql('status')} = 'SUCCESS'",
    ["k"], 86_400_000_000, "seq, rule_id", ("fx_stream",), "seq"))
def cooldown(spark, sf_dir):
    hits = match_rules(stream_events(spark, sf_dir), [TREE_RULES[0]])
    keyed = hits.select("seq", "t", "rule_id", F.try_variant_get("event", "$.device_session_id", "string").alias("partition_key"))
    return sequence.cooldown(keyed, {"big_purchase": 86_400}, "t", "seq").select("seq", "rule_id")


_ANSWER = f"SELECT 1 FROM c b WHERE b.object_name = 'RESULT' AND b.session_id = a.session_id AND b.t BETWEEN a.t + 1 AND a.t + {SIX_HOURS}"
_CLICKS = ctes("fx_clicks", c="SELECT *, epoch_us(ts) AS t FROM fx_clicks")


def click_sides(spark, sf_dir):
    c = clicks(spark, sf_dir)
    return c.where("object_name = 'CONTINUE'"), c.where("object_name = 'RESULT'")


@query("followed_by", _CLICKS + f"SELECT event_id, session_id, (SELECT min(b.t) FROM c b WHERE b.object_name = 'RESULT' AND b.session_id = a.session_id AND b.t BETWEEN a.t + 1 AND a.t + {SIX_HOURS}) AS second_us FROM c a WHERE object_name = 'CONTINUE' AND EXISTS ({_ANSWER})")
def followed_by(spark, sf_dir):
    first, second = click_sides(spark, sf_dir)
    found = sequence.followed_by(first, second, ["session_id"], "t", 0, SIX_HOURS)
    return found.select("event_id", "session_id", F.col("second_time").alias("second_us"))


@query("not_followed_by", _CLICKS + f"SELECT event_id, session_id FROM c a WHERE object_name = 'CONTINUE' AND NOT EXISTS ({_ANSWER})")
def not_followed_by(spark, sf_dir):
    first, second = click_sides(spark, sf_dir)
    return sequence.not_followed_by(first, second, ["session_id"], "t", 0, SIX_HOURS).select("event_id", "session_id")


@query("not_followed_by_min", _CLICKS + f"SELECT event_id FROM c a WHERE object_name = 'CONTINUE' AND NOT EXISTS (SELECT 1 FROM c b WHERE b.object_name = 'RESULT' AND b.session_id = a.session_id AND b.t BETWEEN a.t + {HOUR} AND a.t + {3 * HOUR})")
def not_followed_by_min(spark, sf_dir):
    first, second = click_sides(spark, sf_dir)
    return sequence.not_followed_by(first, second, ["session_id"], "t", HOUR, 3 * HOUR).select("event_id")
