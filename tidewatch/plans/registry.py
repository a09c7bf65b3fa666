"""Registered queries: a Spark form and, where one can be written, an equivalent SQL text."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidewatch.operators.match import events_of
from tidewatch.functions.values import epoch_micros
from tidewatch.plans import fixtures as fx

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn

    return register


def ctes(*views: str, recursive: bool = False, **more: str) -> str:
    """``WITH`` clause over fixture views and further named texts."""
    texts = {"fx_stream": fx.STREAM, "fx_batch": fx.BATCH, "fx_clicks": fx.CLICKS, "fx_datasets": fx.DATASETS}
    parts = [f"{v} AS ({texts[v]})" for v in views] + [f"{n} AS ({t})" for n, t in more.items()]
    return ("WITH RECURSIVE " if recursive else "WITH ") + ",\n".join(parts) + "\n"


def phone_sql(raw: str) -> str:
    """E.164 form of a text expression, in SQL."""
    c = f"regexp_replace({raw}, '[\\s\\-.()]', '', 'g')"
    n = (
        f"CASE WHEN {c} LIKE '+%' THEN {c} WHEN {c} LIKE '00%' THEN '+' || substr({c}, 3) "
        f"WHEN {c} LIKE '0%' THEN '+84' || substr({c}, 2) WHEN {c} LIKE '84%' THEN '+' || {c} "
        f"WHEN length({c}) BETWEEN 7 AND 10 THEN '+84' || {c} ELSE '+' || {c} END"
    )
    return f"CASE WHEN regexp_full_match({n}, '\\+[1-9][0-9]{{6,14}}') THEN {n} END"


# Parsed stream events for SQL forms: j is the payload where it is a JSON object.
SQL_EVENTS = "SELECT seq, ts, epoch_us(ts) AS t, user_id, topic, source, payload, CASE WHEN json_valid(payload) AND json_type(payload) = 'OBJECT' THEN payload END AS j FROM fx_stream"


def events_sql(body: str, *views: str, **more: str) -> str:
    return ctes("fx_stream", *views, e=f"SELECT * FROM ({SQL_EVENTS}) x WHERE j IS NOT NULL", **more) + body


def spread(rows: DataFrame, by: str) -> DataFrame:
    """Rows dealt over as many tasks as a shuffle has. A file of few row groups is scanned by few tasks, which would
    also parse and match all its rows."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), by)


def stream_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parsed events with ``seq``, ``source``, ``schema_version``, ``event`` and time ``t`` in microseconds."""
    return events_of(fx.view(spark, sf_dir, fx.STREAM)).withColumn("t", epoch_micros(F.col("ts")))


def dataset_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The membership sets as ``dataset_id, dataset_version, tuple``."""
    rows = fx.view(spark, sf_dir, fx.DATASETS)
    return rows.select(
        "dataset_id", "dataset_version", F.when(F.col("v2").isNull(), F.array("v1")).otherwise(F.array("v1", "v2")).alias("tuple")
    )
