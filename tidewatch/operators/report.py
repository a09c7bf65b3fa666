"""Operating metrics, source unions, dead letters and output layouts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def union_sources(*sources: DataFrame) -> DataFrame:
    """All rows of several sources; a column one of them lacks is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), sources)


def metrics(checked: DataFrame, time: str, interval: str = "1 hour") -> DataFrame:
    """Events, valid events and rejects by error code, per interval."""
    return (
        checked.groupBy(F.window(time, interval)["start"].alias("window_start"), F.coalesce("error_code", F.lit("OK")).alias("outcome"))
        .agg(F.count("*").alias("events"))
    )


def hit_rate(events: DataFrame, hits: DataFrame, time: str, interval: str = "1 hour") -> DataFrame:
    """Events and triggered events per interval; ``hits`` has one row per (seq, rule)."""
    start = F.window(time, interval)["start"].alias("window_start")
    total = events.groupBy(start).agg(F.count("*").alias("events"))
    hit = hits.groupBy(start).agg(F.countDistinct("seq").alias("triggered"))
    return total.join(hit, "window_start", "left").withColumn("triggered", F.coalesce("triggered", F.lit(0)))


def dead_letters(rejected: DataFrame, validated_at: Column | None = None) -> DataFrame:
    """Rejected rows as dead-letter records: one JSON text per row in ``value``, keyed by topic.

    A payload that parses is embedded as JSON, any other as text.
    """
    as_json = "body" if "body" in rejected.columns else "event"
    stamp = F.current_timestamp() if validated_at is None else validated_at
    reason = F.col("error_code")
    head = [
        F.col("error_code"),
        F.concat_ws(": ", reason, F.concat_ws(", ", "failed_fields")).alias("error_reason"),
        "failed_fields",
        "failed_stage",
        F.date_format(stamp, "yyyy-MM-dd'T'HH:mm:ss.SSSXXX").alias("validated_at"),
        F.coalesce("topic", F.lit("UNKNOWN")).alias("source_topic"),
    ]
    parsed = F.to_json(F.struct(*head, F.col(as_json).alias("raw_payload")))
    unparsed = F.to_json(F.struct(*head, F.col("payload").alias("raw_payload")), {"ignoreNullFields": "false"})
    return rejected.select(F.coalesce("topic", F.lit("UNKNOWN")).alias("key"), F.when(F.col(as_json).isNotNull(), parsed).otherwise(unparsed).alias("value"))


def stream_dead_letters(checked: DataFrame, validated_at: Column | None = None) -> DataFrame:
    """Dead letters of the stream side, where the stage is the one check that rejects."""
    shaped = checked.withColumns(
        {
            "failed_fields": F.transform("errors", lambda e: F.concat(e["code"], F.lit(": "), e["field"])),
            "failed_stage": F.lit("STREAM_VALIDATION"),
        }
    )
    return dead_letters(shaped.where("error_code is not null"), validated_at)


def map_output(hits: DataFrame, layouts: dict[str, dict[str, str]], default: dict[str, str]) -> DataFrame:
    """Hits in the layout of their rule: output field -> Spark SQL expression over the hit, as JSON in ``value``."""

    def record(layout: dict[str, str]) -> Column:
        return F.to_json(F.struct(*[F.expr(source).alias(name) for name, source in layout.items()]))

    whens = [F.when(F.col("rule_id") == rule, record(layout)) for rule, layout in layouts.items()]
    return hits.withColumn("value", F.coalesce(*whens, record(default)))


def map_output_by_table(hits: DataFrame, layouts: DataFrame, columns: list[str], payload: str = "payload") -> DataFrame:
    """Hits in the layout that a table gives their rule: ``output`` maps targets to values, ``value`` is that as JSON.

    ``layouts``: ``rule_id`` (``*`` for rules without rows of their own), ``target``, ``source``. A source is
    ``event.<path>`` (a field of the payload, null when missing), ``hit.<column>`` (one of ``columns``), or ``=`` and a
    constant. Targets without a value are left out. A changed table needs no new plan: the layouts of a rule travel as
    one row, joined by rule, and are read per hit.
    """
    entry = F.struct("target", "source")
    per_rule = layouts.groupBy("rule_id").agg(F.sort_array(F.collect_list(entry)).alias("_layout"))
    other = per_rule.where("rule_id = '*'").select(F.col("rule_id").alias("_any"), F.col("_layout").alias("_default"))
    held = F.create_map(*[x for c in columns for x in (F.lit(c), F.col(c).cast("string"))])

    def value(source: Column) -> Column:
        name = F.regexp_replace(source, r"^(event|hit)\.|^=", "")
        return (
            F.when(source.startswith("event."), F.call_function("get_json_object", F.col(payload), F.concat(F.lit("$."), name)))
            .when(source.startswith("hit."), F.try_element_at(held, name))
            .when(source.startswith("="), name)
        )

    joined = hits.join(per_rule, "rule_id", "left").withColumn("_any", F.lit("*")).join(other, "_any", "left")
    entries = F.transform(F.coalesce("_layout", "_default"), lambda e: F.struct(e["target"].alias("key"), value(e["source"]).alias("value")))
    output = F.map_from_entries(F.filter(entries, lambda e: e["value"].isNotNull()))
    mapped = joined.withColumn("output", output).withColumn("value", F.to_json("output"))
    return mapped.select(*hits.columns, "output", "value")
