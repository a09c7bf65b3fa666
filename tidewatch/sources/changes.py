"""Change records of the catalogues, flattened by the connector."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

RULE_CHANGE = (
    "rule_id string, name string, rule_json string, cooldown_seconds bigint, version bigint, enabled boolean,"
    "__deleted string, __op string"
)


def rule_changes(records: DataFrame, order: str = "seq", text: str = "payload") -> DataFrame:
    """Rule changes with their defaults: no cooldown, version 0, not enabled, not deleted."""
    change = F.from_json(text, RULE_CHANGE)
    return records.select(order, change.alias("c")).select(
        order,
        "c.rule_id",
        "c.name",
        "c.rule_json",
        F.coalesce("c.cooldown_seconds", F.lit(0)).alias("cooldown_seconds"),
        F.coalesce("c.version", F.lit(0)).alias("version"),
        F.coalesce("c.enabled", F.lit(False)).alias("enabled"),
        F.coalesce("c.__deleted", F.lit("false")).alias("deleted"),
        F.col("c.__op").alias("op"),
    )


#: Whether a change takes its row away.
GONE = "lower(coalesce(__deleted, 'false')) = 'true' OR lower(coalesce(__op, '')) = 'd'"


def parsed_changes(records: DataFrame, columns: str, order: str = "seq", text: str = "payload") -> DataFrame:
    """Change records with ``columns`` (a schema) of the changed row and the connector's own two (see ``GONE``)."""
    change = F.from_json(text, f"{columns}, __deleted string, __op string")
    return records.select(order, change.alias("c")).select(order, "c.*")


def schema_changes(records: DataFrame, order: str = "seq", text: str = "payload") -> DataFrame:
    """The schema table after its change records: the last state of each id, deleted ones gone."""
    rows = parsed_changes(records, "schema_id string, schema_payload string", order, text).where("schema_id is not null")
    last = rows.groupBy("schema_id").agg(F.max_by(F.struct(*rows.columns), order).alias("_l")).select("_l.*")
    return last.where(~F.expr(GONE)).select(order, "schema_id", "schema_payload")
