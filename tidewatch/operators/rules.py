"""The rule catalogue: a change log folded to the live rules, and rules laid out as tables."""

from __future__ import annotations

import json
import re

from pyspark.sql import Column, DataFrame, functions as F

from tidewatch.functions.values import text
from tidewatch.operators.predicates import leaves, names_of
from tidewatch.operators.scans import CHUNK_ROWS, prior_max

CONDITION = (
    "struct<field:string,fields:array<string>,op:string,value:variant,dataset_id:string,dataset_version:string,"
    "function:string,expr:string,right_field:string,right_expr:string,negate:boolean>"
)
RULE_TYPE = (
    "rule_id string, rule_name string, rule_version string, trigger_criteria array<struct<source:string,"
    "schema_version:string,version:string,key_field:string,event_time_field:string,"
    f"conditions:array<array<{CONDITION}>>>>"
)
EXACT = ["==", "IN"]
ISO_TIME = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}"


def is_delete() -> Column:
    """A change that takes the rule out: deleted flag, delete operation, or not enabled."""
    return (
        (F.lower(F.coalesce("deleted", F.lit("false"))) == "true")
        | (F.lower(F.coalesce("op", F.lit(""))) == "d")
        | ~F.coalesce("enabled", F.lit(False))
    )


def live_rules(changes: DataFrame, order: str = "seq", chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """The live row of every rule after its changes, in arrival order, passed the version gate.

    The gate skips a change whose version is not above the live one; an accepted delete clears
    the live version. So a change is decisive exactly when no later change of the rule has a
    higher version, and the rule's live row is the first decisive change that is not a delete:
    every decisive one before it was a delete, and everything after it is skipped.
    """
    numbered = changes.withColumn("version", F.coalesce("version", F.lit(0)).cast("bigint"))
    scanned = prior_max(numbered, ["rule_id"], order, F.col("version"), "_later", chunk_rows, descending=True)
    decisive = scanned.where((F.col("_later").isNull() | (F.col("version") >= F.col("_later"))) & ~is_delete())
    first = F.min_by(F.struct(*changes.columns), F.col(order)).alias("_live")
    return decisive.groupBy("rule_id").agg(first).select("_live.*")


def upsert_rules(stored: DataFrame, incoming: DataFrame, order: str) -> DataFrame:
    """Rule table after an insert-or-overwrite on (rule_id, version); the highest ``order`` wins."""
    rows = stored.unionByName(incoming)
    return (
        rows.groupBy("rule_id", "version")
        .agg(F.max_by(F.struct(*rows.columns), F.col(order)).alias("_row"))
        .select("_row.*")
    )


def rule_conditions(rules: DataFrame) -> DataFrame:
    """One row per trigger condition of ``rules`` (``rule_id``, ``rule_json``).

    A trigger without conditions keeps one row with a null ``op``. ``values`` is the text form of
    the literal, one element unless it is a list. ``index_by`` is ``text`` or ``number`` where an equality of the
    field with one of the values, read as such, decides the condition, and null for every other condition.
    """
    doc = F.from_json("rule_json", RULE_TYPE)
    # Scalars leave the trigger before the next explode, so only what is needed travels on.
    head = ["rule_id", "trigger_no", "source", "schema_version", "key_field", "event_time_field"]
    triggers = rules.select("rule_id", F.posexplode_outer(doc["trigger_criteria"]).alias("trigger_no", "t")).select(
        "rule_id",
        "trigger_no",
        "t.source",
        F.coalesce("t.schema_version", "t.version", F.lit("v1")).alias("schema_version"),
        "t.key_field",
        "t.event_time_field",
        "t.conditions",
    )
    groups = triggers.select(*head, F.posexplode_outer("conditions").alias("group_no", "g"))
    conds = groups.select(*head, "group_no", F.posexplode_outer("g").alias("cond_no", "c"))
    value = F.col("c.value")
    listed = F.startswith(F.schema_of_variant(value), F.lit("ARRAY"))
    plain = F.lit(True)
    for part in ("function", "expr", "right_field", "right_expr"):
        plain = plain & F.col(f"c.{part}").isNull()
    single = F.coalesce(F.size("c.fields"), F.lit(0)) + F.when(F.col("c.field").isNull(), 0).otherwise(1) == 1
    plain = plain & single & ~F.coalesce(F.col("c.negate"), F.lit(False)) & F.upper("c.op").isin(EXACT)
    # The literal's JSON type, without a list's brackets; a list of several types reads as VARIANT.
    kind = F.regexp_replace(F.schema_of_variant(value), r"^ARRAY<(.*)>$", "$1")
    numeric = kind.rlike("^(BIGINT|DOUBLE|FLOAT|DECIMAL.*)$")
    index_by = F.when(plain & (kind == "STRING") & (listed | ~text(value).rlike(ISO_TIME)), "text").when(plain & numeric, "number")
    return conds.select(
        *head,
        "group_no",
        "cond_no",
        F.coalesce("c.fields", F.when(F.col("c.field").isNotNull(), F.array("c.field"))).alias("fields"),
        F.upper("c.op").alias("op"),
        F.when(listed, F.from_json(F.to_json(value), "array<string>"))
        .when(text(value).isNotNull(), F.array(text(value)))
        .alias("values"),
        F.col("c.dataset_id").alias("dataset_id"),
        F.col("c.dataset_version").alias("dataset_version"),
        index_by.alias("index_by"),
    )


def parse_rules(rules: DataFrame) -> list[dict]:
    """Live rules on the driver, as documents; the change row's id and cooldown are the rule's own.

    A rule catalogue is configuration, and every rule becomes part of the plan, which the driver holds as well.
    """
    cooldown = F.col("cooldown_seconds") if "cooldown_seconds" in rules.columns else F.lit(0)
    rows = rules.select("rule_id", "rule_json", cooldown.alias("cooldown")).collect()
    parsed = []
    for row in sorted(rows, key=lambda r: r["rule_id"]):
        doc = json.loads(row["rule_json"])
        if doc.get("rule_id") not in (None, row["rule_id"]):
            raise ValueError(f"rule {row['rule_id']} carries the document of {doc['rule_id']}")
        parsed.append({**doc, "rule_id": row["rule_id"], "cooldown_seconds": row["cooldown"] or 0})
    return parsed


def rule_classes(rules: DataFrame, datasets: list[str], triggers: bool = False) -> DataFrame:
    """CEP, STATEFUL or STATELESS per rule (``rule_id``, ``rule_json``), by its condition tree, with ``triggers``
    also by its trigger conditions, which is what decides where a rule can be evaluated.

    Read off their canonical JSON text, where keys and marks stand in one fixed form. A dotted field makes a rule
    stateful only when its first part names a dataset, be it a field of its own or inside an expression.
    """
    doc = F.try_parse_json("rule_json")
    part = lambda name: F.coalesce(F.to_json(F.try_variant_get(doc, f"$.{name}", "variant")), F.lit(""))
    shape = F.concat(part("trigger_criteria"), part("condition_tree")) if triggers else part("condition_tree")
    of_dataset = F.lit(False)
    if datasets:
        names = "|".join(re.escape(d) for d in datasets)
        of_dataset = shape.rlike(
            rf'"(field|right_field)":"({names})\.|"(fields|key_fields)":\[[^\]]*"({names})\.|"(expr|right_expr)":"([^"]*[^\w."])?({names})\.'
        )
    kind = (
        F.when(shape.contains('"type":"SEQUENCE"') | shape.rlike('(?i)"op":"IS_FIRST_ARRIVAL"'), "CEP")
        .when(shape.rlike('(?i)"op":"IN_DATASET"') | of_dataset, "STATEFUL")
        .otherwise("STATELESS")
    )
    return rules.select("rule_id", kind.alias("rule_class"))


def rule_class(rule: dict, datasets: set[str] = frozenset(), triggers: bool = False) -> str:
    """As :func:`rule_classes`, for a rule already on the driver."""
    expressions = leaves(rule if triggers else {"condition_tree": rule.get("condition_tree")})
    ops = {(e.get("op") or "").upper() for e in expressions}
    if _has_sequence(rule.get("condition_tree")) or "IS_FIRST_ARRIVAL" in ops:
        return "CEP"
    names = [n for e in expressions for n in names_of(e)]
    if "IN_DATASET" in ops or any("." in n and n.split(".")[0] in datasets for n in names):
        return "STATEFUL"
    return "STATELESS"


def _has_sequence(node: dict | None) -> bool:
    return bool(node) and (node.get("type") == "SEQUENCE" or any(_has_sequence(c) for c in node.get("children", [])))
