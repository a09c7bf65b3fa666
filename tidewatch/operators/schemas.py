"""The schema catalogue: a table of JSON documents that says how each topic and dataset must look.

The catalogue is configuration, tens of rows. It is read once, its size checked, and turned
into column expressions with constant paths and bounds, so a validation is a single scan of
the data without a join, inside generated code.
"""

from __future__ import annotations

import json
from collections import defaultdict
from dataclasses import dataclass

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

FIELD_TYPE = (
    "struct<type:string,required:boolean,nullable:boolean,allowed_values:array<string>,min:double,max:double,"
    "min_length:int,max_length:int,regex_pattern:string,format:string,default_value:variant>"
)
PAYLOAD_TYPE = (
    "schema_type string, dataset_name string, source string, topic string, version string, ttl_seconds bigint,"
    "allowed_sync_modes array<string>, key_definition struct<field:string,key_type:string,allow_null:boolean,"
    "auto_normalize:boolean,default_country_code:string,regex_pattern:string,allowed_country_codes:array<string>>,"
    f"fields map<string,{FIELD_TYPE}>"
)


def read_schemas(table: DataFrame, order: str | None = None) -> DataFrame:
    """Catalogue rows (``schema_id``, ``schema_payload`` text) as typed columns.

    Unreadable payloads are dropped. ``order`` names the registration order; the later
    of two registrations for one topic, source or dataset counts.
    """
    rank = F.col(order).cast("bigint") if order else F.lit(0).cast("bigint")
    doc = F.from_json("schema_payload", PAYLOAD_TYPE)
    return (
        table.where(F.try_parse_json("schema_payload").isNotNull())
        .select("schema_id", rank.alias("registered"), doc.alias("doc"))
        .where("doc.schema_type is not null")
        .select("schema_id", "registered", "doc.*")
        .withColumns({"schema_type": F.upper("schema_type"), "version": F.coalesce("version", F.lit("v1"))})
    )


def schema_fields(schemas: DataFrame) -> DataFrame:
    """One row per schema field, with the defaults of its constraints filled in."""
    fields = F.transform(
        F.map_entries("fields"), lambda e: F.struct(e["key"].alias("field"), e["value"].alias("rule"))
    )
    return schemas.select("schema_id", "schema_type", "dataset_name", "version", F.inline(fields)).select(
        "schema_id", "schema_type", "dataset_name", "version", "field",
        F.upper(F.coalesce("rule.type", F.lit("STRING"))).alias("type"),
        F.coalesce("rule.required", F.lit(False)).alias("required"),
        F.coalesce("rule.nullable", F.lit(True)).alias("nullable"),
        *[f"rule.{c}" for c in ("allowed_values", "min", "max", "min_length", "max_length", "regex_pattern", "format", "default_value")],
    )


def compiling_patterns(spark: SparkSession, patterns: set[str]) -> set[str]:
    """The regular expressions that compile; a broken one never rejects a row."""
    good = set()
    for pattern in patterns:
        try:
            spark.sql("select '' rlike :p", args={"p": pattern}).collect()
            good.add(pattern)
        except PySparkException:
            pass
    return good


def string_map(pairs: dict[str, str]) -> Column:
    """A constant map column."""
    if not pairs:
        return F.create_map().cast("map<string,string>")
    return F.create_map(*[F.lit(x) for pair in pairs.items() for x in pair])


@dataclass(frozen=True)
class Registry:
    """The catalogue on the driver, in registration order."""

    schemas: list[dict]

    @classmethod
    def of(cls, schemas: "DataFrame | Registry") -> "Registry":
        if isinstance(schemas, Registry):
            return schemas
        ordered = schemas.orderBy("registered", "schema_id")
        rows = ordered.select(F.to_json(F.struct(*schemas.columns))).collect()
        docs = [json.loads(r[0]) for r in rows]
        patterns = {f["regex_pattern"] for d in docs for f in d.get("fields", {}).values() if f.get("regex_pattern")}
        good = compiling_patterns(schemas.sparkSession, patterns)
        for doc in docs:
            for rule in doc.get("fields", {}).values():
                if rule.get("regex_pattern") not in good:
                    rule.pop("regex_pattern", None)
        by_id = {}
        for doc in docs:
            by_id.pop(doc["schema_id"], None)
            by_id[doc["schema_id"]] = doc
        return cls(list(by_id.values()))

    def names(self) -> Column:
        """Every name a schema answers to, as a constant map to schema ids; the last registration wins."""
        names = {}
        for s in self.schemas:
            names["id:" + s["schema_id"]] = s["schema_id"]
            if s["schema_type"] == "STREAM":
                tags = [("topic:", (s.get("topic") or "").upper()), ("source:", (s.get("source") or "").upper())]
            else:
                dataset = (s.get("dataset_name") or "").lower()
                tags = [("dataset:", dataset and f"{dataset}_{s['version']}".lower()), ("dataset:", dataset)]
            names.update({tag + name: s["schema_id"] for tag, name in tags if name})
        return string_map(names)

    def stream_schema(self, *candidates: Column) -> Column:
        """Schema id for the first candidate that names a topic, a source, ``stream_<x>_v1`` or an id."""
        names, tries = self.names(), []
        for c in candidates:
            folded = F.upper(F.trim(c))
            tries += [
                F.concat(F.lit("topic:"), folded),
                F.concat(F.lit("source:"), folded),
                F.concat(F.lit("id:stream_"), c, F.lit("_v1")),
                F.concat(F.lit("id:"), c),
            ]
        return F.coalesce(*[F.try_element_at(names, t) for t in tries])

    def batch_schema(self, dataset: Column, version: Column) -> Column:
        """Schema id by dataset and version, then by schema id, then by dataset alone."""
        v = F.when(F.length(version) > 0, version).otherwise("v1")
        key = F.lower(F.concat(dataset, F.lit("_"), v))
        tries = [
            F.concat(F.lit("dataset:"), key),
            F.concat(F.lit("id:batch_"), key),
            F.concat(F.lit("dataset:"), F.lower(dataset)),
        ]
        return F.coalesce(*[F.try_element_at(self.names(), t) for t in tries])

    def groups(self, kind: str, part: str) -> list[tuple[list[str], dict]]:
        """Schema ids that share the same definition of ``part`` (fields, key_definition, ...)."""
        shared = defaultdict(list)
        for s in self.schemas:
            if s["schema_type"] == kind:
                shared[json.dumps(s.get(part))].append(s["schema_id"])
        return [(ids, json.loads(text) or {}) for text, ids in shared.items()]

    def per_schema(self, kind: str, part: str, schema_id: Column, value) -> Column:
        """``value(definition)`` of the row's schema, null without one."""
        whens = [F.when(schema_id.isin(ids), value(definition)) for ids, definition in self.groups(kind, part)]
        return F.coalesce(*whens) if whens else F.lit(None)
