"""Matching events to rules.

Events carry ``seq``, ``source``, ``schema_version`` and ``event`` (VARIANT).
"""

from __future__ import annotations

import json
from collections import defaultdict

from pyspark.sql import Column, DataFrame, functions as F

from tidewatch.functions.keys import normalize_key
from tidewatch.functions.values import field, is_object_text, number
from tidewatch.operators.predicates import dnf, leaf, quoted, tree
from tidewatch.operators.scans import with_once
from tidewatch.operators.shared import Unit, match_units


def events_of(df: DataFrame, version: str = "v1") -> DataFrame:
    """Adds the columns matching needs to raw ``seq, source, payload`` rows; a payload that is no JSON object drops out."""
    objects = df.where(is_object_text(F.col("payload")))
    parsed = with_once(objects, event=F.try_parse_json("payload")).where("event is not null")
    if "schema_version" not in df.columns:
        parsed = parsed.withColumn("schema_version", F.lit(version))
    return parsed


# ---------------------------------------------------------------- candidates by index look-up


def candidate_ids(events: DataFrame, conditions: DataFrame, exact: bool = True, undecided: bool = True) -> DataFrame:
    """Adds ``candidates``: the ids of the rules worth evaluating for each event, as one array. Every rule that
    :func:`match_rules` would report is among them.

    ``exact``: rules of the event's source and version with an equality that an index decides (``index_by`` of
    :func:`~tidewatch.operators.rules.rule_conditions`) and that hits. ``undecided``: rules with any other condition
    or with none, which are candidates for every event of their source and version.

    The index is part of the plan: per source, version and field a constant map from value to rules. One pass
    over the events, no join, no shuffle, no pairs.
    """
    rows = conditions.select("rule_id", "source", "schema_version", "fields", "values", "index_by").collect()
    sources = defaultdict(set)
    for r in rows:
        sources[r["rule_id"]].add(r["source"])
    indexed, rest = defaultdict(lambda: defaultdict(set)), defaultdict(set)
    for r in rows:
        route = (r["source"], r["schema_version"])
        # A name that starts with a source is read from that source's events only.
        if r["index_by"] is None or r["fields"][0].split(".")[0] in sources[r["rule_id"]]:
            rest[route].add(r["rule_id"])
            continue
        for value in r["values"]:
            key = value if r["index_by"] == "text" else float(value)
            indexed[route][(r["fields"][0], r["index_by"])].add((key, r["rule_id"]))
    parts = []
    for route in sorted(indexed.keys() | rest.keys(), key=repr):
        here = []
        if undecided and rest[route]:
            here.append(F.expr(f"array({', '.join(map(quoted, sorted(rest[route])))})"))
        for (name, kind), entries in sorted(indexed[route].items()) if exact else ():
            by_value = defaultdict(list)
            for key, rule_id in sorted(entries):
                by_value[key].append(rule_id)
            value = field(F.col("event"), name, "string")
            if kind == "number":
                value = number(value)
            index = F.map_from_arrays(
                F.from_json(F.lit(json.dumps(list(by_value))), f"array<{'double' if kind == 'number' else 'string'}>"),
                F.from_json(F.lit(json.dumps(list(by_value.values()))), "array<array<string>>"),
            )
            here.append(F.coalesce(F.try_element_at(index, value), F.array().cast("array<string>")))
        if here:
            parts.append(F.when(F.expr(route_test(route)), F.array_distinct(F.concat(*here))))
    none = F.array().cast("array<string>")
    return events.withColumn("candidates", F.coalesce(*parts, none) if parts else none)


def candidates_exact(events: DataFrame, conditions: DataFrame) -> DataFrame:
    """(seq, rule_id) where an indexed ``field == value`` or ``IN`` condition of the rule's source hits."""
    return _pairs(candidate_ids(events, conditions, undecided=False))


def candidates_complex(events: DataFrame, conditions: DataFrame) -> DataFrame:
    """(seq, rule_id) for every rule of the event's source and version that an index cannot decide:
    one with a non-exact condition or with no condition at all."""
    return _pairs(candidate_ids(events, conditions, exact=False))


def candidates(events: DataFrame, conditions: DataFrame) -> DataFrame:
    """Both, as pairs. ``conditions`` come from live rules only, so nothing has to be masked afterwards."""
    return _pairs(candidate_ids(events, conditions))


def _pairs(events: DataFrame) -> DataFrame:
    return events.select("seq", F.explode("candidates").alias("rule_id"))


# ---------------------------------------------------------------- evaluation


class FieldColumns:
    """Names the payload fields a rule set reads, so each is extracted and parsed one time per event."""

    def __init__(self, rules: list[dict], profile: dict[str, str] | None = None):
        self.profile = profile or {}
        self.sources = {t["source"] for r in rules for t in r.get("trigger_criteria", [])}
        self.names: dict[tuple[str | None, str | None, str], str] = {}
        self.numbers: dict[str, str] = {}
        self.texts: dict[str, str] = {}

    def text(self, name: str) -> str:
        """Column with the text form of ``name``: a payload path, ``<source>[.<version>].<path>`` or
        ``<dataset>.<field>``."""
        return self.column_of(name)

    def number(self, name: str) -> str:
        """Column with the numeric reading of ``name``."""
        return self.numbers.setdefault(self.column_of(name), f"_n{len(self.numbers)}")

    def is_text(self, name: str) -> str:
        """Column that tells whether ``name`` holds a JSON text; a profile field is one."""
        of = self.column_of(name)
        return "true" if of in self.profile.values() else self.texts.setdefault(of, f"_s{len(self.texts)}")

    def column_of(self, name: str) -> str:
        if name in self.profile:
            return self.profile[name]
        head, _, rest = name.partition(".")
        source = version = None
        if rest and head in self.sources:
            source, path = head, rest
            part, _, tail = rest.partition(".")
            if tail and part[:1] == "v" and part[1:].isdigit():
                version, path = part, tail
        else:
            path = name
        return self.names.setdefault((source, version, path), f"_x{len(self.names)}")

    def extract(self, df: DataFrame) -> DataFrame:
        columns = {}
        for (_, _, path), out in self.names.items():
            if out in self.texts:
                columns[self.texts[out]] = F.coalesce(F.schema_of_variant(field(F.col("event"), path)) == "STRING", F.lit(False))
        for (source, version, path), out in self.names.items():
            value = field(F.col("event"), path, "string")
            guard = F.lit(True)
            if source:
                guard = guard & (F.col("source") == source)
            if version:
                guard = guard & (F.col("schema_version") == version)
            columns[out] = F.when(guard, value) if source else value
        df = df.withColumns(columns) if columns else df
        return self._with_numbers(df, set(columns))

    def extract_profile(self, df: DataFrame) -> DataFrame:
        """Numeric readings of profile fields, once the profile is joined."""
        return self._with_numbers(df, set(self.profile.values()))

    def _with_numbers(self, df: DataFrame, texts: set[str]) -> DataFrame:
        numbers = {out: number(F.col(of)) for of, out in self.numbers.items() if of in texts}
        return df.withColumns(numbers) if numbers else df


def trigger_groups(rule: dict) -> dict[tuple[str, str], list[list[dict]]]:
    """The rule's trigger conditions (OR of ANDs) by source and version; no condition means an empty group."""
    groups = defaultdict(list)
    for t in rule.get("trigger_criteria", []):
        route = (t["source"], t.get("schema_version") or t.get("version") or "v1")
        groups[route] += t.get("conditions") or [[]]
    return groups


def route_test(route: tuple[str, str]) -> str:
    source, version = route
    return f"(source = {quoted(source)} AND schema_version = {quoted(version)})"


def trigger_of(rule: dict, leaf_of) -> str:
    """Whether the event passes any trigger of the rule, as SQL."""
    tests = [f"({route_test(r)} AND {dnf(groups, leaf_of)})" for r, groups in trigger_groups(rule).items()]
    return f"coalesce({' OR '.join(tests)}, false)" if tests else "false"


def key_fields(rule: dict) -> tuple[tuple[str, str], ...]:
    """The trigger's key field for each source."""
    return tuple((t["source"], t["key_field"]) for t in rule.get("trigger_criteria", []) if t.get("key_field"))


def key_value(by_source: tuple[tuple[str, str], ...], fields: FieldColumns) -> Column:
    whens = []
    for source, name in by_source:
        raw = F.col(fields.text(name))
        whens.append(F.when(F.col("source") == source, F.coalesce(normalize_key(raw), raw)))
    return F.coalesce(*whens) if whens else F.lit(None).cast("string")


def partition_key(rule: dict, fields: FieldColumns) -> Column:
    """The value of the trigger's key field for the event's source, normalised when it is a phone."""
    return key_value(key_fields(rule), fields)


def required(node: dict | None) -> tuple[list[dict], list[dict]]:
    """A condition tree as a conjunction: the leaves it demands, and the nodes it demands beside them."""
    if not node:
        return [], []
    kind = node["type"].upper()
    if kind == "CONDITION":
        return [node["expression"]], []
    children = node.get("children", [])
    if kind == "AND" or kind == "OR" and len(children) == 1:
        parts = [required(child) for child in children]
        return [e for leaves, _ in parts for e in leaves], [n for _, nodes in parts for n in nodes]
    return [], [node]


def units_of(rule: dict, body: dict | None, fields: FieldColumns, name: str) -> list[Unit]:
    """One unit per group of the rule's trigger, each with the tree ``body``."""
    leaves, nodes = required(body)
    tests = [tree(node, lambda e: leaf(e, fields)) for node in nodes]
    return [
        Unit(name, route, [*group, *leaves], tests)
        for route, groups in trigger_groups(rule).items()
        for group in (groups if all(groups) else [[]])
    ]


def match_rules(events: DataFrame, rules: list[dict], trigger_only: bool = False) -> DataFrame:
    """(event columns, rule_id) for each stateless rule an event satisfies: source and version route,
    trigger, condition tree. One pass over the events, no join and no shuffle.

    The rules of a source share their conditions: see :mod:`~tidewatch.operators.shared`.
    """
    fields = FieldColumns(rules)
    units = [u for r in rules for u in units_of(r, None if trigger_only else r.get("condition_tree"), fields, r["rule_id"])]
    return match_units(events, units, fields, "rule_id").select(*events.columns, "rule_id")
