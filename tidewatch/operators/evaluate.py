"""Whole rules over events: trigger, condition tree, datasets, profile, first arrival, sequence, cooldown.

All rules of a catalogue share one plan, whose joins and shuffles do not grow with their number. The payload decides
first: one pass over the events leaves (event, rule) rows that can still become hits, with what each rule asks for as
data: values to look up, keys and durations of sequences and first arrivals, and its condition as *terms*, sets of
answers that together make a hit. One join then answers every dataset and profile look-up, one as-of scan every
sequence, one ordered pass every first arrival, and one more every cooldown.
"""

from __future__ import annotations

import json
from functools import reduce
from itertools import product

from pyspark.sql import Column, DataFrame, functions as F

from tidewatch.functions.values import duration_micros
from tidewatch.operators import sequence
from tidewatch.operators.match import FieldColumns, key_fields, key_value, match_units, required, route_test, trigger_groups
from tidewatch.operators.predicates import leaf, leaves, names_of, quoted, tree
from tidewatch.operators.scans import asof, ensure_checkpoint_dir, kept, with_once
from tidewatch.operators.shared import Unit

#: A first arrival without a time-to-live is blocked for this long (microseconds, some 3,000 years).
FOREVER = 10**17
MOST_SLOTS = 60
TRUE = {"type": "AND", "children": []}

Term = tuple[tuple[str, ...], int]


def _op(expression: dict) -> str:
    return (expression.get("op") or "").upper()


class RuleTerms:
    """One rule as terms: SQL tests of the payload, and a set of *slots*, answers that come later. A slot is a dataset
    membership, a condition on profile fields, a sequence or a first arrival."""

    def __init__(self, rule: dict, fields: FieldColumns, profile_datasets: set[str]):
        self.rule, self.fields = rule, fields
        self.members: dict[int, dict] = {}
        self.profiles: dict[int, dict] = {}
        self.sequences: dict[int, dict] = {}
        self.arrivals: dict[int, dict] = {}
        self.datasets = profile_datasets
        self.slots: dict[str, int] = {}
        body = self.terms(rule.get("condition_tree"))
        triggers = self.trigger_terms()
        self.main = self.both(triggers, body)
        self.seconds = {s: self.both(triggers, self.side(n["second"])) for s, n in self.sequences.items()}
        for _, mask in self.main:
            if sum(bool(mask >> s & 1) for s in self.arrivals) > 1:
                raise ValueError(f"rule {rule['rule_id']}: two first arrivals would have to wait for each other")

    def asks_profile(self, expression: dict) -> list[str]:
        return [n for n in names_of(expression) if "." in n and n.split(".")[0] in self.datasets]

    def slot(self, node: dict, of: dict[int, dict]) -> list[Term]:
        number = self.slots.setdefault(json.dumps(node, sort_keys=True), len(self.slots))
        if number >= MOST_SLOTS:
            raise ValueError(f"rule {self.rule['rule_id']} has over {MOST_SLOTS} conditions that need state")
        of[number] = node
        return [((), 1 << number)]

    def condition(self, expression: dict) -> list[Term]:
        op = _op(expression)
        if op == "IN_DATASET":
            return self.slot(expression, self.members)
        if op == "IS_FIRST_ARRIVAL":
            return self.slot(expression, self.arrivals)
        if self.asks_profile(expression):
            return self.slot(expression, self.profiles)
        return [((leaf(expression, self.fields),), 0)]

    def later(self, node: dict | None) -> bool:
        """Whether a tree has a slot."""
        if not node:
            return False
        if node["type"].upper() == "SEQUENCE":
            return True
        expression = node.get("expression")
        if expression:
            return _op(expression) in ("IN_DATASET", "IS_FIRST_ARRIVAL") or bool(self.asks_profile(expression))
        return any(map(self.later, node.get("children", [])))

    @staticmethod
    def both(*sides: list[Term]) -> list[Term]:
        out: dict[Term, None] = {}
        for parts in product(*sides):
            tests = dict.fromkeys(t for p in parts for t in p[0] if t != "true")
            out[(tuple(tests), reduce(int.__or__, (p[1] for p in parts), 0))] = None
        return list(out)

    def terms(self, node: dict | None) -> list[Term]:
        if not self.later(node):
            return [((tree(node, lambda e: leaf(e, self.fields)),), 0)]
        kind = node["type"].upper()
        if kind == "SEQUENCE":
            return self.both(self.side(node["first"]), self.slot(node, self.sequences))
        if kind == "CONDITION":
            return self.condition(node["expression"])
        parts = [self.terms(child) for child in node["children"]]
        return self.both(*parts) if kind == "AND" else [t for part in parts for t in part]

    def side(self, side: dict) -> list[Term]:
        return self.both([((f"source = {quoted(side['source'])}",), 0)], *[self.condition(e) for e in side.get("filter", [])])

    def trigger_terms(self) -> list[Term]:
        out = []
        for route, groups in trigger_groups(self.rule).items():
            for group in groups if all(groups) else [[]]:
                out += self.both([((route_test(route),), 0)], *[self.condition(e) for e in group])
        return out

    # ------------------------------------------------ what the first pass needs

    def possible(self, node: dict | None, source: str) -> dict | None:
        """The tree with every slot taken for true, for events of one source; None if that can't be true."""
        if not node:
            return TRUE
        kind = node["type"].upper()
        if kind == "CONDITION":
            return node if not self.later(node) else TRUE
        if kind == "SEQUENCE":
            return self.possible_side(node["first"], source)
        parts = [self.possible(child, source) for child in node.get("children", [])]
        if kind == "AND":
            return None if None in parts else {"type": "AND", "children": parts}
        known = [p for p in parts if p is not None]
        if any(p is TRUE or p == TRUE for p in known):
            return TRUE
        return {"type": "OR", "children": known} if known or not parts else None

    def possible_side(self, side: dict, source: str) -> dict | None:
        if side["source"] != source:
            return None
        conditions = [{"type": "CONDITION", "expression": e} for e in side.get("filter", [])]
        return {"type": "AND", "children": [c for c in conditions if not self.later(c)]}

    def units(self) -> list[Unit]:
        out = []
        for route, groups in trigger_groups(self.rule).items():
            bodies = [self.possible(self.rule.get("condition_tree"), route[0])]
            bodies += [self.possible_side(n["second"], route[0]) for n in self.sequences.values()]
            for body in bodies:
                if body is not None:
                    demanded, nodes = required(body)
                    tests = [tree(n, lambda e: leaf(e, self.fields)) for n in nodes]
                    for group in groups if all(groups) else [[]]:
                        known = [e for e in group if not self.later({"type": "CONDITION", "expression": e})]
                        out.append(Unit(self.rule["rule_id"], route, [*known, *demanded], tests))
        return out

    # ------------------------------------------------ what a row of the rule carries

    def values(self, expression: dict) -> list[str]:
        return [self.fields.text(n) for n in expression.get("fields") or [expression["field"]]]

    def details(self, profile_numbers: dict[str, int]) -> str:
        """The row's terms, look-ups and ordered questions, as SQL."""
        asks, known = [], ["0L"]
        for s, e in self.members.items():
            values = self.values(e)
            whole = " AND ".join(f"{v} IS NOT NULL" for v in values)
            scope = quoted(dataset_scope(e["dataset_id"], e.get("dataset_version")))
            asks.append(f"CASE WHEN {whole} THEN named_struct('no', {len(profile_numbers) + s}, 'scope', {scope}, 'key', array({', '.join(values)})) END")
            if e.get("negate"):
                known.append(f"CASE WHEN {whole} THEN {1 << s}L ELSE 0L END")
        for name in dict.fromkeys(n for e in self.profiles.values() for n in self.asks_profile(e)):
            asks.append(
                f"CASE WHEN partition_key IS NOT NULL THEN named_struct('no', {profile_numbers[name]}, 'scope', {quoted(profile_scope(name))}, 'key', array(partition_key)) END"
            )
        firsts, seconds, arrivals = [], [], []
        for s, n in self.sequences.items():
            least, most = (duration_micros(n.get(k, 0), n["time_unit"]) for k in ("min_time", "max_time"))
            # An answer comes later than its event, or an event both sides accept would answer itself.
            lasts = f"'least', {max(least, 1)}L, 'most', {most}L"
            firsts.append(self.question(s, [k["left_field"] for k in n["join_keys"]], lasts))
            asked = self.question(s, [k["right_field"] for k in n["join_keys"]], f"{lasts}, 'mask', _mask")
            for tests, mask in self.seconds[s]:
                seconds.append(f"CASE WHEN {' AND '.join(tests) or 'true'} THEN {asked.replace('_mask', f'{mask}L')} END")
        for s, e in self.arrivals.items():
            ttl = duration_micros(e["ttl"]) if e.get("ttl") else FOREVER
            arrivals.append(self.question(s, [f"x.{k}" for k in e["key_fields"]], f"'ttl', {ttl}L"))

        def some(items: list[str]) -> str:
            return f"array_compact(array({', '.join(items)}))" if items else "array()"

        terms = [f"CASE WHEN {' AND '.join(tests) or 'true'} THEN {mask}L END" for tests, mask in self.main]
        return (
            f"named_struct('terms', cast({some(terms)} AS array<bigint>), 'known', {' | '.join(known)}, 'asks', cast({some(asks)} AS {ASKS}), "
            f"'firsts', cast({some(firsts)} AS {FIRSTS}), 'seconds', cast({some(seconds)} AS {SECONDS}), 'arrivals', cast({some(arrivals)} AS {ARRIVALS}))"
        )

    def question(self, slot: int, names: list[str], more: str) -> str:
        """A slot with its key; null when a part of the key is missing. Names begin with the side they are of."""
        columns = [self.fields.text(n.split(".", 1)[1]) for n in names]
        whole = " AND ".join(f"{c} IS NOT NULL" for c in columns)
        return f"CASE WHEN {whole} THEN named_struct('slot', {slot}, 'key', array({', '.join(columns)}), {more}) END"

    def profile_bits(self) -> str:
        return " | ".join(f"CASE WHEN {leaf(e, self.fields)} THEN {1 << s}L ELSE 0L END" for s, e in self.profiles.items())


ASKS = "array<struct<no:int,scope:string,key:array<string>>>"
FIRSTS = "array<struct<slot:int,key:array<string>,least:bigint,most:bigint>>"
SECONDS = "array<struct<slot:int,key:array<string>,least:bigint,most:bigint,mask:bigint>>"
ARRIVALS = "array<struct<slot:int,key:array<string>,ttl:bigint>>"


def dataset_scope(dataset_id: str, version: str | None) -> str:
    return f"d|{dataset_id}|{version or '*'}"


def profile_scope(name: str) -> str:
    return f"p|{name}"


def look_ups(rules: list[RuleTerms], datasets: DataFrame | None, profile: DataFrame | None, names: dict[str, int]) -> DataFrame:
    """All values the rules may ask for: ``scope``, ``key``, ``value``. Tables that no rule asks are not read."""
    parts = []
    members = [e for r in rules for e in r.members.values()]
    if members:
        if datasets is None:
            raise ValueError("rules with IN_DATASET need the datasets")
        rows = datasets.where(F.col("dataset_id").isin(sorted({e["dataset_id"] for e in members})))
        scope = lambda version: F.concat(F.lit("d|"), "dataset_id", F.lit("|"), version).alias("scope")
        if any(e.get("dataset_version") for e in members):
            parts.append(rows.select(scope(F.col("dataset_version")), F.col("tuple").alias("key"), F.lit("").alias("value")))
        if any(not e.get("dataset_version") for e in members):
            parts.append(rows.select(scope(F.lit("*")), F.col("tuple").alias("key"), F.lit("").alias("value")))
    if names:
        if profile is None:
            raise ValueError("rules with profile fields need the profile")
        name = F.concat("dataset_name", F.lit("."), "field")
        parts.append(profile.where(name.isin(sorted(names))).select(
            F.concat(F.lit("p|"), name).alias("scope"), F.array("key_value").alias("key"), "value"
        ))
    return reduce(DataFrame.unionByName, parts)


def _case(sql_by_rule: dict[str, str], otherwise: str) -> str:
    return f"CASE rule_id {' '.join(f'WHEN {quoted(i)} THEN {sql}' for i, sql in sql_by_rule.items())} ELSE {otherwise} END" if sql_by_rule else otherwise


def _holds(mask: Column, bits: Column) -> Column:
    return mask.bitwiseAND(F.bitwise_not(bits)) == 0


class FirstPass:
    """The rows (event, rule) that the payload lets pass, with ``partition_key``, what a stateful rule asks for, and
    ``_bits``, the answers so far. A null ``terms`` is that of a rule without state, which this pass has decided."""

    def __init__(self, events: DataFrame, rules: list[dict], profile_datasets: set[str]):
        wanted = dict.fromkeys(n for r in rules for e in leaves(r) for n in names_of(e) if "." in n and n.split(".")[0] in profile_datasets)
        self.numbers = {name: i for i, name in enumerate(wanted)}
        self.fields = FieldColumns(rules, {name: f"_p{i}" for name, i in self.numbers.items()})
        compiled = [RuleTerms(r, self.fields, profile_datasets) for r in rules]
        self.stateful = [r for r in compiled if r.slots]
        key_of: dict[tuple, list[str]] = {}
        for r in rules:
            key_of.setdefault(key_fields(r), []).append(r["rule_id"])
        keys = [F.when(F.col("rule_id").isin(ids), key_value(k, self.fields)) for k, ids in key_of.items()]
        details = {r.rule["rule_id"]: r.details(self.numbers) for r in self.stateful}
        self.profile_bits = {r.rule["rule_id"]: r.profile_bits() for r in self.stateful if r.profiles}
        rows = match_units(events, [u for r in compiled for u in r.units()], self.fields, "rule_id")
        self.rows = rows.withColumn("partition_key", F.coalesce(*keys) if keys else F.lit(None).cast("string"))
        if self.stateful:
            # Once per row, whatever is asked of it further on.
            asked = with_once(self.rows, _d=F.expr(_case(details, "NULL"))).select("*", "_d.*").drop("_d")
            self.rows = asked.withColumn("_bits", F.lit(0).cast("bigint"))

    def member_bits(self, matched: Column) -> Column:
        """The membership slots that hold, from those whose value is in its dataset: negated ones that are known to be
        outside."""
        negated = {r.rule["rule_id"]: f"{sum(1 << s for s, e in r.members.items() if e.get('negate'))}L" for r in self.stateful if r.members}
        no = F.expr(_case(negated, "0L"))
        return matched.bitwiseAND(F.bitwise_not(no)).bitwiseOR(F.coalesce("known", F.lit(0).cast("bigint")).bitwiseAND(F.bitwise_not(matched)))


def hits_of(
    events: DataFrame, rules: list[dict], time: str, tie: str, datasets: DataFrame | None = None,
    profile: DataFrame | None = None, profile_datasets: set[str] = frozenset(), cold_rows: int = sequence.COLD_ROWS,
    columns: list[str] | None = None,
) -> DataFrame:
    """Hits of all rules before cooldown: the event's columns with ``partition_key`` and ``rule_id``. With ``columns``
    only these of the event, besides ``time`` and ``tie``, are carried through the joins and stage tables.

    ``time`` and ``tie`` order events (microseconds, then a unique number). ``profile`` is long and
    already guarded against left-over batches. A missing value makes a membership false, also a negated one, and
    keeps an event out of sequences and first arrivals. A sequence stands for its first event; its second ones have to
    pass the rule's trigger as well. A first arrival sees the events for which the rest of its term holds, so
    below an AND those that pass the other conditions, below an OR those that pass what encloses the OR.
    """
    first = FirstPass(events, rules, set(profile_datasets))
    stateful, rows = first.stateful, first.rows
    out = [*(c for c in events.columns if columns is None or c in (*columns, time, tie)), "partition_key", "rule_id"]
    if not stateful:
        return rows.select(*out)
    if any(r.members or r.profiles for r in stateful):
        rows = _looked_up(first, look_ups(stateful, datasets, profile, first.numbers), tie)
    term = lambda test: F.exists("terms", test)
    if any(r.sequences or r.arrivals for r in stateful):
        # What is left is read several times, by everything that needs order.
        ensure_checkpoint_dir(events.sparkSession)
        waiting = term(lambda m: _holds(m, F.col("_bits").bitwiseOR(_order_bits(stateful)))) | (F.size("seconds") > 0) | F.col("terms").isNull()
        rows = rows.where(waiting).select(*out, "terms", "firsts", "seconds", "arrivals", "_bits").checkpoint()
        if any(r.sequences for r in stateful):
            rows = _with_bits(rows, _sequences(rows, stateful, time, tie), tie)
        if any(r.arrivals for r in stateful):
            rows = _with_bits(rows, _arrivals(rows, time, tie, cold_rows), tie)
    return rows.where(F.col("terms").isNull() | term(lambda m: _holds(m, F.col("_bits")))).select(*out)


def _order_bits(rules: list[RuleTerms]) -> Column:
    """The slots of a row's rule that order decides."""
    by_rule = {r.rule["rule_id"]: f"{sum(1 << s for s in [*r.sequences, *r.arrivals])}L" for r in rules}
    return F.expr(_case(by_rule, "0L"))


def _looked_up(first: FirstPass, table: DataFrame, tie: str) -> DataFrame:
    """``_bits`` with the answers of all datasets and the profile, by one join on (scope, key)."""
    # A row that asks nothing keeps one line, which can't match and which its own number spreads.
    nothing = F.array(F.struct(F.lit(None).cast("int").alias("no"), F.lit(None).cast("string").alias("scope"), F.array(F.col(tie).cast("string")).alias("key")))
    asks = first.rows.withColumn("_ask", F.explode(F.when(F.size("asks") > 0, F.col("asks")).otherwise(nothing))).drop("asks")
    asks = asks.select("*", "_ask.no", "_ask.scope", "_ask.key").drop("_ask")
    found = asks.join(table, ["scope", "key"], "left")
    carried = [c for c in asks.columns if c not in ("no", "scope", "key", tie, "rule_id")]
    answer = F.when(F.col("value").isNotNull(), F.struct("no", "value"))
    one = found.groupBy(tie, "rule_id").agg(*[F.first(c).alias(c) for c in carried], F.collect_set(answer).alias("_found"))
    one = one.withColumns({f"_p{i}": F.expr(f"get(filter(_found, a -> a.no = {i}), 0).value") for i in first.numbers.values()})
    one = first.fields.extract_profile(one)
    at = len(first.numbers)
    matched = F.aggregate("_found", F.lit(0).cast("bigint"), lambda bits, a: F.when(
        a["no"] >= at, bits.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), a["no"] - at))).otherwise(bits))
    return one.withColumn("_bits", first.member_bits(matched).bitwiseOR(F.expr(_case(first.profile_bits, "0L"))))


def _with_bits(rows: DataFrame, marks: DataFrame, tie: str) -> DataFrame:
    """``_bits`` with those of ``marks`` (tie, rule_id, slot)."""
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("slot"))
    more = marks.groupBy(tie, "rule_id").agg(F.bit_or(bit).alias("_more"))
    joined = rows.join(more, [tie, "rule_id"], "left")
    return joined.withColumn("_bits", F.col("_bits").bitwiseOR(F.coalesce("_more", F.lit(0)))).drop("_more")


def _sequences(rows: DataFrame, rules: list[RuleTerms], time: str, tie: str) -> DataFrame:
    """The sequence slots that hold, by one as-of scan of all rules' first events over all their second ones."""
    on = ["rule_id", "slot", "key"]
    first = rows.select(tie, time, "rule_id", F.inline("firsts")).withColumn("_from", F.col(time) + F.col("least"))
    ready = F.filter("seconds", lambda s: _holds(s["mask"], F.col("_bits")))
    second = rows.select(time, "rule_id", F.inline(ready)).select(*on, time)
    answered = asof(first, second, on, "_from", time, F.col(time), "_answer", sequence.SLOT, forward=True)
    followed = F.coalesce(F.col("_answer") <= F.col(time) + F.col("most"), F.lit(False))
    wanted = {r.rule["rule_id"]: f"{sum(1 << s for s, n in r.sequences.items() if n['pattern'] == 'FOLLOWED_BY')}L" for r in rules if r.sequences}
    expected = F.expr(f"(shiftright({_case(wanted, '0L')}, slot) & 1) = 1")
    return answered.where(followed == expected).select(tie, "rule_id", "slot")


def _arrivals(rows: DataFrame, time: str, tie: str, cold_rows: int) -> DataFrame:
    """The first-arrival slots that hold, by one ordered pass over the keys of all rules."""
    asked = rows.select(tie, time, "rule_id", "terms", "_bits", F.inline("arrivals")).withColumn(
        "_own", F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("slot"))
    )
    rest = F.exists("terms", lambda m: (m.bitwiseAND(F.col("_own")) != 0) & _holds(m, F.col("_bits").bitwiseOR(F.col("_own"))))
    seen = asked.where(rest).select(tie, time, "rule_id", "slot", "key", "ttl")
    return sequence.first_arrival_ttl(seen, ["rule_id", "slot", "key"], time, tie, "ttl", cold_rows).select(tie, "rule_id", "slot")


def evaluate_rule(
    events: DataFrame, rule: dict, time: str, tie: str, datasets: DataFrame | None = None,
    profile: DataFrame | None = None, profile_datasets: set[str] = frozenset(),
    cold_rows: int = sequence.COLD_ROWS,
) -> DataFrame:
    """Hits of one rule before cooldown; see :func:`hits_of`."""
    return hits_of(events, [rule], time, tie, datasets, profile, profile_datasets, cold_rows)


def evaluate_rules(
    events: DataFrame, rules: list[dict], time: str, tie: str, datasets: DataFrame | None = None,
    profile: DataFrame | None = None, profile_datasets: set[str] = frozenset(), columns: list[str] | None = None,
) -> DataFrame:
    """Hits of a whole catalogue after cooldown; see :func:`hits_of`."""
    hits = hits_of(events, rules, time, tie, datasets, profile, profile_datasets, columns=columns)
    silences = {r["rule_id"]: r.get("cooldown_seconds", 0) for r in rules}
    # The cooldown reads the hits three times.
    return sequence.cooldown(kept(hits) if any(silences.values()) else hits, silences, time, tie)
