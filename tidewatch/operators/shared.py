"""Many rules over one event at the price of their distinct conditions.

A unit is a conjunction: one group of a rule's trigger with what its condition tree demands. The units of a source
and version are the bits of a set. A condition on one field with literals is never tested unit by unit: all such
conditions of a field together are one look-up, from the field's value (or the cell between the numbers the rules
mention) to the set of units that the value lets pass. The sets of all fields are intersected. Every other distinct
condition is tested at most once per event, and only while a unit that needs it is left.
"""

from __future__ import annotations

import json
import zlib
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterable
from dataclasses import dataclass, field as member

from pyspark.sql import Column, DataFrame, functions as F

from tidewatch.operators.predicates import COMPARE, EXACT_INTEGER, ISO_TIME, Fields, leaf, quoted
from tidewatch.operators.scans import with_once

WORD = 62
#: A source with so few units is tested unit by unit, which costs less than looking up and intersecting sets.
FEW = 8
#: Entries of a text look-up in one bucket, and numbers in one step of a search.
BUCKET, STEP = 4, 16
ALL = "array<array<bigint>>"


@dataclass
class Unit:
    """What is reported (``name``) when the event comes from ``route`` and passes all conditions: ``leaves`` are
    expressions, ``tests`` SQL."""

    name: str
    route: tuple[str, str]
    leaves: list[dict] = member(default_factory=list)
    tests: list[str] = member(default_factory=list)


def _is_number(literal) -> bool:
    return isinstance(literal, (int, float)) and not isinstance(literal, bool) and abs(literal) < EXACT_INTEGER


def _as_number(literal) -> float | None:
    """The double that an ordering comparison uses for a literal, if it uses one."""
    if _is_number(literal):
        return float(literal)
    if isinstance(literal, str) and not ISO_TIME.match(literal):
        try:
            return float(literal)
        except ValueError:
            return None
    return None


def indexed(expression: dict) -> tuple[str, str, object] | None:
    """How a look-up decides a condition, as :func:`~tidewatch.operators.predicates.leaf` reads it: (field, ``text`` or
    ``number``, what), with what a set of texts, or of texts that must not be, or a test of numbers. None for others."""
    op, value = (expression.get("op") or "").upper(), expression.get("value")
    if any(expression.get(k) for k in ("expr", "right_field", "right_expr", "function")) or expression.get("negate"):
        return None
    name = expression.get("field") or next(iter(expression.get("fields") or []), None)
    if not name:
        return None
    if op in ("==", "!=") and isinstance(value, str) and not ISO_TIME.match(value):
        return name, "text", (op == "==", [value])
    if op in ("IN", "NOT IN", "NOT_IN") and isinstance(value, list) and value:
        if {type(v) for v in value} <= {int, float}:
            # Doubles on both sides, of whatever size.
            return name, "number", (op == "IN", [(float(v), float(v), True, True) for v in value])
        if all(isinstance(v, str) for v in value):
            return name, "text", (op == "IN", value)
        return None
    if op == "BETWEEN" and isinstance(value, list) and len(value) == 2:
        low, high = map(_as_number, value)
        return None if low is None or high is None else (name, "number", (True, [(low, high, True, True)]))
    if op in ("==", "!=") and _is_number(value):
        return name, "number", (op == "==", [(float(value), float(value), True, True)])
    if op in COMPARE and op not in ("==", "!=") and (number := _as_number(value)) is not None:
        infinite = float("inf")
        low, high = (number, infinite) if op[0] == ">" else (-infinite, number)
        return name, "number", (True, [(low, high, op == ">=" or op[0] == "<", op == "<=" or op[0] == ">")])
    return None


def _set(bits: Iterable[int], words: int) -> list[int]:
    out = [0] * words
    for b in bits:
        out[b // WORD] |= 1 << b % WORD
    return out


def _constant(value, kind: str) -> Column:
    """A nested list as one literal, read when the plan is optimised."""
    return F.from_json(F.lit(json.dumps(value)), kind)


def _text_sets(column: Column, conditions: dict[int, list], every: set[int], words: int) -> Column:
    """The units that a text lets pass. ``conditions``: by unit, (wanted, texts) that all have to hold."""
    mentioned = sorted({t for tests in conditions.values() for _, texts in tests for t in texts})
    passing = {t: every - {u for u, tests in conditions.items() if not all((t in texts) == wanted for wanted, texts in tests)} for t in mentioned}
    other = every - {u for u, tests in conditions.items() if any(wanted for wanted, _ in tests)}
    buckets = max(1, -(-len(mentioned) // BUCKET))
    keys: list[list[str]] = [[] for _ in range(buckets)]
    for t in mentioned:
        keys[zlib.crc32(t.encode()) % buckets].append(t)
    at = (F.crc32(column.cast("binary")) % buckets + 1).cast("int")
    place = F.array_position(F.element_at(_constant(keys, "array<array<string>>"), at), column)
    sets = F.element_at(_constant([[_set(passing[t], words) for t in k] for k in keys], f"array<{ALL}>"), at)
    found = F.when(place > 0, F.element_at(sets, place.cast("int"))).otherwise(_constant(_set(other, words), "array<bigint>"))
    return F.when(column.isNull(), _constant(_set(every - conditions.keys(), words), "array<bigint>")).otherwise(found)


def _number_sets(column: Column, conditions: dict[int, list], every: set[int], words: int) -> Column:
    """The units that a number lets pass: one set per number mentioned and per gap between two of them."""
    infinite = float("inf")
    numbers = sorted({x for tests in conditions.values() for _, spans in tests for low, high, *_ in spans for x in (low, high) if abs(x) != infinite})

    def holds(test: tuple, cell: int) -> bool:
        wanted, spans = test
        place, on = cell // 2, cell % 2  # on the number at ``place``, or in the gap before it
        inside = False
        for low, high, with_low, with_high in spans:
            at_low = -1 if low == -infinite else bisect_left(numbers, low)
            at_high = len(numbers) if high == infinite else bisect_left(numbers, high)
            inside |= (at_low < place or (on and at_low == place and with_low)) and (place < at_high or (place == at_high and (not on or with_high)))
        return inside == wanted

    cells = [_set(every - {u for u, tests in conditions.items() if not all(holds(t, c) for t in tests)}, words) for c in range(2 * len(numbers) + 1)]
    step = max(STEP, int(len(numbers) ** 0.5))
    blocks = [numbers[i : i + step] for i in range(0, len(numbers), step)]
    # How many numbers are smaller: whole blocks by their first number, then inside the last of them.
    block = F.size(F.filter(_constant([b[0] for b in blocks], "array<double>"), lambda x: x < column))
    smaller = F.when(block == 0, 0).otherwise(
        (block - 1) * step + F.size(F.filter(F.element_at(_constant(blocks, "array<array<double>>"), F.greatest(block, F.lit(1))), lambda x: x < column))
    )
    row = F.struct(smaller.alias("n"))
    known = _constant(numbers, "array<double>")
    cell = F.transform(F.array(row), lambda r: 2 * r["n"] + F.coalesce(F.get(known, r["n"]) == column, F.lit(False)).cast("int"))
    found = F.element_at(_constant(cells, ALL), F.element_at(cell, 1) + 1)
    return F.when(column.isNull(), _constant(_set(every - conditions.keys(), words), "array<bigint>")).otherwise(found)


class _Route:
    """The units of one source and version."""

    def __init__(self, units: list[Unit], fields: Fields):
        self.names, self.tests, self.needs = [u.name for u in units], {}, []
        self.words = -(-len(units) // WORD)
        columns: dict[tuple[str, str], dict[int, list]] = defaultdict(lambda: defaultdict(list))
        for i, unit in enumerate(units):
            others = list(unit.tests)
            for expression in unit.leaves:
                found = indexed(expression)
                if found:
                    name, kind, what = found
                    column = fields.text(name) if kind == "text" else fields.number(name)
                    columns[(column, kind)][i].append(what)
                else:
                    others.append(leaf(expression, fields))
            self.needs.append(sorted({self.tests.setdefault(t, len(self.tests)) for t in others if t != "true"}))
        every = set(range(len(units)))
        self.every = _constant(_set(every, self.words), "array<bigint>")
        self.sets = [
            (_text_sets if kind == "text" else _number_sets)(F.col(column), conditions, every, self.words) for (column, kind), conditions in sorted(columns.items())
        ]

    def passing(self) -> Column:
        """The units that all look-ups let pass, as words of a set."""
        if not self.sets:
            return self.every
        together = lambda a, b: F.zip_with(a, b, lambda x, y: x.bitwiseAND(y))
        return F.aggregate(F.array(*self.sets[1:]), self.sets[0], together) if len(self.sets) > 1 else self.sets[0]

    def tested(self) -> Column:
        """The outcome of each other condition that a unit left still needs."""
        users = defaultdict(set)
        for i, need in enumerate(self.needs):
            for test in need:
                users[test].add(i)
        out = []
        for sql, number in self.tests.items():
            asked = [(w, bits) for w, bits in enumerate(_set(users[number], self.words)) if bits]
            left = F.lit(False)
            for w, bits in asked:
                left = left | (F.get("_bits", F.lit(w)).bitwiseAND(F.lit(bits)) != 0)
            out.append(F.when(left, F.expr(sql)).otherwise(False))
        return F.array(*out) if out else F.array().cast("array<boolean>")

    def left(self) -> Column:
        """Names of the units whose look-ups and tests all hold."""
        numbers = [[i, i // WORD, i % WORD] for i in range(len(self.names))]
        rows = _constant([{"u": u, "w": w, "b": b} for u, w, b in numbers], "array<struct<u:int,w:int,b:int>>")
        on = F.filter(rows, lambda r: F.get("_bits", r["w"]).bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("bigint"), r["b"])) != 0)
        if any(self.needs):
            needs = _constant(self.needs, "array<array<int>>")
            on = F.filter(on, lambda r: F.forall(F.get(needs, r["u"]), lambda t: F.get("_tested", t)))
        names = _constant(self.names, "array<string>")
        found = F.transform(on, lambda r: F.get(names, r["u"]))
        return F.when(F.exists("_bits", lambda w: w != 0), F.array_distinct(found) if len(set(self.names)) < len(self.names) else found)


class _Few:
    """The units of a source and version that has few of them."""

    def __init__(self, units: list[Unit], fields: Fields):
        self.tests = False
        tests = [[*u.tests, *[leaf(e, fields) for e in u.leaves]] for u in units]
        self.cases = [f"CASE WHEN {' AND '.join(t) or 'true'} THEN {quoted(u.name)} END" for u, t in zip(units, tests)]
        self.repeated = len({u.name for u in units}) < len(units)

    def left(self) -> Column:
        found = F.array_compact(F.expr(f"array({', '.join(self.cases)})"))
        return F.array_distinct(found) if self.repeated else found


def by_route(routes: dict, build, none: Column) -> Column:
    whens = [F.when((F.col("source") == source) & (F.col("schema_version") == version), build(r)) for (source, version), r in routes.items()]
    return F.coalesce(*whens, none)


def match_units(events: DataFrame, units: list[Unit], fields: Fields, out: str) -> DataFrame:
    """One row per event and name of the units it passes, with the event's columns and the extracted ``fields``.

    One pass over the events; no join, no shuffle. ``fields`` must know every column that the units' tests name, and
    is asked to extract them here. The sets grow with the units of a source times the numbers and texts they mention.
    """
    grouped = defaultdict(list)
    for unit in units:
        grouped[unit.route].append(unit)
    routes = {route: (_Route if len(us) > FEW else _Few)(us, fields) for route, us in grouped.items()}
    many = {route: r for route, r in routes.items() if isinstance(r, _Route)}
    if not routes:
        return fields.extract(events).withColumn(out, F.lit(None).cast("string")).where("false")
    words = F.array().cast("array<bigint>")
    looked = fields.extract(events)
    if many:
        looked = with_once(looked, _bits=by_route(many, lambda r: r.passing(), words))
    if any(r.tests for r in many.values()):
        looked = with_once(looked, _tested=by_route(many, lambda r: r.tested(), F.array().cast("array<boolean>")))
    found = by_route(routes, lambda r: r.left(), F.lit(None).cast("array<string>"))
    rest = [c for c in looked.columns if c not in ("_bits", "_tested")]
    # explode_outer: a plain explode would add a filter that looks everything up a second time.
    return looked.select(*rest, F.explode_outer(found).alias(out)).where(F.col(out).isNotNull())
