"""Rule conditions as boolean Spark SQL expressions.

Text rather than ``Column`` objects: a catalogue of a thousand rules is then handed to Spark
in one call per source. A leaf is never null: a missing operand makes it false, also for
``!=`` and the NOT forms. ``IS_NULL`` is there for the missing case.
"""

from __future__ import annotations

import re
from typing import Callable, Protocol

from tidewatch.functions.arithmetic import WHOLE, Typed, compared, operands, typed

ISO_TIME = re.compile(r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}")
# Below it every whole number has a double of its own, and no other whole number shares it: comparing doubles
# is exact for such a literal, whatever the event holds.
EXACT_INTEGER = 2**53
COMPARE = {"==": "=", "!=": "<>", ">": ">", "<": "<", ">=": ">=", "<=": "<="}
STRING_TESTS = {"STARTS_WITH": "startswith", "ENDS_WITH": "endswith", "CONTAINS": "contains"}


class Fields(Protocol):
    """Column names of an event's (or a joined profile's) fields by their name in the rule."""

    def text(self, name: str) -> str: ...

    def number(self, name: str) -> str: ...

    def is_text(self, name: str) -> str: ...


def quoted(literal: str) -> str:
    return "'" + literal.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _double(literal) -> str:
    return f"{float(literal)!r}D"


def _sure(test: str) -> str:
    return f"coalesce({test}, false)"


def _compare_literal(op: str, left: str, literal, numbers: str) -> str:
    """The left side read in the literal's type, compared with it."""
    sign = COMPARE[op]
    if isinstance(literal, bool):
        return f"CASE lower({left}) WHEN 'true' THEN true WHEN 'false' THEN false END {sign} {str(literal).lower()}"
    if isinstance(literal, int) and abs(literal) >= EXACT_INTEGER:
        return _whole_or_double(left, None, f"{literal}BD", numbers, _double(literal), sign)
    if isinstance(literal, (int, float)):
        return f"{numbers} {sign} {_double(literal)}"
    if ISO_TIME.match(literal):
        return f"try_to_timestamp({left}) {sign} try_to_timestamp({quoted(literal)})"
    if op in ("==", "!="):
        return f"{left} {sign} {quoted(literal)}"
    # Order is defined for numbers and times only.
    return f"{numbers} {sign} {_double(_as_number(literal))}"


def _as_number(literal: str) -> float:
    try:
        return float(literal)
    except ValueError:
        raise ValueError(f"no order is defined for the text {literal!r}") from None


def _whole_or_double(left: str, right: str | None, right_exact: str, left_number: str, right_number: str, sign: str) -> str:
    """Whole numbers exactly, others as doubles. ``right`` is the right side's text, None for a literal."""
    whole = " AND ".join(f"{t} RLIKE {quoted(WHOLE)}" for t in (left, right) if t)
    return f"CASE WHEN {whole} THEN try_cast({left} AS decimal(38,0)) {sign} {right_exact} ELSE {left_number} {sign} {right_number} END"


def _compare_fields(op: str, left: str, right: str, numbers: tuple[str, str], both_texts: str) -> str:
    """Two JSON texts are equal as texts only. Else numbers compare by value, whole ones exactly, times by
    instant, anything else (equality only) by text."""
    sign = COMPARE[op]
    by_number = _whole_or_double(left, right, f"try_cast({right} AS decimal(38,0))", *numbers, sign)
    if op in ("==", "!="):
        return f"CASE WHEN {both_texts} THEN {left} {sign} {right} ELSE coalesce({by_number}, {left} {sign} {right}) END"
    return f"coalesce({by_number}, try_to_timestamp({left}) {sign} try_to_timestamp({right}))"


def _member(left: str, literals: list, numbers: str) -> str:
    if {type(v) for v in literals} <= {int, float}:
        return f"{numbers} IN ({', '.join(map(_double, literals))})"
    texts = [str(v).lower() if isinstance(v, bool) else str(v) for v in literals]
    return f"{left} IN ({', '.join(map(quoted, texts))})"


def leaf(expression: dict, fields: Fields) -> str:
    """One comparison: ``field``/``expr`` (with ``function`` LENGTH), ``op``, and
    ``value``/``right_field``/``right_expr``."""
    op = expression["op"].upper()
    if expression.get("expr"):
        return _of_expression(op, typed(expression["expr"], fields.text, fields.number), expression, fields)
    if expression.get("right_expr"):
        function = (expression.get("function") or "").upper()
        name = expression.get("field") or expression["fields"][0]
        own = Typed(f"try_cast({fields.text(name)} AS decimal(38,0))", fields.number(name), frozenset([fields.text(name)]))
        if function == "LENGTH":
            own = Typed(f"cast(length({fields.text(name)}) AS decimal(38,0))", f"cast(length({fields.text(name)}) AS double)")
        return _of_expression(op, own, expression, fields)
    numeric = False
    name = expression.get("field") or expression["fields"][0]
    left = numbers = fields.text(name)
    if (expression.get("function") or "").upper() == "LENGTH":
        numeric, left = True, f"cast(length({left}) AS double)"
        numbers = left
    elif op not in ("IS_NULL", "IS_NOT_NULL") and _reads_number(expression):
        numbers = fields.number(name)
    value = expression.get("value")

    if op == "IS_NULL":
        return f"({left} IS NULL)"
    if op == "IS_NOT_NULL":
        return f"({left} IS NOT NULL)"
    if op in ("IN", "NOT IN", "NOT_IN"):
        inside = _member(left, value, numbers)
        return _sure(inside if op == "IN" else f"NOT ({inside})")
    if op == "BETWEEN":
        low, high = value
        return _sure(f"({_compare_literal('>=', left, low, numbers)} AND {_compare_literal('<=', left, high, numbers)})")
    if op.removeprefix("NOT_") in STRING_TESTS:
        test = f"{STRING_TESTS[op.removeprefix('NOT_')]}({left}, {quoted(value)})"
        return _sure(f"NOT {test}" if op.startswith("NOT_") else test)
    if op not in COMPARE:
        raise ValueError(f"unknown operator {expression['op']!r}")
    if expression.get("right_field"):
        other = expression["right_field"]
        if numeric:
            return _sure(f"{numbers} {COMPARE[op]} {fields.number(other)}")
        both_texts = f"{fields.is_text(name)} AND {fields.is_text(other)}"
        return _sure(_compare_fields(op, left, fields.text(other), (numbers, fields.number(other)), both_texts))
    return _sure(_compare_literal(op, left, value, numbers))


def _of_expression(op: str, left: Typed, expression: dict, fields: Fields) -> str:
    """A condition with an expression on the left, or on the right side of a field. Literals are numbers, or texts of
    numbers."""
    if op in ("IS_NULL", "IS_NOT_NULL"):
        return f"(({left.double}) {'IS NULL' if op == 'IS_NULL' else 'IS NOT NULL'})"

    def literal(value) -> Typed:
        number = value if isinstance(value, (int, float)) and not isinstance(value, bool) else _as_number(str(value))
        whole = isinstance(number, int) and abs(number) < 10**38
        return Typed(f"cast({number}BD AS decimal(38,0))" if whole else None, _double(number))

    value = expression.get("value")
    if op in ("IN", "NOT IN", "NOT_IN"):
        inside = " OR ".join(f"({compared(left, '=', literal(v))})" for v in value)
        return _sure(f"({inside})" if op == "IN" else f"NOT ({inside})")
    if op == "BETWEEN":
        low, high = value
        return _sure(f"(({compared(left, '>=', literal(low))}) AND ({compared(left, '<=', literal(high))}))")
    if op not in COMPARE:
        raise ValueError(f"{expression['op']!r} does not compare numbers")
    if expression.get("right_expr"):
        right = typed(expression["right_expr"], fields.text, fields.number)
    elif expression.get("right_field"):
        name = expression["right_field"]
        right = Typed(f"try_cast({fields.text(name)} AS decimal(38,0))", fields.number(name), frozenset([fields.text(name)]))
    else:
        right = literal(value)
    return _sure(compared(left, COMPARE[op], right))


def _reads_number(expression: dict) -> bool:
    """Whether a field condition compares numbers (or may: another field decides at run time)."""
    if expression.get("right_field"):
        return True
    value = expression.get("value")
    literals = value if isinstance(value, list) else [value]
    ordered = expression["op"].upper() in (">", "<", ">=", "<=", "BETWEEN")
    return any(
        isinstance(v, (int, float)) and not isinstance(v, bool) or ordered and isinstance(v, str) and not ISO_TIME.match(v) for v in literals
    )


def dnf(groups: list[list[dict]], leaf_of: Callable[[dict], str]) -> str:
    """Trigger conditions: any group whose every condition holds. An empty group, or none, passes everything."""
    if not groups or not all(groups):
        return "true"
    return "(" + " OR ".join("(" + " AND ".join(map(leaf_of, group)) + ")" for group in groups) + ")"


def tree(node: dict | None, leaf_of: Callable[[dict], str]) -> str:
    """A condition tree of AND, OR and CONDITION nodes; no tree means true."""
    if not node:
        return "true"
    kind = node["type"].upper()
    if kind in ("AND", "OR"):
        parts = [tree(child, leaf_of) for child in node.get("children", [])]
        return "(" + f" {kind} ".join(parts) + ")" if parts else str(kind == "AND").lower()
    if kind == "CONDITION":
        return leaf_of(node["expression"])
    raise ValueError(f"a {kind} node is not a boolean condition")


def names_of(expression: dict) -> list[str]:
    """The fields that a condition reads, also those inside its expressions."""
    plain = [expression.get("field"), expression.get("right_field"), *(expression.get("fields") or []), *(expression.get("key_fields") or [])]
    inside = [n for k in ("expr", "right_expr") if expression.get(k) for n in operands(expression[k])]
    return [n for n in [*plain, *inside] if n]


def leaves(rule: dict) -> list[dict]:
    """All condition expressions of a rule: trigger conditions first, then the tree."""
    found = [c for t in rule.get("trigger_criteria", []) for g in t.get("conditions") or [] for c in g]

    def walk(node):
        if not node:
            return
        if "expression" in node:
            found.append(node["expression"])
        for child in node.get("children", []):
            walk(child)
        for side in ("first", "second"):
            found.extend((node.get(side) or {}).get("filter", []))

    walk(rule.get("condition_tree"))
    return found
