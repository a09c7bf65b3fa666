"""Linear arithmetic over fields and constants, as written in rule conditions."""

from __future__ import annotations

import ast
from collections.abc import Callable
from dataclasses import dataclass

#: Texts that are whole numbers of a size that decimals hold.
WHOLE = r"^[+-]?[0-9]{1,38}$"


@dataclass(frozen=True)
class Typed:
    """An expression in SQL. ``exact`` is its form over whole numbers (decimals), valid where every text in ``guards``
    is one, and None where a fraction enters by a constant or a division; ``double`` holds for all values."""

    exact: str | None
    double: str
    guards: frozenset[str] = frozenset()

    def whole(self) -> str:
        return " AND ".join(f"{t} RLIKE '{WHOLE}'" for t in sorted(self.guards)) or "true"


def typed(expression: str, text: Callable[[str], str], number: Callable[[str], str]) -> Typed:
    """``"a * 2 + b.c"``; ``text`` and ``number`` name the columns with a field's text form and its double.

    ``+ - * /``, ``%`` and parentheses; anything else is an error. Whole numbers are computed exactly; once a fraction
    enters, all is double. ``%`` is for whole numbers only and null for others, as is a division by zero.
    """

    def build(node: ast.AST) -> Typed:
        match node:
            case ast.Expression():
                return build(node.body)
            case ast.Constant(value=bool()):
                raise ValueError(f"not a number in {expression!r}")
            case ast.Constant(value=int()) if abs(node.value) < 10**38:
                return Typed(f"cast({node.value}BD AS decimal(38,0))", f"{float(node.value)!r}D")
            case ast.Constant(value=int() | float()):
                return Typed(None, f"{float(node.value)!r}D")
            case ast.Name() | ast.Attribute():
                name = ast.unparse(node)
                return Typed(f"try_cast({text(name)} AS decimal(38,0))", number(name), frozenset([text(name)]))
            case ast.UnaryOp(op=ast.USub()):
                inner = build(node.operand)
                return Typed(inner.exact and f"(- {inner.exact})", f"(- {inner.double})", inner.guards)
            case ast.BinOp():
                left, right = build(node.left), build(node.right)
                guards = left.guards | right.guards
                both = left.exact and right.exact

                def with_exact(exact: str, double: str) -> Typed:
                    return Typed(exact if both else None, double, guards)

                match node.op:
                    case ast.Add():
                        return with_exact(f"try_add({left.exact}, {right.exact})", f"({left.double} + {right.double})")
                    case ast.Sub():
                        return with_exact(f"try_subtract({left.exact}, {right.exact})", f"({left.double} - {right.double})")
                    case ast.Mult():
                        return with_exact(f"try_multiply({left.exact}, {right.exact})", f"({left.double} * {right.double})")
                    case ast.Div():
                        return Typed(None, f"try_divide({left.double}, {right.double})", guards)
                    case ast.Mod():
                        if not both:
                            return Typed(None, "cast(NULL AS double)", guards)
                        exact = Typed(f"try_mod({left.exact}, {right.exact})", "", guards)
                        return Typed(exact.exact, f"CASE WHEN {exact.whole()} THEN cast({exact.exact} AS double) END", guards)
        raise ValueError(f"not a linear expression: {expression!r}")

    return build(ast.parse(expression.strip(), mode="eval"))


def compared(left: Typed, sign: str, right: Typed) -> str:
    """A comparison, exact where both sides are whole numbers (and no result outgrows a decimal), else of doubles."""
    doubles = f"{left.double} {sign} {right.double}"
    if not (left.exact and right.exact):
        return doubles
    guard = Typed(None, "", left.guards | right.guards).whole()
    return f"CASE WHEN {guard} THEN coalesce({left.exact} {sign} {right.exact}, {doubles}) ELSE {doubles} END"


def arithmetic(expression: str, operand: Callable[[str], str]) -> str:
    """The expression over doubles; ``operand`` names a field's column."""
    return typed(expression, operand, operand).double


def operands(expression: str) -> list[str]:
    """The fields an expression reads, in order."""
    found: list[str] = []
    arithmetic(expression, lambda name: found.append(name) or name)
    return list(dict.fromkeys(found))
