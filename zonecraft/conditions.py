"""Conditions of a control file, written over data frames, as Spark SQL.

A condition compares columns of its table (``households.NP == 1``), combines comparisons with ``&``, ``|``, ``~`` and brackets
and may use ``np.inf``, arithmetic, ``isin``, ``between``, ``isna`` and ``notna``. Its text is read by Python's own grammar, so
precedence is what the author of a data-frame expression counts on. Missing values follow data frames too: a comparison with
one does not hold, ``!=`` does, and ``~`` turns a condition that does not hold into one that does.
"""

from __future__ import annotations

import ast

COMPARISONS = {ast.Eq: "=", ast.Lt: "<", ast.LtE: "<=", ast.Gt: ">", ast.GtE: ">="}
ARITHMETIC = {ast.Add: "+", ast.Sub: "-", ast.Mult: "*"}
INFINITY = "double('infinity')"


class BadCondition(ValueError):
    """A condition that is not understood, with the part that is not."""


def to_sql(expression: str, table: str) -> str:
    """The condition over ``table`` as Spark SQL over that table's columns."""
    try:
        tree = ast.parse(expression.strip(), mode="eval").body
    except SyntaxError as error:
        raise BadCondition(f"{expression!r} is not an expression: {error.msg}") from error
    return _condition(tree, table)


def _refuse(node: ast.AST, why: str) -> BadCondition:
    return BadCondition(f"{ast.unparse(node)!r} {why}")


def _condition(node: ast.AST, table: str) -> str:
    match node:
        case ast.BinOp(left, ast.BitAnd() | ast.BitOr() as op, right):
            word = "and" if isinstance(op, ast.BitAnd) else "or"
            return f"({_condition(left, table)} {word} {_condition(right, table)})"
        case ast.BoolOp(op, values):
            word = " and " if isinstance(op, ast.And) else " or "
            return "(" + word.join(_condition(v, table) for v in values) + ")"
        case ast.UnaryOp(ast.Invert() | ast.Not(), operand):
            return f"(not coalesce({_condition(operand, table)}, false))"
        case ast.Compare(left, ops, comparators):
            operands = [_value(v, table) for v in (left, *comparators)]
            parts = [_compared(op, a, b, node) for op, a, b in zip(ops, operands, operands[1:], strict=False)]
            return parts[0] if len(parts) == 1 else "(" + " and ".join(parts) + ")"
        case ast.Call(ast.Attribute(owner, "isin"), [ast.List(items) | ast.Tuple(items) | ast.Set(items)], []):
            if not items:
                return "false"
            return f"coalesce({_value(owner, table)} in ({', '.join(_value(i, table) for i in items)}), false)"
        case ast.Call(ast.Attribute(owner, "between"), [low, high], []):
            return f"({_value(owner, table)} between {_value(low, table)} and {_value(high, table)})"
        case ast.Call(ast.Attribute(owner, "isna" | "isnull"), [], []):
            return f"({_value(owner, table)} is null)"
        case ast.Call(ast.Attribute(owner, "notna" | "notnull"), [], []):
            return f"({_value(owner, table)} is not null)"
        case ast.Constant(bool() as value):
            return str(value).lower()
    raise _refuse(node, "is not a condition; comparisons beside & and | need brackets")


def _compared(op: ast.cmpop, left: str, right: str, node: ast.AST) -> str:
    if isinstance(op, ast.NotEq):
        return f"(not {left} <=> {right})"
    if type(op) not in COMPARISONS:
        raise _refuse(node, "compares in a way that data frames do not")
    return f"({left} {COMPARISONS[type(op)]} {right})"


def _value(node: ast.AST, table: str) -> str:
    match node:
        case ast.Attribute(ast.Name("np" | "numpy"), "inf" | "Inf" | "infty"):
            return INFINITY
        case ast.Attribute(ast.Name(name), column) | ast.Subscript(ast.Name(name), ast.Constant(str() as column)):
            if name != table:
                raise _refuse(node, f"is not a column of {table}")
            return f"`{column.replace('`', '``')}`"
        case ast.Constant(str() as text):
            quoted = text.replace("\\", "\\\\").replace("'", "\\'")
            return f"'{quoted}'"
        case ast.Constant(int() | float() as number) if not isinstance(number, bool):
            return INFINITY if number == float("inf") else repr(number) if isinstance(number, int) else f"{number!r}d"
        case ast.UnaryOp(ast.USub(), operand):
            return f"(-{_value(operand, table)})"
        case ast.UnaryOp(ast.UAdd(), operand):
            return _value(operand, table)
        case ast.BinOp(left, op, right) if type(op) in ARITHMETIC:
            return f"({_value(left, table)} {ARITHMETIC[type(op)]} {_value(right, table)})"
        case ast.BinOp(left, ast.Div(), right):
            return f"try_divide({_value(left, table)}, {_value(right, table)})"
        case ast.BinOp(left, ast.Mod(), right):
            return f"pmod({_value(left, table)}, nullif({_value(right, table)}, 0))"
    raise _refuse(node, f"is not a value over {table}")
