"""Small helpers for nested lambdas written as SQL text and parsed once by ``F.expr``.

Built call by call through the driver, such an expression takes thousands of round trips.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import count

Sql = str

_names = count()


def var() -> Sql:
    """A lambda variable name not used before."""
    return f"v{next(_names)}"


def raw(pattern: str) -> Sql:
    """A pattern as a raw SQL literal; its single quotes become regex escapes."""
    return "r'" + pattern.replace("'", r"\x27") + "'"


def lit(value: str) -> Sql:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def each(function: str, array: Sql, body: Callable[[Sql], Sql]) -> Sql:
    """``transform`` or ``filter`` with a lambda variable of its own name."""
    v = var()
    return f"{function}({array}, {v} -> {body(v)})"


def let(value: Sql, body: Callable[[Sql], Sql]) -> Sql:
    """Evaluate ``value`` once for use in ``body``."""
    return f"get({each('transform', f'array({value})', body)}, 0)"
