"""Column names and row comparison as SQL text.

Expressions over many columns are passed to Spark as text: it parses one
string far faster than Python can build the same tree call by call.
"""

from __future__ import annotations

from collections.abc import Sequence


def ident(name: str, side: str | None = None) -> str:
    """A quoted column name, so that it may hold dots, blanks or backticks."""
    quoted = "`" + name.replace("`", "``") + "`"
    return quoted if side is None else f"{side}.{quoted}"


def idents(names: Sequence[str], side: str | None = None) -> list[str]:
    return [ident(n, side) for n in names]


def any_of(conditions: Sequence[str]) -> str:
    """OR over all conditions, as a balanced tree.

    A chain of some hundred ORs is as deep as it is long and can exhaust the
    optimizer's stack on wide tables; the tree is only log2(n) deep and still
    stops at the first true branch.
    """
    level = list(conditions)
    if not level:
        return "false"
    while len(level) > 1:
        pairs = [level[i : i + 2] for i in range(0, len(level), 2)]
        level = [f"({' OR '.join(pair)})" for pair in pairs]
    return level[0]


def differs(columns: Sequence[str], left: str, right: str) -> str:
    """True when any column differs between ``left`` and ``right``.

    Null equals null, and null differs from every value.
    """
    return any_of([f"NOT ({ident(c, left)} <=> {ident(c, right)})" for c in columns])
