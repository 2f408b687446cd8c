"""Row rules: named conditions a row must meet to enter a snapshot."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import types as T

from .text import ident

# A key of 50 characters or more, or one holding this mark,
# comes from a row whose columns have shifted.
MAX_KEY_LENGTH = 50
SHIFTED_KEY_MARK = "@"


class Rule(NamedTuple):
    """``ok`` is a SQL condition, true for the rows to keep."""

    name: str
    ok: str


def key_rules(schema: T.StructType, keys: Sequence[str]) -> list[Rule]:
    """Every key is present; a text key has no ``@`` and is under 50 characters."""
    rules = []
    for key in keys:
        column = ident(key)
        rules.append(Rule(f"{key}_missing", f"{column} IS NOT NULL"))
        if isinstance(schema[key].dataType, T.StringType):
            rules.append(Rule(f"{key}_shifted", f"NOT contains({column}, '{SHIFTED_KEY_MARK}')"))
            rules.append(Rule(f"{key}_too_long", f"length({column}) < {MAX_KEY_LENGTH}"))
    return rules


def passes(rules: Sequence[Rule]) -> str:
    """True when every rule holds."""
    return " AND ".join(f"({rule.ok})" for rule in rules) or "true"


def failing_rule(rules: Sequence[Rule]) -> str:
    """Name of the first rule a row breaks, null when it breaks none."""
    broken = " ".join(
        f"WHEN NOT coalesce({rule.ok}, false) THEN '{_text(rule.name)}'" for rule in rules
    )
    return f"CASE {broken} END" if rules else "CAST(NULL AS STRING)"


def _text(value: str) -> str:
    return value.replace("\\", "\\\\").replace("'", "\\'")
