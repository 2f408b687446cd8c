"""SQL expressions shared by the operators."""

from .hashing import row_hash, row_hash_named
from .rules import Rule, failing_rule, key_rules, passes
from .text import any_of, differs, ident, idents
from .unions import guard_unions, union_all

__all__ = [
    "Rule",
    "any_of",
    "differs",
    "failing_rule",
    "guard_unions",
    "ident",
    "idents",
    "key_rules",
    "passes",
    "row_hash",
    "row_hash_named",
    "union_all",
]
