"""Small helpers for writing Spark SQL expression text.

Model projections are handed to ``selectExpr``/``F.expr`` as SQL text: the
JVM parses a whole projection in one call, where building the same tree from
Python ``Column`` objects costs one Python->JVM round trip per node.
"""

from __future__ import annotations


def q(name: str) -> str:
    """Back-quoted identifier (raw headers contain spaces, dots and dashes)."""
    return "`" + name.replace("`", "``") + "`"


def s(value: str | None) -> str:
    """SQL string literal."""
    if value is None:
        return "CAST(NULL AS STRING)"
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def case(branches: list[tuple[str, str]], otherwise: str) -> str:
    """CASE WHEN c1 THEN v1 ... ELSE otherwise END (first match wins)."""
    body = " ".join(f"WHEN {c} THEN {v}" for c, v in branches)
    return f"(CASE {body} ELSE {otherwise} END)"
