"""SQL-text builders for the DuckDB oracle of the keyword operators."""

from __future__ import annotations


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def count_contains(x: str, terms: list[str]) -> str:
    return "(" + " + ".join(f"CASE WHEN instr({x}, {q(t)}) > 0 THEN 1 ELSE 0 END" for t in terms) + ")"


def any_contains(x: str, terms: list[str]) -> str:
    return "(" + " OR ".join(f"instr({x}, {q(t)}) > 0" for t in terms) + ")"


def strip_ws(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def first_case(pairs, default: str | None = None) -> str:
    """pairs: (condition_sql, value_sql)"""
    body = " ".join(f"WHEN {c} THEN {v}" for c, v in pairs)
    return f"CASE {body}" + (f" ELSE {default}" if default is not None else "") + " END"
