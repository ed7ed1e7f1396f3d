"""DuckDB SQL fragments shared by the oracles (built from the same fixed values)."""
from __future__ import annotations

from ..functions.rules import ROLE_RULES
from ..operators.resolve import KNOWN_ALIASES, SEED_ENTITIES
from .derive import NAME_VARIANTS, ROLE_NOTES, ROLE_TITLES


def lit(s) -> str:
    return "NULL" if s is None else "'" + str(s).replace("'", "''") + "'"


def lst(items) -> str:
    return "[" + ", ".join(lit(x) for x in items) + "]"


def company_sql(k: str) -> str:
    seed = f"{lst(SEED_ENTITIES)}[({k}) % {len(SEED_ENTITIES)} + 1]"
    v = f"((({k}) // {len(SEED_ENTITIES)}) % {NAME_VARIANTS})"
    return (f"(CASE {v} WHEN 0 THEN {seed} WHEN 1 THEN upper({seed}) || ', Inc.' "
            f"WHEN 2 THEN {lst(list(KNOWN_ALIASES))}[({k}) % {len(KNOWN_ALIASES)} + 1] "
            f"WHEN 3 THEN array_to_string(list_reverse(string_split({seed}, ' ')), ' ') "
            f"WHEN 4 THEN substr({seed}, 1, 1) || substr({seed}, 3) "
            f"ELSE 'Company ' || CAST(({k}) AS VARCHAR) END)")


def role_sql(k: str) -> str:
    return f"{lst(ROLE_TITLES)}[({k}) % {len(ROLE_TITLES)} + 1]"


def note_sql(k: str) -> str:
    return f"{lst(ROLE_NOTES)}[({k}) % {len(ROLE_NOTES)} + 1]"


def role_family_sql(text: str) -> str:
    t = f"lower({text})"
    parts = []
    for fam, terms in ROLE_RULES:
        cond = " OR ".join(f"contains({t}, {lit(x)})" for x in terms)
        parts.append(f"WHEN {cond} THEN {lit(fam)}")
    return "(CASE " + " ".join(parts) + " ELSE 'OTHER' END)"
