"""Entity validation: rule columns, split into valid / rejected rows with reasons.

A failing row is rejected on its own; its siblings survive (no batch aborts).
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.rules import FOUNDING_YEAR_RANGE, PRICING_TYPES, url_is_http
from ..functions.strings import _c
from ..schemas import ROLE_FAMILIES


def _nonempty(c) -> Column:
    return _c(c).isNotNull() & (F.length(_c(c)) >= 1)


def rules_for(entity: str, cols: set[str], at=F.col, partial: bool = False) -> list[tuple[str, Column]]:
    """(rule name, column that is TRUE when the row breaks the rule).

    ``at`` reads a field (a column of the table, or of a parsed response); ``partial`` leaves out
    the required fields that the record does not carry at all.
    """
    required = {"startup": [("name", _nonempty)], "product": [("name", _nonempty)],
                "paper": [("title", _nonempty), ("paper_url", url_is_http)],
                "job": [("company_name", _nonempty), ("role_title", _nonempty), ("source_name", _nonempty)],
                "news": [("title", _nonempty), ("source_name", _nonempty)]}
    names = {"paper_url": "paper_url_http", "company_name": "company_required", "role_title": "role_required"}
    optional = {"startup": [("employee_count", "employee_count_nonnegative", lambda c: c >= 0),
                            ("founding_year", "founding_year_range", lambda c: c.between(*FOUNDING_YEAR_RANGE))],
                "product": [("pricing_type", "pricing_type_enum", lambda c: c.isin(*PRICING_TYPES))],
                "paper": [("github_stars", "github_stars_nonnegative", lambda c: c >= 0)],
                "job": [("role_family", "role_family_enum", lambda c: c.isin(*ROLE_FAMILIES))]}
    r = [("source_url_http", ~url_is_http(at("source_url")))] if "source_url" in cols else []
    r += [(names.get(f, f"{f}_required"), ~ok(at(f))) for f, ok in required.get(entity, []) if f in cols or not partial]
    r += [(name, F.coalesce(~ok(at(f)), F.lit(False))) for f, name, ok in optional.get(entity, []) if f in cols]
    return r


def with_violations(df: DataFrame, entity: str) -> DataFrame:
    """Adds ``violations: array<string>`` (empty = valid)."""
    rules = rules_for(entity, set(df.columns))
    arr = F.array_compact(F.array(*[F.when(bad, F.lit(name)) for name, bad in rules])) if rules \
        else F.array().cast("array<string>")
    return df.withColumn("violations", arr)


def validate_entities(df: DataFrame, entity: str) -> tuple[DataFrame, DataFrame]:
    """(valid rows without the helper column, rejected rows with ``violations``)."""
    v = with_violations(df, entity)
    ok = v.filter(F.size("violations") == 0).drop("violations")
    bad = v.filter(F.size("violations") > 0)
    return ok, bad
