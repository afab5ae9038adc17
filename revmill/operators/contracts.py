"""Checks that a typed, keyed table would enforce, as reports."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType


class ContractError(ValueError):
    """Data breaks a rule it is loaded under."""


def check_unique(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count("*").alias("row_count")).where("row_count > 1")


def check_fk(df: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Key values without a parent row, with their number of rows. Counted per key
    before the join, so a frequent orphan is one row in it."""
    referenced = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("row_count"))
    return referenced.join(parent.select(key).distinct(), key, "left_anti")


def check_rules(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Rows breaking each rule, all rules in one pass. As in a CHECK constraint, a rule
    that is neither true nor false (NULL) is not broken."""
    broken = df.agg(*[F.count_if(~rule).alias(f"r{i}") for i, rule in enumerate(rules.values())])
    rows = [
        F.struct(F.lit(name).alias("rule"), F.col(f"r{i}").alias("violations"))
        for i, name in enumerate(rules)
    ]
    return broken.select(F.inline(F.array(*rows)))


def fit_rules(limits: dict[str, int | DecimalType]) -> dict[str, Column]:
    """A rule per column: text no longer than n, or a number within a decimal type."""
    rules = {}
    for name, limit in limits.items():
        column = F.col(name)
        if isinstance(limit, DecimalType):
            fits = column.isNull() | column.try_cast(limit).isNotNull()
            rules[f"{name} fits {limit.simpleString()}"] = fits
        else:
            rules[f"{name} fits varchar({limit})"] = F.length(column) <= limit
    return rules


def check_fit(df: DataFrame, limits: dict[str, int | DecimalType]) -> DataFrame:
    return check_rules(df, fit_rules(limits))


def not_negative(*columns: str) -> dict[str, Column]:
    return {f"{c} >= 0": F.col(c) >= 0 for c in columns}


def apply_defaults(df: DataFrame, defaults: dict[str, Any]) -> DataFrame:
    """Fills absent values; the column keeps its type."""
    types = dict(df.dtypes)
    return df.withColumns(
        {
            c: F.coalesce(F.col(c), F.lit(value).cast(types[c]))
            for c, value in defaults.items()
            if c in types
        }
    )


def enforce(report: DataFrame, what: str) -> None:
    """Raises if a ``check_rules`` report shows a broken rule."""
    broken = report.where("violations > 0").collect()
    if broken:
        found = ", ".join(f"{r['rule']}: {r['violations']} rows" for r in broken)
        raise ContractError(f"{what}: {found}")
