"""Declared rules checked over DataFrames, and schema evolution."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F

from tallyhouse.operators.aggregates import metrics_as_rows


@dataclass(frozen=True)
class Rules:
    """NOT NULL columns, CHECK conditions by name, and unique keys by name."""

    not_null: Sequence[str] = ()
    checks: Mapping[str, Column] = field(default_factory=dict)
    unique: Mapping[str, Sequence[str]] = field(default_factory=dict)


def check_constraints(df: DataFrame, rules: Rules) -> DataFrame:
    """Violations per rule. All row rules share one pass; each unique key takes one grouping.

    As in SQL, a CHECK whose condition is NULL holds, and a key holding a NULL is not compared.
    For a unique key the violations are the rows beyond the first of each key.
    """
    row_rules = {f"not_null({c})": F.count_if(F.col(c).isNull()) for c in rules.not_null}
    row_rules |= {f"check({name})": F.count_if(~test) for name, test in rules.checks.items()}
    parts = [metrics_as_rows(df, row_rules, "rule", "violations")] if row_rules else []
    for name, keys in rules.unique.items():
        counted = df.dropna(subset=list(keys)).groupBy(*keys).agg(F.count("*").alias("n"))
        beyond = F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("violations")
        parts.append(counted.agg(beyond).select(F.lit(f"unique({name})").alias("rule"), "violations"))
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def with_defaults(df: DataFrame, defaults: Mapping[str, Any]) -> DataFrame:
    """DEFAULT values for columns an insert left out."""
    missing = {c: F.lit(v) for c, v in defaults.items() if c not in df.columns}
    return df.withColumns(missing) if missing else df


def add_column(df: DataFrame, name: str, data_type: str) -> DataFrame:
    """A new column; rows written before it read NULL."""
    return df.withColumn(name, F.lit(None).cast(data_type))
