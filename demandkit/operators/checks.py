"""Data-quality checks. Each returns violations; ``assert_empty`` raises on them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from demandkit.operators.grain import KEYS, TARGET


class DataCheckError(AssertionError):
    """A table breaks a rule of the data model."""


def duplicate_keys(df: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).filter(F.col("n_rows") > 1)


def duplicate_timestamps(hourly: DataFrame, column: str = "date_time") -> DataFrame:
    return duplicate_keys(hourly, [column])


def duplicate_ids(lines: DataFrame, column: str = "index") -> DataFrame:
    return duplicate_keys(lines, [column])


def schema_differences(left: DataFrame, right: DataFrame) -> list[str]:
    """Columns that differ in name, order or type; empty when equal."""
    if left.columns != right.columns:
        return [f"{a} != {b}" for a, b in zip(left.columns, right.columns) if a != b] + [
            f"{len(left.columns)} columns != {len(right.columns)} columns"
        ] * (len(left.columns) != len(right.columns))
    return [
        f"{a.name}: {a.dataType.simpleString()} != {b.dataType.simpleString()}"
        for a, b in zip(left.schema, right.schema)
        if a.dataType != b.dataType
    ]


def entity_problems(name: str, df: DataFrame, target: bool = False) -> list[str]:
    """Every entity has a date; the sales entity has a numeric target."""
    types = {f.name: f.dataType for f in df.schema}
    problems = []
    if not isinstance(types.get("date"), T.DateType):
        problems.append(f"{name} has no date column of type date")
    if target and not isinstance(types.get(TARGET), T.NumericType):
        problems.append(f"{name} has no numeric column {TARGET}")
    return problems


def assert_empty(violations: DataFrame | list[str], rule: str) -> None:
    if isinstance(violations, list):
        if violations:
            raise DataCheckError(f"{rule}: {violations}")
        return
    found = violations.limit(5).collect()
    if found:
        raise DataCheckError(f"{rule}: {[r.asDict() for r in found]} ...")
