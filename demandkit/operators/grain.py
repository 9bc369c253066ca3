"""Sales lines -> one row per (store, product, date)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from demandkit.functions.stats import winner

KEYS = ("store", "product", "date")
PAIR = ("store", "product")
TARGET = "sales"
ROW_ID = "index"


def is_measure(field: T.StructField) -> bool:
    """Numbers and booleans are averaged; everything else is voted on."""
    return isinstance(field.dataType, (T.NumericType, T.BooleanType))


def attributes(df: DataFrame) -> list[T.StructField]:
    """Register-specific columns, found from the schema alone."""
    fixed = {*KEYS, TARGET, ROW_ID}
    return [f for f in df.schema if f.name not in fixed]


def plain_names(df: DataFrame) -> DataFrame:
    """Dots of flattened nested names become underscores, as a dotted column name
    would read as a nested field."""
    return df.toDF(*[c.replace(".", "_") for c in df.columns])


def aggregate_map(df: DataFrame, overrides: dict[str, str] | None = None) -> dict[str, str]:
    """Column -> 'sum' | 'mean' | 'most_frequent', by type unless overridden."""
    chosen = {TARGET: "sum"}
    chosen |= {f.name: "mean" if is_measure(f) else "most_frequent" for f in attributes(df)}
    return chosen | (overrides or {})


def sum_or_zero(column: Column) -> Column:
    return F.coalesce(F.sum(column), F.lit(0.0))


def to_grain(lines: DataFrame, keys: Sequence[str] = KEYS, overrides: dict[str, str] | None = None) -> DataFrame:
    """Aggregate sales lines to the grain with one function per column.

    Without voted columns this is one hash aggregation. With them, each line is
    stacked once per voted column, votes are counted by (keys, column, value),
    and only those counts are reduced to the winner per key. Sums and counts of
    the measures ride along on the first slot, so the input is read once, every
    shuffle follows a map-side combine, and no task holds the values of a key.
    """
    lines = plain_names(lines)
    chosen = aggregate_map(lines, overrides)
    types = {f.name: f.dataType for f in lines.schema}
    sums = [c for c, how in chosen.items() if how == "sum"]
    means = [c for c, how in chosen.items() if how == "mean"]
    votes = [c for c, how in chosen.items() if how == "most_frequent"]
    known = lines.dropna(subset=list(keys)).select(
        *keys, *[F.col(c).cast("double").alias(c) for c in sums + means], *votes
    )
    columns = [*keys, *chosen]
    if not votes:
        totals = [sum_or_zero(F.col(c)).alias(c) for c in sums]
        return known.groupBy(*keys).agg(*totals, *[F.avg(c).alias(c) for c in means]).select(*columns)

    measures = sums + means
    slots = [
        F.struct(
            F.lit(slot).alias("__slot"),
            F.col(c).cast("string").alias("__vote"),
            *[(F.col(m) if slot == 0 else F.lit(None).cast("double")).alias(m) for m in measures],
        )
        for slot, c in enumerate(votes)
    ]
    counted = (
        known.select(*keys, F.inline(F.array(*slots)))
        .groupBy(*keys, "__slot", "__vote")
        .agg(
            F.count(F.lit(1)).alias("__votes"),
            *[F.sum(m).alias(f"__sum_{m}") for m in measures],
            *[F.count(m).alias(f"__n_{m}") for m in means],
        )
    )
    slot = F.col("__slot")
    reduced = counted.groupBy(*keys).agg(
        *[sum_or_zero(F.col(f"__sum_{m}")).alias(m) for m in sums],
        *[F.try_divide(F.sum(f"__sum_{m}"), F.sum(f"__n_{m}")).alias(m) for m in means],
        *[
            winner(F.col("__vote"), F.col("__votes"), slot == i).cast(types[c]).alias(c)
            for i, c in enumerate(votes)
        ],
    )
    return reduced.select(*columns)
