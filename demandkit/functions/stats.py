"""Aggregate columns that Spark lacks in the wanted form."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def sample_skew(value: Column) -> Column:
    """Sample-corrected skewness: NULL below three values, 0 without spread."""
    n = F.count(value).cast("double")
    corrected = F.skewness(value) * F.sqrt(n * (n - 1)) / (n - 2)
    return F.when(n < 3, None).when(F.min(value) == F.max(value), 0.0).otherwise(corrected)


def percent_true(flag: Column) -> Column:
    return F.avg(F.coalesce(flag, F.lit(False)).cast("double"))


def winner(value: Column, votes: Column, among: Column | None = None) -> Column:
    """Value with the most votes over a table of (value, votes).

    Ties go to the lowest value and NULL loses every tie. ``among`` restricts the
    rows that take part. The buffer holds one value per group, so hot groups
    combine on the map side.
    """
    order = F.struct((-votes).alias("v"), value.isNull().alias("n"), value.alias("x"))
    if among is not None:
        value, order = F.when(among, value), F.when(among, order)
    return F.min_by(value, order)
