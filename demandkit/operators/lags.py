"""Day-based lags and trailing windows over a sparse daily grain."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window as W, functions as F

from demandkit.functions.dates import day_number
from demandkit.operators.grain import PAIR

WEEK = 7
#: 52 weeks, so that the weekday stays the same.
YEAR = 364
LAG_COLUMNS = ("last_week", "last_year", "rolling7_sum", "rolling7_mean", "rolling7_days")


def sales_lags(curated: DataFrame, keys: Sequence[str] = PAIR, value: str = "sales") -> DataFrame:
    """Same day last week and last year, and the seven days before.

    Value frames over the day number respect gaps, and frames that differ only in
    their bounds share one shuffle and one sort. A partition holds at most one
    row per calendar day of its pair. The current day is never in a frame.
    """
    days = W.partitionBy(*keys).orderBy(day_number(F.col("date")))
    measure = F.col(value)
    before = days.rangeBetween(-WEEK, -1)
    return curated.withColumns(
        {
            "last_week": F.max(measure).over(days.rangeBetween(-WEEK, -WEEK)),
            "last_year": F.max(measure).over(days.rangeBetween(-YEAR, -YEAR)),
            "rolling7_sum": F.sum(measure).over(before),
            "rolling7_mean": F.avg(measure).over(before),
            "rolling7_days": F.count(measure).over(before),
        }
    )


def trailing_days(
    per_day: DataFrame, columns: Sequence[str], days: int = WEEK, keys: Sequence[str] = ()
) -> DataFrame:
    """Means of the preceding days, for tables that may have no key but the date.

    Each day is handed to the days that follow it and averaged there. That needs
    no window over the whole table in one task.
    """
    handed_on = per_day.select(
        *keys,
        F.explode(F.sequence(F.date_add("date", 1), F.date_add("date", days))).alias("date"),
        *columns,
    )
    trailing = handed_on.groupBy(*keys, "date").agg(
        *[F.avg(c).alias(f"past{days}_{c}") for c in columns], F.count(F.lit(1)).alias(f"past{days}_days")
    )
    return per_day.join(trailing, [*keys, "date"], "left").withColumn(
        f"past{days}_days", F.coalesce(f"past{days}_days", F.lit(0))
    )
