"""Predictions -> order table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window as W, functions as F

from demandkit.functions.numbers import half_even, range_text
from demandkit.operators.grain import PAIR
from demandkit.runtime import settle

#: Factors for the two ends of an order range.
BAND = (0.85, 1.15)
SERVED_DAYS = 7

# Columns of the order table.
ORDER_COLUMNS = (
    "id",
    "store",
    "product",
    "tomorrow_order_qty",
    "tomorrow_order_range",
    "day_after_order_qty",
    "day_after_order_range",
    "next7_order_qty",
    "next7_order_range",
)


def position_within(df: DataFrame, group: Sequence[str], order: Sequence[str], name: str) -> DataFrame:
    """1-based position inside each group, a NULL group included.

    No task needs to hold a whole group: the rows are range-partitioned by (group,
    order) and stored; the position is the one inside a partition plus the group's rows
    in the partitions before it. One way for every size.
    """
    ranged = settle(
        df.repartitionByRange(*group, *order).withColumn("__part", F.spark_partition_id()), "ranged"
    )
    before = W.partitionBy(*group).orderBy("__part").rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        ranged.groupBy(*group, "__part")
        .agg(F.count(F.lit(1)).alias("__rows"))
        .select(
            *[F.col(c).alias(f"__{c}") for c in group],
            F.col("__part").alias("__of"),
            F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__offset"),
        )
    )
    local = F.row_number().over(W.partitionBy(*group, "__part").orderBy(*order))
    same = F.col("__part") == F.col("__of")
    for c in group:
        same &= F.col(c).eqNullSafe(F.col(f"__{c}"))
    numbered = ranged.withColumn("__local", local).join(offsets, same)
    return numbered.select(*df.columns, (F.col("__local") + F.col("__offset")).cast("int").alias(name))


def with_day_number(predictions: DataFrame, days: int = SERVED_DAYS) -> DataFrame:
    """Rank of each row's date among the first dates to serve; later dates go.

    The first dates are fetched (seven rows) and used as literals.
    """
    first = [r["date"] for r in predictions.select("date").distinct().orderBy("date").limit(days).collect()]
    dates = F.array(*[F.lit(d) for d in first]).cast("array<date>")
    served = predictions.filter(F.col("date").isin(first))
    return served.withColumn("day_no", F.array_position(dates, F.col("date")).cast("int"))


def _with_bands(predictions: DataFrame, band: tuple[float, float]) -> DataFrame:
    return predictions.withColumns(
        {"order_from": F.col("forecast") * band[0], "order_to": F.col("forecast") * band[1]}
    )


def horizon_totals(predictions: DataFrame, band: tuple[float, float] = BAND) -> DataFrame:
    """Tomorrow, the day after and seven days side by side, in one aggregation.

    A pair needs a row on both of the first two days. Bands are summed before
    they are rounded.
    """
    ranked = _with_bands(with_day_number(predictions), band)
    day = F.col("day_no")
    parts = {"tomorrow": day == 1, "day_after": day == 2, "next7": day > 0}
    measures = ("forecast", "order_from", "order_to")
    totals = ranked.groupBy(*PAIR).agg(
        F.count_if(day == 1).alias("__first"),
        F.count_if(day == 2).alias("__second"),
        *[
            F.sum(F.when(included, F.col(m))).alias(f"{label}_{m}")
            for label, included in parts.items()
            for m in measures
        ],
    )
    served = totals.filter((F.col("__first") > 0) & (F.col("__second") > 0))
    return served.select(
        *PAIR,
        *[
            column
            for label in parts
            for column in (
                half_even(F.col(f"{label}_forecast")).alias(f"{label}_order_qty"),
                range_text(F.col(f"{label}_order_from"), F.col(f"{label}_order_to")).alias(f"{label}_order_range"),
            )
        ],
    )


def order_table(predictions: DataFrame, band: tuple[float, float] = BAND) -> DataFrame:
    """Order suggestions per store and product, numbered by product in a store."""
    totals = horizon_totals(predictions, band)
    return position_within(totals, ["store"], ["product"], "id").select(*ORDER_COLUMNS)


def horizon_frame(ranked: DataFrame, label: str, band: tuple[float, float] = BAND) -> DataFrame:
    """One horizon as a table of its own: 'tomorrow', 'day_after' or 'next7'."""
    wanted = {"tomorrow": F.col("day_no") == 1, "day_after": F.col("day_no") == 2, "next7": F.lit(True)}[label]
    rows = _with_bands(ranked, band).filter(wanted)
    totals = rows.groupBy(*PAIR).agg(*[F.sum(m).alias(m) for m in ("forecast", "order_from", "order_to")])
    return totals.select(
        *PAIR,
        half_even(F.col("forecast")).alias(f"{label}_order_qty"),
        range_text(F.col("order_from"), F.col("order_to")).alias(f"{label}_order_range"),
    )


def join_horizons(predictions: DataFrame, band: tuple[float, float] = BAND) -> DataFrame:
    """The three horizon tables joined; :func:`horizon_totals` gives the same rows
    with a single shuffle."""
    ranked = with_day_number(predictions)
    joined = horizon_frame(ranked, "tomorrow", band)
    for label in ("day_after", "next7"):
        joined = joined.join(horizon_frame(ranked, label, band), list(PAIR))
    return joined
