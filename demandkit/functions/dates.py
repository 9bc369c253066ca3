"""Date columns: calendar fields, Easter, parsing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Month -> season.
SEASONS = {
    "spring": (3, 4, 5),
    "summer": (6, 7, 8),
    "fall": (9, 10, 11),
    "winter": (12, 1, 2),
}

#: Timestamp text of landed weather files.
WEATHER_TS_FORMAT = "MM/dd/yyyy HH:mm:ss"


def season(month: Column) -> Column:
    named = [F.when(month.isin(*months), name) for name, months in SEASONS.items()]
    return F.coalesce(*named, F.lit("undefined"))


def iso_weekday(date: Column) -> Column:
    """Monday is 1, Sunday is 7."""
    return F.weekday(date) + 1


def day_number(date: Column) -> Column:
    return F.unix_date(date)


def parse_weather_ts(text: Column) -> Column:
    """NULL for unreadable text instead of failing the whole job."""
    return F.try_to_timestamp(text, F.lit(WEATHER_TS_FORMAT))


def whole(value: Column, divisor: int) -> Column:
    return F.floor(value / F.lit(divisor)).cast("int")


def with_easter(years: DataFrame, year: str = "year", name: str = "easter") -> DataFrame:
    """Add Gregorian Easter Sunday by the published anonymous computus.

    Each step is a column of its own, so that no step is computed twice.
    """
    y = F.col(year)
    steps = (
        ("golden", y % 19),
        ("century", whole(y, 100)),
        ("in_century", y % 100),
        ("moon_shift", whole(F.col("century") - whole(F.col("century") + 8, 25) + 1, 3)),
        ("epact", (F.col("golden") * 19 + F.col("century") - whole(F.col("century"), 4) - F.col("moon_shift") + 15) % 30),
        (
            "to_sunday",
            ((F.col("century") % 4) * 2 + whole(F.col("in_century"), 4) * 2 + 32 - F.col("epact") - F.col("in_century") % 4)
            % 7,
        ),
        ("late", whole(F.col("golden") + F.col("epact") * 11 + F.col("to_sunday") * 22, 451)),
        ("march_days", F.col("epact") + F.col("to_sunday") - F.col("late") * 7 + 114),
    )
    stepped = years
    for step, value in steps:
        stepped = stepped.withColumn(step, value)
    sunday = F.make_date(y, whole(F.col("march_days"), 31), F.col("march_days") % 31 + 1)
    return stepped.withColumn(name, sunday).drop(*[step for step, _ in steps])
