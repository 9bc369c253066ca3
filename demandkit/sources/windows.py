"""Which load windows exist, and which must be loaded again."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Sales are loaded in windows of four weeks, both ends inclusive.
FIRST_WINDOW = dt.date(2018, 1, 1)
WINDOW_DAYS = 28
GRACE_DAYS = 3
# Weather history comes in files of twenty days and the day after.
WEATHER_DAYS = 20
WEATHER_FILE = "weather_{}_21d.csv"
WEATHER_START = r"weather_(\d{4}-\d{2}-\d{2})_"


def sales_windows(bounds: DataFrame, days: int = WINDOW_DAYS) -> DataFrame:
    """Windows from ``first`` up to the day before ``today`` (a one-row table).

    The next window starts the day after the last one ends.
    """
    last = F.greatest(F.col("first"), F.date_sub("today", 1))
    starts = F.sequence("first", last, F.expr(f"interval {days + 1} days"))
    planned = bounds.filter(F.col("first") < F.col("today")).select("today", F.explode(starts).alias("start_date"))
    return planned.withColumn("end_date", F.date_add("start_date", days)).withColumn(
        "file_name", window_file(F.col("start_date"), F.col("end_date"))
    )


def planned_windows(spark: SparkSession, today: dt.date, first: dt.date = FIRST_WINDOW) -> DataFrame:
    return sales_windows(spark.range(1).select(F.lit(first).alias("first"), F.lit(today).alias("today")))


def window_file(start: Column, end: Column) -> Column:
    return F.concat(
        F.lit("sales_"), F.date_format(start, "yyyy-MM-dd"), F.lit("_"), F.date_format(end, "yyyy-MM-dd"), F.lit(".csv")
    )


def window_start(date: Column, first: Column, days: int = WINDOW_DAYS) -> Column:
    """Start of the window a date falls into, by arithmetic instead of a range join."""
    number = F.floor(F.datediff(date, first) / (days + 1)).cast("int")
    return F.date_add(first, number * (days + 1))


def windows_to_load(windows: DataFrame, landed: DataFrame, grace_days: int = GRACE_DAYS) -> DataFrame:
    """Windows without a file, and those that ended within the grace period."""
    settled = F.date_add("end_date", grace_days) < F.col("today")
    done = windows.filter(settled).join(landed.select("file_name"), "file_name", "left_semi")
    return windows.join(done.select("file_name"), "file_name", "left_anti")


def loads_to_plan(windows: DataFrame, complete: DataFrame, grace_days: int = GRACE_DAYS) -> DataFrame:
    """Windows to load next, given the loads that have come in full (``window_start``).

    A window whose load stopped half way counts as missing; one that ended within the
    configured grace period is loaded again.
    """
    landed = complete.select(F.col("window_start").alias("start_date")).distinct()
    named = windows.join(landed, "start_date", "left_semi")
    return windows_to_load(windows, named, grace_days)


def weather_file(start: Column) -> Column:
    prefix, suffix = WEATHER_FILE.split("{}")
    return F.concat(F.lit(prefix), F.date_format(start, "yyyy-MM-dd"), F.lit(suffix))


def weather_start(file_name: Column) -> Column:
    return F.to_date(F.nullif(F.regexp_extract(file_name, WEATHER_START, 1), F.lit("")))


def weather_windows(landed: DataFrame, today: Column, days: int = WEATHER_DAYS) -> DataFrame:
    """The newest weather file is replaced; when it is full, a second one starts
    on its last day."""
    newest = landed.agg(F.max(weather_start(F.col("file_name"))).alias("newest"))
    requests = F.when(F.datediff(today, F.col("newest")) >= days, 2).otherwise(1)
    starts = newest.select(F.explode(F.sequence(F.lit(0), requests - 1)).alias("n"), "newest")
    planned = starts.select(F.date_add("newest", F.col("n") * days).alias("start_date"))
    return planned.withColumns(
        {"end_date": F.date_add("start_date", days), "file_name": weather_file(F.col("start_date"))}
    )
