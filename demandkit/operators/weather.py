"""Hourly weather history and forecast -> one row per day."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from demandkit.functions.dates import parse_weather_ts

# Landed header -> column name.
VENDOR_COLUMNS = {
    "Date time": "date_time",
    "Minimum Temperature": "minimum_temperature",
    "Maximum Temperature": "maximum_temperature",
    "Temperature": "temperature",
    "Relative Humidity": "relative_humidity",
    "Heat Index": "heat_index",
    "Wind Speed": "wind_speed",
    "Wind Gust": "wind_gust",
    "Wind Direction": "wind_direction",
    "Wind Chill": "wind_chill",
    "Precipitation": "precipitation",
    "Snow Depth": "snow_depth",
    "Cloud Cover": "cloud_cover",
    "Chance Precipitation (%)": "chance_precipitation",
    "Snow": "snow",
    "Dew Point": "dew_point",
    "Info": "info",
    "Precipitation Cover": "precipitation_cover",
    "Visibility": "visibility",
    "Weather Type": "weather_type",
}
# Columns present on one side only.
ONLY_IN_HISTORY = ("dew_point", "info", "precipitation_cover", "visibility", "weather_type")
ONLY_IN_FORECAST = ("chance_precipitation", "snow")
# Daily aggregate by column.
DAILY_AGGREGATES = {
    "minimum_temperature": "min",
    "maximum_temperature": "max",
    "temperature": "avg",
    "relative_humidity": "avg",
    "heat_index": "avg",
    "wind_speed": "avg",
    "wind_gust": "avg",
    "wind_direction": "avg",
    "wind_chill": "avg",
    "precipitation": "avg",
    "snow_depth": "avg",
    "cloud_cover": "avg",
}


def canonical(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed(VENDOR_COLUMNS)


def prepare_history(history: DataFrame) -> DataFrame:
    return canonical(history).drop(*ONLY_IN_HISTORY)


def prepare_forecast(forecast: DataFrame, rain_threshold: float = 0.5) -> DataFrame:
    """Forecast rows in the shape of history: it rains when the chance reaches the threshold."""
    rains = F.when(F.col("chance_precipitation") >= rain_threshold, 1).otherwise(0)
    return (
        canonical(forecast)
        .withColumns(
            {
                "minimum_temperature": F.col("temperature"),
                "maximum_temperature": F.col("temperature"),
                "precipitation": F.col("precipitation") * rains,
            }
        )
        .drop(*ONLY_IN_FORECAST)
    )


def align_to(df: DataFrame, other: DataFrame) -> DataFrame:
    """Same columns in the same order; a difference fails while planning."""
    missing, extra = set(other.columns) - set(df.columns), set(df.columns) - set(other.columns)
    if missing or extra:
        raise ValueError(f"columns differ: missing {sorted(missing)}, extra {sorted(extra)}")
    return df.select(*other.columns)


def latest_per_key(df: DataFrame, keys: Sequence[str], rank: Sequence[str]) -> DataFrame:
    """One row per key: the one highest by ``rank``, then by the remaining columns.

    A maximum over a struct combines on the map side, so a key that fills a third
    of the table is reduced before it is shuffled. No window sorts it.
    """
    rest = [c for c in df.columns if c not in keys and c not in rank]
    best = F.max(F.struct(*rank, *rest)).alias("__best")
    return df.groupBy(*keys).agg(best).select(*keys, "__best.*").select(*df.columns)


def history_wins(history: DataFrame, forecast: DataFrame, key: Sequence[str] = ("date_time",)) -> DataFrame:
    """One observation per timestamp: measured rows replace forecast ones."""
    both = history.withColumn("__source", F.lit(1)).unionByName(
        align_to(forecast, history).withColumn("__source", F.lit(0))
    )
    return latest_per_key(both, key, ["__source"]).drop("__source")


def with_day(hourly: DataFrame) -> DataFrame:
    return hourly.withColumn("date", parse_weather_ts(F.col("date_time")).cast("date"))


def daily(hourly: DataFrame, keys: Sequence[str] = ("date",)) -> DataFrame:
    aggregates = {"min": F.min, "max": F.max, "avg": F.avg}
    present = {c: how for c, how in DAILY_AGGREGATES.items() if c in hourly.columns}
    return hourly.groupBy(*keys).agg(*[aggregates[how](c).alias(c) for c, how in present.items()])


def drop_last_day(df: DataFrame, date: str = "date") -> DataFrame:
    """The last day is usually incomplete."""
    return df.filter(F.col(date) < df.agg(F.max(date)).scalar())


def unreadable_timestamps(hourly: DataFrame) -> DataFrame:
    """Rows whose timestamp text cannot be read; they have no day."""
    return with_day(hourly).filter(F.col("date").isNull())


def weather_by_day(
    history: DataFrame, forecast: DataFrame, rain_threshold: float = 0.5, unreadable: int = 0
) -> DataFrame:
    """Curated weather from landed history and forecast.

    The last day is fetched from the timestamps alone and dropped before anything
    is shuffled; rows that compete for a timestamp share its day. More than
    ``unreadable`` rows without a readable timestamp stop the job.
    """
    past, ahead = prepare_history(history), prepare_forecast(forecast, rain_threshold)
    stamps = with_day(past.select("date_time").union(ahead.select("date_time")))
    found = stamps.agg(F.max("date").alias("last"), F.count_if(F.col("date").isNull()).alias("lost")).first()
    if found["lost"] > unreadable:
        raise ValueError(f"{found['lost']} weather rows have no readable timestamp")
    last = F.lit(found["last"]).cast("date")
    past, ahead = (with_day(side).filter(F.col("date") < last) for side in (past, ahead))
    return daily(history_wins(past, ahead))
