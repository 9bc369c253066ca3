"""Register sources by name.

A source is a function ``(spark, path, store, from_date, to_date) -> DataFrame``
with columns ``index, store, product, date, sales`` and any attributes. Both
dates are inclusive and optional.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from demandkit.config import ForecastConfig

Source = Callable[..., DataFrame]
_SOURCES: dict[str, Source] = {}


def register(name: str) -> Callable[[Source], Source]:
    def add(source: Source) -> Source:
        _SOURCES[name] = source
        return source

    return add


def registered() -> tuple[str, ...]:
    return tuple(_SOURCES)


def load_sales(
    spark: SparkSession,
    config: ForecastConfig,
    path: str,
    from_date: dt.date | str | None = None,
    to_date: dt.date | str | None = None,
) -> DataFrame:
    """Read with the source the configuration names."""
    if config.register not in _SOURCES:
        raise KeyError(f"no source {config.register!r}; known: {sorted(_SOURCES)}")
    return _SOURCES[config.register](spark, path, config.store, from_date, to_date)


def as_date(value: dt.date | str | None) -> dt.date | None:
    return dt.date.fromisoformat(value) if isinstance(value, str) else value


def date_range(df: DataFrame, from_date=None, to_date=None, column: str = "date") -> DataFrame:
    """Inclusive range; a missing side is open. Compares the stored column with
    literals (the day after the last one, for timestamps), so that the filter
    reaches the scan."""
    first, last = as_date(from_date), as_date(to_date)
    value = F.col(column)
    if first is not None:
        df = df.filter(value >= F.lit(first))
    if last is not None:
        df = df.filter(value < F.lit(last + dt.timedelta(days=1)))
    return df
