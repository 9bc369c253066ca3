"""Queries over the order table: lookup, export, dashboard, table page."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from demandkit.functions.numbers import range_end
from demandkit.functions.text import matches_search
from demandkit.operators.serve import SERVED_DAYS

# Horizon -> quantity and range column.
HORIZON_COLUMNS = {
    "tomorrow": ("tomorrow_order_qty", "tomorrow_order_range"),
    "day_after_tomorrow": ("day_after_order_qty", "day_after_order_range"),
    "next_seven_days": ("next7_order_qty", "next7_order_range"),
}
# Column labels of the order export.
EXPORT_LABELS = {
    "id": "ID",
    "product": "Produkt",
    "tomorrow_order_qty": "Bestellung Morgen",
    "day_after_order_qty": "Bestellung Übermorgen",
    "next7_order_qty": "Bestellung nächste 7 Tage",
}
# Column labels of the table page.
TABLE_LABELS = {
    "id": "ID",
    "product": "Produkt",
    "tomorrow_order_range": "Vorschlag Morgen",
    "tomorrow_order_qty": "Bestellung Morgen",
    "day_after_order_range": "Vorschlag Übermorgen",
    "day_after_order_qty": "Bestellung Übermorgen",
    "next7_order_range": "Vorschlag Woche",
    "next7_order_qty": "Bestellung Woche",
}
# Columns searched, and columns a narrow table leaves out.
SEARCH_COLUMNS = ("id", "product")
HIDDEN_WHEN_NARROW = ("next7_order_qty", "next7_order_range", "day_after_order_range", "tomorrow_order_range")


class UnknownStoreError(LookupError):
    """The order table has no rows for the store."""


def forecast_for_store(orders: DataFrame, store: int) -> DataFrame:
    """Order suggestions of one store. Over a table partitioned by store only that
    partition is read."""
    found = orders.filter(F.col("store") == store)
    if found.isEmpty():
        raise UnknownStoreError(f"Store {store} is not known.")
    return found.drop("store")


def rename_all(df: DataFrame, labels: dict[str, str]) -> DataFrame:
    """Rename; a column that is not there is an error."""
    missing = [c for c in labels if c not in df.columns]
    if missing:
        raise KeyError(f"columns not found: {missing}")
    return df.withColumnsRenamed(labels)


def order_export(orders: DataFrame, horizon: str | None) -> DataFrame:
    """Labelled order list with the quantity of one horizon and no ranges.

    An unknown horizon keeps every column.
    """
    labelled = rename_all(orders, EXPORT_LABELS)
    if horizon not in HORIZON_COLUMNS:
        return labelled
    quantities = {EXPORT_LABELS[q] for h, (q, _) in HORIZON_COLUMNS.items() if h != horizon}
    ranges = {r for _, r in HORIZON_COLUMNS.values()}
    return labelled.drop(*quantities, *ranges)


def apply_overrides(orders: DataFrame, overrides: DataFrame, keys: Sequence[str] = ("store", "product")) -> DataFrame:
    """Quantities entered by the user replace the suggestions they match.

    ``overrides`` has the keys, one row each, and any of the quantity columns. Keys
    that come twice stop the job: neither row is the right one.
    """
    changed = [c for c in overrides.columns if c not in keys]
    repeated = F.raise_error(F.concat_ws(" ", F.lit("several overrides for"), *[F.col(k).cast("string") for k in keys]))
    entered = (
        overrides.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("__rows"), *[F.first(c).alias(f"__{c}") for c in changed])
        .withColumns({f"__{c}": F.when(F.col("__rows") > 1, repeated.cast(overrides.schema[c].dataType)).otherwise(F.col(f"__{c}")) for c in changed})
        .drop("__rows")
    )
    joined = orders.join(entered, list(keys), "left")
    return joined.withColumns({c: F.coalesce(f"__{c}", c) for c in changed}).select(*orders.columns)


def dashboard_kpis(orders: DataFrame) -> DataFrame:
    """Per store: units for tomorrow, products, days served."""
    return orders.groupBy("store").agg(
        F.sum("tomorrow_order_qty").alias("tomorrow_total"),
        F.count(F.lit(1)).alias("products"),
        F.lit(SERVED_DAYS).alias("forecast_days"),
    )


def dashboard_bands(orders: DataFrame, column: str = "tomorrow_order_range") -> DataFrame:
    """Per store: sum of the lower ends and the buffer up to the upper ends."""
    low, high = range_end(F.col(column), 1), range_end(F.col(column), 2)
    return orders.groupBy("store").agg(
        F.sum(low).alias("suggested"), (F.sum(high) - F.sum(low)).alias("safety_buffer")
    )


def chart_series(orders: DataFrame) -> DataFrame:
    """Tomorrow and the day after by product, as charted."""
    return orders.select("store", "product", "tomorrow_order_qty", "day_after_order_qty")


def visible_columns(columns: Sequence[str], horizons: Sequence[str], narrow: bool = False) -> list[str]:
    """Columns the table shows for the chosen horizons; a narrow table shows the
    daily quantities only."""
    if narrow:
        return [c for c in columns if c not in HIDDEN_WHEN_NARROW]
    hidden = {c for h, pair in HORIZON_COLUMNS.items() if h not in horizons for c in pair}
    return [c for c in columns if c not in hidden]


def search(orders: DataFrame, query: str | None) -> DataFrame:
    return orders.filter(matches_search(query, [F.col(c) for c in SEARCH_COLUMNS]))


def table_page(
    orders: DataFrame,
    query: str | None = None,
    sort_by: str = "id",
    ascending: bool = True,
    page: int = 1,
    rows_per_page: int = 10,
    horizons: Sequence[str] = tuple(HORIZON_COLUMNS),
    narrow: bool = False,
    labels: bool = False,
    tie_breakers: Sequence[str] = ("id",),
) -> DataFrame:
    """One page of the searched and sorted table (a top-k, never a full sort)."""
    direction = F.col(sort_by).asc() if ascending else F.col(sort_by).desc()
    ties = [F.col(c).asc() for c in tie_breakers if c != sort_by]
    found = search(orders, query).orderBy(direction, *ties)
    shown = found.offset((page - 1) * rows_per_page).limit(rows_per_page)
    shown = shown.select(*visible_columns(shown.columns, horizons, narrow))
    return shown.withColumnsRenamed(TABLE_LABELS) if labels else shown


def _behind(column: Column, last: object, ascending: bool) -> Column:
    """Whether a value comes after ``last`` in the order of a sort: nulls first upwards, last downwards."""
    if last is None:
        return column.isNotNull() if ascending else F.lit(False)
    found = column > F.lit(last) if ascending else column < F.lit(last)
    return found if ascending else F.coalesce(found, F.lit(True))


def page_after(
    orders: DataFrame,
    last: Mapping[str, object] | None,
    query: str | None = None,
    sort_by: str = "id",
    ascending: bool = True,
    rows_per_page: int = 10,
    tie_breakers: Sequence[str] = ("id",),
) -> DataFrame:
    """The page of the searched and sorted table that follows a given row.

    ``last`` holds the sort column and the tie breakers of the last row seen; without it
    the first page is returned. The rows up to ``last`` are filtered out, by a filter that
    reaches the scan, and the rest is a top-k of one page: a task holds ``rows_per_page``
    rows, however deep the page lies. The pages are those of :func:`table_page` where the
    tie breakers tell all rows apart.
    """
    ties = [c for c in tie_breakers if c != sort_by]
    found = search(orders, query)
    if last is not None:
        kind = {f.name: f.dataType for f in orders.schema}
        behind = F.lit(False)
        for column, upwards in reversed([(sort_by, ascending), *((c, True) for c in ties)]):
            value = F.col(column)
            same = value.eqNullSafe(F.lit(last[column]).cast(kind[column]))
            behind = _behind(value, last[column], upwards) | (same & behind)
        found = found.filter(behind)
    direction = F.col(sort_by).asc() if ascending else F.col(sort_by).desc()
    return found.orderBy(direction, *[F.col(c).asc() for c in ties]).limit(rows_per_page)


def last_key(page: DataFrame, sort_by: str = "id", ascending: bool = True, tie_breakers: Sequence[str] = ("id",)) -> dict[str, object] | None:
    """What :func:`page_after` needs of a page to find the next one; None after an empty page."""
    ties = [c for c in tie_breakers if c != sort_by]
    reverse = [F.col(sort_by).desc() if ascending else F.col(sort_by).asc(), *[F.col(c).desc() for c in ties]]
    row = page.orderBy(*reverse).select(sort_by, *ties).first()
    return None if row is None else row.asDict()
