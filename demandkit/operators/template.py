"""The seven days to predict, with attributes carried over from recent rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from demandkit.operators.grain import KEYS, PAIR, TARGET, attributes, is_measure

HORIZON_DAYS = 7
RECENT_ROWS = 3


class IncompleteGridError(ValueError):
    """Some store and product of the grid has no sales history."""


def recent_rows(history: DataFrame, rows: int = RECENT_ROWS) -> DataFrame:
    """Last rows (not days) of each pair. At the grain a pair has at most one row
    per calendar day, which bounds every window partition."""
    newest_first = W.partitionBy(*PAIR).orderBy(F.col("date").desc())
    return (
        history.withColumn("__recency", F.row_number().over(newest_first))
        .filter(F.col("__recency") <= rows)
        .drop("__recency")
    )


def recent_profile(history: DataFrame, rows: int = RECENT_ROWS, measures_too: tuple[str, ...] = ()) -> DataFrame:
    """One row per pair: mean of recent measures, most frequent recent value of
    the others (NULLs skipped, lowest value on ties), and the pair's last date.

    The aggregation reuses the partitioning and order of the window. ``mode``
    sees at most ``rows`` values a pair.
    """
    fields = attributes(history)
    return recent_rows(history, rows).groupBy(*PAIR).agg(
        F.max("date").alias("last_date"),
        *[F.avg(c).alias(f"recent_{c}") for c in measures_too],
        *[
            (F.avg(f.name) if is_measure(f) else F.mode(F.col(f.name), True)).alias(f.name)
            for f in fields
        ],
    )


def missing_pairs(profile: DataFrame) -> DataFrame:
    """How many pairs of the full stores x products grid have no history.

    Counting needs no product of the two sides.
    """
    return profile.agg(
        F.count_distinct("store").alias("stores"),
        F.count_distinct("product").alias("products"),
        F.count(F.lit(1)).alias("pairs"),
    ).withColumn("missing_pairs", F.col("stores") * F.col("products") - F.col("pairs"))


def assert_full_grid(profile: DataFrame) -> None:
    """Raise where a store has never sold a product that another one sells."""
    found = missing_pairs(profile).first()
    if found["missing_pairs"]:
        raise IncompleteGridError(f"{found['missing_pairs']} pairs have no sales history")


def future_template(
    profile: DataFrame,
    assortment: DataFrame | None = None,
    days: int = HORIZON_DAYS,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Rows to predict: every pair on each of the days after the last sales date.

    ``profile`` comes from :func:`recent_profile` and should be a stored table: the
    last date of all pairs is fetched from it. Pairs come from the history. An ``assortment`` table (store, product) replaces them, so that
    a listing without history gets a row with NULL attributes. ``keep`` names
    further profile columns to carry.
    """
    last_date = F.lit(profile.agg(F.max("last_date")).first()[0]).cast("date")
    carried = [c for c in profile.columns if c not in (*PAIR, "last_date") and not c.startswith("recent_")]
    known = profile
    if assortment is not None:
        known = assortment.select(*PAIR).distinct().join(profile, list(PAIR), "left")
    ahead = F.sequence(F.date_add(last_date, 1), F.date_add(last_date, days))
    return known.select(
        *PAIR,
        F.explode(ahead).alias("date"),
        F.lit(None).cast("double").alias(TARGET),
        *carried,
        *keep,
    )


def with_template(history: DataFrame, template: DataFrame) -> DataFrame:
    """Curated sales: history plus the rows to predict, told apart by NULL sales."""
    columns = [*KEYS, TARGET, *[f.name for f in attributes(history)]]
    measures = [f.name for f in attributes(history) if is_measure(f)]
    past = history.withColumns({TARGET: F.coalesce(TARGET, F.lit(0.0)), **{m: F.col(m).cast("double") for m in measures}})
    return past.select(*columns).unionByName(template.select(*columns))
