"""Time splits: train, test and the rows to predict."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

MIN_ROWS = 10
SPLITS = ("train", "test", "predict")


def split_bounds(curated: DataFrame, train_share: float = 0.75) -> DataFrame:
    """One row of dates: span of the sales, first day to predict, end of training."""
    found = curated.agg(
        F.min("date").alias("start"),
        F.max("date").alias("end"),
        F.min(F.when(F.col("sales").isNull(), F.col("date"))).alias("first_null"),
    )
    spans = found.select(
        "start", "end", F.coalesce("first_null", F.date_add("end", 1)).alias("pred_cutoff")
    ).withColumn("timespan", F.datediff("pred_cutoff", "start"))
    return spans.withColumn(
        "train_span", F.floor(F.col("timespan") * train_share).cast("int")
    ).withColumn("cutoff_date", F.date_add("start", F.col("train_span")))


@dataclass(frozen=True)
class Bounds:
    """The dates of :func:`split_bounds`, fetched once and used as literals, which
    reach scans as pushed filters."""

    start: dt.date
    end: dt.date
    pred_cutoff: dt.date
    cutoff_date: dt.date


def fetch_bounds(curated: DataFrame, train_share: float = 0.75) -> Bounds:
    row = split_bounds(curated, train_share).first()
    return Bounds(row["start"], row["end"], row["pred_cutoff"], row["cutoff_date"])


def trim(entity: DataFrame, bounds: Bounds, date: str = "date") -> DataFrame:
    """Keep the days the sales table covers, the days to predict included."""
    return entity.filter(F.col(date).between(F.lit(bounds.start), F.lit(bounds.end)))


def to_predict(curated: DataFrame) -> DataFrame:
    return curated.filter(F.col("sales").isNull())


def history_rows(entity: DataFrame, bounds: Bounds, date: str = "date") -> DataFrame:
    """Everything before the first day to predict (train and test together)."""
    return entity.filter(F.col(date) < F.lit(bounds.pred_cutoff))


def assign_split(entity: DataFrame, bounds: Bounds, date: str = "date") -> DataFrame:
    """Label rows train, test or predict. One table serves all sets."""
    day = F.col(date)
    return entity.withColumn(
        "split",
        F.when(day >= F.lit(bounds.pred_cutoff), "predict")
        .when(day <= F.lit(bounds.cutoff_date), "train")
        .otherwise("test"),
    )


def split_sizes(labelled: DataFrame, date: str = "date") -> DataFrame:
    return labelled.groupBy("split").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min(date).alias("first_date"),
        F.max(date).alias("last_date"),
    )


def entity_sizes(entities: Mapping[str, DataFrame], bounds: Bounds) -> DataFrame:
    """Rows, first and last date of each set of each entity, sets without rows included."""
    per_entity = [
        split_sizes(assign_split(entity.select("date"), bounds)).select(F.lit(name).alias("entity"), "*")
        for name, entity in entities.items()
    ]
    found = reduce(DataFrame.unionByName, per_entity)
    wanted = found.sparkSession.createDataFrame([(e, s) for e in entities for s in SPLITS], "entity string, split string")
    sizes = wanted.join(found, ["entity", "split"], "left")
    return sizes.withColumn("n_rows", F.coalesce("n_rows", F.lit(0).cast("long")))


def _broken(bounds: Bounds, min_rows: int, may_lack: Column) -> Column:
    split, cutoff = F.col("split"), F.lit(bounds.cutoff_date)
    return (
        F.when((F.col("n_rows") == 0) & ~may_lack, "no rows")
        .when((split != "predict") & (F.col("n_rows") < min_rows), "too few rows")
        .when((split == "train") & (F.col("last_date") > cutoff), "train after cut")
        .when((split == "test") & (F.col("first_date") <= cutoff), "test before cut")
        .when((split == "test") & (F.col("last_date") >= F.lit(bounds.pred_cutoff)), "test in days to predict")
    )


def entity_violations(entities: Mapping[str, DataFrame], bounds: Bounds, min_rows: int = MIN_ROWS) -> DataFrame:
    """Sets of an entity that are missing, too small or reach across a cut.

    Only sales must have rows to predict: nothing else need be known of those days.
    """
    sizes = entity_sizes(entities, bounds)
    may_lack = (F.col("split") == "predict") & (F.col("entity") != "sales")
    return sizes.withColumn("violation", _broken(bounds, min_rows, may_lack)).filter(F.col("violation").isNotNull())


def split_violations(sizes: DataFrame, bounds: Bounds, min_rows: int = MIN_ROWS) -> DataFrame:
    """Sets that are missing, too small or reach across a cut."""
    expected = sizes.sparkSession.createDataFrame([(name,) for name in SPLITS], "split string")
    sizes = expected.join(sizes, "split", "left").withColumn("n_rows", F.coalesce("n_rows", F.lit(0).cast("long")))
    return sizes.withColumn("violation", _broken(bounds, min_rows, F.lit(False))).filter(F.col("violation").isNotNull())
