"""Relational features: per-day aggregates of dated entities, attached to sales rows."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import astuple, dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from demandkit.functions.dates import iso_weekday
from demandkit.functions.geo import haversine
from demandkit.functions.stats import percent_true, sample_skew, winner
from demandkit.functions.text import num_characters, num_words
from demandkit.operators.grain import KEYS, TARGET
from demandkit.operators.lags import LAG_COLUMNS, sales_lags
from demandkit.runtime import settle, small_side

# Aggregate primitives by kind of column.
NUMERIC_PRIMITIVES = ("sum", "std", "max", "skew", "min", "mean")
BOOLEAN_PRIMITIVES = ("percent_true",)
DISCRETE_PRIMITIVES = ("num_unique", "mode")
DATE_PRIMITIVES = ("day", "week", "month", "weekday")
TEXT_PRIMITIVES = ("num_words", "num_characters")


@dataclass(frozen=True)
class FeatureDef:
    name: str
    entity: str
    column: str
    primitive: str


def day_feature_name(primitive: str, entity: str, column: str = "") -> str:
    return "__".join(part for part in ("days", primitive, entity, column) if part)


def define_day_features(
    entity: DataFrame, name: str, exclude: Iterable[str] = (), where: dict[str, Column] | None = None
) -> list[FeatureDef]:
    """Feature definitions of one dated entity, from its schema alone."""
    skip = {"date", "index", *exclude}
    found = [FeatureDef(day_feature_name("count", name), name, "", "count")]
    for field in entity.schema:
        if field.name in skip:
            continue
        if isinstance(field.dataType, T.BooleanType):
            primitives = BOOLEAN_PRIMITIVES
        elif isinstance(field.dataType, T.NumericType):
            primitives = NUMERIC_PRIMITIVES
        elif isinstance(field.dataType, T.StringType):
            primitives = DISCRETE_PRIMITIVES
        else:
            continue
        found += [FeatureDef(day_feature_name(p, name, field.name), name, field.name, p) for p in primitives]
    found += [
        FeatureDef(day_feature_name("count", name, f"where_{label}"), name, label, "count_where")
        for label in (where or {})
    ]
    return found


def _numeric_aggregate(primitive: str, column: str) -> Column:
    value = F.col(column).cast("double") if primitive != "percent_true" else F.col(column)
    return {
        "sum": lambda: F.coalesce(F.sum(value), F.lit(0.0)),
        "std": lambda: F.stddev_samp(value),
        "max": lambda: F.max(value),
        "skew": lambda: sample_skew(value),
        "min": lambda: F.min(value),
        "mean": lambda: F.avg(value),
        "percent_true": lambda: percent_true(value),
    }[primitive]()


def day_aggregates(
    entity: DataFrame, definitions: Sequence[FeatureDef], where: dict[str, Column] | None = None
) -> DataFrame:
    """One row per day with the defined aggregates, from one scan of the entity.

    Each row is stacked: a first slot carries its numbers, flags and predicates, and a slot
    for each discrete column its value. One aggregation by (date, slot, value) combines the
    numbers and counts the values before the shuffle, so that no task holds the values of
    a busy day; a second one by date picks the numbers and reduces the counts to distinct counts
    and modes.
    """
    discrete = list(dict.fromkeys(d.column for d in definitions if d.primitive in DISCRETE_PRIMITIVES))
    known = entity.dropna(subset=["date"])
    if not discrete:
        return known.groupBy("date").agg(*[_plain(d, d.column if d.primitive != "count_where" else where[d.column]) for d in definitions])

    carried = {d.column: F.col(d.column) for d in definitions if d.column and d.primitive not in (*DISCRETE_PRIMITIVES, "count_where")}
    carried |= {f"__where_{d.column}": where[d.column] for d in definitions if d.primitive == "count_where"}
    rows = known.select("date", *[c.alias(name) for name, c in carried.items()], *[F.col(c).alias(f"__value_{i}") for i, c in enumerate(discrete)])
    kinds = {f.name: f.dataType for f in rows.schema}
    numbers = F.struct(F.lit(-1).alias("__slot"), F.lit(None).cast("string").alias("__value"), *[F.col(c) for c in carried])
    slots = [
        F.struct(F.lit(i).alias("__slot"), F.col(f"__value_{i}").alias("__value"), *[F.lit(None).cast(kinds[c]).alias(c) for c in carried])
        for i in range(len(discrete))
    ]
    stacked = rows.select("date", F.inline(F.array(numbers, *slots))).filter("__slot = -1 or __value is not null")
    plain = [d for d in definitions if d.primitive not in (*DISCRETE_PRIMITIVES, "count")]
    counted = stacked.groupBy("date", "__slot", "__value").agg(
        F.count(F.lit(1)).alias("__votes"),
        *[_plain(d, F.col(f"__where_{d.column}") if d.primitive == "count_where" else d.column) for d in plain],
    )
    first = F.col("__slot") == -1
    per_day = []
    for d in definitions:
        if d.primitive == "count":
            per_day.append(F.max(F.when(first, F.col("__votes"))).alias(d.name))
        elif d.primitive in DISCRETE_PRIMITIVES:
            mine = F.col("__slot") == discrete.index(d.column)
            value = F.count_if(mine) if d.primitive == "num_unique" else winner(F.col("__value"), F.col("__votes"), mine)
            per_day.append(value.alias(d.name))
        else:
            # A day has one group of numbers.
            per_day.append(F.max(F.when(first, F.col(d.name))).alias(d.name))
    return counted.groupBy("date").agg(*per_day)


def _plain(definition: FeatureDef, value: str | Column) -> Column:
    if definition.primitive == "count":
        return F.count(F.lit(1)).alias(definition.name)
    if definition.primitive == "count_where":
        return F.count_if(value).alias(definition.name)
    return _numeric_aggregate(definition.primitive, value).alias(definition.name)


def transform_features(
    facts: DataFrame,
    date: str = "date",
    texts: Sequence[str] = (),
    points: Sequence[tuple[tuple[str, str], tuple[str, str]]] = (),
    unit: str = "miles",
) -> DataFrame:
    """Columns derived from the row itself: date parts, text sizes, distances."""
    day = F.col(date)
    added = {
        f"day__{date}": F.dayofmonth(day),
        f"week__{date}": F.weekofyear(day),
        f"month__{date}": F.month(day),
        f"weekday__{date}": iso_weekday(day) - 1,
    }
    for text in texts:
        added[f"num_words__{text}"] = num_words(F.col(text))
        added[f"num_characters__{text}"] = num_characters(F.col(text))
    for (lat1, lon1), (lat2, lon2) in points:
        distance = haversine(F.col(lat1), F.col(lon1), F.col(lat2), F.col(lon2), unit)
        added[f"haversine__{lat1}__{lat2}"] = distance
    return facts.withColumns(added)


def transform_definitions(date: str = "date", texts: Sequence[str] = ()) -> list[FeatureDef]:
    found = [FeatureDef(f"{p}__{date}", "sales", date, p) for p in DATE_PRIMITIVES]
    return found + [FeatureDef(f"{p}__{t}", "sales", t, p) for t in texts for p in TEXT_PRIMITIVES]


def direct_features(calendar: DataFrame, prefix: str = "days") -> DataFrame:
    """Calendar columns under the names they get on sales rows."""
    return calendar.select(
        "state", "date", *[F.col(c).alias(f"{prefix}__{c}") for c in calendar.columns if c not in ("state", "date")]
    )


def direct_definitions(calendar: DataFrame) -> list[FeatureDef]:
    return [
        FeatureDef(f"days__{c}", "days", c, "direct") for c in calendar.columns if c not in ("state", "date")
    ]


def attach_day_aggregates(
    facts: DataFrame, per_day: DataFrame, definitions: Sequence[FeatureDef], days: int | None = None
) -> DataFrame:
    """Left join on the day, by broadcast while the aggregate is small, so that
    facts of one busy day are not moved to one task.

    ``days`` bounds the rows of the aggregate. Without it, the aggregate is stored
    and counted.
    """
    side = small_side(per_day, days) if days else small_side(settle(per_day, "day-aggregates"))
    joined = facts.join(side, "date", "left")
    counts = [d.name for d in definitions if d.primitive in ("count", "count_where")]
    return joined.withColumns({c: F.coalesce(c, F.lit(0)) for c in counts})


def build_features(
    curated: DataFrame,
    stores: DataFrame,
    calendar: DataFrame,
    entities: dict[str, DataFrame] | None = None,
    texts: Sequence[str] = (),
    include_target: bool = False,
    with_lags: bool = False,
    days: int | None = None,
) -> tuple[DataFrame, list[FeatureDef]]:
    """Features of history and days to predict in one table, so that every split
    has the same definitions.

    Same-day aggregates of the target are known only in training and are left out
    unless ``include_target`` is set. ``with_lags`` adds day-based lags of the
    target, which look back only. ``stores`` is the store dimension and ``calendar`` comes from :func:`demandkit.operators.calendar.calendar_of`.
    ``days`` is the number of days that all tables are trimmed to.
    """
    features = transform_features(sales_lags(curated) if with_lags else curated, texts=texts)
    definitions = transform_definitions(texts=texts) + direct_definitions(calendar)
    if with_lags:
        definitions += [FeatureDef(name, "sales", TARGET, "lag") for name in LAG_COLUMNS]
    placed = features.join(small_side(stores.select("store", "state")), "store", "left")
    features = placed.join(direct_features(calendar), ["state", "date"], "left")

    dated = {"sales": curated, **(entities or {})}
    for name, entity in dated.items():
        exclude = [k for k in KEYS if k != "product"] if name == "sales" else []
        if name == "sales" and not include_target:
            exclude.append(TARGET)
        mine = define_day_features(entity, name, exclude)
        features = attach_day_aggregates(features, day_aggregates(entity, mine), mine, days)
        definitions += mine
    return features, definitions


def definition_table(spark: SparkSession, definitions: Sequence[FeatureDef]) -> DataFrame:
    return spark.createDataFrame(
        [astuple(d) for d in definitions], "name string, entity string, column string, primitive string"
    )


def definition_coverage(features: DataFrame, definitions: Sequence[FeatureDef]) -> DataFrame:
    """Definitions with the number of rows that carry a value, in one pass."""
    counts = features.agg(*[F.count(F.col(d.name)).alias(d.name) for d in definitions])
    rows = [
        F.struct(
            F.lit(d.name).alias("name"),
            F.lit(d.entity).alias("entity"),
            F.lit(d.column).alias("column"),
            F.lit(d.primitive).alias("primitive"),
            F.col(d.name).alias("non_null"),
        )
        for d in definitions
    ]
    return counts.select(F.inline(F.array(*rows)))
