"""The forecast job: landed tables -> curated sales -> features -> order table.

Every stage takes and returns DataFrames. Stage tables are written once and read
by the steps after them, as train, evaluate and score all need the same rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from demandkit.config import ForecastConfig, store_table
from demandkit.operators.calendar import calendar_of
from demandkit.operators.checks import assert_empty, duplicate_ids, entity_problems
from demandkit.operators.features import FeatureDef, build_features
from demandkit.operators.grain import TARGET, to_grain
from demandkit.operators.model import Trained, recent_mean_forecast, regression_metrics, score, train
from demandkit.operators.serve import order_table
from demandkit.operators.splits import Bounds, assign_split, entity_violations, fetch_bounds, split_sizes, split_violations, trim
from demandkit.operators.template import future_template, recent_profile, with_template
from demandkit.operators.weather import weather_by_day
from demandkit.runtime import names_in, scratch, settle
from demandkit.sources import files
from demandkit.sources.registry import load_sales


@dataclass(frozen=True)
class Curated:
    """Daily history, the recent profile of each pair, and history plus template."""

    history: DataFrame
    profile: DataFrame
    sales: DataFrame


def curate_sales(lines: DataFrame, checked: bool = False) -> Curated:
    history = settle(to_grain(lines), "sales-history")
    if checked:
        assert_empty(entity_problems("sales", history, target=True), "entity columns")
    profile = settle(recent_profile(history, measures_too=(TARGET,)), "recent-profile")
    return Curated(history, profile, with_template(history, future_template(profile)))


def baseline_orders(lines: DataFrame, band: tuple[float, float]) -> DataFrame:
    """Lines -> order table with the recent-mean forecast, reading the lines once.

    Only one row per pair is stored on the way.
    """
    profile = settle(recent_profile(to_grain(lines), measures_too=(TARGET,)), "recent-profile")
    return order_table(recent_mean_forecast(profile), band)


@dataclass(frozen=True)
class FeatureSet:
    features: DataFrame
    definitions: list[FeatureDef]
    bounds: Bounds


def prepare_features(
    sales: DataFrame,
    stores: DataFrame,
    states: list[str],
    entities: dict[str, DataFrame] | None = None,
    config: ForecastConfig = ForecastConfig(),
    checked: bool = False,
    with_lags: bool = False,
) -> FeatureSet:
    """Curated sales -> stored, labelled feature table for all sets.

    With ``checked``, every entity must have its columns, and enough days in the sets
    that have history.
    """
    curated = settle(sales, "curated-sales")
    bounds = fetch_bounds(curated, config.train_share)
    calendar = calendar_of(curated, states)
    trimmed = {name: trim(entity, bounds) for name, entity in (entities or {}).items()}
    if checked:
        assert_empty([p for name, entity in trimmed.items() for p in entity_problems(name, entity)], "entity columns")
        assert_empty(entity_violations({"sales": curated, **trimmed}, bounds), "sizes and bounds by entity")
    features, definitions = build_features(
        curated, stores, calendar, trimmed, with_lags=with_lags, days=(bounds.end - bounds.start).days + 1
    )
    labelled = settle(assign_split(features, bounds), "features")
    if checked:
        assert_empty(split_violations(split_sizes(labelled), bounds), "split sizes and bounds")
    return FeatureSet(labelled, definitions, bounds)


@dataclass(frozen=True)
class Forecast:
    trained: Trained
    evaluation: DataFrame
    predictions: DataFrame


def train_and_score(features: DataFrame, **options) -> Forecast:
    trained = train(features, **options)
    rows = trained.features
    tested = score(trained.evaluation, rows.filter(F.col("split") == "test"))
    predicted = score(trained.production, rows.filter(F.col("split") == "predict"))
    return Forecast(trained, tested, predicted)


def run_forecast(
    lines: DataFrame,
    stores: DataFrame,
    states: list[str],
    entities: dict[str, DataFrame] | None = None,
    config: ForecastConfig = ForecastConfig(),
    with_lags: bool = False,
    **options,
) -> tuple[DataFrame, Forecast]:
    """All stages in order; a failed check stops the job."""
    if "index" in lines.columns:
        assert_empty(duplicate_ids(lines), "one line per row id")
    curated = curate_sales(lines, checked=True)
    prepared = prepare_features(curated.sales, stores, states, entities, config, True, with_lags)
    forecast = train_and_score(prepared.features, **options)
    predictions = settle(forecast.predictions, "predictions")
    return settle(order_table(predictions, config.band), "orders", partition_by=["store"]), forecast


def run_landed(
    spark: SparkSession, config: ForecastConfig, landing: str, out: str, with_lags: bool = False, **options
) -> DataFrame:
    """The whole job over a landing folder.

    ``landing`` holds ``sales/`` (CSV files of sales lines, or what the configured
    register source reads), ``weather/``, ``weather_forecast/`` and, if there are further
    entities, ``entities/`` with a Parquet table each. ``out`` gets a new version with the order
    table by store, the evaluation and the models; stage tables are removed. Returns the
    stored order table.
    """
    with files.new_version(spark, out) as version, scratch(spark, "run"):
        if config.register == "csv":
            lines = files.scan_csv_folder(spark, f"{landing}/sales", config.attribute_types())
        else:
            lines = load_sales(spark, config, f"{landing}/sales")
        by_day = weather_by_day(
            files.scan_weather_history(spark, f"{landing}/weather"),
            files.scan_weather_forecast(spark, f"{landing}/weather_forecast"),
            config.rain_threshold,
        )
        found = files.discover_entities(spark, f"{landing}/entities") if names_in(spark, f"{landing}/entities") else {}
        entities = found | {"weather": settle(by_day, "weather")}
        states = sorted({s.state for s in config.stores})
        stores = store_table(spark, config.stores)
        options = {"max_iter": config.max_iter, "patience": config.patience} | options
        orders, forecast = run_forecast(lines, stores, states, entities, config, with_lags, **options)
        files.write_stage(orders, f"{version}/orders", ["store"])
        files.write_stage(regression_metrics(forecast.evaluation), f"{version}/evaluation")
        forecast.trained.evaluation.save(f"{version}/model_evaluation")
        forecast.trained.production.save(f"{version}/model_production")
        schema = orders.schema
    return spark.read.schema(schema).parquet(f"{version}/orders").select(*schema.names)
