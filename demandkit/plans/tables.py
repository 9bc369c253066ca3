"""The given tables in the roles of the data model.

Stores are regions, products are part types, sales lines are line items, invoices
are orders, hourly weather is the event stream.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from demandkit.functions.dates import WEATHER_TS_FORMAT
from demandkit.config import ForecastConfig
from demandkit.plans.stages import Curated, FeatureSet, baseline_orders, curate_sales, prepare_features, train_and_score
from demandkit.operators.serve import BAND
from demandkit.runtime import settle, small_side

STATES = ["HE", "RP"]
#: Days of the event stream that play the weather forecast, and by how many days
#: the forecast reaches back into history.
FORECAST_DAYS = 6
OVERLAP_DAYS = 1


_SCHEMAS: dict[str, StructType] = {}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A given table. Its schema is taken from the files once, not by a job for
    every read."""
    path = f"{sf}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def store_of_supplier(spark: SparkSession, sf: str) -> DataFrame:
    supplier, nation = table(spark, sf, "supplier"), table(spark, sf, "nation")
    return supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("s_suppkey").alias("l_suppkey"), F.col("n_regionkey").alias("store")
    )


def item_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Line items with store and product, before the order header is known.

    Suppliers and parts are broadcast as long as they are small, so that the lines move for
    the order header alone.
    """
    product = table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_type").alias("product"))
    return (
        table(spark, sf, "lineitem")
        .join(small_side(store_of_supplier(spark, sf)), "l_suppkey")
        .join(small_side(product), "l_partkey")
        .withColumn("date", F.col("l_shipdate").cast("date"))
    )


def sales_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Sales lines with numeric, boolean and categorical attributes; lines of
    pending orders count as deleted."""
    orders = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), "o_orderstatus", "o_orderpriority"
    )
    return item_lines(spark, sf).join(orders, "l_orderkey").select(
        "store",
        "product",
        "date",
        F.when(F.col("o_orderstatus") == "P", 0.0).otherwise(F.col("l_quantity")).alias("sales"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_discount").alias("discount"),
        F.col("l_returnflag").alias("returnflag"),
        F.col("o_orderpriority").alias("priority"),
        (F.col("l_linestatus") == "F").alias("fulfilled"),
    )


def stores(spark: SparkSession, sf: str) -> DataFrame:
    even = F.col("r_regionkey") % 2 == 0
    return table(spark, sf, "region").select(
        F.col("r_regionkey").alias("store"),
        F.when(even, "HE").otherwise("RP").alias("state"),
        F.initcap("r_name").alias("city"),
        F.concat(F.lit("Store "), F.col("r_regionkey").cast("string")).alias("store_name"),
    )


def order_entity(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as an extra dated entity."""
    return table(spark, sf, "orders").select(
        F.col("o_orderdate").cast("date").alias("date"),
        F.col("o_totalprice").alias("totalprice"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderpriority").alias("priority"),
        (F.col("o_orderpriority") == "1-URGENT").alias("urgent"),
    )


def observations(spark: SparkSession, sf: str) -> DataFrame:
    """Events as hourly weather rows in the landed shape (text timestamps)."""
    value = F.col("value")
    return table(spark, sf, "events").select(
        "event_id",
        F.col("ts").cast("date").alias("day"),
        F.date_format("ts", WEATHER_TS_FORMAT).alias("date_time"),
        (value - 1).alias("minimum_temperature"),
        (value + 1).alias("maximum_temperature"),
        value.alias("temperature"),
        (value / 2).alias("relative_humidity"),
        (value + 2).alias("heat_index"),
        (value / 4).alias("wind_speed"),
        (value / 8).alias("wind_gust"),
        (F.col("event_id") % 360).cast("double").alias("wind_direction"),
        (value - 3).alias("wind_chill"),
        (value / 16).alias("precipitation"),
        (F.col("user_id") % 5).cast("double").alias("snow_depth"),
        (F.col("user_id") % 100).cast("double").alias("cloud_cover"),
    )


def _last_day(rows: DataFrame) -> Column:
    return F.lit(rows.agg(F.max("day")).first()[0])


def weather_history(spark: SparkSession, sf: str) -> DataFrame:
    rows = observations(spark, sf)
    measured = rows.filter(F.col("day") <= F.date_sub(_last_day(rows), FORECAST_DAYS)).drop("day")
    return measured.withColumns(
        {c: F.lit("-") for c in ("dew_point", "info", "precipitation_cover", "visibility", "weather_type")}
    )


def weather_forecast(spark: SparkSession, sf: str) -> DataFrame:
    """Forecast values differ from what was measured in the overlap."""
    rows = observations(spark, sf)
    ahead = rows.filter(F.col("day") > F.date_sub(_last_day(rows), FORECAST_DAYS + OVERLAP_DAYS))
    return ahead.drop("day", "minimum_temperature", "maximum_temperature").withColumns(
        {
            "chance_precipitation": F.col("temperature") / 100,
            "snow": F.lit("-"),
            "temperature": F.col("temperature") + 10,
        }
    )


class Stages:
    """Stage tables of one session and one set of inputs, each written once."""

    _built: dict[tuple[str, str, str], object] = {}

    def __init__(self, spark: SparkSession, sf: str):
        self.spark, self.sf = spark, sf

    def _once(self, name: str, build):
        key = (self.spark.sparkContext.applicationId, self.sf, name)
        if key not in self._built:
            self._built[key] = build()
        return self._built[key]

    def curated(self) -> Curated:
        return self._once("curated", lambda: curate_sales(sales_lines(self.spark, self.sf)))

    def orders(self) -> DataFrame:
        """The baseline order table, partitioned by store for lookups."""
        return self._once(
            "orders",
            lambda: settle(baseline_orders(sales_lines(self.spark, self.sf), BAND), "orders", ["store"]),
        )

    def features(self) -> FeatureSet:
        return self._once(
            "features",
            lambda: prepare_features(
                self.curated().sales,
                stores(self.spark, self.sf),
                STATES,
                {"orders": order_entity(self.spark, self.sf)},
            ),
        )

    def forecasts(self) -> DataFrame:
        """What the boosted trees forecast for the days to predict."""

        def build() -> DataFrame:
            config = ForecastConfig()
            done = train_and_score(self.features().features, max_iter=config.max_iter, patience=config.patience)
            return settle(done.predictions, "predictions")

        return self._once("forecasts", build)
