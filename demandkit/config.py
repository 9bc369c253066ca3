"""Customer configuration: a TOML file becomes a dataclass plus a store table."""

from __future__ import annotations

import tomllib
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import DataType

STORE_SCHEMA = "store int, state string, city string, store_name string"


@dataclass(frozen=True)
class Store:
    store: int
    state: str
    city: str
    store_name: str


@dataclass(frozen=True)
class ForecastConfig:
    """Settings that change results. Horizon and grain are fixed by the data model."""

    country: str = "DE"
    register: str = "invoices"
    store: int = 1
    rows_per_page: int = 10
    horizons: tuple[str, ...] = ("tomorrow",)
    band: tuple[float, float] = (0.85, 1.15)
    rain_threshold: float = 0.5
    train_share: float = 0.75
    grace_days: int = 3
    #: Trees at most; boosting stops before that once the test set has gained nothing for
    #: ``patience`` rounds.
    max_iter: int = 100
    patience: int = 20
    stores: tuple[Store, ...] = field(default_factory=tuple)
    #: Types of register attributes by column ("double", "boolean", "string"): numbers
    #: are averaged over a day, others voted on.
    attributes: tuple[tuple[str, str], ...] = ()

    def attribute_types(self) -> dict[str, DataType]:
        return {name: DataType.fromDDL(ddl) for name, ddl in self.attributes}

    def for_store(self, store: int) -> "ForecastConfig":
        if store not in {s.store for s in self.stores}:
            raise KeyError(f"store {store} is not configured")
        return replace(self, store=store)


#: Horizon switches of the customer file, in display order.
HORIZON_SWITCHES = {
    "tomorrow": "tomorrow",
    "day_after_tomorrow": "day_after_tomorrow",
    "next_seven_days": "next_seven_days",
}


def load_config(path: str) -> ForecastConfig:
    with open(path, "rb") as handle:
        doc = tomllib.load(handle)
    base = doc.get("base", {})
    stores = tuple(
        Store(int(s["store"]), s["state"], s["city"], s["store_name"]) for s in doc.get("stores", [])
    )
    horizons = tuple(h for key, h in HORIZON_SWITCHES.items() if base.get(key))
    return ForecastConfig(
        country=base.get("country", "DE"),
        register=base.get("register_plugin_name", "invoices"),
        store=int(base.get("store", 1)),
        rows_per_page=int(base.get("rows_per_page", 10)),
        horizons=horizons or ("tomorrow",),
        grace_days=int(base.get("grace_days", 3)),
        stores=stores,
        attributes=tuple((name, str(ddl)) for name, ddl in doc.get("attributes", {}).items()),
    )


def store_table(spark: SparkSession, stores) -> DataFrame:
    """The store dimension; its size is the length of the configured list."""
    return spark.createDataFrame([(s.store, s.state, s.city, s.store_name) for s in stores], STORE_SCHEMA)
