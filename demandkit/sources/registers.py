"""The three register sources: invoice documents, scanner panel, replay."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from demandkit.functions.numbers import truncated_exp
from demandkit.schemas import INVOICE_SCHEMA, PANEL_SCHEMA
from demandkit.sources.registry import date_range, register

# Fields kept of an invoice row.
INVOICE_FIELDS = (
    "invoice_total",
    "invoice_totalTip",
    "invoice_address_city",
    "invoice_deleted_at",
    "customerCategory_id",
    "tableArea_id",
    "address.company",
    "address.city",
    "item_product_discountable",
    "item_product_pricePerUnit",
    "item_product_name",
    "item_qty",
    "item_timestamp",
    "item_retour",
    "item_expirationDate",
    "item_price",
    "item_lineDiscountGross",
    "item_invoiceDiscountGross",
    "item_discountable",
    "paymentMethod_id_x",
    "productgroup_name",
    "user_name",
    "table_name",
    "item_id",
)
# Register field -> column of the data model.
INVOICE_NAMES = {
    "item_timestamp": "date",
    "item_qty": "sales",
    "item_product_name": "product",
    "item_id": "index",
}
# Identifiers that are categories, not numbers.
CATEGORY_IDS = ("customerCategory_id", "tableArea_id", "paymentMethod_id_x")
CATEGORY_PREFIX = "cat_"

# Week 39 of the panel is mapped to this Monday.
PANEL_EPOCH = dt.date(2018, 1, 1)
PANEL_EPOCH_WEEK = 39
PANEL_FIELDS = (
    "store",
    "product",
    "sales",
    "date",
    "price",
    "AGE60",
    "EDUC",
    "ETHNIC",
    "INCOME",
    "HHLARGE",
    "WORKWOM",
    "HVAL150",
    "SSTRDIST",
    "SSTRVOL",
    "CPDIST5",
    "CPWVOL5",
)


def category_code(column: str) -> Column:
    """'cat_<id>'; NULL stays NULL."""
    return F.concat(F.lit(CATEGORY_PREFIX), F.col(column).cast("string"))


def flatten_invoices(documents: DataFrame) -> DataFrame:
    """Nested documents -> one row per item, nested objects under dotted names.

    Items are nested in their invoice, so no join is needed. Fields that both
    levels have get the suffixes ``_x`` (invoice) and ``_y`` (item).
    """
    invoices = documents.select(F.explode("invoices").alias("i"))
    rows = invoices.select("i", F.explode("i.items").alias("t"))
    header = {f.name: f for f in rows.schema["i"].dataType if f.name != "items"}
    items = [f.name for f in rows.schema["t"].dataType]
    both = (set(header) & set(items)) - {"invoice_id"}
    columns = []
    for name, field in header.items():
        if field.dataType.typeName() == "struct":
            columns += [F.col(f"i.{name}.{sub.name}").alias(f"{name}.{sub.name}") for sub in field.dataType]
        else:
            columns.append(F.col(f"i.{name}").alias(f"{name}_x" if name in both else name))
    columns += [F.col(f"t.{n}").alias(f"{n}_y" if n in both else n) for n in items if n != "invoice_id"]
    return rows.select(*columns)


def join_invoices(invoices: DataFrame, items: DataFrame, key: str = "invoice_id") -> DataFrame:
    """The same rows from two flat tables."""
    both = (set(invoices.columns) & set(items.columns)) - {key}
    left = invoices.withColumnsRenamed({c: f"{c}_x" for c in both})
    return left.join(items.withColumnsRenamed({c: f"{c}_y" for c in both}), key, "inner")


def sales_from_invoices(rows: DataFrame, store: int | Column = 1) -> DataFrame:
    """Flat invoice rows -> sales lines. Items of deleted invoices count zero."""
    kept = rows.select(*[F.col(f"`{name}`").alias(name) for name in INVOICE_FIELDS])
    store = store if isinstance(store, Column) else F.lit(store)
    return kept.withColumnsRenamed(INVOICE_NAMES).withColumns(
        {
            "store": store.cast("int"),
            "date": F.col("date").cast("date"),
            "sales": F.when(F.col("invoice_deleted_at").isNotNull(), F.lit(0.0)).otherwise(F.col("sales")),
            **{c: category_code(c) for c in CATEGORY_IDS},
        }
    )


@register("invoices")
def invoice_source(spark: SparkSession, path: str, store: int = 1, from_date=None, to_date=None) -> DataFrame:
    documents = spark.read.schema(INVOICE_SCHEMA).json(path)
    rows = date_range(flatten_invoices(documents), from_date, to_date, "item_timestamp")
    return sales_from_invoices(rows, store)


def panel_to_sales(panel: DataFrame) -> DataFrame:
    """Weekly log movements -> units per week, dated by the panel week."""
    days = (F.col("week") - PANEL_EPOCH_WEEK) * 7
    return panel.select(
        "*",
        F.col("brand").alias("product"),
        truncated_exp(F.col("logmove")).alias("sales"),
        F.date_add(F.lit(PANEL_EPOCH), days).alias("date"),
    ).select(*PANEL_FIELDS)


@register("panel")
def panel_source(spark: SparkSession, path: str, store: int = 1, from_date=None, to_date=None) -> DataFrame:
    """The panel has a store column of its own."""
    panel = spark.read.schema(PANEL_SCHEMA).option("header", True).csv(path)
    return date_range(panel_to_sales(panel), from_date, to_date)


@register("replay")
def replay_source(spark: SparkSession, path: str, store: int = 1, from_date=None, to_date=None) -> DataFrame:
    """Curated history read again; its rows already carry their store."""
    return date_range(spark.read.parquet(path), from_date, to_date)
