"""Explicit schemas of landed and curated tables."""

from __future__ import annotations

from pyspark.sql import types as T

#: Column types known in advance; register-specific columns are strings unless
#: the caller says otherwise.
SALES_TYPES = {
    "index": T.LongType(),
    "store": T.IntegerType(),
    "product": T.StringType(),
    "date": T.DateType(),
    "sales": T.DoubleType(),
}

# Columns of the scanner panel.
PANEL_SCHEMA = (
    "store int, brand string, week int, logmove double, feat string, price double, "
    "AGE60 double, EDUC double, ETHNIC double, INCOME double, HHLARGE double, WORKWOM double, "
    "HVAL150 double, SSTRDIST double, SSTRVOL double, CPDIST5 double, CPWVOL5 double"
)

#: Invoice documents: one page of the register's export with nested items.
INVOICE_SCHEMA = (
    "invoices array<struct<"
    "invoice_id: bigint, invoice_total: double, invoice_totalTip: double, invoice_address_city: string, "
    "invoice_deleted_at: timestamp, customerCategory_id: string, tableArea_id: string, "
    "paymentMethod_id: string, user_name: string, table_name: string, "
    "address: struct<company: string, city: string>, "
    "items: array<struct<"
    "item_id: bigint, invoice_id: bigint, item_qty: double, item_price: double, item_timestamp: timestamp, "
    "item_product_name: string, item_product_pricePerUnit: double, item_product_discountable: boolean, "
    "item_discountable: boolean, item_retour: boolean, item_expirationDate: timestamp, "
    "item_lineDiscountGross: double, item_invoiceDiscountGross: double, paymentMethod_id: string, "
    "productgroup_name: string>>>>"
)

WEATHER_MEASURES = (
    "Minimum Temperature",
    "Maximum Temperature",
    "Temperature",
    "Relative Humidity",
    "Heat Index",
    "Wind Speed",
    "Wind Gust",
    "Wind Direction",
    "Wind Chill",
    "Precipitation",
    "Snow Depth",
    "Cloud Cover",
)
WEATHER_TYPES = {
    "Date time": T.StringType(),
    **{name: T.DoubleType() for name in WEATHER_MEASURES},
    "Chance Precipitation (%)": T.DoubleType(),
    "Snow": T.DoubleType(),
    "Dew Point": T.DoubleType(),
    "Precipitation Cover": T.DoubleType(),
    "Visibility": T.DoubleType(),
}
