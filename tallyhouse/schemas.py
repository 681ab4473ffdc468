"""Column lists and schemas of the source, the layers and the star."""

from __future__ import annotations

from pyspark.sql import types as T

# Column names, their order and types are those of the source files and of the star.

MONEY = T.DecimalType(18, 2)
RATIO = T.DecimalType(10, 4)

SOURCE_COLUMNS = (
    "order_item_id", "order_id", "product_id", "quantity", "customer_id",
    "order_date", "total_amount", "name", "city", "email", "signup_date",
    "product_name", "category", "price",
)
SOURCE_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in SOURCE_COLUMNS])

CRITICAL_KEYS = ("order_item_id", "order_id", "product_id", "customer_id")
AUDIT_COLUMNS = ("etl_load_id", "etl_load_date", "etl_source_file")

STAGING_RENAMES = {"net_revenue": "total_amount", "name": "customer_name", "price": "unit_price"}
STAGING_COLUMNS = (
    "order_item_id", "order_id", "product_id", "customer_id", "quantity",
    "net_revenue", "order_date", "name", "city", "email", "signup_date",
    "product_name", "category", "price", "dq_email_valid", "dq_date_valid",
)

DIM_CUSTOMER_COLUMNS = (
    "customer_id", "customer_name", "email", "signup_date", "signup_year",
    "signup_month", "city", "country", "region", "customer_segment",
    "total_orders", "total_lifetime_value", "created_date",
    "last_updated_date", "is_active",
)
DIM_PRODUCT_COLUMNS = (
    "product_id", "product_name", "category", "unit_price", "price_band",
    "created_date", "last_updated_date", "is_active",
)
FACT_ITEM_COLUMNS = (
    "order_date_key", "customer_sk", "product_sk", "geography_sk", "channel_sk",
    "order_id", "order_item_id", "quantity", "unit_price", "gross_revenue",
    "net_revenue", "discount_amount", "discount_pct", "customer_tenure_days",
    "etl_load_id",
)

GEOGRAPHY_SCHEMA = (
    "geography_sk long, city_name string, governorate string, country string, "
    "country_code string, region string, continent string, "
    "latitude decimal(9,6), longitude decimal(9,6)"
)
CHANNEL_SCHEMA = "channel_sk long, channel_name string, channel_type string, channel_category string"

CONTROL_SCHEMA = (
    "run_seq long, pipeline_name string, last_loaded_date date, last_run_start timestamp, "
    "last_run_end timestamp, last_run_status string, rows_loaded long, etl_load_id string, rows_rejected long"
)
