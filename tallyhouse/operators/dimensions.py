"""Customer, product, geography and channel dimensions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.functions import expressions as X
from tallyhouse.functions import rules
from tallyhouse.operators.ordering import rank_globally
from tallyhouse.schemas import (
    CHANNEL_SCHEMA,
    DIM_CUSTOMER_COLUMNS,
    DIM_PRODUCT_COLUMNS,
    GEOGRAPHY_SCHEMA,
    MONEY,
)
from tallyhouse.session import literal_rows


# What tells deliveries of a line apart, the newest largest, where lines have it.
DELIVERED = ("delivered_at", "delivered_in")


def newest_rows(lines: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """``columns`` of each key's newest line, one row per key.

    One maximum of day, line id, delivery and values: rows of one line are settled by delivery, then by their values.  Tasks
    combine their lines first, so at most one row per key and task is moved, a frequent key's too.
    """
    delivered = [c for c in DELIVERED if c in lines.columns]
    line = (F.col("order_date").alias("_day"), F.col("order_item_id").cast("bigint").alias("_line"))
    newest = F.max(F.struct(*line, *delivered, *columns)).alias("latest")
    found = lines.filter(F.col(key).isNotNull()).groupBy(key).agg(newest)
    return found.select(key, *[F.col(f"latest.{c}").alias(c) for c in columns])


def _stamp(now):
    return (F.current_timestamp() if now is None else F.lit(now)).cast("timestamp")


def customer_attributes(lines: DataFrame) -> DataFrame:
    """Newest attributes, distinct orders and lifetime value, one row per customer."""
    totals = lines.groupBy("customer_id").agg(
        F.count_distinct("order_id").alias("total_orders"),
        F.sum("net_revenue").cast(MONEY).alias("total_lifetime_value"),
    )
    latest = newest_rows(lines, "customer_id", ("name", "email", "city", "signup_date"))
    return latest.join(totals, "customer_id").select(
        "customer_id",
        F.col("name").alias("customer_name"),
        "email",
        "signup_date",
        F.year("signup_date").alias("signup_year"),
        F.month("signup_date").alias("signup_month"),
        "city",
        "total_orders",
        "total_lifetime_value",
    )


def build_dim_customer(
    lines: DataFrame, now=None, high=rules.HIGH_VALUE_FROM, regular=rules.REGULAR_FROM
) -> DataFrame:
    stamp = _stamp(now)
    return (
        customer_attributes(lines)
        .withColumns(
            {
                "country": F.lit(rules.HOME_COUNTRY),
                "region": F.lit(rules.HOME_REGION),
                "customer_segment": X.customer_segment("total_lifetime_value", "total_orders", high, regular),
                "created_date": stamp,
                "last_updated_date": stamp,
                "is_active": F.lit(1),
            }
        )
        .select(*DIM_CUSTOMER_COLUMNS)
    )


def build_dim_product(lines: DataFrame, now=None, bands=rules.PRICE_BANDS) -> DataFrame:
    """Newest name, category and price per product, with the price's band."""
    stamp = _stamp(now)
    latest = newest_rows(lines, "product_id", ("product_name", "category", "price"))
    return latest.select(
        "product_id",
        "product_name",
        "category",
        F.col("price").alias("unit_price"),
        X.price_band("price", bands).alias("price_band"),
        stamp.alias("created_date"),
        stamp.alias("last_updated_date"),
        F.lit(1).alias("is_active"),
    ).select(*DIM_PRODUCT_COLUMNS)


def build_dim_geography(spark: SparkSession, with_unknown: bool = True) -> DataFrame:
    """The five seeded cities and, by default, an explicit Unknown member."""
    rows = [(sk, city, area, rules.HOME_COUNTRY, "EG", rules.HOME_REGION, "Africa", lat, lon)
            for sk, city, area, lat, lon in rules.GEOGRAPHY_SEED]
    if with_unknown:
        rows.append((rules.UNKNOWN_GEOGRAPHY_SK, "Unknown", None, "Unknown", "--", "Unknown", "Unknown", None, None))
    return literal_rows(spark, rows, GEOGRAPHY_SCHEMA)


def build_dim_channel(spark: SparkSession) -> DataFrame:
    return literal_rows(spark, [(sk, name, kind, None) for sk, name, kind in rules.CHANNEL_SEED], CHANNEL_SCHEMA)


def assign_surrogate_keys(incoming: DataFrame, natural_key: str, surrogate_key: str, existing: DataFrame | None = None) -> DataFrame:
    """Put a surrogate key in front of every row of ``incoming``.

    Known natural keys keep theirs; new ones continue after the largest, in
    natural-key order.
    """
    if existing is None:
        keyed = rank_globally(incoming, natural_key, natural_key, row_number=surrogate_key)
        return keyed.select(surrogate_key, *incoming.columns)
    known = existing.select(natural_key, surrogate_key)
    new = rank_globally(
        incoming.join(known, natural_key, "left_anti"), natural_key, natural_key, row_number="_rank"
    )
    last = existing.agg(F.coalesce(F.max(surrogate_key), F.lit(0)).alias("last")).scalar()
    added = new.withColumn(surrogate_key, F.col("_rank") + last).select(surrogate_key, *incoming.columns)
    kept = incoming.join(known, natural_key).select(surrogate_key, *incoming.columns)
    return kept.unionByName(added)


def customer_totals(items: DataFrame) -> DataFrame:
    return items.groupBy("customer_sk").agg(
        F.count_distinct("order_id").alias("new_orders"), F.sum("net_revenue").cast(MONEY).alias("new_value")
    )


def refresh_customer_stats(
    customers: DataFrame,
    items: DataFrame,
    now=None,
    keep_without_facts: bool = False,
    high=rules.HIGH_VALUE_FROM,
    regular=rules.REGULAR_FROM,
) -> DataFrame:
    """Orders, lifetime value and segment recomputed from the facts.

    Customers without facts drop to zero, or stay as they are when
    ``keep_without_facts`` is set.  The facts are summed per customer first, so
    the join meets one row per key on both sides.
    """
    joined = customers.join(customer_totals(items), "customer_sk", "left")
    orders = F.coalesce("new_orders", F.lit(0))
    value = F.coalesce("new_value", F.lit(0).cast(MONEY))
    segment = X.customer_segment(value, orders, high, regular)
    refreshed = {
        "total_orders": orders,
        "total_lifetime_value": value,
        "customer_segment": segment,
        "last_updated_date": _stamp(now),
    }
    if keep_without_facts:
        found = F.col("new_orders").isNotNull()
        refreshed = {name: F.when(found, new).otherwise(F.col(name)) for name, new in refreshed.items()}
    return joined.withColumns(refreshed).select(*customers.columns)
