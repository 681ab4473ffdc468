"""Cities and channels."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.functions import expressions as X
from tallyhouse.plans.star import Star, line_mean


def city_year_share(star: Star) -> DataFrame:
    """City by year with share and rank; the windows see one row per city and year."""
    grouped = (
        star.dated_orders()
        .join(star.geography.select("geography_sk", "city_name", "country"), "geography_sk")
        .groupBy("city_name", "country", "year_number")
        .agg(
            F.count_distinct("order_id").alias("total_orders"),
            F.count_distinct("customer_sk").alias("unique_customers"),
            F.sum("net_revenue").alias("net_revenue"),
            line_mean().alias("avg_order_value"),
            F.sum("quantity").alias("units_sold"),
        )
    )
    in_year = Window.partitionBy("year_number")
    return grouped.withColumns(
        {
            "city_revenue_share_pct": X.pct("net_revenue", F.sum("net_revenue").over(in_year)),
            "city_rank": F.rank().over(in_year.orderBy(F.desc("net_revenue"))),
        }
    ).orderBy("year_number", F.desc("net_revenue"), "city_name")


def named_items(star: Star) -> DataFrame:
    """Lines with their category."""
    return star.items.join(star.products.select("product_sk", "category"), "product_sk")


def city_category(star: Star) -> DataFrame:
    return (
        named_items(star)
        .join(star.geography.select("geography_sk", "city_name"), "geography_sk")
        .groupBy("city_name", "category")
        .agg(
            F.sum("net_revenue").alias("net_revenue"),
            F.count_distinct("order_id").alias("total_orders"),
            F.sum("quantity").alias("units_sold"),
        )
        .orderBy("city_name", F.desc("net_revenue"), "category")
    )


def channel_share(star: Star) -> DataFrame:
    grouped = (
        star.dated_items()
        .join(star.channels.select("channel_sk", "channel_name", "channel_type"), "channel_sk")
        .groupBy("channel_name", "channel_type", "year_number")
        .agg(
            F.count_distinct("order_id").alias("total_orders"),
            F.count_distinct("customer_sk").alias("unique_customers"),
            F.sum("net_revenue").alias("net_revenue"),
            F.avg("net_revenue").alias("avg_order_value"),
            F.sum("quantity").alias("units_sold"),
        )
    )
    year_total = F.sum("net_revenue").over(Window.partitionBy("year_number"))
    return grouped.withColumn("channel_revenue_share_pct", X.pct("net_revenue", year_total)).orderBy(
        "year_number", F.desc("net_revenue"), "channel_name"
    )


def channel_category(star: Star) -> DataFrame:
    return (
        named_items(star)
        .join(star.channels.select("channel_sk", "channel_name"), "channel_sk")
        .groupBy("channel_name", "category")
        .agg(
            F.sum("net_revenue").alias("net_revenue"),
            F.count_distinct("customer_sk").alias("customers"),
            F.avg("net_revenue").alias("avg_order_value"),
        )
        .orderBy("channel_name", F.desc("net_revenue"), "category")
    )
