"""The four analytic views."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.plans.customers import customer_activity
from tallyhouse.plans.products import PRODUCT_COLUMNS
from tallyhouse.plans.star import Star, line_mean


def vw_monthly_revenue(star: Star) -> DataFrame:
    return (
        star.dated_orders()
        .groupBy("year_month", "year_number", "month_name", "month_number")
        .agg(
            F.sum("net_revenue").alias("net_revenue"),
            F.sum("gross_revenue").alias("gross_revenue"),
            F.sum("discount_amount").alias("discounts"),
            F.count_distinct("order_id").alias("orders"),
            F.count_distinct("customer_sk").alias("customers"),
            F.sum("quantity").alias("units_sold"),
        )
    )


def vw_product_performance(star: Star) -> DataFrame:
    per_product = star.items.groupBy("product_sk").agg(
        F.sum("net_revenue").alias("total_revenue"),
        F.sum("quantity").alias("total_units"),
        F.count_distinct("order_id").alias("total_orders"),
        F.count_distinct("customer_sk").alias("unique_buyers"),
        F.avg("net_revenue").alias("avg_order_value"),
    )
    return per_product.join(star.products.select(*PRODUCT_COLUMNS), "product_sk").drop("product_sk")


def vw_city_performance(star: Star) -> DataFrame:
    per_city = (
        star.order_lines()
        .groupBy("geography_sk")
        .agg(
            F.sum("net_revenue").alias("total_revenue"),
            F.count_distinct("order_id").alias("total_orders"),
            F.count_distinct("customer_sk").alias("unique_customers"),
            line_mean().alias("avg_order_value"),
        )
    )
    places = star.geography.select("geography_sk", "city_name", "country", "latitude", "longitude")
    return per_city.join(places, "geography_sk").drop("geography_sk")


def vw_customer_360(star: Star, as_of: date | None = None) -> DataFrame:
    """Customer aggregates with the days since the last order, today or at ``as_of``."""
    today = F.current_date() if as_of is None else F.lit(as_of)
    people = star.customers.select(
        "customer_sk", "customer_id", "customer_name", "email", "city", "signup_date", "customer_segment"
    )
    return (
        customer_activity(star)
        .join(people, "customer_sk")
        .select(
            "customer_id",
            "customer_name",
            "email",
            "city",
            "signup_date",
            "customer_segment",
            "total_orders",
            "lifetime_value",
            "avg_order_value",
            "last_order_date",
            "first_order_date",
            F.datediff(today, "last_order_date").alias("days_since_last_order"),
        )
    )


VIEWS = {
    "vw_monthly_revenue": vw_monthly_revenue,
    "vw_product_performance": vw_product_performance,
    "vw_city_performance": vw_city_performance,
    "vw_customer_360": vw_customer_360,
}


def register_views(star: Star) -> None:
    """Temporary views for SQL readers."""
    for name, build in VIEWS.items():
        build(star).createOrReplaceTempView(name)
