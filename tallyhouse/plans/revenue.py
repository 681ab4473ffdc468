"""Revenue over time, by category, and the one-row summary."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.functions import expressions as X
from tallyhouse.plans.star import Star, line_mean


def revenue_by_quarter(star: Star) -> DataFrame:
    grouped = star.dated_orders().groupBy("year_number", "quarter_number", "quarter_name", "year_quarter")
    return (
        grouped.agg(
            F.count_distinct("order_id").alias("total_orders"),
            F.count_distinct("customer_sk").alias("unique_customers"),
            F.sum("quantity").alias("total_units_sold"),
            F.sum("gross_revenue").alias("gross_revenue"),
            F.sum("net_revenue").alias("net_revenue"),
            F.sum("discount_amount").alias("total_discounts"),
            line_mean().alias("avg_order_item_value"),
        )
        .withColumn("revenue_per_customer", F.round(X.safe_ratio("net_revenue", "unique_customers"), 4))
        .orderBy("year_number", "quarter_number")
        .drop("quarter_number")
    )


def monthly_revenue(star: Star) -> DataFrame:
    return (
        star.dated_orders()
        .groupBy("year_month", "year_number", "month_number", "month_name")
        .agg(
            F.sum("net_revenue").alias("net_revenue"),
            F.count_distinct("order_id").alias("total_orders"),
            F.count_distinct("customer_sk").alias("unique_customers"),
        )
    )


def monthly_growth(star: Star) -> DataFrame:
    """Month-over-month growth and year-to-date; the windows see one row per month."""
    by_month = Window.orderBy("year_month")
    in_year = Window.partitionBy("year_number").orderBy("month_number").rowsBetween(Window.unboundedPreceding, 0)
    prior = F.lag("net_revenue").over(by_month)
    return (
        monthly_revenue(star)
        .withColumn("prior_month_revenue", prior)
        .withColumn("mom_growth_pct", X.pct(F.col("net_revenue") - F.col("prior_month_revenue"), "prior_month_revenue"))
        .withColumn("ytd_revenue", F.sum("net_revenue").over(in_year))
        .drop("month_number")
        .orderBy("year_month")
    )


def category_share(star: Star) -> DataFrame:
    """Category by year with its share of the year.

    Orders are counted beside the sums: one aggregate of both would move every sum's state with each order.
    """
    group = ("category", "year_number")
    lines = star.dated_items().join(star.products.select("product_sk", "category"), "product_sk")
    sums = lines.groupBy(*group).agg(
        F.sum("net_revenue").alias("net_revenue"),
        F.sum("gross_revenue").alias("gross_revenue"),
        F.sum("discount_amount").alias("total_discounts"),
        F.sum("quantity").alias("units_sold"),
        F.avg("unit_price").alias("avg_unit_price"),
    )
    orders = lines.groupBy(*group).agg(F.count_distinct("order_id").alias("total_orders"))
    orders = orders.withColumnsRenamed({c: f"_{c}" for c in group})
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in group]
    grouped = sums.join(orders, same).select(
        *group, "net_revenue", "gross_revenue", "total_discounts", "total_orders", "units_sold", "avg_unit_price"
    )
    year_total = F.sum("net_revenue").over(Window.partitionBy("year_number"))
    return grouped.withColumn("revenue_share_pct", X.pct("net_revenue", year_total)).orderBy(
        "year_number", F.desc("net_revenue"), "category"
    )


def kpi_summary(star: Star) -> DataFrame:
    return (
        star.dated_orders()
        .agg(
            F.sum("net_revenue").alias("total_net_revenue"),
            F.sum("gross_revenue").alias("total_gross_revenue"),
            F.sum("discount_amount").alias("total_discounts"),
            F.count_distinct("order_id").alias("total_orders"),
            F.count_distinct("customer_sk").alias("total_customers"),
            F.sum("line_count").alias("total_line_items"),
            F.sum("quantity").alias("total_units_sold"),
            F.min("full_date").alias("data_from_date"),
            F.max("full_date").alias("data_to_date"),
        )
        .withColumns(
            {
                "overall_discount_pct": X.pct("total_discounts", "total_gross_revenue"),
                "avg_order_item_value": F.round(X.safe_ratio("total_net_revenue", "total_line_items"), 2),
                "avg_basket_value": F.round(X.safe_ratio("total_net_revenue", "total_orders"), 2),
                "avg_customer_value": F.round(X.safe_ratio("total_net_revenue", "total_customers"), 2),
                "data_span_days": F.datediff("data_to_date", "data_from_date"),
            }
        )
    )
