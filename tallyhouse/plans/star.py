"""The star the analytics read."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Star:
    """Dimensions and facts as frames.

    ``orders`` is the order-grain fact.  It holds every additive measure, so
    questions that need neither product nor channel read it instead of the
    several times longer ``items``.
    """

    dates: DataFrame
    customers: DataFrame
    products: DataFrame
    geography: DataFrame
    channels: DataFrame
    items: DataFrame
    orders: DataFrame
    monthly: DataFrame

    def order_lines(self) -> DataFrame:
        """Order-grain measures under their line-grain names."""
        return self.orders.select(
            "order_date_key",
            "customer_sk",
            "geography_sk",
            "order_id",
            F.col("total_items").alias("line_count"),
            F.col("total_quantity").alias("quantity"),
            F.col("order_gross_revenue").alias("gross_revenue"),
            F.col("order_net_revenue").alias("net_revenue"),
            F.col("order_discount_amount").alias("discount_amount"),
        )

    def dated_orders(self) -> DataFrame:
        return self.order_lines().join(self.dates, F.col("order_date_key") == F.col("date_key"))

    def dated_items(self) -> DataFrame:
        return self.items.join(self.dates, F.col("order_date_key") == F.col("date_key"))


def line_mean(measure: str = "net_revenue", lines: str = "line_count") -> Column:
    """Mean per order line of a summed measure, six decimals."""
    return F.round(F.try_divide(F.sum(measure), F.sum(lines)), 6).cast("decimal(22,6)")


def slice_star(
    star: Star,
    date_from: date | None = None,
    date_to: date | None = None,
    categories: Sequence[str] | None = None,
    cities: Sequence[str] | None = None,
) -> Star:
    """Date, category and city slicers.

    Dates also become conditions on the partition columns, so unread months are
    skipped at the scan.  A category slice leaves only ``items`` meaningful at
    line level, so ``orders`` is summed again from the sliced lines.
    """
    items, orders = star.items, star.orders

    def dated(df: DataFrame) -> DataFrame:
        for bound, compare in ((date_from, "ge"), (date_to, "le")):
            if bound is None:
                continue
            key, month = bound.year * 10000 + bound.month * 100 + bound.day, bound.year * 12 + bound.month
            expressions = [(F.col("order_date_key"), key)]
            if {"order_year", "order_month"} <= set(df.columns):
                expressions.append((F.col("order_year"), bound.year))
                expressions.append((F.col("order_year") * 12 + F.col("order_month"), month))
            for column, limit in expressions:
                df = df.filter(column >= limit if compare == "ge" else column <= limit)
        return df

    items, orders = dated(items), dated(orders)
    if cities:
        places = star.geography.filter(F.col("city_name").isin(*cities)).select("geography_sk")
        items = items.join(places, "geography_sk", "left_semi")
        orders = orders.join(places, "geography_sk", "left_semi")
    if categories:
        from tallyhouse.operators.facts import build_fact_order_summary

        goods = star.products.filter(F.col("category").isin(*categories)).select("product_sk")
        items = items.join(goods, "product_sk", "left_semi")
        orders = build_fact_order_summary(items)
    return replace(star, items=items, orders=orders)
