"""Product rankings and ABC classes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.functions import expressions as X
from tallyhouse.functions import rules
from tallyhouse.operators.frequent import totals_by_key
from tallyhouse.operators.ordering import rank_globally
from tallyhouse.plans.star import Star

PRODUCT_COLUMNS = ("product_sk", "product_id", "product_name", "category", "price_band", "unit_price")


def _sums(star: Star) -> DataFrame:
    totals = {
        "total_units_sold": (F.sum, "quantity"),
        "total_net_revenue": (F.sum, "net_revenue"),
        "total_gross_revenue": (F.sum, "gross_revenue"),
        "line_count": (F.count, None),
    }
    return totals_by_key(star.items, "product_sk", totals, "order_id", "total_orders")


def product_totals(star: Star) -> DataFrame:
    """Lines summed per product before the dimension is joined."""
    return _sums(star).join(star.products.select(*PRODUCT_COLUMNS), "product_sk")


def top_products(star: Star, limit: int = 20) -> DataFrame:
    """The best sellers with their rank inside the category.

    A product that outranks a listed one in its category earns more than it and
    is therefore listed too, so ranking the listed rows gives the ranks among
    all products without a window over every category.
    """
    best = _sums(star).orderBy(F.desc("total_net_revenue"), "product_sk").limit(limit)
    best = best.join(star.products.select(*PRODUCT_COLUMNS), "product_sk")
    in_category = Window.partitionBy("category").orderBy(F.desc("total_net_revenue"))
    return best.select(
        "product_id",
        "product_name",
        "category",
        "price_band",
        "unit_price",
        "total_orders",
        "total_units_sold",
        "total_net_revenue",
        "total_gross_revenue",
        F.round(X.safe_ratio("total_units_sold", "line_count"), 4).alias("avg_qty_per_order"),
        F.rank().over(in_category).alias("rank_in_category"),
    ).orderBy(F.desc("total_net_revenue"), "product_id")


def _cumulative(star: Star) -> DataFrame:
    return rank_globally(
        product_totals(star),
        "total_net_revenue",
        "product_id",
        descending=True,
        running={"running_revenue": "total_net_revenue"},
        totals={"grand_total_revenue": "running_revenue"},
    )


def abc_classification(star: Star, cuts=rules.ABC_CUTS) -> DataFrame:
    """Running share of revenue from the best product down, cut into three classes."""
    return (
        _cumulative(star)
        .select(
            "product_id",
            "product_name",
            "category",
            F.col("total_net_revenue").alias("net_revenue"),
            F.col("total_units_sold").alias("units_sold"),
            F.col("total_orders").alias("order_count"),
            X.pct("total_net_revenue", "grand_total_revenue").alias("revenue_pct"),
            X.pct("running_revenue", "grand_total_revenue").alias("cumulative_pct"),
            X.abc_class("running_revenue", "grand_total_revenue", cuts).alias("abc_class"),
        )
        .orderBy(F.desc("net_revenue"), "product_id")
    )


def pareto(star: Star) -> DataFrame:
    """Revenue per product with the cumulative percentage."""
    return (
        _cumulative(star)
        .select(
            "product_id",
            "product_name",
            F.col("total_net_revenue").alias("net_revenue"),
            X.pct("running_revenue", "grand_total_revenue").alias("cumulative_pct"),
        )
        .orderBy(F.desc("net_revenue"), "product_id")
    )
