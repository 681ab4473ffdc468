"""Dashboard measures as frames."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.functions import expressions as X
from tallyhouse.operators.frequent import totals_by_key
from tallyhouse.plans.customers import customer_activity, order_counts, rfm_inputs
from tallyhouse.plans.star import Star, line_mean

MONTH_NAMES = (
    "January", "February", "March", "April", "May", "June",
    "July", "August", "September", "October", "November", "December",
)
SEGMENTS = ("High Value", "Regular", "New", "Developing")


def exec_kpis(star: Star) -> DataFrame:
    totals = star.order_lines().agg(
        F.sum("net_revenue").alias("total_revenue"),
        F.count_distinct("order_id").alias("total_orders"),
        F.count_distinct("customer_sk").alias("unique_customers"),
        F.sum("quantity").alias("total_units_sold"),
        F.sum("discount_amount").alias("_discount"),
        F.sum("gross_revenue").alias("_gross"),
    )
    return totals.select(
        "total_revenue",
        "total_orders",
        "unique_customers",
        F.round(X.safe_ratio("total_revenue", "total_orders"), 4).alias("avg_order_value"),
        "total_units_sold",
        F.round(X.safe_ratio("_discount", "_gross"), 6).alias("discount_rate"),
    )


def revenue_orders_trend(star: Star) -> DataFrame:
    return (
        star.dated_orders()
        .groupBy("year_month")
        .agg(F.sum("net_revenue").alias("net_revenue"), F.count_distinct("order_id").alias("total_orders"))
        .orderBy("year_month")
    )


def yoy_month_matrix(star: Star, years: list[int] | None = None) -> DataFrame:
    """Month names down, years across: all that have orders, or the given ones."""
    revenue = F.sum("net_revenue")
    if years is None:
        found = star.dated_orders().select("year_number").distinct().collect()  # one row per year
        years = sorted(r["year_number"] for r in found)
    return (
        star.dated_orders()
        .groupBy("month_number", "month_name")
        .pivot("year_number", years)
        .agg(revenue)
        .withColumnsRenamed({str(y): f"y{y}" for y in years})
        .orderBy("month_number")
    )


def seasonality_matrix(star: Star) -> DataFrame:
    """Years down, the twelve months across."""
    pivoted = star.dated_orders().groupBy("year_number").pivot("month_name", list(MONTH_NAMES)).agg(F.sum("net_revenue"))
    return pivoted.withColumnsRenamed({m: m[:3].lower() for m in MONTH_NAMES}).orderBy("year_number")


def category_revenue(star: Star) -> DataFrame:
    """Lines are summed per product before they meet the categories."""
    return (
        star.items.groupBy("product_sk")
        .agg(F.sum("net_revenue").alias("net_revenue"))
        .join(star.products.select("product_sk", "category"), "product_sk")
        .groupBy("category")
        .agg(F.sum("net_revenue").alias("net_revenue"))
    )


def best_category(star: Star) -> DataFrame:
    return category_revenue(star).orderBy(F.desc("net_revenue"), "category").limit(1)


def avg_catalog_price(star: Star) -> DataFrame:
    return star.products.agg(F.avg("unit_price").alias("avg_unit_price"))


def category_trend(star: Star) -> DataFrame:
    """Category by month, from the monthly product fact."""
    return (
        star.monthly.groupBy("year_month_key", "product_sk")
        .agg(F.sum("total_net_revenue").alias("net_revenue"))
        .join(star.products.select("product_sk", "category"), "product_sk")
        .groupBy("category", F.col("year_month_key").alias("year_month"))
        .agg(F.sum("net_revenue").alias("net_revenue"))
        .orderBy("year_month", "category")
    )


def price_band_distribution(star: Star) -> DataFrame:
    return (
        star.items.join(star.products.select("product_sk", "price_band"), "product_sk")
        .groupBy("price_band")
        .agg(F.count_distinct("order_id").alias("total_orders"), F.sum("net_revenue").alias("net_revenue"))
    )


def customer_ltv(star: Star) -> DataFrame:
    """Revenue per customer, whatever else is filtered."""
    return star.orders.groupBy("customer_sk").agg(F.sum("order_net_revenue").alias("customer_ltv")).join(
        star.customers.select("customer_sk", "customer_id"), "customer_sk"
    ).select("customer_id", "customer_ltv")


def avg_customer_ltv(star: Star) -> DataFrame:
    return (
        star.orders.groupBy("customer_sk")
        .agg(F.sum("order_net_revenue").alias("ltv"))
        .agg(F.round(X.safe_ratio(F.sum("ltv"), F.count(F.lit(1))), 4).alias("avg_customer_ltv"))
    )


def repeat_buyers(star: Star, orders: int = 2) -> DataFrame:
    return order_counts(star).agg(F.count_if(F.col("order_count") >= orders).alias("repeat_buyers"))


def at_risk_customers(star: Star, as_of: date, days: int = 90) -> DataFrame:
    """Customers without an order for ``days`` or more at ``as_of``."""
    quiet = customer_activity(star).withColumn("days_since_last_purchase", F.datediff(F.lit(as_of), "last_order_date"))
    return (
        quiet.filter(F.col("days_since_last_purchase") >= days)
        .join(star.customers.select("customer_sk", "customer_id"), "customer_sk")
        .select("customer_id", "last_order_date", "days_since_last_purchase")
    )


def segment_breakdown(star: Star) -> DataFrame:
    return star.customers.groupBy("customer_segment").agg(F.count(F.lit(1)).alias("customers"))


def rfm_points(star: Star, as_of: date) -> DataFrame:
    return rfm_inputs(star, as_of).select(
        "customer_id", "recency_days", "frequency", "monetary_value", "customer_segment"
    )


def customer_acquisition(star: Star) -> DataFrame:
    return (
        star.customers.groupBy("signup_year", "signup_month")
        .agg(F.count(F.lit(1)).alias("new_customers"))
        .orderBy("signup_year", "signup_month")
    )


def top_customers(star: Star, limit: int = 20) -> DataFrame:
    """Best customers by value; sums per customer, then a top-k without a full sort."""
    people = star.customers.select("customer_sk", "customer_id", "customer_name", "city", "customer_segment")
    best = customer_activity(star).orderBy(F.desc("lifetime_value"), "customer_sk").limit(limit)
    return (
        best.join(people, "customer_sk")
        .select(
            "customer_id", "customer_name", "city", "total_orders", "lifetime_value", "last_order_date", "customer_segment"
        )
        .orderBy(F.desc("lifetime_value"), "customer_id")
    )


def city_segment_matrix(star: Star) -> DataFrame:
    """Cities down, segments across, distinct customers inside."""
    pairs = star.orders.select("geography_sk", "customer_sk").distinct()
    counted = (
        pairs.join(star.customers.select("customer_sk", "customer_segment"), "customer_sk")
        .groupBy("geography_sk", "customer_segment")
        .agg(F.count(F.lit(1)).alias("customers"))
        .join(star.geography.select("geography_sk", "city_name"), "geography_sk")
    )
    matrix = counted.groupBy("city_name").pivot("customer_segment", list(SEGMENTS)).agg(F.sum("customers"))
    names = {s: s.lower().replace(" ", "_") for s in SEGMENTS}
    return matrix.fillna(0, subset=list(SEGMENTS)).withColumnsRenamed(names).orderBy("city_name")


def category_mix_by_city(star: Star) -> DataFrame:
    """Category share of a city's revenue; the window sees one row per category."""
    grouped = (
        star.items.groupBy("geography_sk", "product_sk")
        .agg(F.sum("net_revenue").alias("net_revenue"))
        .join(star.products.select("product_sk", "category"), "product_sk")
        .groupBy("geography_sk", "category")
        .agg(F.sum("net_revenue").alias("net_revenue"))
        .join(star.geography.select("geography_sk", "city_name"), "geography_sk")
    )
    city_total = F.sum("net_revenue").over(Window.partitionBy("geography_sk"))
    return (
        grouped.withColumn("city_share_pct", X.pct("net_revenue", city_total))
        .select("city_name", "category", "net_revenue", "city_share_pct")
        .orderBy("city_name", "category")
    )


def city_revenue(star: Star) -> DataFrame:
    grouped = (
        star.order_lines()
        .groupBy("geography_sk")
        .agg(
            F.sum("net_revenue").alias("net_revenue"),
            F.count_distinct("order_id").alias("total_orders"),
            F.count_distinct("customer_sk").alias("unique_customers"),
            F.sum("line_count").alias("line_count"),
        )
    )
    return grouped.join(star.geography.select("geography_sk", "city_name"), "geography_sk").select(
        "city_name", "net_revenue", "total_orders", "unique_customers"
    )


def city_market_share(star: Star) -> DataFrame:
    """City totals and their share of all revenue."""
    cities = city_revenue(star)
    total = F.sum("net_revenue").over(Window.partitionBy())  # one row per city
    return cities.select(
        "*",
        F.round(X.safe_ratio("net_revenue", "total_orders"), 4).alias("avg_order_value"),
        X.pct("net_revenue", total).alias("market_share_pct"),
    ).orderBy(F.desc("net_revenue"), "city_name")


def _revenue_by_month(star: Star) -> DataFrame:
    """One row per calendar month with revenue."""
    return (
        star.dated_orders()
        .groupBy("year_number", "month_number", "year_month")
        .agg(F.sum("net_revenue").alias("net_revenue"), F.count_distinct("order_date_key").alias("active_days"))
        .withColumn("month_index", F.col("year_number") * 12 + F.col("month_number"))
    )


def revenue_yoy(star: Star) -> DataFrame:
    """Against the same month of the year before; null when that month has none."""
    now = _revenue_by_month(star)
    prior = now.select((F.col("month_index") + 12).alias("month_index"), F.col("net_revenue").alias("prior_year_revenue"))
    return (
        now.join(prior, "month_index", "left")
        .select(
            "year_month",
            "net_revenue",
            "prior_year_revenue",
            X.pct(F.col("net_revenue") - F.col("prior_year_revenue"), "prior_year_revenue").alias("yoy_pct"),
        )
        .orderBy("year_month")
    )


def revenue_ytd(star: Star) -> DataFrame:
    in_year = Window.partitionBy("year_number").orderBy("month_number").rowsBetween(Window.unboundedPreceding, 0)
    return (
        _revenue_by_month(star)
        .select("year_month", "net_revenue", F.sum("net_revenue").over(in_year).alias("ytd_revenue"))
        .orderBy("year_month")
    )


def revenue_3m_rolling(star: Star) -> DataFrame:
    """Mean daily revenue over the active days of three calendar months."""
    recent = Window.orderBy("month_index").rangeBetween(-2, 0)  # one row per month
    return (
        _revenue_by_month(star)
        .select(
            "year_month",
            F.round(X.safe_ratio(F.sum("net_revenue").over(recent), F.sum("active_days").over(recent)), 4).alias(
                "avg_daily_revenue_3m"
            ),
        )
        .orderBy("year_month")
    )


def weekday_weekend(star: Star) -> DataFrame:
    return (
        star.dated_orders()
        .groupBy("is_weekend")
        .agg(F.sum("net_revenue").alias("net_revenue"), F.count_distinct("order_id").alias("total_orders"))
    )


def qoq_waterfall(star: Star) -> DataFrame:
    """Change between consecutive quarters; one row per quarter."""
    quarters = star.dated_orders().groupBy("year_quarter").agg(F.sum("net_revenue").alias("net_revenue"))
    prior = F.lag("net_revenue").over(Window.orderBy("year_quarter"))
    return quarters.select(
        "year_quarter", "net_revenue", (F.col("net_revenue") - prior).alias("revenue_change")
    ).orderBy("year_quarter")


def product_matrix(star: Star) -> DataFrame:
    totals = {
        "units_sold": (F.sum, "quantity"),
        "net_revenue": (F.sum, "net_revenue"),
        "_priced": (F.count, "net_revenue"),
    }
    per_product = totals_by_key(star.items, "product_sk", totals, "order_id", "total_orders").select(
        "product_sk",
        "units_sold",
        "net_revenue",
        F.try_divide("net_revenue", "_priced").cast("decimal(22,6)").alias("avg_order_value"),
        "total_orders",
    )
    return (
        per_product.join(star.products.select("product_sk", "product_id", "product_name", "category"), "product_sk")
        .drop("product_sk")
        .orderBy(F.desc("net_revenue"), "product_id")
    )


def new_customers_month(star: Star) -> DataFrame:
    """Customers whose first order falls in the month."""
    first = star.orders.groupBy("customer_sk").agg(F.min("order_date_key").alias("first_key"))
    return (
        first.groupBy(X.month_text_of_key("first_key").alias("year_month"))
        .agg(F.count(F.lit(1)).alias("new_customers"))
        .orderBy("year_month")
    )
