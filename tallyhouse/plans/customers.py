"""Customer value, RFM, cohorts, repeat purchase."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.functions import expressions as X
from tallyhouse.functions import rules
from tallyhouse.operators.frequent import totals_by_key
from tallyhouse.operators.ordering import ntile_column, rank_globally
from tallyhouse.plans.star import Star
from tallyhouse.session import materialize


def customer_activity(star: Star) -> DataFrame:
    """Orders, units, value, first and last day, one row per customer."""
    totals = {
        "total_items_bought": (F.sum, "quantity"),
        "lifetime_value": (F.sum, "net_revenue"),
        "line_count": (F.sum, "line_count"),
        "first_key": (F.min, "order_date_key"),
        "last_key": (F.max, "order_date_key"),
    }
    return (
        totals_by_key(star.order_lines(), "customer_sk", totals, "order_id", "total_orders")
        .withColumns(
            {
                "first_order_date": X.date_of_key("first_key"),
                "last_order_date": X.date_of_key("last_key"),
                "avg_order_value": F.round(F.try_divide("lifetime_value", "line_count"), 6).cast("decimal(22,6)"),
            }
        )
        .drop("first_key", "last_key")
    )


def rfm_inputs(star: Star, as_of: date = rules.RFM_AS_OF) -> DataFrame:
    """Recency, frequency and monetary value per customer."""
    return (
        customer_activity(star)
        .join(star.customers.select("customer_sk", "customer_id", "customer_name", "city", "email", "customer_segment"), "customer_sk")
        .select(
            "customer_sk",
            "customer_id",
            "customer_name",
            "city",
            "email",
            "customer_segment",
            F.datediff(F.lit(as_of), "last_order_date").alias("recency_days"),
            F.col("total_orders").alias("frequency"),
            F.col("lifetime_value").alias("monetary_value"),
        )
    )


def rfm_segmentation(star: Star, as_of: date = rules.RFM_AS_OF, recency_best_high: bool = False) -> DataFrame:
    """Quintile scores and a named segment.

    As written, the most recent fifth scores 1; ``recency_best_high`` turns the
    scale so that it scores 5.  Ties go by customer id.
    """
    base = materialize(rfm_inputs(star, as_of).drop("email", "customer_segment"))
    scored = base.select(
        "*",
        ntile_column(base, "recency_days", "customer_id", 5, descending=recency_best_high).alias("r_score"),
        ntile_column(base, "frequency", "customer_id", 5).alias("f_score"),
        ntile_column(base, "monetary_value", "customer_id", 5).alias("m_score"),
    )
    return scored.select(
        "customer_id",
        "customer_name",
        "city",
        "recency_days",
        "frequency",
        F.round("monetary_value", 2).alias("monetary_value"),
        "r_score",
        "f_score",
        "m_score",
        (F.col("r_score") + F.col("f_score") + F.col("m_score")).alias("rfm_total_score"),
        X.rfm_segment("r_score", "f_score", "m_score").alias("customer_segment"),
    ).orderBy(F.desc("rfm_total_score"), "customer_id")


def cohort_retention(star: Star, months: int = 12) -> DataFrame:
    """Active customers per first-order month and months since.

    A customer's active months are a set of at most as many numbers as the
    calendar has months, gathered with map-side combining; one shuffle serves
    both the first month and the activity.
    """
    per_customer = (
        star.order_lines()
        .join(star.dates.select("date_key"), F.col("order_date_key") == F.col("date_key"), "left_semi")
        .groupBy("customer_sk")
        .agg(F.collect_set(X.month_of_key("order_date_key")).alias("active"))
    )
    activity = per_customer.select(
        F.array_min("active").alias("cohort"), F.explode("active").alias("month")
    ).withColumn("months_since_first", F.col("month") - F.col("cohort"))
    # A customer has each month once, so rows are customers.
    counts = (
        activity.filter(F.col("months_since_first").between(0, months))
        .groupBy("cohort", "months_since_first")
        .agg(F.count(F.lit(1)).alias("active_customers"))
    )
    size = F.max("active_customers").over(Window.partitionBy("cohort"))
    month_text = F.concat(
        F.lpad(F.floor(F.col("cohort") / 12).cast("string"), 4, "0"),
        F.lit("-"),
        F.lpad((F.col("cohort") % 12 + 1).cast("string"), 2, "0"),
    )
    return (
        counts.withColumn("cohort_size", size)
        .select(
            month_text.alias("cohort_month"),
            "months_since_first",
            "active_customers",
            "cohort_size",
            X.pct("active_customers", "cohort_size").alias("retention_pct"),
        )
        .orderBy("cohort_month", "months_since_first")
    )


def clv_ranking(star: Star) -> DataFrame:
    """Customers by value with percentile and quartile, ranked in range buckets."""
    base = customer_activity(star).join(
        star.customers.select("customer_sk", "customer_id", "customer_name", "city", "signup_date"), "customer_sk"
    )
    ranked = rank_globally(
        base, "lifetime_value", "customer_id", percent_rank="clv_percentile", ntiles={"clv_quartile": 4}
    )
    return ranked.select(
        "customer_id",
        "customer_name",
        "city",
        "signup_date",
        "total_orders",
        "total_items_bought",
        "lifetime_value",
        "avg_order_value",
        "last_order_date",
        F.datediff("last_order_date", "signup_date").alias("customer_age_days"),
        "clv_percentile",
        "clv_quartile",
    ).orderBy(F.desc("lifetime_value"), "customer_id")


def order_counts(star: Star) -> DataFrame:
    return star.orders.groupBy("customer_sk").agg(F.count_distinct("order_id").alias("order_count"))


def repeat_purchase_rate(star: Star) -> DataFrame:
    return (
        order_counts(star)
        .agg(
            F.count(F.lit(1)).alias("total_customers"),
            F.count_if(F.col("order_count") == 1).alias("one_time_buyers"),
            F.count_if(F.col("order_count") >= 2).alias("repeat_buyers"),
            F.count_if(F.col("order_count") >= 5).alias("loyal_buyers"),
            F.sum("order_count").alias("_orders"),
        )
        .select(
            "total_customers",
            "one_time_buyers",
            "repeat_buyers",
            "loyal_buyers",
            X.pct("repeat_buyers", "total_customers").alias("repeat_purchase_rate_pct"),
            F.round(X.safe_ratio("_orders", "total_customers"), 6).alias("avg_orders_per_customer"),
        )
    )


def new_vs_returning(star: Star) -> DataFrame:
    """Customers and revenue on the day of the first order against later days.

    Orders are summed to customer and day first, so the window over a customer
    holds at most one row per calendar day, and the month grouping reuses its
    partitioning.
    """
    daily = (
        star.order_lines()
        .groupBy("customer_sk", "order_date_key")
        .agg(F.sum("net_revenue").alias("net_revenue"))
        .withColumn("first_key", F.min("order_date_key").over(Window.partitionBy("customer_sk")))
        .join(
            star.dates.select("date_key", "year_month"), F.col("order_date_key") == F.col("date_key")
        )
        .withColumn("is_new", F.col("order_date_key") == F.col("first_key"))
    )
    revenue = F.col("net_revenue")
    zero = F.lit(0).cast("decimal(28,2)")
    per_customer = daily.groupBy("customer_sk", "year_month").agg(
        F.max(F.col("is_new").cast("int")).alias("new"),
        F.max((~F.col("is_new")).cast("int")).alias("returning"),
        F.sum(F.when(F.col("is_new"), revenue).otherwise(zero)).alias("new_revenue"),
        F.sum(F.when(~F.col("is_new"), revenue).otherwise(zero)).alias("returning_revenue"),
    )
    return (
        per_customer.groupBy("year_month")
        .agg(
            F.sum("new").alias("new_customers"),
            F.sum("returning").alias("returning_customers"),
            F.sum("new_revenue").alias("new_customer_revenue"),
            F.sum("returning_revenue").alias("returning_customer_revenue"),
        )
        .orderBy("year_month")
    )
