"""Order-item, order and monthly-product facts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.functions import expressions as X
from tallyhouse.functions import rules
from tallyhouse.operators.frequent import is_one_of
from tallyhouse.schemas import FACT_ITEM_COLUMNS, MONEY, RATIO


# Columns that tell a row's load, not its content.
LOAD_COLUMNS = ("etl_load_id",)

# What the item fact is made of.  Lines move with what an order's lines share in front, which is then compressed as one.
KEYED_ORDER_COLUMNS = (
    "etl_load_id", "channel_sk", "geography_sk", "customer_tenure_days", "customer_sk", "order_date", "order_id",
)
KEYED_LINE_COLUMNS = ("order_item_id", "product_sk", "quantity", "price", "net_revenue")


def _with_keys(lines: DataFrame, customers: DataFrame, products: DataFrame, geography: DataFrame, default_geography: int) -> DataFrame:
    """Surrogate keys by join.

    Lines without a customer or product key drop out; an unmapped city takes
    the default member.  No hints here: a small dimension is broadcast by its size,
    a large one (``by_rows``) is shuffled and AQE splits a frequent key.  The few cities come
    first, so that no city name is moved with a line.  Customers come last: the
    lines of an order leave together, and what they share is compressed in all
    later moves.
    """
    return (
        lines.join(geography.select(F.col("city_name").alias("city"), "geography_sk"), "city", "left")
        .withColumn("geography_sk", F.coalesce("geography_sk", F.lit(default_geography)).cast("bigint"))
        .drop("city")
        .join(products.select("product_id", "product_sk"), "product_id")
        .join(customers.select("customer_id", "customer_sk"), "customer_id")
    )


def _channel(lines: DataFrame, default_channel: int):
    if "channel_sk" in lines.columns:
        return F.coalesce("channel_sk", F.lit(default_channel)).cast("bigint")
    return F.lit(default_channel).cast("bigint")


def build_fact_order_items(
    lines: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    geography: DataFrame,
    default_geography: int = rules.UNKNOWN_GEOGRAPHY_SK,
    default_channel: int = rules.DEFAULT_CHANNEL_SK,
) -> DataFrame:
    """One row per cleaned order line, with dimension keys."""
    return fact_columns(keyed_lines(lines, customers, products, geography, default_geography, default_channel))


def keyed_lines(
    lines: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    geography: DataFrame,
    default_geography: int = rules.UNKNOWN_GEOGRAPHY_SK,
    default_channel: int = rules.DEFAULT_CHANNEL_SK,
) -> DataFrame:
    """Cleaned lines with dimension keys, a channel and a batch id, all other columns as they are."""
    load_id = F.col("etl_load_id") if "etl_load_id" in lines.columns else F.lit(None).cast("string")
    return _with_keys(lines, customers, products, geography, default_geography).withColumns(
        {"channel_sk": _channel(lines, default_channel), "etl_load_id": load_id}
    )


def fact_columns(keyed: DataFrame) -> DataFrame:
    """The item fact from lines with keys."""
    return keyed.withColumns(
        {"order_date_key": X.date_key("order_date"), "unit_price": F.col("price").cast(MONEY)}
    ).select(*FACT_ITEM_COLUMNS)


def build_fact_from_staging(
    staging: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    geography: DataFrame,
    load_id: str | None = None,
    default_geography: int = rules.UNKNOWN_GEOGRAPHY_SK,
    default_channel: int = rules.DEFAULT_CHANNEL_SK,
    clip: bool = True,
) -> DataFrame:
    """The same fact from staging rows, measures recomputed.

    ``clip=False`` lets the discount share and the tenure go negative.
    """
    gross = (F.col("quantity").cast("decimal(18,2)") * F.col("unit_price")).cast(MONEY)
    gap = (gross - F.col("total_amount")).cast(MONEY)
    zero = F.lit(0).cast(MONEY)
    discount = F.greatest(gap, zero)
    share = F.when(gross > 0, F.round(F.try_divide(discount if clip else gap, gross), 4)).otherwise(0).cast(RATIO)
    tenure = F.datediff("order_date", "signup_date")
    return (
        _with_keys(staging, customers, products, geography, default_geography)
        .withColumns(
            {
                "order_date_key": X.date_key("order_date"),
                "channel_sk": _channel(staging, default_channel),
                "gross_revenue": gross,
                "net_revenue": F.col("total_amount").cast(MONEY),
                "discount_amount": discount.cast(MONEY),
                "discount_pct": share,
                "customer_tenure_days": F.greatest(tenure, F.lit(0)) if clip else tenure,
                "etl_load_id": F.lit(load_id).cast("string"),
            }
        )
        .select(*FACT_ITEM_COLUMNS)
    )


def unmapped_lines(lines: DataFrame, dimension: DataFrame, natural_key: str) -> DataFrame:
    """Lines whose natural key is missing from a dimension (quarantine)."""
    return lines.join(dimension.select(natural_key), natural_key, "left_anti")


def count_unmapped(lines: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    """Unmapped lines per dimension; the lines are summed per key before the anti-join."""

    def missing(dimension, key):
        per_key = lines.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
        return unmapped_lines(per_key, dimension, key).agg(
            F.lit(key).alias("natural_key"), F.coalesce(F.sum("n"), F.lit(0)).alias("row_count")
        )

    return missing(customers, "customer_id").unionByName(missing(products, "product_id"))


def build_fact_order_summary(items: DataFrame, by_date: bool = False) -> DataFrame:
    """Order grain: items, quantity, revenue and distinct products.

    Lines are moved once, by order; counting distinct products needs no second exchange then.  ``by_date`` moves them in
    ranges of (date, order), so that orders come out in the layout of the stored fact.
    """
    order = ("order_id", "order_date_key", "customer_sk", "geography_sk")
    # What lines of an order share comes first: it is compressed as one.
    items = items.select(*order, "product_sk", "quantity", "gross_revenue", "net_revenue", "discount_amount")
    moved = items.repartitionByRange("order_date_key", "order_id") if by_date else items.repartition(*order)
    return moved.groupBy(*order).agg(
        F.count(F.lit(1)).alias("total_items"),
        F.sum("quantity").alias("total_quantity"),
        F.sum("gross_revenue").cast(MONEY).alias("order_gross_revenue"),
        F.sum("net_revenue").cast(MONEY).alias("order_net_revenue"),
        F.sum("discount_amount").cast(MONEY).alias("order_discount_amount"),
        F.count_distinct("product_sk").alias("distinct_products"),
    )


def monthly_product_base(items: DataFrame, by_product: bool = False) -> DataFrame:
    """Product by month, without the change columns.

    Lines are moved once, by product and month.  Distinct orders and customers are counted by marking the first line of
    each, in windows within that partitioning, as two distinct counts would send every line three times.  ``by_product``
    moves them by product alone, so that a product's months come out in one task: for products without too many lines.
    """
    group = ("year_month_key", "product_sk")
    lines = items.select(
        X.month_text_of_key("order_date_key").alias("year_month_key"),
        "product_sk", "order_id", "customer_sk", "quantity", "gross_revenue", "net_revenue", "unit_price",
    ).repartition(*(("product_sk",) if by_product else ("product_sk", "year_month_key")))

    def first_of(column):
        place = F.row_number().over(Window.partitionBy(*group, column).orderBy(column))
        return (F.col(column).isNotNull() & (place == 1)).cast("bigint")

    return (
        lines.withColumn("_first_of_order", first_of("order_id"))
        .withColumn("_first_of_customer", first_of("customer_sk"))
        .groupBy(*group)
        .agg(
            F.sum("quantity").alias("total_units_sold"),
            F.sum("_first_of_order").alias("total_orders"),
            F.sum("gross_revenue").cast(MONEY).alias("total_gross_revenue"),
            F.sum("net_revenue").cast(MONEY).alias("total_net_revenue"),
            F.round(F.avg("unit_price"), 2).cast(MONEY).alias("avg_unit_price"),
            F.round(F.avg("net_revenue"), 2).cast(MONEY).alias("avg_order_value"),
            F.sum("_first_of_customer").alias("total_customers"),
        )
    )


PRIOR = ("total_net_revenue", "total_units_sold")


def _with_prior(monthly: DataFrame) -> DataFrame:
    earlier = Window.partitionBy("product_sk").orderBy("year_month_key")
    return monthly.withColumns({f"_prior_{c}": F.lag(c).over(earlier) for c in PRIOR})


def _with_changes(rows: DataFrame, layout: Sequence[str]) -> DataFrame:
    columns = [c for c in rows.columns if c not in {f"_prior_{p}" for p in PRIOR}]
    if layout:
        # Small counts beside the month, which moved rows share.
        front = ("year_month_key", "total_orders", "total_customers")
        rows = rows.select(*front, *[c for c in rows.columns if c not in front]).hint("rebalance", *layout)
    return rows.select(
        *columns,
        X.growth("total_net_revenue", "_prior_total_net_revenue").alias("revenue_mom_change_pct"),
        X.growth("total_units_sold", "_prior_total_units_sold").alias("units_mom_change_pct"),
    )


def with_month_change(monthly: DataFrame, layout: Sequence[str] = ()) -> DataFrame:
    """Change against the product's previous existing month.

    A product's window holds one row per calendar month.  With a ``layout`` the rows are rebalanced on these columns while
    they carry the earlier month's numbers, which are half as wide as the changes.
    """
    return _with_changes(_with_prior(monthly), layout)


def build_fact_monthly_product(items: DataFrame, layout: Sequence[str] = (), frequent: Sequence | None = None) -> DataFrame:
    """Product by month with the changes.

    Where the ``frequent`` products are known, only their lines are moved by product and month; those of the others are moved
    by product, and their monthly rows need no move to meet the earlier month.
    """
    if frequent is None:
        return with_month_change(monthly_product_base(items), layout)
    often = is_one_of("product_sk", frequent)
    rows = _with_prior(monthly_product_base(items.filter(~often), by_product=True))
    if frequent:
        rows = rows.unionByName(_with_prior(monthly_product_base(items.filter(often))))
    return _with_changes(rows, layout)


def with_layout_columns(fact: DataFrame, key: str = "order_date_key") -> DataFrame:
    """Year and month of the date key, the partition columns of a stored fact."""
    number = F.col(key)
    return fact.withColumns(
        {
            "order_year": F.floor(number / 10000).cast("int"),
            "order_month": (F.floor(number / 100) % 100).cast("int"),
        }
    )
