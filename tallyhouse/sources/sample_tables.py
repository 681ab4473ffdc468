"""Order lines, clean or dirty, derived from the TPC-H-like sample tables.

The library's input is one wide delimited order-line file.  These functions
shape ``lineitem`` joined to its parents into that layout, so that every
operator can run over whole tables.  Money is computed in integer cents.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.functions import rules
from tallyhouse.functions.expressions import as_column
from tallyhouse.schemas import GEOGRAPHY_SCHEMA, MONEY, SOURCE_COLUMNS
from tallyhouse.session import by_rows, literal_rows

SIGNUP_BASE = date(1994, 1, 1)


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def cents_to_money(cents):
    return (as_column(cents).cast("decimal(18,0)") * F.lit("0.01").cast("decimal(3,2)")).cast(MONEY)


def order_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Typed order lines, one per ``lineitem`` row, plus a ``channel_sk``.

    ``(l_orderkey, l_linenumber)`` repeats, so the line id also takes in part
    and supplier.  It is plain arithmetic: a row number per order would sort a
    very large order in one task.  Sizes decide on the joins, for large parents
    their rows (``by_rows``), and AQE splits skewed join partitions.

    Customers and nations meet the orders, a quarter of the rows, so lines are
    moved twice, by part and last by order: lines of an order come out together.
    """
    line = read_table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_partkey",
        (
            (F.col("l_orderkey") * 8 + F.col("l_linenumber")) * 1048576
            + (F.col("l_partkey") * 31 + F.col("l_suppkey")) % 1048576
        ).alias("order_item_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("cents"),
        F.round(F.col("l_discount") * 100).cast("bigint").alias("discount"),
    )
    orders = read_table(spark, folder, "orders").select(
        "o_orderkey",
        "o_custkey",
        F.col("o_orderdate").cast("date").alias("order_date"),
        F.left("o_orderpriority", F.lit(1)).cast("bigint").alias("channel_sk"),
    )
    customer = by_rows(read_table(spark, folder, "customer")).select("c_custkey", "c_name", "c_nationkey")
    nation = read_table(spark, folder, "nation").select("n_nationkey", "n_name")
    part = by_rows(read_table(spark, folder, "part")).select("p_partkey", "p_name", "p_type")

    unit_cents = F.expr("(2 * cents + quantity) div (2 * quantity)")
    paid_cents = F.expr("(cents * (100 - discount) + 50) div 100")
    ordered = (
        orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select("o_orderkey", "o_custkey", "order_date", "channel_sk", "c_name", "n_name")
    )
    return (
        line.join(part, F.col("l_partkey") == F.col("p_partkey"))
        .join(ordered, F.col("l_orderkey") == F.col("o_orderkey"))
        .select(
            "order_item_id",
            F.col("l_orderkey").alias("order_id"),
            F.col("l_partkey").alias("product_id"),
            "quantity",
            F.col("o_custkey").alias("customer_id"),
            "order_date",
            cents_to_money(paid_cents).alias("total_amount"),
            F.col("c_name").alias("name"),
            F.col("n_name").alias("city"),
            F.concat(F.lower(F.replace("c_name", F.lit("#"), F.lit("."))), F.lit("@example.com")).alias("email"),
            F.date_add(F.lit(SIGNUP_BASE), (F.col("o_custkey") % 730).cast("int")).alias("signup_date"),
            F.col("p_name").alias("product_name"),
            F.col("p_type").alias("category"),
            cents_to_money(unit_cents).alias("price"),
            "channel_sk",
        )
    )


def dirty_source(spark: SparkSession, folder: str) -> DataFrame:
    """All order lines as text, with faults spread over them.

    Every line stays in; the remainders below only choose which value of a line
    is damaged, and every 29th id is delivered twice.
    """
    lines = order_lines(spark, folder)
    line_id = F.col("order_item_id")

    def every(n):
        return line_id % n == 0

    text = {c: F.col(c).cast("string") for c in SOURCE_COLUMNS}
    damaged = {
        **text,
        "order_item_id": F.when(every(101), "").otherwise(text["order_item_id"]),
        "customer_id": F.when(every(103), "NULL").otherwise(text["customer_id"]),
        "product_id": F.when(every(107), "abc").otherwise(text["product_id"]),
        "quantity": F.when(every(89), "-5")
        .when(every(61), "n/a")
        .when(every(67), F.concat(text["quantity"], F.lit(".7")))
        .otherwise(text["quantity"]),
        "order_date": F.when(every(73), "not-a-date").when(every(113), "NaN").otherwise(text["order_date"]),
        "signup_date": F.when(every(109), "").otherwise(text["signup_date"]),
        "total_amount": F.when(every(59), "0").when(every(127), "bad").otherwise(text["total_amount"]),
        "name": F.when(every(131), "None")
        .when(every(2), F.concat(F.lit("  "), text["name"], F.lit(" ")))
        .otherwise(text["name"]),
        "city": F.when(every(97), "NULL")
        .when(every(71), F.lower(text["city"]))
        .when(every(43), "el cairo")
        .when(every(47), "AL-QAHIRA")
        .when(every(37), " alex ")
        .otherwise(text["city"]),
        "email": F.when(every(79), F.replace(text["email"], F.lit("@"), F.lit(".")))
        .when(every(41), F.upper(text["email"]))
        .when(every(139), "")
        .otherwise(text["email"]),
        "product_name": F.when(every(137), "N/A").otherwise(text["product_name"]),
        "category": F.when(every(53), "electronic")
        .when(every(31), "food & bev")
        .when(every(149), "")
        .otherwise(text["category"]),
        "price": F.when(every(83), "").when(every(151), "-1").otherwise(text["price"]),
    }
    copies = F.explode(F.sequence(F.lit(1), F.when(every(29), 2).otherwise(1)))
    return lines.withColumn("_copy", copies).select(*[damaged[c].alias(c) for c in SOURCE_COLUMNS])


def sample_geography(spark: SparkSession, folder: str) -> DataFrame:
    """Geography members of the sample: one per nation, plus Unknown."""
    nation = read_table(spark, folder, "nation")
    region = read_table(spark, folder, "region")
    members = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        (F.col("n_nationkey") + 1).cast("bigint").alias("geography_sk"),
        F.col("n_name").alias("city_name"),
        F.concat(F.col("n_name"), F.lit(" Governorate")).alias("governorate"),
        F.col("n_name").alias("country"),
        F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("country_code"),
        F.col("r_name").alias("region"),
        F.col("r_name").alias("continent"),
        (F.col("n_nationkey") * 3 - 36).cast("decimal(9,6)").alias("latitude"),
        (F.col("n_nationkey") * 5 - 60).cast("decimal(9,6)").alias("longitude"),
    )
    unknown = literal_rows(
        spark,
        [(rules.UNKNOWN_GEOGRAPHY_SK, "Unknown", None, "Unknown", "--", "Unknown", "Unknown", None, None)],
        GEOGRAPHY_SCHEMA,
    )
    return members.unionByName(unknown)
