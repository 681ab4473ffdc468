"""Data-quality profile of unprocessed text rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions import expressions as X
from tallyhouse.functions import rules

NUMERIC = ("quantity", "total_amount", "price")


def overview(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count"), F.lit(len(df.columns)).cast("bigint").alias("column_count"))


def _null_counts(df: DataFrame) -> DataFrame:
    counts = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return counts.unpivot(["_rows"], list(df.columns), "column_name", "null_count")


def null_profile(df: DataFrame) -> DataFrame:
    """Columns with nulls: count and percentage, in one pass."""
    return (
        _null_counts(df)
        .filter(F.col("null_count") > 0)
        .select("column_name", "null_count", X.pct("null_count", "_rows").alias("null_pct"))
    )


def _copies(df: DataFrame) -> DataFrame:
    """Distinct rows with their number of copies."""
    return df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_copies"))


def duplicate_profile(df: DataFrame) -> DataFrame:
    """Full-row and id duplicates, and distinct ids.

    The rows are shuffled once to distinct rows; a null id counts as one value
    among the duplicates and as none among the distinct ids.
    """
    some_id = F.struct("order_item_id")
    return _copies(df).agg(
        (F.sum("_copies") - F.count(F.lit(1))).alias("full_row_duplicates"),
        (F.sum("_copies") - F.count_distinct(some_id)).alias("order_item_id_duplicates"),
        F.count_distinct("order_id").alias("distinct_orders"),
        F.count_distinct("customer_id").alias("distinct_customers"),
        F.count_distinct("product_id").alias("distinct_products"),
    )


def numeric_profile(df: DataFrame, columns: Sequence[str] = NUMERIC) -> DataFrame:
    """Minimum, maximum, mean, negatives, zeros and unreadable values per column, in one pass."""
    profiles = []
    for c in columns:
        v = F.col(c).try_cast("decimal(20,4)")
        profiles.append(
            F.struct(
                F.lit(c).alias("column_name"),
                F.min(v).alias("min_value"),
                F.max(v).alias("max_value"),
                F.round(F.avg(v), 2).alias("mean_value"),
                F.count_if(v < 0).alias("negatives"),
                F.count_if(v == 0).alias("zeros"),
                F.count_if(v.isNull()).alias("nulls"),
            )
        )
    return df.agg(F.array(*profiles).alias("profiles")).select(F.inline("profiles"))


def _dates(df: DataFrame, formats) -> DataFrame:
    return df.select(
        X.parse_date("order_date", formats).alias("order_day"), X.parse_date("signup_date", formats).alias("signup_day")
    )


def date_profile(df: DataFrame, formats=rules.DATE_FORMATS) -> DataFrame:
    return (
        _dates(df, formats)
        .agg(
            F.min("order_day").alias("order_date_min"),
            F.max("order_day").alias("order_date_max"),
            F.min("signup_day").alias("signup_date_min"),
            F.max("signup_day").alias("signup_date_max"),
            F.count_if(F.col("order_day").isNull()).alias("bad_order_dates"),
            F.count_if(F.col("signup_day").isNull()).alias("bad_signup_dates"),
            F.count_if(F.col("order_day") < F.col("signup_day")).alias("order_before_signup"),
            F.count(F.lit(1)).alias("_rows"),
        )
        .withColumn("order_before_signup_pct", X.pct("order_before_signup", "_rows", 1))
        .drop("_rows")
    )


def categorical_profile(df: DataFrame, columns: Sequence[str] = ("category", "city")) -> DataFrame:
    """Value counts and share of all rows, nulls left out of the list."""
    cells = df.select(
        F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("value")) for c in columns])).alias("cell")
    ).select("cell.column_name", "cell.value")
    counts = cells.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("row_count"))
    # Every row gives each column one cell, so one column's counts add up to all
    # rows; taken from the counts, whose shuffle is shared, not from a second scan.
    first = F.when(F.col("column_name") == columns[0], F.col("row_count"))
    rows = counts.agg(F.sum(first).alias("n")).scalar()
    return counts.filter(F.col("value").isNotNull()).withColumn("share_pct", X.pct("row_count", rows, 1))


def email_profile(df: DataFrame) -> DataFrame:
    """Well-formed addresses after trimming; a null is invalid."""
    return df.agg(
        F.sum(1 - X.email_valid(F.trim("email"))).alias("invalid_emails"),
        F.sum(X.email_valid(F.trim("email"))).alias("valid_emails"),
    )


def quality_score(df: DataFrame, formats=rules.DATE_FORMATS) -> DataFrame:
    """Issues, score (half a point each off 100, not below 0) and grade, as one row.

    One scan: the rows are shuffled to distinct rows once, and each of those
    counts as often as it was delivered.
    """

    def times(condition):
        return F.sum(F.when(condition, F.col("_copies")).otherwise(0))

    rows = F.sum("_copies")
    null_columns = F.lit(0)
    for c in df.columns:
        null_columns = null_columns + F.max(F.col(c).isNull().cast("int"))
    issues = (
        (rows - F.count(F.lit(1)))
        + (rows - F.count_distinct(F.struct("order_item_id")))
        + times(X.parse_date("order_date", formats).isNull())
        + times(X.parse_date("signup_date", formats).isNull())
        + times(X.email_valid(F.trim("email")) == 0)
        + null_columns
    )
    total = _copies(df).agg(F.coalesce(issues, F.lit(0)).alias("total_issues"))
    return total.withColumn("score", F.greatest(F.lit(0.0), 100 - F.col("total_issues") * 0.5)).withColumn(
        "grade", X.quality_grade("score")
    )
