"""Type-1 upserts as a full outer join on the natural key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.operators.ordering import rank_globally
from tallyhouse.session import materialize

AUDIT = ("created_date", "last_updated_date")
CUSTOMER_TRACKED = ("customer_name", "email", "city")
CUSTOMER_UPDATED = ("customer_name", "email", "city", "signup_date", "signup_year", "signup_month")
PRODUCT_TRACKED = ("unit_price", "product_name", "category")
PRODUCT_UPDATED = ("product_name", "category", "unit_price", "price_band")


def upsert_type1(
    existing: DataFrame,
    incoming: DataFrame,
    natural_key: str,
    surrogate_key: str,
    now=None,
    tracked: Sequence[str] | None = None,
    updated: Sequence[str] | None = None,
) -> DataFrame:
    """The merged dimension with an ``action`` column (insert, update, unchanged).

    Without ``tracked`` every matched row is updated; with it, only rows where a
    tracked column differs (nulls compared safely).  ``updated`` names the
    columns an update overwrites, by default all but the audit ones.  A match
    keeps its ``created_date``; new keys continue after the largest.
    """
    columns = [c for c in existing.columns if c != surrogate_key]
    updated = [c for c in (updated or columns) if c not in AUDIT and c != natural_key]
    old = existing.select(surrogate_key, *[F.col(c).alias(f"old_{c}") for c in columns])
    new = incoming.select(*[F.col(c).alias(f"new_{c}") for c in columns])
    joined = old.join(new, F.col(f"old_{natural_key}") == F.col(f"new_{natural_key}"), "full")

    is_new = F.col(f"old_{natural_key}").isNull()
    matched = F.col(f"old_{natural_key}").isNotNull() & F.col(f"new_{natural_key}").isNotNull()
    if tracked is None:
        touched = matched
    else:
        differs = F.lit(False)
        for c in tracked:
            differs = differs | ~F.col(f"old_{c}").eqNullSafe(F.col(f"new_{c}"))
        touched = matched & differs
    stamp = (F.current_timestamp() if now is None else F.lit(now)).cast("timestamp")

    def merged(c):
        if c == "created_date":
            return F.when(is_new, F.col("new_created_date")).otherwise(F.col("old_created_date"))
        if c == "last_updated_date":
            return F.when(is_new, F.col(f"new_{c}")).when(touched, stamp).otherwise(F.col(f"old_{c}"))
        if c == natural_key or c in updated:
            return F.when(is_new | touched, F.col(f"new_{c}")).otherwise(F.col(f"old_{c}"))
        return F.when(is_new, F.col(f"new_{c}")).otherwise(F.col(f"old_{c}"))

    action = F.when(is_new, "insert").when(touched, "update").otherwise("unchanged")
    rows = materialize(joined.select(surrogate_key, *[merged(c).alias(c) for c in columns], action.alias("action")))

    inserts = rank_globally(rows.filter(F.col("action") == "insert"), natural_key, natural_key, row_number="_rank")
    last = existing.agg(F.coalesce(F.max(surrogate_key), F.lit(0)).alias("last")).scalar()
    keyed = inserts.withColumn(surrogate_key, F.col("_rank") + last).select(*rows.columns)
    return rows.filter(F.col("action") != "insert").unionByName(keyed)


def upsert_customers_changed(existing: DataFrame, incoming: DataFrame, now=None) -> DataFrame:
    """Only customers whose name, e-mail or city changed; new ones start as New with no orders."""
    starting = incoming.withColumns(
        {
            "customer_segment": F.lit("New"),
            "total_orders": F.lit(0).cast("bigint"),
            "total_lifetime_value": F.lit(0).cast("decimal(18,2)"),
        }
    )
    return upsert_type1(
        existing, starting, "customer_id", "customer_sk", now, CUSTOMER_TRACKED, CUSTOMER_UPDATED
    )


def upsert_products_changed(existing: DataFrame, incoming: DataFrame, now=None) -> DataFrame:
    """Only products whose price, name or category changed."""
    return upsert_type1(existing, incoming, "product_id", "product_sk", now, PRODUCT_TRACKED, PRODUCT_UPDATED)


def merge_counts(merged: DataFrame) -> DataFrame:
    return merged.groupBy("action").agg(F.count(F.lit(1)).alias("row_count"))
