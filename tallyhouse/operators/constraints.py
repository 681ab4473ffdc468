"""Checks, foreign keys and unique keys as violation reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions import rules


def fact_rules(date_range=rules.DATE_KEY_RANGE) -> dict[str, Column]:
    return {
        "date_key_range": F.col("order_date_key").between(*date_range),
        "net_revenue_nonnegative": F.col("net_revenue") >= 0,
        "quantity_positive": F.col("quantity") > 0,
    }


def staging_rules() -> dict[str, Column]:
    return {
        "quantity_positive": F.col("quantity") > 0,
        "total_amount_nonnegative": F.col("total_amount") >= 0,
        "unit_price_nonnegative": F.col("unit_price") >= 0,
    }


def check_constraints(df: DataFrame, checks: Mapping[str, Column]) -> DataFrame:
    """(rule, violations) in one pass; a null result is no violation, as in SQL checks."""
    counts = df.agg(*[F.count_if(~check).alias(name) for name, check in checks.items()])
    return counts.unpivot([], list(checks), "rule", "violations")


def split_violations(df: DataFrame, checks: Mapping[str, Column]) -> tuple[DataFrame, DataFrame]:
    """(rows that pass, rows that fail any check)."""
    passes = F.lit(True)
    for check in checks.values():
        passes = passes & F.coalesce(check, F.lit(True))
    return df.filter(passes), df.filter(~passes)


def require_no_violations(report: DataFrame) -> None:
    broken = report.filter(F.col("violations") > 0).collect()  # one row per rule
    if broken:
        raise ValueError("constraints violated: " + ", ".join(f"{r['rule']}={r['violations']}" for r in broken))


def fk_orphans(child: DataFrame, child_name: str, parents: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Orphan rows per foreign key of one table, in a single scan of it.

    ``parents`` maps a foreign key to its parent and the parent's key.  The
    child is counted per key value before it meets the parents, so a frequent
    key is one row in the join.
    """
    keys = list(parents)
    per_key = (
        child.select(*[F.col(k).cast("bigint").alias(k) for k in keys])
        .unpivot([], keys, "foreign_key", "key")
        .groupBy("foreign_key", "key")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    known = None
    for key, (parent, parent_key) in parents.items():
        values = parent.select(F.lit(key).alias("foreign_key"), F.col(parent_key).cast("bigint").alias("key")).distinct()
        known = values if known is None else known.unionByName(values)
    # Both sides are grouped by what they meet on, and the parents may hold millions of keys: none is broadcast.
    checked = per_key.join(known.withColumn("_known", F.lit(True)).hint("merge"), ["foreign_key", "key"], "left")
    orphan = F.when(F.col("_known").isNull(), F.col("n")).otherwise(0)
    return checked.groupBy("foreign_key").agg(F.sum(orphan).alias("orphan_rows")).select(
        F.lit(child_name).alias("child_table"), "foreign_key", "orphan_rows"
    )


def fk_integrity(star) -> DataFrame:
    """The foreign keys of the two transaction facts."""
    shared = {
        "order_date_key": (star.dates, "date_key"),
        "customer_sk": (star.customers, "customer_sk"),
        "geography_sk": (star.geography, "geography_sk"),
    }
    more = {"product_sk": (star.products, "product_sk"), "channel_sk": (star.channels, "channel_sk")}
    items = fk_orphans(star.items, "fact_order_items", {**shared, **more})
    return items.unionByName(fk_orphans(star.orders, "fact_order_summary", shared))


def duplicate_keys(df: DataFrame, table: str, keys: Sequence[str]) -> DataFrame:
    """How many key values repeat, and how many rows they hold."""
    repeated = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
    return repeated.agg(
        F.lit(table).alias("table_name"),
        F.lit(",".join(keys)).alias("unique_key"),
        F.count(F.lit(1)).alias("repeated_keys"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows_involved"),
    )
