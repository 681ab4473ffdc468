"""The full load: cleaned lines to raw, staging, dimensions and facts."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.functions import rules
from tallyhouse.operators import dimensions as D
from tallyhouse.operators import facts, quarantine
from tallyhouse.operators.calendar import build_dim_date
from tallyhouse.operators.cleaning import clean_orders, clean_split, derive_revenue
from tallyhouse.operators.constraints import fact_rules, split_violations
from tallyhouse.operators.frequent import frequent_values
from tallyhouse.operators.upsert import upsert_customers_changed, upsert_products_changed, upsert_type1
from tallyhouse.plans.star import Star
from tallyhouse.session import stored_aside
from tallyhouse.sources.files import load_raw, load_staging, save_processed, staging_rows, with_audit
from tallyhouse.sources.warehouse import Version, Warehouse

LAYOUT = ("order_year", "order_month")
MONTHLY_LAYOUT = ("year_month_key",)
PIPELINE = "fact_order_items_load"


@dataclass(frozen=True)
class Settings:
    """What a deployment may vary."""

    calendar_start: date = rules.CALENDAR_START
    calendar_end: date = rules.CALENDAR_END
    date_key_range: tuple[int, int] = rules.DATE_KEY_RANGE
    high_value_from: tuple = rules.HIGH_VALUE_FROM
    regular_from: tuple = rules.REGULAR_FROM
    default_geography: int = rules.UNKNOWN_GEOGRAPHY_SK
    default_channel: int = rules.DEFAULT_CHANNEL_SK
    lookback_days: int = 0


def new_load_id() -> str:
    return str(uuid.uuid4())


def utc_now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def seed_dimensions(wh: Warehouse, settings: Settings, geography: DataFrame | None = None) -> None:
    """Calendar, geography and channels."""
    spark = wh.spark
    wh.publish(
        {
            "dim_date": wh.write_version(
                "dim_date", build_dim_date(spark, settings.calendar_start, settings.calendar_end).coalesce(1)
            ),
            "dim_geography": wh.write_version(
                "dim_geography", (D.build_dim_geography(spark) if geography is None else geography).coalesce(1)
            ),
            "dim_channel": wh.write_version("dim_channel", D.build_dim_channel(spark).coalesce(1)),
        }
    )


def load_dimension(wh: Warehouse, table: str, incoming: DataFrame, natural_key: str, surrogate_key: str, now=None) -> Version:
    """Insert all on the first load, type-1 upsert later.  Returns the unpublished version."""
    if wh.exists(table):
        merged = upsert_type1(wh.read(table), incoming, natural_key, surrogate_key, now).drop("action")
    else:
        merged = D.assign_surrogate_keys(incoming, natural_key, surrogate_key)
    return wh.write_version(table, merged)


def load_dimensions(
    wh: Warehouse, lines: DataFrame, settings: Settings, now=None, product_lines: DataFrame | None = None
) -> None:
    """Customers from ``lines``, products from ``product_lines`` where these differ."""
    customers = D.build_dim_customer(lines, now, settings.high_value_from, settings.regular_from)
    products = D.build_dim_product(lines if product_lines is None else product_lines, now)
    with stored_aside(wh.spark):
        customer = load_dimension(wh, "dim_customer", customers, "customer_id", "customer_sk", now)
    with stored_aside(wh.spark):
        product = load_dimension(wh, "dim_product", products, "product_id", "product_sk", now)
    wh.publish({"dim_customer": customer, "dim_product": product})


def build_items(wh: Warehouse, lines: DataFrame, settings: Settings, rebalanced: bool = False) -> DataFrame:
    """Order-item fact with layout columns, rows that break a check left out.

    ``lines`` are cleaned: what was derived from price, quantity and amount is left behind and derived again after the
    last move, which with ``rebalanced`` is that to the months.
    """
    keyed = facts.keyed_lines(
        lines.drop("gross_revenue", "discount_amount", "discount_pct"),
        wh.lookup("dim_customer"),
        wh.lookup("dim_product"),
        wh.read("dim_geography"),
        settings.default_geography,
        settings.default_channel,
    )
    if rebalanced:
        month = F.trunc("order_date", "month").alias("_month")
        keyed = keyed.select(month, *facts.KEYED_ORDER_COLUMNS, *facts.KEYED_LINE_COLUMNS).hint("rebalance", "_month")
    items = facts.fact_columns(derive_revenue(keyed.withColumn("total_amount", F.col("net_revenue"))))
    good, _ = split_violations(items, fact_rules(settings.date_key_range))
    return facts.with_layout_columns(good)


def priced(lines: DataFrame) -> DataFrame:
    """Lines that can enter the star: a batch without any price has no median to repair them with."""
    return lines.filter(F.col("price").isNotNull())


def quarantine_rows(
    wh: Warehouse, lines: DataFrame, settings: Settings, load_id: str, loaded: int | None = None, rejected: DataFrame | None = None
) -> int:
    """Add to the quarantine what a load left out, with reasons; returns the rows added.

    ``lines`` are the cleaned lines, ``loaded`` the fact rows they became, ``rejected`` the delivered rows that cleaning
    tagged.  The dimensions are joined only where the counts leave lines unexplained.
    """
    broken = quarantine.broken_lines(lines, settings.date_key_range)
    parts = [quarantine.quarantined(broken, "fact", load_id)]
    if rejected is not None:
        parts.append(quarantine.quarantined(rejected, "clean", load_id))
    added = wh.append(quarantine.TABLE, parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1]))
    counts = {r["stage"]: r["count"] for r in added.groupBy("stage").count().collect()}  # two stages
    unexplained = 0 if loaded is None else lines.count() - counts.get("fact", 0) - loaded
    if unexplained:
        keys = {"customer_id": wh.lookup("dim_customer"), "product_id": wh.lookup("dim_product")}
        sound = lines.join(broken.select("order_item_id"), "order_item_id", "left_anti")
        more = wh.append(quarantine.TABLE, quarantine.quarantined(quarantine.unmapped_lines(sound, keys), "fact", load_id))
        counts["unmapped"] = more.count()
    return sum(counts.values())


def write_derived(wh: Warehouse, items: DataFrame) -> dict[str, Version]:
    """New versions of the order and the monthly fact from the stored items."""
    summary = facts.with_layout_columns(facts.build_fact_order_summary(items, by_date=True))
    monthly = facts.build_fact_monthly_product(items, MONTHLY_LAYOUT, frequent_values(items, "product_sk"))
    return {
        "fact_order_summary": wh.write_version("fact_order_summary", summary, LAYOUT, moved=True),
        "fact_monthly_product_performance": wh.write_version(
            "fact_monthly_product_performance", monthly, MONTHLY_LAYOUT, moved=True
        ),
    }


def load_facts(wh: Warehouse, lines: DataFrame, settings: Settings) -> None:
    """Truncate and reload of the three facts, published together."""
    version = wh.write_version("fact_order_items", build_items(wh, lines, settings, rebalanced=True), LAYOUT, moved=True)
    items = wh.read_version("fact_order_items", version)
    wh.publish({"fact_order_items": version, **write_derived(wh, items)})


def refresh_customers(wh: Warehouse, settings: Settings, now=None) -> None:
    """Customer orders, value and segment from the facts."""
    orders = wh.read("fact_order_summary").withColumn("net_revenue", F.col("order_net_revenue"))
    wh.replace(
        "dim_customer",
        D.refresh_customer_stats(
            wh.read("dim_customer"), orders, now, False, settings.high_value_from, settings.regular_from
        ),
    )


def open_star(wh: Warehouse) -> Star:
    return Star(
        dates=wh.read("dim_date"),
        customers=wh.lookup("dim_customer"),
        products=wh.lookup("dim_product"),
        geography=wh.read("dim_geography"),
        channels=wh.read("dim_channel"),
        items=wh.read("fact_order_items"),
        orders=wh.read("fact_order_summary"),
        monthly=wh.read("fact_monthly_product_performance"),
    )


def run_pipeline(
    wh: Warehouse,
    source: DataFrame,
    source_name: str = "",
    settings: Settings = Settings(),
    dry_run: bool = False,
    skip_raw: bool = False,
    geography: DataFrame | None = None,
    load_time: datetime | None = None,
    on_step: Callable[[str], None] = lambda step: None,
) -> DataFrame:
    """Full load of text rows.  Returns the cleaned rows; a dry run writes nothing.

    The raw layer gets the rows as delivered, staging and all later steps the
    cleaned ones.  Success or failure is written to the run log.
    """
    load_id, started = new_load_id(), utc_now()
    load_time = load_time or started
    if dry_run:
        return clean_orders(source, load_id, source_name, load_time)
    try:
        cleaned, rejected = clean_split(source, load_id, source_name, load_time)
        on_step("processed")
        path = save_processed(cleaned, f"{wh.root}/processed", load_time.strftime("%Y%m%d_%H%M%S"))
        stored = wh.spark.read.parquet(path)
        if not skip_raw:
            on_step("raw")
            load_raw(with_audit(source, load_id, source_name, load_time), wh.path("raw", "ecommerce_orders"))
        on_step("staging")
        load_staging(stored, wh.path("staging", "order_items"))
        with wh.one_publication():
            on_step("dimensions")
            seed_dimensions(wh, settings, geography)
            load_dimensions(wh, priced(stored), settings, load_time)
            on_step("facts")
            load_facts(wh, priced(stored), settings)
            left_out = quarantine_rows(wh, stored, settings, load_id, wh.read("fact_order_items").count(), rejected)
            on_step("refresh")
            refresh_customers(wh, settings, load_time)
        record_success(wh, started, load_id, left_out)
    except Exception:
        wh.record_run(PIPELINE, None, started, "FAILED", None, load_id)
        raise
    return stored


def record_success(wh: Warehouse, started: datetime, load_id: str, rejected: int) -> None:
    """A run row with the rows and the newest date of the item fact, and the rows left out."""
    summary = wh.read("fact_order_items").agg(F.count(F.lit(1)).alias("n"), F.max("order_date_key").alias("k")).first()
    loaded = datetime.strptime(str(summary["k"]), "%Y%m%d").date() if summary["k"] else None
    wh.record_run(PIPELINE, loaded, started, "SUCCESS", summary["n"], load_id, rejected)


def describe_clean(cleaned: DataFrame) -> DataFrame:
    """What a dry run shows: count, mean, spread and extremes per column."""
    return cleaned.summary("count", "mean", "stddev", "min", "max")


def run_from_staging(wh: Warehouse, settings: Settings = Settings(), now=None) -> None:
    """The load that starts at staging: changed-only upserts, facts, refresh, one batch id and one run row."""
    load_id, started = new_load_id(), utc_now()
    try:
        with wh.one_publication():
            left_out = load_from_staging(wh, load_id, settings, now)
        record_success(wh, started, load_id, left_out)
    except Exception:
        wh.record_run(PIPELINE, None, started, "FAILED", None, load_id)
        raise


def load_from_staging(wh: Warehouse, load_id: str, settings: Settings, now=None) -> int:
    """Returns the staging rows left out, which go to the quarantine."""
    staging = wh.spark.read.parquet(wh.path("staging", "order_items"))
    lines = staging.withColumnsRenamed({"customer_name": "name", "unit_price": "price", "total_amount": "net_revenue"})
    customers, products = D.build_dim_customer(priced(lines), now), D.build_dim_product(priced(lines), now)

    def merged(table, incoming, natural_key, surrogate_key, upsert):
        if wh.exists(table):
            return upsert(wh.read(table), incoming, now).drop("action")
        return D.assign_surrogate_keys(incoming, natural_key, surrogate_key)

    wh.publish(
        {
            "dim_customer": wh.write_version(
                "dim_customer", merged("dim_customer", customers, "customer_id", "customer_sk", upsert_customers_changed)
            ),
            "dim_product": wh.write_version(
                "dim_product", merged("dim_product", products, "product_id", "product_sk", upsert_products_changed)
            ),
        }
    )
    items = facts.build_fact_from_staging(
        staging.filter(F.col("unit_price").isNotNull()),
        wh.lookup("dim_customer"),
        wh.lookup("dim_product"),
        wh.read("dim_geography"),
        load_id,
        settings.default_geography,
        settings.default_channel,
    )
    good, _ = split_violations(items, fact_rules(settings.date_key_range))
    version = wh.write_version("fact_order_items", facts.with_layout_columns(good), LAYOUT)
    stored = wh.read_version("fact_order_items", version)
    wh.publish({"fact_order_items": version, **write_derived(wh, stored)})
    refresh_customers(wh, settings, now)
    delivered = lines.withColumn("total_amount", F.col("net_revenue"))
    return quarantine_rows(wh, delivered, settings, load_id, stored.count())
