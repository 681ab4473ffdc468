"""Every operator as a query over the sample tables: ``name -> f(spark, folder)``.

Analytic queries read a star that is loaded once per session and folder into the
shared folder and stays there as Parquet, as a warehouse would; operator queries
run on the sample tables directly.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.functions import expressions as X
from tallyhouse.functions import rules
from tallyhouse.operators import access, cleaning, constraints, dimensions, facts, quality, upsert
from tallyhouse.operators.describe import describe_all
from tallyhouse.operators.calendar import build_dim_date, calendar_between
from tallyhouse.plans import customers, full_load, incremental, measures, places, products, revenue, views
from tallyhouse.plans.star import Star, slice_star
from tallyhouse.session import materialize, shared_dir
from tallyhouse.sources import files
from tallyhouse.sources.sample_tables import dirty_source, order_lines, read_table, sample_geography
from tallyhouse.sources.warehouse import Warehouse, current_runs, high_water_marks, upsert_runs
from tallyhouse.streaming.landing import load_available

Query = Callable[[SparkSession, str], DataFrame]

# Parameters that suit the sample's dates and amounts.
CALENDAR = (date(1994, 1, 1), date(2002, 12, 31))
AS_OF = date(2001, 9, 1)
SPLIT = date(1999, 6, 15)
NOW = datetime(2001, 9, 1)
HIGH, REGULAR = (2000000, 15), (800000, 10)
SETTINGS = full_load.Settings(
    calendar_start=CALENDAR[0],
    calendar_end=CALENDAR[1],
    date_key_range=(19940101, 20021231),
    high_value_from=HIGH,
    regular_from=REGULAR,
)
LOAD_ID = "batch-1"

QUERIES: dict[str, Query] = {}
_stars: dict[tuple[str, str], Star] = {}


def comparable(df: DataFrame) -> DataFrame:
    """Plain result types: integers as bigint, decimals as double, dates as text."""
    out = []
    for field in df.schema.fields:
        column = F.col(field.name)
        if isinstance(field.dataType, (T.ByteType, T.ShortType, T.IntegerType, T.BooleanType)):
            column = column.cast("bigint")
        elif isinstance(field.dataType, (T.DecimalType, T.FloatType)):
            column = column.cast("double")
        elif isinstance(field.dataType, (T.DateType, T.TimestampType)):
            column = column.cast("string")
        out.append(column.alias(field.name))
    return df.select(*out)


def query(name: str):
    def register(build: Query) -> Query:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return comparable(build(spark, folder))

        run.__name__ = name
        QUERIES[name] = run
        return build

    return register


def star_query(name: str, build: Callable[[Star], DataFrame]) -> None:
    query(name)(lambda spark, folder: build(sample_star(spark, folder)))


# --- inputs ------------------------------------------------------------------

def scratch(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/{uuid.uuid4()}"


def clean_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Undamaged lines with all derived columns."""
    return order_lines(spark, folder).transform(cleaning.derived)


def source_text(spark: SparkSession, folder: str) -> DataFrame:
    """Damaged lines as a file reader delivers them."""
    return dirty_source(spark, folder).transform(cleaning.normalise_nulls, rules.CSV_NULL_TOKENS)


def cleaned(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.clean_orders(dirty_source(spark, folder), LOAD_ID, "sample", NOW)


def up_to(step) -> Query:
    return lambda spark, folder: cleaning.typed(dirty_source(spark, folder), last=step)


def stored_lines(wh: Warehouse, folder: str) -> DataFrame:
    """Undamaged lines as the processed snapshot, so the parent joins run once.

    Stored as they are delivered; readers compute the derived columns that they use.
    """
    path = files.save_processed(order_lines(wh.spark, folder), f"{wh.root}/processed", "sample")
    return wh.spark.read.parquet(path).transform(cleaning.derived)


def sample_warehouse(spark: SparkSession, folder: str) -> Warehouse:
    wh = Warehouse(spark, scratch(spark))
    lines = stored_lines(wh, folder)
    full_load.seed_dimensions(wh, SETTINGS, sample_geography(spark, folder))
    full_load.load_dimensions(wh, lines, SETTINGS, NOW)
    full_load.load_facts(wh, lines, SETTINGS)
    return wh


def sample_star(spark: SparkSession, folder: str) -> Star:
    """The star of a sample folder, loaded on first use in a session."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _stars:
        _stars[key] = full_load.open_star(sample_warehouse(spark, folder))
    return _stars[key]


def dims(spark: SparkSession, folder: str, lines: DataFrame):
    customer = dimensions.assign_surrogate_keys(
        dimensions.build_dim_customer(lines, NOW, HIGH, REGULAR), "customer_id", "customer_sk"
    )
    product = dimensions.assign_surrogate_keys(dimensions.build_dim_product(lines, NOW), "product_id", "product_sk")
    return customer, product, sample_geography(spark, folder)


def without_stamps(df: DataFrame) -> DataFrame:
    return df.drop("created_date", "last_updated_date")


# --- sources and sinks -------------------------------------------------------

@query("extract_csv")
def _extract_csv(spark, folder):
    path = scratch(spark)
    files.write_csv(dirty_source(spark, folder), path)
    return files.extract_csv(spark, path)


@query("landing_copy")
def _landing_copy(spark, folder):
    path = scratch(spark)
    files.write_csv(dirty_source(spark, folder), f"{path}/in", compression="gzip")
    files.landing_copy(spark, f"{path}/in", f"{path}/out", compression="gzip")
    return files.extract_fixed(spark, f"{path}/out")


@query("load_raw")
def _load_raw(spark, folder):
    path = scratch(spark)
    rows = files.with_audit(dirty_source(spark, folder), LOAD_ID, "sample", NOW)
    files.load_raw(rows, path)
    files.load_raw(rows, path)  # the same batch again replaces itself
    return spark.read.parquet(path)


@query("raw_bulk_copy")
def _raw_bulk_copy(spark, folder):
    path = scratch(spark)
    files.write_csv(dirty_source(spark, folder), f"{path}/in")
    files.raw_bulk_copy(spark, f"{path}/in", f"{path}/raw", LOAD_ID)
    return spark.read.parquet(f"{path}/raw").drop("etl_load_date", "etl_source_file")


@query("load_staging")
def _load_staging(spark, folder):
    path = scratch(spark)
    files.load_staging(cleaned(spark, folder), path)
    return spark.read.parquet(path)


@query("staging_computed")
def _staging_computed(spark, folder):
    staged = files.staging_computed(files.staging_rows(clean_lines(spark, folder).withColumn("dq_date_valid", F.lit(1))))
    return staged.select(
        "order_item_id", "calculated_revenue", "discount_amount", "order_year", "order_month", "customer_tenure_days"
    )


@query("save_processed")
def _save_processed(spark, folder):
    path = files.save_processed(cleaned(spark, folder), scratch(spark), "20010901_000000")
    return files.read_columns(spark, path)


@query("truncate_reload_fact")
def _truncate_reload_fact(spark, folder):
    wh = sample_warehouse(spark, folder)
    full_load.load_facts(wh, stored_lines(wh, folder), SETTINGS)
    counts = None
    for table in ("fact_order_items", "fact_order_summary", "fact_monthly_product_performance"):
        revenue_column = {
            "fact_order_items": "net_revenue",
            "fact_order_summary": "order_net_revenue",
            "fact_monthly_product_performance": "total_net_revenue",
        }[table]
        one = wh.read(table).agg(
            F.lit(table).alias("table_name"), F.count(F.lit(1)).alias("row_count"), F.sum(revenue_column).alias("net_revenue")
        )
        counts = one if counts is None else counts.unionByName(one)
    return counts


@query("read_fact_back")
def _read_fact_back(spark, folder):
    return sample_star(spark, folder).items.select(
        "order_item_id", "order_id", "order_date_key", "quantity", "gross_revenue", "net_revenue", "discount_amount"
    )


# --- cleaning ----------------------------------------------------------------

@query("clean_colnames")
def _clean_colnames(spark, folder):
    messy = dirty_source(spark, folder).toDF(*[f" {c.replace('_', '  ').title()}! " for c in files.SOURCE_COLUMNS])
    return cleaning.standardise_names(messy)


query("clean_dedup")(up_to(cleaning.drop_duplicate_rows))
query("clean_null_tokens")(up_to(cleaning.normalise_nulls))
query("clean_drop_null_keys")(up_to(cleaning.drop_null_keys))
query("rejected_keys")(lambda s, f: cleaning.rejected_keys(dirty_source(s, f)))

for _name, _step, _columns in (
    ("clean_fill_defaults", cleaning.fill_defaults, ("name", "city", "product_name", "category")),
    ("clean_cast_ids", cleaning.cast_ids, ("order_id", "product_id", "customer_id", "quantity")),
    ("clean_cast_money", cleaning.cast_money, ("total_amount", "price")),
    ("clean_strings", cleaning.standardise_texts, ("name", "city", "email", "product_name", "category")),
    ("clean_city_alias", cleaning.unify_cities, ("city",)),
    ("clean_category_alias", cleaning.unify_categories, ("category",)),
    ("clean_dates", cleaning.parse_dates, ("order_date", "signup_date")),
    ("dq_date_valid", cleaning.flag_valid_dates, ("dq_date_valid",)),
    ("clean_date_sentinel", cleaning.fill_missing_dates, ("order_date", "signup_date")),
    ("dq_order_before_signup", cleaning.flag_order_before_signup, ("dq_order_before_signup",)),
    ("clean_quantity_range", cleaning.repair_quantity, ("quantity",)),
):
    query(_name)(
        lambda s, f, step=_step, columns=_columns: up_to(step)(s, f).select("order_item_id", *columns)
    )


@query("profile_value_counts")
def _profile_value_counts(spark, folder):
    rows = up_to(cleaning.unify_categories)(spark, folder)
    return (
        cleaning.value_counts(rows, "category")
        .withColumn("column_name", F.lit("category"))
        .unionByName(cleaning.value_counts(rows, "city").withColumn("column_name", F.lit("city")))
    )


@query("clean_price_median")
def _clean_price_median(spark, folder):
    rows = materialize(cleaning.typed(dirty_source(spark, folder)).select("order_item_id", "price"))  # read twice
    return cleaning.repair_price(rows)


for _name, _columns in (
    ("clean_amount_recompute", ("total_amount",)),
    ("dq_email_valid", ("email", "dq_email_valid")),
    ("derive_revenue", ("gross_revenue", "net_revenue", "discount_amount", "discount_pct")),
    ("derive_tenure", ("customer_tenure_days",)),
    ("derive_year_month", ("order_year", "order_month")),
    ("price_band", ("price", "price_band")),
    ("audit_columns", ("etl_load_id", "etl_load_date", "etl_source_file")),
):
    query(_name)(lambda s, f, columns=_columns: cleaned(s, f).select("order_item_id", *columns))

query("clean_orders")(cleaned)
query("clean_summary")(lambda s, f: cleaning.clean_summary(dirty_source(s, f), cleaning.typed(dirty_source(s, f))))

# --- quality profile ---------------------------------------------------------

for _name, _profile in (
    ("dq_overview", quality.overview),
    ("dq_nulls", quality.null_profile),
    ("dq_duplicates", quality.duplicate_profile),
    ("dq_numeric_ranges", quality.numeric_profile),
    ("dq_dates", quality.date_profile),
    ("dq_categorical", quality.categorical_profile),
    ("dq_email", quality.email_profile),
    ("dq_score", quality.quality_score),
):
    query(_name)(lambda s, f, profile=_profile: profile(source_text(s, f)))

# --- dimensions --------------------------------------------------------------

@query("dim_date")
def _dim_date(spark, folder):
    orders = read_table(spark, folder, "orders")
    day = F.col("o_orderdate").cast("date")
    return calendar_between(orders.agg(F.min(day).alias("start"), F.max(day).alias("end")))


query("dim_customer")(lambda s, f: without_stamps(dimensions.build_dim_customer(clean_lines(s, f), NOW, HIGH, REGULAR)))
query("dim_product")(lambda s, f: without_stamps(dimensions.build_dim_product(clean_lines(s, f), NOW)))
query("dim_geography")(sample_geography)


@query("dim_channel")
def _dim_channel(spark, folder):
    used = order_lines(spark, folder).groupBy("channel_sk").agg(F.count(F.lit(1)).alias("line_count"))
    return (
        dimensions.build_dim_channel(spark)
        .join(used, "channel_sk", "left")
        .select("channel_sk", "channel_name", "channel_type", "channel_category", F.coalesce("line_count", F.lit(0)).alias("line_count"))
    )


@query("surrogate_keys")
def _surrogate_keys(spark, folder):
    """Keys of the customers before the split, then of all of them."""
    lines = order_lines(spark, folder)
    first = lines.filter(F.col("order_date") <= F.lit(SPLIT)).select("customer_id").distinct()
    known = dimensions.assign_surrogate_keys(first, "customer_id", "customer_sk")
    everyone = lines.select("customer_id").distinct()
    return dimensions.assign_surrogate_keys(everyone, "customer_id", "customer_sk", known)


@query("customer_segment")
def _customer_segment(spark, folder):
    return dimensions.build_dim_customer(clean_lines(spark, folder), NOW, HIGH, REGULAR).select(
        "customer_id", "total_orders", "total_lifetime_value", "customer_segment"
    )


# What a dimension is built from.
_BUILT_FROM = {
    "customer_id": ("order_id", "net_revenue", "name", "email", "city", "signup_date"),
    "product_id": ("product_name", "category", "price"),
}


def _before_and_after(spark, folder, build, natural_key, surrogate_key):
    needed = (natural_key, "order_item_id", "order_date", *_BUILT_FROM[natural_key])
    lines = materialize(clean_lines(spark, folder).select(*needed))
    earlier = lines.filter(F.col("order_date") <= F.lit(SPLIT))
    later = lines.filter(F.col("order_date") > F.lit(SPLIT))
    existing = dimensions.assign_surrogate_keys(build(earlier), natural_key, surrogate_key)
    return existing, build(later)


def _customers_of(lines):
    return dimensions.build_dim_customer(lines, NOW, HIGH, REGULAR)


def _products_of(lines):
    return dimensions.build_dim_product(lines, NOW)


@query("upsert_dim_type1")
def _upsert_dim_type1(spark, folder):
    existing, incoming = _before_and_after(spark, folder, _customers_of, "customer_id", "customer_sk")
    return without_stamps(upsert.upsert_type1(existing, incoming, "customer_id", "customer_sk", NOW))


@query("upsert_customer_changed")
def _upsert_customer_changed(spark, folder):
    existing, incoming = _before_and_after(spark, folder, _customers_of, "customer_id", "customer_sk")
    old_address = F.when(F.col("signup_month") == 1, F.lit(None).cast("string")).otherwise(F.col("email"))
    existing = existing.withColumn("email", old_address)
    return without_stamps(upsert.upsert_customers_changed(existing, incoming, NOW))


@query("upsert_product_changed")
def _upsert_product_changed(spark, folder):
    existing, incoming = _before_and_after(spark, folder, _products_of, "product_id", "product_sk")
    return without_stamps(upsert.upsert_products_changed(existing, incoming, NOW))


@query("merge_counts")
def _merge_counts(spark, folder):
    existing, incoming = _before_and_after(spark, folder, _products_of, "product_id", "product_sk")
    return upsert.merge_counts(upsert.upsert_products_changed(existing, incoming, NOW))


def _refreshed_from_all(keep: bool) -> Query:
    def run(spark, folder):
        """All customers start as new, those that never ordered too; statistics refreshed from all facts."""
        star = sample_star(spark, folder)
        everyone = read_table(spark, folder, "customer").select(F.col("c_custkey").alias("customer_id"))
        fresh = {"total_orders": F.lit(0), "total_lifetime_value": F.lit(0), "customer_segment": F.lit("New"), "last_updated_date": F.lit(NOW)}
        known = star.customers.select("customer_id", "customer_sk")
        starting = everyone.join(known, "customer_id", "left").withColumns(
            {name: value.cast(star.customers.schema[name].dataType) for name, value in fresh.items()}
        )
        done = dimensions.refresh_customer_stats(starting, star.items, NOW, keep, HIGH, REGULAR)
        return done.select("customer_id", "total_orders", "total_lifetime_value", "customer_segment")

    return run


for _name, _keep in (("refresh_customer_stats_inner", True), ("refresh_customer_stats", False)):
    query(_name)(_refreshed_from_all(_keep))
    query(f"{_name}_all_facts")(_refreshed_from_all(_keep))

# --- facts -------------------------------------------------------------------

@query("fact_order_items")
def _fact_order_items(spark, folder):
    lines = materialize(clean_lines(spark, folder))
    return facts.build_fact_order_items(lines, *dims(spark, folder, lines)).drop("etl_load_id")


@query("fact_order_items_sql")
def _fact_order_items_sql(spark, folder):
    """From staging rows; discount share and tenure keep their sign."""
    lines = materialize(clean_lines(spark, folder))
    staging = files.staging_rows(lines.withColumn("dq_date_valid", F.lit(1)))
    return facts.build_fact_from_staging(staging, *dims(spark, folder, lines), load_id=LOAD_ID, clip=False)


@query("unmapped_keys")
def _unmapped_keys(spark, folder):
    """Lines of the whole table against dimensions that end at the split."""
    lines = materialize(clean_lines(spark, folder).select("customer_id", "product_id", "order_date"))
    earlier = lines.filter(F.col("order_date") <= F.lit(SPLIT))
    return facts.count_unmapped(lines, earlier.select("customer_id").distinct(), earlier.select("product_id").distinct())


query("fact_order_summary")(lambda s, f: facts.build_fact_order_summary(sample_star(s, f).items))
query("fact_monthly_product")(lambda s, f: facts.monthly_product_base(sample_star(s, f).items))
query("monthly_mom_change")(
    lambda s, f: facts.build_fact_monthly_product(sample_star(s, f).items).select(
        "year_month_key", "product_sk", "total_net_revenue", "total_units_sold", "revenue_mom_change_pct", "units_mom_change_pct"
    )
)

# --- incremental loads and control -------------------------------------------

def _order_runs(spark, folder):
    """A run log made of orders: one run per order, one pipeline per priority."""
    status = F.when(F.col("o_orderstatus") == "F", "FAILED").otherwise("SUCCESS")
    return read_table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("run_seq"),
        F.col("o_orderpriority").alias("pipeline_name"),
        F.col("o_orderdate").cast("date").alias("last_loaded_date"),
        status.alias("last_run_status"),
        F.col("o_custkey").alias("rows_loaded"),
    )


query("hwm_read")(lambda s, f: high_water_marks(_order_runs(s, f)))


@query("hwm_upsert")
def _hwm_upsert(spark, folder):
    runs = _order_runs(spark, folder)
    done = current_runs(runs.filter(F.col("last_loaded_date") <= F.lit(SPLIT)))
    return upsert_runs(done, runs.filter(F.col("last_loaded_date") > F.lit(SPLIT)))


query("incremental_delta")(
    lambda s, f: incremental.incremental_delta(clean_lines(s, f), SPLIT).select(
        "order_item_id", "order_date", "net_revenue"
    )
)


@query("incremental_replace_window")
def _incremental_replace_window(spark, folder):
    """A fact that already holds the window, its window replaced: nothing repeats."""
    items = sample_star(spark, folder).items
    delta = items.filter(F.col("order_date_key") > incremental.key_of(SPLIT))
    return incremental.replace_window(items, delta, SPLIT).select("order_item_id", "order_date_key", "net_revenue")


def _loaded_in_two_steps(spark, folder) -> Warehouse:
    """Text rows loaded up to the split, then incrementally, then once more."""
    wh = Warehouse(spark, scratch(spark))
    source = dirty_source(spark, folder)
    early = source.filter(~(X.parse_date("order_date") > F.lit(SPLIT)) | X.parse_date("order_date").isNull())
    places_ = sample_geography(spark, folder)
    incremental.run_incremental(wh, early, "sample", settings=SETTINGS, geography=places_, load_time=NOW)
    incremental.run_incremental(wh, source, "sample", from_date=SPLIT, settings=SETTINGS, load_time=NOW)
    return wh


@query("run_incremental")
def _run_incremental(spark, folder):
    return _loaded_in_two_steps(spark, folder).read("fact_order_items").select(
        "order_item_id", "order_date_key", "quantity", "net_revenue"
    )


def _deliveries(lines: DataFrame) -> tuple[list[list[DataFrame]], list]:
    """Two calls with two deliveries each: days overlap, lines come again, corrected, with another day or quantity."""
    i = F.col("order_item_id")
    amount = F.when(i % 8 == 1, F.col("total_amount") + 10).otherwise(F.col("total_amount")).cast(T.DecimalType(18, 2))
    day = F.when((i % 4 == 2) & (i % 3 == 0), F.date_add("order_date", 31)).otherwise(F.col("order_date"))
    text = [F.col(c).cast("string").alias(c) for c in files.SOURCE_COLUMNS]
    return [
        [lines.filter((i % 4).isin(0, 1)), lines.withColumn("total_amount", amount).filter((i % 4).isin(1, 2))],
        [
            lines.withColumn("order_date", day).filter((i % 4 == 3) | (i % 4 == 2) & (i % 3 == 0)),
            lines.withColumn("quantity", F.col("quantity") + (i % 16 == 3).cast("int")).filter((i % 32 == 0) | (i % 16 == 3)),
        ],
    ], text


@query("stream_load")
def _stream_load(spark, folder):
    """Facts and dimensions after files were streamed in two calls: of each line the last delivery counts."""
    wh, path = Warehouse(spark, scratch(spark)), scratch(spark)
    calls, text = _deliveries(materialize(order_lines(spark, folder)))
    for deliveries in calls:
        for rows in deliveries:
            rows.select(*text).write.options(**files.CSV_OPTIONS).mode("append").csv(f"{path}/landing", compression="gzip")
        load_available(wh, f"{path}/landing", f"{path}/taken", SETTINGS, sample_geography(spark, folder))
    product = wh.lookup("dim_product")

    def rows(table, key, label, number, amount):
        return table.select(
            key.cast("bigint").alias("key"), label.cast("string").alias("label"), number.cast("bigint").alias("number"), amount.alias("amount")
        )

    c = F.col
    parts = {
        "fact_order_items": rows(wh.read("fact_order_items"), c("order_item_id"), c("order_date_key"), c("quantity"), c("net_revenue")),
        "fact_order_summary": rows(wh.read("fact_order_summary"), c("order_id"), c("order_date_key"), c("total_items"), c("order_net_revenue")),
        "monthly_units": rows(wh.read("fact_monthly_product_performance").join(product, "product_sk"), c("product_id"), c("year_month_key"), c("total_units_sold"), c("total_net_revenue")),
        "monthly_change": rows(wh.read("fact_monthly_product_performance").join(product, "product_sk"), c("product_id"), c("year_month_key"), c("total_customers"), c("units_mom_change_pct")),
        "dim_customer": rows(wh.read("dim_customer"), c("customer_id"), c("customer_segment"), c("total_orders"), c("total_lifetime_value")),
        "dim_product": rows(product, c("product_id"), c("product_name"), F.lit(0), c("unit_price")),
    }
    out = None
    for name, part in parts.items():
        part = part.withColumns({"amount": c("amount").cast("double"), "table_name": F.lit(name)})
        out = part if out is None else out.unionByName(part)
    return out


@query("rebuild_derived_facts")
def _rebuild_derived_facts(spark, folder):
    """Monthly fact after an incremental load that only touched the later months."""
    wh = Warehouse(spark, scratch(spark))
    lines = stored_lines(wh, folder)
    full_load.seed_dimensions(wh, SETTINGS, sample_geography(spark, folder))
    full_load.load_dimensions(wh, lines, SETTINGS, NOW)
    full_load.load_facts(wh, lines.filter(F.col("order_date") <= F.lit(SPLIT)), SETTINGS)
    incremental.load_window(wh, lines, SPLIT, SETTINGS)
    monthly = wh.read("fact_monthly_product_performance")
    product = wh.lookup("dim_product").select("product_sk", "product_id")
    return monthly.join(product, "product_sk").select(
        F.col("year_month_key").cast("string").alias("year_month_key"),
        "product_id",
        "total_net_revenue",
        "total_orders",
        "total_customers",
        "revenue_mom_change_pct",
        "units_mom_change_pct",
    )


@query("quarantine")
def _quarantine(spark, folder):
    """What a full load of the damaged lines left out, and why."""
    wh = Warehouse(spark, scratch(spark))
    full_load.run_pipeline(
        wh, dirty_source(spark, folder), "sample", SETTINGS, skip_raw=True, geography=sample_geography(spark, folder), load_time=NOW
    )
    return wh.read("quarantine").drop("etl_load_id").withColumn("reasons", F.array_join("reasons", ", "))


@query("full_load")
def _full_load(spark, folder):
    wh = Warehouse(spark, scratch(spark))
    source = materialize(dirty_source(spark, folder))  # the delivery, which the raw and the clean layer read
    full_load.run_pipeline(
        wh, source, "sample", SETTINGS, geography=sample_geography(spark, folder), load_time=NOW
    )
    return wh.read("dim_customer").select(
        "customer_id", "customer_name", "city", "total_orders", "total_lifetime_value", "customer_segment"
    )


@query("dry_run_describe")
def _dry_run_describe(spark, folder):
    """All columns but the batch id, which differs from run to run; means and deviations to single precision."""
    wh = Warehouse(spark, scratch(spark))
    rows = full_load.run_pipeline(wh, dirty_source(spark, folder), dry_run=True, load_time=NOW)
    shown = describe_all(rows.drop("etl_load_id"))
    return shown.withColumns({c: F.col(c).cast("float") for c in ("mean", "std")})


@query("run_full_etl")
def _run_full_etl(spark, folder):
    wh = Warehouse(spark, scratch(spark))
    files.load_staging(cleaned(spark, folder), wh.path("staging", "order_items"))
    full_load.seed_dimensions(wh, SETTINGS, sample_geography(spark, folder))
    full_load.run_from_staging(wh, SETTINGS, NOW)
    return wh.read("fact_order_summary").select(
        "order_id", "order_date_key", "total_items", "total_quantity", "order_net_revenue", "distinct_products"
    )


# --- analytics ---------------------------------------------------------------

star_query("revenue_by_quarter", revenue.revenue_by_quarter)
star_query("monthly_growth", revenue.monthly_growth)
star_query("category_share", revenue.category_share)
star_query("top_products", products.top_products)
star_query("abc_classification", products.abc_classification)
star_query("rfm_segmentation", lambda star: customers.rfm_segmentation(star, AS_OF))
star_query("cohort_retention", customers.cohort_retention)
star_query("clv_ranking", customers.clv_ranking)
star_query("city_year_share", places.city_year_share)
star_query("city_category", places.city_category)
star_query("repeat_purchase_rate", customers.repeat_purchase_rate)
star_query("new_vs_returning", customers.new_vs_returning)
star_query("channel_share", places.channel_share)
star_query("channel_category", places.channel_category)
star_query("kpi_summary", revenue.kpi_summary)

star_query("vw_monthly_revenue", views.vw_monthly_revenue)
star_query("vw_product_performance", views.vw_product_performance)
star_query("vw_city_performance", views.vw_city_performance)
star_query("vw_customer_360", lambda star: views.vw_customer_360(star, AS_OF))

# --- dashboard measures ------------------------------------------------------

star_query("exec_kpis", measures.exec_kpis)
star_query("revenue_orders_trend", measures.revenue_orders_trend)
star_query("yoy_month_matrix", measures.yoy_month_matrix)
star_query("seasonality_matrix", measures.seasonality_matrix)
star_query(
    "slice",
    lambda star: measures.exec_kpis(
        slice_star(star, date(1996, 3, 15), date(1999, 10, 20), ("ECONOMY", "PROMO"), ("NATION_1", "NATION_2", "NATION_7"))
    ),
)
star_query("best_category", measures.best_category)
star_query("avg_catalog_price", measures.avg_catalog_price)
star_query("category_trend", measures.category_trend)
star_query("price_band_distribution", measures.price_band_distribution)
star_query("pareto", products.pareto)
star_query("customer_ltv", measures.customer_ltv)
star_query("avg_customer_ltv", measures.avg_customer_ltv)
star_query("repeat_buyers", measures.repeat_buyers)
star_query("at_risk_customers", lambda star: measures.at_risk_customers(star, AS_OF))
star_query("segment_breakdown", measures.segment_breakdown)
star_query("rfm_points", lambda star: measures.rfm_points(star, AS_OF))
star_query("customer_acquisition", measures.customer_acquisition)
star_query("top_customers", measures.top_customers)
star_query("city_segment_matrix", measures.city_segment_matrix)
star_query("category_mix_by_city", measures.category_mix_by_city)
star_query("city_market_share", measures.city_market_share)
star_query("revenue_yoy", measures.revenue_yoy)
star_query("revenue_ytd", measures.revenue_ytd)
star_query("revenue_3m_rolling", measures.revenue_3m_rolling)
star_query("weekday_weekend", measures.weekday_weekend)
star_query("qoq_waterfall", measures.qoq_waterfall)
star_query("category_revenue", measures.category_revenue)
star_query("city_revenue", measures.city_revenue)
star_query("product_matrix", measures.product_matrix)
star_query("new_customers_month", measures.new_customers_month)

# --- constraints, layout, access ---------------------------------------------

@query("check_constraints")
def _check_constraints(spark, folder):
    """Damaged lines against the published ranges, before any repair."""
    rows = up_to(cleaning.fill_missing_dates)(spark, folder).withColumns(
        {"order_date_key": X.date_key("order_date"), "net_revenue": F.col("total_amount"), "unit_price": F.col("price")}
    )
    checks = {**constraints.fact_rules(SETTINGS.date_key_range), **constraints.staging_rules()}
    return constraints.check_constraints(rows, checks)


@query("fk_integrity")
def _fk_integrity(spark, folder):
    """Facts of all lines against a calendar that ends at the split."""
    star = sample_star(spark, folder)
    short = Star(**{**star.__dict__, "dates": build_dim_date(spark, CALENDAR[0], SPLIT)})
    return constraints.fk_integrity(short)


@query("unique_keys")
def _unique_keys(spark, folder):
    star = sample_star(spark, folder)
    lines = read_table(spark, folder, "lineitem")
    report = constraints.duplicate_keys(lines, "lineitem", ["l_orderkey", "l_linenumber"])
    for df, table, keys in (
        (star.customers, "dim_customer", ["customer_id"]),
        (star.products, "dim_product", ["product_id"]),
        (star.geography, "dim_geography", ["city_name"]),
        (star.dates, "dim_date", ["full_date"]),
        (star.orders, "fact_order_summary", ["order_id"]),
        (star.monthly, "fact_monthly_product_performance", ["year_month_key", "product_sk"]),
    ):
        report = report.unionByName(constraints.duplicate_keys(df, table, keys))
    return report


@query("year_partition_layout")
def _year_partition_layout(spark, folder):
    """Rows per year, answered from the partition columns."""
    return sample_star(spark, folder).items.groupBy("order_year").agg(F.count(F.lit(1)).alias("row_count"))


star_query("mask_email", lambda star: access.masked_customers(star.customers).select("customer_id", "email"))


@query("row_filter_city")
def _row_filter_city(spark, folder):
    """Each region is a user entitled to the cities of its nations."""
    star = sample_star(spark, folder)
    entitlements = star.geography.select(F.col("region").alias("user_name"), "city_name")
    return access.rows_for_user(star.items, star.geography, entitlements, "ASIA").select("order_item_id", "net_revenue")
