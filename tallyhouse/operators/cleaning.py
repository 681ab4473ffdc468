"""The cleaning rules, one function each, and their composition.

The order is part of the meaning: names, duplicates, nulls, keys, defaults,
types, texts, dates, ranges, e-mail, derived columns, band, audit.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions import expressions as X
from tallyhouse.functions import rules
from tallyhouse.operators import quarantine
from tallyhouse.operators.ordering import weighted_median
from tallyhouse.schemas import CRITICAL_KEYS, MONEY, RATIO
from tallyhouse.session import materialize
from tallyhouse.sources.files import with_audit


def standard_name(name: str) -> str:
    name = re.sub(r"\s+", "_", name.strip().lower())
    return re.sub(r"[^a-z0-9_]", "", name)


def standardise_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[standard_name(c) for c in df.columns])


def drop_duplicate_rows(df: DataFrame) -> DataFrame:
    """Exact full-row duplicates; copies meet map-side before the shuffle."""
    return df.dropDuplicates()


def normalise_nulls(df: DataFrame, tokens: Sequence[str] = rules.NULL_TOKENS) -> DataFrame:
    """Missing-value texts of all text columns to null."""
    texts = {name for name, kind in df.dtypes if kind == "string"}
    return df.select(*[X.null_if_token(c, tokens).alias(c) if c in texts else F.col(c) for c in df.columns])


def drop_null_keys(df: DataFrame) -> DataFrame:
    return df.dropna(subset=list(CRITICAL_KEYS))


def fill_defaults(df: DataFrame) -> DataFrame:
    return df.fillna(rules.FILL_DEFAULTS)


def cast_ids(df: DataFrame) -> DataFrame:
    """Ids to bigint, quantity to int; what cannot be read becomes null."""
    ids = {c: X.to_long(c) for c in CRITICAL_KEYS}
    return df.withColumns({**ids, "quantity": X.to_int("quantity")})


def drop_unreadable_keys(df: DataFrame) -> DataFrame:
    """Keys that were text but no number; ``rejected_keys`` lists them."""
    return drop_null_keys(df)


def cast_money(df: DataFrame) -> DataFrame:
    return df.withColumns({c: X.to_money(c) for c in ("total_amount", "price")})


def standardise_texts(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "city": X.title_case(F.trim("city")),
            "name": F.trim("name"),
            "category": X.title_case(F.trim("category")),
            "product_name": F.trim("product_name"),
            "email": F.lower(F.trim("email")),
        }
    )


def unify_cities(df: DataFrame, aliases=rules.CITY_ALIASES) -> DataFrame:
    return df.withColumn("city", X.replace_alias("city", aliases))


def unify_categories(df: DataFrame, aliases=rules.CATEGORY_ALIASES) -> DataFrame:
    return df.withColumn("category", X.replace_alias("category", aliases))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("row_count"))


def parse_dates(df: DataFrame, formats: Sequence[str] = rules.DATE_FORMATS) -> DataFrame:
    return df.withColumns({c: X.parse_date(c, formats) for c in ("order_date", "signup_date")})


def flag_valid_dates(df: DataFrame) -> DataFrame:
    both = F.col("order_date").isNotNull() & F.col("signup_date").isNotNull()
    return df.withColumn("dq_date_valid", both.cast("int"))


def fill_missing_dates(df: DataFrame) -> DataFrame:
    sentinel = F.lit(rules.DATE_SENTINEL)
    return df.withColumns({c: F.coalesce(F.col(c), sentinel) for c in ("order_date", "signup_date")})


def flag_order_before_signup(df: DataFrame) -> DataFrame:
    return df.withColumn("dq_order_before_signup", (F.col("order_date") < F.col("signup_date")).cast("int"))


def repair_quantity(df: DataFrame) -> DataFrame:
    return df.withColumn("quantity", F.when(F.col("quantity") > 0, F.col("quantity")).otherwise(1))


def repair_price(df: DataFrame) -> DataFrame:
    """Null or non-positive prices become the median of the others.

    The median comes from distinct prices with counts, combined map-side and
    walked in range buckets, so no task holds all prices.
    """
    valid = F.col("price") > 0
    counts = df.filter(valid).groupBy("price").agg(F.count(F.lit(1)).alias("weight"))
    median = F.round(weighted_median(counts, "price", "weight"), 2).cast(MONEY)
    return df.withColumn("price", F.when(valid, F.col("price")).otherwise(median))


def repair_amount(df: DataFrame) -> DataFrame:
    """Null or non-positive amounts become quantity times (repaired) price."""
    product = (F.col("quantity") * F.col("price")).cast(MONEY)
    return df.withColumn("total_amount", F.when(F.col("total_amount") > 0, F.col("total_amount")).otherwise(product))


def flag_valid_email(df: DataFrame) -> DataFrame:
    return df.withColumn("dq_email_valid", X.email_valid("email"))


def derive_revenue(df: DataFrame) -> DataFrame:
    """Gross, net, discount (never negative) and discount share of gross."""
    zero = F.lit(0).cast(MONEY)
    return (
        df.withColumns(
            {
                "gross_revenue": F.round(F.col("quantity") * F.col("price"), 2).cast(MONEY),
                "net_revenue": F.col("total_amount").cast(MONEY),
            }
        )
        .withColumn("discount_amount", F.greatest(F.col("gross_revenue") - F.col("net_revenue"), zero).cast(MONEY))
        .withColumn(
            "discount_pct",
            F.when(F.col("gross_revenue") > 0, F.round(F.try_divide("discount_amount", "gross_revenue"), 4))
            .otherwise(0)
            .cast(RATIO),
        )
    )


def derive_tenure(df: DataFrame) -> DataFrame:
    return df.withColumn("customer_tenure_days", F.greatest(F.datediff("order_date", "signup_date"), F.lit(0)))


def derive_year_month(df: DataFrame) -> DataFrame:
    return df.withColumns({"order_year": F.year("order_date"), "order_month": F.month("order_date")})


def assign_price_band(df: DataFrame, bands=rules.PRICE_BANDS) -> DataFrame:
    return df.withColumn("price_band", X.price_band("price", bands))


# --- compositions ------------------------------------------------------------

# Text rows to typed rows, in order.
STEPS = (
    standardise_names,
    drop_duplicate_rows,
    normalise_nulls,
    drop_null_keys,
    fill_defaults,
    cast_ids,
    drop_unreadable_keys,
    cast_money,
    standardise_texts,
    unify_cities,
    unify_categories,
    parse_dates,
    flag_valid_dates,
    fill_missing_dates,
    flag_order_before_signup,
    repair_quantity,
)


def typed(df: DataFrame, formats: Sequence[str] = rules.DATE_FORMATS, last=None, first=None) -> DataFrame:
    """All steps, or those from ``first`` up to and including ``last``."""
    for step in STEPS[STEPS.index(first) if first else 0 :]:
        df = df.transform(step, formats) if step is parse_dates else df.transform(step)
        if step is last:
            break
    return df


def derived(df: DataFrame) -> DataFrame:
    """Columns computed from rows whose prices are repaired."""
    return (
        df.transform(repair_amount)
        .transform(flag_valid_email)
        .transform(derive_revenue)
        .transform(derive_tenure)
        .transform(derive_year_month)
        .transform(assign_price_band)
    )


def clean_orders(
    df: DataFrame,
    load_id: str,
    source_file: str = "",
    load_time=None,
    formats: Sequence[str] = rules.DATE_FORMATS,
    stage: bool = True,
) -> DataFrame:
    """The whole cleaning pipeline.

    The price median needs one pass over the typed rows before the final pass.
    With ``stage`` they are kept in the shared folder in between, so that the
    full-row duplicate shuffle runs once.
    """
    rows = typed(df, formats)
    rows = materialize(rows) if stage else rows
    return rows.transform(repair_price).transform(derived).transform(with_audit, load_id, source_file, load_time)


def clean_split(
    df: DataFrame, load_id: str, source_file: str = "", load_time=None, formats: Sequence[str] = rules.DATE_FORMATS
) -> tuple[DataFrame, DataFrame]:
    """(cleaned rows as of ``clean_orders``, rejected rows with their reasons), from one pass over the source.

    Rows without exact duplicates are written once, split by whether a key is at fault; both results read their part.
    """
    text = typed(df, last=normalise_nulls)
    tagged = text.withColumn(quarantine.REASONS, quarantine.reasons_of(quarantine.key_faults()))
    stored = materialize(tagged.withColumn("_rejected", F.size(quarantine.REASONS) > 0), ("_rejected",))
    accepted = stored.filter(~F.col("_rejected")).select(*text.columns)
    rows = typed(accepted, formats, first=drop_null_keys).transform(repair_price).transform(derived)
    rejected = stored.filter("_rejected").select(*text.columns, quarantine.REASONS)
    return rows.transform(with_audit, load_id, source_file, load_time), rejected


def rejected_keys(df: DataFrame) -> DataFrame:
    """Rows that cleaning drops for their keys, with the reason."""
    rows = typed(df, last=normalise_nulls)
    missing = F.lit(False)
    unreadable = F.lit(False)
    for key in CRITICAL_KEYS:
        missing = missing | F.col(key).isNull()
        unreadable = unreadable | X.to_long(key).isNull()
    return (
        rows.withColumn("reason", F.when(missing, "null key").when(unreadable, "unreadable key"))
        .filter(F.col("reason").isNotNull())
    )


def clean_summary(raw: DataFrame, cleaned: DataFrame) -> DataFrame:
    """Rows in, out and removed as (metric, value)."""
    rows_in = raw.agg(F.count(F.lit(1)).alias("rows_in"), F.lit(0).cast("bigint").alias("rows_out"))
    rows_out = cleaned.agg(F.lit(0).cast("bigint").alias("rows_in"), F.count(F.lit(1)).alias("rows_out"))
    both = rows_in.unionByName(rows_out).agg(F.sum("rows_in").alias("rows_in"), F.sum("rows_out").alias("rows_out"))
    return both.withColumn("rows_removed", F.col("rows_in") - F.col("rows_out")).unpivot(
        [], ["rows_in", "rows_out", "rows_removed"], "metric", "value"
    )
