"""Column expressions shared by the operators.  All stay inside codegen."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyhouse.functions import rules
from tallyhouse.schemas import MONEY


def as_column(value) -> Column:
    return F.col(value) if isinstance(value, str) else value


# --- text --------------------------------------------------------------------

def null_if_token(value, tokens: Sequence[str] = rules.NULL_TOKENS) -> Column:
    """Null when the text is exactly one of the tokens (no trimming)."""
    text = as_column(value)
    return F.when(~text.isin(*tokens), text)


def title_case(value) -> Column:
    """Capital after every non-letter, so ``al-qahira`` becomes ``Al-Qahira``.

    ``initcap`` only capitalises after whitespace.
    """
    runs = F.regexp_extract_all(F.lower(as_column(value)), F.lit(r"(\p{L}+|[^\p{L}]+)"), F.lit(1))
    capitalised = F.transform(runs, lambda run: F.concat(F.upper(F.left(run, F.lit(1))), F.substring(run, 2, 2**31 - 1)))
    return F.array_join(capitalised, "")


def replace_alias(value, aliases: Mapping[str, str]) -> Column:
    """Replace exact texts through a literal lookup."""
    text = as_column(value)
    chain = None
    for wrong, right in aliases.items():
        chain = F.when(text == wrong, right) if chain is None else chain.when(text == wrong, right)
    return text if chain is None else chain.otherwise(text)


def email_valid(value) -> Column:
    """1 for a well-formed address, 0 otherwise and for null."""
    return F.coalesce(as_column(value).rlike(rules.EMAIL_PATTERN), F.lit(False)).cast("int")


def mask_email(value) -> Column:
    """First letter, then a constant tail."""
    return F.concat(F.left(as_column(value), F.lit(1)), F.lit("XXX@XXXX.com"))


# --- numbers -----------------------------------------------------------------

def to_long(value) -> Column:
    """Number in text to bigint, truncating a fraction; bad text to null."""
    return as_column(value).try_cast("decimal(38,6)").try_cast("bigint")


def to_int(value) -> Column:
    return as_column(value).try_cast("decimal(38,6)").try_cast("int")


def to_money(value) -> Column:
    """Number in text to decimal(18,2), half up; bad text to null."""
    return F.round(as_column(value).try_cast("decimal(38,6)"), 2).try_cast(MONEY)


def safe_ratio(numerator, denominator) -> Column:
    """Exact decimal ratio with 16 digits; null when the denominator is zero or null.

    The 22-digit operands leave room for 20 digits before the point.
    """
    wide = "decimal(22,2)"
    return F.try_divide(as_column(numerator).cast(wide), as_column(denominator).cast(wide))


def pct(numerator, denominator, digits: int = 2) -> Column:
    """``100 * numerator / denominator`` rounded half up; null for a zero denominator."""
    return F.round(safe_ratio(as_column(numerator) * 100, denominator), digits)


def growth(current, prior, digits: int = 4) -> Column:
    """``(current - prior) / prior``; null without a prior value or with zero."""
    now, before = as_column(current), as_column(prior)
    return F.round(safe_ratio(now - before, before), digits)


# --- dates -------------------------------------------------------------------

def parse_date(value, formats: Sequence[str] = rules.DATE_FORMATS) -> Column:
    """First format that fits; null when none does (ANSI casts would raise)."""
    text = as_column(value)
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(fmt)).cast("date") for fmt in formats])


def date_key(value) -> Column:
    """Date to integer YYYYMMDD, by arithmetic rather than formatting."""
    day = as_column(value)
    return F.year(day) * 10000 + F.month(day) * 100 + F.day(day)


def line_order(day, line="order_item_id") -> Column:
    """Day and line id as one number, larger for newer lines.

    A number of fixed width is compared in a hash aggregate, where a struct of both would need sorted rows.
    """
    days = F.coalesce(F.unix_date(as_column(day)), F.lit(-10_000_000)) + 10_000_000
    wide = "decimal(38,0)"
    return (days.cast("decimal(10,0)") * F.lit(Decimal(10**20))).cast(wide) + (
        F.coalesce(as_column(line).cast("bigint"), F.lit(-(2**63))).cast("decimal(20,0)") + F.lit(Decimal(2**63))
    ).cast(wide)


def month_of_key(key) -> Column:
    """Month number counted from year 0, of an integer YYYYMMDD key."""
    number = as_column(key)
    return F.floor(number / 10000).cast("int") * 12 + F.floor(number / 100).cast("int") % 100 - 1


def month_text_of_key(key) -> Column:
    """``YYYY-MM`` of an integer YYYYMMDD key."""
    digits = as_column(key).cast("string")
    return F.concat(F.substring(digits, 1, 4), F.lit("-"), F.substring(digits, 5, 2))


def date_of_key(key) -> Column:
    number = as_column(key)
    return F.make_date(
        F.floor(number / 10000).cast("int"),
        F.floor(number / 100).cast("int") % 100,
        number % 100,
    )


# --- classifications ---------------------------------------------------------

def price_band(price, bands=rules.PRICE_BANDS) -> Column:
    amount = as_column(price)
    chain = None
    for name, low, high in bands:
        inside = amount >= low if high is None else (amount >= low) & (amount < high)
        chain = F.when(inside, name) if chain is None else chain.when(inside, name)
    return chain.otherwise("Unknown")


def customer_segment(lifetime_value, orders, high=rules.HIGH_VALUE_FROM, regular=rules.REGULAR_FROM) -> Column:
    value, count = as_column(lifetime_value), as_column(orders)
    return (
        F.when((value >= high[0]) | (count >= high[1]), "High Value")
        .when((value >= regular[0]) | (count >= regular[1]), "Regular")
        .when(count == 1, "New")
        .otherwise("Developing")
    )


def rfm_segment(r, f, m) -> Column:
    r, f, m = as_column(r), as_column(f), as_column(m)
    return (
        F.when((r >= 4) & (f >= 4) & (m >= 4), "Champions")
        .when((r >= 3) & (f >= 3), "Loyal Customers")
        .when((r >= 4) & (f <= 2), "Recent Customers")
        .when((r <= 2) & (f >= 3) & (m >= 3), "At Risk")
        .when((r <= 2) & (f <= 2) & (m <= 2), "Lost")
        .when(m >= 4, "High Spenders")
        .otherwise("Regular")
    )


def abc_class(running, total, cuts=rules.ABC_CUTS) -> Column:
    """Exact decimal comparison: running * 100 against cut * total."""
    scaled = as_column(running) * 100
    whole = as_column(total)
    return (
        F.when(scaled <= whole * cuts[0], "A - High Value")
        .when(scaled <= whole * cuts[1], "B - Mid Value")
        .otherwise("C - Low Value")
    )


def quality_grade(score) -> Column:
    value = as_column(score)
    chain = None
    for grade, floor in rules.DQ_GRADES:
        chain = F.when(value >= floor, grade) if chain is None else chain.when(value >= floor, grade)
    return chain.otherwise("D")
