"""Dimensions, facts and upserts on small frames."""

from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyhouse.operators import access, cleaning, constraints, dimensions, facts, upsert
from tallyhouse.operators.calendar import build_dim_date
from tallyhouse.session import literal_rows

NOW = datetime(2024, 1, 1)
LATER = datetime(2024, 2, 1)


@pytest.fixture
def lines(source):
    def make(*overrides):
        return cleaning.clean_orders(source(*overrides), "load-1")

    return make


def item(i, **extra):
    return {"order_item_id": str(i), "order_id": str(i), **{k: str(v) for k, v in extra.items()}}


def test_one_customer_row_per_id(lines):
    rows = [item(i, customer_id=1 + i % 3) for i in range(6)]
    dim = dimensions.build_dim_customer(lines(*rows), NOW).collect()
    assert len(dim) == 3
    assert {r["customer_segment"] for r in dim} <= {"High Value", "Regular", "New", "Developing"}


@pytest.mark.parametrize(
    "orders,amount,segment",
    [(10, 2500, "High Value"), (5, 1, "High Value"), (1, 20000, "High Value"), (3, 1, "Regular"), (1, 8000, "Regular"),
     (1, 10, "New"), (2, 10, "Developing")],
)
def test_segment(lines, orders, amount, segment):
    rows = [item(i, total_amount=amount) for i in range(orders)]
    assert dimensions.build_dim_customer(lines(*rows), NOW).first()["customer_segment"] == segment


def test_latest_price_wins(lines):
    rows = lines(
        item(1, product_id=10, price=1200, order_date="2023-05-01"), item(2, product_id=10, price=900, order_date="2022-05-01")
    )
    (product,) = dimensions.build_dim_product(rows, NOW).collect()
    assert product["unit_price"] == Decimal("1200.00") and product["price_band"] == "Mid-Range"


def test_same_day_tie_goes_to_the_larger_line_id(lines):
    rows = lines(item(1, city="Giza"), item(2, city="Tanta"))
    assert dimensions.build_dim_customer(rows, NOW).first()["city"] == "Tanta"


def test_seeded_dimensions(spark):
    cities = {r["city_name"]: r["geography_sk"] for r in dimensions.build_dim_geography(spark).collect()}
    assert cities == {"Cairo": 1, "Giza": 2, "Alexandria": 3, "Mansoura": 4, "Tanta": 5, "Unknown": 0}
    assert dimensions.build_dim_geography(spark, with_unknown=False).count() == 5
    assert [r["channel_sk"] for r in dimensions.build_dim_channel(spark).orderBy("channel_sk").collect()] == list(range(1, 8))


def test_calendar(spark):
    days = build_dim_date(spark)
    assert days.count() == 4383 and len(days.columns) == 19
    row = days.filter("date_key = 20210103").first()
    assert (row["week_of_year"], row["day_of_week"], row["is_weekend"], row["year_quarter"]) == (53, 1, 1, "2021-Q1")
    leap = days.filter("date_key = 20240229").first()
    assert (leap["is_leap_year"], leap["days_in_month"], leap["month_name_short"]) == (1, 29, "Feb")


def test_surrogate_keys_stay_and_continue(spark):
    known = literal_rows(spark, [(5, 2), (7, 1)], "nk long, sk long")
    incoming = literal_rows(spark, [(9,), (5,), (3,)], "nk long")
    keyed = dimensions.assign_surrogate_keys(incoming, "nk", "sk", known)
    assert sorted((r["nk"], r["sk"]) for r in keyed.collect()) == [(3, 3), (5, 2), (9, 4)]


def keyed(spark, lines):
    customers = literal_rows(spark, [(1, 10), (2, 20)], "customer_id long, customer_sk long")
    products = literal_rows(spark, [(10, 100), (20, 200)], "product_id long, product_sk long")
    return facts.build_fact_order_items(lines, customers, products, dimensions.build_dim_geography(spark))


def two_lines(lines, **second):
    return lines(
        item(1, customer_id=1, product_id=10, quantity=2, price=300, total_amount=540),
        {**item(2, customer_id=2, product_id=20), **{k: str(v) for k, v in second.items()}},
    )


def test_fact_keys_and_measures(spark, lines):
    rows = {r["customer_sk"]: r for r in keyed(spark, two_lines(lines)).collect()}
    assert set(rows) == {10, 20} and rows[10]["product_sk"] == 100 and rows[10]["order_date_key"] == 20220615
    assert (rows[10]["gross_revenue"], rows[10]["net_revenue"], rows[10]["discount_amount"]) == (600, 540, 60)
    assert rows[10]["geography_sk"] == 1 and rows[10]["channel_sk"] == 1


def test_unmapped_lines_drop_and_are_counted(spark, lines):
    rows = two_lines(lines, customer_id=99)
    assert keyed(spark, rows).count() == 1
    customers = literal_rows(spark, [(1,)], "customer_id long")
    products = literal_rows(spark, [(10,), (20,)], "product_id long")
    counts = {r["natural_key"]: r["row_count"] for r in facts.count_unmapped(rows, customers, products).collect()}
    assert counts == {"customer_id": 1, "product_id": 0}


def test_unknown_city_takes_the_default_member(spark, lines):
    rows = two_lines(lines, city="Aswan")
    assert {r["geography_sk"] for r in keyed(spark, rows).collect()} == {0, 1}
    none = literal_rows(spark, [(1, 10), (2, 20)], "customer_id long, customer_sk long")
    products = literal_rows(spark, [(10, 100), (20, 200)], "product_id long, product_sk long")
    fact = facts.build_fact_order_items(rows, none, products, dimensions.build_dim_geography(spark), default_geography=5)
    assert {r["geography_sk"] for r in fact.collect()} == {5, 1}


def test_order_grain(spark, lines):
    rows = lines(
        {**item(1, customer_id=1, product_id=10), "order_id": "100"},
        {**item(2, customer_id=1, product_id=20), "order_id": "100"},
        {**item(3, customer_id=2, product_id=10), "order_id": "101"},
    )
    orders = {r["order_id"]: r for r in facts.build_fact_order_summary(keyed(spark, rows)).collect()}
    assert set(orders) == {100, 101}
    assert orders[100]["total_items"] == 2 and orders[100]["distinct_products"] == 2 and orders[100]["total_quantity"] == 4


def test_month_grain_and_change(spark, lines):
    rows = [item(i, customer_id=1, product_id=10, quantity=1, total_amount=100, order_date=f"2022-03-{i + 1:02d}") for i in range(5)]
    rows.append(item(9, customer_id=2, product_id=10, quantity=2, total_amount=250, order_date="2022-06-01"))
    monthly = facts.build_fact_monthly_product(keyed(spark, lines(*rows))).orderBy("year_month_key").collect()
    assert [r["year_month_key"] for r in monthly] == ["2022-03", "2022-06"]
    assert monthly[0]["total_orders"] == 5 and monthly[0]["total_units_sold"] == 5
    assert monthly[0]["revenue_mom_change_pct"] is None
    assert monthly[1]["revenue_mom_change_pct"] == Decimal("-0.5000") and monthly[1]["units_mom_change_pct"] == Decimal("-0.6000")


def test_zero_prior_month_gives_null(spark):
    monthly = literal_rows(
        spark, [("2022-01", 1, Decimal(0), 0), ("2022-02", 1, Decimal(5), 3)],
        "year_month_key string, product_sk long, total_net_revenue decimal(18,2), total_units_sold long",
    )
    last = facts.with_month_change(monthly).orderBy("year_month_key").collect()[-1]
    assert last["revenue_mom_change_pct"] is None and last["units_mom_change_pct"] is None


def test_fact_from_staging_sign(spark, lines):
    from tallyhouse.sources.files import staging_rows

    rows = staging_rows(lines(item(1, customer_id=1, product_id=10, quantity=1, price=100, total_amount=150, order_date="2020-12-31")))
    customers = literal_rows(spark, [(1, 10)], "customer_id long, customer_sk long")
    products = literal_rows(spark, [(10, 100)], "product_id long, product_sk long")
    args = (rows, customers, products, dimensions.build_dim_geography(spark))
    signed = facts.build_fact_from_staging(*args, clip=False).first()
    clipped = facts.build_fact_from_staging(*args).first()
    assert signed["discount_pct"] == Decimal("-0.5000") and signed["customer_tenure_days"] == -1
    assert clipped["discount_pct"] == 0 and clipped["customer_tenure_days"] == 0 and clipped["discount_amount"] == 0


# --- upserts ---

def products(spark, rows):
    frame = literal_rows(
        spark, [(i, n, "Books", Decimal(p)) for i, n, p in rows],
        "product_id long, product_name string, category string, unit_price decimal(18,2)",
    )
    return frame.withColumns(
        {"price_band": F.lit("Budget"), "created_date": F.lit(NOW), "last_updated_date": F.lit(NOW), "is_active": F.lit(1)}
    )


def test_upsert_keeps_created_date_and_keys(spark):
    existing = dimensions.assign_surrogate_keys(products(spark, [(1, "a", 5), (3, "c", 5)]), "product_id", "product_sk")
    incoming = products(spark, [(3, "c2", 6), (2, "b", 7)]).withColumn("created_date", F.lit(LATER)).withColumn("last_updated_date", F.lit(LATER))
    merged = {r["product_id"]: r for r in upsert.upsert_type1(existing, incoming, "product_id", "product_sk", LATER).collect()}
    assert {i: r["product_sk"] for i, r in merged.items()} == {1: 1, 3: 2, 2: 3}
    assert {i: r["action"] for i, r in merged.items()} == {1: "unchanged", 3: "update", 2: "insert"}
    assert merged[3]["created_date"] == NOW and merged[3]["last_updated_date"] == LATER and merged[3]["product_name"] == "c2"
    assert merged[1]["last_updated_date"] == NOW and merged[2]["created_date"] == LATER


def test_changed_only_upsert_is_null_safe(spark):
    existing = dimensions.assign_surrogate_keys(products(spark, [(1, None, 5), (2, "b", 5)]), "product_id", "product_sk")
    incoming = products(spark, [(1, "a", 5), (2, "b", 5)])
    merged = {r["product_id"]: r["action"] for r in upsert.upsert_products_changed(existing, incoming, LATER).collect()}
    assert merged == {1: "update", 2: "unchanged"}


def test_upsert_twice_is_upsert_once(spark):
    existing = dimensions.assign_surrogate_keys(products(spark, [(1, "a", 5)]), "product_id", "product_sk")
    incoming = products(spark, [(1, "a", 6), (2, "b", 7)]).withColumn("last_updated_date", F.lit(LATER))
    once = upsert.upsert_type1(existing, incoming, "product_id", "product_sk", LATER).drop("action")
    twice = upsert.upsert_type1(once, incoming, "product_id", "product_sk", LATER).drop("action")
    assert sorted(map(str, once.collect())) == sorted(map(str, twice.select(*once.columns).collect()))


def test_new_customers_start_as_new(spark, lines):
    existing = dimensions.assign_surrogate_keys(dimensions.build_dim_customer(lines(item(1, customer_id=1)), NOW), "customer_id", "customer_sk")
    incoming = dimensions.build_dim_customer(lines(*[item(i, customer_id=2, total_amount=9000) for i in range(4)]), NOW)
    merged = {r["customer_id"]: r for r in upsert.upsert_customers_changed(existing, incoming, LATER).collect()}
    assert (merged[2]["customer_segment"], merged[2]["total_orders"], merged[2]["action"]) == ("New", 0, "insert")
    assert merged[1]["action"] == "unchanged"


def test_refresh_with_and_without_facts(spark, lines):
    customers = dimensions.assign_surrogate_keys(
        dimensions.build_dim_customer(lines(item(1, customer_id=1), item(2, customer_id=2)), NOW), "customer_id", "customer_sk"
    )
    some = literal_rows(spark, [(1, 7, Decimal(100))], "customer_sk long, order_id long, net_revenue decimal(18,2)")
    all_ = {r["customer_id"]: r for r in dimensions.refresh_customer_stats(customers, some, LATER).collect()}
    kept = {r["customer_id"]: r for r in dimensions.refresh_customer_stats(customers, some, LATER, True).collect()}
    assert (all_[1]["total_lifetime_value"], all_[2]["total_orders"], all_[2]["customer_segment"]) == (100, 0, "Developing")
    assert (kept[2]["total_orders"], kept[2]["last_updated_date"]) == (1, NOW)


# --- constraints and access ---

def test_constraints_and_quarantine(spark, lines):
    fact = keyed(spark, two_lines(lines, order_date="bad"))
    report = {r["rule"]: r["violations"] for r in constraints.check_constraints(fact, constraints.fact_rules()).collect()}
    assert report == {"date_key_range": 1, "net_revenue_nonnegative": 0, "quantity_positive": 0}
    good, bad = constraints.split_violations(fact, constraints.fact_rules())
    assert (good.count(), bad.count()) == (1, 1)
    with pytest.raises(ValueError, match="date_key_range=1"):
        constraints.require_no_violations(constraints.check_constraints(fact, constraints.fact_rules()))


def test_foreign_and_unique_keys(spark):
    child = literal_rows(spark, [(1, 5), (1, 5), (2, 6)], "a long, b long")
    parent = literal_rows(spark, [(1,)], "a long")
    other = literal_rows(spark, [(5,), (6,)], "k long")
    report = {r["foreign_key"]: r["orphan_rows"] for r in constraints.fk_orphans(child, "t", {"a": (parent, "a"), "b": (other, "k")}).collect()}
    assert report == {"a": 1, "b": 0}
    row = constraints.duplicate_keys(child, "t", ["a", "b"]).first()
    assert (row["repeated_keys"], row["rows_involved"]) == (1, 2)


def test_masking_and_row_filter(spark):
    people = literal_rows(spark, [(1, "ann@x.org")], "customer_id long, email string")
    assert access.masked_customers(people).first()["email"] == "aXXX@XXXX.com"
    assert access.masked_customers(people, privileged=True).first()["email"] == "ann@x.org"
    rights = literal_rows(spark, [("kim", "Giza")], "user_name string, city_name string")
    rows = literal_rows(spark, [(1, 1), (2, 2)], "geography_sk long, v long")
    seen = access.rows_for_user(rows, dimensions.build_dim_geography(spark), rights, "kim").collect()
    assert [r["geography_sk"] for r in seen] == [2]
