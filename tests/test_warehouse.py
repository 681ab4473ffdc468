"""Full, incremental and streaming loads in a scratch warehouse."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from tallyhouse.operators import facts
from tallyhouse.plans import full_load, incremental
from tallyhouse.plans.full_load import PIPELINE, Settings
from tallyhouse.plans.views import register_views
from tallyhouse.sources import files
from tallyhouse.sources.warehouse import Warehouse
from tallyhouse.streaming.landing import load_available


def row(i, day, **extra):
    return {
        "order_item_id": str(i), "order_id": str(i // 2), "customer_id": str(i % 5), "product_id": str(i % 3),
        "order_date": day, "total_amount": str(100 + i), **extra,
    }


EARLY = [row(i, f"2022-0{1 + i % 3}-1{i % 9}") for i in range(24)]
LATE = [row(100 + i, f"2022-0{4 + i % 2}-0{1 + i % 9}") for i in range(12)]


@pytest.fixture
def wh(spark, tmp_path):
    return Warehouse(spark, str(tmp_path / "wh"))


def content(wh, table, drop=()):
    df = wh.read(table).drop("etl_load_id", "last_updated_date", "created_date", *drop)
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def test_full_load(wh, source):
    steps = []
    full_load.run_pipeline(wh, source(*EARLY), "in.csv", on_step=steps.append)
    assert steps == ["processed", "raw", "staging", "dimensions", "facts", "refresh"]
    items, orders, monthly = (wh.read(t) for t in ("fact_order_items", "fact_order_summary", "fact_monthly_product_performance"))
    assert items.count() == 24 and {"order_year", "order_month"} <= set(items.columns)
    total = items.agg(F.sum("net_revenue")).first()[0]
    assert orders.agg(F.sum("order_net_revenue")).first()[0] == total == monthly.agg(F.sum("total_net_revenue")).first()[0]
    assert wh.read("dim_customer").agg(F.sum("total_lifetime_value")).first()[0] == total
    assert wh.high_water_mark(PIPELINE) == date(2022, 3, 18)
    raw = wh.spark.read.parquet(wh.path("raw", "ecommerce_orders"))
    assert raw.count() == 24 and dict(raw.dtypes)["quantity"] == "string"
    staging = wh.spark.read.parquet(wh.path("staging", "order_items"))
    assert staging.count() == 24 and "calculated_revenue" in staging.columns
    register_views(full_load.open_star(wh))
    assert wh.spark.sql("SELECT sum(net_revenue) FROM vw_monthly_revenue").first()[0] == total


FAULTY = [
    row(900, "soon"), dict(row(901, "2022-01-05"), customer_id="", order_id="x"), dict(row(902, "2022-01-05"), product_id="abc"), EARLY[0], EARLY[1],
]


def reasons(wh):
    return sorted((r["order_item_id"], r["stage"], ", ".join(r["reasons"])) for r in wh.read("quarantine").collect())


def test_quarantine_balances(spark, wh, source, tmp_path):
    """Rows in are facts, quarantined rows and exact duplicates, in full, staging and delivery loads."""
    want = [("900", "fact", "date_key_range"), ("901", "clean", "missing customer_id, unreadable order_id"), ("902", "clean", "unreadable product_id")]
    full_load.run_pipeline(wh, source(*EARLY, *FAULTY), skip_raw=True)
    assert reasons(wh) == want
    assert wh.read("fact_order_items").count() + len(want) + 2 == len(EARLY) + len(FAULTY)
    assert [r["rows_rejected"] for r in wh.runs().collect()] == [3]
    staged = Warehouse(spark, str(tmp_path / "staged"))
    full_load.seed_dimensions(staged, Settings())
    files.load_staging(spark.read.parquet(f"{wh.root}/processed"), staged.path("staging", "order_items"))
    full_load.run_from_staging(staged)
    assert reasons(staged) == want[:1] and staged.read("fact_order_items").count() == 24
    stream = Warehouse(spark, str(tmp_path / "stream"))
    deliver(stream, source, [*EARLY, *FAULTY], [dict(row(910, "2022-02-01"), price=""), dict(row(911, "2022-02-01"), price="-1")])
    assert reasons(stream) == [*want, ("910", "fact", "no price"), ("911", "fact", "no price")]
    assert stream.read("fact_order_items").count() == 24 and [r["rows_rejected"] for r in stream.runs().orderBy("run_seq").collect()] == [3, 2]


def test_unmapped_lines_are_quarantined(spark, wh, source):
    full_load.run_pipeline(wh, source(*EARLY), skip_raw=True)
    lines = spark.read.parquet(f"{wh.root}/processed").drop("run_ts")
    strange = lines.withColumn("customer_id", F.when(F.col("order_item_id") < 3, 99).otherwise(F.col("customer_id")).cast("long"))
    assert full_load.quarantine_rows(wh, strange, Settings(), "b", loaded=21) == 3
    assert reasons(wh) == [(str(i), "fact", "unmapped customer_id") for i in range(3)]


def test_dry_run_writes_nothing(wh, source):
    rows = full_load.run_pipeline(wh, source(*EARLY), dry_run=True)
    assert rows.count() == 24 and not wh.exists("fact_order_items") and wh.runs().count() == 0
    assert [r["summary"] for r in full_load.describe_clean(rows).collect()] == ["count", "mean", "stddev", "min", "max"]


def test_skip_raw(wh, source):
    full_load.run_pipeline(wh, source(*EARLY), skip_raw=True)
    with pytest.raises(Exception):
        wh.spark.read.parquet(wh.path("raw", "ecommerce_orders"))


def test_reload_replaces(wh, source):
    full_load.run_pipeline(wh, source(*EARLY))
    before = content(wh, "fact_order_items")
    full_load.run_pipeline(wh, source(*EARLY))
    assert content(wh, "fact_order_items") == before and wh.current_version("fact_order_items") == 2


def test_failure_is_logged_and_hides_nothing(wh, source):
    full_load.run_pipeline(wh, source(*EARLY))

    def fail(step):
        if step == "facts":
            raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        full_load.run_pipeline(wh, source(*EARLY), on_step=fail)
    assert [r["last_run_status"] for r in wh.runs().orderBy("run_seq").collect()] == ["SUCCESS", "FAILED"]
    assert wh.high_water_mark(PIPELINE) == date(2022, 3, 18)
    assert wh.read("fact_order_items").count() == 24


def test_incremental_equals_one_full_load(spark, source, tmp_path):
    step, once = Warehouse(spark, str(tmp_path / "a")), Warehouse(spark, str(tmp_path / "b"))
    assert incremental.run_incremental(step, source(*EARLY)) == 24
    assert incremental.run_incremental(step, source(*EARLY, *LATE)) == 12
    incremental.run_incremental(once, source(*EARLY, *LATE))
    for table in ("fact_order_items", "fact_order_summary", "fact_monthly_product_performance", "dim_customer", "dim_product"):
        assert content(step, table) == content(once, table), table
    assert step.high_water_mark(PIPELINE) == date(2022, 5, 8)
    # Nothing new: an empty delta changes nothing.
    before = content(step, "fact_order_items")
    assert incremental.run_incremental(step, source(*EARLY, *LATE)) == 0
    assert content(step, "fact_order_items") == before
    # The same window again, from inside a month, repeats nothing.
    assert incremental.run_incremental(step, source(*EARLY, *LATE), from_date=date(2022, 2, 14)) > 12
    for table in ("fact_order_items", "fact_order_summary", "fact_monthly_product_performance"):
        assert content(step, table) == content(once, table), table


def test_late_rows_and_lookback(wh, source):
    incremental.run_incremental(wh, source(*EARLY))
    late = row(500, "2022-03-17")
    assert incremental.run_incremental(wh, source(*EARLY, late)) == 0
    loaded = incremental.run_incremental(wh, source(*EARLY, late), settings=Settings(lookback_days=3))
    assert loaded >= 1 and wh.read("fact_order_items").filter("order_item_id = 500").count() == 1


def test_window_that_lost_a_month(wh, source):
    incremental.run_incremental(wh, source(*EARLY, *LATE))
    incremental.run_incremental(wh, source(*EARLY), from_date=date(2022, 3, 31))
    assert wh.read("fact_order_items").count() == 24
    assert wh.read("fact_monthly_product_performance").agg(F.max("year_month_key")).first()[0] == "2022-03"
    expected = facts.build_fact_order_summary(wh.read("fact_order_items")).count()
    assert wh.read("fact_order_summary").count() == expected


def test_open_frames_and_broken_loads(wh, source, monkeypatch):
    """A frame opened before a load still reads its rows; a load that dies half-way publishes nothing."""
    incremental.run_incremental(wh, source(*EARLY))
    tables = ("fact_order_items", "fact_order_summary", "fact_monthly_product_performance")
    opened, before = {t: wh.read(t) for t in tables}, {t: wh.read(t).count() for t in tables}
    with monkeypatch.context() as patch:
        patch.setattr(incremental, "refresh_customers", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            incremental.run_incremental(wh, source(*EARLY, *LATE))
    again = Warehouse(wh.spark, wh.root)
    assert {t: again.read(t).count() for t in tables} == before
    incremental.run_incremental(again, source(*EARLY, *LATE, row(700, "2022-03-18")), from_date=date(2022, 3, 1))
    assert {t: df.count() for t, df in opened.items()} == before
    assert again.read("fact_order_items").count() == 37
    months = {f.split("order_year=")[-1] for f in again._published()["fact_order_items"].folders if "order_year=" in f}
    assert months == {"2022/order_month=1", "2022/order_month=2"}  # untouched ones stayed where they were


def test_full_reload_resets(wh, source):
    incremental.run_incremental(wh, source(*EARLY, *LATE))
    assert incremental.run_incremental(wh, source(*EARLY), full_reload=True) == 24


def test_load_from_staging_agrees(spark, source, tmp_path):
    a, b = Warehouse(spark, str(tmp_path / "a")), Warehouse(spark, str(tmp_path / "b"))
    full_load.run_pipeline(a, source(*EARLY))
    full_load.seed_dimensions(b, Settings())
    files.load_staging(spark.read.parquet(f"{a.root}/processed"), b.path("staging", "order_items"))
    full_load.run_from_staging(b)
    full_load.run_from_staging(b)
    for table in ("fact_order_items", "fact_order_summary", "fact_monthly_product_performance"):
        assert content(a, table) == content(b, table), table
    assert b.read("dim_customer").count() == 5


def test_sentinel_dates_stay_out_of_facts(wh, source):
    full_load.run_pipeline(wh, source(*EARLY, row(900, "soon")))
    assert wh.read("fact_order_items").count() == 24
    assert wh.spark.read.parquet(wh.path("staging", "order_items")).count() == 25


def test_streaming_files(spark, source, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    landing = str(tmp_path / "landing")
    source(*EARLY).coalesce(1).write.options(**files.CSV_OPTIONS).mode("append").csv(landing)
    load_available(wh, landing, str(tmp_path / "cp"))
    assert wh.read("fact_order_items").count() == 24
    source(*LATE).coalesce(1).write.options(**files.CSV_OPTIONS).mode("append").csv(landing)
    load_available(wh, landing, str(tmp_path / "cp"))
    load_available(wh, landing, str(tmp_path / "cp"))
    assert wh.read("fact_order_items").count() == 36
    assert spark.read.parquet(wh.path("raw", "ecommerce_orders")).count() == 36
    once = Warehouse(spark, str(tmp_path / "once"))
    incremental.run_incremental(once, source(*EARLY, *LATE))
    for table in ("fact_order_items", "fact_order_summary", "fact_monthly_product_performance", "dim_customer", "dim_product"):
        assert content(wh, table) == content(once, table), table


@pytest.mark.parametrize("per_batch", [None, 1])
def test_streaming_takes_same_and_older_days(spark, source, tmp_path, per_batch):
    """Overlapping days, older attributes, a repeated file and lookback_days: as one load of all lines."""
    wh, landing = Warehouse(spark, str(tmp_path / "wh")), str(tmp_path / "landing")
    first = [dict(row(1, "2022-06-15"), city="Giza"), row(2, "2022-03-02")]
    second = [dict(row(3, "2022-06-15"), city="Giza"), dict(row(4, "2022-06-14"), city="Cairo"), row(5, "2021-12-31")]
    for files_of in ([first, second[:1]], [second[1:], first]):
        for rows in files_of:
            source(*rows).coalesce(1).write.options(**files.CSV_OPTIONS).mode("append").csv(landing)
        load_available(wh, landing, str(tmp_path / "cp"), settings=Settings(lookback_days=3), files_per_batch=per_batch)
    once = Warehouse(spark, str(tmp_path / "once"))
    incremental.run_incremental(once, source(*first, *second))
    for table in ("fact_order_items", "fact_order_summary", "fact_monthly_product_performance", "dim_customer", "dim_product"):
        keys = [c for c in ("customer_sk", "product_sk") if c in once.read(table).columns]  # numbered by arrival
        assert content(wh, table, keys) == content(once, table, keys), table


TABLES = ("fact_order_items", "fact_order_summary", "fact_monthly_product_performance", "dim_customer", "dim_product")


def deliver(wh, source, *deliveries):
    return [incremental.run_incremental(wh, source(*rows), whole_source=False) for rows in deliveries]


def test_redelivered_line_without_a_price_stays_one_row(wh, source):
    bare = dict(row(1, "2022-03-02"), price="")
    deliver(wh, source, [bare, dict(row(2, "2022-03-03"), price="100.00")], [bare, dict(row(3, "2022-03-04"), price="300.00")])
    got = wh.read("fact_order_items").select("order_item_id", "unit_price").collect()
    assert sorted((r[0], float(r[1])) for r in got) == [(1, 300.0), (2, 100.0), (3, 300.0)]


def test_corrected_amounts_and_moved_months(spark, wh, source, tmp_path):
    """The last delivery of a line counts, in the month it is in now; all tables as if only it had come."""
    first = [row(i, f"2022-0{1 + i % 6}-1{i % 9}") for i in range(24)]
    fixed = [dict(first[4], total_amount="7"), dict(first[7], order_date="2022-09-01"), dict(first[9], order_date="2021-12-24", quantity="9"), dict(first[11], customer_id="77")]
    assert deliver(wh, source, first, fixed, fixed, first[:3]) == [24, 4, 0, 0]
    lines = {r["order_item_id"]: r for r in [*first, *fixed]}
    once = Warehouse(spark, str(tmp_path / "once"))
    incremental.run_incremental(once, source(*lines.values()))
    for table in TABLES:
        keys = [c for c in ("customer_sk", "product_sk") if c in once.read(table).columns]
        assert content(wh, table, keys) == content(once, table, keys), table
    index = wh.read(incremental.INDEX)
    facts_ = wh.read("fact_order_items").select("order_item_id", "order_year", "order_month")
    assert sorted(index.select(*facts_.columns).collect()) == sorted(facts_.collect())
    assert wh.current_version(incremental.INDEX) == wh.current_version("fact_order_items")


def test_delivery_rewrites_only_its_months(wh, source):
    """One old line of one product: its month, and the month its product is sold in next."""
    deliver(wh, source, [row(i, f"2022-0{1 + i % 6}-1{i % 9}") for i in range(24)])
    before = {t: set(wh._published()[t].folders) for t in TABLES[:3]}
    monthly = sorted(map(str, wh.read("fact_monthly_product_performance").filter("year_month_key > '2022-03'").collect()))
    deliver(wh, source, [dict(row(500, "2022-02-20"), product_id="1", customer_id="1")])
    assert sorted(map(str, wh.read("fact_monthly_product_performance").filter("year_month_key > '2022-05'").collect())) == [r for r in monthly if "2022-06" in r]
    kept = {t: {f.split("/", 1)[1] for f in wh._published()[t].folders if "/" in f} for t in TABLES[:3]}
    assert all("order_year=2022/order_month=2" not in kept[t] and len(kept[t]) == 5 for t in TABLES[:2])
    assert "year_month_key=2022-06" in kept[TABLES[2]] and "year_month_key=2022-02" not in kept[TABLES[2]]
    assert before and wh.read("fact_order_items").count() == 25


def test_delivery_after_a_whole_load(spark, wh, source, tmp_path):
    """The index and the newest lines are built anew where a whole load changed the facts behind them."""
    incremental.run_incremental(wh, source(*EARLY, *LATE))
    old = dict(row(900, "2022-01-01"), customer_id="1", name="Older Name")
    deliver(wh, source, [dict(LATE[2], order_date="2022-01-30"), old])
    once = Warehouse(spark, str(tmp_path / "once"))
    moved = dict(LATE[2], order_date="2022-01-30")
    incremental.run_incremental(once, source(*EARLY, *LATE[:2], moved, *LATE[3:], old))
    for table in TABLES[:3]:
        keys = [c for c in ("customer_sk", "product_sk") if c in once.read(table).columns]
        assert content(wh, table, keys) == content(once, table, keys), table
    assert wh.read("dim_customer").filter("customer_name = 'Older Name'").count() == 0


@pytest.mark.parametrize("per_batch", [None, 1])
def test_newer_file_of_a_stream_wins(spark, source, tmp_path, per_batch):
    wh, landing = Warehouse(spark, str(tmp_path / "wh")), str(tmp_path / "landing")
    for rows in ([row(1, "2022-06-15"), row(2, "2022-06-16")], [dict(row(1, "2022-05-15"), total_amount="40")], [dict(row(1, "2022-04-15"), total_amount="30")]):
        source(*rows).coalesce(1).write.options(**files.CSV_OPTIONS).mode("append").csv(landing)
    load_available(wh, landing, str(tmp_path / "cp"), files_per_batch=per_batch)
    got = wh.read("fact_order_items").select("order_item_id", "order_date_key", F.col("net_revenue").cast("int")).collect()
    assert sorted(map(tuple, got)) == [(1, 20220415, 30), (2, 20220616, 102)]
    assert wh.read("fact_order_summary").count() == 2
    raw = spark.read.parquet(wh.path("raw", "ecommerce_orders"))
    assert raw.select("etl_source_file").distinct().count() == 3 and raw.filter("etl_load_date IS NULL").count() == 0


def test_from_date_filters_a_first_load(wh, source):
    assert incremental.run_incremental(wh, source(row(1, "2022-01-05"), row(2, "2022-02-05")), from_date=date(2022, 1, 31)) == 1


def test_csv_keeps_columns_breaks_and_names(spark, tmp_path):
    path = tmp_path / "in"
    path.mkdir()
    (path / "a.csv").write_text('a,b,c\n1,"two\nlines",3\n')
    assert [tuple(r) for r in files.extract_csv(spark, str(path)).collect()] == [("1", "two\nlines", "3")]
    (path / "b.csv").write_text("b,a,c\n1,2,3\n")
    with pytest.raises(Exception, match="(?i)header"):
        files.extract_csv(spark, str(path)).collect()


def test_facts_prune_partitions(wh, source):
    full_load.run_pipeline(wh, source(*EARLY))
    plan = incremental.months_from(wh.read("fact_order_items"), date(2022, 3, 1))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "order_year" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_csv_round_trip(spark, source, tmp_path):
    path = str(tmp_path / "in")
    files.write_csv(source({"name": 'A "B", C', "city": "NULL", "email": ""}), path)
    read = files.extract_csv(spark, path).first()
    assert read["name"] == 'A "B", C' and read["city"] is None and read["email"] is None
    files.landing_copy(spark, path, str(tmp_path / "out"))
    text = "".join(r["value"] for r in spark.read.text(str(tmp_path / "out")).collect())
    assert '"1001","5001"' in text
    assert files.extract_fixed(spark, str(tmp_path / "out")).first()["name"] == 'A "B", C'
