"""How often rows are computed, moved and stored, on small tables of its own."""

import datetime as dt
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyhouse import registry, session
from tallyhouse.operators import constraints, describe, facts
from tallyhouse.operators import frequent as keyed_sums
from tallyhouse.operators.dimensions import newest_rows
from tallyhouse.plans import customers, full_load, measures, products, revenue
from tallyhouse.registry import QUERIES, SETTINGS, clean_lines, sample_warehouse, stored_lines
from tallyhouse.schemas import SOURCE_COLUMNS
from tallyhouse.session import CLUSTER_CONF, materialize
from tallyhouse.sources import files
from tallyhouse.sources.sample_tables import order_lines
from tallyhouse.sources.warehouse import Warehouse


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """The sample's tables with a few rows: 6 orders of 3 customers, 12 lines of 4 parts."""
    folder = str(tmp_path_factory.mktemp("tables"))
    day = dt.datetime(1999, 1, 15)
    rows = {
        "region": ([(0, "ASIA")], "r_regionkey int, r_name string"),
        "nation": ([(n, f"NATION_{n}", 0) for n in range(2)], "n_nationkey int, n_name string, n_regionkey int"),
        "customer": ([(c, f"Customer#{c:09d}", c % 2) for c in range(3)], "c_custkey long, c_name string, c_nationkey int"),
        "part": ([(p, f"part {p}", "ECONOMY") for p in range(4)], "p_partkey long, p_name string, p_type string"),
        "orders": (
            [(o, o % 3, day + dt.timedelta(days=20 * o), "2-HIGH") for o in range(6)],
            "o_orderkey long, o_custkey long, o_orderdate timestamp, o_orderpriority string",
        ),
        "lineitem": (
            [(i // 2, i % 4, 1, i % 2 + 1, float(i % 5 + 1), 100.0 * (i + 1), 0.05) for i in range(12)],
            "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double",
        ),
    }
    for name, (values, schema) in rows.items():
        spark.createDataFrame(values, schema).coalesce(1).write.parquet(f"{folder}/{name}.parquet")
    return folder


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_customers_meet_orders_not_lines(spark, tables):
    lines = order_lines(spark, tables)
    assert lines.count() == 12
    at = [line for line in plan(lines).splitlines() if "Join" in line]
    # The join on the customer is above no scan of lines: it comes after the last join of the lines in the text.
    text = plan(lines)
    assert text.index("c_custkey") > text.index("l_extendedprice")
    below = text[next(text.index(j) for j in at if "c_custkey" in j) :]
    assert "l_extendedprice" not in below


def test_price_median_computes_typed_rows_once(spark, tables):
    found = QUERIES["clean_price_median"](spark, tables)
    assert "l_extendedprice" not in plan(found)
    assert {r["order_item_id"] for r in found.collect()} <= {r["order_item_id"] for r in order_lines(spark, tables).collect()}


def shuffle_files(spark):
    """Shuffle files in the session's scratch folders."""
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return sum(blocks.apply(i).getName().startswith("shuffle_") for i in range(blocks.size()))


def test_stored_tables_leave_no_shuffles(spark, tables):
    """Loads keep the shuffles of one step, not of all steps until the driver collects garbage."""
    before = shuffle_files(spark)
    materialize(order_lines(spark, tables).groupBy("customer_id").count())
    assert shuffle_files(spark) <= before
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def exchanges(df):
    """Shuffles by a key in the plan before it runs."""
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_facts_move_lines_once(spark, tables):
    keys = "order_date_key int, customer_sk long, product_sk long, geography_sk long, order_id long, quantity int"
    money = ", ".join(f"{c} decimal(18,2)" for c in ("gross_revenue", "net_revenue", "discount_amount", "unit_price"))
    rows = [
        (19990103, 1, 5, 0, 10, 2, *map(Decimal, ("8", "7", "1", "4"))),
        (19990104, 1, 5, 0, 10, 1, *map(Decimal, ("4", "4", "0", "4"))),
        (19990105, 2, 5, 0, 11, 1, *map(Decimal, ("5", "5", "0", "5"))),
        (19990105, None, 5, 0, None, 1, Decimal(5), Decimal(5), Decimal(0), None),
        (19990205, 2, 5, 0, 10, 1, *map(Decimal, ("5", "5", "0", "5"))),
        (19990205, 2, 6, 0, 10, 1, *map(Decimal, ("5", "5", "0", "5"))),
    ]
    items = spark.createDataFrame(rows, f"{keys}, {money}")
    monthly = facts.monthly_product_base(items)
    found = {(r.year_month_key, r.product_sk): (r.total_units_sold, r.total_orders, r.total_customers, r.avg_unit_price) for r in monthly.collect()}
    assert found == {
        ("1999-01", 5): (5, 2, 2, Decimal("4.33")),
        ("1999-02", 5): (1, 1, 1, Decimal("5.00")),
        ("1999-02", 6): (1, 1, 1, Decimal("5.00")),
    }
    orders = facts.build_fact_order_summary(items)
    assert sorted((r.order_id or 0, r.order_date_key, r.total_items, r.distinct_products) for r in orders.collect()) == [
        (0, 19990105, 1, 1), (10, 19990103, 1, 1), (10, 19990104, 1, 1), (10, 19990205, 2, 2), (11, 19990105, 1, 1)
    ]
    assert "Expand" not in plan(monthly)
    assert exchanges(facts.monthly_product_base(items)) == 1 and exchanges(facts.build_fact_order_summary(items)) == 1


def test_newest_lines_are_found_without_a_join(spark, tables):
    lines = order_lines(spark, tables)
    newest = newest_rows(lines, "product_id", ("product_name", "price"))
    assert "Join" not in plan(newest_rows(materialize(lines), "product_id", ("product_name", "price")))
    wanted = {}
    for r in sorted(lines.collect(), key=lambda r: (r.order_date, r.order_item_id)):
        wanted[r.product_id] = (r.product_name, r.price)
    assert {r.product_id: (r.product_name, r.price) for r in newest.collect()} == wanted


def test_landing_copy_may_be_compressed(spark, tables, tmp_path):
    """A copy of compressed files holds the same rows, line breaks and quotes included, and less than half the bytes."""
    rows = order_lines(spark, tables).select(*[F.col(c).cast("string").alias(c) for c in SOURCE_COLUMNS])
    rows = rows.withColumn("name", F.lit('two\nlines, "quoted"'))
    files.write_csv(rows, f"{tmp_path}/in", compression="gzip")
    files.landing_copy(spark, f"{tmp_path}/in", f"{tmp_path}/out", compression="gzip")
    assert sorted(files.extract_fixed(spark, f"{tmp_path}/out").collect()) == sorted(rows.collect())
    files.landing_copy(spark, f"{tmp_path}/in", f"{tmp_path}/plain")
    assert files.extract_fixed(spark, f"{tmp_path}/plain").count() == rows.count()
    assert list((tmp_path / "out").glob("*.csv.gz")) and not list((tmp_path / "plain").glob("*.csv.gz"))


def test_loads_move_what_cannot_be_computed(spark, tables):
    """Stored lines and the lines moved to their months hold no derived measures; the fact has them all the same."""
    wh = sample_warehouse(spark, tables)
    lines = stored_lines(wh, tables)
    assert spark.read.parquet(f"{wh.root}/processed/run_ts=sample").columns == order_lines(spark, tables).columns
    text = plan(full_load.build_items(wh, lines, SETTINGS, rebalanced=True))
    below = text[text.index("RebalancePartitions") :]
    assert "net_revenue" in below and "discount_pct" not in below and "gross_revenue" not in below
    asked = facts.build_fact_order_items(clean_lines(spark, tables), wh.read("dim_customer"), wh.read("dim_product"), wh.read("dim_geography"))
    items = wh.read("fact_order_items").select(*asked.columns)
    assert items.count() == 12 and sorted(map(str, items.collect())) == sorted(map(str, asked.collect()))


def test_months_are_moved_with_the_earlier_numbers(spark, tables):
    items = full_load.open_star(sample_warehouse(spark, tables)).items
    monthly = facts.build_fact_monthly_product(items, ("year_month_key",))
    text = plan(monthly)
    assert "mom_change_pct" not in text[text.index("RebalancePartitions") :]
    assert sorted(map(str, monthly.collect())) == sorted(map(str, facts.build_fact_monthly_product(items).collect()))


def test_orders_by_date_are_moved_once(spark, tables):
    items = full_load.open_star(sample_warehouse(spark, tables)).items
    orders = facts.build_fact_order_summary(items, by_date=True)
    text = orders._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange rangepartitioning") == 1 and text.count("Exchange ") == 1
    assert sorted(map(str, orders.collect())) == sorted(map(str, facts.build_fact_order_summary(items).collect()))


def test_category_orders_are_moved_without_sums(spark, tables):
    shares = revenue.category_share(full_load.open_star(sample_warehouse(spark, tables)))
    by_order = [x for x in shares._jdf.queryExecution().executedPlan().toString().splitlines() if "Aggregate(keys=[" in x and "order_id" in x.split("functions=")[0]]
    assert by_order and not any("sum(" in x or "avg(" in x for x in by_order)
    assert sum(r["total_orders"] for r in shares.collect()) == 6


def test_dry_run_computes_typed_rows_once(spark, source, tmp_path):
    """The median and the result read typed rows that were stored aside; the warehouse stays empty."""
    wh = Warehouse(spark, f"{tmp_path}/wh")
    rows = full_load.run_pipeline(wh, source({}, {"order_item_id": "2", "price": ""}), dry_run=True)
    assert "LogicalRDD" not in plan(rows)
    assert sorted(r["price"] for r in rows.collect()) == [Decimal("600.00")] * 2
    assert not (tmp_path / "wh").exists()


def test_described_columns_are_counted_one_by_one(spark, source):
    """No row is multiplied by its columns, and every value is counted once per column."""
    rows = source({}, {"order_item_id": "2", "city": "NULL"}).withColumn("number", F.lit(7)).withColumn("none", F.lit(None).cast("int"))
    values = describe.value_table(rows)
    assert "Generate" not in plan(values) and plan(values).count("Aggregate") == len(rows.columns) - 1  # the empty one is folded
    found = {(r["column_name"], r["number"], r["text"]): r["n"] for r in values.collect()}
    assert found["number", 7.0, None] == 2 and found["city", None, "Cairo"] == 1 and found["order_id", None, "5001"] == 2
    assert len(found) == len(rows.columns) - 1 + 2  # two ids and two cities, nothing of the empty column


def test_dry_run_stores_no_derived_rows(spark, tables, monkeypatch):
    """The described rows are read by column from the stored typed rows."""
    stored = []
    monkeypatch.setattr(registry, "materialize", lambda df: stored.append(df) or materialize(df))
    assert QUERIES["dry_run_describe"](spark, tables).count() == len(SOURCE_COLUMNS) + 13
    assert not stored


def test_frequent_products_are_moved_by_month_others_by_product(spark, tables):
    """The monthly fact moves lines once and, but for frequent products, its own rows only to their months."""
    items = full_load.open_star(sample_warehouse(spark, tables)).items
    wanted = sorted(map(str, facts.build_fact_monthly_product(items).collect()))
    assert exchanges(facts.build_fact_monthly_product(items)) == 2
    assert exchanges(facts.build_fact_monthly_product(items, (), [])) == 1
    for frequent in ([], [1, 3], [1, 2, 3, 4]):
        assert sorted(map(str, facts.build_fact_monthly_product(items, (), frequent).collect())) == wanted
        assert sorted(map(str, facts.build_fact_monthly_product(items, ("year_month_key",), frequent).collect())) == wanted


def test_order_lines_move_with_what_they_share_in_front(spark, tables):
    wh = sample_warehouse(spark, tables)
    moved = plan(full_load.build_items(wh, stored_lines(wh, tables), SETTINGS, rebalanced=True))
    below = moved[moved.index("RebalancePartitions") :].splitlines()[1]
    assert below.index("customer_sk") < below.index("order_id#") < below.index("order_item_id") < below.index("product_sk")
    # The join on customers is the last one.
    assert moved.index("customer_sk#") < moved.index("Join Inner, (customer_id") < moved.index("Join Inner, (product_id")


@pytest.mark.parametrize("frequent", [[], [1], [1, 2, None]])
def test_totals_by_key_move_plain_rows_once(spark, monkeypatch, frequent):
    rows = spark.createDataFrame(
        [(1, 10, 2, Decimal("1.10"))] * 2
        + [(1, 11, None, None), (1, None, 5, Decimal("2.00")), (2, 10, 1, None), (None, 12, 3, Decimal("4.00")), (None, 13, 3, None)],
        "k long, o long, q int, m decimal(18,2)",
    )
    totals = {"q": (F.sum, "q"), "m": (F.sum, "m"), "priced": (F.count, "m"), "n": (F.count, None), "low": (F.min, "q"), "high": (F.max, "q")}
    asked = rows.groupBy("k").agg(F.count_distinct("o").alias("orders"), *[how(c or F.lit(1)).alias(name) for name, (how, c) in totals.items()])
    assert set(keyed_sums.frequent_values(rows, "k")) == {1, 2}
    monkeypatch.setattr(keyed_sums, "frequent_values", lambda *_: frequent)
    found = keyed_sums.totals_by_key(rows, "k", totals, "o", "orders")
    # The rows as they are, then sums per key.
    text = found._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning") == (2 if frequent else 1)
    assert "HashAggregate" not in text[text.rindex("Exchange hashpartitioning") :]
    assert found.dtypes == asked.dtypes
    assert sorted(map(str, found.collect())) == sorted(map(str, asked.collect()))


def test_frequent_values_are_found(spark):
    rows = spark.range(20000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k")).repartition(7)
    found = keyed_sums.frequent_values(rows, "k")
    assert -1 in found and len(found) <= 1000


def test_product_and_customer_totals_send_no_sums_twice(spark, tables):
    star = full_load.open_star(sample_warehouse(spark, tables))
    for found in (measures.product_matrix(star), products.product_totals(star), customers.customer_activity(star)):
        text = found._jdf.queryExecution().executedPlan().toString()
        assert "HashAggregate" not in text[text.rindex("Exchange hashpartitioning") :]


def test_cluster_sessions_compress_shuffles_as_tables():
    assert CLUSTER_CONF["spark.io.compression.codec"] == CLUSTER_CONF["spark.sql.parquet.compression.codec"] == "zstd"


def physical(df):
    return df._jdf.queryExecution().sparkPlan().toString()


def test_large_stored_tables_are_not_broadcast(spark, tables, monkeypatch):
    """Files of a byte per key pass Spark's limit with millions of rows, which the driver would hold; rows decide then."""
    wh = sample_warehouse(spark, tables)
    lines = stored_lines(wh, tables)
    small = full_load.build_items(wh, lines, SETTINGS)
    assert "customer_sk" in physical(small) and "SortMergeJoin" not in physical(small)
    monkeypatch.setattr(session, "BROADCAST_ROWS", 1)
    large = full_load.build_items(wh, lines, SETTINGS)
    joins = [line for line in physical(large).splitlines() if "BroadcastHashJoin" in line]
    assert physical(large).count("SortMergeJoin") == 2 and all("city" in line for line in joins)
    assert sorted(large.collect()) == sorted(small.collect())
    star = full_load.open_star(wh)
    for dimension, key in ((star.customers, "customer_sk"), (star.products, "product_sk")):
        assert "Broadcast" not in physical(star.items.join(dimension.select(key), key))


def test_parents_of_foreign_keys_are_not_broadcast(spark, tables):
    star = full_load.open_star(sample_warehouse(spark, tables))
    report = constraints.fk_integrity(star)
    assert "Broadcast" not in physical(report)
    assert {r["orphan_rows"] for r in report.collect()} == {0}


def test_intermediate_tables_go_with_their_step(spark, tmp_path):
    """A step's tables are removed when it ends or fails; what it keeps goes with the step around it."""
    there = lambda df: [f for f in df.inputFiles() if os.path.exists(f.removeprefix("file://"))]
    free = materialize(spark.range(3))
    with session.stored_aside(spark):
        with session.stored_aside(spark) as keep:
            inner = materialize(spark.range(3))
            kept = keep(inner.filter("id > 0"))
            assert there(inner)
        assert not there(inner) and kept.count() == 2
        with pytest.raises(ValueError), session.stored_aside(spark):
            failed = materialize(spark.range(2))
            raise ValueError
        assert not there(failed) and there(kept)
    assert not there(kept) and there(free)


def test_deliveries_leave_no_intermediate_tables(spark, tables, monkeypatch):
    """A streamed load leaves its warehouse, and the rows that the query made its landing files of, which are compressed."""
    stored = []
    monkeypatch.setattr(session, "write_parquet", lambda df, path, *a, f=session.write_parquet: stored.append(path) or f(df, path, *a))
    landing = []
    monkeypatch.setattr(registry, "load_available", lambda wh, path, *a, f=registry.load_available: landing.append(path) or f(wh, path, *a))
    assert QUERIES["stream_load"](spark, tables).count() > 0
    assert [path for path in stored if os.path.exists(path)] == stored[:1] and len(stored) > 10
    assert {f.split(".", 1)[1] for f in os.listdir(landing[0]) if f.startswith("part")} == {"csv.gz"}
