"""Registered queries against their SQL twins on the smallest sample."""

import os

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check import connect, differences
from tallyhouse.registry import QUERIES

FOLDER = "/root/testdata/sf0.001"
# Loads that write a warehouse of their own are tested in test_warehouse.
SLOW = {"run_incremental", "rebuild_derived_facts", "truncate_reload_fact", "full_load", "run_full_etl", "load_raw", "raw_bulk_copy", "quarantine", "stream_load"}

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="sample tables are not here")


@pytest.fixture(scope="module")
def db():
    return connect(FOLDER)


def test_every_query_has_its_twin():
    assert set(QUERIES) <= set(oracle_sql()) <= set(queries())


def test_flagship(spark):
    rows = entry(spark).collect()
    assert len(rows) == 27 and rows[0]["year_quarter"] == "1995-Q1"


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in SLOW])
def test_agrees(spark, db, name):
    assert differences(spark, db, FOLDER, name, queries()[name], oracle_sql()[name]) == ""


@pytest.mark.parametrize("name,without", [("refresh_customer_stats_all_facts", "Developing"), ("refresh_customer_stats_inner_all_facts", "New")])
def test_refresh_counts_every_order(spark, db, tmp_path, name, without):
    """Orders of all dates are in the totals; a customer that never ordered has none."""
    for file in os.listdir(FOLDER):
        if file != "customer.parquet":
            os.symlink(f"{FOLDER}/{file}", tmp_path / file)
    one_more = "SELECT * REPLACE (CAST(-7 AS BIGINT) AS c_custkey) FROM customer WHERE c_custkey = 1"
    db.execute(f"COPY (SELECT * FROM customer UNION ALL {one_more}) TO '{tmp_path}/customer.parquet'")
    folder = str(tmp_path)
    got = {r["customer_id"]: r for r in queries()[name](spark, folder).collect()}
    orders = dict(db.sql("SELECT o_custkey, count(DISTINCT o_orderkey) FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1").fetchall())
    everyone = {k for (k,) in db.sql("SELECT c_custkey FROM customer").fetchall()} | {-7}
    assert {k: r["total_orders"] for k, r in got.items()} == {k: orders.get(k, 0) for k in everyone}
    assert got[-7]["customer_segment"] == without
    assert differences(spark, connect(folder), folder, name, queries()[name], oracle_sql()[name]) == ""
