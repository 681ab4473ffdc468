"""Distributed ranks against plain windows."""

import random
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyhouse.operators.ordering import ntile_column, rank_globally, weighted_median
from tallyhouse.session import materialize


def frame(spark, values):
    rows = [(i, v) for i, v in enumerate(values)]
    random.Random(3).shuffle(rows)
    return spark.createDataFrame(rows, "id long, v decimal(18,2)")


CASES = {
    "unique": [Decimal(i) / 7 for i in range(500)],
    "many ties": [Decimal(i % 5) for i in range(700)],
    "one value": [Decimal(4)] * 300,
    "hot value": [Decimal(1)] * 400 + [Decimal(i) for i in range(300)],
    "fewer rows than tiles": [Decimal(3), Decimal(1), Decimal(1)],
    "single row": [Decimal(9)],
}


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("name", list(CASES))
def test_matches_plain_windows(spark, name, descending):
    df = frame(spark, CASES[name])
    by_value = F.col("v").desc() if descending else F.col("v").asc()
    total = Window.orderBy(by_value, "id")
    ties = Window.orderBy(by_value)
    plain = df.select(
        "id",
        F.row_number().over(total).cast("long").alias("rn"),
        F.rank().over(ties).cast("long").alias("rk"),
        F.percent_rank().over(ties).alias("pr"),
        F.ntile(5).over(total).alias("t5"),
        F.ntile(4).over(total).alias("t4"),
        F.sum("v").over(total.rowsBetween(Window.unboundedPreceding, 0)).cast("decimal(30,2)").alias("run"),
        F.lit(len(CASES[name])).cast("long").alias("n"),
    )
    ours = rank_globally(
        df, "v", "id", descending, row_number="rn", rank="rk", percent_rank="pr",
        ntiles={"t5": 5, "t4": 4}, running={"run": "v"}, total_rows="n",
    ).select("id", "rn", "rk", "pr", "t5", "t4", F.col("run").cast("decimal(30,2)"), "n")
    assert sorted(map(tuple, ours.collect())) == sorted(map(tuple, plain.collect()))


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("name", list(CASES))
def test_ntile_expression(spark, name, descending):
    df = materialize(frame(spark, CASES[name]))
    by_value = F.col("v").desc() if descending else F.col("v").asc()
    plain = df.select("id", F.ntile(5).over(Window.orderBy(by_value, "id")))
    ours = df.select("id", ntile_column(df, "v", "id", 5, descending))
    assert sorted(map(tuple, ours.collect())) == sorted(map(tuple, plain.collect()))


def test_rows_spread_over_buckets(spark):
    from tallyhouse.operators.ordering import place

    placed = place(frame(spark, CASES["one value"]), "v", "id")
    sizes = [r["count"] for r in placed.groupBy("_bucket").count().collect()]
    assert sum(sizes) == 300 and (len(sizes) == 1 or max(sizes) < 300)


def test_hot_value_is_split_without_coalescing(spark):
    from tallyhouse.operators.ordering import place

    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(4000).select(F.col("id"), F.lit(1).cast("decimal(18,2)").alias("v"))
        sizes = [r["count"] for r in place(df, "v", "id").groupBy("_bucket").count().collect()]
        assert sum(sizes) == 4000 and max(sizes) < 2000
        plain = df.select("id", F.percent_rank().over(Window.orderBy("v")))
        ours = rank_globally(df, "v", "id", percent_rank="p").select("id", "p")
        assert sorted(map(tuple, ours.collect())) == sorted(map(tuple, plain.collect()))
        mixed = df.withColumn("v", F.when(F.col("id") < 3000, F.col("v")).otherwise(F.col("id").cast("decimal(18,2)")))
        plain = mixed.select("id", F.rank().over(Window.orderBy(F.desc("v"))).cast("long"))
        ours = rank_globally(mixed, "v", "id", descending=True, rank="r").select("id", "r")
        assert sorted(map(tuple, ours.collect())) == sorted(map(tuple, plain.collect()))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


@pytest.mark.parametrize("values", [[5], [1, 2], [1, 1, 9], [1, 2, 2, 7], list(range(101)), [3] * 50 + [4] * 50])
def test_weighted_median(spark, values):
    df = spark.createDataFrame([(Decimal(v),) for v in values], "v decimal(18,2)")
    counts = df.groupBy("v").agg(F.count(F.lit(1)).alias("w"))
    ordered = sorted(values)
    expected = (ordered[(len(values) - 1) // 2] + ordered[len(values) // 2]) / 2
    assert float(spark.range(1).select(weighted_median(counts, "v", "w")).first()[0]) == expected


def test_empty_input(spark):
    df = spark.createDataFrame([], "id long, v decimal(18,2)")
    assert rank_globally(df, "v", "id", row_number="rn", percent_rank="p").count() == 0
    assert spark.range(1).select(weighted_median(df.withColumn("w", F.lit(1)), "v", "w")).first()[0] is None
