"""Statistics of all columns at once, one row a column.

Numbers have count, mean, standard deviation, extremes and quartiles (linear between the two nearest values), all other
columns count, distinct values, the most frequent one (the smallest text of several) and how often it occurs.

Means and deviations are one aggregate over the rows.  Everything else comes from one table of (column, value, rows), made of
one aggregate per column, which reads that column alone and combines before its shuffle.  A single range sort of its numbers
by column and value gives every quartile of every column: a range partition's rows before it are one small row per column, so
no task holds a column.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.operators.ordering import place
from tallyhouse.session import materialize

QUARTILES = (("q25", 0.25), ("q50", 0.50), ("q75", 0.75))


def value_table(df: DataFrame) -> DataFrame:
    """(column_name, number, text, n) of every value that is not null, numbers as double, the rest as text.

    One aggregate per column: a row is never multiplied by its columns.
    """
    every = None
    for field in df.schema.fields:
        numeric = isinstance(field.dataType, T.NumericType)
        value = F.col(f"`{field.name}`").cast("double" if numeric else "string").alias("value")
        counted = df.select(value).filter("value IS NOT NULL").groupBy("value").agg(F.count(F.lit(1)).alias("n"))
        none = F.lit(None)
        rows = counted.select(
            F.lit(field.name).alias("column_name"),
            (F.col("value") if numeric else none).cast("double").alias("number"),
            (none if numeric else F.col("value")).cast("string").alias("text"),
            "n",
        )
        every = rows if every is None else every.unionByName(rows)
    return every


def quartiles(values: DataFrame) -> DataFrame:
    """(column_name, q25, q50, q75) from (column_name, number, n)."""
    placed = place(values.select("column_name", "number", "n"), "column_name", "number")
    before = Window.partitionBy("column_name").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    all_rows = Window.partitionBy("column_name")  # both run over one row per range partition
    starts = placed.groupBy("column_name", "_bucket").agg(F.sum("n").alias("_rows")).select(
        "column_name",
        "_bucket",
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"),
        F.sum("_rows").over(all_rows).alias("_total"),
    )
    within = Window.partitionBy("column_name", "_bucket").orderBy("_seq")
    ends = placed.join(starts, ["column_name", "_bucket"]).withColumn("_end", F.col("_start") + F.sum("n").over(within))
    holds = lambda place_: (F.col("_end") - F.col("n") <= place_) & (place_ < F.col("_end"))
    aggregates, wanted = [], F.lit(False)
    for name, share in QUARTILES:
        exact = (F.col("_total") - 1) * F.lit(share)
        low, high = F.floor(exact), F.ceil(exact)
        wanted = wanted | holds(low) | holds(high)
        aggregates += [F.max(F.when(holds(low), F.col("number"))).alias(f"{name}_low"), F.max(F.when(holds(high), F.col("number"))).alias(f"{name}_high")]
        aggregates.append(F.max(exact - low).alias(f"{name}_share"))
    found = ends.filter(wanted).groupBy("column_name").agg(*aggregates)
    between = [(F.col(f"{n}_low") + (F.col(f"{n}_high") - F.col(f"{n}_low")) * F.col(f"{n}_share")).alias(n) for n, _ in QUARTILES]
    return found.select("column_name", *between)


def describe_all(df: DataFrame) -> DataFrame:
    """column_name, value_count, unique_values, top, freq, mean, std, min, q25, q50, q75, max of every column.

    The rows are read by column, so what is costly for all columns alike should be stored before.
    """
    numeric = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    values = materialize(value_table(df))
    counted = values.groupBy("column_name").agg(
        F.sum("n").alias("value_count"),
        F.count("text").alias("_texts"),
        F.max(F.when(F.col("text").isNotNull(), F.col("n"))).alias("freq"),
        F.min("number").alias("min"),
        F.max("number").alias("max"),
    )
    names = df.sparkSession.createDataFrame([(f.name,) for f in df.schema.fields], "column_name string")
    most = F.broadcast(counted.select("column_name", F.col("freq").alias("n")))  # one row per column
    top = values.filter("text IS NOT NULL").join(most, ["column_name", "n"]).groupBy("column_name").agg(F.min("text").alias("top"))
    moments = df.agg(
        *[F.avg(F.col(f"`{c}`").cast("double")).alias(f"mean {c}") for c in numeric],
        *[F.stddev_samp(F.col(f"`{c}`").cast("double")).alias(f"std {c}") for c in numeric],
    )
    spread = moments.select(
        F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"`mean {c}`").alias("mean"), F.col(f"`std {c}`").alias("std")) for c in numeric]))
    ) if numeric else names.limit(0).selectExpr("column_name", "double(null) mean", "double(null) std")
    every = names.join(counted, "column_name", "left").join(top, "column_name", "left").join(spread, "column_name", "left")
    every = every.join(quartiles(values.filter("number IS NOT NULL")), "column_name", "left")
    return every.select(
        "column_name",
        F.coalesce("value_count", F.lit(0)).alias("value_count"),
        F.when(F.col("_texts") > 0, F.col("_texts")).alias("unique_values"),
        "top", "freq", "mean", "std", "min", "q25", "q50", "q75", "max",
    )
