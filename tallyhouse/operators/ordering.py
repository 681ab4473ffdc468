"""Global ranks without moving all rows to one task.

A window without ``partitionBy`` sorts the whole input in a single task.  Here
Spark's range partitioner spreads the rows over ordered buckets instead; within
a bucket the position comes from the sorted partition, and one small row per
bucket carries how much precedes it.  The order always ends in a unique key, so
equal values can be split over buckets and no bucket grows with a frequent one.

``place`` freezes bucket and position in the shared folder, so a retried task
or a second reader sees the same ones.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.session import materialize

_SEQ_BITS = 33  # monotonically_increasing_id: partition above, row number below


def place(df: DataFrame, value: str, tie: str, descending: bool = False) -> DataFrame:
    """Add ``_bucket`` and ``_seq`` (from 0) in the order (value, tie)."""
    order = [F.col(value).desc() if descending else F.col(value).asc(), F.col(tie).asc()]
    position = F.monotonically_increasing_id()
    placed = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_position", position)
        .withColumns(
            {
                "_bucket": F.shiftright("_position", _SEQ_BITS).cast("int"),
                "_seq": F.col("_position").bitwiseAND(F.lit((1 << _SEQ_BITS) - 1)),
            }
        )
        .drop("_position")
    )
    return materialize(placed)


def _bucket_starts(placed: DataFrame, running: Mapping[str, str], value: str | None, descending: bool) -> DataFrame:
    """One row per bucket: rows, sums and first rank before it.

    The windows below run over as many rows as there are range partitions.
    """
    aggs = [F.count(F.lit(1)).alias("_n")]
    aggs += [F.sum(column).alias(f"_sum_{name}") for name, column in running.items()]
    if value:
        extreme, other = (F.min, F.max) if descending else (F.max, F.min)
        seq_sign = 1 if descending else -1
        aggs += [
            other(value).alias("_first"),
            extreme(F.struct(F.col(value).alias("v"), (F.col("_seq") * seq_sign).alias("s"))).alias("_last"),
        ]
    buckets = placed.groupBy("_bucket").agg(*aggs)
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = {
        "_start": F.coalesce(F.sum("_n").over(before), F.lit(0)),
        "_total": F.sum("_n").over(Window.partitionBy()),
    }
    for name in running:
        starts[f"_start_{name}"] = F.coalesce(F.sum(f"_sum_{name}").over(before), F.lit(0))
        starts[f"_total_{name}"] = F.sum(f"_sum_{name}").over(Window.partitionBy())
    buckets = buckets.withColumns(starts)
    if value:
        # Rank of a bucket's last value, from the earliest bucket that ends in it.
        last_rank = F.col("_start") + F.abs(F.col("_last.s")) + 1
        buckets = buckets.withColumn("_last_rank", F.min(last_rank).over(Window.partitionBy("_last.v")))
        step = Window.orderBy("_bucket")
        carried = F.lag("_last.v").over(step) == F.col("_first")
        buckets = buckets.withColumn(
            "_first_rank", F.when(carried, F.lag("_last_rank").over(step)).otherwise(F.col("_start") + 1)
        )
    drop = ["_n"] + [f"_sum_{name}" for name in running] + (["_last", "_last_rank"] if value else [])
    return buckets.drop(*drop)


def ntile_of(position: Column, total: Column, tiles: int) -> Column:
    """NTILE from a 1-based position: the first ``total % tiles`` tiles hold one more."""
    small = F.floor(total / tiles)
    extra = total - small * tiles
    wide_rows = extra * (small + 1)
    in_wide = F.floor((position - 1) / (small + 1)) + 1
    in_small = extra + F.floor((position - 1 - wide_rows) / F.greatest(small, F.lit(1))) + 1
    return F.when(position <= wide_rows, in_wide).otherwise(in_small).cast("int")


def rank_globally(
    df: DataFrame,
    value: str,
    tie: str,
    descending: bool = False,
    row_number: str | None = None,
    rank: str | None = None,
    percent_rank: str | None = None,
    ntiles: Mapping[str, int] | None = None,
    running: Mapping[str, str] | None = None,
    totals: Mapping[str, str] | None = None,
    total_rows: str | None = None,
) -> DataFrame:
    """Add global ranking columns in the order (value, tie).

    ``tie`` must be unique and both columns not null.  ``running`` maps a new
    column to the (exact, decimal or integer) column summed up to and including
    the row; ``totals`` maps a new column to a key of ``running`` for its grand
    total.  ``rank`` and ``percent_rank`` give equal values equal ranks.
    """
    running, totals, ntiles = dict(running or {}), dict(totals or {}), dict(ntiles or {})
    ranked = rank is not None or percent_rank is not None
    placed = place(df, value, tie, descending)
    starts = _bucket_starts(placed, running, value if ranked else None, descending)
    # One row per range partition, whatever the data size.
    rows = placed.join(F.broadcast(starts), "_bucket")

    added: dict[str, Column] = {}
    position = F.col("_start") + F.col("_seq") + 1
    if row_number:
        added[row_number] = position
    for name, tiles in ntiles.items():
        added[name] = ntile_of(position, F.col("_total"), tiles)
    for name, column in running.items():
        upto = Window.partitionBy("_bucket").orderBy("_seq").rowsBetween(Window.unboundedPreceding, 0)
        added[name] = F.col(f"_start_{name}") + F.sum(column).over(upto)
    for name, source in totals.items():
        added[name] = F.col(f"_total_{source}")
    if total_rows:
        added[total_rows] = F.col("_total")
    if ranked:
        local = F.col("_start") + F.min("_seq").over(Window.partitionBy("_bucket", value)) + 1
        exact = F.when(F.col(value) == F.col("_first"), F.col("_first_rank")).otherwise(local)
        if rank:
            added[rank] = exact
        if percent_rank:
            added[percent_rank] = F.when(
                F.col("_total") > 1, (exact - 1).cast("double") / (F.col("_total") - 1)
            ).otherwise(F.lit(0.0))
    return rows.withColumns(added).select(*df.columns, *added)


def ntile_column(df: DataFrame, value: str, tie: str, tiles: int, descending: bool = False) -> Column:
    """NTILE as a plain expression over ``df``'s rows.

    Only (value, tie) is sorted; the last row of every tile but the final one is
    kept, and a row's tile is one more than the tile ends before it.  ``df``
    should be materialized, as it is read once per call.
    """
    sorted_keys = rank_globally(df.select(value, tie), value, tie, descending, row_number="_rn", total_rows="_n")
    ends = sorted_keys.filter(
        (F.col("_rn") < F.col("_n"))
        & (ntile_of(F.col("_rn"), F.col("_n"), tiles) < ntile_of(F.col("_rn") + 1, F.col("_n"), tiles))
    )
    cuts = ends.select("_rn", value, tie).collect()  # at most tiles - 1 rows
    kinds = dict(df.select(value, tie).dtypes)
    tile = F.lit(1)
    for cut in sorted(cuts):
        cut_value, cut_tie = F.lit(cut[value]).cast(kinds[value]), F.lit(cut[tie]).cast(kinds[tie])
        beyond = F.col(value) < cut_value if descending else F.col(value) > cut_value
        tile = tile + F.when(beyond | ((F.col(value) == cut_value) & (F.col(tie) > cut_tie)), 1).otherwise(0)
    return tile


def weighted_median(counts: DataFrame, value: str, weight: str) -> Column:
    """Median of a value held as distinct values with counts, as a scalar column.

    Exact: the mean of the two middle values (the same one twice for an odd
    count).  Null when there is no row.
    """
    walked = rank_globally(
        counts.select(value, weight).withColumn("_key", F.col(value)),
        value,
        "_key",
        running={"_upto": weight},
        totals={"_all": "_upto"},
    )
    start = F.col("_upto") - F.col(weight)
    low, high = F.floor((F.col("_all") + 1) / 2), F.floor((F.col("_all") + 2) / 2)

    def holds(position):
        return (position > start) & (position <= F.col("_upto"))

    middle = walked.filter(holds(low) | holds(high))
    both = F.sum(F.col(value) * (holds(low).cast("int") + holds(high).cast("int")))
    return middle.agg((both / 2).alias("median")).scalar()


