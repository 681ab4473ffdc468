"""Sums and distinct counts per key that move rows once, with frequent keys spread over tasks."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Share of all rows above which a key's rows are not left to one task, and the tasks they are spread over.
FREQUENT_SHARE = 0.001
SPREAD = 256


def frequent_values(df: DataFrame, column: str, share: float = FREQUENT_SHARE) -> list:
    """The values that more than ``share`` of the rows hold, rarer ones may be among them; at most ``1 / share``.

    One pass over the column with a sketch of bounded size per task; no row is moved.
    """
    return [v for v in df.stat.freqItems([column], share).first()[0] if v is not None]


def is_one_of(column: str, values: Sequence) -> Column:
    """Never null, so that a null key belongs to the other rows."""
    return F.coalesce(F.col(column).isin(list(values)), F.lit(False))


def totals_by_key(
    rows: DataFrame,
    key: str,
    totals: Mapping[str, tuple[Callable[..., Column], str | None]],
    distinct: str,
    distinct_name: str,
) -> DataFrame:
    """Per key the distinct values of ``distinct``, and ``totals``: a sum, count, minimum or maximum of a column (None: rows).

    As an aggregate, a distinct count sends the sums of every (key, value) pair twice.  Here the plain columns are sent once,
    by key, those of a frequent key by value too; what follows is one row per key, or ``SPREAD`` for a frequent one.
    """
    parts = rows.select(*dict.fromkeys([key, distinct, *[c for _, c in totals.values() if c]]))
    by, frequent = [key], frequent_values(rows, key)
    if frequent:
        spread = F.pmod(F.xxhash64(distinct), F.lit(SPREAD)).cast("int")
        by, parts = [key, "_part"], parts.withColumn("_part", F.when(is_one_of(key, frequent), spread).otherwise(0))
    parts = parts.repartition(*by).groupBy(*by).agg(
        F.count_distinct(distinct).alias(distinct_name),
        *[how(F.col(c) if c else F.lit(1)).alias(name) for name, (how, c) in totals.items()],
    )
    if not frequent:
        return parts
    kinds = {f.name: f.dataType for f in parts.schema.fields}
    again = {name: F.sum if how is F.count else how for name, (how, _) in totals.items()}
    return parts.groupBy(key).agg(
        *[how(name).cast(kinds[name]).alias(name) for name, how in {distinct_name: F.sum, **again}.items()]
    )
