"""Large delimited files with line breaks inside quotes, read by many tasks.

A reader that honours such line breaks takes a file as a whole, since a split may begin inside a quoted value.  Here a
file is read as lines, split anywhere, and every line is described by what it does to the state "inside a quoted
value": it keeps it, swaps it, sets it or clears it.  These four functions compose, so one small row per split tells in
which state the next split begins.  Lines that belong to one record then meet by the line that began it; records of one
line, nearly all, are never grouped.

The state follows the CSV reader's own rule: a quote counts where a value begins, and inside a quoted value; a quote
in the middle of a plain value is a character like any other.  Lines end with a newline.  Where a file's first line has
a carriage return before it, every such pair is one line break, in values too.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyhouse.session import materialize

CLOSED_VALUE = r'(^|,)"(?:[^"]|"")*+"'
OPEN_VALUE = r'(?:^|,)"'
REST_OF_VALUE = r'^(?:[^"]|"")*+"'


def ends_open(line: Column) -> Column:
    """Whether a line that begins outside a quoted value ends inside one."""
    return F.regexp_replace(line, CLOSED_VALUE, "$1").rlike(OPEN_VALUE)


def ends_open_from_inside(line: Column) -> Column:
    """Whether a line that begins inside a quoted value ends inside one."""
    # A value's rest ends with a character that is no separator, so that what follows is not taken for a new value.
    rest = F.regexp_replace(line, REST_OF_VALUE, "_")
    return F.when(line.rlike(REST_OF_VALUE), ends_open(rest)).otherwise(True)


def numbered_lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Lines with file, split and a number that grows along the split."""
    rows = spark.read.option("lineSep", "\n").text(list(paths))
    return rows.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("n"),
        F.col("value").alias("line"),
    )


def files_with_breaks(spark: SparkSession, paths: Sequence[str]) -> list[str]:
    """Files in which a line leaves a quoted value open.  Where none does, every line is a record."""
    open_lines = numbered_lines(spark, paths).filter(F.col("line").contains('"')).filter(ends_open(F.col("line")))
    # At most the files of the listing that the driver holds already.
    return sorted(r["file"] for r in open_lines.select("file").distinct().collect())


def records(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(file, is_first, record): every record of the files as one text, line breaks included.

    Lines are stored once, as splits must be the same in all passes.  Windows run within a split, whose size is bounded,
    and over one row per split of a file.  A record that is still open at the end of its file ends there.
    """
    line = F.col("line")
    quoted = line.contains('"')
    stored = materialize(
        numbered_lines(spark, paths).withColumns(
            {"out_to": quoted & ends_open(line), "in_to": ~quoted | ends_open_from_inside(line), "cr": line.endswith("\r")}
        )
    )
    swaps = ~F.col("in_to") & F.col("out_to")
    fixed = F.col("in_to") == F.col("out_to")
    along = Window.partitionBy("file", "split").orderBy("n")
    so_far = along.rowsBetween(Window.unboundedPreceding, 0)
    odd = F.sum(swaps.cast("long")).over(so_far) % 2 == 1
    lines = (
        stored.withColumn("odd", odd)
        # The state that a split would have to begin with, had nothing fixed it: the last fixed state, less the swaps up to it.
        .withColumn("base", F.last(F.when(fixed, F.col("out_to") != F.col("odd")), ignorenulls=True).over(so_far))
    )
    ends = lines.groupBy("file", "split").agg(
        F.max_by("odd", "n").alias("end_odd"), F.max_by("base", "n").alias("end_base"), F.min_by("cr", "n").alias("first_cr")
    )
    splits = _entry_states(ends)
    entered = lines.join(splits, ["file", "split"])
    inside_after = F.coalesce("base", "enters_inside") != F.col("odd")
    entered = entered.withColumn("after", inside_after).withColumn(
        "before", F.coalesce(F.lag("after").over(along), F.col("enters_inside"))
    )
    began = F.last(F.when(~F.col("before"), F.col("n")), ignorenulls=True).over(so_far)
    entered = entered.withColumn("began", began)
    first_of_file = F.col("is_first_split") & (F.col("began") == F.first("n").over(along))
    entered = entered.withColumn("is_first", F.coalesce(first_of_file, F.lit(False)))
    alone = entered.filter(~F.col("before") & ~F.col("after")).select("file", "is_first", "pairs", F.col("line").alias("record"))
    found = alone.unionByName(_of_many_lines(entered.filter(F.col("before") | F.col("after"))))
    one_break = F.regexp_replace(F.regexp_replace("record", "\r\n", "\n"), "\r$", "")
    return found.select("file", "is_first", F.when(F.col("pairs"), one_break).otherwise(F.col("record")).alias("record"))


def _entry_states(ends: DataFrame) -> DataFrame:
    """For every split whether it begins inside a quoted value, from the last line of each split before it."""
    of_file = Window.partitionBy("file").orderBy("split")
    before = of_file.rowsBetween(Window.unboundedPreceding, -1)
    # Seen from the file's beginning, a fixed state of a split is again one less the swaps up to it.
    odd_before = F.coalesce(F.sum(F.col("end_odd").cast("long")).over(before), F.lit(0)) % 2 == 1
    states = ends.withColumn("odd_before", odd_before).withColumn("base_here", F.col("end_base") != F.col("odd_before"))
    base = F.coalesce(F.last("base_here", ignorenulls=True).over(before), F.lit(False))
    return states.select(
        "file",
        "split",
        (base != F.col("odd_before")).alias("enters_inside"),
        (F.row_number().over(of_file) == 1).alias("is_first_split"),
        F.first("first_cr").over(of_file).alias("pairs"),
    )


def _of_many_lines(parts: DataFrame) -> DataFrame:
    """Records of several lines; what a split holds of a record that began before goes to the split that began it."""
    of_file = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    last_began = parts.groupBy("file", "split").agg(F.max("began").alias("last_began"))
    earlier = last_began.select("file", "split", F.last("last_began", ignorenulls=True).over(of_file).alias("began_before"))
    keyed = parts.join(earlier, ["file", "split"]).withColumn("began", F.coalesce("began", "began_before"))
    lines = F.array_sort(F.collect_list(F.struct("split", "n", "line")))
    return (
        keyed.groupBy("file", "began")
        .agg(F.max("is_first").alias("is_first"), F.max("pairs").alias("pairs"), lines.alias("lines"))
        .select("file", "is_first", "pairs", F.array_join("lines.line", "\n").alias("record"))
    )


def rows_of_records(spark: SparkSession, paths: Sequence[str], names: Sequence[str], options: dict[str, str]) -> DataFrame:
    """The records of files as rows of text columns; the first record of each file must hold the names."""
    schema = ", ".join(f"`{name}` string" for name in names)
    parser = {k: v for k, v in options.items() if k not in ("header", "encoding")}
    found = records(spark, paths).filter("record <> ''")
    parsed = materialize(found.select("file", "is_first", F.from_csv("record", schema, parser).alias("r")))
    heads = parsed.filter("is_first").filter(~(F.concat_ws("\n", "r.*") == "\n".join(names)))
    wrong = heads.select("file", "r.*").first()
    if wrong:
        raise ValueError(f"the header of {wrong['file']} is {list(wrong)[1:]}, expected {list(names)}")
    return parsed.filter("NOT is_first").select("r.*")
