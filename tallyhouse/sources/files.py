"""Delimited files in and out, and the layer writers."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.functions import rules
from tallyhouse.functions.expressions import null_if_token
from tallyhouse.schemas import AUDIT_COLUMNS, SOURCE_COLUMNS, STAGING_COLUMNS, STAGING_RENAMES
from tallyhouse.session import shuffles_removed, write_parquet
from tallyhouse.sources.records import files_with_breaks, rows_of_records

# The dialect of landing files: comma, newline, double quotes, header, UTF-8, line breaks inside quotes.
CSV_OPTIONS = {
    "multiLine": "true",
    "header": "true",
    "sep": ",",
    "quote": '"',
    "escape": '"',
    "encoding": "UTF-8",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "emptyValue": "",
}


def bytes_of(size: str) -> int:
    """A size setting such as ``256m`` or ``134217728b`` in bytes."""
    number, unit = re.fullmatch(r"(\d+)([kmgt]?)b?", size.strip().lower()).groups()
    return int(number) << (10 * " kmgt".index(unit or " "))


def read_rows(spark: SparkSession, path: str | Sequence[str], names: Sequence[str], split_above: int | None = None) -> DataFrame:
    """Rows of text columns under the given names, which every file's header must hold.

    Files up to ``split_above`` bytes (by default the size of a split) are one task each.  Larger ones are looked
    through for quoted values left open at a line's end: files without any are split by Spark, files with line breaks
    inside quotes are cut into records by many tasks.  Only a file without a newline stays in one piece.
    """
    path = [path] if isinstance(path, str) else list(path)
    if split_above is None:
        split_above = bytes_of(spark.conf.get("spark.sql.files.maxPartitionBytes"))
    schema = ", ".join(f"`{name}` string" for name in names)

    def read(paths, multi_line):
        options = {**CSV_OPTIONS, "multiLine": multi_line}
        return spark.read.options(**options, enforceSchema="false").schema(schema).csv(paths)

    listed = spark.read.format("binaryFile").load(path).select("path", "length")  # contents are not read
    large = sorted(r["path"] for r in listed.filter(F.col("length") > split_above).collect())
    if not large:
        return read(path, "true")
    broken = files_with_breaks(spark, large)
    small = sorted(r["path"] for r in listed.filter(F.col("length") <= split_above).collect())
    whole = sorted(set(large) - set(broken))
    parts = [read(small, "true")] if small else []
    parts += [read(whole, "false")] if whole else []
    parts += [rows_of_records(spark, broken, names, CSV_OPTIONS)] if broken else []
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    return rows


def extract_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    null_tokens: Sequence[str] = rules.CSV_NULL_TOKENS,
    split_above: int | None = None,
) -> DataFrame:
    """Every column as text, missing-value texts as null.

    The header gives the names (cleaning standardises them); types are never
    inferred.  The header of every file is compared with the first one's, and
    reading fails by name where they differ, so no file is read by another's positions.
    """
    path = [path] if isinstance(path, str) else list(path)
    header = spark.read.options(**{**CSV_OPTIONS, "header": "false"}).csv(path).first()
    names = list(header) if header else list(SOURCE_COLUMNS)
    rows = read_rows(spark, path, names, split_above)
    return rows.select(*[null_if_token(F.col(f"`{c}`"), null_tokens).alias(c) for c in names])


def extract_fixed(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Source files known to have the standard 14 columns; no header look-up."""
    rows = read_rows(spark, path, SOURCE_COLUMNS)
    return rows.select(*[null_if_token(c, rules.CSV_NULL_TOKENS).alias(c) for c in SOURCE_COLUMNS])


def write_csv(df: DataFrame, path: str, quote_all: bool = False, compression: str | None = None) -> None:
    """Delimited files, with a compression such as ``gzip`` one task's rows each, which readers cannot split."""
    with shuffles_removed(df.sparkSession):
        writer = df.write.mode("overwrite").options(**CSV_OPTIONS, quoteAll=str(quote_all).lower())
        writer.csv(path, compression=compression)


def landing_copy(spark: SparkSession, source: str, target: str, compression: str | None = None) -> None:
    """Delimited file to delimited file with every text quoted."""
    write_csv(read_rows(spark, source, SOURCE_COLUMNS), target, quote_all=True, compression=compression)


def with_audit(df: DataFrame, load_id: str, source_file: str, load_time=None) -> DataFrame:
    """One batch id, one load time and the source name on every row."""
    stamp = F.current_timestamp() if load_time is None else F.lit(load_time)
    return df.withColumns(
        {
            "etl_load_id": F.lit(load_id),
            "etl_load_date": stamp.cast("timestamp"),
            "etl_source_file": F.lit(source_file),
        }
    )


def load_raw(df: DataFrame, path: str) -> None:
    """Append 17 columns to the raw layer, one folder per batch.

    The batch's folder is replaced as a whole, so a rerun of one batch does not
    deliver its rows twice.
    """
    rows = df.select(
        *[F.col(c).cast("string").alias(c) for c in SOURCE_COLUMNS + AUDIT_COLUMNS[:2]],
        F.col("etl_source_file").cast("string").alias("etl_source_file"),
    )
    write_parquet(rows, path, ("etl_load_id",), "overwrite", partitionOverwriteMode="dynamic")


def raw_bulk_copy(spark: SparkSession, landing: str, path: str, load_id: str, partitions: int | None = None) -> None:
    """Landing files into the raw layer in parallel.

    Files and the splits of large ones set the parallelism; ``partitions`` overrides it.
    """
    rows = with_audit(extract_fixed(spark, landing), load_id, landing)
    load_raw(rows.repartition(partitions) if partitions else rows, path)


def staging_rows(df: DataFrame) -> DataFrame:
    """The 16 staging columns under their staging names."""
    return df.select(*STAGING_COLUMNS).withColumnsRenamed(STAGING_RENAMES)


def staging_computed(staging: DataFrame) -> DataFrame:
    """The five computed staging columns.  The tenure keeps its sign here."""
    revenue = (F.col("quantity").cast("decimal(18,2)") * F.col("unit_price")).cast("decimal(38,2)")
    return staging.withColumns(
        {
            "calculated_revenue": revenue,
            "discount_amount": F.greatest(revenue - F.col("total_amount"), F.lit(0).cast("decimal(38,2)")),
            "order_year": F.year("order_date"),
            "order_month": F.month("order_date"),
            "customer_tenure_days": F.datediff("order_date", "signup_date"),
        }
    )


def load_staging(df: DataFrame, path: str) -> None:
    """Truncate and reload staging, computed columns included."""
    write_parquet(staging_computed(staging_rows(df)), path, mode="overwrite")


def save_processed(df: DataFrame, folder: str, run_ts: str) -> str:
    """Audit snapshot of the cleaned rows, one folder per run."""
    path = f"{folder}/run_ts={run_ts}"
    write_parquet(df, path, mode="overwrite")
    return path


def read_columns(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    rows = spark.read.parquet(path)
    return rows.select(*columns) if columns else rows


def read_jdbc(spark: SparkSession, url: str, table: str, key: str | None = None, bounds=None, partitions: int = 16) -> DataFrame:
    """Optional database source, split over a numeric key when bounds are given."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    if key and bounds:
        reader = (
            reader.option("partitionColumn", key)
            .option("lowerBound", str(bounds[0]))
            .option("upperBound", str(bounds[1]))
            .option("numPartitions", str(partitions))
        )
    return reader.load()


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append", batch_size: int = 10000) -> None:
    df.write.format("jdbc").option("url", url).option("dbtable", table).option("batchsize", str(batch_size)).mode(mode).save()
