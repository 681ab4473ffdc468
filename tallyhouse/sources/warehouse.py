"""Parquet warehouse with published table versions and a run log.

A table is replaced by writing a folder of its own and then publishing it in
the log, so readers never see half a table and no path is overwritten or removed
while it is read.  A table is a list of folders: a whole version, or single
partitions of earlier versions beside it, at most one per partition value.  Both
logs are append-only: one small file per publication or run, and a reader takes
the newest row.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from datetime import date, datetime, timezone
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.schemas import CONTROL_SCHEMA
from tallyhouse.session import by_rows, literal_rows, write_parquet

VERSION_SCHEMA = "seq long, publication string, table_name string, version long, folder string, schema string"
FOLDER = "table_version"
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


class Version(NamedTuple):
    """A state of a table: its number, its folders below the table's own, its columns."""

    number: int
    folders: tuple[str, ...]
    schema: T.StructType


class Warehouse:
    """Layers raw, staging and dw under one root folder.

    An open warehouse keeps reading the table versions it first saw, so all its
    frames belong together; ``refresh`` moves it to the newest ones.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._versions: dict[str, Version] | None = None
        self._held: dict[str, Version] | None = None
        self._seq = 0

    def refresh(self) -> "Warehouse":
        self._versions = None
        return self

    # --- paths and logs ---

    def path(self, layer: str, table: str) -> str:
        return f"{self.root}/{layer}/{table}"

    def _log(self, name: str, schema: str) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(self.path("control", name))
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return literal_rows(self.spark, [], schema)

    def _append(self, name: str, rows: Sequence[tuple], schema: str) -> None:
        literal_rows(self.spark, rows, schema).write.mode("append").parquet(self.path("control", name))

    def _published(self) -> dict[str, Version]:
        """Newest publication of every table; its folders are bounded by the calendar."""
        if self._versions is None:
            each = self._log("versions", VERSION_SCHEMA).groupBy("table_name", "seq", "publication").agg(
                F.max("version").alias("version"), F.max("schema").alias("schema"), F.collect_set("folder").alias("folders")
            )
            newest = each.groupBy("table_name").agg(
                F.max_by(F.struct("version", "folders", "schema"), F.struct("seq", "publication")).alias("r"), F.max("seq").alias("s")
            )
            rows = newest.collect()
            self._versions = {
                r["table_name"]: Version(
                    r["r"]["version"], tuple(sorted(r["r"]["folders"])), T.StructType.fromJson(json.loads(r["r"]["schema"]))
                )
                for r in rows
            }
            self._seq = max((r["s"] for r in rows), default=0)
        return self._versions

    def current_version(self, table: str) -> int:
        """Number of the version in view, 0 when there is none."""
        return self._published()[table].number if self.exists(table) else 0

    # --- tables ---

    def exists(self, table: str) -> bool:
        return table in self._published()

    def read(self, table: str) -> DataFrame:
        if not self.exists(table):
            raise ValueError(f"table {table} has not been published")
        return self.read_version(table, self._published()[table])

    def lookup(self, table: str) -> DataFrame:
        """The table as the side of joins that is looked up; a large one is not broadcast."""
        return by_rows(self.read(table))

    def read_version(self, table: str, version: Version) -> DataFrame:
        return self._with_folder(table, version).drop(FOLDER)

    def _with_folder(self, table: str, version: Version) -> DataFrame:
        base = self.path("dw", table)
        reader = self.spark.read.schema(version.schema).option("basePath", base)
        return reader.parquet(*[f"{base}/{folder}" for folder in version.folders])

    def write_version(self, table: str, df: DataFrame, partition_by: Sequence[str] = (), moved: bool = False) -> Version:
        """Write a new, not yet published version into a folder of its own.

        Partitioned tables are rebalanced on their partition columns: AQE makes
        files of the advisory size and splits a folder that holds too much.  Rows
        that were ``moved`` to their folders already stay where they are.
        """
        number = self.current_version(table) + 1
        folder = f"{FOLDER}=v{number:06d}-{uuid.uuid4().hex}"
        rows = df.hint("rebalance", *partition_by) if partition_by and not moved else df
        write_parquet(rows, f"{self.path('dw', table)}/{folder}", partition_by)
        return Version(number, (folder,), df.schema)

    def publish(self, versions: Mapping[str, Version]) -> None:
        """Make the versions current, all at once; inside ``one_publication`` at its end."""
        self._published()
        if self._held is not None:
            self._held.update(versions)
        else:
            self._seq += 1
            key = (self._seq, uuid.uuid4().hex)
            rows = []
            for table, v in versions.items():
                rows += [(*key, table, v.number, folder, None) for folder in v.folders]
                rows.append((*key, table, v.number, None, v.schema.json()))
            self._append("versions", rows, VERSION_SCHEMA)
        self._versions.update(versions)

    @contextmanager
    def one_publication(self) -> Iterator[None]:
        """Start from the newest versions and publish all that is written inside together, or nothing if it fails.

        Reads through this warehouse see what was written; other readers do not until the end.
        """
        self.refresh()
        self._held = {}
        try:
            yield
            held, self._held = self._held, None
            if held:
                self.publish(held)
        except BaseException:
            self._held = None
            self.refresh()
            raise

    def replace(self, table: str, df: DataFrame, partition_by: Sequence[str] = ()) -> None:
        self.publish({table: self.write_version(table, df, partition_by)})

    def append(self, table: str, df: DataFrame) -> DataFrame:
        """Add rows to a table, which may be new; what is there stays where it is.  Returns the rows added."""
        new = self.write_version(table, df)
        before = self._published()[table].folders if self.exists(table) else ()
        self.publish({table: Version(new.number, (*before, *new.folders), new.schema)})
        return self.read_version(table, new)

    def overwrite_partitions(
        self, table: str, df: DataFrame, partition_by: Sequence[str], old: DataFrame, number: int | None = None
    ) -> DataFrame:
        """Replace the partitions of ``old`` (rows of the table) and those of ``df`` by the rows of ``df``.

        Only ``df`` is written; the other partitions stay where they are, and the
        replaced ones too, for readers that hold them.  Returns the rows written.
        ``number`` is the new version's, by default the next one.
        """
        keys = list(partition_by)
        current = self._published()[table]
        new = self.write_version(table, df, keys)
        written = self.read_version(table, new)
        # Partition values only: bounded by the calendar.
        replaced = {tuple(r) for r in old.select(*keys).union(written.select(*keys)).distinct().collect()}
        held = self._with_folder(table, current)
        values = held.select(FOLDER, *keys).distinct().collect() if FOLDER in held.columns else []
        kept = []
        for r in values:
            if tuple(r[k] for k in keys) not in replaced:
                parts = [f"{k}={NULL_PARTITION if r[k] is None else r[k]}" for k in keys]
                kept.append("/".join([f"{FOLDER}={r[FOLDER]}", *parts]))
        self.publish({table: Version(number or new.number, (*kept, *new.folders), current.schema)})
        return written

    # --- run log ---

    def runs(self) -> DataFrame:
        return self._log("runs", CONTROL_SCHEMA)

    def high_water_mark(self, pipeline: str) -> date | None:
        return read_high_water_mark(self.runs(), pipeline)

    def record_run(
        self,
        pipeline: str,
        loaded_date: date | None,
        started: datetime,
        status: str,
        rows_loaded: int | None,
        load_id: str,
        rows_rejected: int | None = None,
    ) -> None:
        seq = self.runs().agg(F.coalesce(F.max("run_seq"), F.lit(0))).first()[0] + 1
        ended = datetime.now(timezone.utc).replace(tzinfo=None)
        self._append("runs", [(seq, pipeline, loaded_date, started, ended, status, rows_loaded, load_id, rows_rejected)], CONTROL_SCHEMA)


def current_runs(runs: DataFrame) -> DataFrame:
    """Newest row per pipeline: the control table as it stands."""
    latest = runs.groupBy("pipeline_name").agg(F.max_by(F.struct(*runs.columns), "run_seq").alias("r"))
    return latest.select("r.*")


def upsert_runs(runs: DataFrame, updates: DataFrame) -> DataFrame:
    """Control table after newer rows replaced those of the same pipelines."""
    return current_runs(runs.unionByName(updates))


def high_water_marks(runs: DataFrame) -> DataFrame:
    """Date of the newest successful run per pipeline; a later failed run does not hide it."""
    done = runs.filter(F.col("last_run_status") == "SUCCESS")
    return done.groupBy("pipeline_name").agg(F.max_by("last_loaded_date", "run_seq").alias("last_loaded_date"))


def read_high_water_mark(runs: DataFrame, pipeline: str) -> date | None:
    row = high_water_marks(runs.filter(F.col("pipeline_name") == pipeline)).first()
    return row["last_loaded_date"] if row else None
