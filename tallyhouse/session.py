"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Settings a cluster job should run with.  Shuffle partitions start high and
# AQE coalesces them, so the same value serves small and large inputs.
CLUSTER_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "8192",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.parquet.compression.codec": "zstd",
    # Shuffle files too: two fifths fewer bytes than lz4 where lines are moved.
    "spark.io.compression.codec": "zstd",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


# Of every table the library stores, whatever the session's own default.
PARQUET_CODEC = CLUSTER_CONF["spark.sql.parquet.compression.codec"]


def build_session(app_name: str = "tallyhouse", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the cluster settings; ``conf`` overrides single keys."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**CLUSTER_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local-mode session that names none gets a scratch folder of its own;
    on a cluster a machine-local folder would be lost with its machine.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        folder = tempfile.mkdtemp(prefix="tallyhouse-")
        context.setCheckpointDir(folder)
    return folder


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Queries inside remove their shuffle files when they end, not when the driver happens to collect garbage.

    For writes: what was written is read from there, so a load holds the shuffles of one step at a time.
    """
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "errorifexists", **options: str) -> None:
    """A stored table: compressed, and without shuffle files left behind."""
    with shuffles_removed(df.sparkSession):
        df.write.mode(mode).options(**options).partitionBy(*partition_by).parquet(path, compression=PARQUET_CODEC)


_aside: ContextVar[list[str] | None] = ContextVar("tables stored aside", default=None)


@contextmanager
def stored_aside(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Tables materialized inside are removed when it ends, whether it succeeds or not.

    For steps whose result is written elsewhere, so that a load holds the intermediate tables of one step at a time.  It
    gives a ``materialize`` whose tables stay for the step around it.
    """
    paths: list[str] = []
    outer = _aside.get()
    before = _aside.set(paths)

    def keep(df: DataFrame) -> DataFrame:
        inner = _aside.set(outer)
        try:
            return materialize(df)
        finally:
            _aside.reset(inner)

    try:
        yield keep
    finally:
        _aside.reset(before)
        for path in paths:
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def materialize(df: DataFrame, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write a frame to a table in the shared folder and read it from there.

    Computed once and cut from its lineage, yet safe when executors are lost.
    Parquet lets each reader take only its columns and gives the planner real
    sizes.  Tables lie under the application's id, for removal after the job,
    or after the step that needs them (``stored_aside``).
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/{uuid.uuid4()}"
    if (aside := _aside.get()) is not None:
        aside.append(path)
    write_parquet(df, path, partition_by)
    return spark.read.schema(df.schema).parquet(path)


# Rows up to which a stored table may be broadcast, if its size allows it: pairs of keys are then about 90 MB in memory.
BROADCAST_ROWS = 1_500_000


def by_rows(stored: DataFrame) -> DataFrame:
    """A stored table as a side of joins; with more than ``BROADCAST_ROWS`` rows it is moved by key, never broadcast.

    Sizes are those of compressed files.  Sorted keys take about a byte there and 57 in memory, so millions of them pass as
    small, and the driver would have to hold them.  The rows are counted in the files' footers.
    """
    return stored.hint("merge") if stored.count() > BROADCAST_ROWS else stored


def literal_rows(spark: SparkSession, rows: Sequence[Sequence], schema: str) -> DataFrame:
    """A few known rows as literals, without a Python worker."""
    fields = T.StructType.fromDDL(schema).fields
    if not rows:
        return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in fields])
    structs = [
        F.struct(*[F.lit(value).cast(f.dataType).alias(f.name) for value, f in zip(row, fields)]) for row in rows
    ]
    return spark.range(1, numPartitions=1).select(F.inline(F.array(*structs)))
