"""Small helpers shared by the corpus operators."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.session import materialize, shared_dir

LETTERS = re.compile(r"[^\W\d_]+")
SLICE_BYTES = 2 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(key: Column, folds: int) -> Column:
    """crc32 of the key as text, modulo ``folds``; null for a null key."""
    return F.crc32(key.cast("string").cast("binary")) % folds


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, learnable: Column, rows: int) -> DataFrame:
    """Up to ``rows`` labelled documents (doc_id, text, n_chars, label), chosen by a hash of the id.

    The bound makes the label side safe to broadcast.  Rows with a null id, text or label are not learned from, and a
    document that is labelled twice counts once, with the smaller label.
    """
    chosen = (
        labels.select(F.col("doc_id").alias("_id"), F.col(label).cast("int").alias("label"))
        .filter(F.col("_id").isNotNull() & F.col("label").isin(0, 1))
        .groupBy("_id")
        .agg(F.min("label").alias("label"))
        .withColumn("doc_id", F.col("_id"))
        .filter(learnable)
        .orderBy(F.xxhash64(F.col("_id").cast("string")), "_id")
        .limit(rows)
        .select("_id", "label")
    )
    declared = F.col("n_chars").cast("long") if "n_chars" in docs.columns else F.lit(None).cast("long")
    texts = docs.select("doc_id", "text", declared.alias("n_chars")).filter(F.col("text").isNotNull())
    return texts.join(F.broadcast(chosen), F.col("doc_id") == F.col("_id")).drop("_id")


def slices(batches: Iterator[pa.RecordBatch], column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of about ``most`` bytes of a text or binary column, one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(lengths.astype(np.int64) + 64)
        at = 0
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, before + most, side="right")))
            yield batch.slice(at, to - at)
            at = to


class WordHash:
    """crc32 of words modulo ``buckets``, remembered for up to ``most`` words."""

    def __init__(self, buckets: int, most: int = 400_000):
        self.buckets, self.most, self.known = buckets, most, {}

    def __call__(self, words) -> list[int]:
        known, out = self.known, []
        if len(known) > self.most:
            known.clear()
        for word in words:
            code = known.get(word)
            if code is None:
                code = known[word] = zlib.crc32(word.encode("utf-8", "surrogatepass")) % self.buckets
            out.append(code)
        return out


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -30.0, 30.0)))


def stored(df: DataFrame) -> DataFrame:
    """``materialize`` in zstd, freeing the shuffle files of the job that fills the table."""
    spark = df.sparkSession
    conf = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.parquet.compression.codec": "zstd"}
    before = {key: spark.conf.get(key, None) for key in conf}
    try:
        for key, value in conf.items():
            spark.conf.set(key, value)
        return materialize(df)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value) if value is not None else spark.conf.unset(key)


def forget(df: DataFrame) -> None:
    """Delete the files of a ``stored`` table that nothing reads any more."""
    spark = df.sparkSession
    root = shared_dir(spark)
    for folder in {name.rsplit("/", 1)[0] for name in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        if spark.sparkContext.applicationId in folder and path.toUri().getPath().startswith(spark._jvm.org.apache.hadoop.fs.Path(root).toUri().getPath()):
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def with_unique_id(docs: DataFrame) -> DataFrame:
    """Add ``_doc``, a unique long in the order of doc_id.

    That is doc_id itself where it is unique and never null.  Otherwise the rows are range-sorted by (doc_id, text),
    nulls first, numbered and stored, so that each of several equal rows is a document of its own.
    """
    ids = docs.select(F.col("doc_id").cast("long").alias("_doc"))
    if ids.groupBy("_doc").count().filter(F.col("_doc").isNull() | (F.col("count") > 1)).isEmpty():
        return docs.withColumn("_doc", F.col("doc_id").cast("long"))
    order = [F.col("doc_id").asc_nulls_first(), F.sha2(F.coalesce("text", F.lit("")), 256)]
    ordered = docs.repartitionByRange(*order).sortWithinPartitions(*order)
    return stored(ordered.withColumn("_doc", F.monotonically_increasing_id()))


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) of every node of an undirected graph; root is the smallest node of its component.

    Rounds of hooking every node to its smallest neighbour and contracting.  A star, as buckets give them, takes one
    round, a chain of n nodes O(log n) with the jump.  Each round is stored; hubs are met by joins, never collected.
    """
    left = stored(
        edges.select(F.least(a, b).alias("u"), F.greatest(a, b).alias("v")).filter("u < v").distinct()
    )
    labels = stored(left.select(F.explode(F.array("u", "v")).alias("node")).distinct().withColumn("root", F.col("node")))
    while not left.isEmpty():
        hook = left.groupBy(F.col("v").alias("child")).agg(F.min("u").alias("parent"))
        above = hook.select(F.col("child").alias("mid"), F.col("parent").alias("top"))
        hook = stored(hook.join(above, F.col("parent") == F.col("mid"), "left").select("child", F.coalesce("top", "parent").alias("parent")))
        at = [hook.select(F.col("child").alias(f"c{k}"), F.col("parent").alias(f"p{k}")) for k in (0, 1, 2)]
        moved = left.join(at[0], F.col("u") == F.col("c0"), "left").join(at[1], F.col("v") == F.col("c1"), "left")
        moved = moved.select(F.coalesce("p0", "u").alias("x"), F.coalesce("p1", "v").alias("y"))
        next_left = stored(moved.select(F.least("x", "y").alias("u"), F.greatest("x", "y").alias("v")).filter("u < v").distinct())
        next_labels = stored(labels.join(at[2], F.col("root") == F.col("c2"), "left").select("node", F.coalesce("p2", "root").alias("root")))
        for old in (left, labels, hook):
            forget(old)
        left, labels = next_left, next_labels
    return labels


def aside(df: DataFrame, names: tuple[str, ...]) -> tuple[DataFrame, dict[str, str]]:
    """The frame with columns of these names under others, and how to name them back."""
    back = {f"_their_{c}": c for c in names if c in df.columns}
    return df.withColumnsRenamed({old: new for new, old in back.items()}), back
