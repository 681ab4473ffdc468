"""Mixture-controlled packing of token streams into fixed windows.

Every source is a queue of documents.  A window gives queue k the quantum ``window * T_k / T`` of its tokens, where
``T_k`` is the queue's total: deficit round-robin with the mixture of the corpus as target.  A queue gets whole tokens
only; what it is owed or has been given ahead is its deficit and is carried to the next window.  Served in a fixed
order, with the rounding carried along the queues as well, the number of tokens that queue k has given after x tokens
in all is ``x * S_k // T - x * S_(k-1) // T`` (S: running totals of the queues), and the deficit stays within one token.  So
the deficits at any window are known without packing what lies before it, and every task cuts its own documents.

A queue must be owed a token per window for that count never to fall, so there are at most ``window`` such queues.
Sources with less than ``1/window`` of all tokens are mixed into one of them, each a queue of its own again: they are
the leaves of a binary tree, and after x tokens of a node its left child has given ``x * own // all`` and its right child
the others, which never fall whatever the shares.  A deficit is carried over as many windows as a source needs to be owed
a token; it stays below one token per level times the shares above, about two tokens where siblings are alike, for which
sources are set side by side by size.  If these sources together are owed less than a token per window, the smallest large
source is mixed in with them.  Their pieces are mostly single tokens.  All windows are full but the last one.

A document's place in its source needs the tokens before it: tasks store their token ids with a running count per
source, and the sums of (task, source) are ranked globally.  No text is shuffled.

Defined results: a null text is an empty one, which is the closing id alone; a null source is the empty source; every
row is packed, repeated ones again; an empty table gives no pieces.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.bpe_codec import encoding
from tallyhouse.llm.common import slices
from tallyhouse.operators.ordering import rank_globally
from tallyhouse.session import materialize

WINDOW = 1_024
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, source string"


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def token_ids(texts: list[str], tokenizer_file: str, rank_file: str, pattern: str, special: str) -> list[np.ndarray]:
    """Ids as the tokenizer file gives them.

    The rank file holds the same vocabulary and encodes several times faster; a text with the one added token's string
    goes to the tokenizer itself.
    """
    fast = encoding(rank_file, pattern)
    out = []
    for text in texts:
        if special in text:
            out.append(np.asarray(_tokenizer(tokenizer_file).encode(text, add_special_tokens=False).ids, "<u4"))
        else:
            out.append(np.frombuffer(fast.encode_to_numpy(text, disallowed_special=()), "<u4"))
    return out


def tokenise(docs: DataFrame, tokenizer_file: str, rank_file: str, pattern: str, special: str = "<|endoftext|>", end_id: int = 0) -> DataFrame:
    """(part, doc_id, source, before, n, ids): ``before`` counts the task's earlier tokens of that source."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, given = TaskContext.get().partitionId(), {}
        for batch in slices(batches, "text"):
            before, n, blobs = [], [], []
            ids = token_ids(batch.column("text").to_pylist(), tokenizer_file, rank_file, pattern, special)
            for source, code in zip(batch.column("source").to_pylist(), ids):
                code = np.append(code, end_id).astype("<u4")
                before.append(given.get(source, 0))
                n.append(len(code))
                given[source] = before[-1] + n[-1]
                blobs.append(code.astype("<u2").tobytes() if code.max() < 65_536 else b"\0" + code.tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array([part] * len(n), pa.int32()), batch.column("doc_id"), batch.column("source"), pa.array(before, pa.int64()), pa.array(n, pa.int64()), pa.array(blobs, pa.binary())],
                ["part", "doc_id", "source", "before", "n", "ids"],
            )

    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    )
    return texts.mapInArrow(run, "part int, doc_id long, source string, before long, n long, ids binary")


class Schedule:
    """How many tokens each queue has given after any number of tokens."""

    def __init__(self, totals: list[int], window: int):
        self.window, self.totals = window, totals
        self.upto = [0]
        for n in totals:
            self.upto.append(self.upto[-1] + n)

    def given(self, queue: int, windows: int) -> int:
        x, all_ = min(windows * self.window, self.upto[-1]), self.upto[-1]
        return x * self.upto[queue + 1] // all_ - x * self.upto[queue] // all_

    def offset(self, queue: int, window: int) -> int:
        """Where the queue's share begins in a window."""
        all_ = self.upto[-1]
        x, y = min(window * self.window, all_), min((window + 1) * self.window, all_)
        return y * self.upto[queue] // all_ - x * self.upto[queue] // all_

    def holding(self, queue: int, token: int) -> int:
        """The window that takes the queue's token."""
        w = max(0, token * self.upto[-1] // (self.totals[queue] * self.window) - 2)
        while self.given(queue, w + 1) <= token:
            w += 1
        while w and self.given(queue, w) > token:
            w -= 1
        return w

    def cut(self, queue: int, first: int, n: int) -> Iterator[tuple[int, int, int, int]]:
        """(start, length, window, offset) of the pieces of n tokens that begin at the queue's token ``first``."""
        w, at, end = self.holding(queue, first), first, first + n
        low = self.given(queue, w)
        while at < end:
            high = self.given(queue, w + 1)
            to = min(end, high)
            if to > at:
                yield at - first, to - at, w, self.offset(queue, w) + at - low
                at = to
            w, low = w + 1, high


def tree_paths(by_source: DataFrame) -> DataFrame:
    """(source, path): the steps from a leaf to the root of the binary tree over sources (source, n) in the order of n.

    A step (level, right, own, all) has the tokens of a node and of its parent.
    """
    rank = F.col("_rank") - 1
    ranked = materialize(rank_globally(by_source, "n", "source", row_number="_rank").select("source", "n", rank.alias("leaf")))
    height = max(1, (ranked.count() - 1).bit_length())
    leaves = ranked.select("source", "n", "leaf", F.explode(F.sequence(F.lit(0), F.lit(height))).alias("level"))
    nodes = materialize(leaves.groupBy("level", F.expr("shiftright(leaf, level)").alias("node")).agg(F.sum("n").alias("all")))
    steps = leaves.filter(F.col("level") > 0).withColumn("child", F.expr("shiftright(leaf, level - 1)"))
    steps = steps.withColumns({"node": F.expr("shiftright(child, 1)"), "right": F.col("child") % 2 == 1})
    children = nodes.select((F.col("level") + 1).alias("level"), F.col("node").alias("child"), F.col("all").alias("own"))
    steps = steps.join(children, ["level", "child"]).join(nodes, ["level", "node"])
    return steps.groupBy("source").agg(F.sort_array(F.collect_list(F.struct("level", "right", "own", "all"))).alias("path"))


def mixed(first: int, n: int, path: list[tuple[int, bool, int, int]]) -> np.ndarray:
    """Positions in the tree's queue of n tokens of a leaf that begin at its token ``first``."""
    at = np.arange(first, first + n)
    for _, right, own, all_ in path:
        if own == all_:
            continue
        if (int(at[-1]) + 1) * all_ >= 1 << 62:
            at = at.astype(object)
        at = at * all_ // own if right else -(-(at + 1) * all_ // own) - 1
    return at


def runs(first: int, n: int, path: list[dict] | None) -> Iterator[tuple[int, int, int]]:
    """(start in the document, position in the queue, length) of tokens that lie side by side in their queue."""
    if path is None:
        yield 0, first, n
        return
    at = mixed(first, n, [(x["level"], x["right"], x["own"], x["all"]) for x in path])
    begins = [0, *(np.flatnonzero(at[1:] - at[:-1] != 1) + 1).tolist(), n]
    for begin, end in zip(begins, begins[1:]):
        yield begin, int(at[begin]), end - begin


def pack(coded: DataFrame, window: int = WINDOW) -> DataFrame:
    """Pieces of tokenised documents; ``coded`` is what ``tokenise`` gives, stored."""
    sums = materialize(coded.groupBy("part", "source").agg(F.sum("n").alias("n")))
    by_source = sums.groupBy("source").agg(F.sum("n").alias("n"))
    total = by_source.agg(F.sum("n")).first()[0] or 0
    # At most ``window`` rows, by the condition.
    large = sorted((r["source"], int(r["n"])) for r in by_source.filter(F.col("n") * window >= total).collect())
    rest = total - sum(n for _, n in large)
    if rest and large and rest * window < total:
        smallest = min(large, key=lambda x: x[::-1])
        large.remove(smallest)
        rest += smallest[1]
    totals = [n for _, n in large] + [rest] * (rest > 0)
    shared = len(large)  # the queue of all other sources
    plan, names = Schedule(totals, window), [name for name, _ in large]

    queue = F.lit(shared)
    if names:
        position = F.array_position(F.array(*[F.lit(name) for name in names]), F.col("source"))
        queue = F.when(position > 0, (position - 1).cast("int")).otherwise(queue)
    queued = sums.withColumn("queue", queue.cast("int")).withColumn("_tie", F.struct("source", "part"))
    starts = rank_globally(queued, "queue", "_tie", running={"upto": "n"})
    starts = starts.select("part", "source", "queue", (F.col("upto") - F.col("n")).alias("first"))
    starts = starts.join(starts.groupBy("source").agg(F.min("first").alias("base")), "source")
    if rest:
        starts = starts.join(tree_paths(by_source.filter(~F.col("source").isin(names))), "source", "left")
    else:
        starts = starts.withColumn("path", F.lit(None).cast("array<struct<level: int, right: boolean, own: bigint, all: bigint>>"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "ids"):
            out = [[] for _ in range(8)]
            for doc_id, source, n, k, first, path, blob in zip(*[batch.column(c).to_pylist() for c in ("doc_id", "source", "n", "queue", "first", "path", "ids")]):
                ids = np.frombuffer(blob, "<u2").astype("<u4") if len(blob) % 2 == 0 else np.frombuffer(blob, "<u4", offset=1)
                raw = memoryview(ids.tobytes())
                for begin, at, many in runs(first, n, path):
                    for start, length, w, offset in plan.cut(k, at, many):
                        start += begin
                        for column, value in zip(out, (doc_id, start, length, zlib.crc32(raw[4 * start : 4 * (start + length)]), n, w, offset, source)):
                            column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out[:7]] + [pa.array(out[7], pa.string())], [c.split()[0] for c in PIECES.split(", ")])

    placed = coded.join(starts, ["part", "source"]).select(
        "doc_id", "source", "n", "queue", (F.col("first") - F.col("base") + F.col("before")).alias("first"), "path", "ids"
    )
    return placed.mapInArrow(run, PIECES)


def pack_documents(docs: DataFrame, tokenizer_file: str, rank_file: str, pattern: str, window: int = WINDOW) -> DataFrame:
    """Pieces (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, source) of all documents."""
    return pack(materialize(tokenise(docs, tokenizer_file, rank_file, pattern)), window)
