"""Suffix-array dedup: which bytes lie in a string of ``length`` bytes that also starts earlier.

Prefix doubling over all documents.  The name of 2h bytes at a position is that of the pair of its h-byte names at
offset h; below half the length the pairs are inside a task and names are 64-bit fingerprints.  Beyond, Spark sorts
(rank, next rank, position) and a scan reranks: positions with a unique rank drop out, those that repeat an earlier
position past the threshold are decided, the rest goes to the next round.

Round one is sparse.  Every string of ``length`` bytes has one anchor, its least 48-byte name (the leftmost of equals).
Both depend on the string alone, so equal strings have equal anchors at equal places.  Neighbouring strings share their
anchor; such a run of starts is one row (rank: name of the anchor, next rank: name of all bytes of the run).  Anchors
seen once are unique.  Equal runs after the first one repeat it in full.  What is left are runs whose anchor occurs in
other surroundings, that is, the edges of repeated passages.  Round two is dense: every start in those runs, sorted by
its names at offsets 0 and length/2.

Both sorts are range partitioned by (rank, next rank, document, start), so a name that a third of all rows share is
spread over tasks.  A partition is scanned as a stream; one small row of each tells the driver how it begins and ends.
Two different strings are taken for equal if 64-bit names collide within one rank (below 1e-7 for a million equal
anchors).  Tables between the rounds are stored in the shared folder.

Defined results: a null text has no bytes; documents are ordered by doc_id, nulls first, rows with equal ids by their
texts, and equal rows are copies of each other; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import aside, forget, slices, stored, with_unique_id
from tallyhouse.session import literal_rows

LENGTH = 100
ANCHOR = 48  # longer ones repeat by chance less often, shorter ones are fewer
PIECE_BYTES = 1 << 16  # of text named at once: its arrays of 64-bit names stay in the processor's cache
_ODD = np.uint64(0x9E3779B97F4A7C15)  # 2^64 divided by the golden ratio
_LOW = np.uint64(0xFFFFFFFF)
ROW = "rank long, next long, doc long, start long, n int"


def _pair(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    x = left * _ODD + right
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def names(data: np.ndarray, length: int) -> np.ndarray:
    """The name of the ``length`` bytes at each position: doubled from single bytes, overlapping in the last step."""
    one = (data.astype(np.uint64) + np.uint64(1)) * _ODD
    if length == 1 or len(one) < length:
        return one[: max(0, len(one) - length + 1)]
    now, h = one, 1
    while 2 * h <= length:
        now, h = _pair(now[: len(now) - h], now[h:]), 2 * h
    if h < length:
        now = _pair(now[: len(now) - (length - h)], now[length - h :])
    return now


def _joined(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of several texts in a row, and where each starts and the last one ends."""
    parts = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    bounds = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)
    return np.frombuffer(b"".join(parts), np.uint8), bounds


def anchor_runs(data: np.ndarray, bounds: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """(document index, start, n, rank, next) of the runs of string starts that share an anchor."""
    anchor = max(1, min(ANCHOR, length // 2))
    width = length - anchor + 1  # anchors in a string
    total = len(data) - length + 1
    if total <= 0:
        return tuple(np.empty(0, np.int64) for _ in range(5))
    small = names(data, anchor)
    best = (small & ~_LOW) | np.arange(len(small), dtype=np.uint64)
    step = 1
    while 2 * step <= width:
        best, step = np.minimum(best[: len(best) - step], best[step:]), 2 * step
    best = np.minimum(best[:total], best[width - step : width - step + total])
    at = (best & _LOW).astype(np.int64)
    doc = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))[:total]
    inside = np.arange(total) + length <= bounds[doc + 1]
    new = inside.copy()
    new[1:] &= (at[1:] != at[:-1]) | (doc[1:] != doc[:-1]) | ~inside[:-1]
    begin = np.flatnonzero(new)
    stop = np.flatnonzero(inside & np.append(~inside[1:] | new[1:], True))
    h = (length + 1) // 2
    half = names(data, h)
    whole = _pair(half[:total], half[length - h :][:total])
    n = stop - begin + 1
    around = _pair(_pair(whole[begin], whole[stop]), (n * (4 * length) + at[begin] - begin).astype(np.uint64))
    return doc[begin], begin - bounds[doc[begin]], n, small[at[begin]].view(np.int64), around.view(np.int64)


def rerank(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Sort by (rank, next, doc, start) and scan: (decided, undecided) rows as (rank, doc, start, n).

    Decided rows equal an earlier row in rank and next rank.  Undecided ones are the first of theirs, but share the
    rank with another.  All other rows have no equal and drop out.
    """
    order = ["rank", "next", "doc", "start"]
    fields = [("kind", pa.int8()), ("part", pa.int32()), ("flag", pa.bool_()), ("rank", pa.int64()), ("next", pa.int64()), ("doc", pa.int64()), ("start", pa.int64()), ("n", pa.int32())]
    schema = pa.schema(fields)
    DECIDED, UNDECIDED, FIRST, PENDING, LAST = range(5)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()

        def out(kind, columns, flag=False):
            m = len(columns[0])
            return pa.RecordBatch.from_arrays([pa.array(np.full(m, kind, np.int8)), pa.array(np.full(m, part, np.int32)), pa.array(np.full(m, flag))] + [pa.array(c, t) for c, (_, t) in zip(columns, fields[3:])], schema=schema)

        first = pending = last = None  # first row; first row of the latest rank while it may be alone; (rank, next)
        first_shared = False
        for batch in batches:
            if not batch.num_rows:
                continue
            c = [batch.column(k).to_numpy() for k in range(5)]
            rank, nxt = c[0], c[1]
            before = (rank[0] - 1, nxt[0]) if last is None else last
            same_rank = np.concatenate([[rank[0] == before[0]], rank[1:] == rank[:-1]]) if last is not None else np.concatenate([[False], rank[1:] == rank[:-1]])
            same = same_rank & np.concatenate([[nxt[0] == before[1]], nxt[1:] == nxt[:-1]])
            if same.any():
                yield out(DECIDED, [x[same] for x in c])
            heads = np.flatnonzero(~same)  # one for each (rank, next)
            leads = ~same_rank[heads]  # first of its rank
            followed = np.append(~leads[1:], False)  # another head of the same rank comes next
            if len(heads) and not leads[0]:  # a further head of the rank that was open
                if pending is not None:
                    yield out(UNDECIDED, [np.array([x]) for x in pending])
                    pending = None
                elif first is not None and last[0] == first[0]:
                    first_shared = True
            if first is None:
                first = [x[0] for x in c]
                first_shared = bool(followed[0])
                mine = np.arange(len(heads)) > 0
            else:
                mine = np.ones(len(heads), bool)
            send = heads[mine & (~leads | followed)]
            if len(send):
                yield out(UNDECIDED, [x[send] for x in c])
            if leads.any():
                k = np.flatnonzero(leads)[-1]
                alone = k == len(heads) - 1 and mine[k]
                pending = [x[heads[k]] for x in c] if alone else None
            last = (rank[-1], nxt[-1])
        if first is not None:
            yield out(FIRST, [np.array([x]) for x in first], first_shared)
            if pending is not None:
                yield out(PENDING, [np.array([x]) for x in pending])
            yield out(LAST, [np.array([x]) for x in (last[0], last[1], 0, 0, 0)])

    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("rank", "next", "doc", "start", "n")
    scanned = stored(ordered.mapInArrow(scan, "kind byte, part int, flag boolean, " + ROW))
    # At most three rows for each range partition.
    edges: dict[int, dict] = {}
    for r in scanned.filter(F.col("kind") >= FIRST).collect():
        edges.setdefault(r["part"], {})[r["kind"]] = r
    decided, undecided, open_rank, open_next, waiting = [], [], None, None, None
    for _, edge in sorted(edges.items()):
        row, last = edge[FIRST], edge[LAST]
        plain = [row["rank"], row["doc"], row["start"], row["n"]]
        if open_rank is not None and row["rank"] == open_rank:
            equal = row["next"] == open_next
            if waiting and (row["flag"] or not equal):
                undecided.append(waiting)
                waiting = None
            (decided if equal else undecided).append(plain)
        else:
            waiting = plain
            if row["flag"]:
                undecided.append(plain)
                waiting = None
        if last["rank"] != row["rank"]:
            lone = edge.get(PENDING)
            waiting = [lone["rank"], lone["doc"], lone["start"], lone["n"]] if lone else None
        open_rank, open_next = last["rank"], last["next"]
    kept = "rank long, doc long, start long, n int"
    columns = ["rank", "doc", "start", "n"]
    return tuple(
        scanned.filter(F.col("kind") == kind).select(*columns).unionByName(literal_rows(rows.sparkSession, more, kept))
        for kind, more in ((DECIDED, decided), (UNDECIDED, undecided))
    )


def _dense(length: int):
    """Every start of the undecided runs, named at offset 0 and at half the length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", PIECE_BYTES):
            data, bounds = _joined(batch.column("text").to_pylist())
            h = (length + 1) // 2
            half = names(data, h)
            ends, start, n = _flat(batch.column("runs"))
            doc = np.repeat(np.arange(batch.num_rows), np.diff(ends))
            offset = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(start, n)
            doc = np.repeat(doc, n)
            where = bounds[doc] + offset
            yield pa.RecordBatch.from_arrays(
                [pa.array(half[where].view(np.int64)), pa.array(half[where + length - h].view(np.int64)), pa.array(batch.column("_doc").to_numpy()[doc], pa.int64()), pa.array(offset, pa.int64()), pa.array(np.ones(len(where), np.int32))],
                ["rank", "next", "doc", "start", "n"],
            )

    return run


def _sparse(length: int):
    """The runs of starts that share an anchor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", PIECE_BYTES):
            data, bounds = _joined(batch.column("text").to_pylist())
            doc, start, n, rank, around = anchor_runs(data, bounds, length)
            yield pa.RecordBatch.from_arrays(
                [pa.array(rank, pa.int64()), pa.array(around, pa.int64()), pa.array(batch.column("_doc").to_numpy()[doc], pa.int64()), pa.array(start, pa.int64()), pa.array(n, pa.int32())],
                ["rank", "next", "doc", "start", "n"],
            )

    return run


def repeated_runs(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(doc, start, n): runs of starts of strings that also start earlier; ``docs`` has ``_doc`` and ``text``."""
    assert length >= 2
    anchors = stored(docs.select("_doc", "text").mapInArrow(_sparse(length), ROW))
    decided, undecided = rerank(anchors)
    forget(anchors)
    runs = undecided.groupBy("doc").agg(F.collect_list(F.struct("start", "n")).alias("runs"))  # bounded by the document
    texts = docs.select("_doc", "text").join(runs, F.col("_doc") == F.col("doc")).select("_doc", "text", "runs")
    # Not stored: the range partitioner's sample costs a second naming, which is cheaper than the table.
    repeated, _ = rerank(texts.mapInArrow(_dense(length), ROW))
    return decided.unionByName(repeated).select("doc", "start", "n")


def _flat(runs: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ends, start, n): row k has the runs from ends[k] to ends[k + 1], none if it is null.

    A document of a thousand bytes may have as many runs, each of them a few hundred bytes as a Python object.
    """
    flat = runs.flatten()
    sizes = pc.fill_null(pc.list_value_length(runs), 0).to_numpy(zero_copy_only=False)
    start, n = (flat.field(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in (0, 1))
    return np.append(0, np.cumsum(sizes)).astype(np.int64), start, n


def spans(start: np.ndarray, n: np.ndarray, length: int) -> list[tuple[int, int]]:
    """Sorted, disjoint (from, to) of the bytes under the strings of all runs; touching ones are one."""
    if not len(start):
        return []
    order = np.argsort(start, kind="stable")
    begin, end = start[order], np.maximum.accumulate((start + n)[order] - 1 + length)
    new = np.flatnonzero(begin[1:] > end[:-1])
    return list(zip(begin[np.append(0, new + 1)].tolist(), end[np.append(new, len(end) - 1)].tolist()))


def cuts(batch: pa.RecordBatch, length: int) -> Iterator[tuple[str | None, list[tuple[int, int]]]]:
    """The text of each row and the spans of its ``_runs``."""
    ends, start, n = _flat(batch.column("_runs"))
    for k, text in enumerate(batch.column("text")):
        yield text.as_py(), spans(start[ends[k] : ends[k + 1]], n[ends[k] : ends[k + 1]], length)


def without(data: bytes, gone: list[tuple[int, int]]) -> bytes:
    kept, at = [], 0
    for a, b in gone:
        kept.append(data[at:a])
        at = b
    return b"".join([*kept, data[at:]])


def _with_runs(docs: DataFrame, length: int) -> DataFrame:
    """Documents with ``_doc`` and the list ``_runs`` (null: none)."""
    named = docs if "_doc" in docs.columns else with_unique_id(docs)
    runs = repeated_runs(named, length).groupBy("doc").agg(F.collect_list(F.struct("start", "n")).alias("_runs"))
    runs = runs.withColumnRenamed("doc", "_run_doc")
    return named.join(runs, F.col("_doc") == F.col("_run_doc"), "left").drop("_run_doc")


def repeat_digest(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            rows = []
            for text, gone in cuts(batch, length):
                data = (text or "").encode("utf-8", "surrogatepass")
                rows.append((len(data), sum(b - a for a, b in gone), len(gone), hashlib.sha256(without(data, gone)).hexdigest()))
            columns = [pa.array(x, t) for x, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.int64(), pa.string()))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    found = _with_runs(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), length).select("doc_id", "text", "_runs")
    return found.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def drop_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """The documents without their repeated bytes; a character that loses a byte goes as a whole.

    All documents and columns stay; ``n_chars``, where there is one, is that of the new text, and a null text stays.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            texts = []
            for text, gone in cuts(batch, length):
                if text is not None and gone:
                    text = without(text.encode("utf-8", "surrogatepass"), gone).decode("utf-8", "ignore")
                texts.append(text)
            columns = [pa.array(texts, pa.string()) if c == "text" else batch.column(c) for c in columns_in]
            yield pa.RecordBatch.from_arrays(columns, columns_in)

    plain, back = aside(docs, ("_doc", "_runs", "_run_doc"))
    columns_in = plain.columns
    found = _with_runs(plain, length).select(*plain.columns, "_runs")
    out = found.mapInArrow(run, plain.schema)
    if "n_chars" in out.columns:
        kind = plain.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text")).cast(kind))
    return out.withColumnsRenamed(back)
