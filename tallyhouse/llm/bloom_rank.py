"""Ranked lexical search over bit-sliced Bloom signatures, exact to the last rank.

Index.  Documents with about as many terms share a block.  A block is a bit matrix of hash rows by documents: a term that
a document holds sets ``HASHES`` bits of the document's column, and again under other hashes for each of ``LEVELS`` that
its number of occurrences reaches.  The AND of a term's rows is a bitmap of documents that contains all that hold the term,
and a few that don't; the AND for a level contains all that hold it so often.

Bounds.  For a block, a term adds its weight times the largest gain of the highest level whose bitmaps are set, as the
sum over levels of bitmap times step.  The sum over an item's terms is an upper bound of the score of every document.

Search.  The ``k`` documents of highest bound of each item are scored exactly from their texts; the k-th best score, or 1
where fewer have a score, is what an item's other documents must reach.  A second pass over the bitmaps lists every document
whose bound reaches it, and all of these are scored from their texts.  What is not listed has a bound below k found scores.

Items are taken in blocks of about ``TERMS_PER_BLOCK`` terms, so what a task holds of them is bounded; their number of
passes over the index grows with the items, not with the documents.  Document frequencies come with the index, of the
items' terms where there are at most ``VOCABULARY`` different ones, else of all terms, joined.

Defined results: null and empty texts, and those without a term, are no documents and no items (an item without a term or
without a scoring document has no rows); a text of any length is one column, in a block with fewer others; rows that repeat
an id are documents or items of their own, with ranks of their own; equal scores rank by doc_id, nulls first; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.llm.common import slices, stored, with_unique_id

HASHES = 3
LEVELS = (1, 2, 3, 4, 6, 8, 12, 16, 24, 32, 64)
BITS_PER_KEY = 20
BLOCK = 2_048
BLOCK_BITS = 1 << 26
FLUSH_KEYS = 4 << 20
FLUSH_DOCS = 16_384
TERMS_PER_BLOCK = 1 << 19
GROUP_TERMS = 4_096
VOCABULARY = 1 << 18
GAIN = 1_000_000  # no gain of a term reaches it
# ASCII letters and digits and all other bytes make terms; only A to Z are lower-cased.
TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
INDEX = "kind string, height int, docs array<long>, lengths array<long>, bits binary, term binary, n long"
ARROW_INDEX = pa.schema(
    [("kind", pa.string()), ("height", pa.int32()), ("docs", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())), ("bits", pa.binary()), ("term", pa.binary()), ("n", pa.int64())]
)


class Queries(NamedTuple):
    """A block of items: distinct weighted terms, and for each item its number and terms with repeats."""

    terms: list[bytes]
    weights: np.ndarray
    numbers: list[int]
    wanted: list[tuple[np.ndarray, np.ndarray]]


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(TERM_BYTES).split()


def weight(n: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))


def length_factor(lengths, n: int, total: int) -> np.ndarray:
    return np.array([75 + 25 * int(x) * n // total for x in lengths], np.int64)


def gain(tf: int, m):
    return (1_000_000_000 * tf) // (1000 * tf + 12 * m)


def term_hashes(terms) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, terms), np.uint64, len(terms))


def hash_rows(hashes: np.ndarray, level: int, height: int) -> np.ndarray:
    """The matrix rows of terms at a level, one column for each hash."""
    with np.errstate(over="ignore"):
        x = hashes + np.uint64(level * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
        x = (x ^ x >> np.uint64(32)) * np.uint64(0xD6E8FEB86659FD93)
        x ^= x >> np.uint64(32)
    low, high = x & np.uint64(0xFFFFFFFF), (x >> np.uint64(32)) | np.uint64(1)
    return ((low[:, None] + high[:, None] * np.arange(HASHES, dtype=np.uint64)) % np.uint64(height)).astype(np.int64)


def signature(columns: list[tuple[np.ndarray, np.ndarray]], height: int) -> np.ndarray:
    """Bit matrix, packed along the documents, of (term hashes, occurrences) by document."""
    bits = np.zeros((height, -(-len(columns) // 8) * 8), bool)
    for column, (hashes, tf) in enumerate(columns):
        for level, least in enumerate(LEVELS):
            some = hashes[tf >= least] if level else hashes
            if not len(some):
                break
            bits[hash_rows(some, level, height), column] = True
    return np.packbits(bits, axis=1)


def blocks_of(pending: list[tuple]) -> Iterator[dict]:
    """Index rows of (keys, doc, length, hashes, occurrences), documents of similar size together."""
    pending.sort(key=lambda d: (d[0], d[1]))
    end = len(pending)
    while end:
        height = max(64, -(-BITS_PER_KEY * pending[end - 1][0] // 64) * 64)
        start = max(0, end - max(1, min(BLOCK, BLOCK_BITS // height)))
        part = pending[start:end]
        bits = signature([(d[3], d[4]) for d in part], height)
        yield {"kind": "docs", "height": height, "docs": [d[1] for d in part], "lengths": [d[2] for d in part], "bits": bits.tobytes()}
        end = start


def build_index(docs: DataFrame, vocabulary: frozenset[bytes] | None) -> DataFrame:
    """Stored blocks, document frequencies by task (of ``vocabulary``, or of all terms), and totals by task.

    ``docs`` has _doc and text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequency, pending, keys, many, total = Counter(), [], 0, 0, 0
        for batch in slices(batches, "text"):
            for doc, text in zip(batch.column("_doc").to_pylist(), batch.column("text").to_pylist()):
                counts = Counter(terms_of(text))
                if not counts:
                    continue
                tf = np.fromiter(counts.values(), np.int64, len(counts))
                length = int(tf.sum())
                many, total = many + 1, total + length
                frequency.update(counts.keys() if vocabulary is None else vocabulary.intersection(counts))
                own = int(sum((tf >= least).sum() for least in LEVELS))
                pending.append((own, doc, length, term_hashes(counts), tf.astype(np.int32)))
                keys += own
            if keys > FLUSH_KEYS or len(pending) > FLUSH_DOCS:
                for row in blocks_of(pending):
                    yield pa.RecordBatch.from_pylist([row], ARROW_INDEX)
                pending, keys = [], 0
        for row in blocks_of(pending):
            yield pa.RecordBatch.from_pylist([row], ARROW_INDEX)
        rows = [{"kind": "docs total", "n": many}, {"kind": "terms total", "n": total}] if many else []
        rows += [{"kind": "term", "term": term, "n": n} for term, n in frequency.items()]
        for at in range(0, len(rows), 10_000):
            yield pa.RecordBatch.from_pylist(rows[at : at + 10_000], ARROW_INDEX)

    return stored(docs.select("_doc", "text").mapInArrow(run, INDEX))


def grouped(queries: Queries) -> list[tuple[np.ndarray, list[int]]]:
    """(term numbers, item places) of groups of items with at most ``GROUP_TERMS`` terms, one item at least."""
    out, used, members = [], set(), []
    for place, (which, _) in enumerate(queries.wanted):
        more = used.union(which.tolist())
        if members and len(more) > GROUP_TERMS:
            out.append((np.array(sorted(used)), members))
            more, members = set(which.tolist()), []
        used = more
        members = [*members, place]
    return [*out, (np.array(sorted(used), np.int64), members)] if members else out


def bounds(queries: Queries, hashes: np.ndarray, groups, height: int, bits: np.ndarray, m: np.ndarray) -> Iterator[tuple[list[int], np.ndarray]]:
    """(item places, item by document upper bounds) of one block."""
    most = [gain(LEVELS[k + 1] - 1, m) if k + 1 < len(LEVELS) else np.full(len(m), GAIN) for k in range(len(LEVELS))]
    steps = [b - a for a, b in zip([np.zeros(len(m), np.int64), *most], most)]
    for which, members in groups:
        held = np.zeros((len(which), len(m)), np.int64)
        there = np.arange(len(which))
        for level, step in enumerate(steps):
            rows = hash_rows(hashes[which[there]], level, height)
            bitmap = np.bitwise_and.reduce(bits[rows], axis=1)
            some = bitmap.any(1)
            there, bitmap = there[some], bitmap[some]
            if not len(there):
                break
            held[there] += np.unpackbits(bitmap, axis=1, count=len(m)) * step[None]
        held *= queries.weights[which][:, None]
        found = np.empty((len(members), len(m)), np.int64)
        for i, place in enumerate(members):
            mine, times = queries.wanted[place]
            found[i] = (held[np.searchsorted(which, mine)] * times[:, None]).sum(0)
        yield members, found


def _walk(index: DataFrame, queries: Queries, n: int, total: int, emit, schema: str) -> DataFrame:
    """``emit(places, docs, bounds)`` over all blocks; it returns record batches, at the end of a task as well (docs None)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, groups, state = term_hashes(queries.terms), grouped(queries), {}
        for batch in batches:
            for height, docs, lengths, bits in zip(*[batch.column(c) for c in ("height", "docs", "lengths", "bits")]):
                docs, height = np.array(docs.as_py(), np.int64), height.as_py()
                packed = np.frombuffer(bits.as_buffer(), np.uint8).reshape(height, -1)
                m = length_factor(lengths.as_py(), n, total)
                for places, found in bounds(queries, hashes, groups, height, packed, m):
                    yield from emit(state, places, docs, found)
        yield from emit(state, None, None, None)

    blocks = index.filter("kind = 'docs'").select("height", "docs", "lengths", "bits")
    return blocks.mapInArrow(run, schema)


def _pairs(items, docs, scores) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(items, pa.int64()), pa.array(docs, pa.int64()), pa.array(scores, pa.int64())], ["item", "_doc", "bound"])


def highest_bounds(index: DataFrame, queries: Queries, n: int, total: int, k: int) -> DataFrame:
    """(item, _doc, bound) of the k documents of highest bound of each item; a task sends k of each at most."""

    def emit(state, places, docs, found):
        if places is None:
            for place, (best, ids) in state.items():
                yield _pairs([queries.numbers[place]] * len(ids), ids, best)
            return
        for place, row in zip(places, found):
            near = np.argpartition(-row, k - 1)[:k] if len(row) > k else np.arange(len(row))
            near = near[row[near] > 0]
            best, ids = state.get(place, (np.empty(0, np.int64), np.empty(0, np.int64)))
            best, ids = np.concatenate([best, row[near]]), np.concatenate([ids, docs[near]])
            top = np.lexsort((ids, -best))[:k]
            state[place] = best[top], ids[top]

    each = _walk(index, queries, n, total, emit, "item long, _doc long, bound long")
    best = Window.partitionBy("item").orderBy(F.desc("bound"), "_doc")
    return each.withColumn("_place", F.row_number().over(best)).filter(F.col("_place") <= k).drop("_place")


def reaching(index: DataFrame, queries: Queries, n: int, total: int, least: dict[int, int]) -> DataFrame:
    """(item, _doc, bound) of every document whose bound reaches the item's least score."""

    def emit(state, places, docs, found):
        if places is not None:
            needed = np.array([least.get(queries.numbers[p], 1) for p in places], np.int64)
            i, j = np.nonzero(found >= needed[:, None])
            if len(i):
                yield _pairs(np.array(queries.numbers)[np.array(places)[i]], docs[j], found[i, j])

    return _walk(index, queries, n, total, emit, "item long, _doc long, bound long")


def exact_scores(pairs: DataFrame, docs: DataFrame, queries: Queries, n: int, total: int) -> DataFrame:
    """(item, _doc, doc_id, score) of the listed pairs with a score above 0, counted in the whole texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place_of = {number: place for place, number in enumerate(queries.numbers)}
        weights = queries.weights.tolist()
        for batch in slices(batches, "text"):
            rows = []
            for doc, doc_id, text, items in zip(*[batch.column(c).to_pylist() for c in ("_doc", "doc_id", "text", "items")]):
                counts = Counter(terms_of(text))
                m = 75 + 25 * sum(counts.values()) * n // total
                gains = {}
                for item in items:
                    score = 0
                    mine, times = queries.wanted[place_of[item]]
                    for t, repeats in zip(mine.tolist(), times.tolist()):
                        if t not in gains:
                            tf = counts.get(queries.terms[t], 0)
                            gains[t] = weights[t] * gain(tf, m) if tf else 0
                        score += repeats * gains[t]
                    if score > 0:
                        rows.append((item, doc, doc_id, score))
            columns = list(zip(*rows)) or [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["item", "_doc", "doc_id", "score"])

    # Stored, so that its true size decides whether the texts must be shuffled to meet it.
    wanted = stored(pairs.groupBy(F.col("_doc").alias("_wanted")).agg(F.collect_set("item").alias("items")))
    texts = docs.join(wanted, F.col("_doc") == F.col("_wanted")).select("_doc", "doc_id", "text", "items")
    return texts.mapInArrow(run, "item long, _doc long, doc_id long, score long")


def rank_documents(docs: DataFrame, items: DataFrame, k: int = 20, item_key: str = "item_id", item_text: str = "text") -> DataFrame:
    """item_id, rank, doc_id and score of the k best documents of each item; ``docs`` has doc_id and text."""
    spark = docs.sparkSession
    nothing = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found = [terms_of(text) for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("item"), batch.column("item_id"), pa.array(found, pa.list_(pa.binary()))], ["item", "item_id", "terms"])

    asked = items.select(
        F.monotonically_increasing_id().alias("item"),
        F.col(item_key).cast("long").alias("item_id"),
        F.coalesce(F.col(item_text).cast("binary"), F.lit(b"")).alias("text"),
    ).mapInArrow(split, "item long, item_id long, terms array<binary>")
    asked = stored(asked.filter(F.size("terms") > 0))
    n_terms = asked.agg(F.sum(F.size("terms"))).first()[0]
    if not n_terms:
        return nothing
    wanted = stored(asked.select(F.explode("terms").alias("term")).distinct())
    size = wanted.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("term")).alias("bytes")).first()
    small = size["n"] <= VOCABULARY and size["bytes"] <= VOCABULARY * 64
    vocabulary = frozenset(bytes(r["term"]) for r in wanted.collect()) if small else None

    numbered = with_unique_id(docs.select("doc_id", "text"))
    numbered = numbered.select("_doc", F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    numbered = numbered.filter(F.octet_length("text") > 0)
    index = build_index(numbered, vocabulary)
    totals = {r["kind"]: r["n"] for r in index.filter(F.col("kind").endswith("total")).groupBy("kind").agg(F.sum("n").alias("n")).collect()}
    if not totals:
        return nothing
    n, total = totals["docs total"], totals["terms total"]
    counted = index.filter("kind = 'term'").groupBy("term").agg(F.sum("n").alias("n"))
    frequency = stored(wanted.join(counted, "term"))

    blocks = -(-n_terms // TERMS_PER_BLOCK)
    found = None
    for block in range(blocks):
        part = asked.withColumn("_block", F.pmod(F.xxhash64("item"), F.lit(blocks))).filter(F.col("_block") == block)
        part_terms = part.select(F.explode("terms").alias("term")).distinct()
        df = {bytes(r["term"]): r["n"] for r in frequency.join(part_terms, "term", "left_semi").collect()}
        queries = make_queries([(r["item"], [bytes(t) for t in r["terms"]]) for r in part.collect()], df, n)
        if not queries.numbers:
            continue
        likely = exact_scores(highest_bounds(index, queries, n, total, k), numbered, queries, n, total)
        best = likely.groupBy("item").agg(F.count(F.lit(1)).alias("many"), F.min("score").alias("least"))
        least = {r["item"]: r["least"] for r in best.collect() if r["many"] >= k}
        scored = stored(exact_scores(reaching(index, queries, n, total, least), numbered, queries, n, total))
        found = scored if found is None else found.unionByName(scored)
    if found is None:
        return nothing
    order = Window.partitionBy("item").orderBy(F.desc("score"), "doc_id", "_doc")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.join(asked.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")


def make_queries(items: list[tuple[int, list[bytes]]], df: dict[bytes, int], n: int) -> Queries:
    """The items with a term that some document holds and that has a weight."""
    weights = {term: w for term, count in df.items() if (w := weight(n, count)) > 0}
    terms = sorted(weights)
    place = {term: i for i, term in enumerate(terms)}
    numbers, wanted = [], []
    for number, words in items:
        counts = sorted(Counter(place[w] for w in words if w in place).items())
        if counts:
            which, times = np.array(counts, np.int64).T
            numbers.append(number)
            wanted.append((which, times))
    return Queries(terms, np.array([weights[t] for t in terms], np.int64), numbers, wanted)
