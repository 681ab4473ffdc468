"""N-gram Jaccard join by a MinHash LSH forest with exact verification.

A text is the set of its runs of five words (one run of all words where there are fewer).  Texts with equal sets are
one node.  Every node has a MinHash signature of ``TREES`` x ``DEPTH`` values.  A tree of the forest is the trie of its
nodes' signatures, kept as sorted prefixes: nodes below one prefix stand side by side.

Matched prefixes start at full depth in all trees and lose one value in one tree after the other (``forest_depths``)
until the target recall is reached in two ways: by the links of a sample of texts to all texts, found exactly in the pass
that makes the signatures (``Gauge``), and by the chance that a pair just at the threshold shares a matched prefix.  The
second holds where the sample has few links or none.  Sample and chance only set how far prefixes are shortened.

Nodes that share a matched prefix are candidates.  They are gathered as components of the runs' stars, so a run of n
nodes costs n rows, not n^2; a run that is longer than a range partition is joined to its next part by one edge.  A
component is dealt into blocks of about ``BLOCK`` nodes by hash; every pair of blocks is verified in one task on the
exact sets of shingle hashes (64 bit).  Only counts of links and spanning links leave the task.  A component of any
size is spread over its pairs of blocks; no pair is dropped.

Result of ``near_duplicates``, one row per row of documents: doc_id, class_id (smallest doc_id of the connected class),
set_id (smallest doc_id with the same shingles), n_copies (rows with the same shingles, itself included) and n_links
(other texts, counted once for all copies, of similarity at least the threshold).

Defined results: null and blank texts have no shingles, are no one's near duplicate and are classes of their own; rows
with equal or null ids are documents of their own, in the order of their texts; an empty table gives an empty result;
extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import aside, components, forget, slices, stored, with_unique_id
from tallyhouse.session import literal_rows

WORDS = 5
THRESHOLD = 0.8
TREES, DEPTH = 16, 8
RECALL = 0.9997
GAUGE_TEXTS, GAUGE_BYTES = 512, 32 << 10  # texts of the recall sample, and the longest of them
BLOCK = 192
_MIX = np.uint64(0x9E3779B97F4A7C15)  # 2^64 divided by the golden ratio


def forest_depths(step: int, trees: int = TREES, depth: int = DEPTH) -> list[int]:
    """Length of the matched prefix in each tree after so many shortenings, one tree after the other."""
    return [max(1, depth - (step - t + trees - 1) // trees) for t in range(trees)]


def chance(similarity: float, depths: Sequence[int]) -> float:
    """Probability that a pair of this similarity shares a matched prefix."""
    return 1 - math.prod(1 - similarity**d for d in depths)


def shorten(found: dict[int, int], threshold: float = THRESHOLD, recall: float = RECALL) -> list[int]:
    """The first depths that reach the recall; ``found`` counts the sample's links by the step that finds them."""
    links, last = sum(found.values()), TREES * (DEPTH - 1)
    for step in range(last):
        depths = forest_depths(step)
        if sum(n for k, n in found.items() if k <= step) >= recall * links and chance(threshold, depths) >= recall:
            return depths
    return forest_depths(last)


def _scatter(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _MIX
    return x ^ (x >> np.uint64(29))


class Shingler:
    """Sorted distinct 64-bit hashes of the word runs of a text."""

    def __init__(self, words: int = WORDS, most: int = 400_000):
        self.words, self.most, self.known = words, most, {}

    def __call__(self, text: str) -> np.ndarray:
        known = self.known
        if len(known) > self.most:
            known.clear()
        words = text.split()
        for w in set(words):
            if w not in known:
                known[w] = xxhash.xxh3_64_intdigest(w.encode("utf-8", "surrogatepass"))
        codes = np.fromiter((known[w] for w in words), np.uint64, len(words))
        span = min(self.words, len(codes))
        if not span:
            return codes
        n = len(codes) - span + 1
        runs = np.full(n, np.uint64(span))
        for k in range(span):
            runs = _scatter(runs * _MIX + codes[k : k + n])
        return np.unique(runs)


class MinHash:
    def __init__(self, size: int = TREES * DEPTH, seed: int = 20):
        rng = np.random.default_rng(seed)
        self.factors = rng.integers(1, 2**63, size, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.shifts = rng.integers(0, 2**63, size, dtype=np.uint64)

    def __call__(self, shingles: np.ndarray) -> np.ndarray:
        best = np.full(len(self.factors), np.uint64(2**64 - 1))
        for at in range(0, len(shingles), 2048):
            part = shingles[at : at + 2048, None] * self.factors + self.shifts
            best = np.minimum(best, part.min(0))
        return (best >> np.uint64(32)).astype("<u4")


class Gauge:
    """Exact links of any text to the texts of a sample, as the shortening step at which the forest finds each."""

    def __init__(self, texts: Sequence[str], threshold: float):
        shingler, minhash = Shingler(), MinHash()
        sets = {s.tobytes(): s for s in map(shingler, texts) if len(s)}
        self.sets, self.threshold = [sets[name] for name in sorted(sets)], threshold
        self.sizes = np.array([len(s) for s in self.sets], np.int64)
        self.trees = np.array([minhash(s) for s in self.sets], "<u4").reshape(-1, TREES, DEPTH)
        values = np.concatenate([*self.sets, np.empty(0, np.uint64)])
        order = np.argsort(values, kind="stable")
        self.owners = np.repeat(np.arange(len(self.sets)), self.sizes)[order]
        self.values, self.starts = np.unique(values[order], return_index=True)
        self.starts = np.append(self.starts, len(values))
        del self.sets

    def __call__(self, shingles: np.ndarray, signature: np.ndarray) -> list[int]:
        at = np.searchsorted(self.values, shingles)
        inside = at < len(self.values)
        at = at[inside][self.values[at[inside]] == shingles[inside]]
        if not len(at):
            return []
        counts = self.starts[at + 1] - self.starts[at]
        places = np.repeat(self.starts[at] - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
        both = np.bincount(self.owners[places], minlength=len(self.sizes))
        union = self.sizes + len(shingles) - both
        like = np.flatnonzero((both >= self.threshold * union - 1e-9) & (both < union))
        if not len(like):
            return []
        shared = np.cumprod(self.trees[like] == signature.reshape(TREES, DEPTH), 2).sum(2)
        steps = np.where(shared == DEPTH, 0, (DEPTH - 1 - shared) * TREES + np.arange(TREES) + 1)
        return np.where(shared == 0, TREES * DEPTH, steps).min(1).tolist()


def gauge_of(docs: DataFrame, threshold: float = THRESHOLD, texts: int = GAUGE_TEXTS) -> Gauge:
    """A gauge of up to ``texts`` documents by a hash of their id, of at most ``GAUGE_BYTES`` each."""
    chosen = docs.select("_doc").orderBy(F.xxhash64("_doc"), "_doc").limit(texts)
    short = docs.select("_doc", "text").filter(F.octet_length("text") <= GAUGE_BYTES)
    return Gauge([r["text"] for r in short.join(F.broadcast(chosen), "_doc").select("text").collect()], threshold)


def signatures(docs: DataFrame, gauge: Gauge) -> DataFrame:
    """(_doc, doc_id, a, b, n, sig, steps): name and size of the shingle set, signature, links to the gauge's texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, minhash = Shingler(), MinHash()
        for batch in slices(batches, "text"):
            a, b, n, sig, steps = [], [], [], [], []
            for text in batch.column("text").to_pylist():
                s = shingler(text or "")
                name = xxhash.xxh3_128_digest(s.tobytes())
                a.append(int.from_bytes(name[:8], "little", signed=True))
                b.append(int.from_bytes(name[8:], "little", signed=True))
                n.append(len(s))
                values = minhash(s) if len(s) else None
                sig.append(None if values is None else values.tobytes())
                steps.append([] if values is None else gauge(s, values))
            yield pa.RecordBatch.from_arrays(
                [batch.column("_doc"), batch.column("doc_id"), pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(n, pa.int64()), pa.array(sig, pa.binary()), pa.array(steps, pa.list_(pa.int32()))],
                ["_doc", "doc_id", "a", "b", "n", "sig", "steps"],
            )

    rows = docs.select("_doc", F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, "_doc long, doc_id long, a long, b long, n long, sig binary, steps array<int>")


def _alike(tree: np.ndarray, prefix: np.ndarray, depths: np.ndarray) -> np.ndarray:
    """Whether each row but the first shares its tree's matched prefix with the row before it."""
    shared = np.cumprod(prefix[1:] == prefix[:-1], 1).sum(1)
    return (tree[1:] == tree[:-1]) & (shared >= depths[tree[1:]])


def _candidate_edges(nodes: DataFrame, depths: Sequence[int]) -> DataFrame:
    """(node, low): stars of the nodes that share a matched prefix in a tree.

    The tries are one range sort by (tree, prefix, node), so a crowded prefix is spread over tasks.  A task joins the
    nodes of a run to the smallest one it holds; its first and last run are handed over (two rows a task) and joined to
    their neighbours.
    """
    width, lengths = max(depths), np.array(depths)
    spelled = F.expr(f"transform(sequence(0, {TREES - 1}), t -> struct(t AS tree, substring(sig, t * {4 * DEPTH} + 1, {4 * width}) AS prefix))")
    order = ["tree", "prefix", "node"]
    tries = nodes.select("node", F.inline(spelled)).repartitionByRange(*order).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(end, node, low, tree, prefix):
            task = TaskContext.get().partitionId()
            n = len(node)
            return pa.RecordBatch.from_arrays(
                [pa.array([end] * n, pa.int32()), pa.array(node, pa.int64()), pa.array(low, pa.int64()), pa.array([task] * n, pa.int32()), pa.array(tree, pa.int32()), pa.array(prefix, pa.binary())],
                ["end", "node", "low", "task", "tree", "prefix"],
            )

        last = None  # tree, prefix and smallest node of the run that is open
        for batch in batches:
            if not batch.num_rows:
                continue
            tree, node = batch.column("tree").to_numpy(), batch.column("node").to_numpy()
            prefix = np.frombuffer(b"".join(batch.column("prefix").to_pylist()), "<u4").reshape(-1, width)
            starts = np.concatenate([[True], ~_alike(tree, prefix, lengths)])
            low = np.minimum.reduceat(node, np.flatnonzero(starts))
            if last is None:
                yield rows(0, node[:1], low[:1], tree[:1], [prefix[0].tobytes()])
            elif _alike(np.array([last[0], tree[0]]), np.stack([last[1], prefix[0]]), lengths)[0]:
                yield rows(-1, [last[2]], low[:1], [None], [None])
                low[0] = min(low[0], last[2])
            smallest = low[np.cumsum(starts) - 1]
            joined = node != smallest
            yield rows(-1, node[joined], smallest[joined], [None] * int(joined.sum()), [None] * int(joined.sum()))
            last = (tree[-1], prefix[-1].copy(), low[-1])
        if last is not None:
            yield rows(1, [last[2]], [last[2]], [last[0]], [last[1].tobytes()])

    found = stored(tries.mapInArrow(run, "end int, node long, low long, task int, tree int, prefix binary"))
    # At most two rows a task, in the order of the ranges: first and last run of every task that had rows.
    ends = sorted(found.filter("end >= 0").drop("node").collect(), key=lambda r: (r["task"], r["end"]))
    over = []
    for one, two in zip(ends[1::2], ends[2::2]):
        tree = np.array([one["tree"], two["tree"]])
        prefix = np.frombuffer(bytes(one["prefix"]) + bytes(two["prefix"]), "<u4").reshape(2, width)
        if one["low"] != two["low"] and _alike(tree, prefix, lengths)[0]:
            over.append((two["low"], one["low"]))
    edges = found.filter("end < 0 AND node <> low").select("node", "low")
    return edges.union(literal_rows(nodes.sparkSession, over, "node long, low long")) if over else edges


def _verify(threshold: float):
    """Links and spanning links between the nodes of two blocks, or within one."""

    def run(group: pa.Table) -> pa.Table:
        lo, hi = group.column("lo")[0].as_py(), group.column("hi")[0].as_py()
        node = group.column("node").to_numpy()
        side = group.column("block").to_numpy()
        sets = [np.frombuffer(x, np.uint64) for x in group.column("shingles").to_pylist()]
        sizes = np.array([len(s) for s in sets])
        _, ids = np.unique(np.concatenate(sets), return_inverse=True)
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        mark = np.zeros(int(ids.max()) + 1, np.int32)
        links, root = np.zeros(len(node), np.int64), np.arange(len(node))

        def top(i):
            while root[i] != i:
                root[i] = root[root[i]]
                i = root[i]
            return i

        for i in np.flatnonzero(side == lo):
            own = ids[starts[i] : starts[i] + sizes[i]]
            mark[own] = 1
            both = np.add.reduceat(mark[ids], starts)
            mark[own] = 0
            like = both >= threshold * (sizes + sizes[i] - both) - 1e-9
            like &= (side == hi) & (node != node[i])
            if lo == hi:
                like &= node > node[i]
            found = np.flatnonzero(like)
            links[i] += len(found)
            links[found] += 1
            for j in found:
                x, y = top(i), top(j)
                if x != y:
                    root[max(x, y, key=lambda k: node[k])] = min(x, y, key=lambda k: node[k])
        used = np.flatnonzero(links)
        ends = node[[top(i) for i in used]] if len(used) else node[:0]
        return pa.table({"node": pa.array(node[used], pa.int64()), "links": pa.array(links[used], pa.int64()), "low": pa.array(ends, pa.int64())})

    return run


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL, block: int = BLOCK) -> DataFrame:
    """Class, copies and links of every row of ``docs`` (doc_id, text); ``_doc`` is kept for joining back."""
    docs = docs if "_doc" in docs.columns else with_unique_id(docs.select("doc_id", "text"))
    rows = stored(signatures(docs, gauge_of(docs, threshold)))
    nodes = rows.filter("n > 0").groupBy("a", "b").agg(F.min("_doc").alias("node"), F.min("doc_id").alias("set_id"), F.count(F.lit(1)).alias("n_copies"))
    nodes = stored(nodes)
    own = rows.join(nodes.select("node"), F.col("_doc") == F.col("node"))
    # One row for each of the few shortening steps.
    found = own.select(F.explode("steps").alias("step")).groupBy("step").count().collect()
    depths = shorten({r["step"]: r["count"] for r in found}, threshold, recall)
    edges = _candidate_edges(own.select("node", "sig"), depths)
    groups = components(edges, "node", "low")

    sizes = groups.groupBy("root").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks"))
    dealt = groups.join(sizes, "root").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))

    def shingle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler()
        for batch in slices(batches, "text"):
            sets = pa.array([shingler(t).tobytes() for t in batch.column("text").to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in ("node", "root", "blocks", "block")] + [sets], ["node", "root", "blocks", "block", "shingles"])

    # Texts are dealt by id whatever the size of the other side, so that the plan is the same at every size.
    texts = docs.select("_doc", "text").join(dealt.hint("merge"), F.col("_doc") == F.col("node")).drop("_doc")
    sets = stored(texts.select("node", "root", "blocks", "block", "text").mapInArrow(shingle, "node long, root long, blocks int, block int, shingles binary"))
    pairs = sets.select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")).select(
        "root", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "node", "block", "shingles"
    )
    verified = stored(pairs.groupBy("root", "lo", "hi").applyInArrow(_verify(threshold), "node long, links long, low long"))
    links = verified.groupBy("node").agg(F.sum("links").alias("n_links"))
    roots = components(verified, "node", "low")
    classes = nodes.join(links, "node", "left").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    smallest = classes.groupBy("root").agg(F.min("set_id").alias("class_id"), F.min("node").alias("first"))
    classes = stored(classes.join(smallest, "root").select("a", "b", "set_id", "n_copies", F.coalesce("n_links", F.lit(0)).alias("n_links"), "class_id", "first"))
    for old in (edges, sets):
        forget(old)
    joined = rows.select("_doc", "doc_id", "a", "b", "n").join(classes, ["a", "b"], "left")
    bare = F.col("n") == 0
    return joined.select(
        "_doc",
        "doc_id",
        F.when(bare, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.when(bare, F.col("doc_id")).otherwise(F.col("set_id")).alias("set_id"),
        F.when(bare, F.lit(1)).otherwise(F.col("n_copies")).cast("long").alias("n_copies"),
        F.when(bare, F.lit(0)).otherwise(F.col("n_links")).cast("long").alias("n_links"),
        (bare | (F.col("_doc") == F.col("first"))).alias("stays"),
    )


def one_of_each(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents without those that belong to the class of an earlier one; columns as they came."""
    plain, back = aside(docs, ("_doc",))
    named = with_unique_id(plain)
    gone = near_duplicates(named, threshold).filter(~F.col("stays")).select("_doc")
    kept = named.join(gone, "_doc", "left_anti").drop("_doc")
    return kept.withColumnsRenamed(back)
