"""Approximate nearest neighbours by an adaptive dimension scan inside probed lists.

Index: vectors of one length get one more coordinate, sqrt(M^2 - |x|^2) with M the largest norm, so that the largest
inner product is the smallest distance.  A bounded, documented sample (``SAMPLE``) gives the centroids; every vector is
put into the list of its nearest one.  How many of its nearest lists a query probes is measured on the same sample: the
fewest that reach ``RECALL`` there.  Clustered vectors need few; vectors without any structure need nearly half.

Scan: vectors of a list and the queries that probe it are rotated by one random orthogonal matrix and read in column
blocks of ``COLUMNS``.  After d of D columns the distance is estimated as D/d times the partial one; a candidate is
abandoned as soon as the hypothesis that it belongs to the k nearest found so far is rejected, that is when
partial * D/d > bound * (1 + EPSILON / sqrt(d))^2.  What survives all blocks is ranked by its exact inner product.

Near lists share a cell, so a query is sent once to a cell with the lists it probes there.  Both sides of a cell are
dealt into blocks by hash, by their counted sizes, so a cell that holds a third of all vectors (equal vectors share a
list) or of all queries is many tasks.  A task keeps k per query and the rest is a top-k over these.  The driver sees
the sample and counts by list, at most ``LISTS`` rows.

Defined results: vectors that are null, zero, hold a null or a non-finite component, have no id, or are not of the most
frequent length (the shorter of equals) take no part; a query never finds rows of its own id; equal scores rank by the
smaller id; with fewer than k candidates all are returned; repeated ids are candidates each and one query, with
the smallest of their vectors; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.llm.common import stored

SAMPLE = 20_000
LISTS = 1_024
ROWS_PER_LIST = 64
RECALL = 0.96
CALIBRATION = 256
BASE_BLOCK, QUERY_BLOCK = 4_096, 512
CHUNK = 256
COLUMNS = 16
DENSE = 16  # share of surviving pairs, one in so many, from which a column block is computed for all pairs at once
EPSILON = 2.1
FOUND = "query_id long, vec_id long, score double"


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """(vec_id, v array<double>, norm2) of the vectors that take part."""
    v = F.col(vector).cast("array<double>")
    whole = vectors.select(F.col(key).cast("long").alias("vec_id"), v.alias("v")).filter(
        F.col("vec_id").isNotNull()
        & F.col("v").isNotNull()
        & ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
        & F.exists("v", lambda x: x != 0)
    )
    sizes = whole.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return whole.filter(F.size("v") == (sizes["d"] if sizes else 0)).withColumn(
        "norm2", F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    )


def closest(points: np.ndarray, means: np.ndarray, step: int = 2_048) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centroid of each point, and the squared distance less the point's own square."""
    own, best = np.empty(len(points), np.int64), np.empty(len(points))
    for at in range(0, len(points), step):
        distance = (means**2).sum(1)[None] - 2 * points[at : at + step] @ means.T
        own[at : at + step] = distance.argmin(1)
        best[at : at + step] = distance.min(1)
    return own, best


def centroids(sample: np.ndarray, lists: int, rounds: int = 12, seed: int = 3) -> np.ndarray:
    """Lloyd's rounds from random rows; an empty list takes the row farthest from its centroid."""
    rng = np.random.default_rng(seed)
    means = sample[rng.permutation(len(sample))[:lists]].copy()
    for _ in range(rounds):
        own, distance = closest(sample, means)
        size = np.bincount(own, minlength=len(means))
        sums = np.stack([np.bincount(own, sample[:, k], len(means)) for k in range(sample.shape[1])], 1)
        means = np.where(size[:, None] > 0, sums / np.maximum(size, 1)[:, None], means)
        empty = np.flatnonzero(size == 0)
        if len(empty):
            means[empty] = sample[np.argsort(-(distance + (sample**2).sum(1)), kind="stable")[: len(empty)]]
    return means


def rotation(size: int, seed: int = 5) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(seed).normal(size=(size, size)))
    return q * np.sign(np.diag(r))


def _rows(column) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(len(flat), -1)


def _raised(v: np.ndarray, top2: float, query: bool) -> np.ndarray:
    extra = np.zeros(len(v)) if query else np.sqrt(np.maximum(0.0, top2 - (v**2).sum(1)))
    return np.concatenate([v, extra[:, None]], 1)


def _squares(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of two column blocks."""
    return ((x**2).sum(1)[:, None] + (y**2).sum(1)[None] - 2 * x @ y.T).clip(0)


def probes_needed(points: np.ndarray, means: np.ndarray, k: int, recall: float, asked: int = CALIBRATION) -> int:
    """The fewest nearest lists that hold ``recall`` of the k nearest sample points of ``asked`` sample points."""
    own, _ = closest(points, means)
    some = points[:asked].copy()
    some[:, -1] = 0.0  # as queries are raised
    distance = (points**2).sum(1)[None] - 2 * some @ points.T
    distance[np.arange(len(some)), np.arange(len(some))] = np.inf
    near = np.argsort(distance, 1, kind="stable")[:, : min(k, len(points) - 1)]
    rank = ((means**2).sum(1)[None] - 2 * some @ means.T).argsort(1, kind="stable").argsort(1, kind="stable")
    needed = np.sort(np.take_along_axis(rank, own[near], 1).ravel())
    return int(needed[min(len(needed) - 1, int(np.ceil(recall * len(needed))))]) + 1 if len(needed) else len(means)


def scan(base_id, base, base_list, query_id, query, probed, turn: np.ndarray, top2: float, k: int, columns: int = COLUMNS, epsilon: float = EPSILON):
    """(query index, id, score) of up to k best rows of ``base`` in the lists that each query probes.

    ``probed`` is a boolean matrix, query by list number; ``base_list`` holds the rows' list numbers.
    """
    order = np.argsort(base_list, kind="stable")
    base_id, base, base_list = base_id[order], base[order], base_list[order]
    size = turn.shape[0]
    b, q = _raised(base, top2, False) @ turn, _raised(query, top2, True) @ turn
    bound = np.full(len(q), np.inf)
    best_score = np.full((len(q), k), -np.inf)
    best_id = np.full((len(q), k), np.iinfo(np.int64).max)
    for at in range(0, len(b), CHUNK):
        part, ids, exact = b[at : at + CHUNK], base_id[at : at + CHUNK], base[at : at + CHUNK]
        d = min(columns, size)
        near = _squares(q[:, :d], part[:, :d])
        qi, bi = np.nonzero((near * (size / d) <= bound[:, None] * (1 + epsilon / d**0.5) ** 2 + 1e-12) & (query_id[:, None] != ids[None]) & probed[:, base_list[at : at + CHUNK]])
        partial = near[qi, bi]
        while d < size and len(qi):
            e = min(d + columns, size)
            if len(qi) * DENSE > near.size:  # many pairs are left: one product of the blocks is cheaper than their rows
                partial = partial + _squares(q[:, d:e], part[:, d:e])[qi, bi]
            else:
                partial = partial + ((q[qi, d:e] - part[bi, d:e]) ** 2).sum(1)
            d = e
            slack = (1 + epsilon / d**0.5) ** 2 if d < size else 1 + 1e-9
            stay = partial * (size / d) <= bound[qi] * slack + 1e-12
            qi, bi, partial = qi[stay], bi[stay], partial[stay]
        if not len(qi):
            continue
        score = (query[qi] * exact[bi]).sum(1)
        touched, where = np.unique(qi, return_inverse=True)
        row = np.concatenate([np.repeat(np.arange(len(touched)), k), where])
        s = np.concatenate([best_score[touched].ravel(), score])
        i = np.concatenate([best_id[touched].ravel(), ids[bi]])
        order = np.lexsort((i, -s, row))
        place = np.arange(len(order)) - np.searchsorted(row[order], row[order])
        top = order[place < k]
        best_score[touched], best_id[touched] = s[top].reshape(-1, k), i[top].reshape(-1, k)
        bound[touched] = np.maximum(0.0, (query[touched] ** 2).sum(1) + top2 - 2 * best_score[touched, -1])
    qi, place = np.nonzero(best_score > -np.inf)
    return qi, best_id[qi, place], best_score[qi, place]


def nearest(vectors: DataFrame, key: str, vector: str, is_query: Column, k: int = 20, recall: float = RECALL, sample: int = SAMPLE) -> DataFrame:
    """query_id, rank, vec_id and score of the k nearest found of each query; ``is_query`` is on ``vec_id``."""
    spark = vectors.sparkSession
    rows = stored(usable(vectors, key, vector))
    total, top2 = rows.agg(F.count(F.lit(1)), F.max("norm2")).first()
    if not total:
        return spark.range(0).select(*[F.lit(None).cast(t).alias(c) for c, t in (("query_id", "long"), ("rank", "int"), ("vec_id", "long"), ("score", "double"))])
    # At most ``sample`` rows, chosen by a hash of the id.
    learned = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).select("v").toArrow()
    points = _raised(_rows(learned.column("v")), top2, False)
    means, turn = centroids(points, max(1, min(LISTS, total // ROWS_PER_LIST, len(points)))), rotation(points.shape[1])
    probes = probes_needed(points, means, k, recall)
    hubs = centroids(means, max(1, min(len(means), total // BASE_BLOCK)))
    cell_of, _ = closest(means, hubs)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                v = _raised(_rows(batch.column("v")), top2, False)
                own, _ = closest(v, means)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell_of[own].astype(np.int32)), pa.array(own[:, None].astype(np.int32).tolist(), pa.list_(pa.int32()))], ["vec_id", "v", "cell", "lists"])

    fields = "vec_id long, v array<double>, cell int, lists array<int>"
    placed = stored(rows.select("vec_id", "v").mapInArrow(assign, fields))
    size = np.zeros(len(means), np.int64)
    for r in placed.groupBy(F.col("lists")[0].alias("list")).count().collect():  # at most LISTS rows
        size[r["list"]] = r["count"]

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            v = _raised(_rows(batch.column("v")), top2, True)
            order = ((means**2).sum(1)[None] - 2 * v @ means.T).argsort(1, kind="stable")
            reach = np.cumsum(size[order], 1)
            # Lists before which fewer than ten times k candidates were seen are probed too.
            wanted = (np.arange(len(means))[None] < probes) | (np.concatenate([np.zeros((len(v), 1)), reach[:, :-1]], 1) < 10 * k + 1)
            took, cells, lists = [], [], []
            for i in range(len(v)):
                chosen = order[i, wanted[i]]
                for cell in np.unique(cell_of[chosen]):
                    took.append(i)
                    cells.append(cell)
                    lists.append(chosen[cell_of[chosen] == cell].tolist())
            yield pa.RecordBatch.from_arrays([*batch.take(pa.array(took)).columns, pa.array(cells, pa.int32()), pa.array(lists, pa.list_(pa.int32()))], ["vec_id", "v", "cell", "lists"])

    asked = stored(rows.filter(is_query).groupBy("vec_id").agg(F.min("v").alias("v")).mapInArrow(probe, fields))
    blocks = {}
    for asks, side, most in ((False, placed, BASE_BLOCK), (True, asked, QUERY_BLOCK)):
        counts = {r["cell"]: r["count"] for r in side.groupBy("cell").count().collect()}  # at most LISTS rows
        blocks[asks] = F.element_at(F.array(*[F.lit(int(-(-counts.get(c, 0) // most))) for c in range(len(hubs))]), F.col("cell") + 1)

    def spread(side: DataFrame, asks: bool) -> DataFrame:
        """A row's own block on its side, every block of the other side; none where the other side is empty."""
        block = F.pmod(F.xxhash64("vec_id"), blocks[asks]).cast("int")
        there = F.when(blocks[not asks] > 0, F.sequence(F.lit(0), F.greatest(blocks[not asks], F.lit(1)) - 1))
        both = side.select("cell", "vec_id", "v", "lists", block.alias("own"), F.explode(there).alias("other"))
        x, y = ("other", "own") if asks else ("own", "other")
        return both.select("cell", F.col(x).alias("x"), F.col(y).alias("y"), F.lit(asks).alias("asks"), "vec_id", "v", "lists")

    def search(group: pa.Table) -> pa.Table:
        asks = group.column("asks").to_numpy()
        ids, v, lists = group.column("vec_id").to_numpy(), _rows(group.column("v")), group.column("lists").to_pylist()
        probed = np.zeros((int(asks.sum()), len(means)), bool)
        for i, row in enumerate(np.flatnonzero(asks)):
            probed[i, lists[row]] = True
        own = np.array([lists[row][0] for row in np.flatnonzero(~asks)], np.int64)
        qi, found, score = scan(ids[~asks], v[~asks], own, ids[asks], v[asks], probed, turn, top2, k)
        return pa.table({"query_id": pa.array(ids[asks][qi], pa.int64()), "vec_id": pa.array(found, pa.int64()), "score": pa.array(score, pa.float64())})

    dealt = spread(placed, False).unionByName(spread(asked, True))
    found = dealt.groupBy("cell", "x", "y").applyInArrow(search, FOUND)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
