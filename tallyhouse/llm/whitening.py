"""Embedding whitening from a polarisation covariance.

Vectors become whole numbers x = floor(256 c).  The fit list holds each distinct x vector once: n vectors with the sums S
by dimension.  Covariances come from variances alone: with centred values y = n x - S,

    sum y_i y_j = (sum (y_i + y_j)^2 - sum y_i^2 - sum y_j^2) / 2,

so every task adds up squares for each dimension and for the sum of each pair of dimensions, and nothing else.  All of it
is exact: a task squares z = x - c with c the rounded mean, and n^2 sum z^2 - n R^2 with R = S - n c is the sum of the
squares of y to the last digit.  Sums leave a task in limbs of 31 bits, which Spark adds up without overflow, and are put
together as whole numbers of any size.  The covariance matrix, rounded once, goes to ``eigh``.

Shuffled are the distinct x vectors (copies meet map-side first) and the sums, D (D + 1) / 2 of them for D dimensions
whatever the number of rows; the driver holds these sums and the matrix.

Defined results: rows whose vector is null or holds a null or non-finite entry are left out, as are those whose vector is
not of the most frequent length (the shorter of equals); an entry beyond the range of a long counts as the end of that
range; repeated rows and null or repeated ids are rows of their own in the result and one vector in the fit list; a
component without variance (eigenvalue at most D * 2^-52 of the largest) has a null ``whitened``; ``deviation`` is null
where it exceeds a long; ``explained`` is null where the trace is zero; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import stored

SCALE = 256
LIMB = 31
ROWS = 4_096
SUMS = "key long, limb int, part long"
WHITENED = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


class Whitening(NamedTuple):
    """A fitted transform: n and sums are exact, ``axes`` holds one unit eigenvector a column, largest eigenvalue first."""

    n: int
    sums: list[int]
    values: np.ndarray
    axes: np.ndarray
    trace: float
    identity_error: float


def whole_vectors(vectors: DataFrame, vector: str, *others) -> DataFrame:
    """``others`` and x array<long> of the rows that take part."""
    v = F.col(vector).cast("array<double>")
    rows = vectors.select(*others, v.alias("_v")).filter(
        F.col("_v").isNotNull() & ~F.exists("_v", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    )
    return rows.select(*[c for c in rows.columns if c != "_v"], F.transform("_v", lambda c: F.floor(c * SCALE)).alias("x"))


def of_length(rows: DataFrame, size: int) -> DataFrame:
    return rows.filter(F.size("x") == size)


def matrix(column) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False)
    return flat.reshape(len(column), -1)


def _largest(x: np.ndarray) -> int:
    return max(abs(int(x.min())), abs(int(x.max()))) if x.size else 0


def exact_sum(x: np.ndarray) -> list[int]:
    """Column sums as whole numbers of any size."""
    kind = np.int64 if _largest(x) * len(x) < 1 << 62 else object
    return [int(s) for s in x.astype(kind, copy=False).sum(0)]


def shifted(x: np.ndarray, centre: list[int]) -> np.ndarray:
    """x - centre, in longs where these hold it and twice its value squared over ``ROWS`` rows."""
    far = _largest(x) + max((abs(c) for c in centre), default=0)
    if (2 * far) ** 2 * ROWS < 1 << 62:
        return x - np.array(centre, np.int64)
    return x.astype(object) - np.array(centre, object)


def square_sums(z: np.ndarray) -> list[np.ndarray]:
    """For each dimension i: sums of z_i^2 and of (z_i + z_j)^2 for j > i."""
    out = []
    for i in range(z.shape[1]):
        block = z[:, i:] + z[:, i : i + 1]
        block[:, 0] = z[:, i]
        out.append((block * block).sum(0))
    return out


def limbs(totals: Iterator[tuple[int, int]]) -> pa.RecordBatch:
    """(key, limb, part) of whole numbers: the signed parts of 31 bits that are not zero, one row at least."""
    keys, places, parts = [], [], []
    for key, total in totals:
        sign, rest, place = (-1 if total < 0 else 1), abs(total), 0
        while rest or not place:
            keys.append(key)
            places.append(place)
            parts.append(sign * (rest & (1 << LIMB) - 1))
            rest, place = rest >> LIMB, place + 1
    return pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(places, pa.int32()), pa.array(parts, pa.int64())], ["key", "limb", "part"])


def whole_numbers(sums: DataFrame) -> dict[int, int]:
    """The totals by key; at most a few rows for each key."""
    totals: dict[int, int] = {}
    for r in sums.groupBy("key", "limb").agg(F.sum("part").alias("part")).collect():
        totals[r["key"]] = totals.get(r["key"], 0) + (r["part"] << LIMB * r["limb"])
    return totals


def _means(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals: list[int] = []
    count = 0
    for batch in batches:
        if batch.num_rows:
            sums = exact_sum(matrix(batch.column("x")))
            totals = [a + b for a, b in zip(totals, sums)] if totals else sums
            count += batch.num_rows
    if count:
        yield limbs([(-1, count), *enumerate(totals)])


def covariance(n: int, sums: list[int], centre: list[int], squares: dict[int, int]) -> np.ndarray:
    """V from the sums of squares by i * D + j, each entry exact until its one rounding."""
    size = len(sums)
    left = [s - n * c for s, c in zip(sums, centre)]
    own = [n * n * squares[i * size + i] - n * left[i] ** 2 for i in range(size)]
    v = np.empty((size, size))
    for i in range(size):
        v[i, i] = own[i] / n**3
        for j in range(i + 1, size):
            both = n * n * squares[i * size + j] - n * (left[i] + left[j]) ** 2
            v[i, j] = v[j, i] = (both - own[i] - own[j]) // 2 / n**3
    return v


def project(x: np.ndarray, model: Whitening) -> np.ndarray:
    """x - S / n on every axis, over the root of its eigenvalue; NaN on axes without variance."""
    centre, left = _centre(model.n, model.sums)
    z = shifted(x, centre).astype(float) - np.array([r / model.n for r in left])
    flat = model.values <= len(model.sums) * np.finfo(float).eps * max(model.values[:1], default=0.0)
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(flat, np.nan, z @ model.axes / np.sqrt(np.where(flat, np.nan, model.values)))


def _centre(n: int, sums: list[int]) -> tuple[list[int], list[int]]:
    """The rounded means, and what they leave of the sums."""
    centre = [(2 * s + n) // (2 * n) for s in sums]
    return centre, [s - n * c for s, c in zip(sums, centre)]


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int]:
    """Exact sums of (n x - S)^2 over the dimensions, by row."""
    centre, left = _centre(n, sums)
    z = shifted(x, centre)
    if z.dtype != object and n * (_largest(z) + 1) < 1 << 31 and (n * (_largest(z) + 1)) ** 2 * z.shape[1] < 1 << 62:
        return (((n * z - np.array(left, np.int64)) ** 2).sum(1)).tolist()
    z = z.astype(object)
    return [int(s) for s in ((n * z - np.array(left, object)) ** 2).sum(1)]


def fit(vectors: DataFrame, vector: str, components: int = 4) -> Whitening | None:
    """The leading components of the distinct vectors; None where there is no vector."""
    rows = whole_vectors(vectors, vector)
    common = rows.groupBy(F.size("x").alias("size")).count().orderBy(F.desc("count"), "size").first()
    if common is None or not common["size"]:
        return None
    size = common["size"]
    distinct = stored(of_length(rows, size).distinct())
    totals = whole_numbers(distinct.mapInArrow(_means, SUMS))
    n, sums = totals[-1], [totals[i] for i in range(size)]
    centre, _ = _centre(n, sums)

    def squares(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = None
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                got = square_sums(shifted(matrix(batch.column("x").slice(at, ROWS)), centre))
                got = [s.astype(object) for s in got]
                totals = got if totals is None else [a + b for a, b in zip(totals, got)]
        if totals is not None:
            yield limbs((i * size + i + k, int(s)) for i, row in enumerate(totals) for k, s in enumerate(row))

    v = covariance(n, sums, centre, whole_numbers(distinct.mapInArrow(squares, SUMS)))
    values, axes = np.linalg.eigh(v)
    values, axes = np.maximum(values[::-1][:components], 0.0), axes[:, ::-1][:, :components]
    axes = axes * np.where(axes[np.abs(axes).argmax(0), np.arange(axes.shape[1])] < 0, -1.0, 1.0)
    model = Whitening(n, sums, values, np.ascontiguousarray(axes), float(np.trace(v)), 0.0)

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ones = None
        for batch in batches:
            if batch.num_rows:
                w = project(matrix(batch.column("x")), model)
                w = np.concatenate([np.ones((len(w), 1)), w], 1)
                ones = w.T @ w if ones is None else ones + w.T @ w
        if ones is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(ones.size, dtype=np.int64)), pa.array(ones.ravel())], ["place", "total"])

    # The first row holds the sums of the whitened values, the rest their products: at most 25 numbers.
    found = distinct.mapInArrow(products, "place long, total double").groupBy("place").agg(F.sum("total").alias("total")).collect()
    wide = len(values) + 1
    square = np.empty(wide * wide)
    for r in found:
        square[r["place"]] = r["total"]
    square = square.reshape(wide, wide) / n
    error = np.abs(square[1:, 1:] - np.outer(square[0, 1:], square[0, 1:]) - np.eye(wide - 1))
    return model._replace(identity_error=float(np.nanmax(error)) if np.isfinite(error).any() else 0.0)


def whiten(vectors: DataFrame, key: str, vector: str, model: Whitening | None) -> DataFrame:
    """One row for each row that takes part and each component of the model."""
    rows = whole_vectors(vectors, vector, F.col(key).cast("long").alias("vec_id"))
    if model is None:
        return vectors.sparkSession.createDataFrame([], WHITENED)
    many = len(model.values)
    explained = model.values / model.trace if model.trace else np.full(many, np.nan)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                x = matrix(part.column("x"))
                far = [d if d < 1 << 63 else None for d in deviations(x, model.n, model.sums)]
                again = pa.array(np.repeat(np.arange(len(x)), many))
                columns = [
                    part.column("vec_id").take(again),
                    pa.array(np.tile(np.arange(1, many + 1, dtype=np.int32), len(x))),
                    pa.array(np.full(len(again), model.n, np.int64)),
                    pa.array(far, pa.int64()).take(again),
                    pa.array(project(x, model).ravel(), from_pandas=True),
                    pa.array(np.tile(explained, len(x)), from_pandas=True),
                    pa.array(np.full(len(again), model.identity_error)),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return of_length(rows, len(model.sums)).mapInArrow(run, WHITENED)
