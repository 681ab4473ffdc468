"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

Features of a document: its distinct words, hashed into ``BUCKETS`` and weighted by the logarithm of their count to
unit length; statistics of the text's structure and the declared length (metadata), each as one of ``BINS`` quantile
bins.  The score of features x is w0 + sum w_i x_i + 1/2 sum_f ((sum v_if x_i)^2 - sum v_if^2 x_i^2), linear in the
number of features for any rank.  Labels, language, source and id are no inputs.

The model is fitted on a bounded, documented sample of labelled rows (``SAMPLE``) from the folds given for learning;
features are computed on Spark, only the sample's come to the driver.  All documents are scored, whole.

Defined results: a null text scores as an empty one; an empty one has no words and the bins of an empty text; a null
declared length is taken from the text; without labels of both classes every score is the share of label 1 (0.5 when
there is none); rows are scored by themselves, so repeated rows, null ids and extra columns change nothing.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.llm.common import WordHash, aside, fold, labelled_sample, sigmoid, slices

SAMPLE = 6_000
BUCKETS = 1 << 14
BINS = 8
RANK = 8
THRESHOLD = 0.3
SYMBOLS = re.compile(r"[^\w\s.,;:'\"?()-]")
STATS = ("declared", "words", "word_length", "symbols", "upper", "digits", "distinct", "top_word", "repeated_lines", "line_words", "marked_words", "repeated_next")


def structure(text: str, n_chars: int | None, words: list[str], counts: Counter) -> list[float]:
    """One number for each of ``STATS``; shares unless the name says otherwise."""
    n, chars = max(1, len(words)), max(1, len(text))
    lines = [line for line in text.split("\n") if line.strip()]
    pairs = Counter(zip(words, words[1:]))
    return [
        float(np.log1p(max(0, n_chars if n_chars is not None else len(text)))),
        float(np.log1p(len(words))),
        sum(map(len, words)) / n,
        len(SYMBOLS.findall(text)) / chars,
        sum(map(str.isupper, words)) / n,
        sum(map(str.isdigit, text)) / chars if any(d in text for d in "0123456789") else 0.0,
        len(counts) / n,
        max(counts.values(), default=0) / n,
        1 - len(set(lines)) / max(1, len(lines)),
        float(np.log1p(n / max(1, len(lines)))),
        sum(not w[-1].isalnum() and w[-1] not in ".,;:'\"?)" for w in words) / n,
        sum(c for c in pairs.values() if c > 1) / n,
    ]


def features(text: str, n_chars: int | None, hashed: WordHash) -> tuple[np.ndarray, np.ndarray, list[float]]:
    """Word buckets, their weights, and the statistics."""
    words = text.split()
    counts = Counter(words)
    codes = np.asarray(hashed(counts), np.int32)
    weights = np.log1p(np.fromiter(counts.values(), np.float32, len(counts)))
    return codes, weights / max(1e-9, float(np.sqrt((weights**2).sum()))), structure(text, n_chars, words, counts)


@dataclass
class Machine:
    edges: np.ndarray  # STATS x (BINS - 1) quantiles
    bias: float
    linear: np.ndarray
    factors: np.ndarray

    def rows(self, codes: list[np.ndarray], weights: list[np.ndarray], stats: np.ndarray):
        """Feature ids, values and row starts of several documents."""
        bins = (stats[:, :, None] > self.edges[None]).sum(2)  # row x statistic
        own = BUCKETS + np.arange(len(STATS)) * BINS + bins
        ids = np.concatenate([x for pair in zip(own, codes) for x in pair]).astype(np.int64)
        ones = np.ones(len(STATS), np.float32)
        values = np.concatenate([x for w in weights for x in (ones, w)]).astype(np.float32)
        starts = np.concatenate([[0], np.cumsum([len(STATS) + len(c) for c in codes])[:-1]])
        return ids, values, starts

    def margin(self, ids, values, starts):
        """Linear term plus half of (squared sum less sum of squares); also the sums by factor."""
        vx = self.factors[ids] * values[:, None]
        sums = np.add.reduceat(vx, starts, axis=0)
        squares = np.add.reduceat((vx**2).sum(1), starts)
        line = np.add.reduceat(self.linear[ids] * values, starts)
        return self.bias + line + 0.5 * ((sums**2).sum(1) - squares), sums

    def score(self, codes, weights, stats) -> np.ndarray:
        return sigmoid(self.margin(*self.rows(codes, weights, stats))[0])


def fit(codes: list[np.ndarray], weights: list[np.ndarray], stats: np.ndarray, y: np.ndarray, epochs: int = 12, rate: float = 0.08, decay: float = 1e-4, seed: int = 7) -> Machine:
    """Adagrad on the log loss in shuffled groups of rows; deterministic for a given order of rows."""
    edges = np.quantile(stats, np.arange(1, BINS) / BINS, axis=0).T if len(y) else np.zeros((len(STATS), BINS - 1))
    size = BUCKETS + len(STATS) * BINS
    share = float(y.mean()) if len(y) else 0.5
    machine = Machine(edges, float(np.log((share + 1e-6) / (1 - share + 1e-6))), np.zeros(size, np.float32), np.zeros((size, RANK), np.float32))
    if share in (0.0, 1.0) or not len(y):
        machine.bias = 0.0 if not len(y) else machine.bias
        return machine
    rng = np.random.default_rng(seed)
    machine.factors = rng.normal(0, 0.02, (size, RANK)).astype(np.float32)
    seen_w, seen_v, seen_b = np.full(size, 1e-3, np.float32), np.full((size, RANK), 1e-3, np.float32), 1e-3
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for rows in np.array_split(order, max(1, len(y) // 128)):
            ids, values, starts = machine.rows([codes[r] for r in rows], [weights[r] for r in rows], stats[rows])
            z, sums = machine.margin(ids, values, starts)
            slope = ((sigmoid(z) - y[rows]) / len(rows)).astype(np.float32)
            at = np.repeat(np.arange(len(rows)), np.diff(np.append(starts, len(ids))))
            step = slope[at] * values
            own = machine.factors[ids]
            by_v = step[:, None] * (sums[at] - own * values[:, None])
            used, where = np.unique(ids, return_inverse=True)
            gw = np.bincount(where, step, len(used)) + decay * machine.linear[used]
            gv = np.stack([np.bincount(where, by_v[:, f], len(used)) for f in range(RANK)], 1) + decay * machine.factors[used]
            seen_w[used] += gw**2
            seen_v[used] += gv**2
            gb = float(slope.sum())
            seen_b += gb**2
            machine.linear[used] -= rate * gw / np.sqrt(seen_w[used])
            machine.factors[used] -= rate * gv / np.sqrt(seen_v[used])
            machine.bias -= rate * gb / seen_b**0.5
    return machine


def train(docs: DataFrame, labels: DataFrame, learnable: Column, sample: int = SAMPLE) -> Machine:
    """Fit on up to ``sample`` labelled documents; ``learnable`` is a condition on ``doc_id``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashed = WordHash(BUCKETS)
        for batch in slices(batches, "text"):
            got = [features(t, n, hashed) for t, n in zip(batch.column("text").to_pylist(), batch.column("n_chars").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("label"), pa.array([c.astype("<i4").tobytes() for c, _, _ in got], pa.binary()), pa.array([w.astype("<f4").tobytes() for _, w, _ in got], pa.binary()), pa.array([s for _, _, s in got], pa.list_(pa.float64()))],
                ["doc_id", "label", "codes", "weights", "stats"],
            )

    chosen = labelled_sample(docs, labels, "quality", learnable, sample).mapInArrow(run, "doc_id long, label int, codes binary, weights binary, stats array<double>")
    rows = sorted(chosen.collect(), key=lambda r: (r["doc_id"], r["codes"]))  # at most ``sample`` documents' features
    return fit(
        [np.frombuffer(r["codes"], "<i4") for r in rows],
        [np.frombuffer(r["weights"], "<f4") for r in rows],
        np.array([r["stats"] for r in rows], float).reshape(len(rows), len(STATS)),
        np.array([r["label"] for r in rows], float),
    )


def score_quality(docs: DataFrame, machine: Machine, threshold: float = THRESHOLD) -> DataFrame:
    """The documents with ``score`` and ``predicted`` (1 if the score is ``threshold`` or more)."""
    kinds = docs.schema
    declared = "n_chars" in docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashed = WordHash(BUCKETS)
        for batch in slices(batches, "text"):
            counts = batch.column("n_chars").to_pylist() if declared else [None] * batch.num_rows
            got = [features(t or "", None if n is None else int(n), hashed) for t, n in zip(batch.column("text").to_pylist(), counts)]
            score = machine.score([c for c, _, _ in got], [w for _, w, _ in got], np.array([s for _, _, s in got]))
            names = [*batch.schema.names, "score", "predicted"]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score, pa.float64()), pa.array((score >= threshold).astype(np.int32))], names)

    schema = T.StructType([f for f in kinds.fields] + [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])
    return docs.mapInArrow(run, schema)


def quality_filter(docs: DataFrame, labels: DataFrame, learnable: Column | None = None, sample: int = SAMPLE) -> DataFrame:
    """The documents that the classifier accepts, columns as they came; learns from every fold but the first of five."""
    machine = train(docs, labels, learnable if learnable is not None else fold(F.col("doc_id"), 5) != 0, sample)
    plain, back = aside(docs, ("score", "predicted"))
    kept = score_quality(plain, machine).filter(F.col("predicted") == 1).drop("score", "predicted")
    return kept.withColumnsRenamed(back)
