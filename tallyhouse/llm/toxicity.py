"""Toxicity: a logistic classifier regularised by counterfactual identity swaps.

A document's features are its distinct words (lower case, letters only) and their four-letter beginnings, hashed.
Counterfactual pairs come from the sentences of the labelled documents.  A sentence that names a group is paired with
the same sentence naming each other group of that kind, one term swapped at a time.  A sentence that names none is
paired with itself: two terms of a kind, chosen by a hash of the sentence, are put into the same slot.  The loss adds
``PAIR_WEIGHT`` times the squared change of the margin within a pair, so a word that merely names a group can't carry
the score, and neutral mentions stop being false positives.  Swaps of one document weigh one document together, and so
do its inserted pairs, however many sentences it has.

A pair is kept as the features that only one of its sides has, and equal pairs are counted on Spark, so what the fit
gets grows with the terms, not with the sentences.  Only features that are tied to the label in the sample (chi-square
of at least ``CHI_SQUARE``, ``MIN_DOCS`` documents) or that occur in a pair get a weight: in a long document thousands of
rare words would otherwise add up.  They are chosen on Spark, and only they leave it.

The model is fitted on a bounded, documented sample of labelled rows (``SAMPLE``); all documents are scored, whole.
The identity terms are a parameter.

Defined results: null and empty texts have no features and score the bias; repeated rows, null ids, extra columns
change nothing, as rows are scored by themselves; without labels of both classes every score is the share of label 1
(0.5 when there is none).  A text is one piece of work of one task, which holds its distinct words.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import LETTERS, WordHash, labelled_sample, sigmoid, slices, stored

SAMPLE = 20_000
BUCKETS = 1 << 18
BEGINNING = 4
CHI_SQUARE = 12.0
MIN_DOCS = 3
PAIR_WEIGHT = 4.0
UNIT = 1_000_000  # weight of one document's pairs of a kind, in whole numbers so that sums have no order
SENTENCES = re.compile(r"[.!?\n]+")
THRESHOLD = 0.3

# Groups of terms that name people in the same way; a swap stays within its group.
IDENTITY_TERMS: tuple[tuple[str, ...], ...] = (
    ("women", "men", "girls", "boys"),
    ("woman", "man", "girl", "boy"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("gay", "lesbian", "bisexual", "straight", "transgender"),
    ("black", "white", "asian", "latino", "african", "european"),
    ("immigrants", "refugees", "locals", "foreigners"),
    ("disabled", "blind", "deaf", "elderly", "young"),
)


def distinct_words(text: str) -> set[str]:
    return set(LETTERS.findall(text.lower()))


def keys_of(words) -> set[str]:
    """The words and their marked beginnings."""
    return {*words, *("^" + w[:BEGINNING] for w in words if len(w) > BEGINNING)}


def codes_of(words, hashed: WordHash) -> np.ndarray:
    """Distinct buckets of words and of their beginnings."""
    return np.unique(np.asarray(hashed(keys_of(words)), np.int32))


def counterfactuals(text: str, terms: Sequence[Sequence[str]]) -> tuple[Counter, Counter]:
    """Pairs of swapped and of inserted terms, each as the keys that only one side has, with their number."""
    kinds = {t: kind for kind in terms for t in kind}
    named, inserted = Counter(), Counter()

    def add(pairs: Counter, rest: set[str], one: str, two: str) -> None:
        keys, a, b = keys_of(rest), keys_of([one]), keys_of([two])
        pairs[tuple(sorted(a - b - keys)), tuple(sorted(b - a - keys))] += 1

    for sentence in SENTENCES.split(text):
        words = distinct_words(sentence)
        for term in words & kinds.keys():
            for other in kinds[term]:
                if other != term:
                    add(named, words - {term}, term, other)
        if words and terms and not words & kinds.keys():
            draw = zlib.crc32(sentence.encode("utf-8", "surrogatepass"))
            kind = terms[draw % len(terms)]
            i = draw // len(terms) % len(kind)
            j = (i + 1 + draw // (len(terms) * len(kind)) % (len(kind) - 1)) % len(kind) if len(kind) > 1 else i
            add(inserted, words, kind[i], kind[j])
    return named, inserted


def pairs_of(text: str, terms: Sequence[Sequence[str]], hashed: WordHash) -> list[dict]:
    """The pairs of a text with codes for keys; all of a kind weigh about ``UNIT`` together."""
    out = []
    for kind, pairs in zip((1, 0), counterfactuals(text, terms)):
        total = sum(pairs.values())
        out += [{"a": sorted(hashed(a)), "b": sorted(hashed(b)), "named": kind, "weight": UNIT * n // total, "n": n} for (a, b), n in pairs.items()]
    return out


def tied(docs, hits, n, positive):
    """Whether a feature is tied to the label: numbers, arrays or columns of documents and toxic documents with it."""
    cross = hits * (n - positive - docs + hits) - (docs - hits) * (positive - hits)
    return (n * cross * cross >= CHI_SQUARE * docs * (n - docs) * positive * (n - positive)) & (docs >= MIN_DOCS) & (docs < n)


@dataclass
class Model:
    bias: float
    weights: np.ndarray
    named: int = 0  # pairs of the fit with a swapped term
    inserted: int = 0

    def margin(self, codes: list[np.ndarray]) -> np.ndarray:
        return np.array([self.bias + float(self.weights[c].sum(dtype=np.float64)) for c in codes])

    def score(self, codes: list[np.ndarray]) -> np.ndarray:
        return sigmoid(self.margin(codes))


def _by_row(codes: list[np.ndarray], place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of the selected features."""
    rows = np.repeat(np.arange(len(codes)), [len(c) for c in codes])
    columns = place[np.concatenate(codes)] if codes else np.empty(0, np.int64)
    keep = columns >= 0
    return rows[keep], columns[keep]


def fit(codes: list[np.ndarray], pairs: list[tuple], y: np.ndarray, pair_weight: float = PAIR_WEIGHT, steps: int = 300, decay: float = 2e-4) -> Model:
    """Full-batch gradient steps with momentum; deterministic.  ``pairs``: codes of one side only, of the other, weight."""
    weights = np.zeros(BUCKETS, np.float32)
    share = float(y.mean()) if len(y) else 0.5
    bias = float(np.log((share + 1e-6) / (1 - share + 1e-6)))
    if share in (0.0, 1.0) or not len(y):
        return Model(bias if len(y) else 0.0, weights)
    docs, hits = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for c, label in zip(codes, y):
        docs[c] += 1
        hits[c] += label
    n = len(y)
    wanted = tied(docs, hits, float(n), float(y.sum()))
    for a, b, _ in pairs:
        wanted[a] = wanted[b] = True
    chosen = np.flatnonzero(wanted)
    place = np.full(BUCKETS, -1, np.int64)
    place[chosen] = np.arange(len(chosen))
    row, col = _by_row(codes, place)
    row_a, col_a = _by_row([a for a, _, _ in pairs], place)
    row_b, col_b = _by_row([b for _, b, _ in pairs], place)
    heavy = 2 * pair_weight * np.array([w for _, _, w in pairs], float) / n
    w, b = np.zeros(len(chosen)), bias
    seen_w, seen_b = np.full(len(chosen), 1e-6), 1e-6
    for _ in range(steps):
        slope = (sigmoid(b + np.bincount(row, w[col], n)) - y) / n
        grad = np.bincount(col, slope[row], len(chosen)) + decay * w
        if pairs:
            gap = np.bincount(row_a, w[col_a], len(pairs)) - np.bincount(row_b, w[col_b], len(pairs))
            pull = heavy * gap
            grad += np.bincount(col_a, pull[row_a], len(chosen)) - np.bincount(col_b, pull[row_b], len(chosen))
        seen_w += grad**2
        seen_b += slope.sum() ** 2
        w -= 0.3 * grad / np.sqrt(seen_w)
        b -= 0.3 * slope.sum() / np.sqrt(seen_b)
    weights[chosen] = w
    return Model(b, weights)


def train(docs: DataFrame, labels: DataFrame, learnable: Column, sample: int = SAMPLE, terms: Sequence[Sequence[str]] = IDENTITY_TERMS) -> Model:
    """Fit on up to ``sample`` labelled documents; ``learnable`` is a condition on ``doc_id``."""
    sides = pa.struct([("a", pa.list_(pa.int32())), ("b", pa.list_(pa.int32())), ("named", pa.int32()), ("weight", pa.int64()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashed = WordHash(BUCKETS)
        for batch in slices(batches, "text"):
            texts = batch.column("text").to_pylist()
            codes = [codes_of(distinct_words(t), hashed) for t in texts]
            pairs = [pairs_of(t, terms, hashed) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("label"), pa.array(codes, pa.list_(pa.int32())), pa.array(pairs, pa.list_(sides))],
                ["doc_id", "label", "codes", "pairs"],
            )

    chosen = labelled_sample(docs, labels, "toxic", learnable, sample)
    rows = stored(chosen.mapInArrow(run, "doc_id long, label int, codes array<int>, pairs array<struct<a: array<int>, b: array<int>, named: int, weight: long, n: long>>"))
    n, positive = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("label"), F.lit(0))).first()
    features = rows.select(F.explode("codes").alias("code"), "label").groupBy("code").agg(F.count(F.lit(1)).cast("double").alias("docs"), F.sum("label").cast("double").alias("hits"))
    # One number for each feature that is used, BUCKETS at most; then the kinds of pairs, which the terms bound.
    used = [r["code"] for r in features.filter(tied(F.col("docs"), F.col("hits"), float(n), float(positive))).select("code").collect()]
    pairs = rows.select(F.inline("pairs")).groupBy("a", "b").agg(F.sum("weight").alias("weight"), F.sum(F.col("n") * F.col("named")).alias("named"), F.sum("n").alias("n")).collect()
    pairs.sort(key=lambda r: (r["a"], r["b"]))
    used = np.unique(np.array(used + [c for r in pairs for c in r["a"] + r["b"]], np.int32))

    def narrow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = [np.intersect1d(np.asarray(c, np.int32), used) for c in batch.column("codes").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("label"), pa.array([c.tobytes() for c in codes], pa.binary())], ["doc_id", "label", "codes"])

    found = rows.select("doc_id", "label", "codes").mapInArrow(narrow, "doc_id long, label int, codes binary")
    found = sorted(found.collect(), key=lambda r: (r["doc_id"], r["codes"]))  # ``sample`` rows of used features
    model = fit(
        [np.frombuffer(r["codes"], np.int32) for r in found],
        [(np.array(r["a"], np.int32), np.array(r["b"], np.int32), r["weight"] / UNIT) for r in pairs],
        np.array([r["label"] for r in found], float),
    )
    model.named = sum(r["named"] for r in pairs)
    model.inserted = sum(r["n"] for r in pairs) - model.named
    return model


def score_toxicity(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, score, predicted) of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashed = WordHash(BUCKETS)
        for batch in slices(batches, "text"):
            score = model.score([codes_of(distinct_words(t or ""), hashed) for t in batch.column("text").to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(score, pa.float64()), pa.array((score >= threshold).astype(np.int32))], ["doc_id", "score", "predicted"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, score double, predicted int")
