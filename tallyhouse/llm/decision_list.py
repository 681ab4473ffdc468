"""Quality rules: ordered lists of threshold conjunctions, learned by sequential covering.

Each round grows a conjunction of ``statistic <= t`` or ``statistic >= t`` on two thirds of the uncovered labelled rows
by information gain, prunes its tail on the last third, and keeps it if it holds there.  Covered rows leave; the next
rule sees the rest.  The list is a chain of ``CASE WHEN`` branches over statistics columns, evaluated by Spark.

Statistics are computed for whole texts of all documents; the list is learned from those of a bounded, documented
sample of labelled rows (``SAMPLE``).

Defined results: a null text has no words; words are runs of characters other than space and \\t to \\r; without labels
of both classes the list is empty and keeps everything; rows are judged by themselves, so repeated rows, null ids and
extra columns change nothing.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import labelled_sample, slices

SAMPLE = 20_000
BLANKS = re.compile(r"[\x20\x09-\x0D]+")
SYMBOLS = re.compile(r"[#*$%&|<>]")
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
MORE = ("n_upper_words", "n_distinct_words", "n_marked_words")
# What rules may ask for; each is a column expression over the counts, so the list stays readable SQL.
RATIOS = {
    "word_length": "word_chars / greatest(n_words, 1)",
    "symbol_share": "n_symbols / greatest(n_words, 1)",
    "dup_lines": "cast(n_dup_lines as double)",
    "repeat_share": "n_repeat_words / greatest(n_words, 1)",
    "upper_share": "n_upper_words / greatest(n_words, 1)",
    "distinct_share": "n_distinct_words / greatest(n_words, 1)",
    "marked_share": "n_marked_words / greatest(n_words, 1)",
    "words": "cast(n_words as double)",
}


def text_counts(text: str) -> tuple[int, ...]:
    """``BASE`` and ``MORE`` of one text."""
    words = text.encode("utf-8", "surrogatepass").split()  # bytes.split() cuts at space and \t to \r alone
    n = len(words)
    ids: dict[bytes, int] = {}
    codes = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, n)
    repeats = 0
    if n >= 3:
        span = len(ids)
        pairs = codes[:-1] * span + codes[1:]
        _, pairs = np.unique(pairs, return_inverse=True)  # renumbered, so that the product stays small
        _, which, times = np.unique(pairs[:-1] * span + codes[2:], return_inverse=True, return_counts=True)
        again = times[which] > 1
        covered = np.zeros(n, bool)
        for k in range(3):
            covered[k : n - 2 + k] |= again
        repeats = int(covered.sum())
    seen, dup = set(), 0
    for line in text.split("\n"):
        if BLANKS.sub("", line):
            dup += line in seen
            seen.add(line)
    chars = len(text) - sum(map(len, BLANKS.findall(text)))
    upper = sum(w.isupper() for w in words)
    marked = sum(not (w[-1:].isalnum() or w[-1] > 127 or w[-1:] in b".,;:'\"?)") for w in words)
    return n, chars, len(SYMBOLS.findall(text)), dup, repeats, upper, len(ids), marked


def with_counts(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` columns and the counts of each whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            counts = np.array([text_counts(t or "") for t in batch.column("text").to_pylist()], np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in keep] + list(map(pa.array, counts.T)), [*keep, *BASE, *MORE])

    kinds = dict(docs.dtypes)
    schema = ", ".join([f"`{c}` {kinds[c]}" for c in keep] + [f"{c} long" for c in BASE + MORE])
    return docs.select(*keep, "text").mapInArrow(run, schema)


@dataclass(frozen=True)
class Condition:
    name: str
    at_least: bool
    threshold: float

    def holds(self, x: dict[str, np.ndarray]) -> np.ndarray:
        return x[self.name] >= self.threshold if self.at_least else x[self.name] <= self.threshold

    def column(self) -> Column:
        value = F.expr(RATIOS[self.name])
        return value >= F.lit(self.threshold) if self.at_least else value <= F.lit(self.threshold)


def _covers(rule: list[Condition], x: dict[str, np.ndarray], n: int) -> np.ndarray:
    out = np.ones(n, bool)
    for condition in rule:
        out &= condition.holds(x)
    return out


def _grow(x: dict[str, np.ndarray], bad: np.ndarray, most: int) -> list[Condition]:
    """Add the condition of highest gain until only bad rows are covered or nothing is gained."""
    rule, inside = [], np.ones(len(bad), bool)
    while len(rule) < most:
        p, n = int(bad[inside].sum()), int((~bad[inside]).sum())
        if not p or not n:
            break
        base, best = np.log2(p / (p + n)), (0.0, None)
        for name, values in x.items():
            v, b = values[inside], bad[inside]
            order = np.argsort(v, kind="stable")
            v, b = v[order], b[order]
            cuts = np.flatnonzero(v[1:] > v[:-1])  # between unequal neighbours
            if not len(cuts):
                continue
            low = np.cumsum(b)[cuts]
            for at_least, hits, rows in ((False, low, cuts + 1), (True, p - low, len(v) - cuts - 1)):
                with np.errstate(divide="ignore", invalid="ignore"):
                    gain = np.where(hits > 0, hits * (np.log2(hits / rows) - base), 0.0)
                i = int(gain.argmax())
                if gain[i] > best[0] + 1e-9:
                    best = (float(gain[i]), Condition(name, at_least, float((v[cuts[i]] + v[cuts[i] + 1]) / 2)))
        if best[1] is None:
            break
        rule.append(best[1])
        inside &= best[1].holds(x)
    return rule


def _worth(rule: list[Condition], x: dict[str, np.ndarray], bad: np.ndarray) -> tuple[float, float]:
    """(p - n) / (p + n) and precision of a rule on the pruning rows."""
    hit = _covers(rule, x, len(bad))
    p, n = int((hit & bad).sum()), int((hit & ~bad).sum())
    return ((p - n) / (p + n), p / (p + n)) if p + n else (-1.0, 0.0)


def learn(x: dict[str, np.ndarray], bad: np.ndarray, rules: int = 12, conditions: int = 4, precision: float = 0.9) -> list[list[Condition]]:
    """Ordered conjunctions that reject; rows that none covers are kept."""
    out: list[list[Condition]] = []
    for _ in range(rules):
        if not bad.any() or bad.all():
            break
        third = np.arange(len(bad)) % 3 == 2
        grown = _grow({k: v[~third] for k, v in x.items()}, bad[~third], conditions)
        held, held_bad = {k: v[third] for k, v in x.items()}, bad[third]
        options = [grown[:k] for k in range(1, len(grown) + 1)]
        if not options:
            break
        best = max(options, key=lambda r: (_worth(r, held, held_bad)[0], -len(r)))
        if _worth(best, held, held_bad)[1] < precision:
            break
        out.append(best)
        rest = ~_covers(best, x, len(bad))
        x, bad = {k: v[rest] for k, v in x.items()}, bad[rest]
    return out


def train(docs: DataFrame, labels: DataFrame, learnable: Column, sample: int = SAMPLE) -> list[list[Condition]]:
    """Learn from the statistics of up to ``sample`` labelled documents."""
    chosen = with_counts(labelled_sample(docs, labels, "quality", learnable, sample), ["doc_id", "label"])
    rows = chosen.select("doc_id", "label", *[F.expr(e).alias(n) for n, e in RATIOS.items()]).collect()
    rows.sort(key=lambda r: (hash((r["doc_id"] * 2_654_435_761) % 2**32), tuple(r)))
    x = {name: np.array([r[name] for r in rows], float) for name in RATIOS}
    return learn(x, np.array([r["label"] == 0 for r in rows], bool))


def verdict(rules: list[list[Condition]]) -> Column:
    """True (keep) or false as a chain of conditional branches, first match first."""
    chain = None
    for rule in rules:
        condition = rule[0].column()
        for more in rule[1:]:
            condition = condition & more.column()
        chain = F.when(condition, F.lit(False)) if chain is None else chain.when(condition, F.lit(False))
    return F.lit(True) if chain is None else chain.otherwise(F.lit(True))


def judge(docs: DataFrame, rules: list[list[Condition]]) -> DataFrame:
    """doc_id, the base counts, ``base_failed`` and ``kept``."""
    counted = with_counts(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), ["doc_id"])
    failed = (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)
    return counted.select("doc_id", *BASE, failed.alias("base_failed"), (~failed & verdict(rules)).alias("kept"))
