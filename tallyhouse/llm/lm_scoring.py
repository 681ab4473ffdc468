"""Language-model scoring by cross-entropy difference.

Two interpolated bigram models, one of the target texts and one of all texts, share one vocabulary of lower-case words.
For a token w after u

    p(w | u) = (c(u, w) + MASS * p(w)) / (c(u) + MASS),    p(w) = (c(w) + 1) / (N + V)

and a document's score is its mean loss per token under the target less that under the background; lower is more like
the target.  A text starts after an empty word.  V is the number of words held possible: one more than the corpus has,
and ``WORDS`` at least.

Both models are counted over whole texts of all documents, each word, context and pair by itself under a 64-bit key, in a
stored table that grows with the corpus.  A task adds up ``CHUNK`` bytes of text at a time and sends one row per n-gram
seen in them, so a hot n-gram is a row per chunk.

Texts of other corpora are scored against that table (``score_language``): stored in chunks, a chunk asks for each of its
n-grams once, by a join.  The corpus itself is counted and scored in one exchange (``score_corpus``): what a chunk sends to
be counted is what it asks.  Its sorted keys are cut by value into ranges, whose number grows with the corpus, and packed
into one row a range, delta-coded and with their counts.  A task adds up one range of all chunks and sends each chunk the
totals in the order of its keys.  Chunks are numbered by partition and place; texts are read again to be scored, and sums
of the keys tell if a chunk is not the one that was counted.  A task holds the n-grams of one chunk or one range, whatever
the corpus; a text above ``CHUNK`` bytes is a chunk of its own.

Target texts are the labelled documents of quality 1 unless another set of ids is given.

Defined results: null, blank and letterless texts have no tokens and null scores; rows are scored by themselves and
repeated rows count as often as they occur; a null id is never in the target; with an empty target its model is
uniform; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import LETTERS, slices, stored

WORDS = 1 << 18
MASS = 2.0
CHUNK = 16 << 20
START = -1  # before a text's first word
WORD, CONTEXT, PAIR = range(3)
SCORES = "doc_id long, n_tokens long, target_loss double, background_loss double, difference double"


class Codes:
    """64-bit keys of a text's words, remembered for up to ``most`` words."""

    def __init__(self, most: int = 400_000):
        self.known, self.most = {}, most

    def __call__(self, text: str) -> np.ndarray:
        known = self.known
        if len(known) > self.most:
            known.clear()
        words = LETTERS.findall(text.lower())
        for w in set(words):
            if w not in known:
                known[w] = int.from_bytes(hashlib.blake2b(w.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)
        return np.fromiter((known[w] for w in words), np.int64, len(words))


def pair_classes(codes: np.ndarray, starts: np.ndarray | int = 0) -> tuple[np.ndarray, np.ndarray]:
    """The key before each token (START at the positions ``starts``) and the 64-bit key of each pair."""
    before = np.roll(codes, 1)
    if len(codes):
        before[starts] = START
    mixed = before.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + codes.astype(np.uint64) * np.uint64(0xBF58476D1CE4E5B9)
    mixed = (mixed ^ (mixed >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
    return before, (mixed ^ (mixed >> np.uint64(29))).astype(np.int64)


def grams(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word, context and pair keys of all tokens of coded texts, in the order of the kinds."""
    lengths = np.array([len(x) for x in texts], np.int64)
    words = np.concatenate([*texts, np.empty(0, np.int64)])
    return words, *pair_classes(words, (np.cumsum(lengths) - lengths)[lengths > 0])


def _rows(columns: dict[str, np.ndarray], most: int = 1 << 16) -> Iterator[pa.RecordBatch]:
    for at in range(0, len(next(iter(columns.values()))), most):
        yield pa.RecordBatch.from_arrays([pa.array(x[at : at + most]) for x in columns.values()], list(columns))


def _tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per n-gram of each ``CHUNK`` bytes of text."""
    codes, held, size = Codes(), ([], []), 0

    def counted() -> Iterator[pa.RecordBatch]:
        for kind, (other, target) in enumerate(zip(grams(held[0]), grams(held[1]))):
            seen, times = np.unique(np.concatenate([other, target]), return_counts=True)
            used, n = np.unique(target, return_counts=True)
            within = np.zeros(len(seen), np.int64)
            within[np.searchsorted(seen, used)] = n
            yield from _rows({"kind": np.full(len(seen), kind, np.int8), "key": seen, "target": within, "background": times})

    for batch in slices(batches, "text"):
        for text, target in zip(batch.column("text").to_pylist(), batch.column("target").to_pylist()):
            held[target].append(codes(text or ""))
            size += len(text or "")
        if size >= CHUNK:
            yield from counted()
            held, size = ([], []), 0
    yield from counted()


@dataclass
class Models:
    """Counts of words, contexts and pairs (kind, key, target, background), stored; tokens in all, and words possible."""

    counts: DataFrame
    totals: tuple[int, int]
    words: int


def count_models(docs: DataFrame, target_ids: DataFrame) -> Models:
    """Counts over all documents; ``target_ids`` holds the doc_id of the target's."""
    chosen = target_ids.select(F.col("doc_id").cast("long").alias("_id")).filter(F.col("_id").isNotNull()).distinct()
    flagged = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(chosen, F.col("doc_id") == F.col("_id"), "left")
    counts = stored(
        flagged.select("text", F.col("_id").isNotNull().alias("target"))
        .mapInArrow(_tally, "kind byte, key long, target long, background long")
        .groupBy("kind", "key")
        .agg(F.sum("target").alias("target"), F.sum("background").alias("background"))
    )
    whole = counts.filter(F.col("kind") == WORD).agg(F.count("*"), F.sum("target"), F.sum("background")).first()
    return Models(counts, (whole[1] or 0, whole[2] or 0), max(WORDS, whole[0] + 1))


def _chunked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows with the number of their chunk."""
    chunk, size = TaskContext.get().partitionId() << 32, 0
    for batch in slices(batches, "text"):
        if size >= CHUNK:
            chunk, size = chunk + 1, 0
        size += batch.nbytes
        yield pa.RecordBatch.from_arrays([pa.array([chunk] * batch.num_rows, pa.int64()), *batch.columns], ["chunk", *batch.schema.names])


def _asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each n-gram of a chunk once, or once a task where a chunk is cut."""
    codes, held, last = Codes(), [], None

    def asked() -> Iterator[pa.RecordBatch]:
        for kind, keys in enumerate(grams(held)):
            seen = np.unique(keys)
            yield from _rows({"chunk": np.full(len(seen), last, np.int64), "kind": np.full(len(seen), kind, np.int8), "key": seen})

    for batch in slices(batches, "text"):
        for chunk, text in zip(batch.column("chunk").to_pylist(), batch.column("text").to_pylist()):
            if chunk != last:
                yield from asked()
                held, last = [], chunk
            held.append(codes(text or ""))
    yield from asked()


def _scorer(totals: tuple[int, int], words: int):
    def run(texts: pa.Table, answers: pa.Table) -> pa.Table:
        codes = Codes()
        coded = [codes(text or "") for text in texts.column("text").to_pylist()]
        of_kind = answers.column("kind").to_numpy()
        found = []  # of each kind: target's and background's counts by token
        for kind, keys in enumerate(grams(coded)):
            rows = np.flatnonzero(of_kind == kind)
            known = answers.column("key").to_numpy()[rows]
            order = np.argsort(known)
            known = known[order]
            at = np.searchsorted(known, keys)
            hit = at < len(known)
            hit[hit] = known[at[hit]] == keys[hit]
            both = np.zeros((2, len(keys)))
            for k, name in enumerate(("target", "background")):
                both[k][hit] = answers.column(name).to_numpy()[rows][order][at[hit]]
            found.append(both)
        n = np.array([len(x) for x in coded], np.int64)
        full, ends = n > 0, np.cumsum(n)
        means = []
        for k in (0, 1):
            single = (found[WORD][k] + 1.0) / (totals[k] + words)
            p = (found[PAIR][k] + MASS * single) / (found[CONTEXT][k] + MASS)
            mean = np.zeros(len(n))
            if full.any():
                mean[full] = np.add.reduceat(-np.log(p), (ends - n)[full]) / n[full]
            means.append(mean)
        losses = [pa.array(x, pa.float64(), mask=~full) for x in (*means, means[0] - means[1])]
        return pa.Table.from_arrays([texts.column("doc_id"), pa.array(n), *losses], [c.split()[0] for c in SCORES.split(", ")])

    return run


def score_language(docs: DataFrame, models: Models) -> DataFrame:
    """doc_id, n_tokens, the two mean losses and their difference for every row."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    texts = stored(texts.mapInArrow(_chunked, "chunk long, doc_id long, text string"))
    asked = texts.select("chunk", "text").mapInArrow(_asked, "chunk long, kind byte, key long")
    answers = stored(asked.join(models.counts, ["kind", "key"]).select("chunk", "kind", "key", "target", "background"))
    scored = texts.groupBy("chunk").cogroup(answers.groupBy("chunk"))
    return scored.applyInArrow(_scorer(models.totals, models.words), SCORES)


# --- counting and scoring one corpus in one exchange --------------------------

TARGETS = 1 << 20  # target ids up to which they are broadcast
SENT = "chunk long, kind byte, part int, keys binary, counts binary, check long"
ANSWERED = "chunk long, kind byte, part int, counts binary, check long, words long, target long, background long"


def packed(numbers: np.ndarray) -> bytes:
    """Whole numbers as their sizes in bytes and their significant bytes."""
    numbers = np.ascontiguousarray(numbers, np.uint64)
    size = np.ones(len(numbers), np.uint8)
    for k in range(1, 8):
        size += numbers >= np.uint64(1 << 8 * k)
    return size.tobytes() + numbers.view(np.uint8).reshape(-1, 8)[np.arange(8) < size[:, None]].tobytes()


def unpacked(data: bytes, many: int) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8)
    out = np.zeros((many, 8), np.uint8)
    out[np.arange(8) < raw[:many, None]] = raw[many:]
    return out.view(np.uint64).ravel()


def ranges(keys: np.ndarray, parts: int) -> np.ndarray:
    """Where each of ``parts`` equal ranges of 64 bits begins in sorted keys, and the end."""
    edges = np.array([(p << 64) // parts for p in range(parts)], np.uint64)
    return np.append(np.searchsorted(keys, edges), len(keys))


def _chunk_grams(coded: list[np.ndarray]):
    """Of WORD and PAIR: (sorted keys, place of each token's key, and for words the place of the key before it)."""
    words, before, pairs = (x.view(np.uint64) for x in grams(coded))
    single, at = np.unique(np.concatenate([words, before]), return_inverse=True)
    double, pair_at = np.unique(pairs, return_inverse=True)
    return (single, at[: len(words)], at[len(words) :]), (double, pair_at)


def _send(parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = Codes()
        for chunk, rows in _chunks(batches):
            coded = [codes(text or "") for _, text, _ in rows]
            wanted = np.repeat(np.array([t for _, _, t in rows], bool), [len(c) for c in coded])
            (single, at, before), (double, pair_at) = _chunk_grams(coded)
            count = lambda places, keys: (np.bincount(places[wanted], minlength=len(keys)), np.bincount(places, minlength=len(keys)))
            for kind, keys, counts in ((WORD, single, (*count(at, single), *count(before, single))), (PAIR, double, count(pair_at, double))):
                cuts = ranges(keys, parts)
                for part in np.flatnonzero(np.diff(cuts)):
                    own = keys[cuts[part] : cuts[part + 1]]
                    row = [chunk, kind, part, packed(np.diff(own, prepend=np.uint64(0))), b"".join(packed(c[cuts[part] : cuts[part + 1]]) for c in counts), _check(own)]
                    yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, (pa.int64(), pa.int8(), pa.int32(), pa.binary(), pa.binary(), pa.int64()))], [f.split()[0] for f in SENT.split(", ")])

    return run


def _check(keys: np.ndarray) -> int:
    return int((keys.sum(dtype=np.uint64) + np.uint64(len(keys))).astype(np.int64))


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[tuple]]]:
    """(number, rows of doc_id, text, target) of chunks of about ``CHUNK`` bytes."""
    chunk, rows, size = TaskContext.get().partitionId() << 32, [], 0
    for batch in slices(batches, "text"):
        for row in zip(*[batch.column(c).to_pylist() for c in ("doc_id", "text", "target")]):
            rows.append(row)
            size += len(row[1] or "")
            if size >= CHUNK:
                yield chunk, rows
                chunk, rows, size = chunk + 1, [], 0
    if rows:
        yield chunk, rows


def _unpack_arrays(data: bytes, many: int, arrays: int) -> list[np.ndarray]:
    out, at = [], 0
    for _ in range(arrays):
        end = at + many + int(np.frombuffer(data, np.uint8, many, at).sum())
        out.append(unpacked(data[at:end], many).astype(np.int64))
        at = end
    return out


def _key_count(data: bytes) -> int:
    """How many numbers packed bytes hold: the least m whose first m sizes fill the rest."""
    raw = np.frombuffer(data, np.uint8)
    filled = np.arange(1, len(raw) + 1) + np.cumsum(raw, dtype=np.int64)
    return int(np.searchsorted(filled, len(raw))) + 1


def _add_up(group: pa.Table) -> pa.Table:
    """Totals of one range of keys over all chunks, back to each chunk."""
    kind, part = group.column("kind")[0].as_py(), group.column("part")[0].as_py()
    arrays = 4 if kind == WORD else 2
    keys, counts = [], []
    for packed_keys, packed_counts in zip(group.column("keys").to_pylist(), group.column("counts").to_pylist()):
        many = _key_count(packed_keys)
        keys.append(np.cumsum(unpacked(packed_keys, many), dtype=np.uint64))
        counts.append(np.stack(_unpack_arrays(packed_counts, many, arrays)))
    seen, at = np.unique(np.concatenate(keys), return_inverse=True)
    ends = np.cumsum([len(k) for k in keys])
    totals = np.stack([np.bincount(at, row, len(seen)) for row in np.concatenate(counts, 1)]).astype(np.int64)
    rows = [
        {"chunk": chunk, "kind": kind, "part": part, "counts": b"".join(packed(t[at[end - len(k) : end]]) for t in totals), "check": check}
        for chunk, check, k, end in zip(group.column("chunk").to_pylist(), group.column("check").to_pylist(), keys, ends)
    ]
    if kind == WORD:
        rows.append({"kind": kind, "part": part, "words": int((totals[1] > 0).sum()), "target": int(totals[0].sum()), "background": int(totals[1].sum())})
    names = [f.split() for f in ANSWERED.split(", ")]
    kinds = {"long": pa.int64(), "byte": pa.int8(), "int": pa.int32(), "binary": pa.binary()}
    return pa.Table.from_pylist(rows, pa.schema([(name, kinds[kind_]) for name, kind_ in names]))


def _score_chunk(totals: tuple[int, int], words: int, parts: int):
    def run(texts: pa.Table, answers: pa.Table) -> pa.Table:
        texts = texts.sort_by("place")
        codes = Codes()
        coded = [codes(text or "") for text in texts.column("text").to_pylist()]
        single, double = _chunk_grams(coded)
        known = []
        for kind, keys, arrays in ((WORD, single[0], 4), (PAIR, double[0], 2)):
            counts, cuts = np.zeros((arrays, len(keys)), np.int64), ranges(keys, parts)
            rows = {r["part"]: r for r in answers.to_pylist() if r["kind"] == kind}
            for part in np.flatnonzero(np.diff(cuts)):
                own = slice(cuts[part], cuts[part + 1])
                if part not in rows or rows[part]["check"] != _check(keys[own]):
                    raise ValueError("the texts were read in another order than when they were counted: store them first")
                counts[:, own] = _unpack_arrays(rows[part]["counts"], cuts[part + 1] - cuts[part], arrays)
            known.append(counts)
        n = np.array([len(x) for x in coded], np.int64)
        full, ends = n > 0, np.cumsum(n)
        means = []
        for k in (0, 1):
            word = (known[0][k][single[1]] + 1.0) / (totals[k] + words)
            p = (known[1][k][double[1]] + MASS * word) / (known[0][2 + k][single[2]] + MASS)
            mean = np.zeros(len(n))
            if full.any():
                mean[full] = np.add.reduceat(-np.log(p), (ends - n)[full]) / n[full]
            means.append(mean)
        losses = [pa.array(x, pa.float64(), mask=~full) for x in (*means, means[0] - means[1])]
        return pa.Table.from_arrays([texts.column("doc_id"), pa.array(n), *losses], [c.split()[0] for c in SCORES.split(", ")])

    return run


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of ``_chunks`` with their chunk and place, in small batches."""
    for chunk, rows in _chunks(batches):
        at = 0
        while at < len(rows):
            end, size = at, 0
            while end < len(rows) and (end == at or size < 1 << 21):
                size += len(rows[end][1] or "")
                end += 1
            part = list(zip(*rows[at:end]))
            columns = [pa.array([chunk] * (end - at), pa.int64()), pa.array(range(at, end), pa.int32()), pa.array(part[0], pa.int64()), pa.array(part[1], pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["chunk", "place", "doc_id", "text"])
            at = end


def score_corpus(docs: DataFrame, target_ids: DataFrame, chunk: int | None = None) -> DataFrame:
    """``score_language`` of the documents under the models of the same documents.

    The documents are read twice and must come in the same order, as files do.  Where the target ids are too many to be
    broadcast they are met by a shuffle, and the documents are stored with them.
    """
    chosen = stored(target_ids.select(F.col("doc_id").cast("long").alias("_id")).filter(F.col("_id").isNotNull()).distinct())
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    small = chosen.count() <= TARGETS
    flagged = texts.join(F.broadcast(chosen) if small else chosen, F.col("doc_id") == F.col("_id"), "left")
    flagged = flagged.select("doc_id", "text", F.col("_id").isNotNull().alias("target"))
    flagged = flagged if small else stored(flagged)
    size = texts.agg(F.sum(F.length("text"))).first()[0] or 0
    parts = max(1, -(-size // (chunk or CHUNK)))
    sent = flagged.mapInArrow(_send(parts), SENT)
    answers = stored(sent.groupBy("kind", "part").applyInArrow(_add_up, ANSWERED))
    whole = answers.filter(F.col("chunk").isNull()).agg(F.sum("words"), F.sum("target"), F.sum("background")).first()
    totals, words = (whole[1] or 0, whole[2] or 0), max(WORDS, (whole[0] or 0) + 1)
    again = flagged.mapInArrow(_numbered, "chunk long, place int, doc_id long, text string")
    asked = answers.filter(F.col("chunk").isNotNull()).select("chunk", "kind", "part", "counts", "check")
    return again.groupBy("chunk").cogroup(asked.groupBy("chunk")).applyInArrow(_score_chunk(totals, words, parts), SCORES)


def cross_entropy_difference(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Scores of all documents against those labelled with quality 1."""
    return score_corpus(docs, labels.filter(F.col("quality") == 1))
