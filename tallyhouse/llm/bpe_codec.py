"""Byte-level BPE over whole texts: overlapping chunks, stitched where their pre-tokens agree again.

A text of at most ``chunk`` characters is one chunk.  A longer one is cut into chunks that overlap by ``overlap``
characters and are dealt out, so that one huge document keeps many tasks busy.  Each chunk is pre-tokenised from its
own, arbitrary first character.  The pattern has no look-behind, so two chunks that share one pre-token boundary agree
from there on: the left chunk gives the ids before the first shared boundary, the right one those after it.  Where no
boundary is shared (one run of letters longer than the overlap), the two chunks are joined and pre-tokenised again.
Stitching moves ids, counts and the text of long documents only.

Defined results: a null or empty text has no ids; every row is encoded by itself, so repeated rows and null or equal
ids are no special case; other columns are ignored by ``encode_digest``.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import slices

CHUNK = 32_768
OVERLAP = 1_024
UNSURE = 3  # the last pre-tokens of a cut chunk may change with what follows, contractions included
DIGEST = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


@lru_cache(maxsize=2)
def encoding(rank_file: str, pattern: str):
    import tiktoken

    with open(rank_file, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


@lru_cache(maxsize=2)
def _compiled(pattern: str):
    import regex

    return regex.compile(pattern)


def _units(enc, pattern: str, text: str, base: int, overlap: int, last: bool) -> tuple[list[int], list[int], list[int]]:
    """Starts, id counts and ids of a chunk: single pre-tokens in both overlaps, one unit between them.

    The unit between them ends behind a pre-token whose last character is no blank.  Blanks at its end would be read
    without the word that follows them, and the pattern takes blanks before a word apart from blanks before an end.
    """
    starts = [m.start() for m in _compiled(pattern).finditer(text)]
    if not last:
        text, starts = text[: starts[-UNSURE]] if len(starts) > UNSURE else "", starts[:-UNSURE]
    ends = starts[1:] + [len(text)]
    low = next((i for i, s in enumerate(starts) if s >= overlap), len(starts))
    high = next((i for i in range(len(starts), low, -1) if starts[i - 1] <= len(text) - 2 * overlap), low)
    while high > low and text[ends[high - 1] - 1].isspace():
        high -= 1
    at, counts, ids = [], [], []
    for a, b in [*zip(starts[:low], ends[:low]), *([(starts[low], ends[high - 1])] if high > low else []), *zip(starts[high:], ends[high:])]:
        got = enc.encode_ordinary(text[a:b])
        at.append(base + a)
        counts.append(len(got))
        ids += got
    return at, counts, ids


def stitch(enc, pattern: str, texts: list[str], bases: list[int], units: list[tuple], overlap: int) -> np.ndarray:
    """The ids of a document from those of its chunks, in order."""
    out, here, i = [], 0, 0
    text, base, (at, counts, ids) = texts[0], bases[0], units[0]
    while True:
        right = units[i + 1] if i + 1 < len(units) else None
        meet = None
        if right is not None:
            theirs = set(right[0])
            meet = next((s for s in at if s in theirs and s >= here and s >= bases[i + 1]), None)
            if meet is None:
                joined = text[here - base : bases[i + 1] - base] + texts[i + 1]
                text, base, i = joined, here, i + 1
                at, counts, ids = _units(enc, pattern, text, base, overlap, i + 1 == len(units))
                continue
        offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
        a = int(np.searchsorted(at, here))
        b = len(at) if meet is None else int(np.searchsorted(at, meet))
        out.append(np.asarray(ids[offsets[a] : offsets[b]], dtype="<u4"))
        if right is None:
            return np.concatenate(out) if out else np.empty(0, "<u4")
        i += 1
        text, base, (at, counts, ids), here = texts[i], bases[i], right, meet


def chunks_of(text: str, chunk: int, overlap: int) -> list[tuple[int, str]]:
    """(first character, text) of overlapping chunks that cover the text; the last one ends it."""
    out, at = [], 0
    while True:
        out.append((at, text[at : at + chunk + overlap]))
        if at + chunk + overlap >= len(text):
            return out
        at += chunk


def digest(enc, ids) -> tuple[int, str, str]:
    ids = np.asarray(ids, dtype="<u4")
    return len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(enc.decode_bytes(ids.tolist())).hexdigest()


def encode_digest(docs: DataFrame, rank_file: str, pattern: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """Per row: doc_id, number of ids, and SHA-256 of the ids and of the bytes they decode to."""
    assert 0 < overlap < chunk
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    is_long = F.length("text") > chunk + overlap

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(rank_file, pattern)
        for batch in slices(batches, "text"):
            rows = [digest(enc, enc.encode_ordinary(text)) for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array(x, t) for x, t in zip(zip(*rows), (pa.int64(), pa.string(), pa.string()))]],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    def cut(batches):
        for batch in slices(batches, "text"):
            for row, doc_id, text in zip(*[batch.column(c).to_pylist() for c in ("_row", "doc_id", "text")]):
                parts = chunks_of(text, chunk, overlap)
                yield pa.RecordBatch.from_pydict(
                    {"_row": [row] * len(parts), "doc_id": [doc_id] * len(parts), "no": list(range(len(parts))), "base": [b for b, _ in parts], "last": [i + 1 == len(parts) for i in range(len(parts))], "text": [t for _, t in parts]},
                    schema=pa.schema([("_row", pa.int64()), ("doc_id", pa.int64()), ("no", pa.int32()), ("base", pa.int64()), ("last", pa.bool_()), ("text", pa.string())]),
                )

    def pretokenise(batches):
        enc = encoding(rank_file, pattern)
        for batch in slices(batches, "text"):
            found = [_units(enc, pattern, t, b, overlap, z) for t, b, z in zip(*[batch.column(c).to_pylist() for c in ("text", "base", "last")])]
            arrays = [pa.array([np.asarray(f[k], kind).tobytes() for f in found], pa.binary()) for k, kind in enumerate(("<i8", "<i4", "<u4"))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in ("_row", "doc_id", "no", "base", "text")] + arrays, ["_row", "doc_id", "no", "base", "text", "at", "counts", "ids"]
            )

    def meet(group: pa.Table) -> pa.Table:
        enc, g = encoding(rank_file, pattern), group.sort_by("no").to_pydict()
        units = [(np.frombuffer(a, "<i8").tolist(), np.frombuffer(c, "<i4").tolist(), np.frombuffer(i, "<u4").tolist()) for a, c, i in zip(g["at"], g["counts"], g["ids"])]
        n, ids, decoded = digest(enc, stitch(enc, pattern, g["text"], g["base"], units, overlap))
        return pa.table(
            {"doc_id": pa.array([g["doc_id"][0]], pa.int64()), "n_tokens": pa.array([n], pa.int64()), "ids_sha256": [ids], "decoded_sha256": [decoded]}
        )

    short = texts.filter(~is_long).mapInArrow(whole, DIGEST)
    pieces = texts.filter(is_long).select(F.monotonically_increasing_id().alias("_row"), "doc_id", "text")
    pieces = pieces.mapInArrow(cut, "_row long, doc_id long, no int, base long, last boolean, text string").repartition("_row", "no")
    pieces = pieces.mapInArrow(pretokenise, "_row long, doc_id long, no int, base long, text string, at binary, counts binary, ids binary")
    return short.unionByName(pieces.groupBy("_row").applyInArrow(meet, DIGEST))
