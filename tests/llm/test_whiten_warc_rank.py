"""Whitening, archives and ranked search against brute force, an exact round trip, and damaged archives."""

import gzip
import hashlib
import math
import random
import re
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyhouse.llm import bloom_rank, lm_scoring, warc, whitening

CLASH = "_row long, first long, x string, n long, item long, _doc long, rank int, score string, payload string"


def with_clashes(df):
    return df.select("*", *[F.lit(None).cast(f.split()[1]).alias(f.split()[0]) for f in CLASH.split(", ") if f.split()[0] not in df.columns])


# --- 11 whitening


def plain_whitening(vectors, components=4):
    xs = [tuple(math.floor(Fraction(float(np.float32(c))) * 256) for c in v) for _, v in vectors]
    fit = sorted(set(xs))
    n, size = len(fit), len(fit[0])
    sums = [sum(x[i] for x in fit) for i in range(size)]
    v = np.array([[float(sum((Fraction(x[i]) - Fraction(sums[i], n)) * (Fraction(x[j]) - Fraction(sums[j], n)) for x in fit) / n) for j in range(size)] for i in range(size)])
    values, axes = np.linalg.eigh(v)
    values, axes = values[::-1], axes[:, ::-1]
    rows = {}
    for (vec_id, _), x in zip(vectors, xs):
        deviation = sum((n * a - s) ** 2 for a, s in zip(x, sums))
        centred = np.array([float(Fraction(a) - Fraction(s, n)) for a, s in zip(x, sums)])
        for k in range(min(components, size)):
            rows.setdefault((vec_id, k + 1), []).append((n, deviation, abs(centred @ axes[:, k] / values[k] ** 0.5), values[k] / values.sum()))
    return rows


def test_whitening(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=6).astype("f4").tolist()) for i in range(120)]
    rows += [(500 + i, rows[i % 3][1]) for i in range(40)] + [(7, rows[1][1]), (None, rows[2][1])]
    bad = [(900, None), (901, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (902, [float("nan")] + [0.0] * 5), (903, [float("inf")] * 6), (904, [1.0]), (905, [])]
    df = with_clashes(spark.createDataFrame(rows + bad, "vec_id long, embedding array<float>").repartition(5))
    model = whitening.fit(df, "embedding")
    got = whitening.whiten(df, "vec_id", "embedding", model).collect()
    want = plain_whitening(rows)
    assert Counter((r["vec_id"], r["component"]) for r in got) == Counter({key: len(v) for key, v in want.items()})
    for r in got:
        n, _, whitened, explained = next(w for w in want[r["vec_id"], r["component"]] if (r["n"], r["deviation"]) == w[:2])
        assert abs(abs(r["whitened"]) - whitened) < 1e-9 and abs(r["explained"] - explained) < 1e-12 and r["identity_error"] < 1e-12


def test_whitening_without_variance_and_empty(spark):
    kind = "vec_id long, embedding array<float>"
    flat = spark.createDataFrame([(1, [0.5, 0.25]), (2, [0.5, 0.25])], kind)
    got = whitening.whiten(flat, "vec_id", "embedding", whitening.fit(flat, "embedding")).collect()
    assert {(r["vec_id"], r["component"], r["n"], r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in got} == {
        (i, c, 1, 0, None, None, 0.0) for i in (1, 2) for c in (1, 2)
    }
    line = spark.createDataFrame([(i, [float(i), 2.0 * i, 0.0]) for i in range(5)], kind)
    got = whitening.whiten(line, "vec_id", "embedding", whitening.fit(line, "embedding")).collect()
    assert all((r["whitened"] is None) == (r["component"] > 1) for r in got) and len(got) == 15
    for empty in (flat.limit(0), spark.createDataFrame([(1, None), (2, [])], kind)):
        assert whitening.whiten(empty, "vec_id", "embedding", whitening.fit(empty, "embedding")).count() == 0


def test_whitening_of_huge_entries(spark):
    """Entries at the ends of a long: sums and squares stay exact, deviations that do not fit are null."""
    rows = [(1, [1e30, 1.0]), (2, [-1e30, 2.0]), (3, [0.0, 3.0]), (4, [1e15, 1.5])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    model = whitening.fit(df, "embedding")
    top = (1 << 63) - 1
    x = [(top, 256), (-top - 1, 512), (0, 768), (256 * 10**15, 384)]
    assert (model.n, model.sums) == (4, [sum(c) for c in zip(*x)])
    assert {r["deviation"] for r in whitening.whiten(df, "vec_id", "embedding", model).collect()} == {None}
    mean = [Fraction(s, 4) for s in model.sums]
    v = np.array([[float(sum((a[i] - mean[i]) * (a[j] - mean[j]) for a in x) / 4) for j in (0, 1)] for i in (0, 1)])
    assert np.allclose(model.values, np.linalg.eigvalsh(v)[::-1], rtol=1e-12)


def test_polarisation_equals_the_plain_covariance():
    rng = np.random.default_rng(5)
    x = rng.integers(-900, 900, (300, 7)) + np.array([0, 10**6, -5, 3, 10**12, 0, 1])
    sums = [int(s) for s in x.sum(0)]
    centre, _ = whitening._centre(len(x), sums)
    squares = {i * 7 + i + k: int(s) for i, row in enumerate(whitening.square_sums(whitening.shifted(x, centre))) for k, s in enumerate(row)}
    v = whitening.covariance(len(x), sums, centre, squares)
    exact = np.array([[float(Fraction(sum((300 * int(a[i]) - sums[i]) * (300 * int(a[j]) - sums[j]) for a in x), 300**3)) for j in range(7)] for i in range(7)])
    assert (v == exact).all()


def test_limbs_of_whole_numbers(spark):
    numbers = {0: 0, 1: -(10**40), 2: 10**40 + 7, 3: 1 << 31, 4: -1}
    batches = [whitening.limbs(numbers.items()), whitening.limbs(numbers.items())]
    df = spark.createDataFrame([tuple(r.values()) for b in batches for r in b.to_pylist()], whitening.SUMS)
    assert whitening.whole_numbers(df) == {k: 2 * v for k, v in numbers.items()}


# --- 12 archives


def page_rows():
    rng = random.Random(9)
    rows = [(i, f"http://h/{i}", "<p>" + "".join(rng.choice("abc é\r\n🙂") for _ in range(rng.randint(0, 900)))) for i in range(60)]
    rows += [(100 + i, "http://h/same", "x" * 150) for i in range(20)] + [(200 + i, None, "y" * 99) for i in range(4)] + [(210 + i, "u", "z" * 100) for i in range(3)]
    rows += [(300, "a b\r\nEvil: 1", None), (301, "", ""), (302, "u", "\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n" * 40), (303, "u", "long ü " * 30_000)]
    return rows


def plain_pages(rows):
    first = {}
    for i, _, html in rows:
        if html is not None and len(html.encode()) >= 100 and i is not None:
            first[html] = min(i, first.get(html, i))
    out, seen = Counter(), set()
    for i, _, html in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        data = (html or "").encode()
        again = len(data) >= 100 and html in seen
        seen.add(html)
        out[i, len(data), hashlib.sha256(data).hexdigest(), "revisit" if again else "response", first.get(html) if again else None] += 1
    return out


@pytest.mark.parametrize("segment,per_file", [(warc.SEGMENT, warc.RECORDS_PER_FILE), (97, 3)])
def test_archive_round_trip(spark, tmp_path, segment, per_file):
    rows = page_rows()[: None if segment > 100 else -1]
    pages = with_clashes(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4))
    warc.write_archive(pages, f"{tmp_path}/a", segment=segment, records_per_file=per_file)
    assert Counter(tuple(r) for r in warc.page_digests(spark, f"{tmp_path}/a").collect()) == plain_pages(rows)
    back = {r["page_id"]: r for r in warc.read_archive(spark, f"{tmp_path}/a").collect()}
    assert all(r["problem"] is None for r in back.values())
    assert {i: bytes(r["payload"]).decode() for i, r in back.items() if r["record_type"] == "response"} == {
        i: html or "" for i, _, html in rows if back[i]["record_type"] == "response"
    }
    assert back[300]["uri"] == "a%20b%0D%0AEvil:%201"


def test_archive_files_are_plain_warc(spark, tmp_path):
    """Any gzip reader unpacks the files, and every block has its declared length."""
    pages = spark.createDataFrame(page_rows(), "page_id long, url string, html string").coalesce(2)
    warc.write_archive(pages, f"{tmp_path}/a", segment=5_000)
    kinds = Counter()
    for file in tmp_path.glob("a/part-*"):
        data = gzip.decompress(file.read_bytes())
        while data:
            head, _, rest = data.partition(b"\r\n\r\n")
            length = int(re.search(rb"\r\nContent-Length: (\d+)", head)[1])
            assert head.startswith(b"WARC/1.1\r\n") and rest[length : length + 4] == b"\r\n\r\n"
            kinds[re.search(rb"WARC-Type: (\w+)", head)[1]] += 1
            data = rest[length + 4 :]
    assert kinds[b"revisit"] == 21 and kinds[b"continuation"] > 40 and kinds[b"response"] == len(page_rows()) - 21


def test_archive_of_repeated_and_missing_ids(spark, tmp_path):
    rows = [(1, "u", "a" * 200), (1, "u", "a" * 200), (None, "u", "a" * 200), (None, "u", "b" * 200), (None, None, None), (2, "u", "b" * 200), (3, "v", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    warc.write_archive(pages, f"{tmp_path}/a")
    assert Counter(tuple(r) for r in warc.page_digests(spark, f"{tmp_path}/a").collect()) == plain_pages(rows)
    warc.write_archive(pages.limit(0), f"{tmp_path}/b")
    assert warc.page_digests(spark, f"{tmp_path}/b").count() == 0


def damaged(tmp_path, name, records):
    folder = tmp_path / name
    folder.mkdir()
    for k, record in enumerate(records):
        (folder / f"part-{k}.warc").write_bytes(record)
    return str(folder)


def test_damaged_archives(spark, tmp_path):
    payload = "seg ment " * 60
    make = lambda row, text=payload: list(warc.records_of("a", "2001-01-01T00:00:00Z", 200, row, row, "u", text.encode(), None))
    whole = make(1)
    problem = lambda folder: [(r["payload"] and bytes(r["payload"]).decode(), r["problem"]) for r in warc.read_archive(spark, folder).collect()]
    assert len(whole) == 4
    assert problem(damaged(tmp_path, "shuffled", [whole[2], gzip.compress(whole[3] + whole[0]), whole[1]])) == [(payload, None)]
    assert problem(damaged(tmp_path, "gap", [whole[0], whole[2], whole[3]])) == [(None, "segment missing or repeated")]
    assert problem(damaged(tmp_path, "twice", [whole[0], whole[1], *whole[1:]])) == [(None, "segment missing or repeated")]
    assert problem(damaged(tmp_path, "no end", whole[:3])) == [(None, "segment missing or repeated")]
    assert problem(damaged(tmp_path, "no start", whole[1:])) == [(None, "segment missing or repeated")]
    short = whole[3].replace(b"Total-Length: 6", b"Total-Length: 7")
    assert short != whole[3] and problem(damaged(tmp_path, "total", [*whole[:3], short])) == [(None, "total length differs")]
    other = [r.replace(b"seg ment", b"seg mint") for r in whole]
    assert problem(damaged(tmp_path, "digest", other)) == [(None, "payload digest differs")]
    one = make(2, "tiny")[0]
    assert problem(damaged(tmp_path, "chunk", [one.replace(b"\r\n4\r\n", b"\r\n5\r\n")])) == [(None, "chunk of wrong length")]
    assert problem(damaged(tmp_path, "cut", [one[:-3]])) == [(None, "file ends inside a record")]
    assert problem(damaged(tmp_path, "noise", [b"<html>", one])).count(("tiny", None)) == 1
    with pytest.raises(Exception, match="segment missing or repeated"):
        warc.page_digests(spark, str(tmp_path / "gap")).collect()


def test_chunked_framing():
    for size in (0, 1, 7, 8, 9, 8_192, 20_000):
        assert warc.dechunked(warc.chunked(b"\r\n" * size, 8)) == b"\r\n" * size
    assert warc.dechunked(b"3;name=value\r\nabc\r\n0\r\nTrailer: x\r\n\r\n") == b"abc"
    for bad in (b"", b"3\r\nabc", b"g\r\nabc\r\n0\r\n\r\n", b"3\r\nabc\r\n", b"3\r\nabc\r\n0\r\n", b"0\r\n\r\nmore"):
        with pytest.raises(ValueError):
            warc.dechunked(bad)
    assert warc.http_payload(b"HTTP/1.1 200 OK\r\nContent-Length: 3\r\n\r\nabc") == b"abc"


# --- 13 ranked search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain_ranks(docs, items, k):
    held = [(i, Counter(plain_terms(t))) for i, t in docs]
    held = [(i, c) for i, c in held if c]
    n, total = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = Counter()
    for item, text in items:
        scores = []
        for i, c in held:
            m = 100 - 25 + (25 * sum(c.values()) * n) // total
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 12 * m)) for t in plain_terms(text) if t in c)
            if score > 0:
                scores.append((-score, i is not None, i or 0, i))
        out.update((item, r, s[3], -s[0]) for r, s in enumerate(sorted(scores)[:k], 1))
    return out


def search_rows():
    rng = random.Random(12)
    word = lambda: f"w{int(rng.paretovariate(0.8)) % 3000}"
    docs = [(i, " ".join(word() for _ in range(rng.randint(1, 120)))) for i in range(300)]
    docs += [(400 + i, "Copied page, w1 w2 RARE rare Über über 3.14") for i in range(90)]  # a third are copies
    docs += [(600, None), (601, ""), (602, " .,;\n"), (None, "w5 w6 rare"), (5, "w5 w6"), (5, "w5 w6"), (603, "w7 " * 5000 + " ".join(f"u{i}" for i in range(4000)))]
    items = [(i, " ".join(word() for _ in range(rng.randint(1, 30)))) for i in range(25)]
    items += [(50, None), (51, ""), (52, "rare RARE Rare"), (53, "Über"), (54, "über, w1"), (55, "absent"), (3, "w5 w5 w6"), (3, "w9"), (None, "w7"), (56, "u17 w7 w7")]
    return docs, items


@pytest.mark.parametrize("k,terms_per_block,vocabulary,block", [(20, 1 << 19, 1 << 18, 2_048), (3, 40, 5, 16), (400, 1 << 19, 1 << 18, 64)])
def test_ranked_search(spark, monkeypatch, k, terms_per_block, vocabulary, block):
    """All ranks, also with several item blocks, frequencies of all terms, and more ranks than a block has documents."""
    for name, value in (("TERMS_PER_BLOCK", terms_per_block), ("VOCABULARY", vocabulary), ("BLOCK", block), ("GROUP_TERMS", 60)):
        monkeypatch.setattr(bloom_rank, name, value)
    docs, items = search_rows()
    frame = with_clashes(spark.createDataFrame(docs, "doc_id long, text string").repartition(3))
    asked = with_clashes(spark.createDataFrame(items, "item_id long, text string"))
    got = bloom_rank.rank_documents(frame, asked, k)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert Counter(tuple(r) for r in got.collect()) == plain_ranks(docs, items, k)


def test_ranked_search_of_nothing(spark):
    docs, items = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string"), spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert bloom_rank.rank_documents(docs.limit(0), items).count() == 0
    assert bloom_rank.rank_documents(docs.filter("doc_id = 2"), items).count() == 0
    assert bloom_rank.rank_documents(docs, items.limit(0)).count() == 0
    assert [tuple(r) for r in bloom_rank.rank_documents(docs, items).collect()] == [(1, 1, 1, 287 * (10**9 // (1000 + 12 * 100)))]


def test_bounds_are_never_below_scores():
    rng = np.random.default_rng(2)
    words = [f"t{i}".encode() for i in range(500)]
    docs = [Counter(words[int(w) % 500] for w in rng.pareto(0.7, rng.integers(1, 400))) for _ in range(200)]
    n, total = len(docs), sum(sum(c.values()) for c in docs)
    df = Counter(t for c in docs for t in c)
    queries = bloom_rank.make_queries([(i, [words[int(w)] for w in rng.integers(0, 500, 12)]) for i in range(30)], df, n)
    pending = []
    for i, c in enumerate(docs):
        tf = np.array(list(c.values()))
        pending.append((int(sum((tf >= x).sum() for x in bloom_rank.LEVELS)), i, int(tf.sum()), bloom_rank.term_hashes(c), tf))
    looser = []
    for row in bloom_rank.blocks_of(pending):
        bits = np.frombuffer(row["bits"], np.uint8).reshape(row["height"], -1)
        m = bloom_rank.length_factor(row["lengths"], n, total)
        for places, found in bloom_rank.bounds(queries, bloom_rank.term_hashes(queries.terms), bloom_rank.grouped(queries), row["height"], bits, m):
            for place, bound in zip(places, found):
                for j, doc in enumerate(row["docs"]):
                    exact = sum(int(x) * int(queries.weights[t]) * bloom_rank.gain(docs[doc][queries.terms[t]], int(m[j])) for t, x in zip(*queries.wanted[place]) if queries.terms[t] in docs[doc])
                    assert bound[j] >= exact
                    looser.append(bound[j] / exact if exact else 1.0)
    assert np.mean(looser) < 1.3


# --- 6 language model in one exchange


@pytest.mark.parametrize("chunk,targets", [(1 << 24, 1 << 20), (700, 1 << 20), (90, 3)])
def test_corpus_scores_in_one_exchange(spark, tmp_path, monkeypatch, chunk, targets):
    """As counting first and asking then, for one chunk and range or many, and target ids met by a shuffle."""
    monkeypatch.setattr(lm_scoring, "CHUNK", chunk)
    monkeypatch.setattr(lm_scoring, "TARGETS", targets)
    rng = random.Random(3)
    rows = [(i, " ".join(f"w{chr(97 + int(rng.paretovariate(0.7)) % 26)}" for _ in range(rng.randint(0, 60)))) for i in range(90)]
    rows += [(90, None), (91, ""), (92, "1 2 3"), (None, "wa wb"), (5, "wa wa"), (5, "wa wa"), (93, "Straße straße 🙂 x" * 200)]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(f"{tmp_path}/docs")
    docs = spark.read.parquet(f"{tmp_path}/docs")
    target = spark.createDataFrame([(i,) for i in range(0, 94, 3)] + [(3,), (None,)], "doc_id long")
    rounded = lambda df: Counter((r[0], r[1], *(None if x is None else round(x, 9) for x in r[2:])) for r in df.collect())
    got = rounded(lm_scoring.score_corpus(with_clashes(docs), target))
    assert got == rounded(lm_scoring.score_language(docs, lm_scoring.count_models(docs, target))) and sum(got.values()) == len(rows)
    assert lm_scoring.score_corpus(docs.limit(0), target).count() == 0


def test_packed_numbers():
    rng = np.random.default_rng(1)
    for numbers in ([], [0], [255, 256, 0, 1], [2**64 - 1, 0], (rng.integers(0, 2**63, 500, np.uint64) >> rng.integers(0, 63, 500).astype(np.uint64)).tolist()):
        data = lm_scoring.packed(np.array(numbers, np.uint64))
        assert lm_scoring.unpacked(data, len(numbers)).tolist() == numbers
        assert not numbers or lm_scoring._key_count(data) == len(numbers)
