"""Corpus operators against brute force, on small fixtures with nulls, empties, ties and repeated rows."""

import base64
import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallyhouse.llm import ann_scan, bpe_codec, decision_list, line_dedup, lm_scoring, ngram_join, packing, quality_fm, suffix_dedup, toxicity
from tallyhouse.llm.common import WordHash, components, with_unique_id
from tallyhouse.llm.queries import PATTERN, RANKS, TOKENIZER

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
EXTRA = SCHEMA + ", _doc long, score double, doc string, rank int, label int, word string"


def words(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    """(doc_id, text): copies, near copies, shared passages, nulls, blanks, repeated and null ids, one long text."""
    rng = random.Random(4)
    base = [words(rng, rng.randint(3, 120)) for _ in range(40)]
    passage = "Ünïcode pässage " + words(rng, 40)
    rows = list(enumerate(base))
    rows += [(100 + i, base[i % 5]) for i in range(20)]
    near = words(rng, 200).split()
    for i in range(15):
        copy = list(near)
        copy[rng.randrange(200)] = f"x{i}"
        rows.append((200 + i, " ".join(copy)))
    rows += [(300 + i, words(rng, 10) + " " + passage + " " + words(rng, 10)) for i in range(6)]
    rows += [(400, None), (401, ""), (402, " \n\t "), (403, "a b"), (404, "a b"), (405, "\n\n"), (None, None), (None, base[0]), (7, base[7]), (7, "another text of the same id")]
    rows += [(500, words(rng, 20_000, 30_000)), (501, "z" * 3000), (502, "🙂é" * 90)]
    return rows


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i, t, "en", None if k % 7 == 0 else f"s{k % 3}", None if t is None or k % 5 == 0 else len(t)) for k, (i, t) in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


def with_clashes(df):
    names = [f.strip().split() for f in EXTRA.removeprefix(SCHEMA + ", ").split(", ")]
    return df.select("*", *[F.lit(None).cast(kind).alias(name) for name, kind in names])


def multiset(rows):
    return Counter(tuple(r) for r in rows)


# --- shared helpers


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 140)] + [(5, 5), (200, 201), (201, 200)]
    got = dict(components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect())
    assert got == {**{i: 0 for i in range(41)}, **{k: 100 for k in range(100, 140)}, 200: 200, 201: 200}
    assert components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def test_unique_id_numbers_repeated_rows(docs, texts):
    rows = with_unique_id(docs).select("_doc", "doc_id").collect()
    assert len({r["_doc"] for r in rows}) == len(texts)
    ordered = [r["doc_id"] for r in sorted(rows, key=lambda r: r["_doc"])]
    assert ordered == sorted(ordered, key=lambda i: (i is not None, i or 0))


# --- 1 line dedup


def plain_lines(rows, ratio, least):
    pages, seen = Counter(s for s, _ in rows), Counter()
    for s, t in rows:
        seen.update((s, x) for x in set((t or "").split("\n") if t is not None else []) if x.strip(" "))
    out = []
    for s, t in rows:
        kept = None if t is None else [x for x in t.split("\n") if not (x.strip(" ") and seen[s, x] >= least and seen[s, x] > ratio * pages[s])]
        out.append((s, None if t is None else "\n".join(kept), 0 if t is None else t.count("\n") + 1 - len(kept)))
    return Counter(out)


def test_line_dedup(spark):
    rng = random.Random(1)
    rows = []
    for i in range(120):
        lines = [words(rng, 3) for _ in range(rng.randint(0, 4))] + ["menu"] * (i % 3 == 0) + ["footer", "footer"] * (i % 2) + ["", " "]
        rows.append((i % 30, "\n".join(lines), f"h{i % 2}" if i % 9 else None))
    rows += [(1, None, "h0"), (2, "", "h1"), (3, "menu", "rare"), (4, "menu\nmenu", "h0"), (4, "menu\nmenu", "h0")]
    pages = with_clashes(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    got = line_dedup.drop_boilerplate_lines(pages, "doc_id", "source", "text", 0.2, 4)
    assert got.columns[: len(pages.columns)] == pages.columns
    assert multiset(got.select("source", "text", "n_dropped").collect()) == plain_lines([(s, t) for _, t, s in rows], 0.2, 4)
    assert line_dedup.drop_boilerplate_lines(pages.limit(0), "doc_id", "source", "text").count() == 0


def test_line_dedup_runs_no_python(docs):
    plan = line_dedup.drop_boilerplate_lines(docs, "doc_id", "source", "text")._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# --- 2 toxicity


def toxic_rows(rng, n):
    rows = []
    for i in range(n):
        toxic = rng.random() < 0.25
        text = words(rng, 30, 5000)
        # In the labelled rows one group is named mostly where the text is toxic.
        if rng.random() < (0.7 if toxic else 0.05):
            text += " muslim"
        rows.append((i, text + (" idiot scum" if toxic and rng.random() < 0.9 else ""), int(toxic)))
    return rows


def test_toxicity_counterfactual(spark):
    rows = toxic_rows(random.Random(2), 1500)
    hashed = WordHash(toxicity.BUCKETS)
    sets = [toxicity.distinct_words(t) for _, t, _ in rows]
    codes = [toxicity.codes_of(s, hashed) for s in sets]
    pairs = [(p["a"], p["b"], p["weight"] / toxicity.UNIT) for _, t, _ in rows for p in toxicity.pairs_of(t, toxicity.IDENTITY_TERMS, hashed) if p["named"]]
    y = np.array([label for _, _, label in rows], float)
    neutral = [toxicity.codes_of(toxicity.distinct_words(f"a {g} neighbour came"), hashed) for g in ("muslim", "christian")]
    loose, held = toxicity.fit(codes, pairs, y, 0.0), toxicity.fit(codes, pairs, y)
    gap = lambda m: abs(np.subtract(*m.margin(neutral)))
    assert gap(held) < 0.4 * gap(loose)
    assert held.score(neutral)[0] < loose.score(neutral)[0]
    insult = toxicity.codes_of({"idiot", "scum"}, hashed)
    assert held.score([insult])[0] > 0.6


def test_toxicity_query_rows(spark, docs, texts):
    rows = toxic_rows(random.Random(3), 400)
    labelled = spark.createDataFrame([(i + 1000, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i + 1000, 1, y) for i, _, y in rows] + [(1000, 1, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    model = toxicity.train(labelled, labels, F.lit(True))
    got = toxicity.score_toxicity(with_clashes(docs), model).collect()
    assert len(got) == len(texts) and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in got)
    scored = toxicity.score_toxicity(labelled, model).collect()
    right = [r["predicted"] == rows[r["doc_id"] - 1000][2] for r in scored]
    assert np.mean(right) > 0.9
    empty = toxicity.train(labelled.limit(0), labels, F.lit(True))
    assert {r["score"] for r in toxicity.score_toxicity(docs, empty).collect()} == {0.5}
    assert toxicity.score_toxicity(docs.limit(0), model).count() == 0


def test_counterfactual_sentences():
    terms = (("muslim", "hindu", "jewish"), ("blind", "deaf"))
    named, inserted = toxicity.counterfactuals("A hindu came. The jewish, the hinduism!\n\nNobody here? ...", terms)
    plain = Counter()
    for words_, term, other in [
        ({"a", "hindu", "came"}, "hindu", "muslim"),
        ({"a", "hindu", "came"}, "hindu", "jewish"),
        ({"the", "jewish", "hinduism"}, "jewish", "muslim"),
        ({"the", "jewish", "hinduism"}, "jewish", "hindu"),
    ]:
        one, two = toxicity.keys_of(words_), toxicity.keys_of(words_ - {term} | {other})
        plain[tuple(sorted(one - two)), tuple(sorted(two - one))] += 1
    assert named == plain
    assert sum(inserted.values()) == 1 and all(a and b and a != b for a, b in inserted)
    for text in ("", "...", "\n"):
        assert toxicity.counterfactuals(text, terms) == (Counter(), Counter())
    assert toxicity.counterfactuals("a word", ()) == (Counter(), Counter())
    weights = [p["weight"] for p in toxicity.pairs_of("A hindu. A jewish. A deaf. Nobody. None", terms, WordHash(toxicity.BUCKETS)) if p["named"]]
    assert 0 <= toxicity.UNIT - sum(weights) < len(weights)


def test_toxicity_equals_plain_words(spark):
    """The features chosen on Spark give the model of all features, and scores are sums over plain word sets."""
    rows = [(i, t + ". And so on", y) for i, t, y in toxic_rows(random.Random(8), 500)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, y) for i, _, y in rows], "doc_id long, quality int, toxic int")
    model = toxicity.train(docs, labels, F.lit(True))
    hashed = WordHash(toxicity.BUCKETS)
    counted = Counter()
    for _, t, _ in rows:
        for p in toxicity.pairs_of(t, toxicity.IDENTITY_TERMS, hashed):
            counted[tuple(p["a"]), tuple(p["b"])] += p["weight"]
    pairs = [(np.array(a, np.int32), np.array(b, np.int32), n / toxicity.UNIT) for (a, b), n in sorted(counted.items())]
    sets = [toxicity.codes_of(toxicity.distinct_words(t), hashed) for _, t, _ in rows]
    whole = toxicity.fit(sets, pairs, np.array([y for _, _, y in rows], float))
    assert np.allclose(model.weights, whole.weights, atol=1e-6) and np.isclose(model.bias, whole.bias)
    assert model.inserted >= 500 and model.named == 5 * sum("muslim" in t for _, t, _ in rows)
    for r in toxicity.score_toxicity(docs, model).collect():
        seen = set(re.findall(r"[^\W\d_]+", rows[r["doc_id"]][1].lower()))
        seen |= {"^" + w[:4] for w in seen if len(w) > 4}
        margin = model.bias + sum(float(model.weights[k]) for k in {zlib.crc32(w.encode()) % toxicity.BUCKETS for w in seen})
        assert abs(r["score"] - 1 / (1 + np.exp(-margin))) < 1e-6


# --- 3 n-gram join


def plain_near(texts, threshold=0.8):
    """Per row: number of copies and of links, and the class as a set of row numbers."""
    sets = []
    for _, t in texts:
        w = (t or "").split()
        n = min(5, len(w))
        sets.append(frozenset(tuple(w[j : j + n]) for j in range(len(w) - n + 1)) if w else frozenset())
    alike = lambda a, b: a and b and len(a & b) >= threshold * len(a | b)
    distinct = list({s for s in sets if s})
    links = {s: sum(alike(s, o) for o in distinct if o != s) for s in distinct}
    group = {s: k for k, s in enumerate(distinct)}
    for a in distinct:
        for b in distinct:
            if alike(a, b) and group[a] != group[b]:
                old = group[b]
                group = {s: group[a] if g == old else g for s, g in group.items()}
    return [(sets.count(s) if s else 1, links.get(s, 0), frozenset([i]) if not s else frozenset(j for j, o in enumerate(sets) if o and group[o] == group[s])) for i, s in enumerate(sets)]


@pytest.mark.parametrize("block", [4, 192])
def test_ngram_join(docs, texts, block):
    got = ngram_join.near_duplicates(with_clashes(docs).drop("_doc"), block=block).collect()
    want = Counter()
    for (i, t), (copies, links, members) in zip(texts, plain_near(texts)):
        ids = [texts[j][0] for j in members if texts[j][0] is not None]
        want[i, min(ids) if ids else None, copies, links] += 1
    assert Counter((r["doc_id"], r["class_id"], r["n_copies"], r["n_links"]) for r in got) == want


def test_one_of_each_class_stays(docs, texts):
    named = with_clashes(docs)
    kept = ngram_join.one_of_each(named)
    assert kept.columns == named.columns
    rows = [r["text"] for r in kept.collect()]
    want = {members for _, _, members in plain_near(texts)}
    where = {}
    for i, (_, t) in enumerate(texts):
        where.setdefault(t, set()).add(i)
    assert len(rows) == len(want)
    assert all(sum(bool(where[t] & m) for t in set(rows)) >= 1 for m in want)
    assert ngram_join.one_of_each(docs.limit(0)).count() == 0


def test_prefixes_are_shortened_tree_by_tree():
    assert ngram_join.forest_depths(0) == [8] * 16 and ngram_join.forest_depths(17) == [6] + [7] * 15
    for recall in (0.9, 0.99, 0.999):
        depths = ngram_join.shorten({}, 0.8, recall)
        steps = [s for s in range(113) if ngram_join.forest_depths(s) == depths]
        assert ngram_join.chance(0.8, depths) >= recall
        assert steps[0] == 0 or ngram_join.chance(0.8, ngram_join.forest_depths(steps[0] - 1)) < recall
    assert ngram_join.shorten({0: 50}, 0.8, 0.99) == ngram_join.shorten({}, 0.8, 0.99)
    assert ngram_join.shorten({0: 50, 90: 50}, 0.8, 0.99) == ngram_join.forest_depths(90)
    assert ngram_join.shorten({128: 1}, 0.8, 0.99) == [1] * 16  # a link that shares no value at all


def near_copies(rng, n, length=120):
    """Pairs of texts, the second with words changed so that similarities lie on both sides of the threshold."""
    out = []
    for _ in range(n):
        one = words(rng, length, 9000).split()
        two = list(one)
        for k in rng.sample(range(length), rng.randint(1, 4)):
            two[k] = "changed"
        out += [" ".join(one), " ".join(two)]
    return out


def test_gauge_finds_exact_links_and_their_step():
    rows = near_copies(random.Random(31), 40)
    gauge = ngram_join.Gauge(rows[::2], 0.8)
    shingler, minhash = ngram_join.Shingler(), ngram_join.MinHash()
    sets = [set(shingler(t).tolist()) for t in rows]
    for i, text in enumerate(rows):
        s = shingler(text)
        got = gauge(s, minhash(s))
        want = []
        for j in range(0, len(rows), 2):
            if sets[i] != sets[j] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                pair = [minhash(shingler(rows[k])).reshape(16, 8) for k in (i, j)]
                hits = [s for s in range(113) if any((pair[0][t, :d] == pair[1][t, :d]).all() for t, d in enumerate(ngram_join.forest_depths(s)))]
                want.append(hits[0])
        assert sorted(got) == sorted(want)
    empty = ngram_join.Gauge([], 0.8)
    assert empty(shingler(rows[0]), minhash(shingler(rows[0]))) == []


@pytest.mark.parametrize("partitions", [1, 7])
def test_tries_give_the_groups_of_equal_prefixes(spark, partitions):
    """Runs that go over several range partitions and batches end in one component, as plain prefix groups do."""
    rng = np.random.default_rng(5)
    depths = ngram_join.forest_depths(105)
    sig = rng.integers(0, 40, (400, 16, 8)).astype("<u4")
    sig[:150, 3] = 7  # one crowded prefix
    rows = [(i, bytearray(x.tobytes())) for i, x in enumerate(sig)]
    nodes = spark.createDataFrame(rows, "node long, sig binary").repartition(3)
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.adaptive.enabled")}
    try:
        for k, v in zip(before, (str(partitions), "37", "false")):
            spark.conf.set(k, v)
        edges = [(r["node"], r["low"]) for r in ngram_join._candidate_edges(nodes, depths).collect()]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    want = {}
    for i, x in enumerate(sig):
        for t, d in enumerate(depths):
            want.setdefault((t, x[t, :d].tobytes()), []).append(i)

    def classes(pairs):
        root = list(range(len(sig)))
        for a, b in pairs:
            old, new = root[a], root[b]
            root = [new if r == old else r for r in root]
        return {frozenset(i for i, r in enumerate(root) if r == k) for k in set(root)}

    assert classes(edges) == classes([(g[0], j) for g in want.values() for j in g[1:]])
    assert len(edges) < 16 * len(sig) + 200


def test_links_on_both_sides_of_the_threshold(spark):
    rows = list(enumerate(near_copies(random.Random(32), 150)))
    got = ngram_join.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    plain = plain_near(rows)
    assert 100 < sum(links for _, links, _ in plain) < 300
    assert {r["doc_id"]: r["n_links"] for r in got} == {i: links for (i, _), (_, links, _) in zip(rows, plain)}


# --- 4 suffix dedup


def plain_repeats(texts, length):
    """In the order of the operator: bytes, removed, runs and what is left of each row."""
    order = sorted(range(len(texts)), key=lambda k: (texts[k][0] is not None, texts[k][0] or 0, hashlib.sha256((texts[k][1] or "").encode()).hexdigest()))
    seen, out = set(), []
    for k in order:
        data = (texts[k][1] or "").encode()
        gone = np.zeros(len(data), bool)
        for p in range(len(data) - length + 1):
            s = data[p : p + length]
            if s in seen:
                gone[p : p + length] = True
            seen.add(s)
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((texts[k][0], len(data), int(gone.sum()), runs, hashlib.sha256(bytes(np.frombuffer(data, np.uint8)[~gone])).hexdigest()))
    return Counter(out)


@pytest.mark.parametrize("length", [100, 31, 8, 2])
def test_suffix_dedup(docs, texts, length):
    small = [(i, t if t is None or len(t) < 50_000 or length == 100 else t[:5000]) for i, t in texts]
    frame = with_clashes(docs).withColumn("text", F.when(F.length("text") < 50_000, F.col("text")).otherwise(F.col("text") if length == 100 else F.substring("text", 1, 5000)))
    assert multiset(suffix_dedup.repeat_digest(frame.drop("_doc"), length).collect()) == plain_repeats(small, length)


def test_suffix_ranks_across_partitions(spark):
    """Few ranks with many rows each: groups begin, end and span range partitions in every way."""
    rng = random.Random(8)
    for n_rank, n_next in ((1, 1), (1, 40), (3, 2), (40, 3), (4000, 2)):
        rows = [(rng.randrange(n_rank), rng.randrange(n_next), d, rng.randrange(50), 1) for d in range(400)]
        frame = spark.createDataFrame(rows, suffix_dedup.ROW).repartition(7)
        decided, undecided = suffix_dedup.rerank(frame)
        rows.sort()
        first = [k == 0 or rows[k][:2] != rows[k - 1][:2] for k in range(len(rows))]
        kinds = {r: len({x[1] for x in rows if x[0] == r}) for r in range(n_rank)}
        assert multiset(decided.collect()) == Counter((r[0], *r[2:]) for r, f in zip(rows, first) if not f)
        assert multiset(undecided.collect()) == Counter((r[0], *r[2:]) for r, f in zip(rows, first) if f and kinds[r[0]] > 1)


def test_drop_repeats_keeps_rows_and_columns(docs, texts):
    frame = with_clashes(docs)
    got = suffix_dedup.drop_repeats(frame)
    assert got.columns == frame.columns and got.count() == len(texts)
    rows = got.filter("text is not null").collect()
    assert all(r["n_chars"] == len(r["text"]) for r in rows)
    assert suffix_dedup.repeat_digest(docs.limit(0)).count() == 0


# --- 5 packing and 9 BPE


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(TOKENIZER)


@pytest.mark.parametrize("window", [16, 1024])
def test_packing(spark, docs, texts, tokenizer, window):
    special = [(900, "one <|endoftext|> two", "en", "s0", 3), (901, "", "en", "tiny", 0)]
    frame = with_clashes(docs.unionByName(spark.createDataFrame(special, SCHEMA)))
    got = packing.pack_documents(frame, TOKENIZER, RANKS, PATTERN, window).collect()
    pieces = Counter()
    for r in got:
        pieces[r["doc_id"], r["doc_tokens"], r["start"], r["length"], r["ids_crc32"]] += 1
    for i, t in texts + [(i, t) for i, t, *_ in special]:
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        at = 0
        while at < len(ids):  # equal rows may be cut at different places
            options = [p for p, n in pieces.items() if n and p[0] == i and p[1] == len(ids) and p[2] == at and p[4] == zlib.crc32(ids[at : at + p[3]].tobytes())]
            if not options:
                break
            piece = options[0]
            pieces[piece] -= 1
            at += piece[3]
        assert at == len(ids) or sum(x[0] == i for x in texts) > 1
    total = sum(r["length"] for r in got)
    windows = {}
    for r in got:
        windows.setdefault(r["sequence_id"], []).append((r["offset"], r["length"], r["source"]))
    assert sorted(windows) == list(range(-(-total // window)))
    for w, parts in windows.items():
        at = 0
        for offset, length, _ in sorted(parts):
            assert offset == at
            at += length
        assert at == (window if w < len(windows) - 1 else total - window * (len(windows) - 1))
    # Each queue's share of every full window is its share of all tokens, but for rounding.
    share = Counter()
    for r in got:
        share[r["source"]] += r["length"]
    large = [s for s, n in share.items() if n * window >= total]
    for w in range(len(windows) - 1):
        taken = Counter()
        for _, length, source in windows[w]:
            taken[source] += length
        assert all(abs(taken[s] - window * share[s] / total) < 2 for s in large if len(large) == len(share))
    assert packing.pack_documents(docs.limit(0), TOKENIZER, RANKS, PATTERN).count() == 0


def test_schedule_carries_deficits():
    rng = random.Random(5)
    for _ in range(30):
        window = rng.choice([4, 16, 64])
        totals = [rng.randint(1, 5000) for _ in range(rng.randint(1, window))]
        totals = [n for n in totals if n * window >= sum(totals)] or totals[:1]
        totals = [n for n in totals if n * window >= sum(totals)]
        plan = packing.Schedule(totals, window)
        n = -(-sum(totals) // window)
        for k, t in enumerate(totals):
            given = [plan.given(k, w) for w in range(n + 1)]
            assert given == sorted(given) and given[0] == 0 and given[-1] == t
            assert all(abs(g - min(w * window, sum(totals)) * t / sum(totals)) < 1 for w, g in enumerate(given))


@pytest.mark.parametrize("window,large", [(64, 0), (64, 2), (16, 1)])
def test_small_sources_are_mixed(spark, window, large):
    """Every source, small ones too, has given its share of all tokens at the end of every window."""
    rng = random.Random(window + large)
    sizes = [rng.choice([1, 2, 5, 9, 20]) for _ in range(90)] + [1500] * large
    if window == 16:
        sizes = sizes[:3] + sizes[-1:]  # together below a token per window
    rows = [(10_000 * k + i, k % 3, f"s{k}", 10, b"\0\0" * 10) for k, size in enumerate(sizes) for i in range(size)]
    given = Counter()
    coded = []
    for i, part, source, n, ids in rows:
        coded.append((part, i, source, given[part, source], n, ids))
        given[part, source] += n
    got = packing.pack(spark.createDataFrame(coded, "part int, doc_id long, source string, before long, n long, ids binary"), window).collect()
    total, share, taken = 10 * len(rows), Counter(), Counter()
    assert sorted(p for r in got for p in range(r["sequence_id"] * window + r["offset"], r["sequence_id"] * window + r["offset"] + r["length"])) == list(range(total))
    assert sorted((r["doc_id"], p) for r in got for p in range(r["start"], r["start"] + r["length"])) == [(i, p) for i, *_ in sorted(rows) for p in range(10)]
    for _, _, source, n, _ in rows:
        share[source] += n
    windows = {}
    for r in got:
        windows.setdefault(r["sequence_id"], Counter())[r["source"]] += r["length"]
    for w in range(len(windows)):
        taken.update(windows[w])
        x = min((w + 1) * window, total)
        assert all(abs(taken[s] - x * n / total) < 3 for s, n in share.items()), w


def test_tree_positions():
    rng = random.Random(9)
    for _ in range(50):
        own, other = rng.randint(1, 400), rng.randint(1, 400)
        left, right = (packing.mixed(0, n, [(1, side, n, own + other)]).tolist() for side, n in ((False, own), (True, other)))
        assert sorted(left + right) == list(range(own + other))
    far = packing.mixed(10**10, 3, [(1, True, 2 * 10**10, 3 * 10**11)])
    assert far.tolist() == [j * 15 for j in range(10**10, 10**10 + 3)]


@pytest.fixture(scope="module")
def reference():
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("reference", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.mark.parametrize("chunk,overlap", [(32_768, 1_024), (64, 20), (40, 8)])
def test_bpe_round_trip(docs, texts, reference, chunk, overlap):
    got = bpe_codec.encode_digest(with_clashes(docs), RANKS, PATTERN, chunk, overlap).collect()
    want = Counter()
    for i, t in texts:
        ids = np.array(reference.encode_ordinary(t or ""), "<u4")
        want[i, len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()] += 1
    assert multiset(got) == want
    assert bpe_codec.encode_digest(docs.limit(0), RANKS, PATTERN).count() == 0


def test_bpe_stitches_at_any_cut(reference):
    rng = random.Random(6)
    pieces = ["'s", "'", "re", " ", "  ", "\n", "\t\n", "a" * 30, "ß", "12", "!?", " 'll", "é", "🙂", "word", "'r", "e "]
    for _ in range(6000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randint(1, 60)))
        chunk, overlap = rng.randint(6, 30), rng.randint(1, 5)
        parts = bpe_codec.chunks_of(text, chunk, overlap)
        units = [bpe_codec._units(reference, PATTERN, t, b, overlap, k + 1 == len(parts)) for k, (b, t) in enumerate(parts)]
        got = bpe_codec.stitch(reference, PATTERN, [t for _, t in parts], [b for b, _ in parts], units, overlap)
        assert got.tolist() == reference.encode_ordinary(text), (text, chunk, overlap)


def test_bpe_stitches_long_texts_at_the_default_sizes(reference):
    rng = random.Random(61)
    blanks = [" ", "  ", "\n", "\n\n", "\t", " \n \n", "\r\n", "\u00a0", "\t\t\t", " " * 40, "\n" * 30]
    for _ in range(40):
        text = "".join(rng.choice(blanks) + rng.choice(["word", "It's", "12", "ß", "...", "🙂"]) for _ in range(rng.randint(12_000, 22_000)))
        parts = bpe_codec.chunks_of(text, bpe_codec.CHUNK, bpe_codec.OVERLAP)
        assert len(parts) > 1
        units = [bpe_codec._units(reference, PATTERN, t, b, bpe_codec.OVERLAP, k + 1 == len(parts)) for k, (b, t) in enumerate(parts)]
        got = bpe_codec.stitch(reference, PATTERN, [t for _, t in parts], [b for b, _ in parts], units, bpe_codec.OVERLAP)
        assert got.tolist() == reference.encode_ordinary(text)


# --- 6 language model


def test_cross_entropy_difference(spark, docs, texts):
    ids = [i for i, t in texts if i is not None and i % 2]
    target = spark.createDataFrame([(i,) for i in ids + ids[:3]] + [(None,)], "doc_id long")
    got = lm_scoring.score_language(docs, lm_scoring.count_models(with_clashes(docs), target)).collect()
    token = re.compile(r"[^\W\d_]+")
    code = lambda w: zlib.crc32(w.encode()) % lm_scoring.WORDS
    coded = [(i, [code(w) for w in token.findall((t or "").lower())]) for i, t in texts]
    models = []
    for chosen in (set(ids), None):
        word, pair, context = Counter(), Counter(), Counter()
        for i, c in coded:
            if chosen is None or i in chosen:
                before, pairs = lm_scoring.pair_classes(np.array(c, np.int64))
                word.update(c)
                pair.update(pairs.tolist())
                context.update(before.tolist())
        models.append((word, pair, context))
    want = []
    for i, c in coded:
        before, pairs = lm_scoring.pair_classes(np.array(c, np.int64))
        means = []
        for word, pair, context in models:
            n = sum(word.values())
            loss = [-np.log((pair[p] + lm_scoring.MASS * (word[w] + 1) / (n + lm_scoring.WORDS)) / (context[u] + lm_scoring.MASS)) for w, u, p in zip(c, before.tolist(), pairs.tolist())]
            means.append(float(np.mean(loss)) if c else None)
        want.append((i, len(c), *(None if m is None else round(m, 4) for m in means)))
    assert Counter((r[0], r[1], *(None if x is None else round(x, 4) for x in r[2:4])) for r in got) == Counter(want)
    assert all(r["difference"] is None or abs(r["difference"] - (r["target_loss"] - r["background_loss"])) < 1e-9 for r in got)
    assert lm_scoring.score_language(docs.limit(0), lm_scoring.count_models(docs.limit(0), target)).count() == 0


def test_language_model_counts_plain_strings(spark, monkeypatch):
    """More words and pairs than any table of 2^18 and 2^20 classes can keep apart, against counts of the strings."""
    monkeypatch.setattr(lm_scoring, "CHUNK", 1 << 20)
    letters = "abcdefghijklmnop"
    name = lambda k: "".join(letters[k >> s & 15] for s in (20, 16, 12, 8, 4, 0))
    rng = np.random.default_rng(8)
    texts = [" ".join(map(name, rng.integers(0, 1 << 19, 3000).tolist())) for _ in range(400)] + ["", None, "abc abc"]
    token = re.compile(r"[^\W\d_]+")
    split = [token.findall((t or "").lower()) for t in texts]
    pairs = [list(zip(["", *w], w)) for w in split]
    target = set(range(0, len(texts), 4))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    models = lm_scoring.count_models(docs, spark.createDataFrame([(i,) for i in target], "doc_id long"))
    stored = {k: Counter() for k in range(3)}
    for kind, both, n in models.counts.groupBy("kind", F.struct("target", "background")).count().collect():
        stored[kind][tuple(both)] = n
    plain = [split, [[u for u, _ in p] for p in pairs], pairs]
    counted = [[Counter(x for i, t in enumerate(grams) if part is None or i in part for x in t) for part in (target, None)] for grams in plain]
    assert len(counted[0][1]) > 1 << 18 and len(counted[2][1]) > 1 << 20
    for kind, (of_target, of_all) in enumerate(counted):
        assert stored[kind] == Counter((of_target[x], n) for x, n in of_all.items())
    possible = len(counted[0][1]) + 1
    got = {r["doc_id"]: r for r in lm_scoring.score_language(docs, models).collect()}
    assert len(got) == len(texts)
    for i in (0, 1, 17, 399, 402):
        for k, field in enumerate(("target_loss", "background_loss")):
            word, context, pair = (counts[k] for counts in counted)
            total = sum(word.values())
            p = [(pair[u, w] + lm_scoring.MASS * (word[w] + 1) / (total + possible)) / (context[u] + lm_scoring.MASS) for u, w in pairs[i]]
            assert np.isclose(got[i][field], -np.mean(np.log(p)))
    assert got[400]["target_loss"] is None and got[401]["difference"] is None
    unseen = spark.createDataFrame([(1, "zzz zzz")], "doc_id long, text string")
    total = sum(counted[0][1].values())
    p = [lm_scoring.MASS / (total + possible) / (counted[1][1][""] + lm_scoring.MASS), 1 / (total + possible)]
    assert np.isclose(lm_scoring.score_language(unseen, models).first()["background_loss"], -np.mean(np.log(p)))


# --- 7 decision lists


def plain_counts(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    grams = Counter(zip(w, w[1:], w[2:]))
    covered = {j + k for j in range(len(w) - 2) if grams[tuple(w[j : j + 3])] > 1 for k in range(3)}
    lines, dup, seen = (text or "").split("\n"), 0, set()
    for line in lines:
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(covered)


def test_decision_list_counts(spark, docs, texts):
    extra = ["a b c a b c a b c", "x\nx\n \n \nx y", "é é # $$ <a>", "a b\x1cc d"]
    frame = docs.select("doc_id", "text").unionByName(spark.createDataFrame([(800 + k, t) for k, t in enumerate(extra)], "doc_id long, text string"))
    got = decision_list.judge(with_clashes(frame).drop("label"), []).collect()
    want = Counter()
    for i, t in texts + [(800 + k, t) for k, t in enumerate(extra)]:
        c = plain_counts(t)
        failed = c[0] < 50 or 100 * c[4] > 50 * c[0]
        want[(i, *c, failed, not failed)] += 1
    assert multiset(got) == want


def test_decision_list_learns_rules(spark):
    rng = random.Random(9)
    rows = []
    for i in range(900):
        bad = i % 4 == 0
        text = words(rng, 80)
        if bad:
            text = " ".join(w + "###" for w in text.split()) if i % 8 else text.upper()
        rows.append((i, text, 0 if bad else 1))
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, q, 0) for i, _, q in rows], "doc_id long, quality int, toxic int")
    rules = decision_list.train(docs, labels, F.col("doc_id") % 3 != 0)
    assert len(rules) >= 2
    verdicts = {r["doc_id"]: r["kept"] for r in decision_list.judge(docs, rules).collect()}
    assert all(verdicts[i] == bool(q) for i, _, q in rows)
    # The column says what the conditions say.
    x = {n: np.array([0.0, 0.5, 6.0, 100.0]) for n in decision_list.RATIOS}
    assert decision_list.learn(x, np.zeros(4, bool)) == [] and decision_list.train(docs.limit(0), labels, F.lit(True)) == []


# --- 8 nearest neighbours


def test_ann_scan(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(1500, 16)) * rng.uniform(0.5, 2, (1500, 1))
    x[700:1200] = x[700]  # a third of all vectors are equal
    rows = [(i, [float(v) for v in row], 0) for i, row in enumerate(x)]
    odd = [(None, [1.0] * 16, 0), (2000, None, 0), (2020, [0.0] * 16, 0), (2040, [float("nan")] + [1.0] * 15, 0), (2060, [None] + [1.0] * 15, 0), (2080, [1.0, 2.0], 0), (2100, [float("inf")] * 16, 0), (60, rows[60][1], 0)]
    frame = spark.createDataFrame(rows + odd, "vec_id long, v array<double>, list int").repartition(4)
    got = {}
    for r in ann_scan.nearest(frame, "vec_id", "v", F.col("vec_id") % 20 == 0).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert set(got) == set(range(0, 1500, 20))
    ids, every = np.array([*range(1500), 60]), np.vstack([x, x[60]])
    hits = 0
    for q, found in got.items():
        found.sort()
        assert [r for r, _, _ in found] == list(range(1, 21)) and all(v != q for _, v, _ in found)
        scores = every @ x[q]
        assert np.allclose([s for _, _, s in found], [scores[ids == v][0] for _, v, _ in found])
        assert found == sorted(found, key=lambda t: (-t[2], t[1]))
        best = [k for k in np.lexsort((ids, -scores)) if ids[k] != q][:20]
        hits += len(set(np.round(scores[best], 9)) & set(np.round([s for _, _, s in found], 9))) / len(set(np.round(scores[best], 9)))
    assert hits / len(got) > 0.9
    few = ann_scan.nearest(frame.filter("vec_id < 5"), "vec_id", "v", F.col("vec_id") == 0).collect()
    assert [r["vec_id"] for r in few] == [int(k) for k in np.lexsort((np.arange(1, 5), -(x[1:5] @ x[0]))) + 1]
    assert ann_scan.nearest(frame.limit(0), "vec_id", "v", F.lit(True)).count() == 0


# --- 10 quality


def test_factorisation_identity():
    rng = np.random.default_rng(3)
    size = quality_fm.BUCKETS + len(quality_fm.STATS) * quality_fm.BINS
    machine = quality_fm.Machine(np.zeros((len(quality_fm.STATS), quality_fm.BINS - 1)), 0.3, rng.normal(size=size), rng.normal(size=(size, quality_fm.RANK)))
    ids, values = rng.choice(size, 9, replace=False), rng.normal(size=9)
    z, _ = machine.margin(ids, values, np.array([0]))
    pairs = sum(values[a] * values[b] * (machine.factors[ids[a]] @ machine.factors[ids[b]]) for a in range(9) for b in range(a))
    assert np.isclose(z[0], 0.3 + values @ machine.linear[ids] + pairs)


def test_quality_classifier(spark, docs, texts):
    rng = random.Random(11)
    rows = [(i + 2000, words(rng, 60) if i % 3 else " ".join(w + "&&&" for w in words(rng, 60).split()), "en", "s", None) for i in range(600)]
    labelled = spark.createDataFrame(rows, SCHEMA)
    labels = spark.createDataFrame([(i + 2000, int(i % 3 > 0), 0) for i in range(600)], "doc_id long, quality int, toxic int")
    machine = quality_fm.train(labelled, labels, F.col("doc_id") % 5 != 0)
    scored = quality_fm.score_quality(labelled, machine).filter("doc_id % 5 = 0").collect()
    assert all(r["predicted"] == ((r["doc_id"] - 2000) % 3 > 0) for r in scored)
    got = quality_fm.score_quality(with_clashes(docs).drop("score"), machine)
    assert got.count() == len(texts) and all(0 <= r["score"] <= 1 for r in got.collect())
    kept = quality_fm.quality_filter(with_clashes(docs), labels.limit(0))
    assert kept.columns == with_clashes(docs).columns and kept.count() == len(texts)  # 0.5 each without labels
    assert quality_fm.score_quality(docs.limit(0), machine).count() == 0


# --- the pipeline


def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline
    from __spark_entry__ import queries

    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs
        stage(spark, docs, folder).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        if k < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == columns, name
            assert docs.join(before, "doc_id", "left_anti").isEmpty()
    assert queries()["pipeline"](spark, folder).count() == docs.count()


def test_pipeline_equals_plain_stages(spark, tmp_path):
    """The stages behind the classifier against plain versions in a row, on all documents that it keeps."""
    import corpus_pipeline
    from tokenizers import Tokenizer

    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    out = []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, folder).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        out.append(docs.collect())
    first, pages, one_each, unrepeated, packed = out

    assert 0 < len(first) < spark.read.parquet(f"{folder}/documents.parquet").count()
    plain = plain_lines([(r["source"], r["text"]) for r in first], line_dedup.RATIO, line_dedup.MIN_PAGES)
    assert Counter((r["source"], r["text"]) for r in pages) == sum((Counter({(s, t): n}) for (s, t, _), n in plain.items()), Counter())

    rows = [(r["doc_id"], r["text"]) for r in pages]
    classes = {members for _, _, members in plain_near(rows)}
    assert {r["doc_id"] for r in one_each} == {min(rows[i][0] for i in members) for members in classes}
    assert len(one_each) == len(classes) < len(pages)

    seen, want = set(), {}
    for r in sorted(one_each, key=lambda r: r["doc_id"]):
        data = (r["text"] or "").encode()
        gone = np.zeros(len(data), bool)
        for p in range(len(data) - 99):
            s = data[p : p + 100]
            if s in seen:
                gone[p : p + 100] = True
            seen.add(s)
        at, kept = 0, []
        for c in r["text"] or "":
            size = len(c.encode())
            if not gone[at : at + size].any():
                kept.append(c)
            at += size
        want[r["doc_id"]] = "".join(kept)
    assert {r["doc_id"]: r["text"] or "" for r in unrepeated} == want
    assert want != {r["doc_id"]: r["text"] or "" for r in one_each}

    tokenizer = Tokenizer.from_file(str(TOKENIZER))
    windows, pieces = {}, {}
    for r in packed:
        windows.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        pieces.setdefault(r["doc_id"], []).append(r)
    for parts in windows.values():
        ends = np.cumsum([n for _, n in sorted(parts)])
        assert [o for o, _ in sorted(parts)] == [0, *ends[:-1]] and ends[-1] <= 1024
    assert pieces.keys() == want.keys()
    for doc_id, text in want.items():
        ids, at = np.array(tokenizer.encode(text, add_special_tokens=False).ids + [0], "<u4"), 0
        for r in sorted(pieces[doc_id], key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids)
            assert r["ids_crc32"] == zlib.crc32(ids[at : at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids)


def test_suffix_names_are_given_in_small_pieces():
    """Texts are named some at a time, with the runs that all texts at once have."""
    import numpy as np
    import pyarrow as pa

    from tallyhouse.llm import suffix_dedup

    rng = np.random.default_rng(5)
    texts = ["".join(map(chr, rng.integers(97, 123, 9000))) for _ in range(30)] + ["", None, "short", "é" * 200]
    texts[7] = texts[3]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts)], ["_doc", "text"])
    pieces = list(suffix_dedup._sparse(100)(iter([batch])))
    assert len(pieces) >= 4 and all(len(set(p.column("doc").to_pylist())) * 9000 <= suffix_dedup.PIECE_BYTES for p in pieces)
    doc, start, n, rank, around = suffix_dedup.anchor_runs(*suffix_dedup._joined(texts), 100)
    whole = list(zip(rank.tolist(), around.tolist(), doc.tolist(), start.tolist(), n.tolist()))
    assert [tuple(r.values()) for p in pieces for r in p.to_pylist()] == whole
    runs = {d: [r[:2] + r[3:] for r in whole if r[2] == d] for d in (3, 7)}
    assert runs[3] and runs[3] == runs[7]


def test_repeat_spans_of_many_runs_stay_arrays():
    """A run for every byte, as near copies give them, may not become a Python object each."""
    import tracemalloc

    many = 200_000
    kind = pa.list_(pa.struct([("start", pa.int64()), ("n", pa.int32())]))
    each = pa.StructArray.from_arrays([pa.array(np.arange(many)[::-1]), pa.array(np.ones(many, np.int32))], ["start", "n"])
    all_in_one = pa.ListArray.from_arrays(pa.array([0, many], pa.int32()), each)
    text = pa.array(["x" * (many + 99)])
    tracemalloc.start()
    try:
        assert list(suffix_dedup.cuts(pa.RecordBatch.from_arrays([text, all_in_one], ["text", "_runs"]), 100)) == [(text[0].as_py(), [(0, many + 99)])]
        assert tracemalloc.get_traced_memory()[1] < 20e6  # 45 MB as dicts
    finally:
        tracemalloc.stop()

    rows = [[(5, 2), (106, 1), (300, 1)], None, [], [(7, 1), (0, 3)], [(10, 200), (20, 1), (309, 1), (410, 1)]]
    lists = pa.array([None if r is None else [{"start": a, "n": n} for a, n in r] for r in rows], kind)
    batch = pa.RecordBatch.from_arrays([pa.array(["a", None, "b", "c", "d"]), lists], ["text", "_runs"]).slice(0, 5)
    want = [[(5, 206), (300, 400)], [], [], [(0, 107)], [(10, 409), (410, 510)]]
    assert [gone for _, gone in suffix_dedup.cuts(batch, 100)] == want
    assert [gone for _, gone in suffix_dedup.cuts(batch.slice(3), 100)] == want[3:]  # a slice of a list array
