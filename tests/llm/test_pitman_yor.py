"""Hierarchical Pitman-Yor scores: counts against a plain version, seatings
against exact posteriors, probabilities against the formula."""

import itertools
import math
import re
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidecast.llm import pitman_yor as py
from tidecast.llm import queries as Q

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def tokens(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) + [None]


def base_scores(rows, held):
    counts = Counter(w for i, t in rows if not held(i) for w in tokens(t))
    n, v = sum(counts.values()), len(counts)
    return {i: (len(tokens(t)), sum(counts[w] > 0 for w in tokens(t)), n, sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in tokens(t))) for i, t in rows}


def in_fold(i):
    return i is not None and zlib.crc32(str(i).encode()) % 5 == 1


def fold():
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 1


def test_query_against_plain_counts(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    want = base_scores(docs, in_fold)
    rows = Q.op13_pitman_yor(spark, SF).collect()
    assert len(rows) == len(docs)
    for r in rows:
        n, known, total, base = want[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens, r.held_out) == (n, known, total, in_fold(r.doc_id))
        assert r.base_score == pytest.approx(base, rel=1e-9)
        assert r.score < 0
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)  # the context helps on unseen texts


def test_odd_rows(spark):
    rows = [(1, "A b\tc\x0bD\x1fe f É é"), (2, None), (3, ""), (4, " \n "), (None, "a b a"), (5, "a b a b " * 500), (5, "a b a b " * 500), (6, "a"), (7, "É Z"), (8, "x" * 100_000)]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, word string")
    want = [(n, known, total, round(base, 6)) for n, known, total, base in (base_scores([(0, t)] + [], lambda i: True)[0] for _, t in rows)]
    got = py.score(df, fold()).collect()
    counts = Counter(w for i, t in rows if not in_fold(i) for w in tokens(t))
    total, v = sum(counts.values()), len(counts)
    plain = sorted((i is None, i or 0, len(tokens(t)), sum(counts[w] > 0 for w in tokens(t)), round(sum(math.log10((counts[w] + 0.5) / (total + 0.5 * (v + 1))) for w in tokens(t)), 6)) for i, t in rows)
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_tokens, r.n_known, round(r.base_score, 6)) for r in got) == plain
    assert all(r.train_tokens == total and math.isfinite(r.score) for r in got) and len(want) == len(rows)


def test_empty_and_untrained(spark):
    df = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    assert py.score(df.limit(0), F.lit(False)).count() == 0
    rows = py.score(df, F.lit(True)).collect()
    assert {(r.doc_id, r.n_known, r.train_tokens, r.score, round(r.base_score, 9)) for r in rows} == {(1, 0, 0, 0.0, 0.0), (2, 0, 0, 0.0, 0.0)}


@pytest.mark.parametrize("room,bucket,size", [(10**6, 10**6, 24 << 20), (20, 50, 200)])
def test_probabilities_sum_to_one_and_match_formula(spark, monkeypatch, room, bucket, size):
    """p(. | u) from the model's own tables: sums to 1 over known and unknown words, and gives the scores."""
    monkeypatch.setattr(py, "ROOM", room)
    monkeypatch.setattr(py, "BUCKET", bucket)
    monkeypatch.setattr(py, "BLOCK_BYTES", size)
    rng = np.random.default_rng(3)
    texts = [" ".join(f"w{int(x)}" for x in rng.zipf(1.5, 12) % 30) for _ in range(60)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    held = F.col("doc_id") % 6 == 0
    model = py.Model(py.written(py.encode(df, "doc_id", "text", held)))
    hash_of = lambda w: py.END if w is None else py.xxhash.xxh64_intdigest(w.encode(), py.SEED) - (1 << 63)
    lexicon = {r.w: list(r.v) for r in model.lexicon.collect()}
    dish = {}
    told = {(r.block, r.bucket): py._unpack("a", r.a) for r in model.seated.where("block is not null").collect()}
    for batch in model.blocks.toArrow().to_batches():
        for i in range(batch.num_rows):
            b = py.Block(batch, i)
            own, _ = b.buckets(model.buckets, model.hot.value)
            for k in set(own.tolist()):
                at = own == k
                for u, w, x in zip(b.u[at].tolist(), b.word[b.w[at]].tolist(), told[batch.column(0)[i].as_py(), k].tolist()):
                    assert dish.setdefault((u, w), x) == x
    s = model.samples
    assert (model.buckets > 1) == (bucket == 50) and (len(model.hot.value) > 0) == (room == 20)

    def p(u, w):
        back = lexicon[py.END if u == py.START else u][s:] if (py.END if u == py.START else u) in lexicon else [1.0] * s
        parent = lexicon[w][:s] if w in lexicon else model.unknown
        return dish.get((u, w), 0.0) + sum(b * q for b, q in zip(back, parent)) / s

    for u in [py.START, *[hash_of(f"w{i}") for i in range(30)]]:
        if u == py.START or u in lexicon:
            assert sum(p(u, w) for w in lexicon) + p(u, 12345) == pytest.approx(1.0, abs=2e-3)
    again = {r.doc_id: r.score for r in py.score(df, held).collect()}
    for i, t in enumerate(texts):
        ws = [hash_of(w) for w in tokens(t)]
        assert again[i] == pytest.approx(sum(math.log10(p(u, w)) for u, w in zip([py.START, *ws], ws)), rel=1e-4)


def partitions(n):
    """Set partitions of n customers as block sizes with multiplicity."""
    def grow(i, blocks):
        if i == n:
            yield tuple(blocks)
            return
        for j in range(len(blocks)):
            yield from grow(i + 1, [b + (k == j) for k, b in enumerate(blocks)])
        yield from grow(i + 1, [*blocks, 1])

    return grow(0, [])


def weight(seatings, p, d, theta):
    """Weight of a restaurant's seatings (block sizes by dish)."""
    out, total = 1.0, 0
    for blocks, q in zip(seatings, p):
        for b in blocks:
            out *= (theta + d * total) * q * math.prod(k - d for k in range(1, b))
            total += 1
    return out


def test_gibbs_reaches_the_posterior():
    """Mean tables of two dishes against the exact posterior over all seatings."""
    c, p, d, theta = [4, 3], [0.3, 0.1], 0.5, 1.0
    exact = Counter()
    for x, y in itertools.product(partitions(4), partitions(3)):
        exact[len(x), len(y)] += weight((x, y), p, d, theta)
    total = sum(exact.values())
    want = [sum(k[i] * v for k, v in exact.items()) / total for i in (0, 1)]
    copies = 3000  # restaurants side by side
    seating = py.Seating(np.tile(c, copies), np.repeat(np.arange(copies), 2), np.tile(p, copies), np.ones(copies), np.zeros(copies, np.int64), d, theta, 1)
    means = []
    for sweep in range(40):
        t, all_tables = seating.sweep()
        assert (t >= 1).all() and (t <= np.tile(c, copies)).all()
        assert (all_tables == t.reshape(copies, 2).sum(1)).all()
        if sweep >= 10:
            means.append(t.reshape(copies, 2).mean(0))
    assert np.mean(means, 0) == pytest.approx(want, abs=0.03)


def test_seating_keeps_its_books():
    rng = np.random.default_rng(2)
    c = rng.integers(2, 40, 200)
    rest = rng.integers(0, 20, 200)
    s = py.Seating(c, rest, np.full(200, 0.01), np.ones(20), np.zeros(20, np.int64), 0.7, 1.0, 4)
    for _ in range(3):
        t, total = s.sweep()
        sizes = np.bincount(s.at, minlength=len(s.size))
        assert (sizes == s.size).all()
        tables = np.add.reduceat(s.size > 0, s.off)
        assert (tables == s.t).all() and (np.bincount(rest, t, 20) == total).all()


def test_large_dishes_are_seated_in_parts():
    """Tables of a dish of many customers grow about as when all are seated one by one."""
    def mean(seats):
        py.SEATS, old = seats, py.SEATS
        try:
            s = py.Seating(np.full(300, 4000), np.arange(300), np.full(300, 0.05), np.ones(300), np.full(300, 500), 0.5, 1.0, 6)
            return s.sweep()[0].mean()
        finally:
            py.SEATS = old

    assert mean(500) == pytest.approx(mean(4000), rel=0.25)


def test_all_parts_of_a_dish_are_seated(monkeypatch):
    monkeypatch.setattr(py, "SEATS", 10)
    c = np.array([37, 4, 10, 101])
    s = py.Seating(c, np.array([0, 0, 1, 1]), np.full(4, 0.2), np.ones(2), np.zeros(2, np.int64), 0.5, 1.0, 3)
    t, total = s.sweep()
    assert np.bincount(s.dish, s.c).tolist() == c.tolist() and s.size.sum() == c.sum() and s.c.max() <= 10
    assert t.sum() == (s.size > 0).sum() and total.tolist() == [t[:2].sum(), t[2:].sum()]


def test_rooms_know_the_tables_of_all_others(monkeypatch):
    """A room whose words are unlike the others' is seated by the counted tables of these, not by its own multiplied."""
    seen = []

    class Spy(py.Seating):
        def __init__(self, *args):
            super().__init__(*args)
            seen.append((float(self.spread[0]), float(self.outside[0])))

    monkeypatch.setattr(py, "Seating", Spy)
    room = py.pa.table({"room": py.pa.array([1, 1], py.pa.int32()), "w": [5, 6], "c": [9, 3], "k": [[4, 3], [1, 2]]})
    py._seat_parent(0.5, 1.0, 0.01, 2, 3, {0: [7, 8], 1: [40, 50], 2: [1, 2]})(room)
    assert seen == [(1.0, 40.0), (1.0, 50.0)]


def test_discount_and_places_over_many_rooms(spark, monkeypatch):
    """Contexts and parent dealt over many places: tables there add up to the whole's."""
    monkeypatch.setattr(py, "ROOM", 20)
    monkeypatch.setattr(py, "BUCKET", 300)
    calls = []
    monkeypatch.setattr(py, "_seat_parent", lambda *a, own=py._seat_parent: calls.append(a) or own(*a))
    texts = [" ".join(f"w{(i * 7 + j * j) % 90}" for j in range(20)) for i in range(80)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    model = py.Model(py.written(py.encode(df, "doc_id", "text", F.lit(False))))
    rooms, first, second = calls[0][4], calls[0][5], calls[1][5]
    assert rooms > 1 and len(calls) == 2 and first is None
    totals = {tuple(second[r][i] for i in range(model.samples)) for r in second}
    assert len(second) == rooms and all(min(t) > 0 for t in totals)


@pytest.mark.parametrize("words", [50, 1 << 30])
def test_places_of_tokens(words):
    """Every token's pair, also where codes and positions don't fit one number."""
    rng = np.random.default_rng(4)
    b = object.__new__(py.Block)
    b.code = rng.integers(0, 300, 5000) * (words // 50)
    b.pair, b.word = np.unique(b.code), range(words)
    assert (b.places() == np.searchsorted(b.pair, b.code)).all()


def test_seating_holds_few_bytes_a_customer():
    n = 100_000
    c, rest, p = np.full(n, 2), np.arange(n) // 10, np.full(n, 1e-3)
    tracemalloc.start()
    try:
        s = py.Seating(c, rest, p, np.ones(n // 10), np.zeros(n // 10, np.int64), 0.5, 1.0, 3)
        held, _ = tracemalloc.get_traced_memory()
    finally:
        tracemalloc.stop()
    assert s.size.sum() == 2 * n and held < 70 * n


def test_pairs_are_divided_once(spark):
    """A block keeps both halves of its pairs, so that neither requests nor scores divide them again."""
    df = spark.createDataFrame([(1, "a b a c"), (2, "b a"), (3, "")], "doc_id long, text string")
    batch = py.encode(df.coalesce(1), "doc_id", "text", F.col("doc_id") == 2).toArrow().combine_chunks().to_batches()[0]
    b = py.Block(batch, 0)
    assert (b.context * len(b.word) + b.w == b.pair).all() and (b.w < len(b.word)).all()
    assert (b.u == np.where(b.context == len(b.word) - 1, py.START, b.word[b.context])).all()


def test_few_dishes_are_seated_as_many(monkeypatch):
    """Steps of few dishes, seated one by one, draw the same numbers and give the same tables as numpy's."""
    def seated(few, spread):
        monkeypatch.setattr(py, "FEW", few)
        rng = np.random.default_rng(5)
        c, rest = rng.zipf(1.5, 400).clip(2, 300), rng.integers(0, 30, 400)
        s = py.Seating(c, rest, np.full(400, 0.02), np.full(30, spread), np.arange(30), 0.6, 1.0, 8, 3.0)
        return [s.at.copy(), s.size.copy(), *s.sweep(), *s.sweep(), s.at, s.size]

    for spread in (1.0, 4.0):
        want = seated(0, spread)
        for few in (8, 64, 10**6):
            assert all((x == y).all() for x, y in zip(want, seated(few, spread)))


def test_vocabulary_goes_in_parts(spark, monkeypatch):
    """A block sends its words packed, once to each part; counts and answers are those of the whole."""
    texts = [(i, " ".join(f"w{(i * 7 + j * j) % 90}" for j in range(20))) for i in range(60)] + [(60, None), (61, "new old")]
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(2)
    monkeypatch.setattr(py, "BLOCK_BYTES", 400)
    blocks = py.written(py.encode(df, "doc_id", "text", fold()))
    plain = Counter(w for i, t in texts if not in_fold(i) for w in tokens(t))
    hash_of = lambda w: py.END if w is None else py.xxhash.xxh64_intdigest(w.encode(), py.SEED) - (1 << 63)
    assert {r.w: r.c for r in py.word_counts(blocks, 5).collect()} == {hash_of(w): c for w, c in plain.items()}
    held = {r.block: r.word for r in blocks.collect()}
    sent = py.vocabulary(blocks, 5, False).collect()
    assert len(held) > 2 and len({(r.block, r.bucket) for r in sent}) == len(sent) <= 5 * len(held)
    for block, words in held.items():
        own = [(r.bucket, w) for r in sent if r.block == block for w in py._unpack("words", r.words).tolist()]
        assert sorted(w for _, w in own) == sorted(words) and all(w % 5 == k for k, w in own)
    monkeypatch.setattr(py, "PART", 100)
    want = base_scores(texts, in_fold)
    for r in py.score(df, fold()).collect():
        n, known, total, base = want[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (n, known, total) and r.base_score == pytest.approx(base, rel=1e-9)


def test_requests_of_many_buckets(spark):
    """Many buckets or few, a block asks for the same pairs."""
    df = spark.createDataFrame([(i, " ".join(f"w{(i * 31 + j * j * 7) % 900}" for j in range(40))) for i in range(60)], "doc_id long, text string").coalesce(1)
    blocks = py.written(py.encode(df, "doc_id", "text", fold()))

    def asked(buckets):
        pairs = []
        for r in py.requests(blocks, buckets, spark.sparkContext.broadcast(np.zeros(0, np.int64))).collect():
            n, words, w, c = (py._unpack(k, r[k]) for k in ("n", "words", "w", "c"))
            assert (words[1:] > words[:-1]).all() and len(r.u) == len(n) and set(w.tolist()) == set(range(len(words)))
            pairs += zip(np.repeat(r.u, n).tolist(), words[w].tolist(), c.tolist())
        return sorted(pairs)

    assert asked(2) == asked(700)
