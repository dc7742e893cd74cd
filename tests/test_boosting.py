"""Boosted trees against a brute-force booster, and the two ways of fitting against each other."""

import math
from dataclasses import replace

import numpy as np
import pytest

from tidecast.operators import boosting as B

S = B.Settings(max_depth=3, learning_rate=0.3, row_share=1.0, column_share=1.0, min_rows=5, max_rounds=6, patience=6, seed=3)


def panel(spark, n=400, seed=1, missing=0.2, fits=1):
    """Rows (fit, id, y, w, valid_0, valid_1, a, b, c) with a planted signal; c is a category code."""
    rng = np.random.default_rng(seed)
    rows = []
    for fit in range(fits):
        for i in range(n):
            a = None if rng.random() < missing else float(rng.integers(0, 12))
            b, c = float(rng.normal()), int(rng.integers(0, 5))
            y = (5.0 if a is None else a) + (c in (1, 4)) * 7.0 + float(rng.integers(0, 3)) + fit
            rows.append((fit, fit * n + i, y, float(rng.integers(1, 4)), i % 10 == 0, i % 5 == 0, a, b, c))
    return spark.createDataFrame(rows, "fit int, id long, y double, w double, valid_0 boolean, valid_1 boolean, a double, b double, c int").repartition(3), rows


def chunked(df):
    bins = B.quantile_bins(df, ["a", "b"], ["c"])
    return B.write_chunks(df, bins, ["id"], "y", "w", ["valid_0", "valid_1"]), bins


def score(g, h, s):
    return max(abs(g) - s.l1, 0.0) ** 2 / (h + s.l2)


def brute_split(rows, s):
    """Best split of rows [(g, h, a, b, c)] by trying every set of the kind allowed."""
    def sums(part):
        return sum(r[0] for r in part), sum(r[1] for r in part), len(part)

    total, best = sums(rows), None
    for f, cat in ((0, False), (1, False), (2, True)):
        values = sorted({r[2 + f] for r in rows if r[2 + f] is not None})
        if cat:
            values.sort(key=lambda v: (lambda p: p[0] / (p[1] + B.CAT_SMOOTH))(sums([r for r in rows if r[2 + f] == v])))
            tries = [(set(values[: k + 1]), False) for k in range(len(values))]
        else:
            tries = [(set(values[: k + 1]), m) for m in (True, False) for k in range(len(values))]
        for left_values, missing_left in tries:
            left = [r for r in rows if (missing_left if r[2 + f] is None else r[2 + f] in left_values)]
            right = [r for r in rows if not (missing_left if r[2 + f] is None else r[2 + f] in left_values)]
            if len(left) < s.min_rows or len(right) < s.min_rows:
                continue
            a, b = sums(left), sums(right)
            gain = score(*a[:2], s) + score(*b[:2], s) - score(*total[:2], s)
            if gain > 1e-9 and (best is None or gain > best[0] * (1 + 1e-9)):
                best = gain, left, right, f
    return best


def brute_fit(rows, fold, s):
    """(validation errors, {id: margin}) of a booster that looks at every split of every leaf."""
    margin = {r[1]: 0.0 for r in rows}
    train, valid = [r for r in rows if not r[4 + fold]], [r for r in rows if r[4 + fold]]
    errors, gains = [], {0: 0.0, 1: 0.0, 2: 0.0}
    for _ in range(s.max_rounds):
        def walk(part, everyone, depth):
            found = brute_split([(2 * r[3] * (margin[r[1]] - r[2]), 2 * r[3], r[6], r[7], r[8], r) for r in part], s) if depth < s.max_depth else None
            if found is None:
                g, h = sum(2 * r[3] * (margin[r[1]] - r[2]) for r in part), sum(2 * r[3] for r in part)
                value = -s.learning_rate * math.copysign(max(abs(g) - s.l1, 0.0), g) / (h + s.l2)
                return {r[1]: value for r in everyone}
            gain, left, right, f = found
            gains[f] += gain
            known = {x[2 + f] for x in left if x[2 + f] is not None}
            missing_left = any(x[2 + f] is None for x in left)
            top = max(known) if f < 2 and known else None

            def goes(r):
                v = r[6 + f]
                return missing_left if v is None else (v in known if f == 2 else top is not None and v <= top)

            return walk([x[5] for x in left], [r for r in everyone if goes(r)], depth + 1) | walk([x[5] for x in right], [r for r in everyone if not goes(r)], depth + 1)

        step = walk(train, rows, 0)
        margin = {i: m + step[i] for i, m in margin.items()}
        total = sum(r[3] for r in valid)
        errors.append(sum(r[3] * abs(margin[r[1]] - r[2]) for r in valid) / total)
    return errors, margin, gains


def values(chunks, nodes, bins, n_folds=2):
    return {r.id: [r[f"pred_{i}"] for i in range(n_folds)] for r in B.predict(chunks, nodes, bins, n_folds, ["id"]).collect()}


def test_equals_brute_force(spark):
    df, rows = panel(spark, 300)
    chunks, bins = chunked(df)
    nodes = B.by_fit(chunks, 2, bins, S)
    got = values(chunks, nodes, bins)
    for fold in (0, 1):
        errors, margin, gain = brute_fit(rows, fold, S)
        best = int(np.argmin(errors)) + 1
        kept = sorted((r.tree, r.error, r.rounds) for r in nodes.where(f"fold = {fold} and node = 0").collect())
        assert [k[1] for k in kept] == pytest.approx(errors[:best]) and {k[2] for k in kept} == {S.max_rounds}
        if best == S.max_rounds:
            assert all(got[i][fold] == pytest.approx(m) for i, m in margin.items())
            raw = {r.feature: r.g for r in nodes.where(f"fold = {fold} and feature is not null").groupBy("feature").agg({"gain": "sum"}).withColumnRenamed("sum(gain)", "g").collect()}
            assert raw == pytest.approx({k: v for k, v in zip("abc", gain.values()) if v})


@pytest.mark.parametrize("settings", [
    replace(S, max_rounds=40, patience=4, row_share=0.8, column_share=0.6),
    replace(S, max_rounds=5, max_depth=5, max_leaves=7),
])
def test_both_ways_grow_the_same_trees(spark, monkeypatch, settings):
    monkeypatch.setattr(B, "CHUNK", 100)
    monkeypatch.setattr(B, "KEEP", 3)
    df, _ = panel(spark, 500, seed=4, fits=2)
    chunks, bins = chunked(df)
    here, spread = B.by_fit(chunks, 2, bins, settings), B.by_level(chunks, 2, bins, settings)
    key = ["fit", "fold", "tree", "node"]
    a, b = ([r.asDict() for r in x.orderBy(*key).collect()] for x in (here, spread))
    assert len(a) == len(b) > 20
    for x, y in zip(a, b):
        for k in x:
            assert x[k] == (pytest.approx(y[k], rel=1e-6, abs=1e-9) if isinstance(x[k], float) else y[k]), (k, x, y)
    if settings.max_leaves == 7:
        leaves = here.where("left is null").groupBy("fit", "fold", "tree").count().agg({"count": "max"}).first()[0]
        assert leaves == 7


def test_patience_ends_the_fit_where_a_long_run_is_best(spark):
    df, _ = panel(spark, 300, seed=5)
    chunks, bins = chunked(df)
    long = replace(S, max_rounds=60, patience=60, learning_rate=0.5)
    every = B.by_fit(chunks, 2, bins, long)
    stopped = B.by_fit(chunks, 2, bins, replace(long, patience=8))
    for fold in (0, 1):
        a = [r.error for r in stopped.where(f"fold = {fold} and node = 0").orderBy("tree").collect()]
        rounds = stopped.where(f"fold = {fold}").first().rounds
        b = [r.error for r in every.where(f"fold = {fold} and node = 0").orderBy("tree").collect()]
        assert a == pytest.approx(b[: len(a)]) and min(a) == a[-1]
        assert rounds == min(len(a) + 8, 60)


@pytest.mark.parametrize("high,side", [(True, False), (False, True)])
def test_missing_values_go_to_the_better_side(spark, high, side):
    """Rows without a value have the label of the large (or the small) values."""
    rows = [(0, i, 10.0 if x >= 5 else 0.0, 1.0, False, False, float(x), 0.0, 0) for i, x in enumerate(list(range(10)) * 10)]
    rows += [(0, 1000 + i, 10.0 if high else 0.0, 1.0, False, False, None, 0.0, 0) for i in range(30)]
    df = spark.createDataFrame(rows, "fit int, id long, y double, w double, valid_0 boolean, valid_1 boolean, a double, b double, c int")
    chunks, bins = chunked(df)
    nodes = B.by_fit(chunks, 1, bins, replace(S, max_rounds=1, learning_rate=1.0, max_depth=1))
    root = nodes.where("node = 0").first()
    assert (root.feature, root.cut, root.missing_left) == ("a", 4.0, side)
    got = values(chunks, nodes, bins, 1)
    assert got[1000][0] == pytest.approx(10.0 if high else 0.0, abs=0.1)


def test_sketched_edges_are_near_exact_ranks(spark):
    n = 20_000
    df = spark.range(n).selectExpr("cast(pow(id, 1.5) as double) as x", "cast(id % 7 as double) as few", "cast(null as double) as none", "cast(id % 300 as int) as many", "cast(id % 4 as int) as code")
    bins = B.quantile_bins(df, ["x", "few", "none"], ["many", "code"])
    ranks = np.round(bins.edges["x"] ** (1 / 1.5))
    want = np.arange(1, B.MISSING) * n / B.MISSING
    assert len(ranks) == B.MISSING - 1 and np.abs(ranks - want).max() <= n / 20_000 * 2 + 1
    assert bins.edges["few"].tolist() == list(map(float, range(7))) and len(bins.edges["none"]) == 0
    assert bins.levels == {"code": 4} and len(bins.edges["many"]) <= B.MISSING - 1
    assert bins.of("few", np.array([0.0, 6.0, 9.0, np.nan])).tolist() == [0, 6, 7, B.MISSING]
    assert bins.of("code", np.array([0.0, 3.0, 4.0, np.nan])).tolist() == [0, 3, B.MISSING, B.MISSING]


def test_unseen_values_and_empty_input(spark):
    df, _ = panel(spark, 100)
    chunks, bins = chunked(df)
    nodes = B.fit_boosters(chunks, 2, bins, S)
    new = spark.createDataFrame([(0, 1, 1e9, -1e9, 99), (0, 2, None, None, None), (5, 3, 1.0, 1.0, 1)], "fit int, id long, a double, b double, c int")
    got = values(B.write_chunks(new, bins, ["id"], None, None), nodes, bins)
    assert set(got) == {1, 2, 3} and all(math.isfinite(v) for x in got.values() for v in x) and got[3] == [0.0, 0.0]
    empty, _ = chunked(df.limit(0))
    assert B.by_fit(empty, 2, bins, S).count() == 0 == B.by_level(empty, 2, bins, S).count()


def test_gains_list_every_column(spark):
    df, _ = panel(spark, 200)
    chunks, bins = chunked(df)
    rows = {r.feature: r for r in B.gains(B.by_fit(chunks, 2, bins, S), bins.columns, 2).collect()}
    assert set(rows) == {"a", "b", "c"} and rows["c"].mean > rows["b"].mean


def test_edges_are_exact_up_to_many_distinct_values(spark, monkeypatch):
    monkeypatch.setattr(B, "SKETCH_ROWS", 0)
    rng = np.random.default_rng(8)
    x = np.floor(rng.random(120_000) ** 3 * 30_000)
    df = spark.createDataFrame(x.reshape(-1, 1).tolist(), "x double").repartition(5)
    edges = B.quantile_bins(df, ["x"]).edges["x"]
    ranks = [math.ceil(i / B.MISSING * len(x)) - 1 for i in range(1, B.MISSING)]
    assert edges.tolist() == np.unique(np.sort(x)[ranks]).tolist()


def test_merged_sketches_keep_ranks(monkeypatch):
    monkeypatch.setattr(B, "POINTS", 500)
    rng = np.random.default_rng(9)
    x = np.sort(rng.normal(size=64_000))
    parts = [B._sketch([(np.sort(own), np.ones(1000, int), float(own.max()), True)]) for own in rng.permutation(x).reshape(64, 1000)]
    while len(parts) > 1:
        parts = [B._sketch(parts[i:i + 2]) for i in range(0, len(parts), 2)]
    points, counts, top, whole = parts[0]
    assert not whole and counts.sum() == len(x) and top == x[-1] and len(points) <= 500
    middles = np.cumsum(counts) - counts / 2
    assert np.abs(np.searchsorted(x, points) - middles).max() <= 7 * len(x) / (2 * 500)


def test_both_sketches_agree_on_few_rows(spark):
    df, _ = panel(spark, 300)
    df = df.selectExpr("a", "b", "if(id % 9 = 0, double('NaN'), a) as d", "cast(null as double) as none", "c")
    some, other = B._edges(df, ["a", "b", "d", "none"], ["c"], B.MISSING), B._sorted_edges(df, ["a", "b", "d", "none"], ["c"], B.MISSING)
    assert {c: e.tolist() for c, e in some[0].items()} == {c: e.tolist() for c, e in other[0].items()} and some[1] == other[1]


def test_packed_rows_give_the_same_edges_and_chunks(spark, monkeypatch):
    """Numeric columns carried as one array: same edges by both sketches, same bins in the chunks."""
    rng = np.random.default_rng(6)
    rows = [(i, int(i % 3), None if i % 7 == 0 else float(rng.normal()), float("nan") if i % 11 == 0 else float(i % 5), i % 4, float(i)) for i in range(900)]
    df = spark.createDataFrame(rows, "id long, fit int, a double, b double, c int, y double").repartition(3).cache()
    packed = df.select("id", "fit", "c", "y", B.pack(["a", "b"]))
    for limit in (B.SKETCH_ROWS, 10):
        monkeypatch.setattr(B, "SKETCH_ROWS", limit)
        plain, other = B.quantile_bins(df, ["a", "b"], ["c"]), B.quantile_bins(packed, ["a", "b"], ["c"])
        assert plain.columns == other.columns and plain.levels == other.levels
        assert all((plain.edges[c] == other.edges[c]).all() for c in plain.edges)
    found = []
    for x, names in ((df, ()), (packed, ("a", "b"))):
        chunks = B.write_chunks(x, plain, ["id"], "y", None, packed=names).collect()
        found.append({i: (r.fit, bytes(m)) for r in chunks for i, m in zip(r.id, np.frombuffer(r.bins, np.uint8).reshape(3, -1).T)})
    assert len(found[0]) == 900 and found[0] == found[1]
