"""Hard negatives against a plain scan over all pairs of anchors and rows."""

import math

import numpy as np
import pytest

from tidecast.llm import hard_negatives as hn
from tidecast.llm import queries as Q
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>, label int, score string"


def clip(x):
    return min(max(x, -2**63), 2**63 - 1)


def brute(rows, anchor, scale=256, n_pos=5, n_neg=10, low=30, high=90):
    best = {}
    for i, x, label, *_ in rows:
        if i is None or x is None or label is None or any(v is None or not math.isfinite(v) for v in x):
            continue
        row = (label, [clip(math.floor(scale * float(np.float32(v)))) for v in x])
        best[i] = min(best.get(i, row), row)
    out = []
    for a, (label, q) in best.items():
        if not anchor(a):
            continue
        scored = sorted((-clip(sum(x * y for x, y in zip(q, v))), i, l) for i, (l, v) in best.items() if i != a)
        for s, p, l in [r for r in scored if r[2] == label][:n_pos]:
            fit = [(t, i) for t, i, m in scored if m != label and low * -s <= 100 * -t <= high * -s][:n_neg]
            out += [(a, p, k, i, -s, -t) for k, (t, i) in enumerate(fit, 1)]
    return sorted(out)


def mined(spark, rows, anchor=10, **kw):
    df = spark.createDataFrame(rows, SCHEMA)
    got = hn.hard_negatives(df, F.col("vec_id") % anchor == 0, **kw).collect()
    return sorted((r.anchor_id, r.positive_id, r["rank"], r.negative_id, r.positive_score, r.negative_score) for r in got)


def cloud(n, dim, seed, labels=4, clusters=6, spread=0.15):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(clusters, dim))
    x = middle[rng.integers(0, clusters, n)] * 0.4 + spread * rng.normal(size=(n, dim))
    return [(i, [float(v) for v in row], int(l), "clash") for i, (row, l) in enumerate(zip(x.astype(np.float32), rng.integers(0, labels, n)))]


@pytest.mark.parametrize("tree_rows,leaf,block", [(4096, 128, 8192), (64, 4, 16), (200, 8, 1000)])
def test_matches_scan(spark, monkeypatch, tree_rows, leaf, block):
    monkeypatch.setattr(hn, "TREE_ROWS", tree_rows)
    monkeypatch.setattr(hn, "LEAF", leaf)
    monkeypatch.setattr(hn, "BLOCK", block)
    rows = cloud(600, 8, 1)
    want = brute(rows, lambda i: i % 10 == 0)
    assert want and mined(spark, rows) == want


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = cloud(120, 4, 2, labels=2) + [
        (None, [1.0] * 4, 0, None), (1000, None, 0, None), (1010, [1.0, None, 1.0, 1.0], 1, None), (1020, [nan] * 4, 1, None),
        (1030, [inf, 0.0, 0.0, 0.0], 1, None), (1040, [1.0] * 4, None, None), (1050, [], 1, None), (1060, [0.5], 0, None), (1070, [0.3] * 6, 1, None),
        (1080, [2.0] * 4, 7, "alone"), (1090, [0.0] * 4, 0, None), (1100, [-1.0] * 4, 1, None), (1100, [-1.0] * 4, 1, None), (1100, [1.0] * 4, 0, None),
    ]
    want = brute(rows, lambda i: i % 10 == 0)
    assert want and mined(spark, rows) == want


def test_copies_and_ties(spark):
    rows = [(i, [0.5, 0.25, -0.5], i % 3, "same") for i in range(400)] + [(400 + i, [0.4, 0.2, -0.4 + 0.001 * (i % 5)], i % 3, None) for i in range(300)]
    want = brute(rows, lambda i: i % 20 == 0)
    assert want and mined(spark, rows, 20) == want


def test_components_beyond_floats(spark):
    rows = [(i, [3e38 if i % 3 else 1e30, 1e25 * (i % 7), float(i)], i % 2, None) for i in range(60)]
    assert mined(spark, rows, 10) == brute(rows, lambda i: i % 10 == 0)


def test_empty_and_no_anchor(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(1, [1.0], 0, None), (2, [1.0], 1, None)]) == []


def test_bounds_hold():
    rng = np.random.default_rng(5)
    whole = np.floor(rng.normal(size=(500, 16)) * rng.choice([1, 256, 1e5], (500, 1))).astype(np.int64)
    whole[100:150] = whole[100]
    import pyarrow as pa
    t = pa.table({"vec_id": np.arange(500), "label": np.arange(500) % 3, "vec": pa.array(whole.tolist(), pa.list_(pa.int64()))})
    old, hn.LEAF = hn.LEAF, 8
    try:
        row = hn._plant(t).to_pylist()[0]
    finally:
        hn.LEAF = old
    tree = hn.Planted(row)
    assert len(tree.first) > 10 and sorted(tree.ids.tolist()) == list(range(500))
    q = hn.Vectors(whole[:40])
    low, high = tree.bounds(q)
    exact = whole[:40] @ whole[tree.ids].T
    for node in range(len(tree.first)):
        below = exact[:, tree.first[node]: tree.last[node]]
        assert (below.min(1) >= low[:, node]).all() and (below.max(1) <= high[:, node]).all()


def test_query(spark):
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    rows = [(i, x, (l + 1) % 10 if l is not None and i % 7 == 0 else l) for i, x, l in rows]
    got = sorted((r.anchor_id, r.positive_id, r["rank"], r.negative_id, r.positive_score, r.negative_score) for r in Q.op12_hard_negatives(spark, SF).collect())
    want = brute(rows, lambda i: i % 100 == 0)
    assert want and got == want
