import math
from collections import defaultdict

import pytest

from conftest import SF_SMALL
from tidecast.llm import mixing
from tidecast.llm.queries import op4_source_mixing


def weights(tokens, a):
    total = sum(tokens.values())
    z = sum((t / total) ** a for t in tokens.values() if t)
    return {s: (t / total) ** a / z if t else 0.0 for s, t in tokens.items()}


def entropy(w):
    return -sum(x * math.log(x) for x in w.values() if x)


def repetition(tokens, w, budget):
    return max(w[s] * budget / t for s, t in tokens.items() if t)


def verify(rows, docs, budget=None, max_epochs=4.0, target=None):
    """docs: (doc_id, text, source).  Weights against a fine scan of exponents,
    draws against what the method promises for every source."""
    tokens = defaultdict(int)
    for _, t, s in docs:
        tokens[s] += len((t or "").split())
    total = sum(tokens.values())
    budget = total if budget is None else budget
    assert len(rows) == len(docs)
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.n_tokens, str(r.source)) for r in rows) == sorted((i if i is not None else -1, len((t or "").split()), str(s)) for i, t, s in docs)
    grid = [i / 10_000 for i in range(10_001)]
    least = next((a for a in grid if repetition(tokens, weights(tokens, a), budget) <= max_epochs), 1.0) if total else 1.0
    if target is not None:
        live = sum(t > 0 for t in tokens.values())
        fit = [a for a in grid if entropy(weights(tokens, a)) >= target * math.log(live) - 1e-12]
        least = max(least, max(fit, default=0))
    want = weights(tokens, least) if total else {}
    by = defaultdict(list)
    for r in rows:
        by[r.source].append(r)
    for s, own in by.items():
        if not tokens[s]:
            assert all(r.copies == 1 and r.weight == 0 for r in own)
            continue
        w = own[0].weight
        assert w == pytest.approx(want[s], abs=3e-4)
        due = round(w * budget)
        passes, rest = divmod(due, tokens[s])
        extra = [r for r in own if r.copies == passes + 1]
        assert all(r.copies in (passes, passes + 1) for r in own)
        drawn = sum(r.n_tokens for r in extra)
        assert rest <= drawn < rest + max(r.n_tokens for r in own) + (rest == 0)
        state = defaultdict(set)  # only one block of a source is drawn in part
        for r in own:
            if r.n_tokens:
                state[r.block].add(r.copies)
        assert sum(len(x) > 1 for x in state.values()) <= 1


DOCS = [(i, " ".join(["w"] * (i % 37 + 1)), "big" if i % 3 else f"s{i % 7}") for i in range(3_000)]
ODD = [(None, "a b", None), (5, None, None), (6, "", "empty"), (7, " \t", "empty"), (8, "x " * 30_000, "long"), (9, "q", "tiny"), (9, "q", "tiny"), (10, "a b", "null")]


@pytest.mark.parametrize("args", [{}, {"max_epochs": 1.0}, {"max_epochs": 2.5, "entropy": 0.9}, {"entropy": 0.8}, {"budget": 5_000}, {"budget": 100_000, "max_epochs": 3}])
def test_against_scan(spark, monkeypatch, args):
    monkeypatch.setattr(mixing, "BLOCK_TOKENS", 500)
    docs = DOCS + ODD
    df = spark.createDataFrame([(*d, 0) for d in docs], "doc_id long, text string, source string, copies int")
    verify(mixing.mix(df, **args).collect(), docs, args.get("budget"), args.get("max_epochs", 4.0), args.get("entropy"))


def test_same_draw_again_and_other_seed(spark):
    df = spark.createDataFrame(DOCS, "doc_id long, text string, source string")
    draw = lambda n, seed: sorted((r.doc_id, r.copies) for r in mixing.mix(df.repartition(n), seed=seed, budget=9_000).collect())
    assert draw(2, 1) == draw(5, 1) != draw(2, 2)


def test_empty_and_impossible(spark):
    df = spark.createDataFrame(ODD, "doc_id long, text string, source string")
    assert mixing.mix(df.limit(0)).count() == 0
    assert {r.copies for r in mixing.mix(df.where("doc_id in (5, 6, 7)")).collect()} == {1}
    with pytest.raises(ValueError):
        mixing.mix(df, budget=10**9)


def test_whole_table(spark):
    docs = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    verify(op4_source_mixing(spark, SF_SMALL).collect(), docs)
