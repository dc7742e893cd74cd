import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from conftest import SF_SMALL
from tidecast.llm import suffix_dedup as S
from tidecast.llm.queries import op1_suffix_dedup

K = S.LENGTH


def brute(docs):
    """docs: (doc_id, text).  Result rows by plain look-up of every string."""
    least = {}
    raw = [(i, (t or "").encode()) for i, t in docs]
    for i, b in raw:
        if i is not None:
            for a in range(len(b) - K + 1):
                s = b[a: a + K]
                if i < least.get(s, i + 1):
                    least[s] = i
    out = []
    for i, b in raw:
        gone = bytearray(len(b))
        if i is not None:
            for a in range(len(b) - K + 1):
                if least[b[a: a + K]] < i:
                    gone[a: a + K] = b"\1" * K
        spans = sum(1 for a, g in enumerate(gone) if g and not (a and gone[a - 1]))
        kept = bytes(c for c, g in zip(b, gone) if not g)
        out.append((-1 if i is None else i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def run(spark, docs, **args):
    df = spark.createDataFrame([(*d, "x", 1) for d in docs], "doc_id long, text string, tag string, chunk int")
    return sorted((-1 if r.doc_id is None else r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in S.suffix_dedup(df, **args).collect())


def sample(seed, n=150):
    r = random.Random(seed)
    passages = ["".join(r.choices("abcdé ", k=r.randint(40, 300))) for _ in range(8)] + ["ab" * 60, "z" * 130]
    docs = []
    for i in range(n):
        t = "".join("".join(r.choices("abcdé ", k=r.choice((0, 3, 49, 90)))) + (r.choice(passages) if r.random() < 0.7 else "") for _ in range(r.randint(0, 6)))
        if r.random() < 0.2 and docs:
            t = r.choice(docs)[1] or ""
            if t and r.random() < 0.6:
                at = r.randrange(len(t))
                t = t[:at] + r.choice("xyz") + t[at + 1:]
        docs.append((r.randrange(10**6) * 3 + i % 3, t))
    return docs


@pytest.mark.parametrize("seed", range(300))
def test_suffix_sort(seed):
    r = np.random.default_rng(seed)
    n = int(r.integers(1, 40))
    pool = [bytes(r.integers(97, 99, K).astype(np.uint8)) for _ in range(3)]
    rows = []
    for _ in range(n):
        s = bytearray(pool[r.integers(3)])
        if r.random() < 0.5:
            s[r.integers(K)] = 120
        rows.append(bytes(s))
    body = np.frombuffer(b"".join(rows), np.uint8)
    group = r.integers(0, 3, n)
    order, same = S.suffix_sort(body, np.arange(n) * K, group, 0x5DEECE66D)
    got = [(group[i], rows[i]) for i in order]
    assert got == sorted(got) and sorted(order) == list(range(n))
    assert same.tolist() == [i > 0 and got[i] == got[i - 1] for i in range(n)]


def test_collisions_are_found():
    """With base 1 hashes see no order of bytes, so the sort has to start again."""
    rows = [b"ab" + b"c" * (K - 2), b"ba" + b"c" * (K - 2), b"ab" + b"c" * (K - 2)]
    body = np.frombuffer(b"".join(rows), np.uint8)
    order, same = S.suffix_sort(body, np.arange(3) * K, np.zeros(3, np.int64), 1)
    assert [rows[i] for i in order] == sorted(rows) and same.tolist() == [False, True, False]


@pytest.mark.parametrize("hot", [None, 2])
def test_random(spark, monkeypatch, hot):
    monkeypatch.setattr(S, "CHUNK_BYTES", 3000)
    docs = sample(1 if hot is None else 2)
    want = brute(docs)
    assert sum(w[2] for w in want) > 5000 and max(w[3] for w in want) > 1
    assert run(spark, docs, hot=hot) == want


def test_cases(spark):
    line = "this line of licence text stands in many documents, word by word."
    docs = [(5, line), (3, line), (9, line + line), (9, line + line), (9, "other " + line), (None, line), (None, None), (1, None), (2, ""), (4, "x" * 49)]
    docs += [(7, "y" * 400_000), (8, "y" * 51), (10, "z" * 30_000 + line), (11, "é" * 24 + "ab"), (12, "a" + "é" * 24 + "ab")]
    assert run(spark, docs) == brute(docs)
    assert run(spark, []) == []


@pytest.mark.parametrize("one_text", [False, True])
def test_hot_phrase(spark, one_text):
    """More places of one phrase than the default bound, in as many documents or in one."""
    r = random.Random(7)
    phrase, n = "all rights to this phrase are held", S.HOT + 4000
    letters = "abcdefghijklmnopqrstuvwxyz"
    around = [("".join(r.choices(letters, k=25)), "".join(r.choices(letters, k=25))) for _ in range(n)]
    around[n // 2:: 50] = around[: n // 2: 50]  # some stand twice
    texts = [a + phrase + b for a, b in around]
    docs = [(1, "".join(texts)), *[(i + 2, t) for i, t in enumerate(texts[::40])]] if one_text else list(enumerate(texts))
    want = brute(docs)
    assert sum(w[2] > 0 for w in want) > 200
    assert run(spark, docs) == want


def test_hot_anchors_are_told_to_their_chunks():
    def rows(chunk, kind, hashes, refs):
        return (0, chunk, kind, *S._split(np.array(hashes, np.uint64)), np.array(refs, np.uint16).tobytes())

    sent = [
        rows(0, S.SOLO, [5, 6, 7], [0, 1, 2]), rows(1, S.SOLO, [5, 6, 8], [3, 4, 5]), rows(2, S.SEVERAL, [6, 9], [40, 60]),
        rows(1, S.OFTEN, [5, 8], [48, 90]),
    ]
    out = pa.Table.from_batches(S._shared_anchors(50)(S._table(sent, S.ANCHOR_ROWS).to_batches())).to_pylist()
    got = {(x["chunk"], x["kind"], int(h)) for x in out for h in S._joined(x["high"], x["low"])}
    back = {(0, S.SOLO, 5), (0, S.SOLO, 6), (1, S.SOLO, 5), (1, S.SOLO, 6)}
    # 5 occurs 1 + 49 times, 6 occurs 42 times, 8 in one document only
    assert got == back | {(2, S.OFTEN, 9)}
    out = pa.Table.from_batches(S._shared_anchors(45)(S._table(sent, S.ANCHOR_ROWS).to_batches())).to_pylist()
    got = {(x["chunk"], x["kind"], int(h)) for x in out for h in S._joined(x["high"], x["low"])}
    assert got == back | {(2, S.OFTEN, 9), (0, S.OFTEN, 5), (1, S.OFTEN, 5)}


def test_whole_table(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    got = sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in op1_suffix_dedup(spark, SF_SMALL).collect())
    assert got == brute(docs)
