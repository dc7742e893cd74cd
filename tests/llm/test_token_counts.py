import random

import numpy as np
import pytest

from conftest import SF_SMALL
from tidecast.llm import token_counts as T
from tidecast.llm.queries import VOCABULARY, op7_token_counts


def greedy(word, vocab, longest):
    n = at = 0
    while at < len(word):
        for k in range(min(longest, len(word) - at), 0, -1):
            if word[at: at + k] in vocab:
                break
        at += k  # a byte that no piece starts with is skipped: k is 1 then
        n += 1
    return n


def brute(text, vocab, prefix=b" ", suffix=b""):
    longest = max(map(len, vocab), default=1)
    found = (text or "").encode().split()
    return len(found), sum(greedy(prefix + w + suffix, vocab, longest) for w in found)


@pytest.mark.parametrize("seed", range(30))
def test_random_vocabularies(seed):
    r = random.Random(seed)
    vocab = {bytes(r.choices(b"abc", k=r.randint(1, 6))) for _ in range(r.randint(1, 25))}
    if seed % 3:
        vocab |= {b"a", b"b", b"c"}
    a = T.Automaton(sorted(vocab))
    ws = [bytes(r.choices(b"abcd" if seed % 2 else b"abc", k=r.randint(1, 30))) for _ in range(200)]
    data = np.frombuffer(b" ".join(ws), np.uint8)
    start, length = T.words(data)
    assert a.count_words(data, start, length).tolist() == [greedy(w, vocab, 6) for w in ws]
    assert a.count_words(data, start, length, b"b", b"ab").tolist() == [greedy(b"b" + w + b"ab", vocab, 6) for w in ws]


def test_cases(spark):
    vocab = [b" ", b"a", b"ab", b" abc", b"\xc3"]
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "abc ab\tzab"), (5, "é abab"), (5, "é abab"), (None, "a"), (7, "ab" * 50_000 + " x" * 50_000)]
    df = spark.createDataFrame([(i, t, 0) for i, t in rows], "doc_id long, text string, n_tokens int")
    got = sorted((r.doc_id or -1, r.n_words, r.n_tokens) for r in T.token_counts(df, vocab).collect())
    assert got == sorted((i or -1, *brute(t, set(vocab))) for i, t in rows)
    assert T.token_counts(df.limit(0), vocab).count() == 0


def test_whole_table(spark):
    vocab = set(T.read_vocabulary(VOCABULARY))
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    rows = op7_token_counts(spark, SF_SMALL).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert (r.n_words, r.n_tokens) == brute(texts[r.doc_id], vocab)
