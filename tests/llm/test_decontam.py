import random
import re

import numpy as np

from conftest import SF_SMALL
from tidecast.llm import decontam as D
from tidecast.llm.queries import op6_decontamination


def fold(text):
    raw = np.frombuffer((text or "").lower().encode(), np.uint8)
    return D.folded(raw, np.array([0, len(raw)]))[0].tobytes().strip(b"\0")


def least_edits(segments, text):
    """Least edits of each whole segment (all of one length) against any region of the text."""
    s, t = np.stack([np.frombuffer(x, np.uint8) for x in segments]), np.frombuffer(text, np.uint8)
    cost, k = np.zeros((len(s), len(t) + 1), np.int32), np.arange(len(t) + 1, dtype=np.int32)
    for i in range(s.shape[1]):
        new = cost + 1
        new[:, 1:] = np.minimum(new[:, 1:], cost[:, :-1] + (t != s[:, i: i + 1]))
        cost = np.minimum.accumulate(new - k, axis=1) + k
    return cost.min(1)


def brute(docs, items):
    by = {}
    for i, t in items:
        for x in D.segments(fold(t).strip()):
            by.setdefault(len(x), []).append((i, x))
    out = {}
    for d, x in docs:
        text = fold(x)
        for n, own in by.items():
            for (i, _), e in zip(own, least_edits([x for _, x in own], text).tolist()):
                if e <= D.budget(n):
                    found, best = out.get((d, i), (0, e))
                    out[d, i] = (found + 1, min(best, e))
    return out


def words(r, n, syllables="an er the on in st re nt ing ti é".split()):
    return " ".join("".join(r.choices(syllables, k=r.randint(1, 4))) for _ in range(n))


def edited(r, text, n):
    t = list(text)
    for _ in range(n):
        at = r.randrange(len(t))
        t[at: at + r.randint(0, 1)] = r.choice(["", "x", "q"])
    return "".join(t)


def run(spark, docs, items):
    a = spark.createDataFrame([(*d, 0, "s") for d in docs], "doc_id long, text string, item_id int, edits string")
    b = spark.createDataFrame([(*i, 0) for i in items], "item_id long, text string, doc_id int")
    return {(r.doc_id, r.item_id): (r.n_segments, r.edits) for r in D.contaminated(a, b).collect()}


def test_random_edits(spark):
    r = random.Random(5)
    items = [(i, words(r, r.choice((2, 5, 9, 14, 30, 60)))) for i in range(30)]
    docs = [(i, words(r, 80)) for i in range(20)]
    for n in range(60):
        body = edited(r, r.choice(items)[1], r.randint(0, 14))
        docs.append((20 + n, f"{words(r, r.randint(0, 30))} {body}{r.choice(['', '.', '!'])} {words(r, r.randint(0, 30))}"))
    want = brute(docs, items)
    assert len(want) > 30
    assert run(spark, docs, items) == want


def test_passage_opens_a_document(spark):
    r = random.Random(11)
    item = "it was a bright cold day in april and the clocks were striking thirteen while he slipped quickly through"
    docs, want = [], set()
    for i, word in enumerate(("it ", "was ", "a ", "bright ", "cold ", "day ", "in ", "april ", "and ", "the ")):
        docs += [(2 * i, words(r, 20)), (2 * i + 1, item.replace(word, "", 1) + " " + words(r, 20))]
        want.add((2 * i + 1, 1))
    assert brute(docs, [(1, item)]).keys() == want
    a = spark.createDataFrame(docs, "doc_id long, text string").coalesce(1)
    rows = D.contaminated(a, spark.createDataFrame([(1, item)], "item_id long, text string")).collect()
    assert {(x.doc_id, x.item_id): (x.n_segments, x.edits) for x in rows} == brute(docs, [(1, item)])
    texts = {d: fold(t) for d, t in docs}
    for x in rows:
        part = texts[x.doc_id][x.first_byte: x.last_byte]
        assert part[-13:] == b"ickly through" and len(part) >= len(item) - 8 and x.first_byte in range(8)


def test_passage_cut_between_documents(spark):
    item = "it was a bright cold day in april and the clocks were striking thirteen while he slipped quickly through"
    docs = [(1, "so " + item[:52]), (2, item[53:] + " so")]
    a = spark.createDataFrame(docs, "doc_id long, text string").coalesce(1)
    assert D.contaminated(a, spark.createDataFrame([(1, item)], "item_id long, text string")).collect() == []


def test_case_and_punctuation(spark):
    item = "The quick, brown fox jumps over the lazy dog; and then it sleeps for the rest of the day."
    docs = [(1, "x " + re.sub(r"\W+", " -- ", item).upper() + " y"), (2, item[:40]), (3, "nothing here"), (None, item), (1, item), (4, item), (4, item)]
    assert set(run(spark, docs, [(7, item), (8, None), (9, ""), (10, "a b")])) == {(1, 7), (None, 7), (4, 7)}


def test_empty_and_long(spark):
    item = words(random.Random(1), 40)
    assert run(spark, [], [(1, item)]) == {} and run(spark, [(1, item)], []) == {}
    assert run(spark, [(1, None), (2, ""), (3, "z " * 3_000_000 + item)], [(1, item), (2, item[5:])]).keys() == {(3, 1), (3, 2)}


def test_blocks_of_the_benchmark(spark, monkeypatch):
    r = random.Random(9)
    items = [(i, words(r, 25)) for i in range(12)]
    docs = [(i, words(r, 10) + " " + t) for i, t in items]
    monkeypatch.setattr(D, "BLOCK_BYTES", 400)
    assert run(spark, docs, items) == brute(docs, items)


def test_whole_table(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    got = {(r.doc_id, r.item_id): (r.n_segments, r.edits) for r in op6_decontamination(spark, SF_SMALL).collect()}
    assert got == brute(docs, items)
