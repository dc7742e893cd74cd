"""The pipeline's stages against brute force on the small tables."""

import re

import pytest
import test_decontam
import test_mixing
import xxhash

import corpus_pipeline as P
from conftest import SF_SMALL


def rows_of(df):
    return {r.doc_id: r for r in df.collect()}


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Rows before and after each stage, and the schema."""
    docs, out = spark.read.parquet(f"{SF_SMALL}/documents.parquet"), []
    for name, stage in P.STAGES:
        path = str(tmp_path_factory.mktemp(name) / "out")
        stage(spark, docs, SF_SMALL).write.parquet(path)
        after = spark.read.parquet(path)
        out.append((name, rows_of(docs), rows_of(after), docs.columns, after.columns, after.count()))
        docs = after
    return {x[0]: x[1:] for x in out}


def test_order_and_columns(stages):
    assert list(stages) == ["toxicity", "exact_dedup", "simhash_near_dedup", "decontamination", "source_mixing"]
    for name, (before, after, given, returned, n) in stages.items():
        assert n == len(after) > 0 and set(after) <= set(before), name
        if name != "source_mixing":
            assert given == returned and all(after[i] == before[i] for i in after)


def test_toxic_go(spark, stages):
    before, after, *_ = stages["toxicity"]
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF_SMALL}/labels.parquet").collect()}
    toxic = [i for i, t in labels.items() if t]
    clean = [i for i, t in labels.items() if not t]
    assert sum(i in after for i in toxic) <= 0.2 * len(toxic) and sum(i in after for i in clean) >= 0.9 * len(clean)


def test_exact(stages):
    before, after, *_ = stages["exact_dedup"]
    first = {}
    for i in sorted(before):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", before[i].text or ""), i)
    assert set(after) == set(first.values())


def fingerprint(text):
    words = [w.encode() for w in re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))]
    grams = [b" ".join(words[i: i + 3]) for i in range(max(len(words) - 2, 1))] if words else []
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_near(stages):
    before, after, *_ = stages["simhash_near_dedup"]
    ids = sorted(before)
    fp = {i: fingerprint(before[i].text) for i in ids}
    up = {i: i for i in ids}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for n, a in enumerate(ids):
        for b in ids[:n]:
            if (fp[a] ^ fp[b]).bit_count() <= 3 and root(a) != root(b):
                x, y = sorted((root(a), root(b)))
                up[y] = x
    assert set(after) == {i for i in ids if root(i) == i}


def test_decontaminated(spark, stages):
    before, after, *_ = stages["decontamination"]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    found = {d for d, _ in test_decontam.brute([(i, r.text) for i, r in before.items()], items)}
    assert set(after) == set(before) - found


def test_mix(spark, stages):
    before, after, *_ = stages["source_mixing"]
    test_mixing.verify(list(after.values()), [(i, r.text, r.source) for i, r in before.items()])


def test_odd_rows(spark, tmp_path):
    """Nulls, empty and repeated rows, further columns; then no rows at all."""
    schema = "doc_id long, text string, lang string, source string, n_chars long, score double, block int, copies string"
    rows = [(1, None, None, None, None, 0.5, 1, "a"), (2, "", "en", "s", 0, None, None, None), (None, "words " * 50, None, "s", 3, 1.0, 2, "b"),
            (None, "words " * 50, None, "s", 3, 1.0, 2, "b"), (4, "other words here", "en", None, 1, None, 3, None), (4, "other words here", "en", None, 1, None, 3, None),
            (6, "long text of words " * 30_000, "en", "t", 1, 0.0, 0, "")]
    for data in (rows, []):
        folder = tmp_path / str(len(data))
        spark.createDataFrame(data, schema).write.parquet(str(folder / "documents.parquet"))
        spark.createDataFrame([], "doc_id long, quality long, toxic long").write.parquet(str(folder / "labels.parquet"))
        spark.createDataFrame([(1, None), (2, "")], "item_id long, text string").write.parquet(str(folder / "benchmark.parquet"))
        out = sorted((-1 if r.doc_id is None else r.doc_id) for r in P.run(spark, str(folder)).collect())
        # 1 and 2 are equal; rows without an id can't be named and rows of one id stay together
        assert out == ([-1, -1, 1, 4, 4, 6] if data else [])


def test_run_is_the_last_stage(spark, stages):
    out = rows_of(P.run(spark, SF_SMALL))
    assert {i: r.copies for i, r in out.items()} == {i: r.copies for i, r in stages["source_mixing"][1].items()}
