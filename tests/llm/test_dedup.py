"""Exact and SimHash dedup and the url filter against brute force."""

import hashlib
import random
import re
from collections import defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
import xxhash

from conftest import SF_SMALL
from tidecast.llm import exact_dedup as X
from tidecast.llm import simhash as S
from tidecast.llm import url_filter as U
from tidecast.llm.queries import URL_RULES, op8_simhash_near_dedup, op9_exact_dedup, op10_url_filter

# --- exact ---------------------------------------------------------------------


def norm(t):
    return re.sub(r"[\x20\x09-\x0D]+", " ", t or "")


def exact(docs):
    by = defaultdict(list)
    for i, t in docs:
        by[norm(t)].append(i)
    out = []
    for i, t in docs:
        group = by[norm(t)]
        keep = min((x for x in group if x is not None), default=None)
        out.append((-1 if i is None else i, -1 if keep is None else keep, len(group), i == keep, hashlib.sha256(norm(t).encode()).hexdigest()))
    return sorted(out)


def run_exact(df):
    return sorted((-1 if r.doc_id is None else r.doc_id, -1 if r.keep_id is None else r.keep_id, r.group_size, r.kept, r.text_sha256) for r in X.exact_dedup(df).collect())


def test_quotient_filters_count_and_merge():
    r = np.random.default_rng(1)
    fps = r.integers(0, 2**63, 400).astype(np.uint64)
    parts = [r.choice(fps, 300) >> np.uint64(4) for _ in range(5)]
    merged = None
    for p in parts:
        f = X.QuotientFilter.unpack(X.QuotientFilter.build(p, np.ones(len(p), np.int64), 4).pack())
        merged = f if merged is None else merged.merge(f)
    keys, counts = np.unique(np.concatenate(parts), return_counts=True)
    assert (merged.fingerprints(0, 4) == keys).all() and (merged.counts == counts).all()
    assert merged.runs.sum() == len(keys)


EXACT = [(3, "a  b"), (1, "a b"), (7, "a\t\nb"), (2, "a b "), (9, None), (8, ""), (5, " "), (None, "a b"), (None, "only"), (None, "only"), (4, "x"), (4, "x"), (6, "é " * 200_000)]


def test_exact_cases(spark):
    df = spark.createDataFrame([(*d, "s", 1) for d in EXACT], "doc_id long, text string, norm string, fp int")
    assert run_exact(df) == exact(EXACT)
    assert run_exact(df.limit(0)) == []


def test_exact_by_shuffle(spark, monkeypatch):
    monkeypatch.setattr("tidecast.llm.common.BROADCAST_ROWS", 0)
    monkeypatch.setattr(X, "small_side", lambda df: df)
    docs = [(i, f"text {i % 40} " * (i % 7)) for i in range(500)]
    assert run_exact(spark.createDataFrame(docs, "doc_id long, text string")) == exact(docs)


def test_exact_whole_table(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF_SMALL}/documents.parquet')")
    want = sorted(con.execute(f"SELECT doc_id, keep_id, group_size, kept, text_sha256 FROM ({X.SQL})").fetchall())
    assert sorted(tuple(r) for r in op9_exact_dedup(spark, SF_SMALL).select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()) == want


# --- SimHash -------------------------------------------------------------------


def bits(text, n=3):
    words = [w.encode() for w in re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))]
    grams = [b" ".join(words[i: i + n]) for i in range(max(len(words) - n + 1, 1))] if words else []
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def classes(fps, radius=3):
    up = list(range(len(fps)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for a in range(len(fps)):
        for b in range(a):
            if (fps[a] ^ fps[b]).bit_count() <= radius:
                up[root(a)] = root(b)
    return [root(i) for i in range(len(fps))]


def want_groups(docs):
    fps = [bits(t) for _, t in docs]
    by = defaultdict(list)
    root = classes(fps)
    for (i, _), r in zip(docs, root):
        by[r].append(i)
    least = {r: min((i for i in own if i is not None), default=-1) for r, own in by.items()}
    return sorted((-1 if i is None else i, f"{f:016x}", least[r]) for (i, _), f, r in zip(docs, fps, root))


def got_groups(rows):
    return sorted((-1 if r.doc_id is None else r.doc_id, r.fingerprint, -1 if r.component_id is None else r.component_id) for r in rows)


def test_filters_merge_in_pairs():
    """Any number of filters of a range gives the counts of all fingerprints."""
    r = np.random.default_rng(3)
    for n in (1, 2, 3, 7, 200):
        parts = [r.integers(0, 3000, 50).astype(np.uint64) << np.uint64(40) for _ in range(n)]
        packed = [X.QuotientFilter.build(p, np.ones(50, np.int64), 4).pack() for p in parts]
        got = X._merged(4)((pa.scalar(0),), pa.table({"filter": pa.array(packed, pa.binary())})).to_pydict()
        values, counts = np.unique(np.concatenate(parts), return_counts=True)
        assert dict(zip(got["fp"], got["n"])) == {int(v): int(c) for v, c in zip(values, counts) if c > 1}


def test_simhash_cases(spark):
    r = random.Random(3)
    base = [r.choice("abcdefgh") + str(r.randrange(50)) for _ in range(400)]
    docs = [(1, None), (0, ""), (5, " \t"), (None, ""), (None, "just two"), (6, "One"), (7, "one"), (8, "one two"), (8, "one two"), (9, "ÄB äb Ab"), (10, "w " * 100_000)]
    for i in range(60):
        t = list(base)
        for _ in range(i % 9):
            t[r.randrange(len(t))] = "zz"
        docs.append((100 + i, " ".join(t)))
    df = spark.createDataFrame([(*d, 1, "x") for d in docs], "doc_id long, text string, fp int, node string")
    want = want_groups(docs)
    assert len({w[2] for w in want}) < len(docs) - 20
    assert got_groups(S.simhash_groups(df).collect()) == want
    assert S.simhash_groups(df.limit(0)).count() == 0


@pytest.mark.parametrize("rows", [100_000, 40])
@pytest.mark.parametrize("n", [100, 10**7, 10**10, 10**13])
def test_links_of_a_dense_ball(spark, monkeypatch, rows, n):
    """Fingerprints around a few centres; also with shards split into several trees."""
    monkeypatch.setattr(S, "SHARD_ROWS", rows)
    make = S.tables
    monkeypatch.setattr(S, "tables", lambda _, radius: make(n, radius))
    r = random.Random(n)
    centres = [r.getrandbits(64) for _ in range(5)]
    fps = {0, 2**64 - 1}
    while len(fps) < 400:
        x = r.choice(centres)
        for _ in range(r.choice((0, 1, 2, 2, 3, 5, 6))):
            x ^= 1 << r.randrange(64)
        fps.add(x)
    fps = sorted(fps)
    nodes = spark.createDataFrame([(f - 2**64 if f >> 63 else f, i) for i, f in enumerate(fps)], "fp long, node long")
    stars = {x.a: x.b for x in S.components(S.near_links(nodes, 3)).collect()}
    root = classes(fps)
    least = {}
    for i, x in enumerate(root):
        least.setdefault(x, i)
    assert [stars.get(i, i) for i in range(len(fps))] == [least[x] for x in root]


def test_components_of_a_long_chain(spark):
    edges = [(i + 1, i) for i in range(300)] + [(1000, 500), (900, 500)]
    random.Random(1).shuffle(edges)
    stars = {x.a: x.b for x in S.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert stars == {i: 0 for i in range(1, 301)} | {1000: 500, 900: 500}


def test_simhash_whole_table(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    assert got_groups(op8_simhash_near_dedup(spark, SF_SMALL).collect()) == want_groups(docs)


# --- urls ----------------------------------------------------------------------


def parts(url):
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    return re.sub("[A-Z]", lambda m: m[0].lower(), host), path


def rule(host, path):
    fit = []
    for what, name in URL_RULES:
        h, p = name[: name.index("/")], name[name.index("/"):]
        if (host == h or host.endswith("." + h)) and path.startswith(p):
            fit.append((len(name), name, what))
    return max(fit)[1:] if fit else (None, None)


class Counts:
    """The same Markov models over plain strings, counted without hashing."""

    def __init__(self, urls):
        self.pair, self.context = [defaultdict(int), defaultdict(int)], [defaultdict(int), defaultdict(int)]
        for url, kind in urls:
            raw = url.encode()
            for i, c in enumerate(raw):
                for order in range(U.ORDER + 1):
                    past = raw[i - order: i] if i >= order else b"\0" * (order - i) + raw[:i]
                    self.pair[kind][past, c] += 1
                    self.context[kind][past] += 1

    def ratio(self, url):
        raw, total = url.encode(), 0.0
        for i, c in enumerate(raw):
            p = [1 / 256] * 2
            for order in range(U.ORDER + 1):
                past = raw[i - order: i] if i >= order else b"\0" * (order - i) + raw[:i]
                for k in (0, 1):
                    n = self.context[k][past]
                    p[k] = (self.pair[k][past, c] + U.STRENGTH * p[k]) / (n + U.STRENGTH)
            total += np.log(p[1]) - np.log(p[0])
        return total / max(len(raw), 1)


URLS = ["http://a.com/en/1", "https://WWW.Example.com/en/2?x#y", "http://blog.example.com/en/3", "http://example.com/de/4", "http://b.net/es/5", "https://x.net/fr/6/", "http://x.net/en/7",
        "http://y.org/en/8", "ftp://u@h.com:80/", "http://com", "http://com/", "http://acom/", "no scheme", "", None, "://h.net/es/", "http://a.com?b://c.net/es/", "http://a.com\n/en/", "a://b://c/d", "http://ü.com/é", "http://n.net/es/" + "q" * 100_000]


def test_urls(spark):
    df = spark.createDataFrame([(i, u, "host") for i, u in enumerate(URLS)] + [(None, "http://a.com/", ""), (3, URLS[3], ""), (3, URLS[3], "")], "page_id long, url string, rule string")
    rows = U.filter_urls(df, URL_RULES).collect()
    assert len(rows) == len(URLS) + 3
    for r in rows:
        if r.page_id is not None:
            host, path = parts(URLS[r.page_id])
            name, what = rule(host, path)
            assert (r.host, r.path, r.rule) == (host, path, name)
            assert r.verdict == what if what else r.verdict in ("allow", "block")
    assert U.filter_urls(df.limit(0), URL_RULES).count() == 0
    assert {r.verdict for r in U.filter_urls(df.where("url like '%org%'"), URL_RULES).collect()} == {"allow"}


def test_urls_whole_table(spark):
    rows = op10_url_filter(spark, SF_SMALL).collect()
    urls = {r.page_id: r.url for r in spark.read.parquet(f"{SF_SMALL}/pages.parquet").collect()}
    assert len(rows) == len(urls)
    known = [(urls[r.page_id], int(rule(r.host, r.path)[1] == "allow")) for r in rows if r.rule]
    model = Counts(known)
    for r in rows:
        assert (r.host, r.path) == parts(urls[r.page_id]) and r.rule == rule(r.host, r.path)[0]
        # hashed slots may be shared; at this size hardly any are
        assert r.score == pytest.approx(model.ratio(urls[r.page_id]), abs=0.05)
    judged = {r.verdict for r in rows if not r.rule}
    lowest = min((r.score for r in rows if not r.rule and r.verdict == "allow"), default=9)
    assert judged <= {"allow", "block"} and all(r.score < lowest for r in rows if not r.rule and r.verdict == "block")


def test_url_counts_are_exact(spark):
    r = random.Random(3)
    urls = [(f"http://{'a.com/en' if i % 3 else 'h.net/es'}/" + "".join(r.choices("abcdefghijklmnopqrstuvwxyzé0123456789%/", k=40))) for i in range(6000)]
    urls += [f"http://n.org/de/{r.random()}" for _ in range(50)]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    rows = U.filter_urls(df, URL_RULES).collect()
    model = Counts([(urls[x.page_id], int(rule(x.host, x.path)[1] == "allow")) for x in rows if x.rule])
    assert len({key for kind in model.pair for key in kind}) > 1 << 17 and len({x.verdict for x in rows if x.rule}) == 2
    for x in rows[::20] + rows[-50:]:
        assert x.score == pytest.approx(model.ratio(urls[x.page_id]), abs=1e-8)
