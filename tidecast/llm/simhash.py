"""SimHash near-dedup: BK-trees over shards of the fingerprints.

A text gives one 64-bit fingerprint of its word shingles.  Documents link if
their fingerprints differ in at most ``radius`` bits; each gets the smallest
doc_id that it reaches over links.

Distinct fingerprints are dealt to shards by bit blocks: with ``radius + a``
blocks, two fingerprints within the radius agree on at least ``a`` whole
blocks, so each choice of ``a`` blocks is one table and the bits of these
blocks are the shard.  Every shard gets a BK-tree (children keyed by their
distance to the parent) and each fingerprint is looked up in the tree of its
shard, following only edges within the radius.  A shard leaves no more than
a spanning forest of its links, and components are joined by alternating
star contraction over Spark tables.  All fingerprints of a 100 TB corpus are
no bounded broadcast, so trees are built where the shuffle puts their shard;
a shard over ``SHARD_ROWS`` is split into several trees and as many lots of
queries, and a group is one tree with one lot, so no group grows with the shard.

Cases: a null or blank text has the fingerprint 0 and links like any other;
fewer words than a shingle give one shingle of the whole sequence; rows with
a null doc_id get a fingerprint, and their component_id is the smallest
non-null id reached (null if there is none); repeated rows are returned as
often as they occur; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidecast.llm.common import column, text_of, written

BITS = 64
SEED = 42
#: Fingerprints in one tree.
SHARD_ROWS = 100_000
#: Pairs of a query and a node looked at in one numpy step.
FRONTIER = 2_000_000
NO_ID = 2**63 - 1


def fingerprint(text: str, shingle: int) -> int:
    """Majority bits of the XXH64 values of the text's word shingles."""
    words = text.encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.r_[0, ends[:-1] + 1][: len(words) - shingle + 1]
    hash64 = xxhash.xxh64_intdigest
    counts, n = np.zeros(BITS, np.int64), len(starts)
    for at in range(0, n, 1 << 16):
        s, e = starts[at: at + (1 << 16)].tolist(), ends[shingle - 1 + at: shingle - 1 + at + (1 << 16)].tolist()
        h = np.fromiter((hash64(joined[a:b], SEED) for a, b in zip(s, e)), "<u8", len(s))
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > n, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, shingle: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fp) for every row; fp is the fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.array([fingerprint(x, shingle) for x in b.column(1).to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps, pa.int64())], ["doc_id", "fp"])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_of(text).alias("text"))
    return rows.mapInArrow(run, "doc_id long, fp long")


def tables(n: int, radius: int) -> list[int]:
    """Bit masks of the tables: the more fingerprints, the more blocks must
    agree, so that a shard of evenly spread fingerprints stays small."""
    agree = 1
    while n >> (BITS * agree // (radius + agree)) > 64 and agree < 4:
        agree += 1
    blocks = radius + agree
    edges = [BITS * i // blocks for i in range(blocks + 1)]
    masks = [((1 << edges[i + 1]) - 1) ^ ((1 << edges[i]) - 1) for i in range(blocks)]
    out = [sum(masks[i] for i in pick) for pick in combinations(range(blocks), agree)]
    return [m - (1 << 64) if m >= 1 << 63 else m for m in out]


class BKTrees:
    """One BK-tree for each group, held in flat arrays.

    ``edges`` holds ``parent * 65 + distance`` in order, ``child`` the node
    that the edge leads to.
    """

    def __init__(self, group: np.ndarray, fp: np.ndarray):
        """``group``: ascending; the first element of each is its root."""
        self.fp = fp
        first = np.r_[True, group[1:] != group[:-1]]
        self.root = np.flatnonzero(first)[np.cumsum(first) - 1]
        at, active = self.root.copy(), np.flatnonzero(~first)
        edges, child = [], []
        while len(active):
            d = np.bitwise_count(fp[active] ^ fp[at[active]]).astype(np.int64)
            key = at[active] * 65 + d
            order = np.argsort(key, kind="stable")
            key, active = key[order], active[order]
            new = np.r_[True, key[1:] != key[:-1]]
            edges.append(key[new])
            child.append(active[new])
            at[active] = active[new][np.cumsum(new) - 1]
            active = active[~new]
        edges = np.concatenate(edges) if edges else np.zeros(0, np.int64)
        child = np.concatenate(child) if child else np.zeros(0, np.int64)
        order = np.argsort(edges, kind="stable")
        self.edges, self.child = edges[order], child[order]

    def within(self, roots: np.ndarray, fp: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query, node) at distance ``radius`` or less."""
        found, q, v = [], np.arange(len(fp)), roots
        while len(q):
            d = np.bitwise_count(fp[q] ^ self.fp[v]).astype(np.int64)
            hit = d <= radius
            found.append((q[hit], v[hit]))
            lo = np.searchsorted(self.edges, v * 65 + np.maximum(d - radius, 0), "left")
            hi = np.searchsorted(self.edges, v * 65 + np.minimum(d + radius, 64), "right")
            n = hi - lo
            q = np.repeat(q, n)
            v = self.child[np.repeat(lo - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())]
        return np.concatenate([a for a, _ in found]), np.concatenate([b for _, b in found])


def _unite(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    while True:
        x, y = label[a], label[b]
        differ = x != y
        if not differ.any():
            return
        a, b, x, y = a[differ], b[differ], x[differ], y[differ]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while True:
            up = label[label]
            if (up == label).all():
                break
            label[:] = up


def _forest(radius: int):
    """Rows in order of (mask, shard, part, tree first) to links (a, b), a > b."""

    def links(t: pa.Table) -> pa.RecordBatch | None:
        part = t["part"].to_numpy()
        tree, query = np.asarray(t["tree"]), np.asarray(t["query"])
        mask, shard = t["mask"].to_numpy(), t["shard"].to_numpy()
        fp, node = t["fp"].to_numpy().view(np.uint64), t["node"].to_numpy()
        group = np.cumsum(np.r_[False, (mask[1:] != mask[:-1]) | (shard[1:] != shard[:-1]) | (part[1:] != part[:-1])])
        trees = BKTrees(group[tree], fp[tree])
        roots = np.full(group[-1] + 1, -1)
        roots[group[tree]] = trees.root
        label, place = np.arange(len(fp)), np.flatnonzero(tree)
        ask = np.flatnonzero(query & (roots[group] >= 0))
        size = np.bincount(group[tree], minlength=group[-1] + 1)[group[ask]]
        ask, size = ask[size > 0], np.cumsum(size[size > 0])
        at = 0
        while at < len(ask):
            to = max(at + 1, int(np.searchsorted(size, (size[at - 1] if at else 0) + FRONTIER, "right")))
            own = ask[at:to]
            q, v = trees.within(roots[group[own]], fp[own], radius)
            _unite(label, own[q], place[v])
            at = to
        # a fingerprint may stand in a group twice, as a tree node and as a query: same node, no link
        low = np.full(len(fp), NO_ID)
        np.minimum.at(low, label, node)
        a, b = node, low[label]
        differ = a != b
        if differ.any():
            pairs = np.unique(np.stack([a[differ], b[differ]]), axis=1)
            return pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], ["a", "b"])
        return None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for b in batches:
            held.append(b)
            n += b.num_rows
            if n < SHARD_ROWS:
                continue
            t = pa.Table.from_batches(held).combine_chunks()
            m, s, p = (t[c].to_numpy() for c in ("mask", "shard", "part"))
            cut = np.flatnonzero((m[1:] != m[:-1]) | (s[1:] != s[:-1]) | (p[1:] != p[:-1]))
            if not len(cut):
                continue
            if (out := links(t.slice(0, cut[-1] + 1))) is not None:
                yield out
            held = t.slice(cut[-1] + 1).to_batches()
            n = t.num_rows - cut[-1] - 1
        if n and (out := links(pa.Table.from_batches(held).combine_chunks())) is not None:
            yield out

    return run


def near_links(nodes: DataFrame, radius: int) -> DataFrame:
    """nodes: (fp, node), fp distinct.  Links (a, b), a > b, that span the
    components of each shard."""
    spark, n = nodes.sparkSession, nodes.count()
    masks = F.array(*[F.lit(m).cast("long") for m in tables(n, radius)])
    dealt = nodes.select("fp", "node", F.explode(masks).alias("mask")).withColumn("shard", F.col("fp").bitwiseAND(F.col("mask")))
    sizes = dealt.groupBy("mask", "shard").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    hot = written(sizes.where(F.col("size") > SHARD_ROWS).withColumn("parts", F.ceil(F.col("size") / SHARD_ROWS).cast("int")).drop("size"))
    # each hot shard has over SHARD_ROWS of the rows, so there are at most rows / SHARD_ROWS of them
    if hot.count():
        big = dealt.join(hot, ["mask", "shard"])
        dealt = dealt.join(hot, ["mask", "shard"], "left_anti")
        # part (i, j), i <= j: the fingerprints of i are the tree, those of j the queries
        own = F.pmod(F.xxhash64("fp"), F.col("parts"))
        split = big.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts").cast("long") - 1)))
        part = F.least("own", "other") * F.col("parts") + F.greatest("own", "other")
        tree, query = F.col("own") <= F.col("other"), F.col("own") >= F.col("other")
        split = split.select("mask", "shard", part.alias("part"), tree.alias("tree"), query.alias("query"), "fp", "node")
    dealt = dealt.select("mask", "shard", F.lit(0).cast("long").alias("part"), F.lit(True).alias("tree"), F.lit(True).alias("query"), "fp", "node")
    if hot.count():
        dealt = dealt.unionByName(split)
    keys = ["mask", "shard", "part"]
    rows = dealt.repartition(*keys).sortWithinPartitions(*keys, F.col("tree").desc(), "fp")
    return rows.mapInArrow(_forest(radius), "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """Stars (a, b): b is the smallest node of a's component; alternating
    large-star and small-star steps until the links no longer change."""
    def state(df):
        return tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    links = written(links.distinct())
    before = state(links)
    while before[0]:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        links = written(small.unionByName(least.select("a", F.col("m").alias("b"))).distinct())
        after = state(links)
        if after == before:
            break
        before = after
    return links


def simhash_groups(docs: DataFrame, shingle: int = 3, radius: int = 3, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id."""
    fps = written(fingerprints(docs, shingle, doc_id, text))
    nodes = written(fps.groupBy("fp").agg(F.coalesce(F.min("doc_id"), F.bitwise_not(F.abs(F.xxhash64("fp")))).alias("node"), F.min("doc_id").alias("least")))
    # the node of a fingerprint is its smallest doc_id; one that only rows without an id have gets a number of its own
    stars = components(near_links(nodes.select("fp", "node"), radius))
    placed = nodes.join(stars.withColumnRenamed("a", "node"), "node", "left").withColumn("root", F.coalesce("b", "node"))
    least = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    placed = placed.select("fp", "root").join(least, "root").select("fp", "component_id")
    return fps.join(placed, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
