"""Hard-negative mining by cover trees over norm-augmented vectors.

Every component x of a vector becomes ``floor(scale * x)``; a score is the
integer inner product.  With a last coordinate ``sqrt(M^2 - |x|^2)`` all
candidates lie on one sphere of radius M and an anchor (last coordinate 0) has
``score = (|q|^2 + M^2 - distance^2) / 2``: large scores are near neighbours.

Candidates are dealt to trees of ``TREE_ROWS`` vectors, neighbours in a
coarse order of label and direction together.  A node of a tree covers its
vectors within a radius that shrinks from level to level by ``BASE``; vectors
that no child of ``LEAF`` or more covers stay with the node.  The triangle
inequality bounds the scores below a node from both sides, and a node knows
the labels below it.  The descent opens nodes by their upper bound and skips
those without a wanted label, above the window, below it, or below the last
place that is still to be had; vectors of opened nodes are verified with exact
integers.  Bounds get a slack beyond rounding, so no result depends on them.

Anchors are read in blocks of at most ``BLOCK`` and each block, the only
thing broadcast, is looked up in all trees.  A task keeps the best places of
its block's anchors over its trees, so what it returns, and the thresholds
that prune its later trees, don't grow with the candidates.

Cases: rows with a null id, label or vector, or with a null or non-finite
component take no part.  Rows that repeat an id count once, as the one with
the least label, then vector.  Missing last components count as 0.  Components and
scores beyond a long are cut to the largest or smallest long.  An
anchor without positives, or a positive without a row in its window, gives no
row.  Equal scores are ordered by id.  Empty tables give empty results; other
columns are not looked at.
"""

from __future__ import annotations

import heapq
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidecast.llm.common import written
from tidecast.session import ensure_checkpoint_dir

#: Vectors in a tree; anchors in a block.
TREE_ROWS, BLOCK = 4096, 8192
#: Radii of neighbouring levels; least vectors of a child.
BASE, LEAF = 1.3, 128
#: Candidate centres whose distances are computed together.
CENTRES = 64
LONG = 2**63 - 1
#: Integers up to here are exact in floating point.
EXACT = 2.0**53
#: Share of squared norms that rounding of distances can reach at most.
ROUNDING = 1e-6

TREE = "first array<int>, last array<int>, own array<int>, radius array<double>, low array<int>, high array<int>, centre array<int>, ids array<long>, labels array<int>, dim int, vectors array<long>"


def candidates(vectors: DataFrame, vec_id: Column, label: Column, vector: Column, scale: int) -> DataFrame:
    """(vec_id, label, vec array<long>) of the rows that take part, an id once."""
    rows = vectors.select(vec_id.cast("long").alias("vec_id"), label.cast("int").alias("label"), vector.cast("array<double>").alias("x"))
    finite = F.forall("x", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("x").isNotNull() & finite)
    vec = F.transform("x", lambda x: F.floor(F.lit(float(scale)) * x))
    least = F.min(F.struct("label", vec.alias("vec"))).alias("row")
    return rows.groupBy("vec_id").agg(least).select("vec_id", "row.label", "row.vec")


class Vectors:
    """Integer vectors whose inner products are exact."""

    def __init__(self, whole: np.ndarray):
        self.whole = whole
        self.float = whole.astype(np.float64)
        self.norm = np.sqrt((self.float**2).sum(1)) if whole.size else np.zeros(len(whole))
        self.top = float(np.abs(self.float).max(initial=0.0))

    def scores(self, rows: np.ndarray, q: "Vectors", i: int) -> np.ndarray:
        d = min(self.whole.shape[1], q.whole.shape[1])
        if self.top * q.top * max(d, 1) < EXACT:
            return (self.float[rows, :d] @ q.float[i, :d]).astype(np.int64)
        exact = self.whole[rows, :d].astype(object) @ q.whole[i, :d].astype(object)
        return np.array([min(max(int(s), -LONG - 1), LONG) for s in exact], np.int64)


def _matrix(flat: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Ragged rows as a matrix, missing last components 0."""
    out = np.zeros((len(sizes), int(sizes.max(initial=0))), np.int64)
    out[np.arange(out.shape[1]) < sizes[:, None]] = flat
    return out


class CoverTree:
    """Nodes in breadth-first order.  A node's vectors are ``order[own:last]``
    of a permutation in which the children's come first: ``order[first:own]``."""

    def __init__(self, v: Vectors, labels: np.ndarray):
        self.v, n = v, len(labels)
        m = v.norm.max(initial=0.0)
        self.points = np.c_[v.float, np.sqrt(np.maximum(m * m - v.norm**2, 0.0))]
        self.order = np.arange(n)
        self.first, self.own, self.last, self.centre, self.radius, self.child = [], [], [], [], [], []
        heads = [(0, n, 0)] if n else []
        while heads:  # one level after the other
            level = []
            for first, last, c in heads:
                rows = self.order[first:last]
                d = self._distance(rows, np.array([c]))[:, 0]
                cover = float(d.max(initial=0.0))
                kept, rest = self._children(rows, cover / BASE) if cover > ROUNDING * m and last - first > LEAF else ([], rows)
                self.first.append(first)
                self.centre.append(c)
                self.radius.append(cover)
                self.last.append(last)
                for centre, inside in kept:
                    level.append((first, first + len(inside), centre))
                    self.order[first: first + len(inside)] = inside
                    first += len(inside)
                self.own.append(first)
                self.order[first:last] = rest
            heads = level
        lab = labels[self.order]
        self.low = [int(lab[a:b].min()) for a, b in zip(self.first, self.last)]
        self.high = [int(lab[a:b].max()) for a, b in zip(self.first, self.last)]

    def _distance(self, rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
        p, c = self.points[rows], self.points[centres]
        gap = (p * p).sum(1)[:, None] + (c * c).sum(1)[None] - 2 * p @ c.T
        return np.sqrt(np.maximum(gap, 0.0))

    def _children(self, rows: np.ndarray, radius: float) -> tuple[list, np.ndarray]:
        """Greedy net: centres over ``radius`` apart that cover all rows;
        (children of LEAF rows or more, rows of the smaller ones)."""
        kept, small = [], []
        while len(rows):
            near = self._distance(rows, rows[:CENTRES]) <= radius
            free = np.ones(len(rows), bool)
            for j in range(min(CENTRES, len(rows))):
                if not free[j]:
                    continue
                mine = near[:, j] & free
                mine[j] = True
                free &= ~mine
                inside = rows[mine]
                kept.append((rows[j], inside)) if len(inside) >= LEAF else small.append(inside)
            rows = rows[free]
        if len(kept) == 1 and not small:  # a wider net would not end
            inside = kept[0][1]
            return [], inside
        return kept, np.concatenate(small) if small else rows


def _plant(rows: pa.Table) -> pa.RecordBatch:
    """One row that holds the tree of ``rows``."""
    vec = rows["vec"].combine_chunks()
    sizes = np.diff(vec.offsets.to_numpy())
    whole = _matrix(vec.flatten().to_numpy(zero_copy_only=False), sizes)
    labels, ids = rows["label"].to_numpy(), rows["vec_id"].to_numpy()
    tree = CoverTree(Vectors(whole), labels)
    at = tree.order
    place = np.empty(len(at), np.int64)
    place[at] = np.arange(len(at))
    row = {
        "first": tree.first, "last": tree.last, "own": tree.own, "radius": tree.radius, "low": tree.low, "high": tree.high,
        "centre": place[np.array(tree.centre, np.int64)].tolist(), "ids": ids[at], "labels": labels[at], "dim": whole.shape[1], "vectors": whole[at].ravel(),
    }
    kinds = {"radius": pa.list_(pa.float64()), "ids": pa.list_(pa.int64()), "vectors": pa.list_(pa.int64()), "dim": pa.int32()}
    names = [x.split()[0] for x in TREE.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([row[k]], kinds.get(k, pa.list_(pa.int32()))) for k in names], names)


def plant(rows: DataFrame) -> DataFrame:
    """Table of trees over all candidates, written.  Rows are sorted by label
    and the signs of their first components within evenly sized ranges, so that
    a tree holds few labels and one side of the space."""
    n = rows.count()
    parts = max(1, min(-(-n // TREE_ROWS), int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    signs = F.transform(F.slice("vec", 1, 16), lambda x: x >= 0)
    dealt = rows.repartitionByRange(parts, "label", signs, "vec_id").sortWithinPartitions("label", signs, "vec_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for b in batches:
            held.append(b)
            size += b.num_rows
            while size >= TREE_ROWS:
                t = pa.Table.from_batches(held)
                yield _plant(t.slice(0, TREE_ROWS))
                held = t.slice(TREE_ROWS).to_batches()
                size -= TREE_ROWS
        if size:
            yield _plant(pa.Table.from_batches(held))

    return written(dealt.select("vec_id", "label", "vec").mapInArrow(run, TREE))


class Planted:
    """A tree as read back, for lookups."""

    def __init__(self, row: dict):
        for k in ("first", "last", "own", "radius", "low", "high", "centre", "ids", "labels"):
            setattr(self, k, np.array(row[k]))
        self.v = Vectors(np.array(row["vectors"], np.int64).reshape(len(self.ids), row["dim"]))
        self.m = self.v.norm.max(initial=0.0)
        # a node's children are the nodes of the next level that start within it
        self.children = [[] for _ in self.first]
        queue, to = 0, 1
        while queue < len(self.first):
            at = self.first[queue]
            while to < len(self.first) and at < self.own[queue] and self.first[to] == at:
                self.children[queue].append(to)
                at = self.last[to]
                to += 1
            queue += 1

    def bounds(self, q: Vectors) -> tuple[np.ndarray, np.ndarray]:
        """(least, largest) possible score below each node, for every anchor."""
        d = min(q.whole.shape[1], self.v.whole.shape[1])
        inner = q.float[:, :d] @ self.v.float[self.centre, :d].T
        square = (q.norm**2)[:, None] + self.m**2
        dist = np.sqrt(np.maximum(square - 2 * inner, 0.0))
        slack = ROUNDING * square + 1.0
        far, near = dist + self.radius, np.maximum(dist - self.radius, 0.0)
        return (square - far**2) / 2 - slack, (square - near**2) / 2 + slack

    def best(self, q: Vectors, i: int, low: np.ndarray, high: np.ndarray, k: int, anchor: int, label: int, same: bool, least: int, most: int, held: tuple, memo: dict) -> tuple:
        """(scores, ids) of the first k of ``held`` and this tree's vectors
        with a score from ``least`` to ``most``; of the anchor's own label,
        but not itself, or of others.  ``memo``: the anchor's scores of this
        tree's nodes so far."""
        scores, ids = held
        heap = [(-high[0], 0)]
        while heap:
            bound, node = heapq.heappop(heap)
            floor = max(least, int(scores[-1])) if len(scores) == k else least
            if -bound < floor:
                break  # every node left is below
            if low[node] > most or (not self.low[node] <= label <= self.high[node] if same else self.low[node] == self.high[node] == label):
                continue
            for c in self.children[node]:
                heapq.heappush(heap, (-high[c], c))
            if node not in memo:
                rows = slice(self.own[node], self.last[node])
                wanted = (self.labels[rows] == label if same else self.labels[rows] != label) & (self.ids[rows] != anchor)
                rows = np.flatnonzero(wanted) + rows.start
                memo[node] = self.v.scores(rows, q, i), self.ids[rows]
            s, own = memo[node]
            fit = (s >= floor) & (s <= most)
            if fit.any():
                scores, ids = np.concatenate((scores, s[fit])), np.concatenate((ids, own[fit]))
                top = np.lexsort((ids, -scores))[:k]
                scores, ids = scores[top], ids[top]
        return scores, ids


def _lookups(block: dict, k: int, same: bool):
    """For each row of ``block`` the best k over the trees of a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        b = block.value
        q = Vectors(b["whole"])
        none = np.zeros(0, np.int64)
        held = [(none, none)] * len(b["ask"])
        for batch in batches:
            for r in range(batch.num_rows):
                tree = Planted({c: batch.column(c)[r].as_py() if c == "dim" else batch.column(c)[r].values.to_numpy(zero_copy_only=False) for c in batch.schema.names})
                low, high = tree.bounds(q)
                memo, of = {}, -1
                for j, i in enumerate(b["ask"].tolist()):
                    memo, of = (memo if i == of else {}), i
                    held[j] = tree.best(q, i, low[i], high[i], k, b["id"][i], b["label"][i], same, int(b["least"][j]), int(b["most"][j]), held[j], memo)
        sizes = [len(s) for s, _ in held]
        ask = np.repeat(np.arange(len(held)), sizes)
        if len(ask):
            anchors = b["id"][b["ask"]][ask]
            yield pa.RecordBatch.from_arrays(
                [pa.array(anchors), pa.array(b["key"][ask]), pa.array(np.concatenate([i for _, i in held])), pa.array(np.concatenate([s for s, _ in held]))],
                ["anchor_id", "key", "found_id", "score"],
            )

    return run


def _top(trees: DataFrame, asked: DataFrame, k: int, same: bool) -> DataFrame:
    """The first k found rows for every (anchor_id, key) of ``asked``
    (block, vec_id, label, vec, key, least, most), all blocks' answers written
    to one table: anchor_id, key, found_id, score, rank."""
    spark = trees.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{uuid.uuid4().hex}"
    schema = "anchor_id long, key long, found_id long, score long"
    spark.createDataFrame([], schema).write.parquet(path)
    blocks = asked.agg(F.max("block")).first()[0]
    for block in range(-1 if blocks is None else blocks + 1):
        t = asked.where(F.col("block") == block).orderBy("vec_id", "key").toArrow()  # BLOCK rows, more or less
        if not t.num_rows:
            continue
        vec = t["vec"].combine_chunks()
        ids = t["vec_id"].to_numpy()
        new = np.r_[True, ids[1:] != ids[:-1]]
        whole = _matrix(vec.flatten().to_numpy(zero_copy_only=False), np.diff(vec.offsets.to_numpy()))
        shared = spark.sparkContext.broadcast({
            "whole": whole[new], "id": ids[new], "label": t["label"].to_numpy()[new], "ask": np.cumsum(new) - 1,
            "key": t["key"].to_numpy(), "least": t["least"].to_numpy(), "most": t["most"].to_numpy(),
        })
        trees.mapInArrow(_lookups(shared, k, same), schema).write.mode("append").parquet(path)
        shared.destroy()
    found = spark.read.schema(schema).parquet(path)
    place = F.row_number().over(Window.partitionBy("anchor_id", "key").orderBy(F.col("score").desc(), "found_id"))
    return found.withColumn("rank", place).where(F.col("rank") <= k)


def hard_negatives(vectors: DataFrame, anchor: Column, vec_id: str | Column = "vec_id", label: str | Column = "label", vector: str | Column = "embedding",
                   scale: int = 256, n_positives: int = 5, n_negatives: int = 10, low: int = 30, high: int = 90) -> DataFrame:
    """Rows (anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score): for every row that ``anchor`` (a condition on ``vec_id``)
    selects and each of its ``n_positives`` best rows of the same label, the
    ``n_negatives`` best rows of other labels with a score from ``low`` to
    ``high`` percent of the positive's."""
    def col(c):
        return F.col(c) if isinstance(c, str) else c

    rows = written(candidates(vectors, col(vec_id), col(label), col(vector), scale))
    trees = plant(rows)
    anchors = rows.where(anchor)
    blocks = max(1, -(-anchors.count() // BLOCK))
    asked = anchors.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int"))
    every = {"key": F.lit(0).cast("long"), "least": F.lit(-LONG - 1), "most": F.lit(LONG)}
    positives = written(_top(trees, asked.withColumns(every), n_positives, True).select("anchor_id", F.col("found_id").alias("positive_id"), F.col("score").alias("key")))
    # a window is asked once for each score of an anchor's positives; those below 0 have none
    windows = positives.select(F.col("anchor_id").alias("vec_id"), "key").where("key >= 0").distinct()
    exact = F.col("key").cast("decimal(38,0)")
    windows = windows.withColumn("least", F.ceil(exact * low / 100).cast("long")).withColumn("most", F.floor(exact * high / 100).cast("long"))
    found = _top(trees, asked.join(windows, "vec_id"), n_negatives, False)
    found = found.select("anchor_id", "key", F.col("rank").cast("int").alias("rank"), F.col("found_id").alias("negative_id"), F.col("score").alias("negative_score"))
    out = positives.join(found, ["anchor_id", "key"])
    return out.select("anchor_id", "positive_id", "rank", "negative_id", F.col("key").alias("positive_score"), "negative_score")
