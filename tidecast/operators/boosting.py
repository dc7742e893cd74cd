"""Weighted squared-loss boosted trees over histograms.

Feature values become bins once: numeric columns by quantiles of mergeable
sketches (Spark's, over many rows sorted runs), categorical codes one bin
each, missing values a bin of their own.  Binned rows are kept as chunks (one row of Spark holds some
thousand of them, feature by feature) in a written table.  A tree grows level
by level from sums of gradient, hessian and rows by (leaf, feature, bin).
Every split tries the missing bin on both sides; categorical bins are ordered
by their mean gradient.  Gains and leaf values have L1 and L2 penalties.

Fits (one for each horizon and hold-out fold) are independent:

* ``by_fit``: a fit of at most ``TASK_ROWS`` rows runs in one task,
  all fits of a call side by side.
* ``by_level``: beyond that the rows stay where they are.  Each level of
  all fits' trees is one aggregation: tasks add up their chunks' sums, a
  shuffle by (fit, leaf, feature) adds these and finds each one's best split, and
  the driver sees one line for each of them.  Margins are a column that is
  written anew every ``KEEP`` rounds, so a round costs one pass a level and
  nothing is refitted.

Both grow the same trees: row and column samples are drawn from the round and
the chunk.  A fit ends when none of its last ``patience`` rounds lowered the
weighted absolute error of its validation rows; the model is the rounds up
to the best one, a table of nodes with raw gains.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidecast.sources.io import scratch_path

#: Bin of missing values; value bins lie below it.
MISSING = 255
#: Rows of a chunk; rows of a fit that one task may hold.
CHUNK, TASK_ROWS = 16_384, 1_000_000
#: Rounds after which margins are written in ``by_level``.
KEEP = 16
#: Fixed value: smoothing of a category's mean gradient in the order of categories.
CAT_SMOOTH = 10.0
MIN_HESSIAN = 1e-3

NODES = (
    "fit int, fold int, tree int, node int, feature string, cut double, missing_left boolean, codes array<int>, "
    "left int, right int, value double, gain double, n_rows long, error double, rounds int"
)


@dataclass(frozen=True)
class Settings:
    """The booster settings of the modelled configuration."""

    max_depth: int = 4
    max_leaves: int = 32
    learning_rate: float = 0.1
    row_share: float = 0.8
    column_share: float = 0.8
    min_rows: int = 10
    l1: float = 0.1
    l2: float = 0.1
    max_rounds: int = 100_000
    patience: int = 200
    seed: int = 777


# --- bins ----------------------------------------------------------------------

@dataclass(frozen=True)
class Bins:
    """``edges``: for each numeric column the values at which bins end (a value
    equal to an edge lies below it).  ``levels``: codes of a categorical column."""

    columns: tuple[str, ...]
    edges: dict
    levels: dict

    def is_cat(self, i: int) -> bool:
        return self.columns[i] in self.levels

    def of(self, column: str, values: np.ndarray) -> np.ndarray:
        """Bins of float values, NaN where there is none."""
        missing = np.isnan(values)
        if column in self.levels:
            known = ~missing & (values >= 0) & (values < self.levels[column])
            return np.where(known, np.where(known, values, 0), MISSING).astype(np.uint8)
        return np.where(missing, MISSING, np.minimum(np.searchsorted(self.edges[column], values, "left"), MISSING - 1)).astype(np.uint8)


#: Array column in which a packed frame holds its numeric columns.
PACKED = "_numeric"


def pack(columns: Sequence[str]) -> Column:
    """``columns`` as one array of doubles: every later step carries one column instead of all of them."""
    return F.array(*[F.col(c).cast("double") for c in columns]).cast("array<double>").alias(PACKED)


def _matrix(b: pa.RecordBatch, width: int) -> np.ndarray:
    """Rows of a batch's packed columns, NaN where there is none."""
    cells = b.column(b.schema.get_field_index(PACKED))
    return cells.flatten().to_numpy(zero_copy_only=False).astype(float, copy=False).reshape(b.num_rows, width)


#: Rows up to which Spark's quantile sketch finds the edges.
SKETCH_ROWS = 1_000_000
#: Values and counts of a column in a sketch; rows that a task sorts at a time.
POINTS, SORTED = 40_000, 65_536
#: Groups of tasks whose sketches are merged before those of a column meet.
GROUPS = 64
SKETCH = "part int, column string, points array<double>, counts array<long>, top double, whole boolean"


def _sketch(parts: list[tuple]) -> tuple:
    """(values, counts, largest value, whole) of several such; distinct values with
    their counts as long as they are at most ``POINTS`` (whole), else the
    middles of that many equal shares of the rows."""
    points, counts = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
    order = np.argsort(points, kind="stable")  # merges sorted runs
    points, counts = points[order], counts[order]
    first = np.flatnonzero(np.r_[True, points[1:] != points[:-1]][: len(points)])
    points, counts = points[first], np.add.reduceat(counts, first) if len(first) else counts
    whole = all(p[3] for p in parts)
    tops = [p[2] for p in parts if p[2] is not None]
    top = max(tops) if tops else None
    if len(points) > POINTS:
        below, whole = np.cumsum(counts), False
        edges = np.arange(POINTS + 1) * int(below[-1]) // POINTS
        middles = (edges[:-1] + edges[1:]) // 2
        points, counts = points[np.searchsorted(below, middles, "right")], np.diff(edges)
    return points, counts, top, whole


def _sketch_rows(part: int, sketches: dict) -> pa.Table:
    values = [[part] * len(sketches), list(sketches), *([x[i] for x in sketches.values()] for i in range(4))]
    kinds = [pa.int32(), pa.string(), pa.list_(pa.float64()), pa.list_(pa.int64()), pa.float64(), pa.bool_()]
    return pa.table([pa.array(v, k) for v, k in zip(values, kinds)], names=[x.split()[0] for x in SKETCH.split(", ")])


def _sketch_partition(batches: Iterator[pa.RecordBatch], packed: Sequence[str] = ()) -> Iterator[pa.RecordBatch]:
    """A sketch for each column of a partition's rows; ``packed`` names those of the
    packed array.  Runs of ``SORTED`` rows are
    merged in pairs of equal size, so n rows are cut log2(n / SORTED) times at most."""
    levels: dict[str, list] = {}
    held: list = []

    def flush() -> None:
        rows = pa.Table.from_batches(held)
        matrix = np.concatenate([_matrix(b, len(packed)) for b in held]) if packed else None
        held.clear()
        for c in [*packed, *(c for c in rows.column_names if c != PACKED)]:
            x = matrix[:, packed.index(c)] if c in packed else rows[c].combine_chunks().drop_null().to_numpy(zero_copy_only=False)
            x = np.sort(x[~np.isnan(x)])
            first = np.flatnonzero(np.r_[True, x[1:] != x[:-1]][: len(x)])
            own, stack = _sketch([(x[first], np.diff(np.r_[first, len(x)]), float(x[-1]) if len(x) else None, True)]), levels.setdefault(c, [])
            i = 0
            while i < len(stack) and stack[i] is not None:
                own, stack[i], i = _sketch([stack[i], own]), None, i + 1
            stack[i:i + 1] = [own]

    for b in batches:
        for at in range(0, b.num_rows, SORTED):
            held.append(b.slice(at, SORTED))
            if sum(x.num_rows for x in held) >= SORTED:
                flush()
    if held:
        flush()
    yield from _sketch_rows(TaskContext.get().partitionId() % GROUPS, {c: _sketch([s for s in stack if s is not None]) for c, stack in levels.items()}).to_batches()


def _sketch_merge(t: pa.Table) -> pa.Table:
    points, counts = ([x.values.to_numpy(zero_copy_only=False) for b in t[c].chunks for x in b] for c in ("points", "counts"))
    return _sketch_rows(0, {t["column"][0].as_py(): _sketch(list(zip(points, counts, t["top"].to_pylist(), t["whole"].to_pylist())))})


def _edges(df: DataFrame, numeric: Sequence[str], codes: Sequence[str], bins: int, accuracy: int = 20_000) -> tuple[dict, dict]:
    """(edges, largest value) of all columns in one aggregation.  Columns whose quantiles
    repeat may have few distinct values; where a sketch counts these as few, they
    are the edges."""
    value = {c: F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")) for c in [*numeric, *codes]}
    shares = [i / bins for i in range(1, bins)]
    tops = [F.max(value[c]).alias(f"_top_{c}") for c in codes]
    row = df.agg(*[F.percentile_approx(value[c], shares, accuracy).alias(c) for c in [*numeric, *codes]], *tops).first().asDict()
    # without a repeated quantile, all of up to bins - 1 distinct values are quantiles
    tied = [c for c in numeric if row[c] is not None and len(set(row[c])) < len(shares)]
    sizes = df.agg(*[F.approx_count_distinct(value[c], 0.02).alias(c) for c in tied]).first() if tied else {}
    few = [c for c in tied if sizes[c] < 1.2 * bins]
    if few:
        exact = df.agg(*[F.collect_set(value[c]).alias(c) for c in few]).first()
        row |= {c: exact[c] for c in few if len(exact[c]) < bins}
    edges = {c: np.unique(np.array(row[c] if row[c] is not None else [], float)) for c in [*numeric, *codes]}
    return edges, {c: row[f"_top_{c}"] for c in codes if row[f"_top_{c}"] is not None}


def _sorted_edges(df: DataFrame, numeric: Sequence[str], codes: Sequence[str], bins: int) -> tuple[dict, dict]:
    """Like :func:`_edges`, where that costs too much: every task sorts its rows'
    columns and keeps a mergeable sketch of each.  Exact where a column has at
    most ``POINTS`` distinct values; each merge beyond that moves a rank by
    1 / (2 * ``POINTS``) of the rows at most."""
    columns, packed = [*numeric, *codes], list(numeric) if PACKED in df.columns else []
    own = [F.col(c).cast("double").alias(c) for c in (codes if packed else columns)]
    parts = df.select(*([PACKED] if packed else []), *own).mapInArrow(lambda batches: _sketch_partition(batches, packed), SKETCH)
    merged = parts.groupBy("column", "part").applyInArrow(_sketch_merge, SKETCH).groupBy("column").applyInArrow(_sketch_merge, SKETCH)

    def edges_of(t: pa.Table) -> pa.Table:
        points, counts = (t[c].combine_chunks().values.to_numpy(zero_copy_only=False) for c in ("points", "counts"))
        few = t["whole"][0].as_py() and len(points) < bins and t["column"][0].as_py() in numeric
        if len(points) and not few:
            below = np.cumsum(counts)
            ranks = [math.ceil(i / bins * int(below[-1])) for i in range(1, bins)]
            points = np.unique(points[np.searchsorted(below, ranks, "left")])
        return pa.table({"column": t["column"], "edges": pa.array([points], pa.list_(pa.float64())), "top": t["top"]})

    row = {r["column"]: r for r in merged.groupBy("column").applyInArrow(edges_of, "column string, edges array<double>, top double").collect()}
    return {c: np.array(row[c].edges if c in row else [], float) for c in columns}, {c: row[c].top for c in codes if c in row and row[c].top is not None}


def quantile_bins(df: DataFrame, numeric: Sequence[str], codes: Sequence[str] = (), bins: int = MISSING) -> Bins:
    """Bin edges of all columns, by Spark's sketch for up to ``SKETCH_ROWS`` rows, else by
    sorted runs; a packed frame holds ``numeric`` in its array.  ``codes`` are 0-based category codes; one with more levels
    than bins is binned like a number."""
    if df.count() > SKETCH_ROWS:
        edges, tops = _sorted_edges(df, numeric, codes, bins)
    else:
        plain = df.select(*[F.col(PACKED)[i].alias(c) for i, c in enumerate(numeric)], *codes) if PACKED in df.columns else df
        edges, tops = _edges(plain, numeric, codes, bins)
    levels = {c: int(top) + 1 for c, top in tops.items() if top < bins}
    return Bins((*numeric, *codes), {c: e for c, e in edges.items() if c not in levels}, levels)


def write_chunks(df: DataFrame, bins: Bins, keep: Sequence[str], label: str | None, weight: str | None, folds: Sequence[str] = (), packed: Sequence[str] = ()) -> DataFrame:
    """Binned rows of ``df`` (with a column ``fit``) as chunks, written and read
    back: fit, chunk, n, bins, label, weight, folds and the ``keep`` columns as arrays.
    ``packed`` names the columns of a packed frame's array.
    Rows are binned where they lie; a byte for each column and fold mask is shuffled."""
    spark, place = df.sparkSession, {c: i for i, c in enumerate(packed)}
    parts, width = max(spark.sparkContext.defaultParallelism, 1), len(bins.columns)
    kinds = dict(df.select(*keep).dtypes)
    schema = "fit int, chunk long, n int, bins binary, label array<double>, weight array<double>, folds binary, " + ", ".join(f"`{c}` array<{kinds[c]}>" for c in keep)
    rows_schema = "_fit int, _bins binary, _label double, _weight double, _folds int, " + ", ".join(f"`{c}` {kinds[c]}" for c in keep)

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = b.num_rows

            def of(c):
                return b.column(b.schema.get_field_index(c))

            def floats(c):
                return of(c).cast(pa.float64()).to_numpy(zero_copy_only=False)

            matrix = np.empty((n, width), np.uint8)
            rows = _matrix(b, len(place)) if place else None
            for i, c in enumerate(bins.columns):
                matrix[:, i] = bins.of(c, rows[:, place[c]] if c in place else floats(c))
            masks = np.zeros(n, np.int32)
            for i, c in enumerate(folds):
                masks |= of(c).fill_null(False).to_numpy(zero_copy_only=False).astype(np.int32) << i
            ends = pa.py_buffer(np.arange(0, (n + 1) * width, width, dtype=np.int32) if width else np.zeros(n + 1, np.int32))
            y = pa.array(floats(label) if label else np.zeros(n))
            w = pa.array(floats(weight) if weight else np.ones(n))
            packed = pa.Array.from_buffers(pa.binary(), n, [None, ends, pa.py_buffer(matrix)])
            yield pa.RecordBatch.from_arrays([of("_fit"), packed, y, w, pa.array(masks), *[of(c) for c in keep]], ["_fit", "_bins", "_label", "_weight", "_folds", *keep])

    def chunk(fit: int, number: int, t: pa.Table) -> pa.RecordBatch:
        n = t.num_rows
        matrix = np.frombuffer(b"".join(t["_bins"].to_pylist()), np.uint8).reshape(n, width)
        masks = t["_folds"].combine_chunks().to_numpy().astype(np.uint8)
        y, w = (t[c].combine_chunks().to_numpy(zero_copy_only=False) for c in ("_label", "_weight"))
        whole = [pa.array([0, n], pa.int32())]
        held = [pa.ListArray.from_arrays(whole[0], t[c].combine_chunks()) for c in keep]
        return pa.RecordBatch.from_arrays(
            [pa.array([fit], pa.int32()), pa.array([number]), pa.array([n], pa.int32()), pa.array([matrix.T.tobytes()], pa.binary()), pa.array([y]), pa.array([w]), pa.array([masks.tobytes()], pa.binary()), *held],
            ["fit", "chunk", "n", "bins", "label", "weight", "folds", *keep],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        held: dict[int, list] = {}
        for b in batches:
            fits = b.column(0).to_numpy()
            for fit in np.unique(fits).tolist():
                own = pa.Table.from_batches([*held.get(fit, []), b.filter(pa.array(fits == fit))])
                while own.num_rows >= CHUNK:
                    yield chunk(fit, number, own.slice(0, CHUNK))
                    number, own = number + 1, own.slice(CHUNK)
                held[fit] = own.to_batches()
        for fit, batches_ in sorted(held.items()):
            if batches_ and (own := pa.Table.from_batches(batches_)).num_rows:
                yield chunk(fit, number, own)
                number += 1

    columns = list(dict.fromkeys([*keep, *(c for c in (label, weight) if c), *folds, *([PACKED] if place else []), *(c for c in bins.columns if c not in place)]))
    rows = df.select(F.col("fit").cast("int").alias("_fit"), *columns).mapInArrow(binned, rows_schema).repartition(parts, *keep)
    path = scratch_path(spark, "chunks")
    rows.mapInArrow(run, schema).write.parquet(path)
    return spark.read.schema(schema).parquet(path)


@dataclass
class Chunk:
    """One chunk as arrays; ``matrix`` is feature by row."""

    fit: int
    number: int
    matrix: np.ndarray
    y: np.ndarray
    w: np.ndarray
    folds: np.ndarray

    @staticmethod
    def read(batch, i: int) -> "Chunk":
        def at(name):
            return batch.column(batch.schema.get_field_index(name))[i]

        n = at("n").as_py()
        bins, folds = np.frombuffer(at("bins").as_py(), np.uint8), np.frombuffer(at("folds").as_py(), np.uint8)
        y, w = (at(c).values.to_numpy(zero_copy_only=False) for c in ("label", "weight"))
        return Chunk(at("fit").as_py(), at("chunk").as_py(), bins.reshape(-1, n) if n else bins.reshape(0, 0), y, w, folds)


# --- trees ---------------------------------------------------------------------

@dataclass
class Split:
    """A node's best split; ``left`` says for every bin whether it goes left."""

    gain: float
    feature: int
    bin: int
    missing_left: bool
    left: np.ndarray
    sums: tuple  # gradient, hessian, rows of the left side


@dataclass
class Node:
    sums: tuple
    depth: int = 0
    split: Split | None = None  # made
    best: Split | None = None   # to be had
    children: tuple[int, int] | None = None
    value: float = 0.0


@dataclass
class Tree:
    nodes: list[Node] = field(default_factory=list)

    def leaves(self, matrix: np.ndarray) -> np.ndarray:
        """Node number of every row's leaf."""
        at = np.zeros(matrix.shape[1], np.int16)
        for i, node in enumerate(self.nodes):  # parents come before their children
            if node.children:
                here = np.flatnonzero(at == i)
                goes = node.split.left[matrix[node.split.feature, here]]
                at[here] = np.where(goes, *node.children)
        return at

    def values(self) -> np.ndarray:
        return np.array([n.value for n in self.nodes])


def _score(g, h, s: Settings):
    """Penalised gain of a leaf with these sums."""
    return np.maximum(np.abs(g) - s.l1, 0.0) ** 2 / (h + s.l2)


#: Share by which a gain must exceed another to count as larger.
TIE = 1e-12


def best_split(hist: np.ndarray, features: np.ndarray, cats: np.ndarray, node: tuple, s: Settings) -> Split | None:
    """Best split of a node; ``hist`` holds (gradient, hessian, rows) by
    feature and bin, ``cats`` says which features are categorical.  Of equal gains the
    first feature wins, of its cuts the first, with missing values on the left."""
    if not len(features) or node[2] < 2 * s.min_rows:
        return None
    order = np.broadcast_to(np.arange(MISSING + 1), (len(features), MISSING + 1))
    sums = hist
    if cats.any():  # a missing code is a category
        order, sums = order.copy(), hist.copy()
        own = hist[cats]
        order[cats] = np.argsort(np.where(own[:, 2] > 0, own[:, 0] / (own[:, 1] + CAT_SMOOTH), np.inf), 1, kind="stable")
        sums[cats] = np.take_along_axis(own, order[cats][:, None], 2)
    below = np.cumsum(sums, 2)  # by cut: all bins up to it
    gains = np.full((2, len(features), MISSING + 1), -np.inf)
    base = _score(node[0], node[1], s)
    missing = hist[:, 2, MISSING] > 0

    def fill(side: int, rows: np.ndarray, left: np.ndarray) -> None:
        g, h, n = left[:, 0], left[:, 1], left[:, 2]
        fits = (n >= s.min_rows) & (n <= node[2] - s.min_rows) & (h >= MIN_HESSIAN) & (h <= node[1] - MIN_HESSIAN)
        gain = _score(g, h, s) + _score(node[0] - g, node[1] - h, s) - base
        gains[side, rows, : gain.shape[1]] = np.where(fits, gain, -np.inf)

    # without missing values both sides are the same, and the left one counts
    fill(0, np.flatnonzero(cats | ~missing), below[cats | ~missing])
    some = np.flatnonzero(~cats & missing)
    if len(some):
        value = below[some, :, :MISSING]
        fill(0, some, value + hist[some][:, :, MISSING:])
        fill(1, some, value)
    gains[:, ~cats, MISSING] = -np.inf
    top = gains.max(2)
    side = (top[1] > top[0] * (1 + TIE)).astype(int)
    top = np.where(side == 1, top[1], top[0])
    most = top.max()
    if not most > TIE * max(base, 1.0):
        return None
    f = int(np.flatnonzero(top * (1 + TIE) >= most)[0])
    cut = int(np.argmax(gains[side[f], f]))
    goes = np.zeros(MISSING + 1, bool)
    goes[order[f, : cut + 1]] = True
    left = below[f, :, cut]
    if not cats[f]:
        goes[MISSING] = side[f] == 0
        left = left + (hist[f, :, MISSING] if side[f] == 0 else 0.0)
    return Split(float(gains[side[f], f, cut]), int(features[f]), cut, bool(goes[MISSING]), goes, tuple(left.tolist()))


def better(a: Split | None, b: Split | None) -> Split | None:
    """The larger gain, at equal gains the first feature."""
    if a is None or b is None:
        return a or b
    first, second = (a, b) if a.feature < b.feature else (b, a)
    return second if second.gain > first.gain * (1 + TIE) else first


def grow(tree: Tree, s: Settings) -> list[int]:
    """Split the leaves whose best split is known and return the new leaves
    that may be split further.  All of them are split at once where no
    limit on leaves can bind, else only the one with the largest gain."""
    ready = [i for i, n in enumerate(tree.nodes) if n.children is None and n.best is not None]
    ready.sort(key=lambda i: -tree.nodes[i].best.gain)
    if 2**s.max_depth > s.max_leaves:
        count = sum(n.children is None for n in tree.nodes)
        ready = ready[:1] if count < s.max_leaves else []
    fresh = []
    for i in sorted(ready):
        node = tree.nodes[i]
        node.split, node.best = node.best, None
        left = node.split.sums
        right = tuple(a - b for a, b in zip(node.sums, left))
        node.children = (len(tree.nodes), len(tree.nodes) + 1)
        tree.nodes += [Node(left, node.depth + 1), Node(right, node.depth + 1)]
        fresh += [c for c in node.children if node.depth + 1 < s.max_depth]
    return fresh


def close(tree: Tree, s: Settings) -> None:
    """Leaf values, scaled by the learning rate."""
    for n in tree.nodes:
        g, h, _ = n.sums
        n.best = None
        n.value = -s.learning_rate * math.copysign(max(abs(g) - s.l1, 0.0), g) / (h + s.l2) if h > 0 else 0.0


def columns_of(tree: int, n: int, s: Settings) -> np.ndarray:
    size = max(1, math.ceil(s.column_share * n)) if n else 0
    return np.sort(np.random.default_rng((s.seed, tree)).choice(n, size, replace=False))


def rows_of(tree: int, chunk: Chunk, s: Settings) -> np.ndarray:
    return np.random.default_rng((s.seed, tree, chunk.number, chunk.fit)).random(len(chunk.y)) < s.row_share


def histogram(values: np.ndarray, g: np.ndarray, h: np.ndarray) -> np.ndarray:
    size = MISSING + 1
    return np.stack([np.bincount(values, g, size), np.bincount(values, h, size), np.bincount(values, minlength=size)])


#: Whole hessians below it and row counts share one exact floating-point sum.
PACK = 2.0**32


def histograms(matrix: np.ndarray, columns: np.ndarray, rows: np.ndarray, g: np.ndarray, h: np.ndarray, packs: bool) -> np.ndarray:
    """:func:`histogram` of every column over some rows."""
    size, out = MISSING + 1, np.empty((len(columns), 3, MISSING + 1))
    g, h = g.take(rows), h.take(rows)
    both = h + PACK if packs else h
    for i, f in enumerate(columns.tolist()):
        values = matrix[f].take(rows).astype(np.intp)
        out[i, 0] = np.bincount(values, g, size)
        out[i, 1] = np.bincount(values, both, size)
        if not packs:
            out[i, 2] = np.bincount(values, minlength=size)
    if packs:
        out[:, 2] = np.floor(out[:, 1] / PACK)
        out[:, 1] -= out[:, 2] * PACK
    return out


# --- a fit in one task -----------------------------------------------------------

def fit_here(chunks: list[Chunk], fold: int, bins: Bins, s: Settings) -> tuple[list[Tree], list[float]]:
    """(trees up to the best round, validation error of every round)."""
    matrix = np.ascontiguousarray(np.concatenate([c.matrix for c in chunks], 1))
    y, w = np.concatenate([c.y for c in chunks]), np.concatenate([c.w for c in chunks])
    valid = (np.concatenate([c.folds for c in chunks]) >> fold & 1).astype(bool)
    margin, trees, errors, best = np.zeros(len(y)), [], [], 0
    h, cats = 2 * w, np.array([bins.is_cat(i) for i in range(len(matrix))], bool)
    packs = bool((h == np.floor(h)).all() and h.sum() < PACK / 2 and len(h) <= 1 << 20)
    while len(errors) < s.max_rounds and len(errors) - best < s.patience:
        number = len(errors)
        rows = np.flatnonzero(np.concatenate([rows_of(number, c, s) for c in chunks]) & ~valid)
        columns = columns_of(number, len(matrix), s)
        g = h * (margin - y)
        tree = Tree([Node((float(g[rows].sum()), float(h[rows].sum()), float(len(rows))))])
        held = {0: (rows, None)}  # rows and histograms of leaves that may be split
        while held:
            for i, (own, hist) in held.items():
                if hist is None:
                    hist = histograms(matrix, columns, own, g, h, packs)
                    held[i] = own, hist
                if tree.nodes[i].best is None:
                    tree.nodes[i].best = best_split(hist, columns, cats[columns], tree.nodes[i].sums, s)
            before = {i: n.children for i, n in enumerate(tree.nodes)}
            fresh, kept = grow(tree, s), {}
            for i, (own, hist) in held.items():
                node = tree.nodes[i]
                if node.children == before.get(i):
                    if node.best is not None and not fresh == []:
                        kept[i] = own, hist  # waits for its turn
                    continue
                goes = node.split.left[matrix[node.split.feature].take(own)]
                a, b = node.children
                if a not in fresh and b not in fresh:
                    continue
                small, large, own_small, own_large = (a, b, own[goes], own[~goes]) if goes.sum() * 2 <= len(own) else (b, a, own[~goes], own[goes])
                part = histograms(matrix, columns, own_small, g, h, packs)
                kept[small], kept[large] = (own_small, part), (own_large, hist - part)
            held = kept if fresh else {}
        close(tree, s)
        margin += tree.values()[tree.leaves(matrix)]
        trees.append(tree)
        errors.append(_error(margin[valid], y[valid], w[valid]))
        if errors[-1] < errors[best - 1] or best == 0:
            best = len(errors)
        del trees[best + s.patience:]
    return trees[:best], errors


def _error(margin: np.ndarray, y: np.ndarray, w: np.ndarray) -> float:
    total = w.sum()
    return float((w * np.abs(margin - y)).sum() / total) if total else 0.0


def by_fit(chunks: DataFrame, n_folds: int, bins: Bins, s: Settings) -> DataFrame:
    """Node table of all fits, each fitted in a task of its own."""
    def run(t: pa.Table) -> pa.Table:
        fold = t["fold"][0].as_py()
        batch = t.combine_chunks().to_batches()[0]
        own = sorted((Chunk.read(batch, i) for i in range(batch.num_rows)), key=lambda c: c.number)
        trees, errors = fit_here(own, fold, bins, s)
        return node_rows(own[0].fit, fold, trees, errors, bins)

    parts = 4 * n_folds * max(1, chunks.select("fit").distinct().count())
    each = chunks.select("fit", "chunk", "n", "bins", "label", "weight", "folds", F.explode(F.array(*[F.lit(i) for i in range(n_folds)])).alias("fold"))
    return _written(each.repartition(parts, "fit", "fold").groupBy("fit", "fold").applyInArrow(run, NODES))


def node_rows(fit: int, fold: int, trees: list[Tree], errors: list[float], bins: Bins) -> pa.Table:
    rows = []
    for number, tree in enumerate(trees):
        for i, n in enumerate(tree.nodes):
            column = bins.columns[n.split.feature] if n.children else None
            cat = n.children is not None and bins.is_cat(n.split.feature)
            edges = None if column is None or cat else bins.edges[column]
            rows.append({
                "fit": fit, "fold": fold, "tree": number, "node": i, "feature": column,
                "cut": None if edges is None else float(edges[n.split.bin]) if n.split.bin < len(edges) else math.inf,
                "missing_left": n.split.missing_left if n.children else None, "codes": np.flatnonzero(n.split.left[:MISSING]).tolist() if cat else None,
                "left": n.children[0] if n.children else None, "right": n.children[1] if n.children else None,
                "value": n.value, "gain": n.split.gain if n.children else None, "n_rows": int(n.sums[2]), "error": errors[number], "rounds": len(errors),
            })
    kinds = {"fit": pa.int32(), "fold": pa.int32(), "tree": pa.int32(), "node": pa.int32(), "feature": pa.string(), "cut": pa.float64(), "missing_left": pa.bool_(), "codes": pa.list_(pa.int32()),
             "left": pa.int32(), "right": pa.int32(), "value": pa.float64(), "gain": pa.float64(), "n_rows": pa.int64(), "error": pa.float64(), "rounds": pa.int32()}
    return pa.table({k: pa.array([r[k] for r in rows], t) for k, t in kinds.items()})


def _written(df: DataFrame) -> DataFrame:
    path = scratch_path(df.sparkSession, "booster")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# --- fits over many tasks ----------------------------------------------------------

SUMS = "fit int, fold int, leaf int, feature int, sums array<double>"
FOUND = "fit int, fold int, leaf int, feature int, gain double, bin int, missing_left boolean, goes binary, sums array<double>"


@dataclass
class Fit:
    """A fit under way, as the driver and (its trees since the margins were written) the tasks see it."""

    trees: list[Tree] = field(default_factory=list)
    errors: list[float] = field(default_factory=list)
    best: int = 0
    written: int = 0  # trees that the margin column holds
    asked: tuple = ()  # leaves of the last tree whose sums are wanted


def _margins(chunk: Chunk, base: np.ndarray, fits: dict, n_folds: int) -> np.ndarray:
    """Margins by fold and row after all closed trees."""
    out = base.reshape(n_folds, -1).copy()
    for fold in range(n_folds):
        for tree in fits[chunk.fit, fold].trees if (chunk.fit, fold) in fits else ():
            out[fold] += tree.values()[tree.leaves(chunk.matrix)]
    return out


def _level(fits: dict, open_: dict, tree: int, n_folds: int, s: Settings):
    """Sums by (leaf, feature, bin) of the asked leaves; at a tree's root also
    its totals (feature -1) and the validation error so far (leaf -1)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict = {}

        def add(key, sums):
            total[key] = total[key] + sums if key in total else sums

        for batch in batches:
            for i in range(batch.num_rows):
                c = Chunk.read(batch, i)
                base = batch.column(batch.schema.get_field_index("margin"))[i].values.to_numpy(zero_copy_only=False)
                margins = _margins(c, base, fits, n_folds)
                columns, sample = columns_of(tree, len(c.matrix), s), rows_of(tree, c, s)
                for fold in range(n_folds):
                    if (c.fit, fold) not in open_:
                        continue
                    grown, asked = open_[c.fit, fold]
                    valid = (c.folds >> fold & 1).astype(bool)
                    h = 2 * c.w
                    g = h * (margins[fold] - c.y)
                    if asked == (0,):
                        off = c.w[valid] * np.abs(margins[fold][valid] - c.y[valid])
                        add((c.fit, fold, -1, -1), np.array([off.sum(), c.w[valid].sum()]))
                    leaf = grown.leaves(c.matrix) if grown.nodes else np.zeros(len(c.y), np.int16)
                    for a in asked:
                        own = np.flatnonzero((leaf == a) & sample & ~valid)
                        if a == 0:
                            add((c.fit, fold, 0, -1), np.array([g[own].sum(), h[own].sum(), len(own)], float))
                        if len(own):
                            for f in columns.tolist():
                                add((c.fit, fold, a, f), histogram(c.matrix[f].take(own), g[own], h[own]).ravel())
        if total:
            keys = np.array(list(total)).T
            yield pa.RecordBatch.from_arrays([*[pa.array(k, pa.int32()) for k in keys], pa.array(list(total.values()), pa.list_(pa.float64()))], ["fit", "fold", "leaf", "feature", "sums"])

    return run


def _find(open_: dict, cats: frozenset, s: Settings):
    """Total sums of every (fit, leaf, feature) to its best split."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict = {}
        for batch in batches:
            keys = list(zip(*[batch.column(i).to_pylist() for i in range(4)]))
            for i, key in enumerate(keys):
                sums = batch.column(4)[i].values.to_numpy(zero_copy_only=False)
                total[key] = total[key] + sums if key in total else sums.copy()
        rows = []
        for (fit, fold, leaf, feature), sums in total.items():
            if feature < 0:
                rows.append((fit, fold, leaf, feature, 0.0, 0, False, b"", sums.tolist()))
                continue
            hist = sums.reshape(3, -1)
            node = hist.sum(1) if leaf == 0 else np.array(open_[fit, fold][0].nodes[leaf].sums)
            if (found := best_split(hist[None], np.array([feature]), np.array([feature in cats]), tuple(node.tolist()), s)) is not None:
                rows.append((fit, fold, leaf, feature, found.gain, found.bin, found.missing_left, np.packbits(found.left).tobytes(), list(found.sums)))
        names = [x.split()[0] for x in FOUND.split(", ")]
        kinds = [pa.int32()] * 4 + [pa.float64(), pa.int32(), pa.bool_(), pa.binary(), pa.list_(pa.float64())]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names)

    return run


def root_splits(chunks: DataFrame, n_folds: int, bins: Bins, s: Settings) -> DataFrame:
    """(fit, fold, feature, gain, base, cut, missing_left, n_left): the best split
    of every feature at the first tree's root, before any is chosen, and the
    gain of the root as a leaf."""
    keys = [r.fit for r in chunks.select("fit").distinct().collect()]
    open_ = {(k, fold): (Tree([]), (0,)) for k in keys for fold in range(n_folds)}
    fits = {k: Fit() for k in open_}
    cats = frozenset(i for i in range(len(bins.columns)) if bins.is_cat(i))
    sums = _with_margins(chunks, {}, n_folds).mapInArrow(_level(fits, open_, 0, n_folds, s), SUMS)
    found = sums.repartition("fit", "fold", "leaf", "feature").mapInArrow(_find(open_, cats, s), FOUND)
    total = found.where("leaf = 0 and feature = -1").select("fit", "fold", F.col("sums").alias("total"))
    off = F.greatest(F.abs(F.col("total")[0]) - s.l1, F.lit(0.0))
    names = F.array(*[F.lit(c) for c in bins.columns])
    edges = F.array(*[F.array(*[F.lit(float(x)) for x in bins.edges.get(c, [])]).cast("array<double>") for c in bins.columns])
    return found.where("feature >= 0").join(total, ["fit", "fold"]).select(
        "fit", "fold", names[F.col("feature")].alias("feature"), "gain", (off * off / (F.col("total")[1] + s.l2)).alias("base"),
        F.get(edges[F.col("feature")], F.col("bin")).alias("cut"), "missing_left", F.col("sums")[2].cast("long").alias("n_left"))


def _with_margins(chunks: DataFrame, fits: dict, n_folds: int) -> DataFrame:
    """Chunks with the margins after all closed trees, written."""
    schema = "fit int, chunk long, n int, bins binary, label array<double>, weight array<double>, folds binary, margin array<double>"
    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches):
        for batch in batches:
            held = []
            for i in range(batch.num_rows):
                c = Chunk.read(batch, i)
                at = batch.schema.get_field_index("margin")
                base = batch.column(at)[i].values.to_numpy(zero_copy_only=False) if at >= 0 else np.zeros(n_folds * len(c.y))
                held.append(_margins(c, base, fits, n_folds).ravel())
            yield pa.RecordBatch.from_arrays([*[batch.column(batch.schema.get_field_index(x)) for x in names[:-1]], pa.array(held, pa.list_(pa.float64()))], names)

    cols = [c for c in names if c in chunks.columns]
    return _written(chunks.select(*cols).mapInArrow(run, schema))


def by_level(chunks: DataFrame, n_folds: int, bins: Bins, s: Settings) -> DataFrame:
    """Node table of all fits, each level one aggregation over all rows."""
    spark = chunks.sparkSession
    keys = sorted(r.fit for r in chunks.select("fit").distinct().collect())
    fits = {(k, fold): Fit() for k in keys for fold in range(n_folds)}
    rows = _with_margins(chunks, {}, n_folds)
    cats = frozenset(i for i in range(len(bins.columns)) if bins.is_cat(i))
    live, tree = set(fits), 0

    def ask(since: dict, open_: dict) -> list:
        sums = rows.mapInArrow(_level(since, open_, tree, n_folds, s), SUMS)
        return sums.repartition("fit", "fold", "leaf", "feature").mapInArrow(_find(open_, cats, s), FOUND).collect()

    while live:
        since = {k: replace(f, trees=f.trees[f.written:]) for k, f in fits.items()}
        open_ = {k: (Tree([]), (0,)) for k in live}
        while open_:
            grown = {k: t for k, (t, _) in open_.items()}
            for r in ask(since, open_):
                k, t = (r.fit, r.fold), grown[r.fit, r.fold]
                if r.leaf < 0:
                    if tree and r.sums[1]:
                        _note(fits[k], r.sums[0] / r.sums[1])
                    elif tree:
                        _note(fits[k], 0.0)
                elif r.feature < 0:
                    t.nodes[:1] = [replace(t.nodes[0], sums=tuple(r.sums)) if t.nodes else Node(tuple(r.sums))]
                else:
                    goes = np.unpackbits(np.frombuffer(r.goes, np.uint8)).astype(bool)
                    found = Split(r.gain, r.feature, r.bin, r.missing_left, goes, tuple(r.sums))
                    if not t.nodes:
                        t.nodes.append(Node((0.0, 0.0, 0.0)))
                    t.nodes[r.leaf].best = better(t.nodes[r.leaf].best, found)
            if all(asked == (0,) for _, asked in open_.values()):  # the errors of the trees before are known now
                done = {k for k in live if len(fits[k].errors) >= s.max_rounds or len(fits[k].errors) - fits[k].best >= s.patience}
                live -= done
                grown = {k: t for k, t in grown.items() if k in live}
            fresh = {k: tuple(grow(t, s)) for k, t in grown.items()}
            for k, t in grown.items():
                if not fresh[k]:
                    close(t, s)
                    fits[k].trees.append(t)
            open_ = {k: (t, fresh[k]) for k, t in grown.items() if fresh[k]}
        tree += 1
        if tree % KEEP == 0 and live:
            rows = _with_margins(rows, {k: replace(f, trees=f.trees[f.written:]) for k, f in fits.items()}, n_folds)
            for f in fits.values():
                f.written = len(f.trees)
    tables = [node_rows(*k, f.trees[: f.best], f.errors, bins) for k, f in fits.items()]
    return _written(spark.createDataFrame(pa.concat_tables(tables), NODES)) if tables else spark.createDataFrame([], NODES)


def _note(fit: Fit, error: float) -> None:
    fit.errors.append(error)
    if fit.best == 0 or error < fit.errors[fit.best - 1]:
        fit.best = len(fit.errors)


def fit_boosters(chunks: DataFrame, n_folds: int, bins: Bins, settings: Settings = Settings()) -> DataFrame:
    """Node table (:data:`NODES`) of a booster for every fit and fold."""
    most = chunks.groupBy("fit").agg(F.sum("n").alias("n")).agg(F.max("n")).first()[0] or 0
    how: Callable = by_fit if most <= TASK_ROWS else by_level
    return how(chunks, n_folds, bins, settings)


# --- use ---------------------------------------------------------------------------

def read_trees(nodes: DataFrame, bins: Bins) -> dict[tuple[int, int], list[Tree]]:
    """{(fit, fold): trees} of a node table; its size is rounds x nodes of a tree."""
    out: dict = {}
    for r in nodes.orderBy("fit", "fold", "tree", "node").collect():
        trees = out.setdefault((r.fit, r.fold), [])
        if r.tree == len(trees):
            trees.append(Tree())
        node = Node((0.0, 0.0, float(r.n_rows)), value=r.value)
        if r.left is not None:
            feature = bins.columns.index(r.feature)
            goes = np.zeros(MISSING + 1, bool)
            if r.codes is not None:
                goes[r.codes] = True
            else:
                goes[: int(np.searchsorted(bins.edges[r.feature], r.cut, "left")) + 1] = True
            goes[MISSING] = r.missing_left
            node.children, node.split = (r.left, r.right), Split(r.gain, feature, 0, r.missing_left, goes, ())
        trees[-1].nodes.append(node)
    return out


def predict(chunks: DataFrame, nodes: DataFrame, bins: Bins, n_folds: int, keep: Sequence[str]) -> DataFrame:
    """Rows of ``chunks``: fit, the ``keep`` columns, label, weight, and for each
    fold whether it validates the row and its model's value (valid_i, pred_i)."""
    trees = chunks.sparkSession.sparkContext.broadcast(read_trees(nodes, bins))
    kinds = dict(chunks.dtypes)
    plain = ", ".join(f"`{c}` {kinds[c].removeprefix('array<').removesuffix('>')}" for c in keep)
    schema = f"fit int, {plain}, label double, weight double, " + ", ".join(f"valid_{i} boolean, pred_{i} double" for i in range(n_folds))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                c = Chunk.read(batch, i)
                out = [pa.array(np.full(len(c.y), c.fit, np.int32))]
                out += [batch.column(batch.schema.get_field_index(k))[i].values for k in keep]
                out += [pa.array(c.y), pa.array(c.w)]
                for fold in range(n_folds):
                    margin = np.zeros(len(c.y))
                    for t in trees.value.get((c.fit, fold), ()):
                        margin += t.values()[t.leaves(c.matrix)]
                    out += [pa.array((c.folds >> fold & 1).astype(bool)), pa.array(margin)]
                names = ["fit", *keep, "label", "weight", *[x for f in range(n_folds) for x in (f"valid_{f}", f"pred_{f}")]]
                yield pa.RecordBatch.from_arrays(out, names)

    return chunks.select("fit", "chunk", "n", "bins", "label", "weight", "folds", *keep).mapInArrow(run, schema)


def gains(nodes: DataFrame, columns: Sequence[str], n_folds: int) -> DataFrame:
    """(fit, feature, mean, std): raw gain of every feature summed over a
    fold's trees, mean and population deviation over folds (M10, A16)."""
    spark = nodes.sparkSession
    every = nodes.select("fit").distinct().select("fit", F.explode(F.array(*[F.lit(c) for c in columns])).alias("feature"), F.lit(None).cast("int").alias("fold"))
    every = every.select("fit", "feature", F.explode(F.array(*[F.lit(i) for i in range(n_folds)])).alias("fold"))
    found = nodes.where(F.col("feature").isNotNull()).groupBy("fit", "feature", "fold").agg(F.sum("gain").alias("gain"))
    full = every.join(found, ["fit", "feature", "fold"], "left").fillna(0.0, "gain")
    return full.groupBy("fit", "feature").agg(F.avg("gain").alias("mean"), F.stddev_pop("gain").alias("std"))
