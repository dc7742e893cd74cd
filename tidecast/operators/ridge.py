"""Ridge regressions of nested hold-outs from sums of products.

The rows that fold n validates are those of the rings 0..n (the column of the
innermost fold that holds a row, NULL for rows that always train).  One pass
collects X'X, X'y and the sums of each ring; what a fold trains on is the sum of
the other rings, and one eigen-decomposition of its centred X'X solves all
penalties.  The size of these sums is the square of the number of columns,
whatever the rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Ring of the rows that no fold validates.
ALWAYS = 1 << 30


@dataclass(frozen=True)
class Ridge:
    alpha: float
    weights: np.ndarray
    intercept: float

    def value(self, cols: Sequence[str]) -> Column:
        """The prediction as an expression of the feature columns."""
        terms = F.zip_with(F.array(*cols), F.array(*[F.lit(float(w)) for w in self.weights]), lambda x, w: x * w)
        return F.aggregate(terms, F.lit(float(self.intercept)), lambda a, b: a + b)


def ring(folds: Sequence[str]) -> Column:
    """Innermost fold that validates a row."""
    out = F.lit(ALWAYS)
    for i in reversed(range(len(folds))):
        out = F.when(F.col(folds[i]), F.lit(i)).otherwise(out)
    return out


def gram_rows(train: DataFrame, cols: Sequence[str], label: str, n_folds: int) -> DataFrame:
    """(ring, i, j, total): sums of products of column i and j over a ring,
    i <= j; column -2 is the constant 1 and -1 the label."""
    width = len(cols) + 2
    at = [(i, j) for i in range(width) for j in range(i, width)]
    upper = np.triu_indices(width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            rings = b.column(0).to_numpy()
            x = np.stack([np.ones(b.num_rows), *[b.column(i).to_numpy(zero_copy_only=False) for i in range(1, b.num_columns)]], 1)
            for r in np.unique(rings).tolist():
                own = x[rings == r]
                sums[r] = sums.get(r, 0.0) + (own.T @ own)[upper]
        for r, total in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(at), r), pa.int32()), pa.array([i - 2 for i, _ in at], pa.int32()), pa.array([j - 2 for _, j in at], pa.int32()), pa.array(total)], ["ring", "i", "j", "total"]
            )

    rows = train.select(ring([f"valid_{n}" for n in range(n_folds)]).alias("ring"), F.col(label).cast("double"), *[F.col(c).cast("double") for c in cols])
    return rows.mapInArrow(run, "ring int, i int, j int, total double").groupBy("ring", "i", "j").agg(F.sum("total").alias("total"))


def gram(train: DataFrame, cols: Sequence[str], label: str, n_folds: int) -> dict[int, np.ndarray]:
    """{ring: symmetric matrix of sums of products}, constant and label first."""
    width, out = len(cols) + 2, {}
    for r in gram_rows(train, cols, label, n_folds).collect():
        m = out.setdefault(r.ring, np.zeros((width, width)))
        m[r.i + 2, r.j + 2] = m[r.j + 2, r.i + 2] = r.total
    return out


def solve(sums: dict[int, np.ndarray], fold: int, alphas: Sequence[float]) -> list[Ridge]:
    """The fold's ridge for every penalty: (Xc'Xc + alpha I) w = Xc'yc, and the
    least solution where that is singular."""
    own = [m for r, m in sums.items() if r > fold]
    if not own:
        return [Ridge(float(a), np.zeros(max((m.shape[0] for m in sums.values()), default=2) - 2), 0.0) for a in alphas]
    total = np.sum(own, 0)
    n, mean = total[0, 0], total[0] / total[0, 0]
    centred = total - n * np.outer(mean, mean)
    values, vectors = np.linalg.eigh(centred[2:, 2:])
    turned = vectors.T @ centred[2:, 1]
    out = []
    for a in alphas:
        scale = values + a
        usable = scale > max(values.max(initial=0.0), 1.0) * 1e-12
        w = vectors @ np.where(usable, turned / np.where(usable, scale, 1.0), 0.0)
        out.append(Ridge(float(a), w, float(mean[1] - mean[2:] @ w)))
    return out


def grid_errors(train: DataFrame, cols: Sequence[str], label: str, folds: Sequence[str], grid: dict[int, list[Ridge]]) -> dict[int, list[float]]:
    """{fold: mean absolute error of each penalty on the rows that it validates}, in one pass."""
    weights = {n: (np.stack([m.weights for m in models], 1), np.array([m.intercept for m in models])) for n, models in grid.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {n: np.zeros(len(b)) for n, (_, b) in weights.items()}
        counts = dict.fromkeys(weights, 0)
        for batch in batches:
            y = batch.column(0).to_numpy(zero_copy_only=False)
            x = np.stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(1 + len(folds), batch.num_columns)], 1)
            for n, (w, b) in weights.items():
                inside = batch.column(1 + n).to_numpy(zero_copy_only=False).astype(bool)
                sums[n] += np.abs(x[inside] @ w + b - y[inside, None]).sum(0)
                counts[n] += int(inside.sum())
        for n, s in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(s), n), pa.int32()), pa.array(np.arange(len(s)), pa.int32()), pa.array(s), pa.array(np.full(len(s), counts[n]))], ["fold", "i", "off", "n"])

    rows = train.select(F.col(label).cast("double"), *folds, *[F.col(c).cast("double") for c in cols])
    total = rows.mapInArrow(run, "fold int, i int, off double, n long").groupBy("fold", "i").agg((F.sum("off") / F.nullif(F.sum("n"), F.lit(0))).alias("mae"))
    out = {n: [0.0] * len(b) for n, (_, b) in weights.items()}
    for r in total.collect():
        out[r.fold][r.i] = float(r.mae or 0.0)
    return out
