"""Ridge from sums of products against the closed form on the rows themselves."""

import numpy as np
import pytest

from tidecast.operators import ridge as R
from tidecast.plans.models import RIDGE_ALPHAS

FOLDS = ["valid_0", "valid_1", "valid_2"]
COLS = ["x0", "x1", "x2", "x3"]


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(3)
    n = 400
    x = rng.normal(size=(n, 4)) * [1, 5, 0.5, 2]
    x[:, 3] = 2 * x[:, 0] - x[:, 1]  # dependent columns: singular without a penalty
    y = x @ [1.0, -2.0, 0.5, 3.0] + 4.0 + rng.normal(size=n)
    ring = rng.integers(0, 10, n)
    rows = [(*map(float, r), float(t), *[bool(k <= f) for f in range(3)]) for r, t, k in zip(x, y, ring)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in [*COLS, "y"]) + ", " + ", ".join(f"{f} boolean" for f in FOLDS))
    return df.repartition(3), x, y, ring


def closed_form(x, y, alpha):
    xc, yc = x - x.mean(0), y - y.mean()
    w = np.linalg.lstsq(np.r_[xc, np.sqrt(alpha) * np.eye(x.shape[1])], np.r_[yc, np.zeros(x.shape[1])], rcond=1e-10)[0]
    return w, y.mean() - x.mean(0) @ w


def test_sums_and_penalties(data):
    df, x, y, ring = data
    sums = R.gram(df, COLS, "y", 3)
    assert set(sums) == {0, 1, 2, R.ALWAYS}
    whole = np.c_[np.ones(len(y)), y, x]
    for r, m in sums.items():
        own = whole[ring == r] if r < 3 else whole[ring > 2]
        assert np.allclose(m, own.T @ own)
    for fold in range(3):
        train = ring > fold
        for m in R.solve(sums, fold, RIDGE_ALPHAS):
            w, b = closed_form(x[train], y[train], m.alpha)
            assert np.allclose(m.weights, w, atol=1e-6) and m.intercept == pytest.approx(b, abs=1e-6)


def test_errors_of_all_penalties_and_predictions(data):
    df, x, y, ring = data
    sums = R.gram(df, COLS, "y", 3)
    grid = {f: R.solve(sums, f, RIDGE_ALPHAS) for f in range(3)}
    errors = R.grid_errors(df, COLS, "y", FOLDS, grid)
    for f, models in grid.items():
        inside = ring <= f
        want = [np.abs(x[inside] @ m.weights + m.intercept - y[inside]).mean() for m in models]
        assert errors[f] == pytest.approx(want)
    m = grid[0][3]
    got = sorted((r.y, r.p) for r in df.select("y", m.value(COLS).alias("p")).collect())
    assert np.allclose(sorted(zip(y, x @ m.weights + m.intercept)), got)


def test_fold_without_training_rows(spark):
    df = spark.createDataFrame([(1.0, 2.0, True, True, True)], "x0 double, y double, valid_0 boolean, valid_1 boolean, valid_2 boolean")
    sums = R.gram(df, ["x0"], "y", 3)
    assert [m.intercept for m in R.solve(sums, 0, (0.0, 1.0))] == [0.0, 0.0]
