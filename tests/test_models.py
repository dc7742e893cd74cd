import numpy as np
import pytest
from pyspark.sql import functions as F

from tidecast.operators.metrics import fold_scores
from tidecast.plans import models as M
from tidecast.plans.features import build_features
from tidecast.sources.fixtures import load_panel_tables

from conftest import SF_SMALL


def _fold_wmae(valid, value):
    wide = (valid.groupBy("store", "dept", "dt", "sales", "weight").pivot("fold", [0, 1, 2]).agg(F.first(value))
            .select("sales", "weight", *[F.col(str(i)).alias(f"p{i}") for i in range(3)]))
    return {r["fold"]: r["wmae"] for r in fold_scores(wide, ["p0", "p1", "p2"]).collect()}


def test_gbt_learns_planted_signal(spark):
    """The fixture labels are close to iid noise (about one random line item
    per cell at sf0.001), so the booster is checked on a label planted as a
    function of two model inputs: it must beat the constant mean by far."""
    tables = load_panel_tables(spark, SF_SMALL, materialize=True)
    feats = build_features(tables, 4, 1)
    planted = F.month("dt") * 1000.0 + F.least(F.floor(F.dayofmonth("dt") / 7), F.lit(3)) * 100.0
    feats = feats.withColumn("sales", F.when(F.col("sales").isNotNull(), planted))
    res = M.fit_gbt_cv(feats, 4, max_rounds=40, patience=15)
    assert [i["fold"] for i in res.info] == [0, 1, 2]
    assert all(1 <= i["best_iter"] <= i["rounds"] <= 40 for i in res.info)
    mean = feats.agg(F.avg("sales")).first()[0]
    model = _fold_wmae(res.valid, "pred")
    const = _fold_wmae(res.valid.withColumn("c", F.lit(mean)), "c")
    assert set(model) == {0, 1, 2}
    assert np.mean(list(model.values())) < 0.5 * np.mean(list(const.values()))
    n_test = feats.where(F.col("sales").isNull()).count()
    assert res.test.count() == 3 * n_test


def test_forecast_horizons_feeds_combination(spark):
    from tidecast.operators.combine import horizon_mean
    from tidecast.sources.fixtures import end_date
    tables = load_panel_tables(spark, SF_SMALL, materialize=True)
    preds = M.forecast_horizons(tables, 1, "gbt", horizons=(1, 2), max_rounds=3)
    assert set(preds.columns) == {"store", "dept", "dt", "horizon", "pred"}
    by_h = {r["horizon"]: (r["n"], r["last"]) for r in preds.groupBy("horizon").agg(
        F.count("*").alias("n"), F.max("dt").alias("last")).collect()}
    assert by_h[1][0] <= by_h[2][0] and by_h[1][1] <= end_date(1) and by_h[2][1] <= end_date(2)
    assert horizon_mean(preds).where(F.col("pred").isNull()).count() == 0


def test_train_sink_has_a_column_per_fold(spark, tmp_path):
    from tidecast.sources.io import read_predictions
    tables = load_panel_tables(spark, SF_SMALL, materialize=True)
    fits = M.fit_horizons(tables, 1, horizons=(1, 2), max_rounds=1)
    M.write_horizon_predictions(fits, "m", str(tmp_path / "p"))
    train = read_predictions(spark, str(tmp_path / "p"), "m", "train")
    test = read_predictions(spark, str(tmp_path / "p"), "m")
    assert {"pred_fold0", "pred_fold1", "pred_fold2"} <= set(train.columns)
    assert train.where("pred_fold2 is null").count() == 0 < train.where("pred_fold0 is null").count()
    keys = tables.future.join(test, ["store", "dept", "dt"], "left_semi")
    assert keys.count() == test.select("store", "dept", "dt").distinct().count() > 0


def test_saved_boosters_give_the_same_forecasts(spark, tmp_path):
    tables = load_panel_tables(spark, SF_SMALL, materialize=True)
    fits = M.fit_horizons(tables, 2, horizons=(1, 3), max_rounds=3)
    again = fits.test_rows(M.load_nodes(spark, M.save_nodes(fits.nodes, str(tmp_path / "m"))))
    key = ["horizon", "store", "dept", "dt", "fold"]
    a, b = (x.orderBy(*key).collect() for x in (fits.test_rows(), again))
    assert len(a) == len(b) > 0 and all(x.pred == pytest.approx(y.pred) for x, y in zip(a, b))
    assert [(i["fit"], i["fold"], i["rounds"]) for i in fits.info()] == [(h, f, 3) for h in (1, 3) for f in range(3)]


def test_importance_is_the_sum_of_raw_gains(spark):
    tables = load_panel_tables(spark, SF_SMALL, materialize=True)
    fits = M.fit_boosted(build_features(tables, 2, 1).withColumn("horizon", F.lit(1)), 2, max_rounds=4)
    got = [(r.feature, r["mean"]) for r in M.importance(fits).collect()]
    assert got == sorted(got, key=lambda r: (-r[1], r[0])) and len(got) == 56
    walked = {}
    for r in fits.nodes.where("feature is not null").collect():
        name = r.feature.removeprefix("code_")
        walked[name] = walked.get(name, 0.0) + r.gain / 3
    assert {k: v for k, v in got if v} == pytest.approx(walked)


def test_ridge_takes_the_larger_of_equal_penalties(spark):
    tables = load_panel_tables(spark, SF_SMALL, materialize=True)
    res = M.fit_ridge_cv(build_features(tables, 2, 1), 2)
    assert len(res.info) == 30 and all(sum(i["chosen"] for i in res.info if i["fold"] == f) == 1 for f in range(3))
    for f in range(3):
        own = [i for i in res.info if i["fold"] == f]
        best = min(i["mae"] for i in own)
        assert max(i["alpha"] for i in own if i["mae"] == best) == next(i["alpha"] for i in own if i["chosen"])
    assert res.valid.where("pred is null").count() == 0 < res.test.count()


def test_horizons_share_their_trailing_frames(monkeypatch):
    """Ten horizons are fitted on frames that are computed once, not once for each."""
    from types import SimpleNamespace

    from tidecast.plans import models

    calls = []
    monkeypatch.setattr(models, "build_all_horizons", lambda *a, **k: calls.append((a[1:], k)))
    monkeypatch.setattr(models, "fit_boosted", lambda *a, **k: k)
    assert models.fit_horizons(SimpleNamespace(calendar=SimpleNamespace(horizons=(1, 2))), 4, patience=3) == {"patience": 3}
    assert calls == [((4, [1, 2]), {"method": "shift"})]
