import math

from tidecast.operators.metrics import cv_score, fold_scores, mae, wmae


def test_wmae_weights_and_missing_predictions(spark):
    rows = [(10.0, 12.0, 1), (10.0, 5.0, 5), (10.0, None, 5)]
    df = spark.createDataFrame(rows, "sales double, pred double, weight int")
    r = wmae(df).first()
    assert math.isclose(r["wmae"], (2 * 1 + 5 * 5) / 6) and r["n"] == 2
    assert math.isclose(mae(df).first()["mae"], 3.5)


def test_cv_is_unweighted_mean_of_fold_scores(spark):
    rows = [(10.0, 1, 11.0, None, 14.0), (20.0, 5, None, 18.0, 20.0), (30.0, 1, None, None, 27.0)]
    df = spark.createDataFrame(rows, "sales double, weight int, p0 double, p1 double, p2 double")
    folds = {r["fold"]: (r["wmae"], r["n"]) for r in fold_scores(df, ["p0", "p1", "p2"]).collect()}
    assert folds == {0: (1.0, 1), 1: (2.0, 1), 2: ((4 + 0 + 3) / 7, 3)}
    r = cv_score(df, ["p0", "p1", "p2"]).first()
    assert math.isclose(r["cv_wmae"], (1.0 + 2.0 + 1.0) / 3) and r["n_folds"] == 3
