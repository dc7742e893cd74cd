import datetime as dt

from tidecast.operators import combine as C

D = dt.date(2001, 3, 5)
PRED = "store int, dept int, dt date, horizon int, pred double"


def test_horizon_mean_and_first_with_missing(spark):
    rows = [
        (1, 1, D, 1, None), (1, 1, D, 2, None),              # all missing
        (1, 2, D, 1, None), (1, 2, D, 2, 4.0), (1, 2, D, 3, 8.0),  # some missing
        (1, 3, D, 2, 2.0), (1, 3, D, 3, 4.0),                # none missing
    ]
    p = spark.createDataFrame(rows, PRED)
    mean = {r["dept"]: (r["pred"], r["n_horizons"]) for r in C.horizon_mean(p).collect()}
    assert mean == {1: (None, 0), 2: (6.0, 2), 3: (3.0, 2)}
    first = {r["dept"]: (r["pred"], r["horizon"]) for r in C.horizon_first(p).collect()}
    assert first == {2: (4.0, 2), 3: (2.0, 2)}


def test_redistribute_needs_both_neighbours(spark):
    d0, d1 = D, D + dt.timedelta(days=7)
    rows = [(1, 1, d0, 6.0), (1, 1, d1, 8.0), (1, 2, d0, 6.0), (1, 3, d0, 6.0), (1, 3, d1, None)]
    df = spark.createDataFrame(rows, "store int, dept int, dt date, pred double")
    got = {(r["dept"], r["dt"]): r["pred"] for r in C.redistribute(df, d0, d1).collect()}
    assert abs(got[(1, d0)] - 6.0) < 1e-12 and abs(got[(1, d1)] - 8.0) < 1e-12
    assert got[(2, d0)] == 6.0 and got[(3, d0)] == 6.0 and got[(3, d1)] is None


def test_scale_and_blend(spark):
    df = spark.createDataFrame([("a", D, 7.0), ("b", D + dt.timedelta(days=7), 7.0)], "id string, dt date, pred double")
    scaled = {r["id"]: r["pred"] for r in C.scale_dates(df, {D: 6 / 7}).collect()}
    assert abs(scaled["a"] - 6.0) < 1e-12 and scaled["b"] == 7.0
    other = spark.createDataFrame([("a", 2.0)], "id string, pred double")
    got = {r["id"]: (r["pred"], r["n_models"]) for r in C.blend([df.select("id", "pred"), other], partial=True).collect()}
    assert got == {"a": (4.5, 2), "b": (7.0, 1)}


def test_hier_forecast_fallback_chain(spark):
    hist = spark.createDataFrame([
        (1, 1, dt.date(2000, 3, 6), 10.0), (1, 1, dt.date(2000, 3, 13), 20.0), (1, 1, dt.date(2000, 4, 3), 60.0),
    ], "store int, dept int, dt date, sales double")
    fut = spark.createDataFrame([(1, 1, dt.date(2001, 3, 5)), (1, 1, dt.date(2001, 3, 26)),
                                 (1, 1, dt.date(2001, 5, 7)), (2, 1, dt.date(2001, 5, 7))],
                                "store int, dept int, dt date")
    got = {(r["store"], r["dt"]): r["pred"] for r in C.hier_forecast(hist, fut).collect()}
    assert got[(1, dt.date(2001, 3, 5))] == 10.0      # same month, same week of month
    assert got[(1, dt.date(2001, 3, 26))] == 15.0     # same month only
    assert got[(1, dt.date(2001, 5, 7))] == 30.0      # series mean
    assert got[(2, dt.date(2001, 5, 7))] == 0.0       # unseen series


def test_blend_fails_on_unequal_keys(spark):
    import pytest

    a = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "id string, pred double")
    assert {r["n_models"] for r in C.blend([a, a]).collect()} == {2}
    with pytest.raises(Exception, match="not in every input"):
        C.blend([a, a.where("id = 'a'")]).collect()
