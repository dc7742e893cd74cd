from tidecast.operators.joins import assert_unique_key, rows_with_lag, union_panel


def test_union_panel_cuts_future_only(spark):
    import datetime as dt
    h = spark.createDataFrame([(1, 1, dt.date(2001, 1, 1), 2.0)], "store int, dept int, dt date, sales double")
    f = spark.createDataFrame([(1, 1, dt.date(2001, 2, 5)), (1, 1, dt.date(2001, 3, 5))], "store int, dept int, dt date")
    got = sorted(tuple(r) for r in union_panel(h, f, dt.date(2001, 2, 5)).collect())
    assert got == [(1, 1, dt.date(2001, 1, 1), 2.0), (1, 1, dt.date(2001, 2, 5), None)]


def test_assert_unique_key_raises(spark):
    import pytest
    df = spark.createDataFrame([(1, 1), (1, 1)], "store int, dept int")
    with pytest.raises(ValueError):
        assert_unique_key(df, ["store", "dept"])


def test_rows_with_lag(spark):
    df = spark.createDataFrame([(1, None), (2, 0.0)], "x int, lag1_store_dept_sales double")
    assert [r.x for r in rows_with_lag(df).collect()] == [2]
