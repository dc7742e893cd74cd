import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidecast.operators.windows import (
    expanding_lagged_avg, lagged_range, lagged_range_columns, rolling_mean, seasonal_value,
)

T = dt.date(2000, 6, 1)
SCHEMA = "store int, dept int, dt date, sales double"


def _panel(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).withColumn("day_num", F.unix_date("dt"))


def _at(df, day, cols):
    r = df.where(F.col("dt") == F.lit(day)).select(*cols).collect()
    assert len(r) == 1
    return r[0]


def test_frame_ends_inclusive(spark):
    # frame of span 28 ending 28 days back: [T-56, T-28], both ends in
    rows = [(1, 1, T - dt.timedelta(days=k), v) for k, v in ((57, 1000.0), (56, 1.0), (28, 2.0), (27, 1000.0))]
    rows.append((1, 1, T, 5.0))
    df = lagged_range(_panel(spark, rows), "sales", ("store", "dept"), 28, spans={"m": 28})
    r = _at(df, T, ["sales_avg_by_store_dept_m", "sales_min_by_store_dept_m", "sales_max_by_store_dept_m",
                    "sales_stddev_by_store_dept_m"])
    assert r[0] == 1.5 and r[1] == 1.0 and r[2] == 2.0
    assert math.isclose(r[3], math.sqrt(0.5))


def test_single_row_stddev_is_null(spark):
    rows = [(1, 1, T - dt.timedelta(days=28), 3.0), (1, 1, T, 5.0)]
    for keys in (("store", "dept"), ("store",)):
        df = lagged_range(_panel(spark, rows), "sales", keys, 28, spans={"m": 28})
        name = "_".join(keys)
        r = _at(df, T, [f"sales_stddev_by_{name}_m", f"sales_avg_by_{name}_m"])
        assert r[0] is None and r[1] == 3.0


def test_null_first_value_kept_and_skipped_by_aggregates(spark):
    # same (month, sunday-week) a year apart; the oldest label is NULL
    d0, d1, d2 = dt.date(1998, 6, 1), dt.date(1999, 6, 7), dt.date(2000, 6, 5)
    rows = [(1, 1, d0, None), (1, 1, d1, 7.0), (1, 1, d2, 9.0)]
    df = _panel(spark, rows).withColumns({"month": F.month("dt"), "week": F.lit(22)})
    out = df.select("dt", seasonal_value("sales", 28).alias("first"), seasonal_value("sales", 28, mode="last")
                    .alias("last"), expanding_lagged_avg("sales", ("store", "dept", "week"), 28).alias("avg"))
    r = _at(out, d2, ["first", "last", "avg"])
    assert r[0] is None and r[1] == 7.0 and r[2] == 7.0


def test_rollup_equals_direct_window_with_peers(spark):
    rng = np.random.default_rng(7)
    rows = []
    for store in range(3):
        for dept in range(4):
            for w in range(60):
                if rng.random() < 0.8:
                    v = None if rng.random() < 0.05 else float(rng.normal(1e5, 3e4))
                    rows.append((store, dept, dt.date(2000, 1, 3) + dt.timedelta(weeks=w), v))
    panel = _panel(spark, rows)
    for keys in (("store",), ("dept",)):
        rolled = lagged_range(panel, "sales", keys, 56)
        direct = panel.withColumns(lagged_range_columns("sales", keys, 56))
        cols = [c for c in direct.columns if c.startswith("sales_")]
        a = {tuple(r[:3]): r[3:] for r in rolled.select("store", "dept", "dt", *cols).collect()}
        b = {tuple(r[:3]): r[3:] for r in direct.select("store", "dept", "dt", *cols).collect()}
        assert a.keys() == b.keys()
        for k in a:
            for x, y in zip(a[k], b[k]):
                assert (x is None) == (y is None), (keys, k)
                if x is not None:
                    assert math.isclose(x, y, rel_tol=1e-9, abs_tol=1e-6), (keys, k, x, y)


@pytest.mark.parametrize("fallback,expected", [(True, [1.0, 1.5, 3.0, None, 8.0]),
                                               (False, [None, 1.5, 3.0, None, None])])
def test_rolling_two_with_gap(spark, fallback, expected):
    vals = [1.0, 2.0, 4.0, None, 8.0]
    rows = [(1, 1, dt.date(2000, 1, 3) + dt.timedelta(weeks=i), v) for i, v in enumerate(vals)]
    out = rolling_mean(spark.createDataFrame(rows, SCHEMA), "sales", fallback=fallback)
    got = [r[0] for r in out.orderBy("dt").select("sales_rolling_mean").collect()]
    assert got == expected


def _windows_above_aggregate(plan: str, key: str) -> list[bool]:
    """For every Window node partitioned by ``key`` alone, whether an
    Aggregate sits below it (i.e. it runs over per-(key, dt) partials)."""
    import re
    lines = plan.splitlines()
    depth = [len(l) - len(l.lstrip(" :+-")) for l in lines]
    only_key = re.compile(rf"windowspecdefinition\({key}#\d+, (day_num#|specifiedwindowframe)")
    out = []
    for i, line in enumerate(lines):
        if line.lstrip(" :+-").startswith("Window ") and only_key.search(line):
            below = []
            for j in range(i + 1, len(lines)):
                if depth[j] <= depth[i]:
                    break
                below.append(lines[j])
            out.append(any(b.lstrip(" :+-").startswith("Aggregate") for b in below))
    return out


def test_hot_store_is_pre_aggregated(spark):
    """One store holds about a third of the rows: its rows are combined per
    (store, dt) before any store-level window, and values equal the direct form."""
    rng = np.random.default_rng(11)
    rows = []
    for w in range(40):
        day = dt.date(2000, 1, 3) + dt.timedelta(weeks=w)
        for dept in range(30):                      # hot store: 30 depts
            rows.append((0, dept, day, float(rng.normal(5e4, 1e4))))
        for store in range(1, 21):                  # 20 stores x 3 depts
            for dept in range(3):
                rows.append((store, dept, day, float(rng.normal(5e4, 1e4))))
    panel = _panel(spark, rows)
    rolled = lagged_range(panel, "sales", ("store",), 28)
    flags = _windows_above_aggregate(rolled._jdf.queryExecution().optimizedPlan().toString(), "store")
    assert flags and all(flags)
    direct = panel.withColumns(lagged_range_columns("sales", ("store",), 28))
    cols = [c for c in direct.columns if c.startswith("sales_")]
    a = {tuple(r[:3]): r[3:] for r in rolled.select("store", "dept", "dt", *cols).collect()}
    b = {tuple(r[:3]): r[3:] for r in direct.select("store", "dept", "dt", *cols).collect()}
    assert a.keys() == b.keys()
    for k in a:
        for x, y in zip(a[k], b[k]):
            assert (x is None) == (y is None)
            if x is not None:
                assert math.isclose(x, y, rel_tol=1e-9, abs_tol=1e-6)
