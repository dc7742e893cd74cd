import datetime as dt
import math
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from tidecast.operators.joins import assert_unique_key
from tidecast.plans.features import base_data, build_all_horizons, build_features, feature_columns, output_columns
from tidecast.sources.fixtures import PanelTables, end_date, load_panel_tables

from conftest import SF_SMALL


@pytest.fixture(scope="module")
def tables(spark):
    return load_panel_tables(spark, SF_SMALL, materialize=True)


def _rows(df, cols):
    return {(r["store"], r["dept"], r["dt"]): tuple(r[c] for c in cols) for r in df.select(*cols).collect()}


def _same(a, b):
    assert a.keys() == b.keys()
    for k in a:
        for x, y in zip(a[k], b[k]):
            assert (x is None) == (y is None), k
            if isinstance(x, float):
                assert math.isclose(x, y, rel_tol=1e-9, abs_tol=1e-6), (k, x, y)
            else:
                assert x == y


def test_feature_list_sizes():
    assert [len(feature_columns(v)) for v in (1, 2, 3, 4)] == [55, 56, 65, 104]


def test_all_horizons_equals_per_horizon(spark, tables):
    long = build_all_horizons(tables, 4, horizons=(1, 3, 10))
    cols = output_columns(4)
    for h in (1, 3, 10):
        one = build_features(tables, 4, h)
        _same(_rows(long.where(F.col("horizon") == h), cols), _rows(one, cols))


def test_row_count_and_unique_key(spark, tables):
    feats = build_features(tables, 3, 2)
    assert_unique_key(feats)
    panel = base_data(tables, 2).where(F.col("dt") >= F.lit(dt.date(1995, 3, 27)))
    assert feats.count() == panel.count()


def test_horizon_futures_are_nested(spark, tables):
    for h in (1, 5):
        a = base_data(tables, h).where(F.col("sales").isNull()).select("store", "dept", "dt")
        b = base_data(tables, h + 1).where(F.col("sales").isNull()).select("store", "dept", "dt")
        assert a.subtract(b).count() == 0
        assert a.agg(F.max("dt")).first()[0] <= end_date(h)


def test_no_leakage(spark, tables):
    """Changing labels dated after dt - 28h leaves the features at dt unchanged."""
    h, target = 2, dt.date(1999, 6, 7)
    cut = target - dt.timedelta(days=28 * h)
    changed = tables.history.withColumn(
        "sales", F.when(F.col("dt") > F.lit(cut), F.col("sales") * 10 + 1).otherwise(F.col("sales")))
    other = PanelTables(history=changed, future=tables.future, stores=tables.stores, context=tables.context, calendar=tables.calendar)
    cols = [c for c in output_columns(4) if c not in ("sales", "norm_sales") and not c.startswith("diff_")]
    a = build_features(tables, 4, h).where(F.col("dt") == F.lit(target))
    b = build_features(other, 4, h).where(F.col("dt") == F.lit(target))
    assert a.count() > 0
    _same(_rows(a, cols), _rows(b, cols))


@pytest.mark.parametrize("method", ["shift", "onepass"])
def test_all_in_one_equals_direct_union(spark, tables, method):
    cols = output_columns(2) + ["horizon"]
    a = build_all_horizons(tables, 2, horizons=(2, 7), method=method)
    b = build_all_horizons(tables, 2, horizons=(2, 7), method="direct")
    key = lambda r: (r["store"], r["dept"], r["dt"], r["horizon"])
    ra = {key(r): tuple(r[c] for c in cols) for r in a.collect()}
    rb = {key(r): tuple(r[c] for c in cols) for r in b.collect()}
    assert ra.keys() == rb.keys()
    for k in ra:
        for x, y in zip(ra[k], rb[k]):
            assert (x is None) == (y is None)
            if isinstance(x, float):
                assert math.isclose(x, y, rel_tol=1e-9, abs_tol=1e-6)


def test_feature_store_all_versions(spark, tables):
    from tidecast.plans.features import write_feature_store
    from tidecast.sources.io import read_features, scratch_path
    path = scratch_path(spark, "store-all")
    write_feature_store(tables, path, versions=(1, 4), horizons=(1, 2))
    v4 = read_features(spark, path, 4, 2)
    assert set(output_columns(4)) <= set(v4.columns)
    assert v4.count() == build_features(tables, 4, 2).count()


def test_other_calendar_and_many_departments(spark):
    """No row is lost on a panel with its own dates, gaps and 5,000 departments."""
    from tidecast.operators.encode import fit_codes
    from tidecast.sources.panel import Calendar

    first, cutoff = dt.date(2010, 2, 5), dt.date(2010, 6, 4)
    weeks = [first + dt.timedelta(days=7 * i) for i in range(17 + 9)]
    hist = [(1, d, w, float(d + i)) for i, w in enumerate(weeks) if w < cutoff for d in (range(5000) if i == 3 else (1, 7)) if (d + i) % 5]
    fut = [(1, d, w) for w in weeks if w >= cutoff for d in (1, 7, 9000)]
    schema = "store int, dept int, dt date"
    h, f = spark.createDataFrame(hist, schema + ", sales double"), spark.createDataFrame(fut, schema)
    stores = spark.createDataFrame([(1, "A", 10.0)], "store int, type string, size double")
    context = spark.createDataFrame([(1, w, 1.0, 2.0, *["NA"] * 7, False) for w in weeks], schema.replace("dept int, ", "")
                                    + ", temperature double, fuel_price double, markdown1 string, markdown2 string, markdown3 string,"
                                    " markdown4 string, markdown5 string, cpi string, unemployment string, is_holiday boolean")
    t = PanelTables(h, f, stores, context, Calendar(cutoff=cutoff, start=first + dt.timedelta(days=14), horizons=(1, 2)))
    for horizon in (1, 2):
        rows = build_features(t, 4, horizon).select("dept", "dt", "sales").collect()
        want = {(d, w) for _, d, w, _ in hist if w >= t.calendar.start} | {(d, w) for _, d, w in fut if w <= t.calendar.end_date(horizon)}
        assert {(r.dept, r.dt) for r in rows} == want and len(rows) == len(want)
    cols = output_columns(4)
    both = build_all_horizons(t, 4)
    for horizon in (1, 2):
        _same(_rows(both.where(F.col("horizon") == horizon), cols), _rows(build_features(t, 4, horizon), cols))
    codes = {r["value"]: r["code"] for r in fit_codes(h.select("dept").unionByName(f.select("dept")), "dept").collect()}
    assert codes == {v: i for i, v in enumerate(sorted({x[1] for x in hist} | {x[1] for x in fut}))}


@pytest.mark.parametrize("build", [lambda t: build_features(t, 3, 1), lambda t: build_all_horizons(t, 2, (1, 2)), lambda t: build_all_horizons(t, 2, (1, 2), method="shift")])
def test_a_repeated_key_fails_within_the_plan(spark, build):
    tables = load_panel_tables(spark, SF_SMALL, materialize=True)
    twice = replace(tables, history=tables.history.unionByName(tables.history.orderBy("dt", "store", "dept").limit(1)))
    with pytest.raises(Exception, match="not unique"):
        build(twice).write.format("noop").mode("overwrite").save()


def test_the_key_check_adds_no_shuffle(spark):
    from tidecast.operators.joins import guard_unique_key
    from tidecast.plans.features import base_data
    from tidecast.operators.windows import lagged_range

    tables = load_panel_tables(spark, SF_SMALL, materialize=True)
    plain = lagged_range(base_data(tables, 1), "sales", ("store", "dept"), 28)
    shuffles = [x._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") for x in (plain, guard_unique_key(plain))]
    assert shuffles[0] == shuffles[1]
