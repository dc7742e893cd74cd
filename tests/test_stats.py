import datetime as dt

from tidecast.operators import stats


def test_histogram_closed_last_bin_and_zero_width(spark):
    df = spark.createDataFrame([(float(x),) for x in (0, 1, 5, 9, 10, 10)], "x double")
    got = {r["bin"]: (r["lo"], r["hi"], r["n"]) for r in stats.histogram(df, "x", 10).collect()}
    assert got == {0: (0.0, 1.0, 1), 1: (1.0, 2.0, 1), 5: (5.0, 6.0, 1), 9: (9.0, 10.0, 3)}
    flat = spark.createDataFrame([(3.0,), (3.0,)], "x double")
    assert [tuple(r) for r in stats.histogram(flat, "x", 10).collect()] == [(0, 3.0, 3.0, 2)]


def test_overlap_counts(spark):
    a = spark.createDataFrame([(1, 1), (1, 2), (2, 1), (2, 1)], "store int, dept int")
    b = spark.createDataFrame([(1, 2), (3, 1)], "store int, dept int")
    r = stats.overlap(a, b, ["store", "dept"]).first()
    assert (r["only_left"], r["only_right"], r["both"]) == (2, 1, 1)
    r = stats.overlap(a, b, ["store"]).first()
    assert (r["only_left"], r["only_right"], r["both"]) == (1, 1, 1)


def test_top_k_tie_order(spark):
    df = spark.createDataFrame([(2, 5.0), (1, 5.0), (3, 7.0), (4, 1.0)], "store int, m double")
    assert [r["store"] for r in stats.top_k(df, "m", 3, ["store"]).collect()] == [3, 1, 2]


def test_pivot_fill_and_distinct_counts(spark):
    d = dt.date(2000, 1, 3)
    df = spark.createDataFrame([(d, 1, 2.0), (d, 1, 3.0), (d, 10, 1.0), (d + dt.timedelta(days=7), 2, 4.0)],
                               "dt date, dept int, sales double")
    piv = {r["dt"]: tuple(r[c] for c in ("1", "2", "10")) for r in stats.pivot_sum(df, "dt", "dept", "sales", [1, 2, 10]).collect()}
    assert piv == {d: (5.0, 0.0, 1.0), d + dt.timedelta(days=7): (0.0, 4.0, 0.0)}
    counts = stats.distinct_counts(df, ["dt", "dept", ("dt", "dept")]).first()
    assert (counts["n_dt"], counts["n_dept"], counts["n_dt_dept"]) == (2, 3, 3)


def test_sparse_series_and_rows_of(spark):
    d = dt.date(2000, 1, 3)
    rows = [(1, 1, d + dt.timedelta(weeks=w), 1.0) for w in range(25)] + [(1, 2, d, 2.0), (2, 1, d, 3.0)]
    df = spark.createDataFrame(rows, "store int, dept int, dt date, sales double")
    sparse = stats.sparse_series(df)
    assert sorted((r["store"], r["dept"], r["n_weeks"]) for r in sparse.collect()) == [(1, 2, 1), (2, 1, 1)]
    assert stats.rows_of(df, sparse).count() == 2


def test_pivot_raises_on_undeclared_values(spark):
    import pytest

    df = spark.createDataFrame([(1, 1, 2.0), (1, 9, 3.0)], "dt int, dept int, sales double")
    with pytest.raises(Exception, match="not declared: 9"):
        stats.pivot_sum(df, "dt", "dept", "sales", [1, 2]).collect()


def test_sketches_merge_to_unions_within_their_error(spark):
    df = spark.range(200_000).selectExpr("cast(id % 50 as int) as g", "cast(id * 7919 % 120000 as int) as v")
    stored = stats.distinct_sketches(df, ["g"], {"v": ["v"]}, lg=12)
    exact = df.select("v").distinct().count()
    n = stats.merged_counts(stored, ["v"]).first()["n_v"]
    assert abs(n - exact) / exact < 4 / 4096**0.5
    a, b = df.where("v < 80000"), df.where("v >= 50000")
    got = stats.sketch_overlap(*[stats.distinct_sketches(x, ["g"], {"v": ["v"]}) for x in (a, b)], "v").first()
    want = stats.overlap(a, b, ["v"]).first()
    for k in ("only_left", "only_right", "both"):
        assert abs(got[k] - want[k]) / exact < 6 / 4096**0.5
    few = stats.sketch_overlap(*[stats.distinct_sketches(x, ["g"], {"v": ["v"]}) for x in (a.where("v < 60"), a.where("v between 50 and 99"))], "v").first()
    assert tuple(few) == (50, 40, 10)


def test_sparse_sums_need_no_declared_values(spark):
    rows = [(1, d, float(d)) for d in range(5000)] + [(2, 7, 1.0), (2, 7, 2.0), (2, None, 5.0), (3, None, 1.0)]
    df = spark.createDataFrame(rows, "row int, col int, x double")
    sparse = stats.sparse_sum(df, "row", "col", "x")
    got = {r.row: r.sums for r in sparse.collect()}
    assert got == {1: {d: float(d) for d in range(5000)}, 2: {7: 3.0}}
    wide = {r.row: (r["7"], r["9999"]) for r in stats.dense(sparse, "row", [7, 9999]).collect()}
    assert wide == {1: (7.0, 0.0), 2: (3.0, 0.0)}
