import datetime as dt

from tidecast.operators.encode import fit_codes, impute_mean, label_decode, label_encode, standardize
from tidecast.operators.folds import holdout_folds


def test_codes_follow_typed_order(spark):
    df = spark.createDataFrame([(10,), (2,), (1,), (2,)], "v int")
    got = {r["value"]: r["code"] for r in fit_codes(df, "v").collect()}
    assert got == {1: 0, 2: 1, 10: 2}


def test_encode_decode_roundtrip_with_null(spark):
    rows = [(1, "B", True), (10, "A", None), (2, "A", False)]
    df = spark.createDataFrame(rows, "store int, type string, hol boolean")
    enc, maps = label_encode(df, ["store", "type", "hol"])
    codes = sorted(tuple(r) for r in enc.collect())
    assert codes == [(0, 1, 2), (1, 0, 1), (2, 0, 0)]
    back = sorted(label_decode(enc, maps).collect(), key=lambda r: r["store"])
    assert [tuple(r) for r in back] == [(1, "B", True), (2, "A", False), (10, "A", None)]


def test_standardize_population_std_and_constant(spark):
    train = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "x double, c double")
    test = spark.createDataFrame([(5.0, 7.0)], "x double, c double")
    tr, te = standardize(train, test, ["x", "c"])
    assert sorted(r["x"] for r in tr.collect()) == [-1.0, 1.0]
    assert [r["c"] for r in tr.collect()] == [0.0, 0.0]
    assert te.first()["x"] == 3.0


def test_impute_mean_from_train(spark):
    train = spark.createDataFrame([(1.0,), (3.0,), (None,)], "x double")
    test = spark.createDataFrame([(None,), (9.0,)], "x double")
    tr, te = impute_mean(train, test, ["x"])
    assert sorted(r["x"] for r in tr.collect()) == [1.0, 2.0, 3.0]
    assert sorted(r["x"] for r in te.collect()) == [2.0, 9.0]


def test_nested_holdout_folds(spark):
    last = dt.date(2001, 1, 29)
    back = [0, 27, 28, 55, 56, 83, 84, 85]
    df = spark.createDataFrame([(last - dt.timedelta(days=b),) for b in back], "dt date")
    got = {r["dt"]: r for r in holdout_folds(df).collect()}
    for b in back:
        r = got[last - dt.timedelta(days=b)]
        assert r["valid_0"] == (b < 28) and r["valid_1"] == (b < 56) and r["valid_2"] == (b < 84)
        assert r["fold"] == (2 if b < 84 else None)
