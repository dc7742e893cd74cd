import datetime as dt
import zipfile

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidecast.sources import io as tio
from tidecast.sources.io import (
    read_csv, read_csv_zip, read_features, read_predictions, read_submission, scratch_path, write_bucketed, write_csv,
    write_features, write_predictions, write_submission,
)


def test_feature_store_prunes_partitions(spark):
    rows = [(v, h, 1, float(v * 10 + h)) for v in (1, 2) for h in (1, 2, 3)]
    df = spark.createDataFrame(rows, "version int, horizon int, store int, x double")
    path = scratch_path(spark, "fs-test")
    write_features(df, path)
    got = read_features(spark, path, 2, 3)
    assert [tuple(r) for r in got.collect()] == [(1, 23.0)]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(version" in plan


def test_predictions_and_submission_roundtrip(spark):
    d = dt.date(2001, 3, 5)
    rows = [(1, 2, d, h, "m", "test", float(h)) for h in (1, 2)]
    df = spark.createDataFrame(rows, "store int, dept int, dt date, horizon int, model string, split string, pred double")
    path = scratch_path(spark, "pred-test")
    write_predictions(df, path)
    back = read_predictions(spark, path, "m")
    assert sorted(r["pred"] for r in back.collect()) == [1.0, 2.0]
    sub = spark.createDataFrame([("1_2_2001-03-05", 4.5)], "id string, pred double")
    spath = scratch_path(spark, "sub-test")
    write_submission(sub, spath)
    assert [tuple(r) for r in read_submission(spark, spath).collect()] == [("1_2_2001-03-05", 4.5)]


def test_csv_na_strings_become_null(spark):
    df = spark.createDataFrame([(1, "NA"), (2, "3.5")], "k int, v string")
    path = scratch_path(spark, "csv-test")
    write_csv(df, path)
    back = read_csv(spark, path, "k int, v double").orderBy("k").collect()
    assert [tuple(r) for r in back] == [(1, None), (2, 3.5)]


def _zip(path, members, **kw):
    with zipfile.ZipFile(path, "w", **kw) as z:
        for name, text in members.items():
            z.writestr(name, text)


def test_zipped_csv_members_are_read_by_several_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tio, "MEMBER_PART", 1000)  # members span several rows
    want = []
    for a in range(2):
        members = {}
        for m in range(4):
            rows = [(a * 10_000 + m * 1000 + i, "NA" if i % 7 == 0 else f"{i / 4}", f"x, \"{i}\"\nline é" if i % 11 == 0 else f"n{i}") for i in range(500)]
            members[f"part/{m}.CSV"] = "name,k,v\r\n" + "".join('"' + t.replace('"', '""') + f'",{k},{v}\r\n' for k, v, t in rows)
            want += [(k, None if v == "NA" else float(v), t) for k, v, t in rows]
        _zip(tmp_path / f"{a}.zip", {**members, "readme.txt": "not a table", "empty.csv": ""}, compression=zipfile.ZIP_DEFLATED if a else zipfile.ZIP_STORED)
    df = read_csv_zip(spark, str(tmp_path), "k int, v double, name string")
    assert sorted(tuple(r) for r in df.collect()) == sorted(want, key=lambda r: r[0])
    assert df.select(F.spark_partition_id()).distinct().count() > 1


def test_zipped_csv_rejects_what_does_not_fit(spark, tmp_path):
    for i, (text, schema) in enumerate([("a,b\n1,x\n", "a int, c string"), ("a,b\nx,y\n", "a int, b string"), ("a,b\n1\n", "a int, b string")]):
        _zip(tmp_path / f"{i}.zip", {"t.csv": text})
        with pytest.raises(Exception):
            read_csv_zip(spark, str(tmp_path / f"{i}.zip"), schema).collect()


def test_bucketed_table_needs_no_shuffle(spark):
    df = spark.range(2000).selectExpr("cast(id % 7 as int) as store", "cast(id % 11 as int) as dept", "cast(id as int) as day", "cast(id as double) as x")
    t = write_bucketed(df, "bucketed_test", ["store", "dept"], 4, ["day"])
    w = Window.partitionBy("store", "dept").orderBy("day").rangeBetween(-100, -7)
    sums = t.withColumn("s", F.sum("x").over(w)).groupBy("store", "dept").agg(F.max("s").alias("s"))
    other = t.groupBy("store", "dept").count()
    plan = sums.join(other.hint("merge"), ["store", "dept"])
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in text and "Window" in text and "SortMergeJoin" in text
    direct = df.withColumn("s", F.sum("x").over(w)).groupBy("store", "dept").agg(F.max("s").alias("s"))
    assert sorted(map(tuple, sums.collect())) == sorted(map(tuple, direct.collect()))


def test_a_model_is_read_with_its_own_schema(spark):
    path = scratch_path(spark, "pred-schemas")
    d = dt.date(2001, 3, 5)
    write_predictions(spark.createDataFrame([(1, 2, d, 1, "m", "test", 1.0)], "store int, dept int, dt date, horizon int, model string, split string, pred double"), path)
    write_predictions(spark.createDataFrame([(1, 2, d, 1, "m", "train", 1.0, 2.0)], "store int, dept int, dt date, horizon int, model string, split string, pred_fold0 double, pred_fold1 double"), path)
    assert set(read_predictions(spark, path, "m").columns) == {"store", "dept", "dt", "horizon", "pred"}
    assert set(read_predictions(spark, path, "m", "train").columns) == {"store", "dept", "dt", "horizon", "pred_fold0", "pred_fold1"}
