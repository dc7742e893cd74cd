import datetime as dt

from pyspark.sql import functions as F

from tidecast.functions.dates import holiday_flags, row_weight, week_of_month, week_us


def test_week_us_matches_sunday_week_numbers(spark):
    start = dt.date(1995, 1, 1)
    n = (dt.date(2013, 12, 31) - start).days + 1
    df = spark.range(n).select(F.date_add(F.lit(start), F.col("id").cast("int")).alias("d"))
    got = {r[0]: r[1] for r in df.select("d", week_us("d")).collect()}
    assert len(got) == n
    for d, w in got.items():
        assert w == int(d.strftime("%U")), d


def test_week_of_month_clamp_and_december(spark):
    days = [1, 6, 7, 27, 28, 31]
    rows = [(dt.date(2001, 1, d),) for d in days] + [(dt.date(2001, 12, d),) for d in days]
    df = spark.createDataFrame(rows, "dt date")
    got = df.orderBy("dt").select(week_of_month("dt"), week_of_month("dt", clamp_december=False)).collect()
    assert [r[0] for r in got] == [0, 0, 1, 3, 3, 3] * 2
    assert [r[1] for r in got] == [0, 0, 1, 3, 3, 3] + [0, 0, 1, 3, 4, 4]


def test_holiday_flags_and_weights(spark):
    rows = [(dt.date(2001, 2, 5), True), (dt.date(2001, 11, 19), True), (dt.date(2001, 12, 24), False),
            (dt.date(2001, 12, 31), None)]
    df = holiday_flags(spark.createDataFrame(rows, "dt date, is_holiday boolean"))
    got = df.orderBy("dt").select("superbowl", "thanksgiving", "christmas", row_weight().alias("w")).collect()
    assert [tuple(r) for r in got] == [(1, 0, 0, 5), (0, 1, 0, 5), (0, 0, 0, 1), (0, 0, 0, 1)]
