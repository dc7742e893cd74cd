"""Panel assembly: union, dimension joins, key checks, splits."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidecast.functions.cols import NA_COLUMNS, normalize_na
from tidecast.functions.dates import day_number, week_us

KEY = ("store", "dept", "dt")

def union_panel(history: DataFrame, future: DataFrame, end: dt.date | None = None,
                label: str = "sales") -> DataFrame:
    """History UNION ALL future-with-NULL-label; the horizon cut applies to the
    future arm only (U1, P5)."""
    fut = future if end is None else future.where(F.col("dt") <= F.lit(end))
    fut = fut.select("store", "dept", "dt", F.lit(None).cast("double").alias(label))
    return history.select("store", "dept", "dt", F.col(label).cast("double").alias(label)).unionByName(fut)


def enrich(panel: DataFrame, stores: DataFrame, context: DataFrame, norm: bool = False,
           label: str = "sales") -> DataFrame:
    """BASE_DATA: panel + store dimension + context, NA strings normalised,
    calendar columns added (P1, P2, P4, J1, J2, C1-C3)."""
    st = stores.select("store", "type", "size")
    ctx = context.select("store", "dt", "temperature", "fuel_price", *NA_COLUMNS, "is_holiday")
    out = panel.join(st, "store", "left").join(ctx, ["store", "dt"], "left")
    out = normalize_na(out)
    cols = {
        "month": F.month("dt"),
        "week": week_us("dt"),
        "day_num": day_number("dt"),
    }
    if norm:
        cols["norm_" + label] = F.try_divide(F.col(label), F.col("size"))
    return out.withColumns(cols)


def assert_unique_key(df: DataFrame, keys=KEY) -> None:
    """Fail if ``keys`` is not unique (guards the in-place window rewrite, J3).

    Runs one aggregation job; only a count reaches the driver.
    """
    dups = df.groupBy(*keys).count().where(F.col("count") > 1).limit(1).count()
    if dups:
        raise ValueError(f"key {tuple(keys)} is not unique")


def guard_unique_key(df: DataFrame, series=("store", "dept"), day: str = "day_num", dt: str = "dt") -> DataFrame:
    """``df`` whose date raises an error where a (series, date) occurs twice:
    the check of :func:`assert_unique_key` inside the plan that needs it (J3).
    Its window is partitioned and ordered like the series-level frames, so it
    adds neither a shuffle, a sort nor a job."""
    peers = F.count(F.lit(1)).over(Window.partitionBy(*series).orderBy(day).rangeBetween(0, 0))
    named = F.concat_ws(", ", *[F.col(c).cast("string") for c in (*series, dt)])
    fail = F.raise_error(F.concat(F.lit("the key (store, dept, dt) is not unique: "), named)).cast("date")
    return df.withColumn(dt, F.when(peers == 1, F.col(dt)).otherwise(fail))


def rows_with_lag(df: DataFrame, lag: str = "lag1_store_dept_sales") -> DataFrame:
    """Rows whose seasonal lag is present."""
    return df.where(F.col(lag).isNotNull())


def split_label(df: DataFrame, label: str = "sales") -> tuple[DataFrame, DataFrame]:
    """(labelled rows, unlabelled rows)."""
    return df.where(F.col(label).isNotNull()), df.where(F.col(label).isNull())


def warmup_cut(df: DataFrame, start: dt.date) -> DataFrame:
    """Drop the first weeks whose windows are short; applied after windows."""
    return df.where(F.col("dt") >= F.lit(start))
