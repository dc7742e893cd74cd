"""Baseline forecasts and multi-horizon / multi-model combination
(A10, A11, A17, A18, J4-J6, C14-C18, M8, M13-M18).

Forecast tables are long: (store, dept, dt, horizon, pred).  Wide
"one column per horizon" frames are only produced for display
(:func:`horizon_wide`); combination works on the long form with one
aggregation per key.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidecast.functions.cols import series_id
from tidecast.functions.dates import week_of_month
from tidecast.operators.windows import SERIES

KEY = ("store", "dept", "dt")

# The hierarchy of the statistical baseline, finest first.
HIER_LEVELS = {
    "store_dept_month_week": ("store", "dept", "month", "week"),
    "store_dept_month": ("store", "dept", "month"),
    "store_dept": ("store", "dept"),
    "store": ("store",),
}


def with_season(df: DataFrame, clamp_december: bool = True) -> DataFrame:
    return df.withColumns({"month": F.month("dt"), "week": week_of_month("dt", clamp_december)})


def hier_means(history: DataFrame, value: str = "sales", clamp_december: bool = True) -> DataFrame:
    """Long table of the hierarchical means: one pass over the four grouping
    sets of store > dept > month > week (A11)."""
    h = with_season(history, clamp_december)
    keys = [F.col(c) for c in HIER_LEVELS["store_dept_month_week"]]
    sets = [[F.col(c) for c in level] for level in HIER_LEVELS.values()]
    g = h.groupingSets(sets, *keys).agg(F.avg(value).alias("mean"), F.grouping_id().alias("_g"))
    names = {0: "store_dept_month_week", 1: "store_dept_month", 3: "store_dept", 7: "store"}
    level = F.lit(None).cast("string")
    for gid, name in names.items():
        level = F.when(F.col("_g") == gid, F.lit(name)).otherwise(level)
    return g.select(level.alias("level"), "store", "dept", "month", "week", "mean")


def hier_level_means(history: DataFrame, future: DataFrame, value: str = "sales",
                     clamp_december: bool = True) -> DataFrame:
    """Future rows with the history mean of each hierarchy level.

    History and future are stacked and the three series-refining levels are
    windows over the stacked panel (future labels are NULL, so averages see
    history only).  All three partitionings refine (store, dept), so one
    shuffle by series serves them, and each partition is one series,
    bounded by the calendar.  The store level would make a partition of a
    whole (possibly hot) store, so it is a partially aggregated groupBy
    joined back instead.
    """
    panel = history.select(*KEY, F.col(value).alias("_y"), F.lit(False).alias("_f")).unionByName(
        future.select(*KEY, F.lit(None).cast("double").alias("_y"), F.lit(True).alias("_f"))
    )
    panel = with_season(panel, clamp_december).repartition(*SERIES)
    means = {f"mean_{name}": F.avg("_y").over(Window.partitionBy(*keys))
             for name, keys in HIER_LEVELS.items() if name != "store"}
    out = panel.withColumns(means).where("_f").drop("_y", "_f")
    store = history.groupBy("store").agg(F.avg(value).alias("mean_store"))
    return out.join(store, "store", "left")


def hier_forecast(history: DataFrame, future: DataFrame, value: str = "sales",
                  clamp_december: bool = True) -> DataFrame:
    """Statistical baseline (M13): mean of the same (series, month, week of
    month), else of (series, month), else of the series, else 0.  The store
    mean is computed by the reference but not used in its fallback chain,
    so it is left out of this plan (it is part of :func:`hier_level_means`).
    """
    panel = history.select(*KEY, F.col(value).alias("_y"), F.lit(False).alias("_f")).unionByName(
        future.select(*KEY, F.lit(None).cast("double").alias("_y"), F.lit(True).alias("_f"))
    )
    panel = with_season(panel, clamp_december).repartition(*SERIES)
    m1, m2, m3 = [F.avg("_y").over(Window.partitionBy(*HIER_LEVELS[n]))
                  for n in ("store_dept_month_week", "store_dept_month", "store_dept")]
    out = panel.withColumn("pred", F.coalesce(m1, m2, m3, F.lit(0.0))).where("_f")
    return out.select(*KEY, series_id("store", "dept", "dt").alias("id"), "pred")


def fitted_history(history: DataFrame, value: str = "sales", clamp_december: bool = True) -> DataFrame:
    """History rows with the finest-level mean as in-sample fit (J4 back to train)."""
    h = with_season(history, clamp_december)
    fit = F.avg(value).over(Window.partitionBy("store", "dept", "month", "week"))
    return h.withColumn("fitted", fit)


def fit_overlay(df: DataFrame, value: str = "sales", fitted: str = "fitted", value_scale: int | None = 4) -> DataFrame:
    """Per-date totals of actual and fitted values (A10).

    The label has ``value_scale`` decimals, so its total is summed exactly in
    decimal: a double sum depends on the order rows arrive in, which
    changes with the partitioning.  ``None`` keeps a double sum.
    """
    total = F.sum(value) if value_scale is None else \
        F.sum(F.col(value).cast(f"decimal(38,{value_scale})")).cast("double")
    return df.groupBy("dt").agg(total.alias("sum_" + value), F.sum(fitted).alias("sum_" + fitted))


def horizon_predictions(forecast: DataFrame, horizons: Sequence[int], cutoff: dt.date, month_days: int = 28,
                        pred: str = "pred") -> DataFrame:
    """Per-horizon copies of a forecast restricted to each horizon's window
    (dt <= cutoff + 28h); a row explode, no join (used to feed the
    combination operators with deterministic inputs)."""
    h = F.explode(F.array(*[F.lit(x) for x in horizons])).alias("horizon")
    out = forecast.select(*KEY, pred, h)
    return out.where(F.col("dt") <= F.date_add(F.lit(cutoff), F.col("horizon") * month_days))


def horizon_wide(preds: DataFrame, horizons: Sequence[int], spine: DataFrame | None = None,
                 pred: str = "pred") -> DataFrame:
    """One column per horizon, ``pred_h{n}``; rows of ``spine`` (default:
    every key seen) (J5)."""
    wide = preds.groupBy(*KEY).pivot("horizon", list(horizons)).agg(F.first(pred))
    wide = wide.select(*KEY, *[F.col(str(h)).alias(f"pred_h{h}") for h in horizons])
    if spine is None:
        return wide
    return spine.select(*KEY).join(wide, list(KEY), "left")


def horizon_mean(preds: DataFrame, pred: str = "pred", spine: DataFrame | None = None) -> DataFrame:
    """Mean of the available horizons per key and their count (M14, A18);
    with a ``spine``, exactly its keys, 0 horizons where none reaches one."""
    mean = preds.groupBy(*KEY).agg(F.avg(pred).alias("pred"), F.count(pred).alias("n_horizons"))
    if spine is None:
        return mean
    return spine.select(*KEY).join(mean, list(KEY), "left").fillna(0, ["n_horizons"])


def horizon_first(preds: DataFrame, pred: str = "pred") -> DataFrame:
    """Forecast of the nearest available horizon per key."""
    p = preds.where(F.col(pred).isNotNull())
    return p.groupBy(*KEY).agg(F.min_by(pred, "horizon").alias("pred"), F.min("horizon").alias("horizon"))


def columns_like(df: DataFrame, token: str) -> list[str]:
    """Columns whose name contains ``token`` (P14), e.g. every fold prediction."""
    return [c for c in df.columns if token in c]


def row_mean(cols: Sequence[str]) -> Column:
    """Row-wise mean skipping NULLs; NULL when all are NULL."""
    n = sum((F.col(c).isNotNull().cast("int") for c in cols), F.lit(0))
    s = sum((F.coalesce(F.col(c), F.lit(0.0)) for c in cols), F.lit(0.0))
    return F.when(n > 0, s / n)


def scale_dates(df: DataFrame, ratios: Mapping[dt.date, float], value: str = "pred") -> DataFrame:
    """Multiply the forecast on given dates by a ratio (C17)."""
    v = F.col(value)
    for d, r in ratios.items():
        v = F.when(F.col("dt") == F.lit(d), v * F.lit(r)).otherwise(v)
    return df.withColumn(value, v)


def redistribute(df: DataFrame, d0: dt.date, d1: dt.date, r0: float = 6 / 14, r1: float = 8 / 14,
                 value: str = "pred") -> DataFrame:
    """Share two adjacent weeks' total r0 : r1 between them when both are
    present in the series (C18, W6, W7)."""
    w = Window.partitionBy(*SERIES).orderBy("dt")
    nxt, nxt_dt = F.lead(value).over(w), F.lead("dt").over(w)
    prv, prv_dt = F.lag(value).over(w), F.lag("dt").over(w)
    v = F.col(value)
    out = (
        F.when((F.col("dt") == F.lit(d0)) & (nxt_dt == F.lit(d1)) & nxt.isNotNull(), (v + nxt) * F.lit(r0))
        .when((F.col("dt") == F.lit(d1)) & (prv_dt == F.lit(d0)) & prv.isNotNull(), (v + prv) * F.lit(r1))
        .otherwise(v)
    )
    return df.withColumn(value, out)


def blend(forecasts: Sequence[DataFrame], weights: Sequence[float] | None = None, key: str = "id",
          value: str = "pred", partial: bool = False) -> DataFrame:
    """Weighted mean of several forecasts aligned on ``key``.

    The frames are stacked and aggregated once per key (no positional
    alignment).  All inputs must hold the same keys, each once: a key that
    some of them lack raises an error when the plan runs, unless ``partial``
    is set; then the rest is averaged and ``n_models`` shows how many contributed.
    """
    weights = list(weights) if weights is not None else [1.0] * len(forecasts)
    parts = [f.select(key, (F.col(value) * F.lit(w)).alias("_wv"), F.lit(w).alias("_w"))
             for f, w in zip(forecasts, weights)]
    stacked = parts[0]
    for p in parts[1:]:
        stacked = stacked.unionByName(p)
    out = stacked.groupBy(key).agg(
        (F.sum("_wv") / F.sum("_w")).alias(value), F.count(F.lit(1)).alias("n_models")
    )
    if partial:
        return out
    lacking = F.raise_error(F.concat(F.lit("not in every input, or more than once: "), F.col(key).cast("string")))
    whole = F.when(F.col("n_models") == len(forecasts), F.col("n_models")).otherwise(lacking.cast("long"))
    return out.withColumn("n_models", whole)


def forecast_vs_actual(history: DataFrame, preds: DataFrame, value: str = "sales", pred: str = "pred") -> DataFrame:
    """Mean actual and mean forecast by date in one table, for dates that
    have either (M18)."""
    both = history.select("dt", F.col(value).alias("_y"), F.lit(None).cast("double").alias("_p")).unionByName(
        preds.select("dt", F.lit(None).cast("double").alias("_y"), F.col(pred).alias("_p")))
    return both.groupBy("dt").agg(F.avg("_y").alias("mean_" + value), F.avg("_p").alias("mean_pred"))


def forecast_by_date(preds: DataFrame, pred: str = "pred", by: Sequence[str] = ("dt", "horizon")) -> DataFrame:
    """Mean forecast per date (and horizon)."""
    return preds.groupBy(*by).agg(F.avg(pred).alias("mean_pred"), F.count(pred).alias("n"))
