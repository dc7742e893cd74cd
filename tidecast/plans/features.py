"""Versioned feature sets per forecast horizon.

``build_features`` produces one horizon; ``build_all_horizons`` produces all
of them from a single panel in one pass: the frames of horizon h only reach
rows dated <= END(h) - 28h, which every horizon's panel contains, so the
windows can be evaluated on the widest panel and unpivoted into a
``horizon`` column afterwards.  One shuffle per window partitioning serves
all horizons instead of one per horizon.  The calendar (cut-off, first
feature date, days of a month) comes with the tables.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidecast.functions.cols import NA_COLUMNS
from tidecast.operators.joins import enrich, guard_unique_key, union_panel
from tidecast.operators.windows import (
    LEVELS,
    OPS,
    ORDER,
    SERIES,
    SPANS,
    expanding_lagged_avg,
    feature_name,
    lagged_range_columns,
    level_name,
    rollup_windows,
    seasonal_value,
    shifted_rollup,
)
from tidecast.sources.io import write_features
from tidecast.sources.panel import PanelTables

VERSIONS = (1, 2, 3, 4)

# Columns of the base panel in output order.
BASE_COLUMNS = (
    "store", "dept", "dt", "month", "week", "unixtime", "is_holiday", "sales", "type", "size",
    "temperature", "fuel_price", *NA_COLUMNS,
)

LAG = "lag1_store_dept_sales"
WEEK_AVG = "sales_avg_by_store_dept_week"
NORM_WEEK_AVG = "norm_sales_avg_by_store_dept_week"


def values_for(version: int) -> list[str]:
    return ["sales", "norm_sales"] if version >= 4 else ["sales"]


def window_columns(version: int) -> list[str]:
    """Names of the SQL-side feature columns of a version, in output order."""
    cols = []
    for value in values_for(version):
        for keys in LEVELS:
            for span in SPANS:
                cols += [feature_name(value, op, keys, span) for op in OPS]
    if version >= 4:
        cols += [WEEK_AVG, NORM_WEEK_AVG]
    if version >= 2:
        cols.append(LAG)
    if version >= 3:
        cols += diff_columns()
    return cols


def diff_columns() -> list[str]:
    return ["diff_" + feature_name("sales", "avg", keys, span) for keys in LEVELS for span in SPANS]


def output_columns(version: int) -> list[str]:
    base = list(BASE_COLUMNS)
    if version >= 4:
        base.insert(base.index("sales") + 1, "norm_sales")
    return base + window_columns(version)


# Training-time feature lists (besides the window features)
# and categorical columns per version.
_TRAIN_BASE = (
    "store", "dept", "month", "weekofyear", "week", "is_holiday", "thanksgiving", "christmas", "type", "size",
    "temperature", "fuel_price", "markdown1", "markdown2", "markdown3", "markdown4", "markdown5", "cpi",
    "unemployment",
)
CATEGORICAL = {
    1: ("store", "dept", "type", "is_holiday"),
    2: ("store", "dept", "type", "is_holiday", "christmas", "thanksgiving"),
    3: ("store", "dept", "type", "is_holiday", "christmas"),
    4: ("store", "dept", "type", "is_holiday", "christmas"),
}


def feature_columns(version: int) -> list[str]:
    """Model input columns of a version (55 / 56 / 65 / 104 columns)."""
    base = list(_TRAIN_BASE)
    if version >= 4:
        base.insert(base.index("is_holiday") + 1, "superbowl")
    feats = [c for c in window_columns(version) if c not in (LAG, WEEK_AVG, NORM_WEEK_AVG)
             and not c.startswith("diff_")]
    out = base
    if version >= 2:
        out = out + [LAG]
    out = out + feats
    if version >= 4:
        out += [WEEK_AVG, NORM_WEEK_AVG]
    if version >= 3:
        out += diff_columns()
    return out


def base_data(tables: PanelTables, horizon: int, version: int = 1) -> DataFrame:
    """History plus the horizon's future weeks, enriched (BASE_DATA)."""
    panel = union_panel(tables.history, tables.future, tables.calendar.end_date(horizon))
    df = enrich(panel, tables.stores, tables.context, norm=version >= 4)
    return df.withColumn("unixtime", F.col("day_num").cast("long") * F.lit(86400))


def rollup_source(tables: PanelTables, horizon: int, version: int) -> DataFrame:
    """The columns the coarse-level rollups need: the panel, plus the store
    size when the size-normalised label is used (no context join)."""
    panel = union_panel(tables.history, tables.future, tables.calendar.end_date(horizon))
    if version >= 4:
        panel = panel.join(tables.stores.select("store", "size"), "store", "left").withColumn(
            "norm_sales", F.try_divide(F.col("sales"), F.col("size")))
    return panel


def _series_columns(version: int, base: int, suffix: str = "") -> dict[str, Column]:
    cols = {}
    for value in values_for(version):
        cols.update(lagged_range_columns(value, SERIES, base, suffix=suffix))
    if version >= 4:
        cols[WEEK_AVG + suffix] = expanding_lagged_avg("sales", ("store", "dept", "week"), base)
        cols[NORM_WEEK_AVG + suffix] = expanding_lagged_avg("norm_sales", ("store", "dept", "week"), base)
    if version >= 2:
        cols[LAG + suffix] = seasonal_value("sales", base)
    return cols


def _with_windows(df: DataFrame, src: DataFrame, version: int, bases: dict[str, int]) -> DataFrame:
    """Series-level windows in place (one shuffle by series serves every
    spec) and the coarse levels through pre-aggregated rollups of ``src``
    joined back on (key, dt), which AQE broadcasts when they turn out small."""
    cols = {}
    for suffix, base in bases.items():
        cols.update(_series_columns(version, base, suffix))
    out = guard_unique_key(df.withColumns(cols))
    for keys in LEVELS:
        if keys == SERIES:
            continue
        feats = rollup_windows(src, values_for(version), keys, bases)
        out = out.join(feats, [*keys, "dt"], "left")
    return out


def _with_diffs(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {"diff_" + feature_name("sales", "avg", k, s): F.col(feature_name("sales", "avg", k, s)) - F.col(LAG)
         for k in LEVELS for s in SPANS}
    )


def build_features(tables: PanelTables, version: int, horizon: int, start: dt.date | None = None) -> DataFrame:
    """Feature set of ``version`` for forecasting ``horizon`` months ahead, over
    the calendar of ``tables``; rows from ``start`` on (default: the calendar's).

    Windows are computed in place instead of being joined back on the key,
    which is equal only while (store, dept, dt) is unique; the plan fails on
    a key that is not.
    """
    df = base_data(tables, horizon, version)
    out = _with_windows(df, rollup_source(tables, horizon, version), version,
                        {"": tables.calendar.month_days * horizon})
    if version >= 3:
        out = _with_diffs(out)
    out = out.where(F.col("dt") >= F.lit(start or tables.calendar.start))
    return out.select(*output_columns(version))


def _shifted(tables: PanelTables, version: int, horizons: list[int]) -> DataFrame:
    """The widest panel with the columns of every horizon, named like the
    one-pass form's, from frames that are computed once.

    The frame of horizon h at ``dt`` is the frame of lag 0 at ``dt - h
    months``.  So the panel gets a row without a label at each such date,
    the trailing frames run once over all rows, and a horizon's columns are
    looked up by a one-row RANGE frame at its distance.  That adds no
    shuffle: all of it is partitioned by series.  The seasonal columns
    partition by the row's own season and keep their growing frames.
    """
    md = tables.calendar.month_days
    df = base_data(tables, max(horizons), version).withColumn("_row", F.lit(True))
    at = F.explode(F.array(*[F.col("day_num") - md * h for h in horizons])).alias("day_num")
    points = df.select(*SERIES, at).withColumn("_row", F.lit(False))
    both = df.unionByName(points, allowMissingColumns=True).repartition(*SERIES)
    nth = F.row_number().over(Window.partitionBy(*SERIES, "day_num").orderBy(F.col("_row").desc()))
    both = both.withColumn("_nth", nth).where(F.col("_row") | (F.col("_nth") == 1)).drop("_nth")
    trailing = {}
    for value in values_for(version):
        trailing.update(lagged_range_columns(value, SERIES, 0))
    both = both.withColumns(trailing)
    frame = F.struct(*[F.col(c) for c in trailing])
    cols = {}
    for h in horizons:
        here = Window.partitionBy(*SERIES).orderBy(ORDER).rangeBetween(-md * h, -md * h)
        cols[f"_series_h{h}"] = F.first(frame).over(here)
        cols.update({k: c for k, c in _series_columns(version, md * h, f"__h{h}").items() if k.split("__h")[0] not in trailing})
    out = guard_unique_key(both.withColumns(cols).where("_row")).drop("_row", *trailing)
    src = rollup_source(tables, max(horizons), version)
    for keys in LEVELS:
        if keys != SERIES:
            out = out.join(shifted_rollup(src, values_for(version), keys, {f"_{level_name(keys)}_h{h}": md * h for h in horizons}), [*keys, "dt"], "left")
    return out


def build_all_horizons(tables: PanelTables, version: int, horizons: Iterable[int] | None = None,
                       start: dt.date | None = None, method: str = "onepass") -> DataFrame:
    """Long feature table with a ``horizon`` column (default: the calendar's).

    ``onepass`` evaluates every horizon's frames after one shuffle of the
    widest panel; ``shift`` computes the trailing frames once and looks every
    horizon's up, at the price of a row for each date and horizon; ``direct`` unions the per-horizon plans (one shuffle per
    horizon), kept as the plain form to compare against.
    """
    cal = tables.calendar
    horizons, start = list(horizons or cal.horizons), start or cal.start
    if method == "direct":
        parts = [build_features(tables, version, h, start).withColumn("horizon", F.lit(h)) for h in horizons]
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out
    per_h = [c for c in window_columns(version) if c not in diff_columns()]
    base_cols = [c for c in output_columns(version) if c not in window_columns(version)]
    if method == "onepass":
        df = base_data(tables, max(horizons), version)
        bases = {f"__h{h}": cal.month_days * h for h in horizons}
        wide = _with_windows(df, rollup_source(tables, max(horizons), version), version, bases)

        def of(c: str, h: int) -> Column:
            return F.col(f"{c}__h{h}")
    elif method == "shift":
        wide = _shifted(tables, version, horizons)
        level = {feature_name(v, op, k, s): level_name(k) if k != SERIES else "series"
                 for v in values_for(version) for k in LEVELS for s in SPANS for op in OPS}

        def of(c: str, h: int) -> Column:
            return F.col(f"_{level[c]}_h{h}").getField(c) if c in level else F.col(f"{c}__h{h}")
    else:
        raise ValueError(method)
    slices = F.array(*[F.struct(F.lit(h).alias("horizon"), *[of(c, h).alias(c) for c in per_h]) for h in horizons])
    long = wide.select(*base_cols, F.inline(slices))
    last = F.date_add(F.lit(cal.cutoff), F.col("horizon") * cal.month_days)
    long = long.where((F.col("dt") >= F.lit(start)) & (F.col("dt") <= last))
    if version >= 3:
        long = _with_diffs(long)
    return long.select(*output_columns(version), "horizon")


def write_feature_store(tables: PanelTables, path: str, versions: Iterable[int] = VERSIONS,
                        horizons: Iterable[int] | None = None) -> None:
    """Every version x horizon feature set under one dataset partitioned by
    (version, horizon), one job per version (S3, M12); replaces the versions
    that it writes."""
    horizons = list(horizons or tables.calendar.horizons)
    for v in versions:
        write_features(build_all_horizons(tables, v, horizons).withColumn("version", F.lit(v)), path)
