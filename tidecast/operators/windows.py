"""Leak-free lagged window features on a weekly panel.

Every frame is RANGE over the day number, both ends inclusive, and ends
``base_days`` before the row, so a feature never sees the label it is used
to predict.

Two physical shapes produce the same values:

* series level, keys = (store, dept): the key is unique per date, so a
  partition is one series with at most one row per week.  Plain RANGE
  windows are bounded by the calendar, not by the data volume.
* coarser levels, keys = (store) or (dept): a direct window would put every
  row of a hot store into one task and scan many peers per date.  Instead
  the panel is pre-aggregated per (key, dt) into mergeable partials (count,
  sum, min, max, centred second moment) - the partial aggregation runs
  map-side, so a hot key is combined before it is shuffled - the frames are
  evaluated over that one-row-per-week table and the result is joined back
  on (key, dt).
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Frame spans in days and the names used in feature columns.
SPANS = {"half_year": 28 * 6, "two_month": 28 * 2, "one_month": 28 * 1}
OPS = ("avg", "stddev", "min", "max")
LEVELS = (("store", "dept"), ("store",), ("dept",))
SERIES = ("store", "dept")

ORDER = "day_num"


def level_name(keys: Sequence[str]) -> str:
    return "_".join(keys)


def feature_name(value: str, op: str, keys: Sequence[str], span: str) -> str:
    return f"{value}_{op}_by_{level_name(keys)}_{span}"


def _frame(keys: Sequence[str], lo, hi, order: str = ORDER):
    return Window.partitionBy(*keys).orderBy(order).rangeBetween(lo, hi)


def _direct(op: str, value: str, w) -> Column:
    if op == "avg":
        return F.avg(value).over(w)
    if op == "stddev":
        return F.stddev_samp(value).over(w)
    if op == "min":
        return F.min(value).over(w)
    if op == "max":
        return F.max(value).over(w)
    raise ValueError(op)


def lagged_range_columns(value: str, keys: Sequence[str], base_days: int, ops: Iterable[str] = OPS,
                         spans: Mapping[str, int] = SPANS, suffix: str = "") -> dict[str, Column]:
    """Direct RANGE-window feature columns ``{op}(value)`` over
    [dt - span - base, dt - base] per partition ``keys`` (W1, W2)."""
    out = {}
    for span_name, span in spans.items():
        w = _frame(keys, -(span + base_days), -base_days)
        for op in ops:
            out[feature_name(value, op, keys, span_name) + suffix] = _direct(op, value, w)
    return out


def lagged_range(df: DataFrame, value: str, keys: Sequence[str], base_days: int, ops: Iterable[str] = OPS,
                 spans: Mapping[str, int] = SPANS) -> DataFrame:
    """Add lagged range-window features; picks the physical shape by level."""
    if tuple(keys) == SERIES:
        return df.withColumns(lagged_range_columns(value, keys, base_days, ops, spans))
    return lagged_range_rollup(df, [value], keys, {"": base_days}, ops, spans)


def _partials(df: DataFrame, values: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """Mergeable per-(key, dt) partials of each value column; NULLs are
    skipped like the window aggregates skip them."""
    aggs = []
    for value in values:
        v = F.col(value)
        aggs += [
            F.count(v).alias(f"{value}__n"),
            F.sum(v).alias(f"{value}__s"),
            F.min(v).alias(f"{value}__mn"),
            F.max(v).alias(f"{value}__mx"),
            (F.var_pop(v) * F.count(v)).alias(f"{value}__m2"),
        ]
    agg = df.groupBy(*keys, "dt").agg(*aggs)
    # Centre each key on its own mean so the merged second moment does not
    # cancel: q = m2 + n * (mean - c)^2 and u = n * (mean - c).
    whole = Window.partitionBy(*keys)
    cols = [*keys, "dt", F.unix_date("dt").alias(ORDER)]
    for value in values:
        n, s = F.col(f"{value}__n"), F.col(f"{value}__s")
        c = F.try_divide(F.sum(s).over(whole), F.sum(n).over(whole))
        dev = s - n * c
        cols += [
            n, s, F.col(f"{value}__mn"), F.col(f"{value}__mx"),
            dev.alias(f"{value}__u"),
            (F.col(f"{value}__m2") + F.try_divide(dev * dev, n)).alias(f"{value}__q"),
        ]
    return agg.select(*cols)


def _merged(value: str, op: str, w) -> Column:
    n = F.sum(f"{value}__n").over(w)
    if op == "avg":
        return F.when(n > 0, F.try_divide(F.sum(f"{value}__s").over(w), n))
    if op == "min":
        return F.min(f"{value}__mn").over(w)
    if op == "max":
        return F.max(f"{value}__mx").over(w)
    if op == "stddev":
        u = F.sum(f"{value}__u").over(w)
        q = F.sum(f"{value}__q").over(w)
        m2 = q - F.try_divide(u * u, n)
        return F.when(n > 1, F.sqrt(F.try_divide(F.greatest(m2, F.lit(0.0)), n - 1)))
    raise ValueError(op)


def rollup_windows(df: DataFrame, values: Sequence[str], keys: Sequence[str], bases: Mapping[str, int],
                   ops: Iterable[str] = OPS, spans: Mapping[str, int] = SPANS) -> DataFrame:
    """One row per (keys, dt) with every lagged frame of each value for
    every base in ``bases`` (column suffix -> base days)."""
    parts = _partials(df, values, keys)
    cols = {}
    for suffix, base in bases.items():
        for span_name, span in spans.items():
            w = _frame(keys, -(span + base), -base)
            for value in values:
                for op in ops:
                    cols[feature_name(value, op, keys, span_name) + suffix] = _merged(value, op, w)
    return parts.select(*keys, "dt", *[c.alias(n) for n, c in cols.items()])


def shifted_rollup(df: DataFrame, values: Sequence[str], keys: Sequence[str], shifts: Mapping[str, int],
                   ops: Iterable[str] = OPS, spans: Mapping[str, int] = SPANS) -> DataFrame:
    """One row per (keys, dt) of ``df`` with, for each of ``shifts`` (name ->
    days), a struct of the trailing frames of lag 0 at that many days before:
    the frames run once, over the partials and a row without values at every date asked for."""
    parts = _partials(df, values, keys).withColumn("_row", F.lit(True))
    asked = F.explode(F.array(*[F.col(ORDER) - d for d in shifts.values()])).alias(ORDER)
    both = parts.unionByName(parts.select(*keys, asked).distinct().withColumn("_row", F.lit(False)), allowMissingColumns=True)
    cols = {}
    for span_name, span in spans.items():
        w = _frame(keys, -span, 0)
        for value in values:
            cols.update({feature_name(value, op, keys, span_name): _merged(value, op, w) for op in ops})
    out = both.select(*keys, "dt", ORDER, "_row", *[c.alias(n) for n, c in cols.items()])
    picks = {name: F.first(F.struct(*cols)).over(_frame(keys, -d, -d)) for name, d in shifts.items()}
    return out.withColumns(picks).where("_row").select(*keys, "dt", *picks)


def lagged_range_rollup(df: DataFrame, values: Sequence[str], keys: Sequence[str], bases: Mapping[str, int],
                        ops: Iterable[str] = OPS, spans: Mapping[str, int] = SPANS) -> DataFrame:
    """Pre-aggregated form of :func:`lagged_range` for coarse keys; equal to
    the direct window on every row (see tests).  How the rollup is joined
    back is left to the planner: AQE broadcasts it when it turns out small."""
    feats = rollup_windows(df, values, keys, bases, ops, spans)
    return df.join(feats, [*keys, "dt"], "left")


def expanding_lagged_avg(value: str, keys: Sequence[str], base_days: int) -> Column:
    """AVG over all earlier rows of the partition up to ``base_days`` back."""
    return F.avg(value).over(_frame(keys, Window.unboundedPreceding, -base_days))


def seasonal_value(value: str, base_days: int, keys: Sequence[str] = ("store", "dept", "month", "week"),
                   mode: str = "first") -> Column:
    """Value of the same (month, Sunday-week) season at least ``base_days``
    back (W5).  ``first`` is the oldest such row (NULLs respected), as the
    feature is defined; ``last`` gives the most recent one."""
    w = _frame(keys, Window.unboundedPreceding, -base_days)
    if mode == "first":
        return F.first(value, ignorenulls=False).over(w)
    if mode == "last":
        return F.last(value, ignorenulls=False).over(w)
    raise ValueError(mode)


def lead_lag(df: DataFrame, cols: Sequence[str], keys: Sequence[str] = SERIES, order: str = "dt",
             n: int = 1) -> DataFrame:
    """``{c}_lead{n}`` / ``{c}_lag{n}`` per series."""
    w = Window.partitionBy(*keys).orderBy(order)
    out = {}
    for c in cols:
        out[f"{c}_lead{n}"] = F.lead(c, n).over(w)
        out[f"{c}_lag{n}"] = F.lag(c, n).over(w)
    return df.withColumns(out)


def rolling_mean(df: DataFrame, value: str, keys: Sequence[str] = SERIES, order: str = "dt", rows: int = 2,
                 out: str | None = None, fallback: bool = True) -> DataFrame:
    """Mean of the last ``rows`` rows per series, NULL unless all are present;
    optionally falling back to the row's own value (W8)."""
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(-(rows - 1), 0)
    mean = F.when(F.count(value).over(w) == rows, F.avg(value).over(w))
    if fallback:
        mean = F.coalesce(mean, F.col(value))
    return df.withColumn(out or f"{value}_rolling_mean", mean)
