"""Descriptive aggregates over the panel.

All of them are groupBy aggregations (partial aggregation before the
shuffle), so hot keys are combined map-side; only scalars reach the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidecast.operators.windows import SERIES


def group_mean(df: DataFrame, keys: Sequence[str], cols: Sequence[str], prefix: str = "mean_") -> DataFrame:
    """Mean of each column per group (A1, A2)."""
    return df.groupBy(*keys).agg(*[F.avg(c).alias(prefix + c) for c in cols])


def series_length(df: DataFrame, keys: Sequence[str] = SERIES, dt: str = "dt") -> DataFrame:
    """Number of dated rows per series (A4)."""
    return df.groupBy(*keys).agg(F.count(dt).alias("n_weeks"))


def sparse_series(df: DataFrame, keys: Sequence[str] = SERIES, n: int = 20) -> DataFrame:
    """Series with fewer than ``n`` rows (HAVING, P10)."""
    return series_length(df, keys).where(F.col("n_weeks") < n)


def rows_of(df: DataFrame, series: DataFrame, keys: Sequence[str] = SERIES) -> DataFrame:
    """Rows of ``df`` whose key equals one of ``series`` (conjunctive equality
    match as a left-semi join, P9)."""
    return df.join(series.select(*keys), list(keys), "left_semi")


def histogram(df: DataFrame, col: str, bins: int = 10) -> DataFrame:
    """Equal-width histogram between min and max, last bin closed (A5).

    The two bounds are one scalar subquery, read by the distributed groupBy;
    nothing runs before the result does.  No value, no bins.
    """
    x = F.col(col).cast("double")
    ends = df.agg(F.struct(F.min(x).alias("lo"), F.max(x).alias("hi"))).scalar()
    rows = df.where(F.col(col).isNotNull()).select(x.alias("x"), ends.alias("ends"))
    lo, width = F.col("ends.lo"), (F.col("ends.hi") - F.col("ends.lo")) / bins
    at = F.when(width == 0, F.lit(0)).otherwise(F.least(F.floor(F.try_divide(F.col("x") - lo, width)), F.lit(bins - 1)))
    counts = rows.select(lo.alias("first"), width.alias("width"), at.cast("int").alias("bin")).groupBy("bin", "first", "width").agg(F.count(F.lit(1)).alias("n"))
    return counts.select(
        "bin",
        (F.col("first") + F.col("bin") * F.col("width")).alias("lo"),
        (F.col("first") + (F.col("bin") + 1) * F.col("width")).alias("hi"),
        "n",
    )


def distinct_counts(df: DataFrame, cols: Sequence[str | tuple[str, ...]]) -> DataFrame:
    """Exact distinct counts of columns or column tuples."""
    out = []
    for c in cols:
        group = (c,) if isinstance(c, str) else tuple(c)
        out.append(F.count_distinct(*[F.col(x) for x in group]).alias("n_" + "_".join(group)))
    return df.agg(*out)


def distinct_sketches(df: DataFrame, by: Sequence[str], values: dict[str, Sequence[str]], lg: int = 12) -> DataFrame:
    """Theta sketches of each named column tuple by ``by``: a small table to
    store with the panel.  Sketches of any groups merge to that of their union
    (A6, U3); counts are exact up to 2^lg values and within about 2 / sqrt(2^lg)
    beyond."""
    return df.groupBy(*by).agg(*[F.theta_sketch_agg(F.concat_ws("\u0001", *[F.col(c).cast("string") for c in cols]), lg).alias(name) for name, cols in values.items()])


def merged_counts(sketches: DataFrame, names: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Estimated distinct counts of the union of the groups' sketches."""
    return sketches.groupBy(*by).agg(*[F.theta_sketch_estimate(F.theta_union_agg(n)).alias(f"n_{n}") for n in names])


def sketch_overlap(a: DataFrame, b: DataFrame, name: str) -> DataFrame:
    """:func:`overlap` from stored sketches: each side merged, then their
    differences and intersection; neither table's keys are shuffled again."""
    both = a.agg(F.theta_union_agg(name).alias("_a")).withColumn("_b", b.agg(F.theta_union_agg(name)).scalar())
    return both.select(
        F.theta_sketch_estimate(F.theta_difference("_a", "_b")).alias("only_left"),
        F.theta_sketch_estimate(F.theta_difference("_b", "_a")).alias("only_right"),
        F.theta_sketch_estimate(F.theta_intersection("_a", "_b")).alias("both"),
    )


def date_span(df: DataFrame, dt: str = "dt") -> DataFrame:
    """First and last date."""
    return df.agg(F.min(dt).alias("first_dt"), F.max(dt).alias("last_dt"), F.count(dt).alias("n_rows"))


def pivot_sum(df: DataFrame, row: str, col: str, value: str, values: Sequence, fill: float | None = 0.0) -> DataFrame:
    """SUM(value) by (row, col) turned wide, one column per declared value of
    ``col``, missing cells filled (A8, A9).  A value that is not declared
    raises an error when the plan runs, so nothing is left out silently."""
    unknown = F.raise_error(F.concat(F.lit(f"{col} has a value that is not declared: "), F.coalesce(F.col(col).cast("string"), F.lit("null"))))
    checked = F.when(F.col(col).isin(list(values)), F.col(value)).otherwise(unknown.cast(df.schema[value].dataType))
    out = df.withColumn(value, checked).groupBy(row).pivot(col, list(values)).agg(F.sum(value))
    if fill is not None:
        out = out.na.fill(fill)
    return out


def sparse_sum(df: DataFrame, row: str, col: str, value: str) -> DataFrame:
    """SUM(value) by (row, col) as a map column ``sums`` for each row (A8, A9):
    the values of ``col`` need not be known, and a row holds only those that it has,
    whatever their number in all.  Rows without a ``col`` have no entry.
    :func:`dense` makes columns of chosen values."""
    cells = df.where(F.col(col).isNotNull()).groupBy(row, col).agg(F.sum(value).alias("_sum"))
    return cells.groupBy(row).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(col, "_sum")))).alias("sums"))


def dense(sparse: DataFrame, row: str, values: Sequence, fill: float | None = 0.0) -> DataFrame:
    """Columns of :func:`sparse_sum` for chosen values, others left out."""
    out = sparse.select(row, *[F.try_element_at("sums", F.lit(v)).alias(str(v)) for v in values])
    return out if fill is None else out.na.fill(fill)


def yoy_week_mean(df: DataFrame, value: str = "sales", dt: str = "dt") -> DataFrame:
    """Mean by (year, ISO week of year), all years in one aggregation (A3)."""
    return df.groupBy(F.year(dt).alias("year"), F.weekofyear(dt).alias("weekofyear")).agg(
        F.avg(value).alias("mean_" + value)
    )


def overlap(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Sizes of only-left / only-right / both over distinct key tuples (U3),
    one full outer join of the two distinct key sets."""
    la = a.select(*keys).distinct().withColumn("_a", F.lit(True))
    rb = b.select(*keys).distinct().withColumn("_b", F.lit(True))
    j = la.join(rb, list(keys), "full_outer")
    return j.agg(
        F.count(F.when(F.col("_a") & F.col("_b").isNull(), 1)).alias("only_left"),
        F.count(F.when(F.col("_b") & F.col("_a").isNull(), 1)).alias("only_right"),
        F.count(F.when(F.col("_a") & F.col("_b"), 1)).alias("both"),
    )


def holiday_calendar(df: DataFrame, by: str = "dt", flag: str = "is_holiday") -> DataFrame:
    """Distinct (date or week, holiday flag) pairs, sorted."""
    return df.select(by, F.coalesce(F.col(flag), F.lit(False)).alias(flag)).distinct().orderBy(by, flag)


def top_k(df: DataFrame, by: str, k: int, tie_break: Sequence[str] = ()) -> DataFrame:
    """The k largest rows by ``by`` with a deterministic tie order."""
    return df.orderBy(F.col(by).desc(), *[F.col(c).asc() for c in tie_break]).limit(k)
