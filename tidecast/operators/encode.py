"""Encoding, imputation and scaling fitted on one frame, applied to others
(A19, M1-M4).

Code tables are numbered once, written to the shared folder and read by
every encode and decode; means and deviations are scalar subqueries of the
plan that applies them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DateType, FractionalType, IntegralType

from tidecast.sources.io import scratch_path

#: Bits of monotonically_increasing_id that number the rows of a partition.
ROW_BITS = 33


def _sort_key(df: DataFrame, col: str) -> tuple[Column, Column]:
    """(number, text) that order the values of a column; one of them is NULL."""
    kind, c = df.schema[col].dataType, F.col(col)
    if isinstance(kind, DateType):
        c, kind = F.unix_date(c), IntegralType()
    if isinstance(kind, FractionalType):
        return c.cast("double"), F.lit(None).cast("string")
    if isinstance(kind, (BooleanType, IntegralType)):
        return c.cast("decimal(20,0)").cast("double"), F.lit(None).cast("string")
    return F.lit(None).cast("double"), c.cast("string")


def write_codes(df: DataFrame, cols: Sequence[str]) -> str:
    """Path of a table (name, value as text, code) of the distinct values of
    all columns, one folder for each name.

    One pass finds the distinct values.  They are sorted over range partitions
    and written with their partition and their place in it; a value's code is
    its place among its column's, moved up by what the partitions before
    hold.  No task numbers a whole column, and the only list of all
    partitions has one line for each column and partition.
    """
    spark, each = df.sparkSession, []
    for c in cols:
        number, text = _sort_key(df, c)
        each.append(F.struct(F.lit(c).alias("name"), F.col(c).cast("string").alias("value"), F.col(c).isNotNull().alias("present"), number.alias("number"), text.alias("text")))
    order = ["name", "present", "number", "text", "value"]
    levels = df.select(F.inline(F.array(*each))).distinct().repartitionByRange(*order).sortWithinPartitions(*order)
    place = F.monotonically_increasing_id()
    placed = levels.select("name", "value", place.alias("place"))
    path = scratch_path(spark, "levels")
    placed.write.parquet(path)
    placed = spark.read.schema(placed.schema).parquet(path)
    part = F.shiftright("place", ROW_BITS)
    sizes = placed.groupBy("name", part.alias("part")).agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("name").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    sizes = sizes.select(F.col("name").alias("_name"), F.col("part").alias("_part"), "first", F.coalesce(before, F.lit(0)).alias("before"))
    coded = placed.join(sizes, (F.col("name") == F.col("_name")) & (part == F.col("_part")))
    out = scratch_path(spark, "codes")
    coded.select("name", "value", (F.col("before") + F.col("place") - F.col("first")).cast("int").alias("code")).write.partitionBy("name").parquet(out)
    return out


def code_tables(df: DataFrame, cols: Sequence[str]) -> dict[str, DataFrame]:
    """{column: (value, code)}, codes in sorted value order, 0-based, NULL
    first (M1).  Sorting is by the typed value, so integers order 1, 2, 10
    (not the string order a string indexer would use)."""
    path, read = write_codes(df, cols), df.sparkSession.read.schema("value string, code int, name string")
    return {c: read.parquet(path).where(F.col("name") == c).select(F.col("value").cast(df.schema[c].dataType).alias("value"), "code") for c in cols}


def fit_codes(df: DataFrame, col: str) -> DataFrame:
    """(value, code) of one column (M1)."""
    return code_tables(df.select(col), [col])[col]


def label_encode(df: DataFrame, cols: Sequence[str], fit_on: DataFrame | None = None) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Replace each column by its code; codes are fitted on ``fit_on`` (default
    ``df``, e.g. history + future together)."""
    maps, out = code_tables((df if fit_on is None else fit_on).select(*cols), cols), df
    for c, m in maps.items():
        out = out.join(m, out[c].eqNullSafe(m["value"]), "left").drop(c, "value").withColumnRenamed("code", c)
    return out.select(*df.columns), maps


def label_decode(df: DataFrame, maps: dict[str, DataFrame]) -> DataFrame:
    """Inverse of :func:`label_encode` (M2)."""
    out = df
    for c, m in maps.items():
        out = out.join(m, out[c] == m["code"], "left").drop(c, "code").withColumnRenamed("value", c)
    return out.select(*df.columns)


FIT = "_fit"


def _with_fitted(frames: Sequence[DataFrame], train: DataFrame, cols: Sequence[str], **of) -> list[DataFrame]:
    """The frames with one column that holds every statistic of every
    column: a scalar subquery that each frame refers to once."""
    fit = train.agg(F.struct(*[f(c).alias(f"{name}_{c}") for c in cols for name, f in of.items()])).scalar()
    return [df.withColumn(FIT, fit) for df in frames]


def impute_mean(train: DataFrame, test: DataFrame, cols: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Fill NULLs with the training mean in both frames (A19, M4); a column
    with no training value at all is filled with 0."""
    fill = {c: F.coalesce(F.col(c).cast("double"), F.col(f"{FIT}.m_{c}"), F.lit(0.0)) for c in cols}
    a, b = (df.withColumns(fill).drop(FIT) for df in _with_fitted((train, test), train, cols, m=F.avg))
    return a, b


def standardize(train: DataFrame, test: DataFrame, cols: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(x - mean) / population std fitted on ``train``; a constant column
    maps to 0, one without a training value stays as it is (M3)."""
    exprs = {}
    for c in cols:
        x, m, s = F.col(c).cast("double"), F.col(f"{FIT}.m_{c}"), F.col(f"{FIT}.s_{c}")
        exprs[c] = F.when(m.isNull(), x).otherwise((x - m) / F.when(s > 0, s).otherwise(1.0))
    a, b = (df.withColumns(exprs).drop(FIT) for df in _with_fitted((train, test), train, cols, m=F.avg, s=F.stddev_pop))
    return a, b
